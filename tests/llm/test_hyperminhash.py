"""HyperMinHash components against all pairs compared; registers and their collision-corrected estimate."""

import random
import re

import numpy as np
import pytest
from tests_llm_data import EDGE, prose

from starmart.llm import hyperminhash
from starmart.llm.common import ASCII_LOWER, mix64
from starmart.llm.hyperminhash import band_keys, collision_rate, compressed, estimate, linked, one_of_each, plausible, registers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=4):
    w = WORD.findall((text or "").translate(ASCII_LOWER))
    return {" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, percent=80):
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    ids = [least.get(find(i)) if sets[i] else rows[i][0] for i in range(len(rows))]
    return sorted(
        ((d, len(s), c, d is not None and d == c) for (d, _), s, c in zip(rows, sets, ids)), key=lambda t: [(x is not None, x) for x in t]
    )


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(x is not None, x) for x in t])


def edited(r, words, edits):
    words = list(words)
    for _ in range(edits):
        words[r.randrange(len(words))] = f"e{r.randrange(10**6)}"
    return words


def corpus(seed):
    """Groups around a text by scattered edits, chains of blocks moved on, shared openings, and short texts."""
    r, out = random.Random(seed), []
    for g in range(8):
        base = prose(seed * 100 + g, r.choice([25, 60, 200, 500]), 3000).split()
        for _ in range(12):
            out.append(" ".join(edited(r, base, r.randrange(0, max(2, len(base) // 14)))))
    long = prose(seed * 100 + 50, 600, 3000).split()
    out += [" ".join(long[i * 12 : i * 12 + 240]) for i in range(12)]  # a chain
    opening = prose(seed * 100 + 51, 150, 3000)
    out += [opening + " " + prose(seed * 100 + 60 + i, 40, 3000) for i in range(30)]
    out += [" ".join(r.choice("abcde") for _ in range(r.randrange(0, 9))) for _ in range(60)]
    out += ["A b\tc", "a  b\nc", "", " \t\r\n", None]
    r.shuffle(out)
    return list(enumerate(out, 100))


@pytest.mark.parametrize("block", [4096, 5])
def test_against_all_pairs(spark, frame, monkeypatch, block):
    monkeypatch.setattr(hyperminhash, "BLOCK", block)
    rows = corpus(block) + [(None, "x y z u v w"), (None, "x y z u v w"), (7, "x y z u v w"), (7, "x y z u v w"), (None, "no id at all here")]
    df = frame([(i, t, "en", "s", 0) for i, t in rows], ["node", "least", "key", "n", "regs", "component_id"]).repartition(6)
    got = result(linked(df))
    assert got == brute(rows) and len({c for _, _, c, _ in got}) > 40
    kept = one_of_each(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, *_, k in got if k}


def test_edge_cases(spark, frame, edge):
    assert linked(frame([])).count() == 0
    assert result(linked(edge)) == brute([(d, t) for d, t, *_ in EDGE])


def test_hot_group_is_not_paired_with_itself(spark, frame):
    """Of copies of one text almost all link to it: the cross step gets the few others."""
    r = random.Random(3)
    base = prose(1, 300, 3000).split()
    rows = [(i, " ".join(edited(r, base, r.randrange(0, 9)))) for i in range(400)]
    df = frame([(i, t, "en", "s", 0) for i, t in rows])
    assert len({c for *_, c, _ in result(linked(df))}) == 1
    classes = hyperminhash.stage(
        hyperminhash.prints(df).groupBy("s1", "s2").agg({"keys": "first", "n": "max"}).toDF("s1", "s2", "keys", "n")
        .selectExpr("*", "monotonically_increasing_id() AS node")
    )
    lists = hyperminhash._lists(classes)
    stars = lists.filter("node <> centre").select("node", "centre").distinct()
    assert stars.count() < 6 * len(rows)
    most = lists.groupBy("centre").count().orderBy("count", ascending=False).first()
    assert most["count"] > 0.5 * lists.count()


def sets(n, share, seed):
    """Two sets of hashes of n members each with the given similarity."""
    r = np.random.default_rng(seed)
    both = round(2 * n * share / (1 + share))
    h = mix64(r.integers(1, 1 << 62, 2 * n - both).astype(np.uint64))
    return np.sort(h[:n]), np.sort(h[n - both :])


@pytest.mark.parametrize("n,share", [(200, 0.8), (5000, 0.5), (100_000, 0.0), (2000, 0.95)])
def test_estimate(n, share):
    found = []
    for seed in range(60):
        a, b = (compressed(registers(x))[None, :] for x in sets(n, share, seed))
        used, equal = ((a | b) != 0).sum(1), ((a == b) & (a != 0)).sum(1)
        found.append(float(estimate(equal, used, np.array([n]), np.array([n]))[0]))
    assert abs(np.mean(found) - share) < 0.02


def test_collision_rate_is_what_is_met():
    for n in (1500, 40_000):
        met = []
        for seed in range(40):
            a, b = (compressed(registers(x)) for x in sets(n, 0.0, seed))
            met.append(((a == b) & (a != 0)).sum() / ((a != 0) & (b != 0)).sum())
        assert abs(np.mean(met) - float(collision_rate(np.array([n]), np.array([n]))[0])) < 0.005


@pytest.mark.parametrize("n", [5, 9, 40, 170, 600, 5000, 60_000])
def test_no_pair_at_the_bound_is_ruled_out(n):
    for seed in range(150):
        a, b = sets(n, 0.8, seed)
        x, y = registers(a), registers(b)
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            assert plausible(compressed(x)[None, :], compressed(y)[None, :], np.array([len(a)]), np.array([len(b)]), 80).all()
            k, m = band_keys(np.stack([x, y]))
            assert ((k == m) & (k != 0)).any()
    a, b = sets(n, 0.55, 1)
    assert n < 40 or not plausible(compressed(registers(a))[None, :], compressed(registers(b))[None, :], np.array([n]), np.array([n]), 80).any()


def test_registers_keep_the_smallest_of_a_bucket():
    h = np.sort(mix64(np.arange(1, 5000, dtype=np.uint64)))
    got, short = registers(h), compressed(registers(h))
    for b in (0, 5, 511):
        low = min(int(x) for x in h if int(x) >> 55 == b) << 9 & (1 << 64) - 1
        bits = f"{low:064b}"
        zeros = len(bits) - len(bits.lstrip("0"))
        mantissa = int(bits[zeros + 1 : zeros + 11].ljust(10, "0"), 2)
        assert int(got[b]) == (zeros + 1) << 10 | 1023 - mantissa
        assert int(short[b]) == (zeros + 1) << 3 | (1023 - mantissa) >> 7
    assert not registers(np.zeros(0, np.uint64)).any() and registers(np.zeros(1, np.uint64))[0] > 0
    assert (band_keys(registers(h[:3])[None, :]) != 0).sum() <= 3
    top = registers(h).reshape(128, 4).max(1)
    assert top[7] == max(registers(h[(h >> np.uint64(57)) == 7]))
