import random

import numpy as np
import xxhash
from tests_llm_data import EDGE, prose

from starmart.llm import simhash as S


def brute_fp(text, k=3):
    words = (text or "").encode().lower().split()
    shingles = [words[i : i + k] for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, bits=3):
    out = list(range(len(fps)))
    for _ in fps:
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if bin(a ^ b).count("1") <= bits:
                    out[i] = out[j] = min(out[i], out[j])
    least = {}
    for i, d in zip(out, ids):
        least.setdefault(i, []).append(d)
    return [min((x for x in least[i] if x is not None), default=None) for i in out]


def test_linked_against_brute_force(frame, edge):
    texts, r = list(EDGE), random.Random(3)
    for i in range(40):
        words = prose(i % 4, 300).split()
        for _ in range(r.randrange(4)):
            words[r.randrange(300)] = "changed"
        texts.append((100 + i, " ".join(words), None, None, None))
    got = S.linked(frame(texts)).collect()
    fps = [brute_fp(t[1]) for t in texts]
    want = sorted(zip([t[0] for t in texts], (f"{f:016x}" for f in fps), brute_components([t[0] for t in texts], fps)), key=str)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str) == want
    assert S.linked(edge).count() == len(EDGE)
    assert S.linked(frame([])).count() == 0


def test_every_link_within_three_bits_shares_a_list(spark):
    r = random.Random(1)
    pairs = []
    for _ in range(300):
        a = r.getrandbits(64)
        b = a
        for bit in r.sample(range(64), 3):
            b ^= 1 << bit
        pairs.append((a, b))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    fps = spark.createDataFrame([(signed(x),) for x in {y for p in pairs for y in p}], "fp long")
    root = {r["node"]: r["root"] for r in S.components(S.links(fps)).collect()}
    assert all(root[signed(a)] == root[signed(b)] for a, b in pairs)


def test_runs_long_and_short(monkeypatch):
    r = np.random.default_rng(2)
    values = np.unique(r.integers(0, 1 << 20, 3000).astype(np.uint64))
    short = S.run_roots(values, 2)
    monkeypatch.setattr(S, "LONG_RUN", 10)
    long_ = S.run_roots(values, 2)
    assert (short == long_).all()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 140)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in S.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}}


def test_one_of_each_against_brute_force(frame, edge):
    texts, r = list(EDGE), random.Random(4)
    for i in range(40):
        words = prose(i % 4, 300).split()
        for _ in range(r.randrange(4)):
            words[r.randrange(300)] = "changed"
        texts.append((100 + i, " ".join(words), "en", "s", None))
    groups = brute_components([t[0] for t in texts], [brute_fp(t[1]) for t in texts])
    for extra in ([], texts[-1:]):  # also with a row that is repeated
        kept = S.one_of_each(frame(texts + extra, ["fp", "root", "_stays_", "r"]))
        got = kept.collect()
        assert kept.columns == [*frame([]).columns, "fp", "root", "_stays_", "r"]
        assert sorted((x["doc_id"] for x in got), key=str) == sorted(set(groups), key=str)
        assert all((x["doc_id"], x["text"], x["lang"], x["source"], x["n_chars"]) in texts for x in got)
    unique = [t for t in texts if t[0] is not None and t[0] != 4]
    want = set(brute_components([t[0] for t in unique], [brute_fp(t[1]) for t in unique]))
    assert {x["doc_id"] for x in S.one_of_each(frame(unique)).collect()} == want


def test_one_of_each_edges(frame, edge):
    kept = S.one_of_each(edge)
    assert kept.columns == edge.columns
    ids = [x["doc_id"] for x in kept.collect()]
    assert sorted(map(str, ids)) == sorted(map(str, [1, None, 4, 5, 6, 7]))  # null, empty and blank texts are alike
    assert S.one_of_each(frame([])).count() == 0
    nobody = S.one_of_each(frame([(None, "a b c", None, None, None), (None, "A b  c", None, None, None)]))
    assert nobody.count() == 1
    # one id on two texts of different groups: both groups keep their row
    two = S.one_of_each(frame([(3, prose(1, 50), None, None, None), (3, prose(2, 50), None, None, None), (4, prose(2, 50), None, None, None)]))
    assert sorted(x["text"] for x in two.collect()) == sorted([prose(1, 50), prose(2, 50)])
