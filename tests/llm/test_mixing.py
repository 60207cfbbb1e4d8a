import random
import zlib

import numpy as np
import pandas as pd
import pytest
import xxhash
from tests_llm_data import EDGE, prose

from starmart.llm import mixing as M


def cells():
    r = np.random.default_rng(3)
    return pd.DataFrame([(s, l, t, int(r.integers(1, 1000))) for s in "abc" for l in "xy" for t in "012"], columns=["source", "lang", "topic", "tokens"])


def test_raking_meets_all_marginals():
    c = cells()
    targets = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"x": 0.6, "y": 0.4}, "topic": {"0": 0.2, "1": 0.3, "2": 0.5}}
    raked = M.rake(c, targets)
    total = c["tokens"].sum()
    assert raked.sum() == pytest.approx(total)
    for by, want in targets.items():
        for v, share in want.items():
            assert raked[c[by] == v].sum() / total == pytest.approx(share, abs=1e-6)


def test_missing_values_and_targets():
    c = cells().assign(tokens=lambda d: d.tokens.where(d.source != "c", 0))
    raked = M.rake(c, {"source": {"a": 0.5, "c": 0.5}})
    assert raked[c.source == "c"].sum() == raked[c.source == "b"].sum() == 0
    assert raked.sum() == pytest.approx(c.tokens.sum())


def test_probabilities_keep_the_wanted_tokens():
    tokens, raked = np.array([1000.0, 10.0, 0.0, 500.0]), np.array([100.0, 1000.0, 0.0, 400.0])
    p = M.calibrated(tokens, raked, 0.5)
    assert p[1] == 1 and p[2] == 0 and (p * tokens).sum() == pytest.approx(755)
    assert M.calibrated(tokens, raked, 1.0) == pytest.approx([1, 1, 0, 1])
    assert list(M.calibrated(np.zeros(2), np.zeros(2))) == [0, 0]


def docs_of(frame):
    rows = [(i, prose(i, 20 + i % 50), "xy"[i % 3 == 0], "abcd"[min(3, i % 7)], 1) for i in range(1500)]
    return frame(rows)


def test_sample_has_the_target_shares(frame):
    targets = {"source": {"a": 0.25, "b": 0.25, "c": 0.25, "d": 0.25}, "lang": {"x": 0.5, "y": 0.5}}
    got = M.mix(docs_of(frame), keep=0.4, targets=targets).toPandas()
    expected = got.n_tokens * got.probability
    assert expected.sum() == pytest.approx(0.4 * got.n_tokens.sum())
    for by, want in targets.items():
        share = expected.groupby(got[by]).sum() / expected.sum()
        assert all(share[v] == pytest.approx(w, abs=0.02) for v, w in want.items())
    assert (got.n_tokens * got.kept).sum() == pytest.approx(0.4 * got.n_tokens.sum(), rel=0.1)


def brute_mix(rows, keep, power):
    """Tokens, topic, probability and draw of each row by plain loops; sweeps until nothing changes."""
    made = []
    for doc_id, text, lang, source in rows:
        words = (text or "").encode().split()
        votes = [0] * M.TOPICS
        for w in words:
            if len(w) >= M.TOPIC_WORD:
                votes[zlib.crc32(w) % M.TOPICS] += 1
        made.append((source or M.NONE, lang or M.NONE, str(votes.index(max(votes))), len(words)))
    tokens = {}
    for *cell, n in made:
        tokens[tuple(cell)] = tokens.get(tuple(cell), 0) + n
    total, raked = sum(tokens.values()), {c: float(n) for c, n in tokens.items()}
    wanted = []
    for i in range(3):
        have = {}
        for c, n in tokens.items():
            have[c[i]] = have.get(c[i], 0) + n
        want = {v: (n / total) ** power for v, n in have.items() if n}
        wanted.append({v: x / sum(want.values()) * total for v, x in want.items()})
    for _ in range(M.SWEEPS):
        for i, want in enumerate(wanted):
            have = {v: sum(x for c, x in raked.items() if c[i] == v) for v in want}
            raked = {c: x * (want[c[i]] / have[c[i]] if have.get(c[i]) else 1) for c, x in raked.items()}
    weight = {c: raked[c] / n if n else 0.0 for c, n in tokens.items()}
    sure = set()
    while True:
        mass = sum(raked[c] for c in tokens if c not in sure and weight[c])
        scale = (keep * total - sum(tokens[c] for c in sure)) / mass if mass else 0.0
        over = {c for c in tokens if c not in sure and weight[c] * scale > 1}
        if not over:
            break
        sure |= over
    out = []
    for (doc_id, text, *_), (s, l, t, n) in zip(rows, made):
        p = 1.0 if (s, l, t) in sure else weight[s, l, t] * scale
        h = 42
        for part in ([] if doc_id is None else [doc_id.to_bytes(8, "little", signed=True)]) + ([] if text is None else [text.encode()]) + [b"mix"]:
            h = xxhash.xxh64_intdigest(part, h)
        h -= (1 << 64) * (h >> 63)
        out.append((doc_id, n, int(t), p, (h % (1 << 40)) / (1 << 40) < p))
    return sorted(out, key=str)


def test_mix_against_brute_force(frame):
    r = random.Random(2)
    rows = [(i, prose(i, r.randrange(0, 60)) + f" longword{r.randrange(9)}" * r.randrange(4), r.choice(["x", "y", "y", None]), r.choice(["a", "a", "b", None])) for i in range(400)]
    rows += [(None, "no id", "x", "a"), (7, None, "x", "b"), rows[3]]
    df = frame([(*row, 1) for row in rows], ["_source", "_topic", "kept"])
    got = M.mix(df, 0.6, 0.7)
    assert {"_source", "_topic", "kept"} <= set(got.columns) and {x["_source"] for x in got.collect()} == {"x"}
    got = sorted(((x["doc_id"], x["n_tokens"], x["topic"], x["probability"], x["kept"]) for x in got.collect()), key=str)
    want = brute_mix(rows, 0.6, 0.7)
    key = lambda t: (str(t[0]), t[1], t[2])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:3] == w[:3] and g[3] == pytest.approx(w[3], abs=1e-7) and g[4] == w[4]
    assert 0.2 < sum(x[4] for x in got) / len(got) < 0.9


def test_many_cells_as_a_table_give_the_same(frame):
    docs = docs_of(frame)
    a, b = (M.mix(docs, max_cells=m).toPandas().sort_values("doc_id") for m in (1000, 1))
    assert np.allclose(a.probability, b.probability, atol=1e-6) and (a.kept.values == b.kept.values).mean() > 0.999


def test_edges(frame, edge):
    got = M.mix(edge.drop("weight"))
    rows = got.collect()
    assert len(rows) == len(EDGE) and got.columns.count("weight") == 1
    assert all(0 <= r["probability"] <= 1 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 8)} == {0}
    assert len({r["kept"] for r in rows if r["doc_id"] == 4}) == 1
    assert M.mix(frame([])).count() == 0
    assert M.profile(b"") == (0, 0) and M.profile(b"a b c") == (3, 0)


def test_both_forms_agree_on_sparse_cells_that_need_many_sweeps(spark):
    r, rows = np.random.default_rng(11), []
    for i in range(120):
        home = int(r.integers(4))
        for _ in range(3):
            lang = home if r.random() < 0.9 else int(r.integers(4))
            rows.append((f"s{i}", f"l{lang}", int(r.integers(8)), int(r.pareto(0.7) * 10) + 1))
    docs = spark.createDataFrame(rows, "source string, lang string, topic int, n_tokens long")
    given = {"source": {f"s{i}": 1 / 110 for i in range(110)}, "lang": {f"l{i}": 0.25 for i in range(4)}}
    for targets in (None, given):
        a, b = (M.weights(docs, targets=targets, max_cells=m)[0].toPandas() for m in (10_000, 1))
        both = a.merge(b, on=["_source", "_lang", "_topic"], suffixes=("", "_t"))
        assert len(both) == len(a) == len(b)
        assert np.allclose(both.probability, both.probability_t, atol=1e-6)
        assert np.allclose(both.weight, both.weight_t, rtol=1e-6, atol=1e-9)
