import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tests_llm_data import EDGE, prose

from starmart.llm import langid as L
from starmart.llm import quality as Q
from starmart.llm.common import read

SF = "/root/testdata/sf0.01"


def test_square_identity():
    r = np.random.default_rng(1)
    x, m = r.normal(size=(5, 30)), Q.Model(0.3, r.normal(size=30), r.normal(size=(30, 4)))
    pairs = [sum(m.factors[i] @ m.factors[j] * row[i] * row[j] for i in range(30) for j in range(i)) for row in x]
    assert np.allclose(m.margin(x), 0.3 + x @ m.linear + pairs)


def test_interactions_are_learned():
    r = np.random.default_rng(2)
    x = r.choice([-1.0, 1.0], size=(2000, 6)).astype(np.float32)
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    m = Q.train(x, y, np.ones(len(y)), epochs=60)
    assert ((m.scores(x) > 0.5) == y).mean() > 0.95


def test_quality_on_held_out_rows(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    got = {r["doc_id"]: r for r in Q.score(docs.select("doc_id", "text", "n_chars"), Q.fit(docs, labels)).collect()}
    assert len(got) == docs.count()
    marks = pq.read_table(f"{SF}/labels.parquet").to_pydict()
    held = [(d, q) for d, q in zip(marks["doc_id"], marks["quality"]) if zlib.crc32(str(d).encode()) % 5 == 0]
    assert sum(got[d]["predicted"] == q for d, q in held) >= 0.97 * len(held)


def test_quality_edges(edge, frame, spark):
    nothing = Q.fit(edge, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["score"] for r in Q.score(edge, nothing).collect()} == {0.5}
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (7, 1), (None, 0), (6, None), (999, 0), (6, 0), (1, 0), (2, 0)], "doc_id long, quality int")
    model = Q.fit(edge, labels)
    out = Q.score(edge, model)
    assert set(out.columns) == set(edge.columns) | {"predicted"} and out.columns.count("score") == 1
    rows = out.collect()
    assert len(rows) == len(EDGE) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= Q.THRESHOLD) for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 4}) == 1
    assert Q.score(frame([]), model).count() == 0
    assert np.isfinite(Q.features("x" * 500_000, None)).all() and np.isfinite(Q.features(None, -5)).all()


def test_statistics():
    v = Q.features("AAA!! bbb bbb | c.\nx\nx", 20)[Q.WORD_BUCKETS :]
    named = dict(zip(Q.STATISTICS, v.tolist()))
    assert named["distinct lines"] == pytest.approx(2 / 3) and named["words after themselves"] == pytest.approx(2 / 7)
    assert named["words ending in marks"] == pytest.approx(1 / 7) and named["stated length is missing"] == 0


def test_language_on_held_out_rows(spark):
    docs = read(spark, SF, "documents")
    model = L.fit(docs)
    got = {r["doc_id"]: r for r in L.predict(docs, model).collect()}
    t = pq.read_table(f"{SF}/documents.parquet").to_pydict()
    held = [(d, x) for d, x in zip(t["doc_id"], t["lang"]) if x and zlib.crc32(str(d).encode()) % 5 == 0]
    assert sum(got[d]["lang_pred"] == x for d, x in held) >= 0.97 * len(held)
    sure = [(d, x) for d, x in held if got[d]["accepted"]]
    assert len(sure) > 0.8 * len(held) and sum(got[d]["lang_pred"] == x for d, x in sure) >= 0.98 * len(sure)


def test_language_predictions_against_brute_force(frame):
    """The model's own numbers, n-gram by n-gram."""
    r = np.random.default_rng(5)
    model = L.Model(["aa", "bb", "cc"], r.normal(size=(L.BUCKETS, L.WIDTH)) * 9, r.normal(size=(L.WIDTH, 3)), r.normal(size=3), 0.5, 0.7)
    texts = ["Ab  c!", "äöü 12 straße", "x", "The quick brown fox\njumps"]
    for got in L.predict(frame([(i, t, None, None, None) for i, t in enumerate(texts)]), model).collect():
        low = "".join(c if ord(c) > 127 or "a" <= c <= "z" else " " for c in texts[got["doc_id"]].lower())
        c = [x for i, x in enumerate(low) if x != " " or i == 0 or low[i - 1] != " "]
        total, n = np.zeros(L.WIDTH), 0
        for k in L.GRAMS:
            for i in range(len(c) - k + 1):
                h = 0
                for x in c[i : i + k]:
                    h = (h * int(L.BASE) + ord(x)) % 2**64
                total, n = total + model.embeddings[int(L.mix64(np.array([(h + k) % 2**64], np.uint64))[0]) >> 52], n + 1
        z = (total / n @ model.weights + model.bias) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert got["lang_pred"] == model.languages[int(p.argmax())] and got["score"] == pytest.approx(float(p.max()), abs=1e-4)
        assert got["accepted"] == (p.max() >= 0.7)


def test_sample_of_many_languages_is_bounded(frame, monkeypatch):
    seen = []
    monkeypatch.setattr(L, "train", lambda x, y, languages: seen.append((x, y, languages)))
    docs = frame([(i, prose(i, 12), f"l{i % 300}", "s", 1) for i in range(6000)])
    L.fit(docs, most_rows=900)
    x, y, languages = seen[0]
    assert len(languages) > 250 and 600 < len(y) == len(x) < 1300
    assert x.at.nbytes + x.share.nbytes < len(y) * 6 * 1000 and x.some(np.arange(5)).shape == (5, L.BUCKETS)
    assert np.allclose(x.some(np.arange(5)).sum(1), 1, atol=1e-4)


def test_language_edges(edge, frame):
    model = L.fit(edge)
    rows = L.predict(edge, model).collect()
    assert len(rows) == len(EDGE)
    by = {r["doc_id"]: r for r in rows}
    for d in (1, 2, 6, 8):
        assert (by[d]["lang_pred"], by[d]["score"], by[d]["accepted"]) == ("und", 0.0, False)
    assert all(r["lang_pred"] in {"en", "de", "fr"} for r in rows if r["doc_id"] not in (1, 2, 6, 8))
    empty = L.fit(frame([]))
    assert {r["lang_pred"] for r in L.predict(edge, empty).collect()} == {"und"}
    assert L.predict(frame([]), model).count() == 0
