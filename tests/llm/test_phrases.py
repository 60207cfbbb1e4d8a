"""Collocations against brute-force counts; the local graph against direct counts; arithmetic beyond 64 bits."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from tests_llm_data import EDGE

from starmart.llm import bitmaps, phrases
from starmart.llm.common import ASCII_LOWER, BATCH_ROWS

SPLIT, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")


def brute(rows, least, limit):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in SPLIT.split((text or "").translate(ASCII_LOWER)):
            w = WORD.findall(piece)
            lang_ = "und" if lang is None else lang
            n[lang_] += len(w)
            for k in range(1, 6):
                f[lang_].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = set()
        for p, a in cand.items():
            for k in range(2, len(p)):
                inside |= {p[i : i + k] for i in range(len(p) - k + 1) if 100 * a >= 100 * counts[p[i : i + k]]}
        kept = []
        for p, a in cand.items():
            if p not in inside:
                cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:limit], 1)]
    return out


def corpus(seed, docs):
    r = random.Random(seed)
    stock = [" ".join(f"s{r.randrange(30)}" for _ in range(r.randrange(2, 14))) for _ in range(12)]
    out = []
    for _ in range(docs):
        parts = [r.choice(stock) if r.random() < 0.5 else " ".join(f"w{int(r.paretovariate(0.8)) % 400}" for _ in range(r.randrange(1, 9)))
                 for _ in range(r.randrange(0, 25))]
        out.append(("".join(p + r.choice([" ", ". ", ", ", "\n", "; \t"]) for p in parts), r.choice(["en", "de", None])))
    return out


@pytest.mark.parametrize("least,graph_words", [(4, 1 << 21), (4, 300), (25, 1 << 21)])
def test_against_brute_force(spark, frame, monkeypatch, least, graph_words):
    monkeypatch.setattr(phrases, "GRAPH_WORDS", graph_words)
    monkeypatch.setattr(phrases, "ROW_WORDS", 1 << 13 if graph_words > 300 else 20)
    monkeypatch.setattr(phrases, "SLICE_WORDS", 1 << 19 if graph_words > 300 else 64)
    monkeypatch.setattr(phrases, "HELD_GRAMS", 1 << 19 if graph_words > 300 else 100)
    rows = corpus(least, 400) + [("a A a a a a a", "xx"), ("b c b c b c b c b c", "xx")] * 3
    df = frame([(i, t, lang, "s", 0) for i, (t, lang) in enumerate(rows)], ["word", "h", "f", "size", "w1"]).repartition(5)
    got = phrases.collocations(df, least, 50).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, least, 50))
    assert len(got) > 20


def test_full_bitmaps_change_nothing(spark, frame, monkeypatch):
    rows = corpus(9, 200)
    df = frame([(i, t, lang, "s", 0) for i, (t, lang) in enumerate(rows)])
    monkeypatch.setattr(bitmaps, "MOST_BITS", 64)
    assert sorted(map(tuple, phrases.collocations(df, 4, 1000).collect())) == sorted(brute(rows, 4, 1000))


def test_edge_cases(spark, frame, edge):
    assert phrases.collocations(frame([])).count() == 0
    for least, limit in ((100, 2000), (2, 10)):
        want = brute([(t, lang) for _, t, lang, *_ in EDGE], least, limit)
        assert sorted(map(tuple, phrases.collocations(edge, least, limit).collect())) == sorted(want)


def unpacked(stream):
    """Edges, ends of pieces and path lengths of a stream's compact graph."""
    edges, tails, lengths = Counter(), Counter(), []
    for words, ends, weights, is_end in phrases.local_graph(stream):
        assert words[-1] == 0 and len(ends) == len(weights)
        for path, w in zip(np.split(words, ends[:-1]), weights.tolist()):
            path = tuple(path[:-1])
            assert all(path)
            if is_end:
                tails[path] += w
            else:
                lengths.append(len(path))
                edges.update({path[i : i + 5]: 0 for i in range(len(path) - 4)})
                for i in range(len(path) - 4):
                    edges[path[i : i + 5]] += w
    return edges, tails, lengths


def test_local_graph_compacts_chains_and_keeps_all_counts():
    r = np.random.default_rng(3)
    for alphabet in (9, 3, 200):
        stock = [r.integers(1, alphabet, r.integers(1, 30)) for _ in range(6)]
        stream = np.concatenate([np.append(stock[i], 0) for i in r.integers(0, 6, 200)]).astype(np.int64)
        edges, tails, lengths = unpacked(stream)
        pieces = [tuple(x[x != 0]) for x in np.split(stream, np.flatnonzero(stream == 0))]
        want = Counter(p[i : i + 5] for p in pieces for i in range(len(p) - 4))
        assert edges == want and len(lengths) <= len(want)
        assert tails == Counter(p[-4:] for p in pieces if p)
    assert unpacked(np.append(np.tile(np.append(np.arange(1, 51), 0), 7), 0))[2] == [50]  # one chain, seven times
    ring = np.array([1, 2, 3, 4, 5, 6] * 9 + [1, 2, 3, 4, 0], np.int64)
    assert unpacked(ring)[0] == Counter(tuple(ring[i : i + 5]) for i in range(len(ring) - 5))


def test_rows_of_the_graph_are_small_however_long_a_path_is(spark, frame):
    words = [f"w{i}" for i in range(30_000)]
    docs = frame([(i, " ".join(words[i:]), "en", "s", 0) for i in range(3)]).coalesce(1)
    rows = phrases.graph(docs, bitmaps.Bitmap(np.full(1, -1, np.int64).view(np.uint64))).collect()
    # what an Arrow batch of such rows may take, in the JVM and in its Python worker
    assert max(8 * (len(r["words"]) + len(r["weights"])) for r in rows) * BATCH_ROWS <= 16 << 20
    edges = Counter()
    for r in rows:
        if not r["is_end"]:
            for end, weight in zip([i for i, w in enumerate(r["words"]) if w == 0], r["weights"], strict=True):
                begin = max((i + 1 for i in range(end) if r["words"][i] == 0), default=0)
                for i in range(begin, end - 4):
                    edges[tuple(r["words"][i : i + 5])] += weight
    h = [int(np.uint64(phrases.word_hash(w.encode(), 0)).view(np.int64)) for w in words]
    assert edges == Counter(tuple(h[i : i + 5]) for k in range(3) for i in range(k, len(h) - 4))


def rows_from_python(df):
    """Rows that came out of Python while the frame was collected."""
    df.collect()
    todo, out = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        else:
            out += node.metrics().apply("pythonNumRowsReceived").value() if node.nodeName() == "MapInArrow" else 0
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return out


def test_longest_grams_leave_python_as_parts_not_as_places(spark, frame):
    every = bitmaps.Bitmap(np.full(1, -1, np.int64).view(np.uint64))
    h = lambda w: int(np.uint64(phrases.word_hash(w.encode(), 0)).view(np.int64))
    found = lambda df: {tuple(r[w] for w in phrases._W): r["f"] for r in df.collect()}

    # all pairs are frequent: a row for a path, not one for each of its places
    words = [f"w{i}" for i in range(4_000)]
    docs = frame([(i, " ".join(words[i:]), "en", "s", 0) for i in range(3)]).coalesce(1)
    longest = phrases.starts(phrases.graph(docs, every), every)
    hashes = [h(w) for w in words] + [0] * 5
    assert found(longest) == {tuple(hashes[i : i + 5]): min(i + 1, 3) for i in range(len(words) - 1)}
    assert rows_from_python(longest) < 50

    # one pair is frequent: wherever it stands, a row a task
    pair = phrases.gram_hash(np.array([[h("a"), h("b")]]), 2) ^ phrases.lang_hash("en")
    only = bitmaps.bitmap(spark.createDataFrame([(int(pair.view(np.int64)[0]),)], "h long"))
    docs = frame([(i, f"x{i} y{i} a b z{i} a b", "en", "s", 0) for i in range(300)]).coalesce(1)
    longest = phrases.starts(phrases.graph(docs, every), only)
    assert found(longest)[h("a"), h("b"), 0, 0, 0] == 600
    assert rows_from_python(longest) < 50


def test_products_beyond_64_bits(spark):
    zeros = "cast(0 as long) w3, cast(0 as long) w4, cast(0 as long) w5"
    a, n, l, r = 4_000_000_007, 9_000_000_000_001, 5_000_000_000, 7_000_000_011
    pair = spark.sql(f"select 'en' lang, 2 size, 1L w1, 2L w2, {zeros}, {a}L f")
    words = spark.sql(f"select 'en' lang, h, f from values (1L, {l}L), (2L, {r}L) t(h, f)")
    got = phrases.scored(pair, pair, words, spark.sql(f"select 'en' lang, {n}L n")).first()
    assert got["score"] == 1000 * a * n // (l * r) and a * n > 1 << 63 and l * r > 1 << 63
