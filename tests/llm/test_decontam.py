import random

import numpy as np
import pytest
from tests_llm_data import prose

from starmart.llm import decontam as D


def brute_align(item, passage):
    h = np.zeros((len(passage) + 1, len(item) + 1), int)
    for i in range(1, len(passage) + 1):
        for j in range(1, len(item) + 1):
            step = D.MATCH if item[j - 1] == passage[i - 1] else D.MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + step, h[i - 1, j] + D.GAP, h[i, j - 1] + D.GAP)
    return int(h.max())


def test_alignment_against_the_whole_table():
    r = random.Random(4)
    for _ in range(60):
        item = np.array([r.randrange(4) for _ in range(r.randrange(1, 12))], np.uint64)
        passage = np.array([r.randrange(4) for _ in range(r.randrange(1, 20))], np.uint64)
        score, first, last = D.align(item, passage)
        assert score == brute_align(item, passage)
        if score:
            assert D.align(item, passage[first:last])[0] == score
    assert D.align(np.zeros(0, np.uint64), np.zeros(3, np.uint64)) == (0, 0, 0)


@pytest.fixture
def tests_items(spark):
    rows = [(1, prose(50, 40), "x"), (2, prose(51, 30), "x"), (3, "two words", "x"), (4, None, "x"), (None, "no id", "x"), (5, "!!", "x"), (2, "zz" + prose(51, 30), "x")]
    return spark.createDataFrame(rows, "item_id long, text string, score string")


def test_matches(frame, edge, tests_items):
    words = prose(50, 40).split()
    edited = [w if i % 6 else "changed" for i, w in enumerate(words)]
    edited[20:20] = ["added", "twice"]
    docs = [
        (10, prose(60, 200) + " " + prose(50, 40).upper().replace(" ", ", ") + " " + prose(61, 200), None, None, None),
        (11, prose(62, 100) + " " + " ".join(edited) + ". " + prose(63, 10), None, None, None),
        (12, prose(64, 300), None, None, None),
        (13, " ".join(reversed(words)), None, None, None),
        (14, prose(51, 30), None, None, None), (14, prose(51, 30), None, None, None),
        (None, "before two, WORDS after", None, None, None),
        (15, " ".join(words[:8]), None, None, None),
    ]
    got = {(r["doc_id"], r["item_id"]): r for r in D.matches(frame(docs), tests_items).collect()}
    assert set(got) == {(10, 1), (11, 1), (14, 2), (None, 3)}
    assert got[10, 1]["score"] == 1 and (got[10, 1]["first_word"], got[10, 1]["last_word"]) == (200, 240)
    assert 0.5 <= got[11, 1]["score"] < 1
    kept = D.clean(frame(docs, ["key", "_key", "score"]), tests_items)
    assert kept.columns[-3:] == ["key", "_key", "score"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [12, 13, 15] and "score" in kept.columns
    assert D.clean(edge, tests_items).count() == edge.count()


def test_blocks_give_the_same(frame, tests_items):
    docs = frame([(i, prose(70 + i, 50) + " " + prose(50 + i % 2, 40 - 10 * (i % 2)), None, None, None) for i in range(6)])
    one = sorted(tuple(r) for r in D.matches(docs, tests_items).collect())
    assert len(one) == 6 and sorted(tuple(r) for r in D.matches(docs, tests_items, block_bytes=50).collect()) == one


def test_item_in_most_documents_keeps_its_seeds(frame, tests_items):
    docs = frame([(i, prose(900 + i, 20) + " " + prose(50, 40), None, None, None) for i in range(200)])
    assert D.matches(docs, tests_items).count() == 200


def brute_matches(docs, items, n=D.N, min_score=D.MIN_SCORE):
    """Matches by the definition: sets of n-grams, whole-table alignment of every chosen passage."""
    split = lambda t: [int(x) for x in D.word_hashes(t)]
    texts, words = {i: split(t) for i, t in docs}, {i: split(t) for i, t in items}
    grams = lambda w, k: [tuple(w[j : j + k]) for j in range(len(w) - k + 1)]
    size = {i: min(n, len(w)) for i, w in words.items()}
    df = {}
    for k in set(size.values()):
        for w in texts.values():
            for g in set(grams(w, k)):
                df[g] = df.get(g, 0) + 1
    out = {}
    for i, item in words.items():
        own = set(grams(item, size[i]))
        usual = float(np.median([df.get(g, 0) for g in own]))
        seeds = {g for g in own if df.get(g, 0) <= max(D.FEW, D.RARE * usual)}
        for d, w in texts.items():
            at = [(j, g) for j, g in enumerate(grams(w, size[i])) if g in own]
            clusters = []
            for j, g in at:
                if clusters and j - clusters[-1][-1][0] <= len(item):
                    clusters[-1].append((j, g))
                else:
                    clusters.append([(j, g)])
            for c in clusters:
                held = {g for _, g in c}
                if held & seeds or len(held) >= D.ENOUGH * len(own):
                    a, b = max(0, c[0][0] - len(item)), min(len(w), c[-1][0] + 2 * len(item))
                    score = brute_align(item, w[a:b]) / (D.MATCH * len(item))
                    if score >= min_score:
                        out[d, i] = max(out.get((d, i), 0), score)
    return out


def test_matches_against_brute_force(spark, frame):
    r = random.Random(11)
    stock = prose(1, 9)
    items = [(i, " ".join([prose(200 + i, r.randrange(3, 40), 60 if i % 3 else 4000), stock if i % 2 else ""])) for i in range(24)]
    docs = []
    for d in range(90):
        parts = [prose(900 + d, r.randrange(0, 60), 60)]
        for _ in range(r.randrange(0, 3)):
            w = r.choice(items)[1].split()
            for _ in range(r.randrange(0, 8)):
                w[r.randrange(len(w))] = f"n{r.randrange(99)}"
            parts += [" ".join(w[r.randrange(0, 6) :]), prose(2000 + d, r.randrange(0, 50))]
        docs.append((d, " ".join([*parts, stock])))
    got = D.matches(frame([(d, t, None, None, None) for d, t in docs]).repartition(4), spark.createDataFrame(items, "item_id long, text string"))
    got = {(x["doc_id"], x["item_id"]): x["score"] for x in got.collect()}
    want = brute_matches(docs, items)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want) and len(want) > 40


def test_stock_phrase_makes_no_passages(spark, frame, monkeypatch):
    """A phrase that all texts and items share costs no passage, although each text meets each item in it."""
    stock = prose(5, 8)
    items = spark.createDataFrame([(i, prose(3000 + i, 60) + " " + stock) for i in range(100)], "item_id long, text string")
    docs = frame([(i, prose(6000 + i, 60) + " " + stock, None, None, None) for i in range(99)] + [(99, prose(3007, 60), None, None, None)])
    made = []
    monkeypatch.setattr(D, "_passages", lambda *a, f=D._passages: made.append(f(*a).cache()) or made[-1])
    assert [(x["doc_id"], x["item_id"]) for x in D.matches(docs, items).collect()] == [(99, 7)]
    assert made[0].count() < 5  # but for a word before the phrase that is the same by chance


def test_nothing_in_nothing_out(frame, edge, tests_items):
    assert D.matches(frame([]), tests_items).count() == 0
    assert D.matches(edge, tests_items.limit(0)).count() == 0
    assert D.clean(edge, tests_items.limit(0)).count() == edge.count()
