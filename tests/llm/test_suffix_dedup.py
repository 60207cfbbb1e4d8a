import hashlib
import random
from collections import Counter

import pytest
from tests_llm_data import EDGE, prose

from starmart.llm import suffix_dedup as S


def brute(texts, length=400):
    raw = [(t or "").encode() for t in texts]
    count = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rows(df):
    got = df.collect()
    for r in got:
        assert sum(s["last"] - s["first"] for s in r["spans"]) == r["n_removed"] and len(r["spans"]) == r["n_spans"]
        assert len(r["kept"]) == r["n_bytes"] - r["n_removed"]
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in got), key=str)


def test_cover():
    assert len({(a - b) % S.PERIOD for a in S.COVER for b in S.COVER}) == S.PERIOD


@pytest.mark.parametrize("block_bytes", [1, 5000, 1 << 22])
def test_against_brute_force(frame, block_bytes):
    r = random.Random(9)
    shared = [prose(i, 90) for i in range(3)]
    texts = []
    for i in range(40):
        parts = [prose(100 + 7 * i + j, r.randrange(1, 60)) for j in range(3)]
        s = r.choice(shared)
        cut = r.randrange(0, 60)
        texts.append(parts[0] + s[cut : cut + r.choice([398, 399, 400, 401, 430])] + parts[1] + "é" * r.randrange(3) + parts[2])
    texts += [texts[0], texts[0], "ab" * 500, "x" * 399, "x" * 400, "y" * 401, "", prose(5, 300) + prose(5, 300)]
    docs = frame([(i, t, None, None, None) for i, t in enumerate(texts)])
    want = sorted(((i, *b) for i, b in enumerate(brute(texts))), key=str)
    assert rows(S.without_repeats(docs.repartition(3), block_bytes=block_bytes)) == want


def test_edges(frame, edge):
    want = sorted(((t[0], *b) for t, b in zip(EDGE, brute([t[1] for t in EDGE]))), key=str)
    assert rows(S.without_repeats(edge)) == want
    assert S.without_repeats(frame([])).count() == 0
    with pytest.raises(ValueError):
        S.without_repeats(edge, length=299)


def test_segments(frame, monkeypatch):
    monkeypatch.setattr(S, "SEGMENT", 1000)
    S._ROLLINGS.clear()
    text = [prose(3, 2000), "z" + prose(3, 1500), prose(4, 1000)]
    b = S.Block("".join(text).encode(), [len(t) for t in text], 4, 400)
    where, (name, _, of, _) = b.samples()
    raw = "".join(text).encode()
    seen = {}
    for p, k in zip(where.tolist(), of.tolist()):
        assert seen.setdefault(raw[p : p + 216], k) == k
    assert len(seen) == len(name)
    S._ROLLINGS.clear()


def test_texts_are_not_shuffled(edge, plan):
    text = plan(S.without_repeats(edge))
    left = text.split("Bucketed: true")[0].rsplit("SortMergeJoin", 1)[1]
    assert "Bucketed: true" in text and "Exchange" not in left
