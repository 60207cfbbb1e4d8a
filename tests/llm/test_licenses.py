import random
import re

from starmart.llm import licenses as L
from starmart.llm.common import ASCII_LOWER

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    w = WORDS.findall((text or "").translate(ASCII_LOWER))
    hits = sorted((i, label) for p, label in L.BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
    return len(w), len(hits), hits[0][0] if hits else None, hits[-1][0] if hits else None, ",".join(sorted({h[1] for h in hits}))


TEXTS = [
    "Released under the MIT License, or CC-BY; mit license again. Mit\n\nLICENSE",
    "gnu general public\tlicense apache license gnu general public license",
    "gnu general public domain license; apache-license; mitlicense", "cc by cc by by cc", "ÜMIT license", None, "", "license mit license",
]


def test_base_phrases_against_brute_force(frame, edge):
    got = L.scan(frame([(i, t, None, None, None) for i, t in enumerate(TEXTS)])).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(TEXTS[r["doc_id"]])
    got = L.scan(edge).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in edge.collect())
    assert [r["n_base"] for r in got if r["doc_id"] is None] == [1]
    assert len([r for r in got if r["doc_id"] == 4 and r["n_words"] == 120]) == 2


def test_edited_notice_is_found_by_its_diagonals(frame, plan):
    words = L.NOTICES["bsd"].split()
    edited = words[:5] + ["and", "other"] + words[5:12] + words[13:]
    docs = frame([(1, "before " * 50 + " ".join(edited) + " after" * 50, None, None, None), (2, " ".join(words[:6]), None, None, None), (3, " ".join(reversed(words)), None, None, None)])
    out = L.scan(docs)
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[1]["labels"] == "bsd" and 0.6 <= got[1]["score"] < 1 and got[1]["spans"][0]["first"] == 50
    assert got[2]["labels"] == got[3]["labels"] == "" and got[2]["score"] == 0
    assert "Python" not in plan(out) and "Cartesian" not in plan(out)


def chain(hits):
    """Longest chain with rising p and rising q, by trying every hit as the last."""
    best = {}
    for p, q in sorted(hits):
        best[p, q] = 1 + max((n for (a, b), n in best.items() if a < p and b < q), default=0)
    return max(best.values(), default=0)


def brute_notices(text, min_share=0.6):
    """Labels and largest share of the notices of a text, window by window."""
    w = WORDS.findall((text or "").translate(ASCII_LOWER))
    found = {}
    for label, notice in L.NOTICES.items():
        t = notice.split()
        n = len(t) - 1
        hits = [(p, q) for p in range(len(w) - 1) for q in range(n) if w[p : p + 2] == t[q : q + 2]]
        for win in range(len(w) // n + 1):
            inside = [(p, q) for p, q in hits if win * n <= p < (win + L.WINDOW) * n]
            runs, last = [], None
            for d in sorted({p - q for p, q in inside}):
                if last is None or d - last > 3:
                    runs.append(set())
                runs[-1].add(d)
                last = d
            solid = [h for run in runs for h in inside if h[0] - h[1] in run and len({q for p, q in inside if p - q in run}) >= L.LEAST_RUN]
            if chain(solid) >= min_share * n:
                found[label] = max(found.get(label, 0), chain(solid) / n)
    return ",".join(sorted(found)), max(found.values(), default=0.0)


def test_notices_against_brute_force(frame):
    r, texts = random.Random(7), []
    notices = [n.split() for n in L.NOTICES.values()]
    for i in range(120):
        words = []
        for _ in range(r.randrange(1, 4)):
            t = list(r.choice(notices))
            for _ in range(r.randrange(0, 6)):
                at, kind = r.randrange(len(t)), r.randrange(4)
                if kind == 0:
                    t[at:at] = ["new"] * r.randrange(1, 9)
                elif kind == 1:
                    del t[at : at + r.randrange(1, 5)]
                elif kind == 2:
                    t = t[at:] + t[:at]
                else:
                    t[at] = "the"
            words += ["x"] * r.randrange(0, 12) + t
        texts.append(" ".join(words))
    mit = L.NOTICES["mit"].split()
    texts += ["the software " * 12, " ".join(mit[:14] + ["one", "two", "three", "four"] + mit[14:]), " ".join(mit[14:] + mit[:14]), "the software to deal in " * 3000]
    got = {x["doc_id"]: x for x in L.scan(frame([(i, t, None, None, None) for i, t in enumerate(texts)]), base={"no such phrase": "none"}).collect()}
    for i, t in enumerate(texts):
        labels, share = brute_notices(t) if len(t) < 10_000 else ("", 0.0)
        assert got[i]["labels"] == labels and abs(got[i]["score"] - share) < 1e-12, t[:300]
        assert all(s["last"] - s["first"] <= L.WINDOW * len(L.NOTICES[s["label"]].split()) for s in got[i]["spans"])
    assert got[120]["labels"] == "" and got[121]["labels"] == "mit" and got[122]["labels"] == ""
    assert sum(bool(x["labels"]) for x in got.values()) > 60


def test_repeated_rows_and_notices(frame):
    text = "start " + L.NOTICES["isc"] + " " + "between " * 80 + L.NOTICES["isc"]
    got = L.scan(frame([(1, text, None, None, None)] * 3)).collect()
    assert len(got) == 3 and all((x["labels"], x["n_spans"], x["score"]) == ("isc", 2, 1.0) for x in got)


def test_empty_table(frame):
    assert L.scan(frame([])).count() == 0
