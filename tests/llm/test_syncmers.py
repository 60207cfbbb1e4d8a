import hashlib

import numpy as np
from tests_llm_data import EDGE, prose

from starmart.llm import syncmers as S
from starmart.llm.common import code_points, mix64


def brute_anchors(points, k=S.K, s=S.S):
    out = []
    for i in range(len(points) - k + 1):
        h = []
        for j in range(i, i + k - s + 1):
            v = 0
            for c in points[j : j + s]:
                v = (v * int(S.BASE) + int(c)) % 2**64
            h.append(int(mix64(np.array([v], np.uint64))[0]))
        if min(h) in (h[0], h[-1]):
            out.append(i)
    return out


def test_anchors_against_brute_force():
    for text in (prose(1, 60), "aaaaaaaaaaaaaaaaaaaa", "abcabcabcabcabcabc", prose(2, 30) + "漢字🎉" * 5):
        at, code = S.anchors(code_points(text))
        assert at.tolist() == brute_anchors(code_points(text))
        for i, c in zip(at.tolist(), code.tolist()):
            assert S.anchors(code_points(text[i : i + S.K]))[1].tolist() == [c]  # the k-mer alone decides
    assert len(S.anchors(code_points("short"))[0]) == 1 and len(S.anchors(code_points(""))[0]) == 0


def slow_print(text):
    """Bound and anchors by the definition."""
    at, code = S.anchors(code_points(text))
    found = [(int(c) >> 40, int(p)) for p, c in zip(at, code)]
    different = sorted({h for h, _ in found})
    bound = 0xFFFFFF if len(different) <= S.FEWEST else max(0xFFFFFF // 16, different[S.FEWEST - 1])
    return bound, [(h, p) for h, p in found if h <= bound]


def slow_likeness(a, b):
    (ba, fa), (bb, fb) = slow_print(a), slow_print(b)
    xa, xb = ([(h, p) for h, p in f if h <= min(ba, bb)] for f in (fa, fb))
    if not xa + xb:
        return 1.0 if not fa + fb else 0.0
    first = lambda f: {h: p for h, p in reversed(f)}
    shifts = sorted(first(xa)[h] - first(xb)[h] for h in {h for h, _ in xa} & {h for h, _ in xb})
    if not shifts:
        return 0.0
    s = shifts[len(shifts) // 2]
    near = lambda f, g, s: sum(any(h == k and abs(p - s - q) <= S.SLACK for k, q in g) for h, p in f)
    return (near(xa, xb, s) + near(xb, xa, -s)) / (len(xa) + len(xb))


def test_prints_and_likeness_against_brute_force():
    texts = ["", "x", "abc" * 60, prose(1, 40), prose(1, 35) + " and more", prose(3, 900), "new " * 9 + prose(3, 900), prose(3, 450) * 2, "aaaaaaaaaaaaaaaaaaaaa" * 30]
    for a in texts:
        bound, found = slow_print(a)
        got = S.sketch(code_points(a))
        assert got[0] == bound and list(zip(got[1].tolist(), got[2].tolist())) == found
        back = S.decode(S.encode(got))
        assert back[0] == got[0] and (back[1] == got[1]).all() and (back[2] == got[2]).all()
        for b in texts:
            assert abs(S.likeness(got, S.sketch(code_points(b))) - slow_likeness(a, b)) < 1e-12


def test_likeness():
    of = lambda t: S.sketch(code_points(t))
    a, b = prose(1, 600), prose(2, 600)
    assert S.likeness(of(a), of(a)) == 1 and S.likeness(of(""), of("")) == 1 and S.likeness(of(a), of("")) == 0
    assert S.likeness(of(a), of(b)) < 0.1
    assert 0.45 < S.likeness(of(a), of(S.edited(a, b))) < 0.9
    assert S.likeness(of(a), of("A new first line.\n" + a)) > 0.9


def test_prints_grow_with_the_text_and_errors_fall(monkeypatch):
    """Against the likeness over all anchors: of texts with an eighth exchanged, and a passage that is a fiftieth."""
    of = lambda t: S.sketch(code_points(t))
    sizes, errors = [], []
    for words in (100, 1000, 20_000):
        a, b = prose(words, words), prose(words + 1, words)
        pairs = [(a, a[: len(a) * 7 // 8] + b[: len(a) // 8]), (a, b[:-1] + a[len(a) // 2 : len(a) // 2 + len(a) // 50])]
        got = [S.likeness(of(x), of(y)) for x, y in pairs]
        with monkeypatch.context() as m:
            m.setattr(S, "FEWEST", 1 << 30)
            whole = [S.likeness(of(x), of(y)) for x, y in pairs]
        sizes.append(len(of(a)[1]))
        errors.append(max(abs(x - y) for x, y in zip(got, whole)))
    assert sizes[0] >= S.FEWEST and sizes[2] > 10 * sizes[0] and errors[2] < 0.03 and max(errors) < 0.15
    assert got[1] > 0.005  # a passage of two per cent still shows


def brute(rows):
    h = lambda t: t
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, -(rows[i][0] or 0)))
    out = []
    for a, b in zip(order, order[1:] + order[:1]):
        t, n = rows[a][1] or "", rows[b][1] or ""
        e = t[: len(t) - len(t) // 3] + n[: len(t) // 3]
        of = lambda x: S.sketch(code_points(x))
        out.append((rows[a][0], len(t), hashlib.sha256(e.encode()).hexdigest(), S.encode(of(t)), S.encode(of(e)), S.likeness(of(t), of(e)), S.likeness(of(t), of(n))))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_brute_force(frame, edge):
    assert rows_of(S.fingerprints(edge)) == brute(EDGE)
    rows = [(i * 7 % 101, prose(i, i % 90), None, None, None) for i in range(101)]
    assert rows_of(S.fingerprints(frame(rows).repartition(5))) == brute(rows)
    assert rows_of(S.fingerprints(frame(rows[:1]))) == brute(rows[:1])
    assert S.fingerprints(frame([])).count() == 0
