from collections import Counter

import pytest

from starmart.llm import sharding as S


def test_table_is_full_and_even():
    table = S.fill_table()
    counts = Counter(table)
    assert len(table) == S.TABLE_SIZE and set(counts) == set(range(len(S.SHARDS)))
    assert max(counts.values()) - min(counts.values()) <= 1


def test_first_claims_follow_preferences():
    names = ("a", "b", "c")
    table = S.fill_table(names, 7)
    taken = set()
    from hashlib import md5

    d = [md5(n.encode()).hexdigest() for n in names]
    order = [[(int(x[:12], 16) + j * (int(x[12:24], 16) % 6 + 1)) % 7 for j in range(7)] for x in d]
    want = [-1] * 7
    while len(taken) < 7:
        for i in range(3):
            if len(taken) < 7:
                slot = next(s for s in order[i] if s not in taken)
                taken.add(slot)
                want[slot] = i
    assert table == want


def test_leaving_shard_moves_little():
    before, after = S.fill_table(), S.fill_table(S.SHARDS[:-1])
    stay = [i for i, s in enumerate(before) if s != len(S.SHARDS) - 1]
    assert sum(before[i] != after[i] for i in stay) < 0.2 * len(stay)


@pytest.mark.parametrize("names,size", [((), 7), (("a", "a"), 7), (("a",), 8), (tuple("abcdefgh"), 7), (("a",), 1_000_033)])
def test_bad_tables(names, size):
    with pytest.raises(ValueError):
        S.fill_table(names, size)


def test_edges(edge, frame, plan):
    out = S.place(edge)
    rows = out.collect()
    assert len(rows) == edge.count() and set(edge.columns) | {"slot", "shard_no", "shard"} == set(out.columns)
    assert len({r["shard"] for r in rows if r["doc_id"] == 4}) == 1
    assert all(0 <= r["slot"] < S.TABLE_SIZE and r["shard"] == S.SHARDS[r["shard_no"]] for r in rows)
    assert S.place(frame([])).count() == 0
    spread = S.place(frame([(None, f"text {i}", "en", "a", 1) for i in range(200)]))
    assert spread.select("shard").distinct().count() > 10
    assert "Python" not in plan(out) and "Exchange hash" not in plan(out)
