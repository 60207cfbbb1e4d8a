import gzip

import pytest

from starmart.llm import warc as W

PAGES = [(3, "u3", "same"), (1, "u1", "same"), (2, "u2", "other ü"), (4, None, None), (5, "u5", ""), (None, "u", "same"), (6, "http://x/\r\ninjected: y", "<p>" + "a" * 300_000), (3, "u3", "same")]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, first string")


def test_round_trip(pages):
    rows = W.round_trip(pages).collect()
    assert len(rows) == len(PAGES) and all(r["digest_ok"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r["page_id"], []).append(r)
    html = {p[0]: (p[2] or "").encode() for p in PAGES}
    for key, own in by.items():
        for r in own:
            assert r["payload_digest"] == W.payload_digest(html[key]) and r["payload_bytes"] == len(html[key])
            assert r["payload"] == (None if r["record_type"] == "revisit" else html[key])
    assert [(r["record_type"], r["refers_to"]) for r in by[3]] == [("revisit", 1)] * 2
    assert [(by[k][0]["record_type"], by[k][0]["refers_to"]) for k in (1, 2, 4, 5, None, 6)] == [
        ("response", None), ("response", None), ("response", None), ("revisit", 4), ("response", None), ("response", None),
    ]
    assert by[4][0]["url"] is None and by[1][0]["url"] == "u1"


def test_short_payloads_are_responses(pages):
    assert {r["page_id"] for r in W.round_trip(pages, min_bytes=5).collect() if r["record_type"] == "revisit"} == set()


def test_no_pages(spark, pages):
    assert W.round_trip(pages.limit(0)).count() == 0


def test_sequential_reader():
    archive = b"".join(W.record(i, f"u{i}", bytes([65 + i]) * 1000) for i in range(5))
    assert gzip.decompress(archive).count(b"WARC/1.1") == 5
    for size in (1, 7, 1000, len(archive)):
        got = [W.parse(m) for m in W.members(archive[i : i + size] for i in range(0, len(archive), size))]
        assert [r["page_id"] for r in got] == list(range(5)) and all(r["digest_ok"] for r in got)
    with pytest.raises(ValueError):
        list(W.members([archive[:-3]]))
    whole = gzip.decompress(W.record(1, "u", b"payload"))
    assert not W.parse(whole.replace(b"payload", b"pAyload"))["digest_ok"]
    for broken in (whole[:-1], whole + b"x", b"HTTP/1.1 200\r\n\r\n"):
        with pytest.raises(ValueError):
            W.parse(broken)


def test_files(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(W.record(1, "u", b"one") + W.record(2, "v", b"two"))
    assert {(r["page_id"], bytes(r["payload"])) for r in W.read_files(spark, f"{tmp_path}/*.warc.gz").collect()} == {(1, b"one"), (2, b"two")}
