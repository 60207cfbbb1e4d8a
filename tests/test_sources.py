import datetime as dt
import json

import pytest

from starmart.contracts import EVENT_CSV_COLUMNS, SONG_RECORDS, STAGED_SONGS, TableContract, fit_widths
from starmart.sinks import write_quoted_csv
from starmart.sources import (
    city_codes,
    code_map_from_dict,
    expand_paths,
    first_per_file,
    preview,
    read_catalogue,
    read_csv_files,
    read_json_auto,
    read_json_glob,
    read_json_paths,
    read_json_tree,
    section_codes,
)
from starmart.sources.files import read_csv_by_position

RECORD = {
    "num_songs": 1, "artist_id": "AR77", "artist_latitude": None, "artist_longitude": None, "artist_location": "",
    "artist_name": "The Kettles", "song_id": "SO42", "title": "Boiling", "duration": 152.92036, "year": 0,
}

CATALOGUE = """value i94prtl
\t'ALC' = 'ALCAN, AK  '
\t'ANC'='ANCHORAGE, AK'
 'BAD'='a=b'
 'XXX' = 'NO STATE'
 'ANC'='ANCH2, AK'
;
value i94addrl
 'AK'='ALASKA'
;
"""


def put(path, *records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r) for r in records))


def test_tree_and_glob(spark, tmp_path):
    put(tmp_path / "A" / "B" / "x.json", {**RECORD, "extra": 1})
    put(tmp_path / "A" / "B" / "x.txt", RECORD)
    put(tmp_path / "y.json", {"song_id": "S2"})
    tree = read_json_tree(spark, str(tmp_path), SONG_RECORDS.schema)
    assert tree.columns == list(SONG_RECORDS.columns)
    assert {r["song_id"]: r["artist_name"] for r in tree.collect()} == {RECORD["song_id"]: "The Kettles", "S2": None}
    assert [r["song_id"] for r in read_json_glob(spark, str(tmp_path), SONG_RECORDS.schema).collect()] == ["S2"]


def test_bulk_load_by_name_cleans(spark, tmp_path):
    put(tmp_path / "s.json", {**RECORD, "title": "x" * 300, "extra": 5})
    row = read_json_auto(spark, str(tmp_path), STAGED_SONGS).first()
    assert row["artist_location"] is None and row["title"] == "x" * 300 and row["duration"] == RECORD["duration"]


def test_bulk_load_by_paths(spark, tmp_path):
    put(tmp_path / "s.json", {"a": {"b": {"c": 5}, "d": " "}, "e": "x"})
    contract = TableContract("t", {"c": "int", "d": "string", "e": "string", "f": "double"})
    df = read_json_paths(spark, str(tmp_path), {"a.b.c": "c", "a.d": "d", "e": "e", "g.h": "f"}, contract)
    assert [tuple(r) for r in df.collect()] == [(5, None, "x", None)]


def test_numbers_as_text_blanks_and_malformed_values(spark, tmp_path, rows):
    put(tmp_path / "s.json", {"k": "10"}, {"k": 11}, {"k": " "})
    contract = TableContract("t", {"k": "int"})
    assert rows(read_json_auto(spark, str(tmp_path), contract)) == [(None,), (10,), (11,)]
    put(tmp_path / "t.json", {"k": "ten"})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_json_auto(spark, str(tmp_path), contract).collect()
    good, rejects = read_json_auto(spark, str(tmp_path), contract, malformed="reject")
    assert rows(good) == [(None,), (10,), (11,)]
    assert rows(rejects.select("k", "reject_reason")) == [("ten", "k: malformed")]


def test_line_that_is_not_json(spark, tmp_path, rows):
    (tmp_path / "s.json").write_text('{"k": 1}\nnot json\n')
    contract = TableContract("t", {"k": "int"})
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        read_json_auto(spark, str(tmp_path), contract).collect()
    good, rejects = read_json_auto(spark, str(tmp_path), contract, malformed="reject")
    assert rows(good) == [(1,)]
    assert rows(rejects) == [(None, "not json", "record: malformed")]


def test_epoch_columns(spark, tmp_path):
    put(tmp_path / "s.json", {"t": 1541990258796})
    df = read_json_auto(spark, str(tmp_path), TableContract("t", {"t": "timestamp"}), ["t"])
    assert df.first()["t"] == dt.datetime(2018, 11, 12, 2, 37, 38, 796000)


def test_first_record_per_file(spark, tmp_path, rows):
    put(tmp_path / "a.json", {"n": 3}, {"n": 1}, {"n": 2})
    put(tmp_path / "b.json", {"n": 9})
    df = read_json_tree(spark, str(tmp_path), "n int")
    assert rows(first_per_file(df, ["n"])) == [(1,), (9,)]


def test_csv_headers_and_quotes(spark, tmp_path, rows):
    header = ",".join(EVENT_CSV_COLUMNS)
    for i, artist in enumerate(["A, B", ""]):
        cells = [f'"{artist}"'] + [str(j) for j in range(1, 17)]
        (tmp_path / f"{i}.csv").write_text(header + "\n" + ",".join(cells) + "\n")
    df = read_csv_files(spark, str(tmp_path), EVENT_CSV_COLUMNS)
    assert rows(df.select("artist", "userId")) == [(None, "16"), ("A, B", "16")]
    write_quoted_csv(df.select("artist", "userId"), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert '"artist","userId"' in text and '"A, B","16"' in text


def test_csv_separator_and_names(spark, tmp_path, rows):
    (tmp_path / "c.csv").write_text("City;Foreign-born\nRome;5\n")
    df = read_csv_files(spark, str(tmp_path), ["City", "Foreign-born"], sep=";", rename={"City": "city", "Foreign-born": "born"})
    assert df.columns == ["city", "born"] and rows(df) == [("Rome", "5")]


def test_path_templates():
    assert expand_paths("l/{year}/{month:02d}", [{"year": 2018, "month": 1}, {"year": 2018, "month": 11}]) == ["l/2018/01", "l/2018/11"]
    assert expand_paths("plain", {}) == ["plain"]
    with pytest.raises(KeyError):
        expand_paths("{day}", {"year": 1})


def test_catalogue(spark, tmp_path, rows):
    (tmp_path / "labels.txt").write_text(CATALOGUE)
    texts = read_catalogue(spark, str(tmp_path / "labels.txt"))
    ports, states = section_codes(texts, "i94prtl"), section_codes(texts, "i94addrl")
    assert rows(ports) == [("ALC", "ALCAN, AK"), ("ANC", "ANCH2, AK"), ("XXX", "NO STATE")]
    assert rows(city_codes(ports, states)) == [
        ("ALC", "ALCAN", "AK", "ALASKA"), ("ANC", "ANCH2", "AK", "ALASKA"), ("XXX", "NO STATE", None, None),
    ]
    assert section_codes(texts, "no such section").count() == 0


def test_constant_codes_and_preview(spark, rows):
    codes = code_map_from_dict(spark, {"1": "Business", "2": "Pleasure"})
    assert rows(codes) == [("1", "Business"), ("2", "Pleasure")]
    assert preview(spark.range(100), 5, ["id"]).count() == 5


def test_no_python_worker(spark, plan, tmp_path):
    put(tmp_path / "s.json", RECORD)
    assert "Python" not in plan(read_json_auto(spark, str(tmp_path), STAGED_SONGS))


def test_csv_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('b,"c c",a\n1,"x, y",q\n')
    (tmp_path / "b.csv").write_text("a,b,c c\nr,2,\n")
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    got = read_csv_files(spark, paths, ["a", "c c"], rename={"c c": "c"})
    assert got.columns == ["a", "c"] and sorted(map(str, got.collect())) == ["Row(a='q', c='x, y')", "Row(a='r', c=None)"]
    with pytest.raises(ValueError, match="no column nowhere"):
        read_csv_files(spark, paths, ["a", "nowhere"])


def test_csv_by_position_with_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h1,h2,h3\n1,"two\nlines, ""quoted""",3\n4,5\n6,7,8,9\n')
    rows, rejects = read_csv_by_position(spark, str(tmp_path), ["x", "y", "z"])
    assert [tuple(r) for r in rows.collect()] == [("1", 'two\nlines, "quoted"', "3")]
    assert sorted((r["record"].strip(), r["reject_reason"]) for r in rejects.collect()) == [("4,5", "record: not 3 fields"), ("6,7,8,9", "record: not 3 fields")]


def test_widths(spark):
    df = spark.createDataFrame([("abcdef", 1), ("ab", 2), (None, 3)], "t string, n int")
    with pytest.raises(Exception, match="t: over 3 characters"):
        fit_widths(df, {"t": 3})[0].collect()
    rows, aside = fit_widths(df, {"t": 3}, "reject")
    assert sorted(r["n"] for r in rows.collect()) == [2, 3] and [r["reject_reason"] for r in aside.collect()] == ["t: over 3 characters"]
    rows, aside = fit_widths(df, {"t": 3}, "cut")
    assert {r["n"]: r["t"] for r in rows.collect()} == {1: "abc", 2: "ab", 3: None} and aside.count() == 1
    with pytest.raises(ValueError):
        fit_widths(df, {"t": 3}, "other")
