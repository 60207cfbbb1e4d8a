from starmart.contracts import EVENT_CSV_COLUMNS
from starmart.plans.session_items import BY_SESSION_ITEM, BY_SONG, BY_USER_SESSION, clean_items, lookup, query_table, write_query_table

EVENTS = [
    # artist, firstName, itemInSession, lastName, length, sessionId, song, userId
    ("Faithless", "Zoe", "4", "Day", "495.3073", "338", "Music Matters", "50"),
    ("Old", "Zoe", "4", "Day", "1.0", "338", "Overwritten", "50"),
    ("", "Zoe", "5", "Day", "", "338", "", "50"),
    ("B", "Sylvie", "2", "Cruz", "3.5", "182", "Second", "10"),
    ("A", "Sylvie", "0", "Cruz", "2.5", "182", "First", "10"),
    ("C", "Sylvie", "1", "Cruz", "bad", "182", "All Hands Against His Own", "10"),
    ("C", "Sylvie", "9", "Cruz", "2.0", "183", "All Hands Against His Own", "10"),
    ("C", "Tegan", "0", "Levine", "2.0", "611", "All Hands Against His Own", "80"),
]
USED = ["artist", "firstName", "itemInSession", "lastName", "length", "sessionId", "song", "userId"]


def items(spark, tmp_path):
    lines = [",".join(EVENT_CSV_COLUMNS)]
    for e in EVENTS:
        cells = dict(zip(USED, e))
        lines.append(",".join(cells.get(c, "") for c in EVENT_CSV_COLUMNS))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "e.csv").write_text("\n".join(lines) + "\n")
    return clean_items(spark, str(tmp_path / "in"))


def test_three_questions(spark, tmp_path, rows):
    cleaned = items(spark, tmp_path)
    assert cleaned.count() == 7 and len(cleaned.columns) == 11

    by_item, rejects = query_table(cleaned, BY_SESSION_ITEM, ["length"])
    assert [tuple(r) for r in lookup(by_item, BY_SESSION_ITEM, session_id=338, item_in_session=4).collect()] == [
        (338, 4, "Faithless", "Music Matters", 495.3073)
    ]
    assert [r["reject_reason"] for r in rejects.collect()] == ["length: malformed"]

    by_user, rejects = query_table(cleaned, BY_USER_SESSION, [])
    path = str(tmp_path / "by_user")
    write_query_table(by_user, BY_USER_SESSION, path)
    found = lookup(spark.read.parquet(path), BY_USER_SESSION, user_id=10, session_id=182)
    assert [(r["artist"], r["song"]) for r in found.collect()] == [
        ("A", "First"), ("C", "All Hands Against His Own"), ("B", "Second"),
    ]
    assert rejects.count() == 0  # the malformed length is no column of this table

    by_song, _ = query_table(cleaned, BY_SONG, [])
    found = lookup(by_song, BY_SONG, song="All Hands Against His Own").select("first_name", "last_name")
    assert [tuple(r) for r in found.collect()] == [("Sylvie", "Cruz"), ("Tegan", "Levine")]
