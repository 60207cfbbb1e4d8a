import datetime as dt

import pytest

from starmart.contracts import CITY_FILE_COLUMNS, IMMIGRATION_INPUT
from starmart.plans import immigration
from starmart.plans.runs import run_immigration
from starmart.operators.checks import QualityError
from starmart.sources import read_immigration

CATALOGUE = """value i94cntyl
   582 =  'MEXICO'
   135 =  'UNITED KINGDOM'
;
value i94prtl
\t'NYC'\t=\t'NEW YORK, NY   '
\t'LON'\t=\t'NO STATE'
;
value i94addrl
\t'NY'='NEW YORK'
;
"""


def record(**values):
    base = {
        "cicid": 1.0, "arrdate": 20573.0, "i94cit": 582.0, "i94res": 135.0, "i94port": "NYC", "i94mode": 1.0,
        "i94addr": "NY", "depdate": None, "i94bir": 30.0, "i94visa": 2.0, "gender": None, "airline": "AA", "visatype": "B2",
    } | values
    return tuple(base[c] for c in IMMIGRATION_INPUT.columns)


RECORDS = [
    record(),
    record(cicid=2.0),
    record(cicid=3.0, i94res=999.0),
    record(cicid=4.0, i94visa=1.0),
    record(cicid=5.0, i94mode=2.0),
    record(cicid=6.0, i94visa=2.9, gender="F", depdate=20583.0),
    record(cicid=7.0, i94mode=None),
]


@pytest.fixture
def files(spark, tmp_path):
    half = len(RECORDS) // 2
    for name, part in (("jan", RECORDS[:half]), ("feb", RECORDS[half:])):
        spark.createDataFrame(part, IMMIGRATION_INPUT.schema).write.parquet(str(tmp_path / name))
    (tmp_path / "labels").write_text(CATALOGUE)
    cities = [",".join(CITY_FILE_COLUMNS).replace(",", ";")]
    for race in ("White", "Asian"):
        cells = {"City": "New York", "State Code": "NY", "Race": race, "Male Population": "40", "Female Population": "60",
                 "Total Population": "100", "Foreign-born": "" if race == "White" else "7"}
        cities.append(";".join(cells.get(c, "x") for c in CITY_FILE_COLUMNS))
    cities.append(";".join("Nowhere" if c == "City" else "1" for c in CITY_FILE_COLUMNS))
    (tmp_path / "cities.csv").write_text("\n".join(cities))
    temps = ["dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude"]
    for day, value in (("1899-12-31", "9"), ("1900-01-01", "2.0"), ("1900-01-01", "4.0"), ("1900-01-01", "")):
        temps.append(f"{day},{value},0.1,Paris,France,48N,2E")
    (tmp_path / "temps.csv").write_text("\n".join(temps))
    return tmp_path


def test_records_filter_and_types(spark, files, plan):
    df = read_immigration(spark, [str(files / "jan"), str(files / "feb")])
    assert sorted(r["cicid"] for r in df.collect()) == [1, 2, 3, 6]
    assert {r["i94cit"] for r in df.collect()} == {"582"}
    text = plan(df)
    assert "GreaterThanOrEqual(i94visa,2.0)" in text and "LessThan(i94mode,2.0)" in text


def test_csv_records(spark, files):
    spark.read.parquet(str(files / "jan")).write.option("header", True).csv(str(files / "csv"))
    assert read_immigration(spark, [str(files / "csv")], "csv").count() == 3


def test_csv_records_by_header(spark, files):
    """Columns in another order, others beside; blank cells are null; what does not parse fails or is set aside."""
    names = [*reversed(IMMIGRATION_INPUT.columns), "dtaddto", "entdepa"]
    values = dict(zip(IMMIGRATION_INPUT.columns, RECORDS[0])) | {"dtaddto": "x", "entdepa": ""}
    line = lambda **v: ",".join("" if x is None else str(x) for x in ((values | v)[n] for n in names))
    (files / "a.csv").write_text("\n".join([",".join(names), line(), line(cicid="9.0", i94bir="  ")]))
    got = read_immigration(spark, [str(files / "a.csv")], "csv").collect()
    assert sorted((r["cicid"], r["i94bir"], r["i94cit"]) for r in got) == [(1, 30, "582"), (9, None, "582")]
    (files / "b.csv").write_text("\n".join([",".join(names), line(), line(arrdate="soon"), line(i94visa="two")]))
    with pytest.raises(Exception):
        read_immigration(spark, [str(files / "b.csv")], "csv").collect()
    good, rejects = read_immigration(spark, [str(files / "a.csv"), str(files / "b.csv")], "csv", malformed="reject")
    assert good.count() == 3
    assert sorted(r["reject_reason"] for r in rejects.collect()) == ["arrdate: malformed", "i94visa: malformed"]
    (files / "c.csv").write_text("cicid,arrdate\n1.0,2.0")
    with pytest.raises(ValueError, match="no column i94cit"):
        read_immigration(spark, [str(files / "c.csv")], "csv")


def test_run_sets_unparsable_rows_aside(spark, files, rows):
    with open(files / "cities.csv", "a") as f:
        f.write("\n" + ";".join({"City": "New York", "State Code": "NY", "Male Population": "4o"}.get(c, "1") for c in CITY_FILE_COLUMNS))
    with open(files / "temps.csv", "a") as f:
        f.write("\n1900-01-01,warm,0.1,Paris,France,48N,2E\n")
    root = str(files / "out")
    arguments = ([str(files / "jan"), str(files / "feb")], str(files / "temps.csv"), str(files / "cities.csv"), str(files / "labels"), root)
    run_immigration(spark, *arguments, malformed="reject")
    assert [r["reject_reason"] for r in spark.read.parquet(f"{root}/rejects/cities").collect()] == ["male_population: malformed"]
    assert [r["reject_reason"] for r in spark.read.parquet(f"{root}/rejects/temperatures").collect()] == ["AverageTemperature: malformed"]
    assert spark.read.parquet(f"{root}/rejects/records").count() == 0
    assert rows(spark.read.parquet(f"{root}/temperature_dim").select("average_temperature")) == [(3.0,)]


def test_whole_run(spark, files, rows):
    root = str(files / "out")
    report = run_immigration(
        spark, [str(files / "jan"), str(files / "feb")], str(files / "temps.csv"), str(files / "cities.csv"),
        str(files / "labels"), root,
    )
    assert all(r["passed"] for r in report.collect())
    fact = spark.read.parquet(f"{root}/immigration_fact")
    day = dt.date(2016, 4, 29)
    assert rows(fact.select("arrival_date", "origin_country", "residency_country", "gender", "count")) == [
        (day, "582", "135", None, 2), (day, "582", "135", "F", 1),
    ]
    assert rows(spark.read.parquet(f"{root}/time_dim")) == [(day, 2016, 4, 29)]
    assert rows(spark.read.parquet(f"{root}/us_cities_dim")) == [
        ("NYC", "NEW YORK", "NY", "NEW YORK", 80, 120, 200, 7),
    ]
    temps = spark.read.parquet(f"{root}/temperature_dim").select("country", "date", "average_temperature")
    assert rows(temps) == [("FRANCE", dt.date(1900, 1, 1), 3.0)]


def test_empty_table_fails_the_run(spark, files):
    (files / "temps.csv").write_text("dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude\n")
    with pytest.raises(QualityError, match="temperature_dim: rows = 0"):
        run_immigration(
            spark, [str(files / "jan")], str(files / "temps.csv"), str(files / "cities.csv"), str(files / "labels"),
            str(files / "out"),
        )


def test_city_totals_as_maximum(spark, files, rows):
    cities = immigration.city_records(spark, str(files / "cities.csv"))
    codes = spark.createDataFrame([("NYC", "NEW YORK", "NY", "NEW YORK")], "city_code string, city_name string, state_code string, state_name string")
    assert rows(immigration.us_cities(cities, codes, "max").select("total_population")) == [(100,)]


def test_names_and_dates(spark, files, rows):
    from starmart.sources import read_catalogue

    records = read_immigration(spark, [str(files / "feb")])
    named = immigration.clean_records(records, immigration.countries(read_catalogue(spark, str(files / "labels"))), names=True)
    assert rows(named.select("residency_country", "origin_country", "departure_date")) == [
        ("UNITED KINGDOM", "MEXICO", dt.date(2016, 5, 9))
    ]
    assert [r["date"] for r in immigration.arrival_dates(named, ordered=True).collect()] == [dt.date(2016, 4, 29)]


def test_year_bound_reaches_the_scan(spark, plan, tmp_path):
    spark.sql("SELECT DATE'1900-01-01' AS date, 'F' AS country_name, 1.0D AS average_temperature").write.parquet(str(tmp_path / "t"))
    text = plan(immigration.temperature_dim(spark.read.parquet(str(tmp_path / "t"))))
    assert "GreaterThanOrEqual(date,1900-01-01)" in text
