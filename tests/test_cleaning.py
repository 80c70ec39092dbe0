import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import divisions, formats, recode, timestamps
from tallyloom.operators import aggregates, cleaning

D = dt.datetime

STANDARD = [
    ("12/30/1899 7:05", D(1899, 12, 30, 7, 5)),
    ("12/30/1899 7:05:00 PM", D(1899, 12, 30, 19, 5)),
    ("2021-03-04 05:06", D(2021, 3, 4, 5, 6)),
    ("2021-03-04 05:06:59", D(2021, 3, 4, 5, 6)),
    ("0000-00-00 05:06", D(2000, 1, 1, 5, 6)),
    ("4/3/2564 8:30", D(2021, 3, 4, 8, 30)),
    ("3/25/2564 8:30", D(2021, 3, 25, 8, 30)),
    ("3/4/2021 8:30", D(2021, 3, 4, 8, 30)),
    ("25/3/2021 8:30", D(2021, 3, 25, 8, 30)),
    ("3/4/2021 12:10 AM", D(2021, 3, 4, 0, 10)),
    ("3/4/2021 12:10:00 pm", D(2021, 3, 4, 12, 10)),
    ("3/4/2021 1:10:00 Pm", D(2021, 3, 4, 13, 10)),
    ("3/4/2021 11:10:00 AM", D(2021, 3, 4, 11, 10)),
    ("3/4/2021 11:10PM", D(2021, 3, 4, 23, 10)),
    ("00/00/0000 9:15", D(2000, 1, 1, 9, 15)),
    ("2/30/2020 8:30", None),
    ("13/13/2020 8:30", None),
    ("2021-03-04", None),
    ("3/4/2021 25:00", None),
    ("no date", None),
    ("", None),
    (None, None),
]


def one_column(spark, values, name="x", kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} {kind}")


def apply(spark, values, build, kind="string"):
    df = one_column(spark, values, kind=kind).withColumn("out", build(F.col("x")))
    return [r.out for r in df.orderBy("i").collect()]


def test_standard_timestamp(spark):
    df = timestamps.standard_timestamps(one_column(spark, [t for t, _ in STANDARD]), {"out": F.col("x")})
    assert df.columns == ["i", "x", "out"]
    for (text, expected), row in zip(STANDARD, df.orderBy("i").collect()):
        assert row.out == expected, text


@pytest.mark.parametrize(
    "date, time, expected",
    [
        ("2021-03-04 05:06", "12/30/1899 7:45 PM", D(2021, 3, 4, 19, 45)),  # they differ: the time column wins
        ("2021-03-04 05:06", "12/30/1899 5:06", D(2021, 3, 4, 5, 6)),
        ("2021-03-04 00:00", "12/30/1899 7:45", D(2021, 3, 4)),  # midnight is kept
        ("2021-03-04 05:06", "garbage", D(2021, 3, 4, 5, 6)),
        ("2021-03-04 05:06", None, D(2021, 3, 4, 5, 6)),
        ("garbage", "12/30/1899 7:45", None),
    ],
)
def test_merged_timestamp(spark, date, time, expected):
    df = spark.createDataFrame([(date, time)], "d string, t string")
    assert timestamps.merged_timestamp(df, F.col("d"), F.col("t"), "out").first()["out"] == expected


def test_reading_timestamp(spark):
    df = spark.createDataFrame([(2008, 1, 9, t) for t in ("2:05 PM", "12:05 AM", "12:05 PM", "11:59 PM", "No time", None)], "y int, m int, d int, t string")
    got = [r[0] for r in df.select(timestamps.reading_timestamp(F.col("y"), F.col("m"), F.col("d"), F.col("t"))).collect()]
    assert got == [D(2008, 1, 9, 14, 5), D(2008, 1, 9, 0, 5), D(2008, 1, 9, 12, 5), D(2008, 1, 9, 23, 59), None, None]


def test_race_times_and_divisions(spark):
    assert apply(spark, ["45:10:00", "1:02:03", "00:59:00", "9:15:00", None], timestamps.repair_minutes) == ["00:45:10", "1:02:03", "00:59:00", "9:15:00", None]
    assert apply(spark, ["1:02:03", "00:45:10", "x", ""], timestamps.seconds_of) == [3723.0, 2710.0, None, None]
    groups = apply(spark, ["M25-29", "F60-64", "MPRO", "FPRO", "MPC"], divisions.age_group)
    assert groups == ["25-29", "60-64", "99-99", "99-99", "98-98"]
    assert apply(spark, groups, divisions.lower_bound) == [25.0, 60.0, 99.0, 99.0, 98.0]


def test_recode_and_bands(spark):
    assert apply(spark, ["a", "b", "c", None], lambda c: recode.recode(c, {"a": "x", "b": "x"})) == ["x", "x", "c", None]
    assert apply(spark, ["a", "c", None], lambda c: recode.recode(c, {"a": 1}, F.lit(0))) == [1, 0, 0]
    ages = [-1.0, 0.0, 18.0, 18.5, 60.0, 61.0, None]
    got = apply(spark, ages, lambda c: recode.bands(c, [0, 18, 60], ["low", "mid", "high"]), "double")
    assert got == [None, "low", "low", "mid", "mid", "high", None]
    assert apply(spark, [12, 2, 3, 8, 9, None], recode.season, "int") == ["Winter", "Winter", "Spring", "Summer", "Fall", None]


def test_level_order(spark):
    assert apply(spark, ["b", "a", "z", None], lambda c: recode.base_level_rank(c, ["a", "b"])) == [2, 1, 3, 3]


def test_rescaled(spark):
    assert apply(spark, [1800.0, 190164.0, None], lambda c: recode.rescaled(c, 9000, 1000), "double") == [1800.0, 190.164, None]


def test_time_bands_and_weekends(spark):
    hours = [D(2024, 1, 3, h) for h in (22, 23, 0, 1, 2, 6, 10, 14, 18, 21)]
    got = apply(spark, hours, lambda c: recode.time_band(c, list("abcdef")), "timestamp_ntz")
    assert got == ["a", "a", "a", "a", "b", "c", "d", "e", "f", "f"]
    moments = [D(2024, 1, 5, 18, 59), D(2024, 1, 5, 19), D(2024, 1, 6, 12), D(2024, 1, 7, 23), D(2024, 1, 8, 1, 59), D(2024, 1, 8, 2)]
    assert apply(spark, moments, recode.is_weekend, "timestamp_ntz") == [False, True, True, True, True, False]


def test_codes(spark):
    risk = apply(spark, ["0", "1", "2", "9", "N", "", " ", None, "3", "x"], lambda c: recode.missing_code(c, ["N", "2", "9", "999", "902"], 9999))
    assert risk == [0, 1, 9999, 9999, 9999, 9999, 9999, 9999, 3, 9999]
    vehicles = apply(spark, ["02", "0010", "0", "0901", "99x", None], lambda c: recode.plain_code(c, ["901", "902", "999"], 9999))
    assert vehicles == [2, 10, 9999, 9999, 9999, 9999]


def test_money_and_thousands(spark):
    assert apply(spark, [1234.5, -1234.5, 0.0], formats.money, "double") == ["$1,234.50", "-$1,234.50", "$0.00"]
    assert apply(spark, [1234567.0], formats.thousands, "double") == ["1,234,567"]
    assert apply(spark, [0.29, 1.1, 1234567.89], formats.cents, "double") == [29, 110, 123456789]


def test_head_injury_from_either_source(spark):
    named = spark.createDataFrame([("HI",), ("Non HI",), ("",), ("1",), (None,)], "head_injury string")
    assert [r[0] for r in cleaning.head_injury(named, "head_injury", []).collect()] == [1, 0, 99, 1, None]
    coded = spark.createDataFrame([("0", "1"), ("0", None), ("2", "2")], "br1 string, br2 string")
    assert [r.head_injury for r in cleaning.head_injury(coded, "head_injury", ["br1", "br2"]).collect()] == [1, 0, 0]


def test_deceased(spark):
    df = spark.createDataFrame([("1", None), ("6", "2"), ("2", "6"), (None, "1"), (None, None)], "e string, w string")
    assert [r[0] for r in df.select(cleaning.deceased(F.col("e"), F.col("w"))).collect()] == [1, 1, 1, 0, 0]


def test_range_filter_rejects_markers(spark):
    df = one_column(spark, ["-56", "115", "116", "-9999", "NA", "null", None, "20.5"])
    assert [r.x for r in cleaning.range_filter(df, "x", -56, 115).orderBy("i").collect()] == ["-56", "115", "20.5"]


def test_dedup_by_year(spark, rows):
    data = [(D(2020, 1, 1), "a"), (D(2020, 1, 1), "a"), (D(2021, 1, 1), "a"), (None, "a"), (None, "a"), (D(2020, 1, 1), None), (D(2020, 1, 1), None)]
    df = spark.createDataFrame(data, "t timestamp_ntz, v string")
    once = cleaning.dedup_by_year(df, "t")
    assert rows(once) == [(None, "a"), (None, "a"), (D(2020, 1, 1), None), (D(2020, 1, 1), "a"), (D(2021, 1, 1), "a")]
    assert rows(cleaning.dedup_by_year(once, "t")) == rows(once)
    assert rows(cleaning.duplicates_per_year(df, "t")) == [(2020, 4, 2), (2021, 1, 0)]


def test_impute(spark):
    df = spark.createDataFrame([(1, 1.0, "x"), (2, None, ""), (3, 4.0, None), (4, 10.0, "x"), (5, None, "y")], "i int, n double, c string")
    mean = {r.i: (r.n, r.c) for r in cleaning.impute(df, ["n"], ["c"]).collect()}
    assert mean == {1: (1.0, "x"), 2: (5.0, "x"), 3: (4.0, "x"), 4: (10.0, "x"), 5: (5.0, "y")}
    assert {r.i: r.n for r in cleaning.impute(df, ["n"], [], how="median").collect()}[2] == 4.0


def test_audit_chains_rules(spark):
    df = one_column(spark, [5, 50, 500, None], kind="int")
    got = aggregates.audit(df, {"big": F.col("x") > 10, "small": F.col("x") < 100}).collect()
    assert [tuple(r) for r in got] == [(1, "big", 4, 2, 2), (2, "small", 2, 1, 1)]


def test_samples(spark):
    df = spark.createDataFrame([(i, i % 10 == 0) for i in range(1000)], "i int, y boolean")
    picked = cleaning.sample_exact(df, ["y"], 0.2, ["i"])
    assert sorted(tuple(r) for r in picked.groupBy("y").count().collect()) == [(False, 180), (True, 20)]
    assert sorted(r.i for r in picked.collect()) == sorted(r.i for r in cleaning.sample_exact(df.repartition(7), ["y"], 0.2, ["i"]).collect())
    assert cleaning.sample_rows(df, 5, ["i"]).count() == 5


RAW = dict(
    adate="1/15/2019 8:30", atime="12/30/1899 8:30", prov="north", aplace="1", sex="1", age="33", injt="02", injp="1", risk1="0", risk2="1",
    risk3="N", risk4="1", risk5=None, br1="0", br2="0", br3="1", br4=None, br5="0", mass_casualty=None, staer=None, staward=None, occu="x",
)
RISKS = [f"risk{i}" for i in range(1, 6)]
LABELS = {1: "Yes", 0: "No", 9999: "Unknown"}


def raw(spark, *changes):
    data = [{**RAW, **c} for c in changes]
    return spark.createDataFrame([tuple(r[k] for k in RAW) for r in data], ", ".join(f"{k} string" for k in RAW))


def test_records_from_raw_file_to_model_rows(spark):
    names = spark.createDataFrame([("north", "North"), ("south", "South")], "name string, label string")
    ids = spark.createDataFrame([("1", "north"), ("2", "south")], "id string, name string")
    df = raw(
        spark, {}, {}, {"prov": "??", "aplace": "2", "sex": "2"}, {"prov": "??", "aplace": "9"}, {"sex": "0"}, {"age": "101"}, {"age": "x"},
        {"adate": "1/15/2017 8:30"}, {"adate": "1/18/2019 19:00", "atime": None, "injt": "77", "risk4": "0"}, {"staer": "6"}, {"injp": "3"},
    )
    cleaned = cleaning.clean_records(
        df, names, ids, RISKS, ["N", "2", "9", "999", "902"], ["901", "902", "999"], ["atime", "occu", "staer", "staward", *[f"br{i}" for i in range(1, 6)]]
    )
    assert cleaned.count() == 10  # one place resolves in neither way
    assert "occu" not in cleaned.columns
    vehicles = spark.createDataFrame([("2", "Motorcycle")], "code string, label string")
    status = {r: (f"status{r[-1]}", LABELS) for r in RISKS}
    study = cleaning.study_records(cleaned, vehicles, "2018-01-01", "2023-12-31 23:59:59", status, list("abcdef"))
    got = study.collect()
    assert len(got) == 5  # one duplicate, one sex 0, two bad ages and one early date are gone
    first = next(r for r in got if r.prov == "North" and r.injp == "1" and r.deceased == 0 and r.veh_desc == "Motorcycle")
    assert (first.adate, first.year, first.weekday, first.weekend, first.time_category) == (D(2019, 1, 15, 8, 30), 2019, "Tuesday", "Weekday", "c")
    assert (first.status1, first.status2, first.status3, first.status5, first.head_injury) == ("No", "Yes", "Unknown", "Unknown", 1)
    other = next(r for r in got if r.veh_desc == "Other than Specified")
    assert (other.weekend, other.status4) == ("Weekend", "No")
    subset = cleaning.model_subset(study, "Motorcycle", {"1": "Driver", "2": "Passenger"}, {"Yes": 1, "No": 0}, "status4", "used")
    assert sorted((r.injp, r.sex, r.deceased, r.used) for r in subset.collect()) == [("Driver", "1", 0, 1), ("Driver", "1", 1, 1), ("Driver", "2", 0, 1)]
