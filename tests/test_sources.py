import pytest
from pyspark.sql import functions as F

from tallyloom.operators import aggregates
from tallyloom.sources import delimited, matrix, tables

READINGS = "oslo;-3.5\noslo;1.5\nrome;20.0\n;4.0\nrome;oops\n"


@pytest.fixture
def readings(tmp_path):
    folder = tmp_path / "readings"
    folder.mkdir()
    (folder / "part1.txt").write_text(READINGS)
    return str(folder)


def test_headerless_typed_text(spark, readings, rows, tmp_path):
    df = delimited.read_delimited(spark, readings, "city string, temperature float", sep=";", header=False)
    found = aggregates.min_avg_max(df, ["city"], "temperature")
    assert rows(found) == [(None, 4.0, 4.0, 4.0), ("oslo", -3.5, -1.0, 1.5), ("rome", 20.0, 20.0, 20.0)]
    out = str(tmp_path / "out")
    delimited.write_delimited(found, out, header=False)
    assert spark.read.csv(out).count() == 3


def test_corrupt_lines_are_kept_on_request(spark, readings):
    df = delimited.read_delimited(spark, readings, "city string, temperature float", sep=";", header=False, keep_corrupt=True).cache()
    assert [r[delimited.CORRUPT] for r in df.where(F.col(delimited.CORRUPT).isNotNull()).collect()] == ["rome;oops"]


def test_external_table_keeps_its_files(spark, readings):
    for _ in range(2):
        df = tables.external_table(spark, "readings_ext", "city string, temperature float", readings)
        assert df.count() == 5
    spark.sql("DROP TABLE readings_ext")
    assert spark.read.text(readings).count() == 5


def test_table_as_buckets(spark):
    tables.table_as(spark.range(100).withColumn("k", F.col("id") % 7), "bucketed", "k", 4)
    joined = spark.table("bucketed").join(spark.table("bucketed").withColumnRenamed("id", "other"), "k").hint("merge")
    assert joined.count() > 0
    spark.sql("DROP TABLE bucketed")


def test_inferred_header_and_years(spark, tmp_path, rows):
    (tmp_path / "y1.csv").write_text("Big Name,Age\nann,3\n")
    (tmp_path / "y2.csv").write_text("big name,age,extra\nbob,x,7\n")
    inferred = delimited.read_delimited(spark, str(tmp_path / "y1.csv"))
    assert dict(inferred.dtypes) == {"Big Name": "string", "Age": "int"}
    df = delimited.read_years(spark, [str(tmp_path / "y1.csv"), str(tmp_path / "y2.csv")])
    assert rows(df, "big_name", "age", "extra", "source_file") == [("ann", "3", None, "y1.csv"), ("bob", "x", "7", "y2.csv")]


def test_reconcile(spark):
    a = spark.createDataFrame([(1, 2.0)], "id int, aroma double")
    b = spark.createDataFrame([(3, 4.0)], "id int, fragrance double")
    assert tables.schema_difference(a, b) == (["aroma"], ["fragrance"])
    assert tables.stack_reconciled(a, b, {"fragrance": "aroma"}).count() == 2
    with pytest.raises(ValueError):
        tables.stack_reconciled(a, b, {})


def test_learned_dimension_takes_the_last_value(spark, rows):
    facts = spark.createDataFrame([("1", "a", 1), ("1", "b", 3), ("1", "", 4), ("", "c", 5), (None, "c", 6), ("2", "z", 2)], "k string, v string, o int")
    assert rows(tables.learn_dimension(facts, "k", "v", "o")) == [("1", "b"), ("2", "z")]


def test_stored_builds_once(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(3).withColumn("year", F.lit(2020))

    path = str(tmp_path / "stored")
    assert tables.stored(spark, path, build, ["year"]).count() == 3
    assert tables.stored(spark, path, build, ["year"]).count() == 3
    assert len(built) == 1
    (tmp_path / "stored" / "_SUCCESS").unlink()  # as a lost job would leave it
    assert tables.stored(spark, path, build, ["year"]).count() == 3
    assert len(built) == 2


def test_matrix(spark, tmp_path, rows):
    (tmp_path / "m1.txt").write_text("a : 0 4 7\nb : 1 0 2\nc : 9 3 0\n\n")
    (tmp_path / "m2.txt").write_text("x : 0 5\ny : 6 0\n")
    edges = matrix.read_matrix(spark, str(tmp_path))
    assert rows(edges) == [
        ("m1.txt", "a", "b", 4), ("m1.txt", "a", "c", 7), ("m1.txt", "b", "a", 1), ("m1.txt", "b", "c", 2), ("m1.txt", "c", "a", 9),
        ("m1.txt", "c", "b", 3), ("m2.txt", "x", "y", 5), ("m2.txt", "y", "x", 6),
    ]


def test_lines_in_a_column_keep_malformed_ones(spark):
    from tallyloom.sources import delimited

    given = spark.createDataFrame([(1, "a;b", 1.5), (2, None, -2.0), (3, 'q"u', None)], "k int, s string, v double")
    lines = delimited.to_lines(given, ";", keep=["k"])
    assert [r.line for r in lines.orderBy("k").collect()][0] == '"a;b";1.5'
    back = delimited.from_lines(lines, "s string, v double", ";")
    assert sorted(map(tuple, back.collect())) == [(1, "a;b", 1.5, None), (2, None, -2.0, None), (3, 'q"u', None, None)]
    spoiled = spark.createDataFrame([(1, "x;no"), (2, "x"), (3, "x;1.0;more"), (4, None), (5, "")], "k int, line string")
    found = {r.k: (r.s, r.v, r[delimited.CORRUPT]) for r in delimited.from_lines(spoiled, "s string, v double", ";").collect()}
    assert found[1] == ("x", None, "x;no") and found[2] == ("x", None, "x") and found[3] == ("x", 1.0, "x;1.0;more") and found[4] == (None, None, None)


def test_matrix_text_in_a_column(spark):
    from tallyloom.sources import matrix

    edges = spark.createDataFrame([("m", "a", "b", 3), ("m", "b", "a", 4), ("m", "a", "c", 5), ("n", "x", "y", 1)], "instance string, src string, dst string, cost int")
    texts = matrix.matrix_lines(edges)
    assert {r.instance: r.text for r in texts.collect()} == {"m": "a : 0 3 5\nb : 4 0 -\nc : - - 0", "n": "x : 0 1\ny : - 0"}
    assert sorted(map(tuple, matrix.parse_matrix(texts, "text").collect())) == sorted(map(tuple, edges.collect()))
    broken = spark.createDataFrame([("z", " p : 0 seven\n\nq : 2 0 9\n"), ("e", ""), ("u", None)], "instance string, t string")
    found = [tuple(r) for r in matrix.parse_matrix(broken, "t").collect()]
    assert ("z", "q", "p", 2) in found and not any(r[1] == "p" for r in found) and {r[0] for r in found} == {"z"}
