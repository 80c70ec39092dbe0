"""Labelled cost matrices as edge lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Files of lines ``name : t1 t2 ... tn`` to (instance, src, dst, cost), one instance per file.

    The i-th cost belongs to the place named on the i-th line, so a file is read as one text.
    """
    whole = spark.read.text(path, wholetext=True)
    return parse_matrix(whole.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("instance"), "value"), "value")


def matrix_lines(edges: DataFrame) -> DataFrame:
    """(instance, text) of (instance, src, dst, cost): a line per place, by name; a pair without an edge has no number (``-``)."""
    places = edges.select("instance", F.explode(F.array("src", "dst")).alias("place")).distinct()
    names = places.groupBy("instance").agg(F.sort_array(F.collect_list("place")).alias("names"))
    costs = edges.groupBy("instance", "src").agg(F.map_from_entries(F.collect_list(F.struct("dst", "cost"))).alias("costs"))
    rows = places.withColumnRenamed("place", "src").join(names, "instance").join(costs, ["instance", "src"], "left")
    cells = F.transform("names", lambda n: F.when(n == F.col("src"), F.lit("0")).otherwise(F.coalesce(F.try_element_at("costs", n).cast("string"), F.lit("-"))))
    lines = rows.select("instance", F.concat("src", F.lit(" : "), F.array_join(cells, " ")).alias("line"))
    return lines.groupBy("instance").agg(F.array_join(F.sort_array(F.collect_list("line")), "\n").alias("text"))


def parse_matrix(texts: DataFrame, text: str) -> DataFrame:
    """Matrices held in a column, beside their ``instance``; lines without a name, or with costs that are no numbers, give no edge for those."""
    lines = F.filter(F.split(text, r"\r?\n"), lambda line: F.trim(line) != "")
    files = texts.select(
        "instance",
        F.transform(lines, lambda line: F.trim(F.split_part(line, F.lit(":"), F.lit(1)))).alias("names"),
        F.transform(
            lines, lambda line: F.split(F.trim(F.split_part(line, F.lit(":"), F.lit(2))), r"\s+").try_cast("array<int>")
        ).alias("costs"),
    )
    rows = files.select("instance", "names", F.posexplode("costs").alias("i", "row"))
    cells = rows.select("instance", "names", F.get("names", F.col("i")).alias("src"), F.posexplode("row").alias("j", "cost"))
    return cells.select("instance", "src", F.get("names", F.col("j")).alias("dst"), "cost").where("src <> dst AND cost IS NOT NULL")
