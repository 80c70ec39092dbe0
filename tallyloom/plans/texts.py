"""Text as a source and a sink: given tables rendered to delimited lines and to matrices, some of them spoiled, and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import recode
from tallyloom.plans import places_routes, trade
from tallyloom.session import checkpointed, read_table
from tallyloom.sources import delimited, matrix


def text_rows(spark, folder):
    """Customers as lines; every seventh has no number for a balance and every eleventh no balance at all. A balance above a limit
    was noted in another unit."""
    given = read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_custkey").alias("id"), F.concat("c_name", F.lit("; "), "c_mktsegment").alias("name"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("balance"),
    )
    lines = delimited.to_lines(given, ";", keep=["key"])
    spoiled = F.when(F.col("key") % 7 == 0, F.concat("line", F.lit("x"))).when(F.col("key") % 11 == 0, F.regexp_replace("line", ";[^;]*$", "")).otherwise(F.col("line"))
    read = delimited.from_lines(lines.select("key", spoiled.alias("line")), "id bigint, name string, balance double", ";")
    return read.select("id", "name", F.round(recode.rescaled(F.col("balance"), 9000, 1000), 6).alias("balance"), F.col(delimited.CORRUPT).isNotNull().alias("malformed"))


def text_min_avg_max(spark, folder):
    """Smallest, mean and largest value per key, of lines of which some hold no number."""
    given = read_table(spark, folder, "events").select(F.col("event_id").alias("key"), "event_type", "value")
    lines = delimited.to_lines(given, ";", keep=["key"])
    spoiled = F.when(F.col("key") % 13 == 0, F.concat(F.split_part("line", F.lit(";"), F.lit(1)), F.lit(";NA"))).otherwise(F.col("line"))
    read = delimited.from_lines(lines.select(spoiled.alias("line")), "city string, temperature double", ";")
    return read.groupBy("city").agg(
        F.min("temperature").alias("min_value"), F.round(F.avg("temperature"), 6).alias("avg_value"), F.max("temperature").alias("max_value"),
        F.count(delimited.CORRUPT).alias("malformed"),
    )


def matrix_edges(spark, folder):
    """Cost matrices of the toured places as text, one per priority, read back to edges."""
    some = F.col("src").isin(places_routes.TOURED) & F.col("dst").isin(places_routes.TOURED)
    edges = checkpointed(places_routes.trade_edges(places_routes.sold_between(spark, folder)).where(some))
    return matrix.parse_matrix(matrix.matrix_lines(edges), "text")


SEGMENTS = ["MACHINERY", "AUTOMOBILE", "BUILDING"]  # the base level first, levels that are not named last


def segments_in_order(spark, folder):
    """Customers per segment in a fixed order of the segments."""
    counted = read_table(spark, folder, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("place", recode.base_level_rank(F.col("segment"), SEGMENTS)).orderBy("place", "segment")


QUERIES = {f.__name__: f for f in (text_rows, text_min_avg_max, matrix_edges, segments_in_order)}

ORACLE = {
    "text_rows": """
SELECT c_custkey AS id, c_name || '; ' || c_mktsegment AS name,
  CASE WHEN c_custkey % 7 = 0 OR c_custkey % 11 = 0 THEN NULL
    WHEN CAST(c_acctbal AS DECIMAL(12,2)) > 9000 THEN ROUND(CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) / 1000, 6)
    ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) END AS balance,
  c_custkey % 7 = 0 OR c_custkey % 11 = 0 AS malformed FROM customer""",
    "text_min_avg_max": """
SELECT event_type AS city, MIN(value) FILTER (event_id % 13 <> 0) AS min_value, ROUND(AVG(value) FILTER (event_id % 13 <> 0), 6) AS avg_value,
  MAX(value) FILTER (event_id % 13 <> 0) AS max_value, COUNT(*) FILTER (event_id % 13 = 0) AS malformed FROM events GROUP BY 1""",
    "matrix_edges": trade.STAR_SQL.rstrip()
    + places_routes.EDGES_SQL.rstrip()
    + f"SELECT instance, src, dst, CAST(cost AS INTEGER) AS cost FROM e WHERE src IN {tuple(places_routes.TOURED)} AND dst IN {tuple(places_routes.TOURED)}",
    "segments_in_order": f"""
SELECT c_mktsegment AS segment, COUNT(*) AS n, CAST(COALESCE(list_position({SEGMENTS}, c_mktsegment), {len(SEGMENTS) + 1}) AS INTEGER) AS place
FROM customer GROUP BY 1""",
}
