"""Descriptive tables and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import recode
from tallyloom.operators import aggregates, relational, stats
from tallyloom.session import read_table

PRICE_EDGES = [0, 20000, 40000, 80000]
PRICE_LABELS = [f"{low} to {high}" for low, high in zip(PRICE_EDGES, PRICE_EDGES[1:])] + [f"over {PRICE_EDGES[-1]}"]


def rate_by_group(spark, folder):
    """Share of one status per price band."""
    banded = read_table(spark, folder, "lineitem").select(
        recode.bands(F.col("l_extendedprice"), PRICE_EDGES, PRICE_LABELS).alias("band"), "l_returnflag"
    )
    return aggregates.rate(banded, ["band"], "l_returnflag", "R")


def pivot_counts(spark, folder):
    by_year = read_table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    return aggregates.pivot_counts(by_year, ["year"], "o_orderstatus", {"F": "finished", "O": "open", "P": "pending"})


def row_share(spark, folder):
    return aggregates.row_share(read_table(spark, folder, "lineitem"), ["l_returnflag"], "l_linestatus")


def share_of_total(spark, folder):
    return aggregates.share_of_total(read_table(spark, folder, "documents"), ["source"])


def nir(spark, folder):
    return aggregates.no_information_rate(read_table(spark, folder, "labels"), "quality")


def frequencies(spark, folder):
    return aggregates.frequencies(read_table(spark, folder, "documents"), "lang")


def mean_median(spark, folder):
    stats_df = aggregates.mean_median(read_table(spark, folder, "events"), ["event_type"], "value")
    return stats_df.withColumns({c: F.round(c, 6) for c in ("mean", "median")})


def yoy_growth(spark, folder):
    """Orders per nation in two years, with the increase and its percentage, largest increase first."""
    placed = read_table(spark, folder, "orders").join(
        read_table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).select("c_nationkey", F.year("o_orderdate").alias("year"))
    return aggregates.period_change(placed, ["c_nationkey"], "year", 1997, 2000).orderBy(F.desc("increase"), "c_nationkey")


def histogram(spark, folder):
    bins = aggregates.histogram(read_table(spark, folder, "orders"), "o_totalprice", 600, ["o_orderstatus"])
    return bins.withColumn("bin", F.col("bin").cast("long"))


def yearly_histogram(spark, folder):
    return read_table(spark, folder, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))


def box_summary(spark, folder):
    boxes = aggregates.box_summary(read_table(spark, folder, "documents"), ["lang"], "n_chars")
    return boxes.withColumns({c: F.round(c, 6) for c in ("q1", "median", "q3")})


def corr_matrix(spark, folder):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return stats.corr_long(read_table(spark, folder, "lineitem"), cols).withColumn("r", F.round("r", 6))


def scored_labels(spark, folder):
    docs = read_table(spark, folder, "documents").select("doc_id", "n_chars", "lang")
    return read_table(spark, folder, "labels").join(docs, "doc_id")


def confusion(spark, folder):
    guessed = scored_labels(spark, folder).withColumn("guess", (F.col("n_chars") > 800).cast("int"))
    return stats.confusion(guessed, "quality", "guess")


def accuracy(spark, folder):
    guessed = scored_labels(spark, folder).withColumn("guess", (F.col("n_chars") > 800).cast("int"))
    return stats.accuracy(guessed, "quality", "guess").withColumn("accuracy", F.round("accuracy", 6))


def auc_rank(spark, folder):
    return stats.auc(scored_labels(spark, folder), "quality", "n_chars").withColumn("auc", F.round("auc", 9))


def auc_lines(spark, folder):
    """The same measure over the largest table: how well the price tells returned from accepted lines."""
    lines = read_table(spark, folder, "lineitem").where("l_returnflag <> 'N'")
    return stats.auc(lines.withColumn("returned", (F.col("l_returnflag") == "R").cast("int")), "returned", "l_extendedprice").withColumn(
        "auc", F.round("auc", 9)
    )


def top_n(spark, folder):
    parts = read_table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    per_part = read_table(spark, folder, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("lines"))
    named = per_part.join(parts, "l_partkey").groupBy("p_name").agg(F.sum("lines").alias("n"))
    return named.orderBy(F.desc("n"), "p_name").limit(10)


def top_sources(spark, folder):
    return relational.top_groups(read_table(spark, folder, "documents"), ["source"], 10)


def extremes(spark, folder):
    return aggregates.extremes(read_table(spark, folder, "lineitem"), "l_extendedprice")


def ols_univariate(spark, folder):
    fits = stats.ols_univariate(read_table(spark, folder, "lineitem"), "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])
    return fits.withColumns({c: F.round(c, 4) for c in ("slope", "intercept", "std_error")}).withColumn("r2", F.round("r2", 8))


def ols_errors(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    fit = lines.agg(F.struct(
        F.regr_slope("l_extendedprice", "l_quantity").alias("b"), F.regr_intercept("l_extendedprice", "l_quantity").alias("a")
    )).scalar()
    fitted = lines.withColumn("_fit", fit).withColumn("fitted", F.col("_fit.a") + F.col("_fit.b") * F.col("l_quantity"))
    return stats.fit_errors(fitted, "l_extendedprice", "fitted").withColumns({c: F.round(c, 4) for c in ("mape", "rmse")})


def centroid_distance(spark, folder):
    """Euclidean distance of every vector to the centre of its own group, dimension by dimension."""
    cells = read_table(spark, folder, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("dim", "v"))
    cells = cells.withColumn("v", F.col("v").cast("double"))
    centres = cells.groupBy("label", "dim").agg(F.avg("v").alias("centre"))
    gap = F.col("v") - F.col("centre")
    return cells.join(centres, ["label", "dim"]).groupBy("vec_id", "label").agg(F.round(F.sqrt(F.sum(gap * gap)), 6).alias("distance"))


QUERIES = {
    f.__name__: f
    for f in (
        rate_by_group, pivot_counts, row_share, share_of_total, nir, frequencies, mean_median, yoy_growth, histogram, yearly_histogram,
        box_summary, corr_matrix, confusion, accuracy, auc_rank, auc_lines, top_n, top_sources, extremes, ols_univariate, ols_errors,
        centroid_distance,
    )
}

_PAIRS = [("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"), ("l_quantity", "l_tax"),
          ("l_extendedprice", "l_discount"), ("l_extendedprice", "l_tax"), ("l_discount", "l_tax")]
_AUC = """, k AS (SELECT y, s, RANK() OVER (ORDER BY s) + (COUNT(*) OVER (PARTITION BY s) - 1) / 2.0 AS r FROM d),
c AS (SELECT SUM(y) AS p, COUNT(*) - SUM(y) AS n FROM d)
SELECT ROUND((CAST((SELECT SUM(r) FROM k WHERE y = 1) AS DOUBLE) - p * (p + 1) / 2) / (CAST(p AS DOUBLE) * n), 9) AS auc FROM c"""

ORACLE = {
    "rate_by_group": """
SELECT CASE WHEN l_extendedprice < 0 THEN NULL WHEN l_extendedprice <= 20000 THEN '0 to 20000' WHEN l_extendedprice <= 40000 THEN '20000 to 40000'
  WHEN l_extendedprice <= 80000 THEN '40000 to 80000' ELSE 'over 80000' END AS band,
  COUNT(*) FILTER (WHERE l_returnflag = 'R') AS hits, COUNT(l_returnflag) AS total,
  CAST(COUNT(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) / COUNT(l_returnflag) AS rate FROM lineitem GROUP BY 1""",
    "pivot_counts": """
SELECT CAST(YEAR(o_orderdate) AS INTEGER) AS year, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS finished,
  COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS "open", COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS pending FROM orders GROUP BY 1""",
    "row_share": """
SELECT l_returnflag, l_linestatus, COUNT(*) AS n, CAST(SUM(COUNT(*)) OVER (PARTITION BY l_returnflag) AS BIGINT) AS row_total,
  COUNT(*) / CAST(SUM(COUNT(*)) OVER (PARTITION BY l_returnflag) AS DOUBLE) AS share FROM lineitem GROUP BY 1, 2""",
    "share_of_total": """
SELECT source, COUNT(*) AS n, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM documents) * 100 AS percentage FROM documents GROUP BY 1""",
    "nir": "SELECT MAX(n) / CAST(SUM(n) AS DOUBLE) AS nir FROM (SELECT COUNT(*) AS n FROM labels GROUP BY quality)",
    "frequencies": "SELECT lang, COUNT(*) AS n, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM documents) AS share FROM documents GROUP BY 1",
    "mean_median": "SELECT event_type, ROUND(AVG(value), 6) AS mean, ROUND(MEDIAN(value), 6) AS median FROM events GROUP BY 1",
    "yoy_growth": """
WITH g AS (SELECT c_nationkey, COUNT(*) FILTER (WHERE YEAR(o_orderdate) = 1997) AS base, COUNT(*) FILTER (WHERE YEAR(o_orderdate) = 2000) AS target
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT c_nationkey, base, target, target - base AS increase, CAST(target - base AS DOUBLE) / NULLIF(base, 0) * 100 AS pct_increase
FROM g WHERE base + target > 0""",
    "histogram": """
SELECT o_orderstatus, CAST(FLOOR(o_totalprice / 600) * 600 AS BIGINT) AS bin, COUNT(*) AS n FROM orders GROUP BY 1, 2""",
    "yearly_histogram": "SELECT CAST(YEAR(o_orderdate) AS INTEGER) AS year, COUNT(*) AS n FROM orders GROUP BY 1",
    "box_summary": """
WITH q AS (SELECT lang, quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.5) AS median, quantile_cont(n_chars, 0.75) AS q3 FROM documents GROUP BY 1),
f AS (SELECT d.lang, n_chars, q1, median, q3, n_chars BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM documents d JOIN q ON d.lang = q.lang)
SELECT lang, ROUND(MAX(q1), 6) AS q1, ROUND(MAX(median), 6) AS median, ROUND(MAX(q3), 6) AS q3, MIN(n_chars) FILTER (WHERE inside) AS low_whisker,
  MAX(n_chars) FILTER (WHERE inside) AS high_whisker, COUNT(*) FILTER (WHERE NOT inside) AS outliers FROM f GROUP BY lang""",
    "corr_matrix": " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, ROUND(CORR({a}, {b}), 6) AS r, CAST(ABS(CORR({a}, {b})) >= 0.9 AS INTEGER) AS collinear FROM lineitem"
        for a, b in _PAIRS
    ),
    "confusion": "SELECT quality, CAST(n_chars > 800 AS INTEGER) AS guess, COUNT(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY 1, 2",
    "accuracy": "SELECT ROUND(AVG(CAST(quality = CAST(n_chars > 800 AS INTEGER) AS INTEGER)), 6) AS accuracy FROM labels JOIN documents USING (doc_id)",
    "auc_rank": "WITH d AS (SELECT quality AS y, n_chars AS s FROM labels JOIN documents USING (doc_id))" + _AUC,
    "auc_lines": "WITH d AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, l_extendedprice AS s FROM lineitem WHERE l_returnflag <> 'N')" + _AUC,
    "top_n": "SELECT p_name, COUNT(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY n DESC, p_name LIMIT 10",
    "top_sources": "SELECT source, COUNT(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, source LIMIT 10",
    "extremes": "SELECT MIN(l_extendedprice) AS smallest, MAX(l_extendedprice) AS largest FROM lineitem",
    "ols_univariate": " UNION ALL ".join(
        f"""SELECT '{x}' AS term, ROUND(regr_slope(l_extendedprice, {x}), 4) AS slope, ROUND(regr_intercept(l_extendedprice, {x}), 4) AS intercept,
  ROUND(regr_r2(l_extendedprice, {x}), 8) AS r2, CAST(regr_count(l_extendedprice, {x}) AS BIGINT) AS n,
  ROUND(SQRT((1 - regr_r2(l_extendedprice, {x})) * regr_syy(l_extendedprice, {x}) / (COUNT(*) - 2) / regr_sxx(l_extendedprice, {x})), 4) AS std_error FROM lineitem"""
        for x in ("l_quantity", "l_discount", "l_tax")
    ),
    "ols_errors": """
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem),
e AS (SELECT l_extendedprice AS y, l_extendedprice - (a + b * l_quantity) AS g FROM lineitem, f)
SELECT ROUND(AVG(ABS(g / y)) * 100, 4) AS mape, ROUND(SQRT(AVG(g * g)), 4) AS rmse FROM e""",
    "centroid_distance": """
WITH c AS (SELECT vec_id, label, UNNEST(generate_series(1, 64)) AS dim, CAST(UNNEST(embedding) AS DOUBLE) AS v FROM embeddings),
m AS (SELECT label, dim, AVG(v) AS centre FROM c GROUP BY 1, 2)
SELECT vec_id, c.label, ROUND(SQRT(SUM((v - centre) * (v - centre))), 6) AS distance FROM c JOIN m ON c.label = m.label AND c.dim = m.dim GROUP BY 1, 2""",
}
