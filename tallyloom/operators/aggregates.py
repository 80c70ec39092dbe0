"""Grouped aggregates: all combine partially before the shuffle, so a hot key sends one row per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.ordering import attach, exact_quantiles, value_counts


def min_avg_max(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Smallest, mean and largest value per key; the mean of decimals comes from their exact sum."""
    exact = df.schema[value].dataType.typeName().startswith("decimal")
    mean = F.sum(value).cast("double") / F.count(value) if exact else F.avg(F.col(value).cast("double"))
    return df.groupBy(*by).agg(F.min(value).alias("min_value"), mean.alias("avg_value"), F.max(value).alias("max_value"))


def conditional_sums(df: DataFrame, by: Sequence[str], value: str, cases: Mapping[str, Column]) -> DataFrame:
    """One sum per case, zero where no row meets the case."""
    sums = [F.coalesce(F.sum(F.when(hit, F.col(value))), F.lit(0)).alias(name) for name, hit in cases.items()]
    return df.groupBy(*by).agg(*sums)


def rate(df: DataFrame, by: Sequence[str], status: str, hit: str) -> DataFrame:
    """Rows with the hit status, rows with any status, and their ratio."""
    hits, total = F.count_if(F.col(status) == hit), F.count(status)
    return df.groupBy(*by).agg(
        hits.alias("hits"), total.alias("total"), F.try_divide(hits.cast("double"), total).alias("rate")
    )


def pivot_counts(df: DataFrame, rows: Sequence[str], col: str, values: Mapping[object, str] | Sequence[str]) -> DataFrame:
    """Counts with the listed values of ``col`` across, zeros where empty; a mapping gives the column labels."""
    labels = values if isinstance(values, Mapping) else {v: str(v) for v in values}
    counts = [F.count_if(F.col(col) == v).alias(label) for v, label in labels.items()]
    return df.groupBy(*rows).agg(*counts)


def frequencies(df: DataFrame, col: str) -> DataFrame:
    """Count and share of every value; shares are taken over the counted table, never over the rows."""
    counted = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("share", F.col("n") / counted.agg(F.sum("n")).scalar())


def no_information_rate(df: DataFrame, col: str) -> DataFrame:
    """Share of the most frequent value, nulls left out."""
    counted = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg((F.max("n") / F.sum("n")).alias("nir"))


def row_share(df: DataFrame, row: Sequence[str], col: str) -> DataFrame:
    """Count per (row, col) with its share of the row total."""
    counted = df.groupBy(*row, col).agg(F.count(F.lit(1)).alias("n"))
    total = counted.groupBy(*row).agg(F.sum("n").alias("row_total"))
    return counted.join(total, list(row)).withColumn("share", F.col("n") / F.col("row_total"))


def period_change(df: DataFrame, by: Sequence[str], period: str, base: object, target: object) -> DataFrame:
    """Counts of two periods per key, their difference and the change in percent (null without a base)."""
    counted = df.where(F.col(period).isin(base, target)).groupBy(*by).agg(
        F.count_if(F.col(period) == base).alias("base"), F.count_if(F.col(period) == target).alias("target")
    )
    change = F.col("target") - F.col("base")
    return counted.withColumn("increase", change).withColumn(
        "pct_increase", F.try_divide(change.cast("double"), F.col("base")) * 100
    )


def mean_median(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Mean and exact median per group, both from one count of the values."""
    return exact_quantiles(df, by, value, {"median": 0.5}, mean="mean")


def value_counts_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Counts of every value of several columns in one pass: (column, value, n), values as text."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]))
    return df.select(pairs.alias("p")).groupBy("p.column", "p.value").agg(F.count(F.lit(1)).alias("n"))


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent non-blank value of each column; ties go to the smaller value.

    The values are counted by key, so that a column with many values never sits in one buffer.
    """
    counted = value_counts_long(df, cols).where("value IS NOT NULL AND value <> ''")
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value")))
    return counted.groupBy("column").agg(best.alias("b")).select("column", F.col("b.value").alias("mode"), (-F.col("b.neg")).alias("n"))


def missing_pattern(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per combination of missing columns (1 = missing)."""
    return df.groupBy(*[F.col(c).isNull().cast("int").alias(c) for c in cols]).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, col: str, width: float, by: Sequence[str] = ()) -> DataFrame:
    """Rows per bin of fixed width; the bin is named by its lower edge."""
    return df.where(F.col(col).isNotNull()).groupBy(*by, (F.floor(F.col(col) / width) * width).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )


def extremes(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("smallest"), F.max(col).alias("largest"))


def daily_amplitude(df: DataFrame, by: Sequence[str], day: Column, ts: str, value: str) -> DataFrame:
    """Largest minus smallest value per day, with the first time either was reached."""
    return (
        df.groupBy(*by, day.alias("day"))
        .agg(
            F.min(F.struct((-F.col(value)).alias("v"), F.col(ts).alias("t"))).alias("hi"),
            F.min(F.struct(F.col(value).alias("v"), F.col(ts).alias("t"))).alias("lo"),
        )
        .select(
            *by,
            "day",
            (-F.col("hi.v") - F.col("lo.v")).alias("amplitude"),
            F.col("hi.t").alias("max_time"),
            F.col("lo.t").alias("min_time"),
        )
    )


def box_summary(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Quartiles, whisker ends inside 1.5 interquartile ranges, and the number of outliers, per group."""
    quartiles = exact_quantiles(df, by, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    fenced = attach(value_counts(df, by, value), quartiles, by, "_v")
    spread, kind = F.col("q3") - F.col("q1"), df.schema[value].dataType
    inside = F.col("_v").between(F.col("q1") - 1.5 * spread, F.col("q3") + 1.5 * spread)
    return fenced.groupBy(*by).agg(
        *[F.max(q).alias(q) for q in ("q1", "median", "q3")],
        F.min(F.when(inside, F.col("_v"))).cast(kind).alias("low_whisker"),
        F.max(F.when(inside, F.col("_v"))).cast(kind).alias("high_whisker"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
    )


def audit(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows before, removed and after for a chain of filters, all counted in one pass over the input.

    A rule sees only the rows that earlier rules kept; a null verdict removes the row.
    """
    passed: list[Column] = []
    counts = [F.count(F.lit(1)).alias("_start")]
    for i, rule in enumerate(rules.values()):
        passed.append(F.coalesce(rule, F.lit(False)))
        counts.append(F.count_if(reduce(lambda a, b: a & b, passed)).alias(f"_kept{i}"))
    wide = df.agg(*counts)
    rows = []
    for i, name in enumerate(rules):
        before, after = F.col("_start" if i == 0 else f"_kept{i - 1}"), F.col(f"_kept{i}")
        rows.append(
            F.struct(
                F.lit(i + 1).alias("step"),
                F.lit(name).alias("rule"),
                before.alias("rows_before"),
                after.alias("rows_after"),
                (before - after).alias("removed"),
            )
        )
    return wide.select(F.inline(F.array(*rows)))


def share_of_total(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Count per group and its percentage of all rows."""
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("percentage", F.col("n") / counted.agg(F.sum("n")).scalar() * 100)

