"""Joins, membership tests, relational division and set-style operators over DataFrames.

No join carries a broadcast hint: Spark broadcasts a side only when its size, estimated or measured
at run time, is below the session's threshold, and shuffles (splitting skewed keys) above it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def star(fact: DataFrame, dims: Sequence[tuple[DataFrame, str]], how: str = "inner") -> DataFrame:
    """Join a fact with dimensions, each given with the key name it shares with the fact."""
    return reduce(lambda left, dim: left.join(dim[0], dim[1], how), dims, fact)


def offering_all(df: DataFrame, entity: Sequence[str], item: str, items: Sequence[str]) -> DataFrame:
    """Entities that have every listed item, once each."""
    return (
        df.where(F.col(item).isin(list(items)))
        .groupBy(*entity)
        .agg(F.countDistinct(item).alias("_k"))
        .where(F.col("_k") == len(set(items)))
        .select(*entity)
    )


def only(df: DataFrame, entity: Sequence[str], item: str, allowed: Sequence[str]) -> DataFrame:
    """Entities with at least one item and nothing outside the allowed ones."""
    return df.groupBy(*entity).agg(F.bool_and(F.col(item).isin(list(allowed))).alias("_ok")).where("_ok").select(*entity)


def divides(
    df: DataFrame, entity: Sequence[str], item: str, universe: DataFrame, exclude: Sequence[str] = ()
) -> DataFrame:
    """Relational division: entities paired with every item of the universe, less the excluded ones.

    Items outside the universe count for nothing.
    """
    universe = universe.select(item).distinct()
    if exclude:
        universe = universe.where(~F.col(item).isin(list(exclude)))
    needed = universe.agg(F.count(item)).scalar()
    return df.join(universe, item, "left_semi").groupBy(*entity).agg(F.countDistinct(item).alias("_k")).where(F.col("_k") == needed).select(*entity)


def membership_flag(df: DataFrame, other: DataFrame, key: Sequence[str], out: str) -> DataFrame:
    """Add a 0/1 column telling whether the row's key appears in the other table."""
    hits = other.select(*key).distinct().withColumn("_hit", F.lit(1))
    return df.join(hits, list(key), "left").withColumn(out, F.coalesce("_hit", F.lit(0))).drop("_hit")


def matching_or(df: DataFrame, condition: Column, other: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows that meet the condition or whose key appears in the other table."""
    return membership_flag(df, other, key, "_in").where(condition | (F.col("_in") == 1)).drop("_in")


def anti(df: DataFrame, other: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key has no partner; rows with a null key are kept."""
    return df.join(other.select(*key).distinct(), list(key), "left_anti")


def not_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """SQL NOT IN: a null among the other keys empties the result, and a null probe never passes.

    The null test is one aggregate, so that the rest is a plain anti join which can shuffle; Spark's own
    null-aware anti join must broadcast the other side.
    """
    facts = other.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count(key).alias("known"))).scalar()
    flagged = df.withColumn("_other", facts)
    kept = flagged.where(
        (F.col("_other.n") == 0) | ((F.col("_other.n") == F.col("_other.known")) & F.col(key).isNotNull())
    ).drop("_other")
    return anti(kept, other.where(F.col(key).isNotNull()), [key])


def unique_lookup(table: DataFrame, key: str, value: str) -> DataFrame:
    """One value per key, so that a lookup join can never multiply rows. A key with two different values is an error."""
    several = F.raise_error(F.concat(F.lit(f"several values of {value} for {key} "), F.col(key).cast("string")))
    one = F.when(F.min(value) == F.max(value), F.min(value)).when(F.min(value).isNotNull(), several.cast(table.schema[value].dataType))
    return table.where(F.col(key).isNotNull()).groupBy(key).agg(one.alias(value))


def code_labels(df: DataFrame, col: str, table: DataFrame, key: str, value: str, out: str, default: str) -> DataFrame:
    """Label a code column from a lookup table, with a default for unknown codes."""
    lookup = unique_lookup(table, key, value).select(F.col(key).alias(col), F.col(value).alias("_label"))
    return df.join(lookup, col, "left").withColumn(out, F.coalesce("_label", F.lit(default))).drop("_label")


def lookup_fallback(
    df: DataFrame, name_col: str, id_col: str, names: DataFrame, ids: DataFrame, out: str, drop_unresolved: bool = True
) -> DataFrame:
    """Resolve a name, else resolve the id to a name and that name; drop rows that resolve in neither way.

    ``names`` has the columns (name, label) and ``ids`` the columns (id, name).
    """
    by_name = unique_lookup(names, "name", "label")
    by_id = unique_lookup(ids, "id", "name").join(by_name, "name").select("id", F.col("label").alias("_by_id"))
    out_df = (
        df.join(by_name.select(F.col("name").alias(name_col), F.col("label").alias("_by_name")), name_col, "left")
        .join(by_id.withColumnRenamed("id", id_col), id_col, "left")
        .withColumn(out, F.coalesce("_by_name", "_by_id"))
        .drop("_by_name", "_by_id")
    )
    return out_df.where(F.col(out).isNotNull()) if drop_unresolved else out_df


def largest_per_key(df: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Rows that reach the largest value of their key, ties kept; expects rows already aggregated to a bounded number per key.

    A rank, so that the aggregate below it is computed once; Spark drops rows of lower rank before the shuffle too.
    """
    ranked = df.where(F.col(value).isNotNull())
    window = Window.partitionBy(*key).orderBy(F.desc(value))
    return ranked.withColumn("_rank", F.rank().over(window)).where("_rank = 1").drop("_rank")


def match_periods(
    first: DataFrame, second: DataFrame, key: Sequence[str], suffixes: tuple[str, str], rules: Mapping[str, Column] | None = None
) -> DataFrame:
    """Match entities across two periods; shared column names get the suffixes, every rule must hold."""
    shared = (set(first.columns) & set(second.columns)) - set(key)
    left = first.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    right = second.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    out = left.join(right, list(key))
    for rule in (rules or {}).values():
        out = out.where(rule)
    return out


def top_groups(df: DataFrame, by: Sequence[str], n: int, count: str = "n") -> DataFrame:
    """The n largest groups by row count; ties go to the smaller key."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(count)).orderBy(F.desc(count), *by).limit(n)


def one_sided_counts(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_key: str, right_key: str, names: tuple[str, str]
) -> DataFrame:
    """Distinct entities of two tables per place, places of either side: each side is reduced before the join."""
    a = left.groupBy(*by).agg(F.countDistinct(left_key).alias(names[0]))
    b = right.groupBy(*by).agg(F.countDistinct(right_key).alias(names[1]))
    return a.join(b, list(by), "full").na.fill(0, list(names))

