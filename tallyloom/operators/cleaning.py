"""Record cleaning: column expressions over whole tables, with counts of what each rule removed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import recode, timestamps
from tallyloom.operators import aggregates, ordering, relational

# Fixed values of the record files.
MISSING = 9999
HEAD_INJURY_CODES = {"HI": 1, "Non HI": 0, "": 99}
DIED_IN_ER = ["1", "6"]
DIED_ON_WARD = ["6"]
REMOVED_SEX = "0"
UNKNOWN_VEHICLE = "Other than Specified"
AGES = (0, 100)
BODY_REGIONS = ["br1", "br2", "br3", "br4", "br5"]


def within(col: Column, lo: object, hi: object) -> Column:
    """Plausible-range test: false, not null, for missing and out-of-range values."""
    return F.coalesce(col.between(lo, hi), F.lit(False))


def range_filter(df: DataFrame, col: str, lo: object, hi: object) -> DataFrame:
    """Rows whose value reads as a number inside the range; text markers and nulls are dropped."""
    return df.where(within(F.col(col).try_cast("double"), lo, hi))


def dedup_by_year(df: DataFrame, ts: str) -> DataFrame:
    """Whole-row duplicates removed within each year; rows without a date all stay.

    The date is one of the compared columns, so comparing whole rows never crosses a year.
    """
    dated = df.where(F.col(ts).isNotNull()).dropDuplicates()
    return dated.unionByName(df.where(F.col(ts).isNull()))


def duplicates_per_year(df: DataFrame, ts: str) -> DataFrame:
    """Rows and removed duplicates per year."""
    copies = df.where(F.col(ts).isNotNull()).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.groupBy(F.year(ts).alias("year")).agg(
        F.sum("_copies").alias("rows_before"), F.sum(F.col("_copies") - 1).alias("removed")
    )


def impute(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], how: str = "mean") -> DataFrame:
    """Fill missing numbers with the mean (or exact median) and missing or blank texts with the mode.

    All fills are scalar subqueries over aggregates, so the rows themselves are not shuffled.
    """
    out = df
    if numeric and how == "mean":
        means = df.agg(F.struct(*[F.avg(c).alias(c) for c in numeric])).scalar()
        out = out.withColumn("_means", means)
        out = out.withColumns({c: F.coalesce(F.col(c), F.col("_means")[c]) for c in numeric}).drop("_means")
    if numeric and how == "median":  # all columns as (column, value) rows, so that their medians come from one chain of jobs
        stacked = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in numeric])))
        medians = ordering.exact_quantiles(stacked, ["column"], "value", {"m": 0.5})
        lookup = medians.agg(F.map_from_entries(F.collect_list(F.struct("column", "m")))).scalar()
        out = out.withColumn("_medians", lookup)
        out = out.withColumns({c: F.coalesce(F.col(c), F.col("_medians")[c]) for c in numeric}).drop("_medians")
    if categorical:
        found = aggregates.modes(df, categorical)
        lookup = found.agg(F.map_from_entries(F.collect_list(F.struct("column", "mode")))).scalar()
        out = out.withColumn("_modes", lookup)
        fills = {c: F.when(F.col(c).isNull() | (F.col(c) == ""), F.col("_modes")[c]).otherwise(F.col(c)) for c in categorical}
        out = out.withColumns(fills).drop("_modes")
    return out


def sample_exact(df: DataFrame, by: Sequence[str], fraction: float, key: Sequence[str], seed: int = 42) -> DataFrame:
    """A seeded sample of exactly the rounded fraction of every class."""
    return ordering.first_of_each(df, by, key, F.round(F.col("_rows") * fraction), seed)


def sample_rows(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """n rows in a seeded random order."""
    return df.orderBy(F.xxhash64(F.lit(seed), *[F.col(k) for k in key]), *key).limit(n)


def head_injury(df: DataFrame, text: str, regions: Sequence[str]) -> DataFrame:
    """Head-injury flag from its text column, or per row from the body-region codes when that column is absent."""
    if text in df.columns:
        flag = recode.recode(F.col(text), HEAD_INJURY_CODES, F.col(text).try_cast("int"))
        return df.withColumn(text, flag)
    return df.withColumn(text, recode.any_set(*[F.col(c) for c in regions]))


def deceased(er_outcome: Column, ward_outcome: Column) -> Column:
    """1 when either the emergency room's or the ward's outcome means death, else 0 (also when both are missing)."""
    died = F.coalesce(er_outcome.isin(DIED_IN_ER), F.lit(False)) | F.coalesce(ward_outcome.isin(DIED_ON_WARD), F.lit(False))
    return died.cast("int")


def clean_records(
    df: DataFrame, names: DataFrame, ids: DataFrame, risk_cols: Sequence[str], risk_junk: Sequence[str],
    vehicle_junk: Sequence[str], drop: Sequence[str], missing: int = MISSING,
) -> DataFrame:
    """One lazy plan for a raw yearly file: dates, place, codes, flags and column pruning."""
    placed = relational.lookup_fallback(df, "prov", "aplace", names, ids, "_place")
    dated = timestamps.merged_timestamp(placed, F.col("adate"), F.col("atime"), "adate")
    filled = dated.withColumns({
        "prov": F.col("_place"),
        **{c: recode.missing_code(F.coalesce(F.col(c), F.lit("")), risk_junk, missing) for c in risk_cols},
        "injt": recode.plain_code(F.coalesce(F.col("injt"), F.lit("")), vehicle_junk, missing),
        "injp": F.when(F.col("injp").isNull() | F.col("injp").isin("N", "n"), str(missing)).otherwise(F.col("injp")),
        "mass_casualty": F.when(F.col("mass_casualty").isNull() | (F.col("mass_casualty") == "N"), "0").otherwise(F.col("mass_casualty")),
        "age": F.col("age").try_cast("double"),
        "deceased": deceased(F.col("staer"), F.col("staward")),
    })
    return head_injury(filled, "head_injury", BODY_REGIONS).drop("_place", *drop)


def study_records(
    df: DataFrame, vehicles: DataFrame, start: str, end: str, status: Mapping[str, tuple[str, Mapping[object, object]]],
    band_labels: Sequence[str],
) -> DataFrame:
    """Cleaned records of all years to the study table: filters, dedup, labels, calendar columns.

    ``vehicles`` has (code, label); ``status`` maps a risk column to its label column and labels. Copies of a row pass
    or fail a filter together, so the filters come first and the whole-row comparison shuffles less.
    """
    kept = (
        df.where(~F.col("sex").eqNullSafe(REMOVED_SEX))
        .where(within(F.col("age"), *AGES))
        .where(within(F.col("adate"), F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))
        .dropDuplicates()
        .withColumn("injt", F.col("injt").cast("string"))
    )
    labelled = relational.code_labels(kept, "injt", vehicles, "code", "label", "veh_desc", UNKNOWN_VEHICLE)
    return labelled.withColumns({
        "year": F.year("adate"),
        "weekday": F.date_format("adate", "EEEE"),
        "weekend": F.when(recode.is_weekend(F.col("adate")), "Weekend").otherwise("Weekday"),
        "time_category": recode.time_band(F.col("adate"), band_labels),
        **{label: recode.recode(F.col(c), mapping, F.lit(None).cast("string")) for c, (label, mapping) in status.items()},
    }).drop(*status)


def model_subset(df: DataFrame, vehicle: str, roles: Mapping[str, str], known: Mapping[str, int], status: str, target: str) -> DataFrame:
    """Rows of one vehicle class with a listed role and a known status; role named, status as 0/1 target."""
    rows = df.where(F.col("veh_desc") == vehicle).where(F.col("injp").isin(list(roles))).where(F.col(status).isin(list(known)))
    return rows.withColumn("injp", recode.recode(F.col("injp"), roles)).withColumn(
        target, recode.recode(F.col(status), known, F.lit(None).cast("int"))
    )
