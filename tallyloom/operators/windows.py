"""Ranking, rolling, to-date and parallel-period operators.

Raw rows are aggregated to the grain of the window first (place, day, month), so the window sees rows
bounded by the calendar and the number of members, not by the volume of readings. The one operator that
must look at single readings, ``rolling_extremes``, works block by block.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators import ordering


def rank_top(df: DataFrame, partition: Sequence[str], order: Sequence[Column], method: str = "rank") -> DataFrame:
    """Rows ranked first in their partition; ``rank`` and ``dense_rank`` keep ties."""
    ranking = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[method]
    window = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_rank", ranking().over(window)).where("_rank = 1").drop("_rank")


def mean_of_sums(total: Column, count: Column) -> Column:
    """Mean of an exact decimal sum, as a double."""
    return total.cast("double") / count


def rolling_days(
    df: DataFrame, day: Column, value: Column, days: int, by: Sequence[str] = (), require_full: bool = False
) -> DataFrame:
    """Mean of all readings from each day on, over ``days`` calendar days.

    Readings are first reduced to one (sum, count) row per day. Windows cut short by the end of the data
    count too, unless ``require_full``.
    """
    daily = df.groupBy(*by, day.alias("day")).agg(F.sum(value).alias("_s"), F.count(value).alias("_c"))
    ahead = Window.partitionBy(*by).orderBy(F.unix_date("day")).rangeBetween(0, days - 1)
    out = daily.select(
        *by,
        "day",
        mean_of_sums(F.sum("_s").over(ahead), F.sum("_c").over(ahead)).alias("mean_value"),
        F.max("day").over(Window.partitionBy(*by)).alias("_last"),
    )
    if require_full:
        out = out.where(F.date_add("day", days - 1) <= F.col("_last"))
    return out.drop("_last")


def best_window(windows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Highest mean with its earliest start day."""
    best = F.min(F.struct((-F.col("mean_value")).alias("v"), F.col("day").alias("d"))).alias("b")
    return windows.groupBy(*by).agg(best).select(*by, (-F.col("b.v")).alias("mean_value"), F.col("b.d").alias("start_day"))


SIDES = (("rest", "own"), ("head", "NOT own"))  # what a reading's own block gives, and the block its window ends in


def _swept(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Running minima inside each group: of own readings from the last one back, of others from the first one on."""
    windows = {
        "rest": Window.partitionBy(*by, "blk").orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, 0),
        "head": Window.partitionBy(*by, "blk").orderBy("t", "own").rowsBetween(Window.unboundedPreceding, 0),
    }
    minima = [F.min(F.when(F.expr(kind), F.col(c))).over(windows[side]).alias(f"{side}_{c}") for side, kind in SIDES for c in ("hi", "lo")]
    return parts.select(*by, "at", "blk", "own", *minima).where("own").drop("own")


def _swept_in_slots(parts: DataFrame, by: Sequence[str], slots: int) -> DataFrame:
    """The same for groups of any size: they are cut by time, and a slot adds the minima of the slots behind or before it."""
    keys = [*by, "blk"]
    slotted = ordering.value_slots(parts, keys, "t", [], slots)
    totals = slotted.groupBy(*keys, "_slot").agg(*[F.min(F.when(F.expr(kind), F.col(c))).alias(f"{side}_{c}") for side, kind in SIDES for c in ("hi", "lo")])
    behind = {
        "rest": Window.partitionBy(*keys).orderBy(F.desc("_slot")).rowsBetween(Window.unboundedPreceding, -1),
        "head": Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1),
    }
    names = [(side, f"{side}_{c}") for side, _ in SIDES for c in ("hi", "lo")]
    beyond = totals.select(*[F.col(c).alias(f"_{c}") for c in keys], F.col("_slot").alias("_of"), *[F.min(n).over(behind[side]).alias(f"_{n}") for side, n in names])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]) & (F.col("_slot") == F.col("_of"))
    inside = _swept(slotted, [*by, "_slot"])
    return inside.join(beyond, same).select(*by, "at", "blk", *[F.least(n, f"_{n}").alias(n) for _, n in names])


def rolling_extremes(
    df: DataFrame, by: Sequence[str], ts: str, value: str, hours: int, block_minutes: int = 60, most: int = 100_000, slots: int = 256
) -> DataFrame:
    """Per reading time, the largest and smallest value of the next ``hours`` (ends included) and when they occur first.

    Time is cut into blocks. A window is the rest of its own block, the whole blocks after it, and the head of
    the block it ends in. Whole blocks come from a table with one row per block; the two partial ones need only
    running minima inside one (series, block) group. No task holds a whole series and no row scans its window.

    A block with more than ``most`` readings is cut further, at equal depth by time: the running minima of such a block come from
    the minima of its slots, one row each, and from a window inside each slot.
    """
    block = block_minutes * 60_000_000
    span = hours * 3_600_000_000
    if span % block or span // block < 2:
        raise ValueError("hours must be at least two whole blocks")
    width = span // block
    by = list(by)
    clock = F.col(ts).cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), clock)
    # smallest (-value, time) is the largest value at its first time
    points = (
        df.where(F.col(value).isNotNull() & F.col(ts).isNotNull())
        .groupBy(*by, clock.alias("at"), micros.alias("t"))
        .agg(F.max(value).alias("_max"), F.min(value).alias("_min"))
        .select(
            *by,
            "at",
            "t",
            F.floor(F.col("t") / block).alias("blk"),
            F.struct((-F.col("_max")).alias("v"), F.col("at").alias("at")).alias("hi"),
            F.struct(F.col("_min").alias("v"), F.col("at").alias("at")).alias("lo"),
        )
    )
    between = Window.partitionBy(*by).orderBy("blk").rangeBetween(1, width - 1)
    blocks = (
        points.groupBy(*by, "blk")
        .agg(F.min("hi").alias("hi"), F.min("lo").alias("lo"))
        .select(*by, "blk", F.min("hi").over(between).alias("mid_hi"), F.min("lo").over(between).alias("mid_lo"))
    )
    # every reading plays two parts: a start in its own block, and a head for starts ``hours`` earlier
    parts = points.select(
        *by,
        "at",
        "hi",
        "lo",
        F.explode(
            F.array(
                F.struct(F.col("blk").alias("blk"), F.col("t").alias("t"), F.lit(True).alias("own")),
                F.struct((F.col("blk") - width).alias("blk"), (F.col("t") - span).alias("t"), F.lit(False).alias("own")),
            )
        ).alias("p"),
    ).select(*by, "at", "hi", "lo", "p.blk", "p.t", "p.own")
    hot = parts.groupBy(*by, "blk").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(*[F.col(c).alias(f"_{c}") for c in (*by, "blk")])
    is_hot = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*by, "blk")])
    swept = _swept(parts.join(hot, is_hot, "left_anti"), by).unionByName(_swept_in_slots(parts.join(hot, is_hot, "left_semi"), by, slots))
    joined = swept.join(blocks, [*by, "blk"])
    return joined.select(
        *by,
        F.col("at").alias("start"),
        F.least("rest_hi", "mid_hi", "head_hi").alias("hi"),
        F.least("rest_lo", "mid_lo", "head_lo").alias("lo"),
    ).select(
        *by,
        "start",
        (-F.col("hi.v")).alias("max_value"),
        F.col("hi.at").alias("max_time"),
        F.col("lo.v").alias("min_value"),
        F.col("lo.at").alias("min_time"),
    )


def largest_swing(extremes: DataFrame, by: Sequence[str]) -> DataFrame:
    """The window with the largest swing per series; the earliest start wins a tie."""
    swing = (F.col("max_value") - F.col("min_value")).alias("swing")
    ranked = extremes.select(*by, "start", swing, "max_time", "min_time")
    best = F.min(F.struct((-F.col("swing")).alias("v"), "start", "max_time", "min_time")).alias("b")
    return ranked.groupBy(*by).agg(best).select(*by, (-F.col("b.v")).alias("swing"), "b.start", "b.max_time", "b.min_time")


def spine(df: DataFrame, members: Sequence[str], period: str, step: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Every member of ``df`` with every period, so that empty periods have rows.

    The axis runs from the first to the last period in ``df``; ``start`` and ``end`` (dates) can only lengthen it.
    """
    ends = df.agg(F.struct(F.min(period).alias("first"), F.max(period).alias("last"))).scalar()
    axis = df.select(*members).distinct().withColumn("_ends", ends)
    first = F.least(F.col("_ends.first"), F.lit(start).cast("date"))  # a null bound is passed over
    last = F.greatest(F.col("_ends.last"), F.lit(end).cast("date"))
    return axis.select(*members, F.explode(F.sequence(first, last, F.expr(f"INTERVAL {step}"))).alias(period))


def densify(
    df: DataFrame, members: Sequence[str], period: str, step: str, measures: Sequence[str], start: str | None = None, end: str | None = None
) -> DataFrame:
    """All rows of ``df`` and a row of zeros for every cell of the axis that has none.

    Rows off the steps of the axis stay, and a measure that is null in ``df`` stays null. Periods are dates.
    """
    keys = [*members, period]
    grid = spine(df, members, period, step, start, end).withColumnsRenamed({c: f"_cell_{c}" for c in keys})
    same = [F.col(f"_cell_{c}").eqNullSafe(F.col(c)) for c in keys]
    both = grid.join(df.withColumn("_given", F.lit(True)), reduce(lambda a, b: a & b, same), "full")
    placed = [F.coalesce(f"_cell_{c}", c).alias(c) for c in keys]
    rest = [c for c in df.columns if c not in keys]
    return both.select(*placed, *[F.when(F.col("_given"), F.col(c)).otherwise(F.lit(0)).alias(c) if c in measures else c for c in rest])


def parallel_period(df: DataFrame, by: Sequence[str], period: str, measure: str, n: int) -> DataFrame:
    """Value of the period n places earlier (zero before the calendar starts) and the net growth; expects dense periods."""
    earlier = F.lag(measure, n).over(Window.partitionBy(*by).orderBy(period))
    return df.withColumn("previous", F.coalesce(earlier, F.lit(0))).withColumn(
        "net_growth", F.col(measure) - F.col("previous")
    )


def to_date(df: DataFrame, by: Sequence[str], reset: Sequence[Column], period: str, measure: str, out: str) -> DataFrame:
    """Running sum that starts anew whenever a reset column (year, month) changes."""
    window = Window.partitionBy(*by, *reset).orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(measure).over(window))


def trailing(df: DataFrame, by: Sequence[str], day: str, measure: str, days: int, out: str) -> DataFrame:
    """Sum over the last ``days`` calendar days, the current one included."""
    window = Window.partitionBy(*by).orderBy(F.unix_date(day)).rangeBetween(-(days - 1), 0)
    return df.withColumn(out, F.sum(measure).over(window))


def period_range(
    df: DataFrame, by: Sequence[str], day: str, ranges: Mapping[str, tuple[str, str]], measure: str
) -> DataFrame:
    """One total per named date range (first day included, last day excluded), side by side, zero where empty."""
    spans = {n: (F.col(day) >= F.lit(a).cast("date")) & (F.col(day) < F.lit(b).cast("date")) for n, (a, b) in ranges.items()}
    sums = [F.coalesce(F.sum(F.when(s, F.col(measure))), F.lit(0)).alias(n) for n, s in spans.items()]
    return df.groupBy(*by).agg(*sums)
