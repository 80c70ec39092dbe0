"""Order-dependent results over groups of any size.

A window over a whole group puts the group in one task. The functions here first cut each group into
slots (value ranges or hash ranges), total every slot, and run the window inside one slot only. The
slot totals are at most ``slots`` rows per group, so their own window stays small. Results are exact.

Values are cut at equal depth: a mergeable quantile sketch of a group's distinct values gives the cut points, so slots hold
about equally many values however these are spread. The cuts need not be exact: ranks come from the counts in each slot. They must
be the same wherever they are used, so they are stored: a row per group, written when the plan is made.
Infinities are values like others; NaN is no value and is left out with the nulls.

A plan partitioned by the group also counts as partitioned by (group, slot), and Spark would then leave the
group where it is. So slotted rows are repartitioned by (group, slot) explicitly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import checkpointed

SKETCH = 4  # ranks of the cut points are off by at most one slot in so many
UNCUT = 4  # a group with at most so many values per slot stays in one


def _cut_points(order: str, slots: int) -> Column:
    """Aggregate: ascending cut points that part the group's rows into slots of about equal depth; none for a small group."""
    if slots < 2:
        return F.expr("array()").cast("array<double>")
    shares = F.array(*[F.lit(i / slots) for i in range(1, slots)])
    cuts = F.percentile_approx(F.col(order).cast("double"), shares, SKETCH * slots)
    return F.when(F.count(order) > UNCUT * slots, F.array_distinct(cuts)).otherwise(F.expr("array()").cast("array<double>"))


def _cuts_before(cuts: Column, value: Column, slots: int) -> Column:
    """How many of the ascending cut points lie at or below a value: a binary search by halving steps."""
    steps = [1 << bit for bit in reversed(range(max(slots - 1, 1).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(step) for step in steps]), F.lit(0),
        lambda at, step: at + F.when(F.get(cuts, at + step - 1) <= value, step).otherwise(0),
    )


def value_slots(df: DataFrame, by: Sequence[str], order: str, measures: Sequence[str], slots: int) -> DataFrame:
    """Cut each group into ranges of a numeric column, as _slot in their order, and add the measures' totals (<m>_total).

    ``df`` must hold one row per (by, order value), so that no slot is filled by one value's rows.
    """
    parts = [_cut_points(order, slots).alias("_cuts"), *[F.sum(m).alias(f"{m}_total") for m in measures]]
    # Stored, because the sketch depends on the order in which its parts are merged: cut points found a second time, for the totals
    # of the slots or in a repeated task, may be others.
    if by:
        known = attach(df, checkpointed(df.groupBy(*by).agg(*parts)), by, order)
    else:  # a single group: one scalar subquery instead of a join without keys
        found = checkpointed(df.agg(F.struct(*parts).alias("_group")))
        known = df.withColumn("_group", found.scalar()).select(*df.columns, "_group.*")
    slot = _cuts_before(F.col("_cuts"), F.col(order).cast("double"), slots)
    return known.withColumn("_slot", slot).drop("_cuts").repartition(*by, "_slot")


def _slot_offsets(df: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Per slot, the totals of all earlier slots of the same group: one column ``<m>_before`` each."""
    per_slot = df.groupBy(*by, "_slot").agg(*[F.sum(m).alias(m) for m in measures])
    earlier = Window.partitionBy(*by).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return per_slot.select(
        *by,
        "_slot",
        *[F.col(m).alias(f"{m}_in_slot") for m in measures],
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"{m}_before") for m in measures],
    )


def running_before(
    df: DataFrame, by: Sequence[str], order: str, measures: Sequence[str], slots: int = 1024
) -> DataFrame:
    """Add ``<m>_before`` and ``<m>_total``: sums of each measure over smaller order values and over the group.

    ``df`` must hold one row per (by, order value).
    """
    placed = value_slots(df, by, order, measures, slots)
    offsets = _slot_offsets(placed, by, measures)
    inside = Window.partitionBy(*by, "_slot").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = placed.join(offsets, [*by, "_slot"])
    for m in measures:
        out = out.withColumn(f"{m}_before", F.col(f"{m}_before") + F.coalesce(F.sum(m).over(inside), F.lit(0)))
    return out.drop("_slot", *[f"{m}_in_slot" for m in measures])


def value_counts(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Rows per group and value as (by, _v, n, _weighted), nulls and NaN left out; everything below works on these counts."""
    return (
        df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        .groupBy(*by, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_weighted", F.col("_v") * F.col("n"))
    )


def attach(df: DataFrame, per_group: DataFrame, by: Sequence[str], spread: str, salts: int = 32) -> DataFrame:
    """Join a table with one row per group to rows that are distinct in (by, spread).

    The small table is copied once per salt, so the rows of a hot group meet it in many tasks.
    """
    left = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = per_group.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    return left.join(right, [*by, "_salt"]).drop("_salt")


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: Mapping[str, float], mean: str | None = None, slots: int = 1024
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group and one column per entry of ``probs``.

    Values are counted first, then only the slots that hold a wanted position are ordered. ``mean`` names a
    column for the mean, which comes from the same counts.
    """
    counted = value_counts(df, by, value)
    placed = value_slots(counted, by, "_v", ["n", "_weighted"], slots)
    n = F.col("n_total")

    def position(p: float) -> Column:
        return F.lit(p) * (n - 1)

    def holds(start: Column, count: Column, where: Column) -> Column:
        return (where >= start) & (where < start + count)

    edges = (("lo", F.floor), ("hi", F.ceil))
    wanted = F.lit(False)
    for p in probs.values():
        for _, edge in edges:
            wanted = wanted | holds(F.col("n_before"), F.col("n_in_slot"), edge(position(p)))
    inside = Window.partitionBy(*by, "_slot").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        placed.join(_slot_offsets(placed, by, ["n"]), [*by, "_slot"])
        .where(wanted)
        .withColumn("_start", F.col("n_before") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    )
    found = ranked.groupBy(*by).agg(
        F.max("n_total").alias("n_total"),
        F.max("_weighted_total").alias("_weighted_total"),
        *[
            F.max(F.when(holds(F.col("_start"), F.col("n"), edge(position(p))), F.col("_v"))).alias(f"_{name}_{side}")
            for name, p in probs.items()
            for side, edge in edges
        ],
    )
    means = [(F.col("_weighted_total") / n).alias(mean)] if mean else []
    return found.select(
        *by,
        *means,
        *[
            (
                F.col(f"_{name}_lo")
                + (position(p) - F.floor(position(p))) * (F.col(f"_{name}_hi") - F.col(f"_{name}_lo"))
            ).alias(name)
            for name, p in probs.items()
        ],
    )


def hash_slot(key: Sequence[str], seed: int, slots: int) -> tuple[Column, Column]:
    """Seeded hash of a row's key, and the slot it falls into; rows are taken in the order of (slot, hash, key)."""
    hashed = F.xxhash64(F.lit(seed), *[F.col(k) for k in key])
    return hashed, F.pmod(F.shiftright(hashed, 20), F.lit(slots)).cast("int")


def first_of_each(df: DataFrame, by: Sequence[str], key: Sequence[str], wanted: Column, seed: int = 42, slots: int = 65536) -> DataFrame:
    """The first rows of each group in the order of ``numbered``; ``wanted`` gives their number from the group's ``_rows``.

    Counts per slot tell where a group's last wanted row falls. Slots before that are a plain filter of the rows, and only the
    slot itself is ranked, so no other row is shuffled. Every task holds one entry per group: for few groups with many rows.
    """
    hashed, slot = hash_slot(key, seed, slots)
    counted = df.groupBy(*by, slot.alias("_slot")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.select(
        *by, "_slot", "_n", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy(*by)).alias("_rows")
    ).withColumn("_wanted", wanted)
    last = placed.where((F.col("_before") < F.col("_wanted")) & (F.col("_wanted") <= F.col("_before") + F.col("_n")))
    group = F.to_json(F.struct(*[F.col(c) for c in by]), {"ignoreNullFields": "false"})
    entry = F.struct(group.alias("k"), F.struct("_slot", (F.col("_wanted") - F.col("_before")).alias("_left")).alias("v"))
    cuts = last.agg(F.map_from_entries(F.collect_list(entry))).scalar()
    marked = df.withColumns({"_cut": F.element_at(cuts, group), "_slot": slot})
    whole = marked.where(F.col("_slot") < F.col("_cut._slot"))
    ranked = marked.where(F.col("_slot") == F.col("_cut._slot")).withColumn("_h", hashed)
    place = F.row_number().over(Window.partitionBy(*by).orderBy("_h", *key))
    return whole.select(*df.columns).unionByName(ranked.withColumn("_place", place).where(F.col("_place") <= F.col("_cut._left")).select(*df.columns))


def numbered(
    df: DataFrame, by: Sequence[str], key: Sequence[str], seed: int = 42, slots: int = 65536
) -> DataFrame:
    """Number the rows of each group in a seeded random order: adds ``rn`` (from 1) and ``group_rows``.

    ``key`` must identify a row, so that the order is the same whenever a task is run again.
    """
    own, slot = hash_slot(key, seed, slots)
    hashed = df.withColumns({"_h": own, "_slot": slot})
    per_slot = hashed.groupBy(*by, "_slot").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*by).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slot.select(
        *by,
        "_slot",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy(*by)).alias("group_rows"),
    )
    inside = Window.partitionBy(*by, "_slot").orderBy("_h", *key)
    return (
        hashed.repartition(*by, "_slot")
        .join(offsets, [*by, "_slot"])
        .withColumn("rn", F.col("_before") + F.row_number().over(inside))
        .drop("_h", "_slot", "_before")
    )
