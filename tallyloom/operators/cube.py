"""Materialised aggregates over hierarchies, and slices of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target


@dataclass(frozen=True)
class CubeSpec:
    """Hierarchies (widest level first), flat dimensions, and additive measures as aggregates by name.

    Each hierarchy is cut at every depth and each flat dimension is on or off, which names every distinct
    grouping set once.
    """

    hierarchies: tuple[tuple[str, ...], ...]
    flat: tuple[str, ...]
    measures: Mapping[str, Column]

    @property
    def columns(self) -> list[str]:
        return [c for h in self.hierarchies for c in h] + list(self.flat)

    def grouping_sets(self) -> list[list[str]]:
        cuts = [[h[:depth] for depth in range(len(h), -1, -1)] for h in self.hierarchies]
        cuts += [[(f,), ()] for f in self.flat]
        return [[c for part in choice for c in part] for choice in product(*cuts)]

    def level_id(self, present: Sequence[str]) -> int:
        """Bit mask of the aggregated-away columns, as grouping_id() gives it."""
        bits = ["0" if c in present else "1" for c in self.columns]
        return int("".join(bits), 2)

    def _level(self, depths: Sequence[int], flat: Sequence[str]) -> list[str]:
        return [c for h, d in zip(self.hierarchies, depths) for c in h[:d]] + list(flat)

    def build(self, df: DataFrame) -> DataFrame:
        """All levels, with ``level_id``: a NULL attribute is then never mistaken for an "all" cell."""
        cells = df.groupingSets([[F.col(c) for c in s] for s in self.grouping_sets()], *[F.col(c) for c in self.columns])
        return cells.agg(F.grouping_id().alias("level_id"), *[m.alias(n) for n, m in self.measures.items()])

    def level(self, df: DataFrame, depths: Sequence[int], flat: Sequence[str] = (), where: Column | None = None) -> DataFrame:
        """One level straight from the facts: what a slice of the stored cube would return."""
        if where is not None:
            df = df.where(where)
        keys = self._level(depths, flat)
        return df.groupBy(*keys).agg(*[m.alias(n) for n, m in self.measures.items()])

    def slice(self, cube: DataFrame, depths: Sequence[int], flat: Sequence[str] = (), where: Column | None = None) -> DataFrame:
        """One level out of the stored cube, chosen by its id."""
        keys = self._level(depths, flat)
        cells = cube.where(F.col("level_id") == self.level_id(keys))
        if where is not None:
            cells = cells.where(where)
        return cells.select(*keys, *self.measures)


def write_cube(cube: DataFrame, path: str) -> None:
    """Store the cube with one folder per level, so that a slice reads only its own."""
    cube.write.mode("overwrite").partitionBy("level_id").parquet(path)


@dataclass(frozen=True)
class Dimension:
    """An id of the facts and the names it stands for, widest level first; one row of ``members`` per id."""

    key: str
    levels: tuple[str, ...]
    members: DataFrame

    @property
    def ids(self) -> list[str]:
        """Columns with the id of a member's part at each level."""
        return [f"{self.key}_{depth}" for depth in range(1, len(self.levels) + 1)]

    def keyed(self) -> DataFrame:
        """Members with the id of their part at each level: the least id that shares the names so far. Missing names are names too."""
        out = self.members.select(self.key, *self.levels)
        for depth, name in enumerate(self.ids, 1):
            path = self.levels[:depth]
            parts = self.members.groupBy(*path).agg(F.min(self.key).alias(name)).withColumnsRenamed({c: f"_{c}" for c in path})
            same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in path])
            out = out.join(parts, same).drop(*[f"_{c}" for c in path])
        return out


Facts = DataFrame | Callable[[Mapping[str, DataFrame]], DataFrame]


class StoredCube:
    """A cube in a folder of its own: one part per level, on ids, and the dimensions' names beside them.

    A slice stores its own level and no other: summed from the smallest finished level that is finer, or from the facts where there
    is none. ``build`` stores them all: the finest level from the facts, every coarser one from its smallest finished parent, the
    level one step finer in one dimension with the fewest cells; levels with equally many steps are worked out side by side. Names
    are joined only to what a slice returns. Measures are sums.
    """

    def __init__(self, spark: SparkSession, path: str, dimensions: Sequence[Dimension], measures: Mapping[str, Column]):
        self.spark, self.path, self.dimensions, self.measures = spark, path, list(dimensions), dict(measures)
        self.ids = [i for d in self.dimensions for i in d.ids]
        self.sizes: dict[tuple[int, ...], int] = {}
        self.facts: Facts | None = None
        self.schema = ", ".join([f"{i} long" for i in self.ids] + [f"{m} long" for m in self.measures])

    def level_id(self, depths: Sequence[int]) -> int:
        """Bit mask of the aggregated-away columns, as grouping_id() gives it."""
        bits = ["0" if at < depth else "1" for d, depth in zip(self.dimensions, depths, strict=True) for at in range(len(d.levels))]
        return int("".join(bits), 2)

    def _folder(self, depths: Sequence[int]) -> str:
        return f"{self.path}/cells/level_id={self.level_id(depths)}"

    def _names_folder(self, place: int) -> str:
        return f"{self.path}/names/{place}"

    def _write(self, cells: DataFrame, depths: tuple[int, ...]) -> None:
        cells.write.parquet(self._folder(depths))
        # Counted from the files' footers. An Observation would leave its manager in the session, which then cannot be serialised, and
        # Spark's binary classifiers take the session with their training summary into every task.
        self.sizes[depths] = self._cells(depths).count()

    def _cells(self, depths: Sequence[int]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self._folder(depths))

    def _summed(self, df: DataFrame, depths: Sequence[int]) -> DataFrame:
        kept = [i for d, depth in zip(self.dimensions, depths, strict=True) for i in d.ids[:depth]]
        sums = df.groupBy(*kept).agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("long").alias(m) for m in self.measures])
        return sums.select(*[F.col(i) if i in kept else F.lit(None).cast("long").alias(i) for i in self.ids], *self.measures)

    def of(self, facts: Facts) -> StoredCube:
        """The cube of (key of each dimension, what the measures sum) rows, no level stored yet; facts without a member are left out.

        Instead of rows, a function may join the members by their keys, where a dimension is better joined before the facts are whole.
        """
        with ThreadPool(len(self.dimensions)) as pool:
            pool.map(inheritable_thread_target(self.spark)(self._write_names), range(len(self.dimensions)))
        self.facts = facts
        return self

    def _from_facts(self, depths: Sequence[int]) -> DataFrame:
        members = {d.key: self._members(place).select(d.key, *d.ids[:depth]) for place, (d, depth) in enumerate(zip(self.dimensions, depths, strict=True))}
        if callable(self.facts):
            joined = self.facts(members)
        else:
            joined = reduce(lambda df, key: df.join(members[key], key), members, self.facts)
        kept = [i for d, depth in zip(self.dimensions, depths, strict=True) for i in d.ids[:depth]]
        return joined.select(*kept, *[c.alias(m) for m, c in self.measures.items()])

    def store(self, depths: Sequence[int]) -> None:
        """Store one level, if it is not there."""
        depths = tuple(depths)
        if depths in self.sizes:
            return
        finer = [one for one in self.sizes if all(a >= b for a, b in zip(one, depths))]
        source = self._cells(min(finer, key=lambda one: (self.sizes[one], one))) if finer else self._from_facts(depths)
        self._write(self._summed(source, depths), depths)

    def build(self, facts: Facts) -> StoredCube:
        """Write all levels."""
        self.of(facts)
        finest = tuple(len(d.levels) for d in self.dimensions)
        self.store(finest)
        levels = sorted(product(*[range(depth + 1) for depth in finest]), key=sum, reverse=True)
        for steps in range(sum(finest) - 1, -1, -1):
            due = [depths for depths in levels if sum(depths) == steps]
            with ThreadPool(len(due)) as pool:
                pool.map(inheritable_thread_target(self.spark)(self._derive), due)
        return self

    def _derive(self, depths: tuple[int, ...]) -> None:
        self._write(self._summed(self._cells(self.parent(depths)), depths), depths)

    def parent(self, depths: tuple[int, ...]) -> tuple[int, ...]:
        """The smallest of the levels that are one step finer."""
        finer = [depths[:i] + (depth + 1,) + depths[i + 1 :] for i, depth in enumerate(depths) if depth < len(self.dimensions[i].levels)]
        return min((one for one in finer if one in self.sizes), key=lambda one: (self.sizes[one], one))

    def _write_names(self, place: int) -> None:
        self.dimensions[place].keyed().write.parquet(self._names_folder(place))

    def _members(self, place: int) -> DataFrame:
        d = self.dimensions[place]
        kinds = {f.name: f.dataType.simpleString() for f in d.members.schema}
        layout = [f"`{d.key}` {kinds[d.key]}", *[f"`{c}` {kinds[c]}" for c in d.levels], *[f"{i} long" for i in d.ids]]
        return self.spark.read.schema(", ".join(layout)).parquet(self._names_folder(place))

    def slice(self, depths: Sequence[int], where: Column | None = None) -> DataFrame:
        """One level by its id, with the names of its members; ``where`` chooses among them by name."""
        self.store(depths)
        out = self._cells(depths)
        for place, (d, depth) in enumerate(zip(self.dimensions, depths, strict=True)):
            if depth:
                key = d.ids[depth - 1]
                names = self._members(place).select(key, *d.levels[:depth]).distinct()
                out = out.join(names, key)
        if where is not None:
            out = out.where(where)
        return out.select(*[c for d, depth in zip(self.dimensions, depths, strict=True) for c in d.levels[:depth]], *self.measures)

    def cells(self) -> DataFrame:
        """All stored levels in one table, with ``level_id``; names are joined once per dimension, by depth and id."""
        out = self.spark.read.schema(f"{self.schema}, level_id long").parquet(f"{self.path}/cells")
        for place, d in enumerate(self.dimensions):
            depth = sum((F.col(i).isNotNull().cast("int") for i in d.ids), F.lit(0))
            out = out.withColumns({"_depth": depth, "_id": F.coalesce(*[F.col(i) for i in reversed(d.ids)])})
            parts = []
            for at, i in enumerate(d.ids, 1):
                kept = [F.when(F.lit(n < at), F.col(c)).alias(c) for n, c in enumerate(d.levels)]
                parts.append(F.struct(F.lit(at).alias("_depth"), F.col(i).alias("_id"), *kept))
            names = self._members(place).select(F.inline(F.array(*parts))).distinct()
            out = out.join(names, ["_depth", "_id"], "left").drop("_depth", "_id")  # "all" has no name
        return out.select(*[c for d in self.dimensions for c in d.levels], "level_id", *self.measures)
