"""Cube questions as chained DataFrame steps: levels on rows, members on columns, slicers and totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.windows import densify


@dataclass(frozen=True)
class Cube:
    """A fact joined with its dimensions, and additive measures as aggregates by name."""

    fact: DataFrame
    measures: Mapping[str, Column]
    levels: tuple[str, ...] = ()
    filters: tuple[Column, ...] = ()
    across: tuple[str, tuple[str, ...]] | None = None
    total: tuple[str, str] | None = None
    axis: tuple[str, str, str | None, str | None] | None = None
    chosen: tuple[str, ...] = field(default=())

    def rows(self, *levels: str) -> Cube:
        return replace(self, levels=levels)

    def show(self, *measures: str) -> Cube:
        return replace(self, chosen=measures)

    def where(self, condition: Column) -> Cube:
        """Slicer: keep the facts of one member or tuple."""
        return replace(self, filters=(*self.filters, condition))

    sub = where  # a subcube nests the same way: its filter also applies before any aggregation

    def columns(self, level: str, members: Sequence[str]) -> Cube:
        """Put the listed members of a level across: a column per member, or per measure and member where several are shown."""
        return replace(self, across=(level, tuple(members)))

    def with_total(self, level: str, label: str = "All") -> Cube:
        """Add the member that stands for the whole level."""
        return replace(self, total=(level, label))

    def dense(self, period: str, step: str, start: str | None = None, end: str | None = None) -> Cube:
        """Show empty cells too: every row member in every period of the data, zero where nothing happened.

        ``start`` and ``end`` lengthen the axis.
        """
        return replace(self, axis=(period, step, start, end))

    def result(self) -> DataFrame:
        df = reduce(lambda d, c: d.where(c), self.filters, self.fact)
        names = self.chosen or tuple(self.measures)
        if self.across and self.across[0] in self.levels:
            raise ValueError(f"{self.across[0]} cannot be on rows and across")
        levels = [*self.levels, self.across[0]] if self.across else list(self.levels)
        aggregates = [self.measures[n].alias(n) for n in names]
        if self.total:
            level, label = self.total
            sets = [[F.col(c) for c in levels], [F.col(c) for c in levels if c != level]]
            out = df.groupingSets(sets, *[F.col(c) for c in levels]).agg(F.grouping(level).alias("_all"), *aggregates)
            out = out.withColumn(level, F.when(F.col("_all") == 1, F.lit(label)).otherwise(F.col(level))).drop("_all")
        else:
            out = df.groupBy(*levels).agg(*aggregates)
        if self.across:
            level, members = self.across
            cell = lambda name, m: F.coalesce(F.max(F.when(F.col(level) == F.lit(m), F.col(name))), F.lit(0))
            cells = [cell(n, m).alias(m if len(names) == 1 else f"{n}_{m}") for n in names for m in members]
            names = [m if len(names) == 1 else f"{n}_{m}" for n in names for m in members]
            out = out.groupBy(*self.levels).agg(*cells)
        if self.axis:
            period, step, start, end = self.axis
            out = densify(out, [c for c in self.levels if c != period], period, step, names, start, end)
        return out
