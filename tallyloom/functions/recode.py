"""Recodes, labels and bands as CASE expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def recode(col: Column, mapping: Mapping[object, object], default: Column | None = None) -> Column:
    """Map the listed values; others keep their value, or take the default. Large mappings belong in a lookup join."""
    other = col if default is None else default
    by_target: dict[object, list[object]] = {}
    for value, target in mapping.items():
        by_target.setdefault(target, []).append(value)
    branches = [(col.isin(values), F.lit(target)) for target, values in by_target.items()]
    out = F.when(*branches[0])
    for hit, target in branches[1:]:
        out = out.when(hit, target)
    return out.otherwise(other)


def bands(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label by ranges that include their upper edge; the first also includes its lower edge.

    The last edge may be left out: the last label then takes everything above.
    """
    out = F.when(col < edges[0], F.lit(None))
    for upper, label in zip(edges[1:], labels):
        out = out.when(col <= upper, F.lit(label))
    return out.when(col > edges[-1], F.lit(labels[-1])) if len(labels) == len(edges) else out


def rescaled(col: Column, limit: float, divisor: float) -> Column:
    """Values above the limit were noted in a smaller unit: divide them."""
    return F.when(col > limit, col / divisor).otherwise(col)


def season(month: Column) -> Column:
    return recode(month, {12: "Winter", 1: "Winter", 2: "Winter", 3: "Spring", 4: "Spring", 5: "Spring",
                          6: "Summer", 7: "Summer", 8: "Summer"}, F.when(month.isNotNull(), F.lit("Fall")))


def time_band(ts: Column, labels: Sequence[str]) -> Column:
    """Six bands of four hours; the first wraps midnight (22:00 to 01:59)."""
    index = F.floor(F.pmod(F.hour(ts) + 2, F.lit(24)) / 4).cast("int")
    return F.when(ts.isNotNull(), F.element_at(F.array(*[F.lit(v) for v in labels]), index + 1))


def is_weekend(ts: Column) -> Column:
    """Friday from 19:00, Saturday, Sunday, and Monday before 02:00."""
    day, hour = F.weekday(ts), F.hour(ts)
    return ((day == 4) & (hour >= 19)) | day.isin(5, 6) | ((day == 0) & (hour < 2))


def missing_code(col: Column, junk: Sequence[str], code: int) -> Column:
    """Text code to integer: blanks, junk and unreadable texts become the missing code."""
    value = F.when(col.isin(list(junk)) | (F.trim(col) == ""), F.lit(None)).otherwise(col.try_cast("int"))
    return F.coalesce(value, F.lit(code))


def plain_code(col: Column, junk: Sequence[str], code: int) -> Column:
    """The same after dropping leading zeros."""
    return missing_code(F.ltrim(col, F.lit("0")), junk, code)


def any_set(*cols: Column) -> Column:
    """1 when any of the text flags is 1, else 0 (missing flags count as 0)."""
    return F.greatest(*[F.coalesce(c.try_cast("int"), F.lit(0)) for c in cols]).eqNullSafe(1).cast("int")


def base_level_rank(col: Column, order: Sequence[str]) -> Column:
    """Position in a fixed level order, for sorting and for choosing the base level; other levels come last."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), col)
    return F.when(place > 0, place).otherwise(len(order) + 1).cast("int")
