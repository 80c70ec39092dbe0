"""Dates and times that arrive as text in several layouts, read without Python functions.

A text is split into its numbers; a layout test decides what each number means. Nothing here raises on bad
input: a text that fits no layout, or names no real day, becomes NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed layouts; a text fits at most one of the first three, and the last only if none of them. Each is "date time rest"; the rest may hold seconds and am/pm.
PLACEHOLDER_DAY = r"^12/30/1899 \d{1,2}:\d{2}"  # a time of day stored without a date
YEAR_FIRST = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}"
BUDDHIST_YEAR = r"^\d{1,2}/\d{1,2}/256\d \d{1,2}:\d{2}"
YEAR_LAST = r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}"
BUDDHIST_OFFSET = 543
NO_DATE = "2000-01-01"  # stands for a date written as all zeros


def hour_of_day(hour: Column, rest: Column) -> Column:
    """Hour on the 24-hour clock; the am/pm mark may follow seconds or blanks, in either case."""
    mark = F.lower(F.trim(rest))
    return (
        F.when(mark.endswith("pm") & (hour < 12), hour + 12)
        .when(mark.endswith("am") & (hour == 12), F.lit(0))
        .otherwise(hour)
    )


def standard_timestamps(df: DataFrame, texts: Mapping[str, Column]) -> DataFrame:
    """Add one timestamp (to the minute) per entry of ``texts``, read from any of the fixed layouts.

    The text is split in one projection and read in the next: each row is then split once, not once per use.
    """
    split = df.withColumns({
        name: part
        for out, text in texts.items()
        for name, part in {
            f"_{out}_parts": F.split(text, r"[-/ :]", 6),
            f"_{out}_layout": F.when(text.rlike(YEAR_FIRST), "iso")
            .when(text.rlike(PLACEHOLDER_DAY), "month first")
            .when(text.rlike(BUDDHIST_YEAR), "buddhist")
            .when(text.rlike(YEAR_LAST), "any"),
        }.items()
    })
    numbers = split.withColumns({f"_{out}": _numbers(F.col(f"_{out}_parts")) for out in texts})
    read = numbers.withColumns({out: _timestamp(F.col(f"_{out}_layout"), F.col(f"_{out}")) for out in texts})
    return read.drop(*[c for out in texts for c in (f"_{out}_parts", f"_{out}_layout", f"_{out}")])


def _numbers(parts: Column) -> Column:
    """Three date numbers, hour of day and minute. What follows the minute's two digits may hold seconds and am/pm."""
    minute = F.get(parts, F.lit(4))
    rest = F.concat(F.substring(minute, 3, 100), F.coalesce(F.get(parts, F.lit(5)), F.lit("")))
    a, b, c, hour = (F.get(parts, F.lit(i)).try_cast("int") for i in range(4))
    return F.struct(
        a.alias("a"), b.alias("b"), c.alias("c"), hour_of_day(hour, rest).alias("hour"), F.substring(minute, 1, 2).try_cast("int").alias("minute")
    )


def _timestamp(layout: Column, n: Column) -> Column:
    a, b, c = n["a"], n["b"], n["c"]

    def at(year: Column, month: Column, day: Column) -> Column:
        return F.try_make_timestamp_ntz(year, month, day, n["hour"], n["minute"], F.lit(0))

    zero = (a == 0) & (b == 0) & (c == 0)
    return (
        F.when(zero & layout.isin("iso", "any"), at(*[F.lit(int(x)) for x in NO_DATE.split("-")]))
        .when(layout == "iso", at(a, b, c))
        .when(layout == "month first", at(c, a, b))
        .when(layout == "buddhist", F.coalesce(at(c - BUDDHIST_OFFSET, b, a), at(c - BUDDHIST_OFFSET, a, b)))
        .when(layout == "any", F.coalesce(at(c, a, b), at(c, b, a)))
    )


def merged_timestamp(df: DataFrame, date_text: Column, time_text: Column, out: str) -> DataFrame:
    """Add the day of the date column with the time of its paired time column.

    The time column wins where both are readable, they disagree, and the date column's own time is after midnight.
    """
    read = standard_timestamps(df, {"_base": date_text, "_other": time_text})
    base, other = F.col("_base"), F.col("_other")
    clock = F.hour(base) * 60 + F.minute(base)
    other_clock = F.hour(other) * 60 + F.minute(other)
    takes_other = other.isNotNull() & (clock > 0) & (clock != other_clock)
    shifted = F.timestamp_add("MINUTE", other_clock - clock, base)
    return read.withColumn(out, F.when(takes_other, shifted).otherwise(base)).drop("_base", "_other")


def reading_timestamp(year: Column, month: Column, day: Column, time_text: Column) -> Column:
    """Timestamp from separate year, month and day columns and a 12-hour clock text; NULL when unreadable."""
    text = F.concat(F.concat_ws("-", year, month, day), F.lit(" "), time_text)
    return F.try_to_timestamp(text, F.lit("yyyy-M-d h:mm a")).cast("timestamp_ntz")


def seconds_of(text: Column) -> Column:
    """Seconds of an h:mm:ss text, NULL when it is not one."""
    parts = F.split(text, ":")
    return F.when(
        text.rlike(r"^\d+:\d{2}:\d{2}$"),
        parts[0].cast("double") * 3600 + parts[1].cast("double") * 60 + parts[2].cast("double"),
    )


def repair_minutes(text: Column) -> Column:
    """A time written as mm:ss:00 (ten minutes or more) becomes 00:mm:ss."""
    return F.regexp_replace(text, r"^([1-9][0-9]):([0-9]{2}):00$", "00:$1:$2")
