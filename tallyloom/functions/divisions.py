"""Competition division codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed groups for divisions that carry no age.
PROFESSIONAL = "99-99"
PHYSICALLY_CHALLENGED = "98-98"


def age_group(division: Column) -> Column:
    """Age range of a division code (one letter and a range), or the fixed group of its special divisions."""
    return (
        F.when(division.isin("MPRO", "FPRO"), PROFESSIONAL)
        .when(division.isin("MPC", "FPC"), PHYSICALLY_CHALLENGED)
        .otherwise(F.regexp_replace(division, r"^\D(\d{2}-\d{2})$", "$1"))
    )


def lower_bound(group: Column) -> Column:
    return F.split_part(group, F.lit("-"), F.lit(1)).try_cast("double")
