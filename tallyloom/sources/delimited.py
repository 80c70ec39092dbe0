"""Delimited text in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def read_delimited(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None, sep: str = ",",
    header: bool = True, keep_corrupt: bool = False,
) -> DataFrame:
    """Delimited text. With a schema nothing is inferred; without one the types are, at the cost of another read.

    Malformed fields become NULL; ``keep_corrupt`` also keeps the text of each malformed line.
    """
    reader = spark.read.option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if keep_corrupt:
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).csv(path)


def to_lines(df: DataFrame, sep: str = ",", line: str = "line", keep: Sequence[str] = ()) -> DataFrame:
    """Rows as delimited text in one column, quoted where needed; ``keep`` names columns to carry beside it."""
    fields = [c for c in df.columns if c not in keep]
    return df.select(*keep, F.to_csv(F.struct(*fields), {"sep": sep}).alias(line))


def from_lines(lines: DataFrame, schema: StructType | str, sep: str = ",", line: str = "line") -> DataFrame:
    """Delimited text of a column as typed columns beside the others. What does not fit its type is NULL; ``_corrupt_record``
    keeps the text of lines with such a field or with another number of fields."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = F.from_csv(line, whole.toDDL(), {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return lines.withColumn("_parsed", parsed).select(*[c for c in lines.columns if c != line], "_parsed.*")


def normal_name(name: str) -> str:
    return name.lower().replace(" ", "_")


def read_text_columns(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> DataFrame:
    """Every column as text, names in lower case with underscores; coercion is left to the cleaning steps."""
    df = spark.read.option("sep", sep).option("header", True).csv(path)
    return df.toDF(*[normal_name(c) for c in df.columns])


def read_years(spark: SparkSession, paths: Sequence[str], sep: str = ",") -> DataFrame:
    """Yearly files whose columns may differ, stacked by name, with the file each row came from."""
    stacked = None
    for path in paths:
        part = read_text_columns(spark, path, sep).withColumn("source_file", F.col("_metadata.file_name"))
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    return stacked


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    df.write.mode("overwrite").option("sep", sep).option("header", header).csv(path)
