"""Catalog tables, stored intermediates and lookups."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def external_table(spark: SparkSession, name: str, columns: str, path: str, sep: str = ";") -> DataFrame:
    """(Re)create an external delimited table over a folder; the files stay when the table is dropped."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING csv OPTIONS (sep '{sep}', header 'false') LOCATION '{path}'")
    return spark.table(name)


def table_as(df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 0) -> DataFrame:
    """Store a result as a table; bucketing on the join key spares later joins their shuffle."""
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def stored(spark: SparkSession, path: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = ()) -> DataFrame:
    """Columnar intermediate that is written once: finished output is read back instead of being built again."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
    if not files.exists(done):
        # an unfinished attempt has no success mark and is replaced
        build().write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return spark.read.parquet(path)


def schema_difference(left: DataFrame, right: DataFrame) -> tuple[list[str], list[str]]:
    """Names only in the left and only in the right table."""
    a, b = set(left.columns), set(right.columns)
    return sorted(a - b), sorted(b - a)


def stack_reconciled(first: DataFrame, second: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename the second table's deviating columns, insist that the names now agree, and stack."""
    renamed = second.withColumnsRenamed(dict(renames))
    only_first, only_second = schema_difference(first, renamed)
    if only_first or only_second:
        raise ValueError(f"columns still differ: {only_first} / {only_second}")
    return first.unionByName(renamed)


def learn_dimension(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Key-to-value dimension from facts: blank keys and values are skipped, the last value in row order wins."""
    known = df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    known = known.where((F.col(key).cast("string") != "") & (F.col(value).cast("string") != ""))
    return known.groupBy(key).agg(F.max_by(value, order).alias(value))
