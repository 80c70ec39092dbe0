"""Helpers shared by the training-data operators: table access, the shared folder, dealing rows into parts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

A_TO_Z = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PART_BYTES = 4_000_000  # text that one part holds; a group given to Python is one part


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """One of the given tables with the named columns only."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the one that driver and executors share (``spark.checkpoint.dir``).

    Only a local session that names none gets a folder of its own; elsewhere a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def part_count(docs: DataFrame, text: str = "text", part_bytes: int = PART_BYTES) -> int:
    """Number of parts of about ``part_bytes`` of text each, and a few for every shuffle partition."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(int(total // part_bytes) + 1, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def in_parts(column: Column | str, parts: int, *more: Column | str) -> Column:
    """The part a row belongs to, from the hash of its id and further columns."""
    return F.pmod(F.xxhash64(column, *more), F.lit(parts)).cast("int")


def text_hash(text: str = "text") -> Column:
    """Tells texts under one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


# What a Python worker keeps between its tasks, by operator: how to let go of it. Workers outlive the stage that fills them.
KEPT: dict[str, Callable[[], None]] = {}


def keep_only(operator: str) -> None:
    """Called where an operator's task begins: frees what others have left in this worker, and returns freed memory."""
    import ctypes

    import pyarrow as pa

    for name in [name for name in KEPT if name != operator]:
        KEPT.pop(name)()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed memory until asked
    if trim is not None:
        trim(0)
