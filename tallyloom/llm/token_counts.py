"""Token counts through a digest cache.

A count depends on the content (here the whole UTF-8 text, null as empty) and on the tokenizer's version. Both are digested;
counts known to the cache are joined, each distinct missing content is encoded once, and its count is appended.

Only digests and ids are shuffled, but for the one text per missing content, which is joined on its row's own id and so
spreads evenly, however many copies a text has. Nulls and empty texts count zero tokens; repeated rows give repeated
results; rows without an id are counted too; a very long text is encoded in one task. An empty table gives no rows and appends
nothing; other columns are left out, so no name can clash. The cache is Parquet in any store Spark writes to, one row per content and
version; rows appended twice by two jobs agree and are merged when read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.encoding import encoder, version_digest

CACHE = "content binary, tokenizer string, n_tokens long"


def cached_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(content, n_tokens) of one tokenizer version; an empty frame if the cache was never written."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], CACHE).select("content", "n_tokens")
    rows = spark.read.schema(CACHE).parquet(cache).filter(F.col("tokenizer") == version)
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def encoded_counts(texts: DataFrame, tokenizer: str) -> DataFrame:
    """Count the tokens of (content, text) rows."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encode = encoder(tokenizer)
        for rows in batches:
            counts = [len(encode.pack(text.as_py())) // 4 for text in rows.column(1)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(counts, pa.int64())], ["content", "n_tokens"])

    return texts.select("content", "text").mapInArrow(run, "content binary, n_tokens long")


def token_counts(docs: DataFrame, tokenizer: str, cache: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of (doc_id, text); distinct texts that are new to ``cache`` are appended to it."""
    spark = docs.sparkSession
    version = version_digest(tokenizer)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("content", F.unhex(F.sha2("text", 256)))
    keyed = rows.select("doc_id", "content", F.octet_length("text").cast("long").alias("n_bytes"))
    missing = (
        keyed.groupBy("content")
        .agg(F.min("doc_id").alias("first_id"))
        .join(cached_counts(spark, cache, version), "content", "left_anti")
        .select("first_id", F.col("content").alias("wanted"))
    )
    picked = rows.join(missing, F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("content") == F.col("wanted")))
    new = encoded_counts(picked, tokenizer)
    new = new.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))  # rows may repeat with their id
    new.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    return keyed.join(cached_counts(spark, cache, version), "content").select("doc_id", "n_bytes", "n_tokens")
