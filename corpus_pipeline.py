"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next.

Language ID drops what no language model accepts; of documents linked by their n-grams one stays; passages that an earlier
document holds are cut out; documents that hold benchmark passages go; what is left is packed into sequences.

A null, empty or letterless text goes at the first stage. Without any labelled document no language can be told: then every text
with letters stays. Very long texts are worked on whole. Of rows that repeat an id and its text all stay together or go together;
texts under one id, or without an id, are told apart by their hash. Ties between group members go to the least id. An empty table
gives an empty result at every stage. Columns other than the five of documents are left out before anything is joined.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import decontamination, language_id, ngram_join, packing, suffix_dedup
from tallyloom.llm.common import shared_folder, table, text_hash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NEAR_WORDS, NEAR_PERCENT = 5, 80  # near copies share so much of their word 5-grams; op8 has values of its own


def _same_text(name: str) -> Column:
    """Whether a row has the id, or the lack of one, and the text of a named row."""
    return F.col("doc_id").eqNullSafe(F.col(f"{name}_id")) & (text_hash() == F.col(f"{name}_hash"))


def accepted_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose best language model finds them usual; a missing language is filled in."""
    model = language_id.fit(docs.filter(~language_id.is_held_out()))
    found = language_id.identify(docs, model, passing=("text", "lang", "source", "n_chars"))
    return found.filter(~F.col("rejected")).withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that n-gram links join, the one with the least id. Rows that repeat an id and its text stay together."""
    kept = ngram_join.one_of_each(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)
    return docs.join(kept.select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")), _same_text("kept"), "left_semi").select(*COLUMNS)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without bytes that an earlier document has; characters cut in two go, and texts of which nothing is left."""
    left = suffix_dedup.suffix_dedup(docs, passing=("lang", "source"))
    # An invalid sequence becomes the replacement character; a valid text may hold it too and stays as it is.
    whole = F.try_validate_utf8(F.col("kept").cast("string"))
    cleaned = F.replace(F.make_valid_utf8(F.col("kept").cast("string")), F.lit("\ufffd"), F.lit(""))
    left = left.withColumn("text", F.coalesce(whole, cleaned)).withColumn("n_chars", F.char_length("text").cast("long"))
    return left.filter((F.col("n_removed") == 0) | (F.col("n_chars") > 0)).select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    marked = decontamination.contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    bad = marked.select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash"))
    return docs.join(bad, _same_text("bad"), "left_anti").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", accepted_language),
    ("ngram_join", one_of_each_group),
    ("suffix_dedup", without_repeated_passages),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

# Groups of links, suffix removal judged on what is left by them, and tokenizer ids are beyond SQL: tested by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
