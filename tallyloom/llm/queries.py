"""Registered queries of the training-data operators, each over its whole table, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (
    chat, decontamination, filter_audit, fim, html_extraction, language_id, ngram_join, packing, quality, suffix_dedup, token_counts,
    token_output, warc,
)
from tallyloom.llm.common import shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def registered(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[query.__name__] = query
    return query


@registered
def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, folder, "documents", "doc_id", "text"), with_kept=False)


@registered
def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, with_ids=False)


@registered
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return decontamination.contamination(docs, table(spark, folder, "benchmark", "item_id", "text"))


ORACLE["op3_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), v AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS size, array_to_string(words[i:i + 9], ' ') AS gram
  FROM b, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS u(i) WHERE len(words) > 0
), g AS (
  SELECT doc_id, i, s.size, array_to_string(words[i:i + s.size - 1], ' ') AS gram
  FROM d, (SELECT DISTINCT size FROM v) AS s, unnest(range(1, len(words) - s.size + 2)) AS u(i)
), o AS (
  SELECT doc_id, i, g.size, item_id FROM g JOIN v ON v.gram = g.gram AND v.size = g.size
), h AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM o, unnest(range(i, i + size)) AS u(p) GROUP BY doc_id
), n AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM o) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN n USING (doc_id)
"""


@registered
def op4_token_output(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    path = shared_folder(spark, "token-ids")
    token_output.write_ids(docs, public_tokenizers.path("byte_bpe_50k.json"), 0, path)
    return token_output.checksums(token_output.read_ids(spark, path))


@registered
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    counts = token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), shared_folder(spark, "token-counts"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@registered
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    entries = quality.ledger(table(spark, folder, "documents", "doc_id", "text"))
    entries = entries.withColumn("base_failed", quality.fails("base")).withColumn("kept", ~quality.fails(quality.CURRENT))
    return entries.drop("n_lines", "n_capitals")


ORACLE["op5_quality_rules"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM t
), g AS (
  SELECT doc_id, i, words[i:i + 2] AS gram FROM w, unnest(range(1, len(words) - 1)) AS u(i)
), r AS (
  SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS following
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1
), c AS (
  SELECT doc_id, sum(least(3, coalesce(following - i, 3))) AS n_repeat_words FROM r GROUP BY doc_id
), m AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(regexp_extract_all(text, '\p{Lu}')) AS n_capitals,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN c USING (doc_id)
), f AS (
  SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (100 * n_symbols > 5 * word_chars)::INT
    + 8 * (100 * n_dup_lines > 50 * n_lines)::INT + 16 * (100 * n_capitals > 40 * word_chars)::INT
    + 32 * (word_chars < 2 * n_words)::INT + 64 * (word_chars > 15 * n_words)::INT AS BIGINT) AS failed_bits FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits,
  (failed_bits & 3) <> 0 AS base_failed, failed_bits = 0 AS kept FROM f
"""


@registered
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    model = language_id.fit(docs.filter(~language_id.is_held_out()))
    return language_id.identify(docs, model).withColumn("held_out", language_id.is_held_out())


@registered
def op8_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.linked_groups(table(spark, folder, "documents", "doc_id", "text"))


@registered
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages", "page_id", "url", "html")
    records = warc.archived(spark, pages, shared_folder(spark, "warc")).filter("gap IS NULL")
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op9_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM f
"""


@registered
def op10_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.digests(chat.examples(given.union(control)))


def _escaped(column: str) -> str:
    """The template's escapes as SQL."""
    sql = f"replace(coalesce({column}, ''), chr(92), chr(92) || chr(92))"
    for control in chat.CONTROL:
        sql = f"replace({sql}, '{control}', '{control[0]}' || chr(92) || '{control[1:]}')"
    return sql


ORACLE["op10_chat_formatting"] = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), f AS (
  SELECT *, length({_escaped("role")}) + length({_escaped("text")}) + {len(chat.START + chat.SEPARATOR + chat.END) + 1} AS size FROM t
), s AS (
  SELECT *, sum(size) OVER w AS upto, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n
  FROM f WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)
), a AS (
  SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '') AS loss,
    CAST(sum(upto) FILTER (role = 'assistant' OR place = n) AS BIGINT) AS formatted_chars
  FROM s GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM a
"""


@registered
def op11_fim(spark: SparkSession, folder: str) -> DataFrame:
    return fim.digests(fim.transform(table(spark, folder, "documents", "doc_id", "text")))


ORACLE["op11_fim"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents
), h AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, ('0x' || digest[1:8])::BIGINT AS h1, ('0x' || digest[9:16])::BIGINT AS h2,
    ('0x' || digest[25:32])::BIGINT % 100 AS h4 FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
      WHEN h4 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h
), p AS (
  SELECT *, array_to_string(units[1:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle,
    array_to_string(units[high + 1:], '') AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""


@registered
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text", "source")
    return filter_audit.audit(filter_audit.masks(docs, table(spark, folder, "labels", "doc_id", "quality", "toxic")))


ORACLE["op12_filter_audit"] = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), l AS (
  SELECT doc_id, max(coalesce((quality = 1)::INT, 0)) AS good, max(coalesce((toxic = 1)::INT, 0)) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [
      len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
      100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text), regexp_matches(text, '[#$%&*|]'),
      coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY text), false)] AS failed
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id
), o AS (
  SELECT a || b || c || d || e AS filter_order, [ascii(x) - 64 FOR x IN [a, b, c, d, e]] AS places
  FROM unnest(['A', 'B', 'C', 'D', 'E']) AS ua(a), unnest(['A', 'B', 'C', 'D', 'E']) AS ub(b),
    unnest(['A', 'B', 'C', 'D', 'E']) AS uc(c), unnest(['A', 'B', 'C', 'D', 'E']) AS ud(d), unnest(['A', 'B', 'C', 'D', 'E']) AS ue(e)
  WHERE len(list_distinct([a, b, c, d, e])) = 5
), g AS (
  SELECT part, failed, count(*) AS n, sum(good) AS n_good, sum(toxic) AS n_toxic FROM m GROUP BY part, failed
), r AS (
  SELECT part, filter_order, step, failed[places[step]] AS fails,
    len(list_filter(places[:step - 1], lambda p: failed[p])) > 0 AS gone,
    len(list_filter(failed, lambda f: f)) AS n_failed, n, n_good, n_toxic, places[step] AS filter
  FROM g, o, unnest(range(1, 6)) AS u(step)
), s AS (
  SELECT part, filter_order, CAST(step AS INT) AS step, any_value(filter) AS filter,
    CAST(coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (fails AND gone), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (fails AND n_failed = 1), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(n_good) FILTER (fails AND NOT gone), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(n_toxic) FILTER (fails AND NOT gone), 0) AS BIGINT) AS toxic_lost
  FROM r GROUP BY part, filter_order, step
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM s
"""


@registered
def op13_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extraction.main_texts(table(spark, folder, "pages", "page_id", "url", "html"))


# The given pages mark their article by its element and use few references, so SQL can cut it out; other pages are tested by hand.
ORACLE["op13_html_extraction"] = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS inner_html FROM pages
), t AS (
  SELECT page_id, url, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(inner_html,
    '<(/?(p|h1)|br)>', ' ', 'g'), '</?b>', '', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g')) AS text FROM a
), s AS (
  SELECT page_id, url, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM t
)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM s
"""
