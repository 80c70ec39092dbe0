"""Quality rules as a bitmask ledger.

Every rule is evaluated once per text; the ledger keeps the measurements and one failure bit per rule. Policies are versioned
sets of rules: applying one, or asking what each rule alone decides, is bit arithmetic on the ledger and never reads the text
again. All of it stays inside one row, so nothing is shuffled but for the few sums of an ablation.

A null text has no words and fails the base. A very long text is measured whole, in its own row. A measurement that equals a
threshold does not fail. Empty tables give empty ledgers; repeated rows give repeated entries; columns
other than doc_id and text are left out, so no name can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"

# name of the rule, its failure over the measurements; a rule's bit is its place in this list and never changes.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 5 * word_chars"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("shouting", "100 * n_capitals > 40 * word_chars"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
]
BITS = {name: 1 << place for place, (name, _) in enumerate(RULES)}


def mask_of(*names: str) -> int:
    return sum(BITS[name] for name in names)


BASE = mask_of("few_words", "repeated_words")
POLICIES: dict[str, int] = {
    "base": BASE,
    "v1": BASE | mask_of("symbols", "repeated_lines"),
    "v2": mask_of(*BITS),
}
CURRENT = "v2"


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, measurements) of (doc_id, text) rows. Three-word windows are told apart by 64-bit hashes within one text."""
    text = F.coalesce("text", F.lit(""))
    words = docs.select(
        "doc_id",
        F.array_remove(F.split(text, SPACE + "+"), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
    )
    n = F.size("words")
    window = lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    windows = words.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_symbols",
        "n_capitals",
        F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window)).alias("windows"),
    )
    # Only texts with an equal pair go on: their windows in order of (hash, place), neighbours compared.
    has_pair = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ordered = windows.withColumn("placed", F.when(has_pair, placed)).drop("windows")
    equal = lambda one, k: F.coalesce(F.get("placed", k - 1)["h"] == one["h"], F.lit(False)) | F.coalesce(
        F.get("placed", k + 1)["h"] == one["h"], F.lit(False)
    )
    starts = F.sort_array(F.transform(F.filter("placed", equal), lambda one: one["i"]))
    started = ordered.withColumn("starts", starts).drop("placed")
    # A repeated window covers three words, less where the next repeated one begins earlier.
    covered = F.transform("starts", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("starts", k + 1) - x, F.lit(3))))
    total = F.aggregate(covered, F.lit(0), lambda a, b: a + b)
    return started.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long")).drop("starts")


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements and ``failed_bits`` per document."""
    bits = [F.when(F.expr(failure), F.lit(BITS[name])).otherwise(F.lit(0)) for name, failure in RULES]
    return measured(docs).withColumn("failed_bits", sum(bits[1:], bits[0]).cast("long"))


def fails(policy: str) -> Column:
    """Whether a ledger row fails any rule of a policy."""
    return F.col("failed_bits").bitwiseAND(F.lit(POLICIES[policy])) != 0


def ablation(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """One row per rule of a policy: documents that fail it, that fail it alone, and that are kept without it."""
    mask = POLICIES[policy]
    failed = F.col("failed_bits").bitwiseAND(F.lit(mask))
    sums = [F.count(F.lit(1)).alias("n_docs")]
    chosen = [(name, bit) for name, bit in BITS.items() if bit & mask]
    for name, bit in chosen:
        sums += [
            F.sum(F.when(failed.bitwiseAND(F.lit(bit)) != 0, 1).otherwise(0)).alias(f"{name}_any"),
            F.sum(F.when(failed == bit, 1).otherwise(0)).alias(f"{name}_alone"),
            F.sum(F.when(failed.bitwiseAND(F.lit(mask & ~bit)) == 0, 1).otherwise(0)).alias(f"{name}_without"),
        ]
    rows = [
        F.struct(
            F.lit(name).alias("rule"),
            F.coalesce(f"{name}_any", F.lit(0)).alias("n_failed"),
            F.coalesce(f"{name}_alone", F.lit(0)).alias("n_failed_alone"),
            F.coalesce(f"{name}_without", F.lit(0)).alias("n_kept_without"),
        )
        for name, _ in chosen
    ]
    return entries.agg(*sums).select("n_docs", F.inline(F.array(*rows)))
