"""Benchmark decontamination with a distributed positional inverted index.

Only terms that a benchmark window can be looked up by are indexed. Every window names its two rarest terms, rare by their
number of postings in the training texts; postings of those terms are stored with their position and the words around.
The lists of the two terms, each shifted by the term's offset in the window, are intersected, and what remains is compared
word by word with the stored surroundings: exact phrases. The same surroundings tell proximity matches, in which all words of
a window stand near its rarest term in any order.

Built from DataFrame functions alone. Texts are never shuffled: a bit table with ``BITS_PER_TERM`` bits for each term, of 8 MB
at most, lets each scan pass over words that no window has; the few that get through are parted from the terms by a join before
anything is stored. A frequent term is never looked up if its window has a rarer one; skewed lists are joins of two shuffled
sides, which adaptive execution splits.

A very long text is one row of words, and is looked through like any other. A null text has no words; an item without words has no windows; an item shorter than a window is one window. Repeated rows get
equal results. Rows are told apart by id and text, so a repeated id with another text has its own result. Empty tables give
no hits or no rows. Other columns are left out, so no name can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.llm.common import A_TO_Z, stored

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # of either case
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
BITS_PER_TERM = 32
LEAST_LONGS, MOST_LONGS = 1 << 14, 1 << 20  # bit tables of 128 KB to 8 MB; a fuller one lets more words through to the join


def words_of(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), *A_TO_Z)
    return F.array_remove(F.split(lower, BETWEEN), "")


def windows_of(items: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window_id, words) and the items (item_id, window_id) that hold them."""
    words = items.select("item_id", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    last = F.greatest(F.size("words") - size, F.lit(0))
    held = words.select("item_id", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("words", i + 1, size))).alias("words"))
    held = held.withColumn("line", F.array_join("words", " ")).dropDuplicates(["item_id", "line"])
    windows = held.groupBy("line").agg(F.first("words").alias("words"))
    windows = stored(windows.withColumn("window_id", F.monotonically_increasing_id()), "windows")  # numbers hold once stored
    held = stored(held.select("item_id", "line").join(windows, "line").select("item_id", "window_id"), "window-items")
    return windows.select("window_id", "words"), held


def _bit(term: Column, longs: int) -> tuple[Column, Column]:
    """Where a term's bit lies: the number of a long and the place in it."""
    place = F.pmod(F.xxhash64(term), F.lit(longs * 64))
    return F.floor(place / 64).cast("int"), (place % 64).cast("int")


def bit_table(terms: DataFrame) -> tuple[DataFrame, int]:
    """One row with one array of longs, in which the bits of all distinct terms are set, and the number of longs."""
    spark, longs = terms.sparkSession, LEAST_LONGS
    needed = terms.count() * BITS_PER_TERM // 64
    while longs < min(needed, MOST_LONGS):
        longs *= 2
    number, place = _bit(F.col("term"), longs)
    own = terms.select(number.alias("number"), F.expr("1L").alias("one"), place.alias("place"))
    own = own.select("number", F.call_function("shiftleft", F.col("one"), F.col("place")).alias("bits"))
    none = spark.range(longs).select(F.col("id").cast("int").alias("number"), F.lit(0).cast("long").alias("bits"))
    filled = own.unionByName(none).groupBy("number").agg(F.bit_or("bits").alias("bits"))
    listed = filled.agg(F.sort_array(F.collect_list(F.struct("number", "bits"))).alias("all"))
    return listed.select(F.transform("all", lambda x: x["bits"]).alias("bits")), longs


def may_hold(term: Column, bits: tuple[DataFrame, int]) -> Column:
    number, place = _bit(term, bits[1])
    return F.getbit(F.element_at(bits[0].scalar(), number + 1), place) == 1


def postings_of(texts: DataFrame, first: DataFrame, second: DataFrame, reach: int) -> DataFrame:
    """(term, doc_id, text_hash, position, around) of every occurrence of a term; ``around``, the words near it, only for first terms."""
    terms = first.select("term", F.lit(True).alias("is_first")).unionByName(second.select("term", F.lit(False).alias("is_first")))
    terms = stored(terms.groupBy("term").agg(F.max("is_first").alias("is_first")), "index-terms")
    placed = texts.select("doc_id", "text_hash", "words", F.posexplode("words").alias("position", "term"))
    placed = placed.filter(may_hold(F.col("term"), bit_table(terms)))
    begin = F.greatest(F.col("position") - reach, F.lit(0))
    around = F.array_join(F.slice("words", begin + 1, F.col("position") - begin + 1 + reach), " ")
    around = F.when(may_hold(F.col("term"), bit_table(terms.filter("is_first"))), around)
    placed = placed.select("term", "doc_id", "text_hash", "position", around.alias("around"))
    around = F.when(F.col("is_first"), F.col("around")).alias("around")
    return stored(placed.join(terms, "term").select("term", "doc_id", "text_hash", "position", around), "postings")


def occurrences(docs: DataFrame, windows: DataFrame, window: int = WINDOW, near: int | None = None) -> DataFrame:
    """(doc_id, text_hash, start, window_id, length): exact occurrences of windows; with ``near``, proximity matches also.

    A proximity match has every word of its window within ``near`` words beyond the window's size on either side of its
    rarest word; it is marked by ``exact`` = false and starts at that word.
    """
    places = windows.select("window_id", F.size("words").alias("length"), F.posexplode("words").alias("offset", "term"))
    reach = window - 1 + (near or 0)

    texts = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), words_of(F.col("text")).alias("words"))
    tokens = texts.select(F.explode("words").alias("term"))
    terms = stored(places.select("term").distinct(), "window-terms")
    counts = tokens.filter(may_hold(F.col("term"), bit_table(terms))).groupBy("term").count()

    # The two rarest terms of each window, and how far the second stands behind the first. Windows that follow one another in
    # an item mostly share them, so lists are intersected once per pair.
    rare = places.groupBy("window_id", "length", "term").agg(F.min("offset").alias("offset"))
    rare = rare.join(counts, "term", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    rare = rare.withColumn("nth", F.row_number().over(W.partitionBy("window_id").orderBy("count", "term"))).filter("nth <= 2")
    nth = lambda n, name: F.max(F.when(F.col("nth") == n, F.col(name)))
    rare = rare.groupBy("window_id", "length").agg(
        F.min("count").alias("least"),
        nth(1, "term").alias("term"),
        nth(2, "term").alias("second"),
        nth(1, "offset").alias("offset"),
        (nth(2, "offset") - nth(1, "offset")).alias("behind"),
    )
    rare = stored(rare.filter("least > 0").drop("least"), "probes")  # a term never seen: no occurrence
    pairs = rare.select("term", "second", "behind").distinct()

    # Postings of those terms, stored; those of the rarest terms with the words around them.
    second_terms = rare.select(F.col("second").alias("term")).filter("term IS NOT NULL")
    postings = postings_of(texts, rare.select("term"), second_terms, reach)

    # Intersect the lists of the two terms, the second shifted back.
    first = pairs.join(postings.select("term", "doc_id", "text_hash", "position"), "term")
    shifted = pairs.withColumnsRenamed({"term": "term1", "second": "second1", "behind": "behind1"}).join(
        postings.select(F.col("term").alias("second1"), F.col("doc_id").alias("doc_id1"), F.col("text_hash").alias("hash1"), F.col("position").alias("at")), "second1"
    )
    same = F.col("doc_id").eqNullSafe(F.col("doc_id1")) & (F.col("text_hash") == F.col("hash1"))
    same = same & (F.col("position") == F.col("at") - F.col("behind1"))
    same = same & (F.col("term") == F.col("term1")) & (F.col("second") == F.col("second1")) & (F.col("behind") == F.col("behind1"))
    met = first.join(shifted, same, "left_semi").unionByName(first.filter("second IS NULL"))

    # What is left, for every window of the pair: compare all its words.
    met = met.select("term", F.col("second").alias("second2"), F.col("behind").alias("behind2"), "doc_id", "text_hash", "position")
    surrounded = postings.filter("around IS NOT NULL").select(*(F.col(c).alias(f"{c}_p") for c in postings.columns))
    here = F.col("doc_id").eqNullSafe(F.col("doc_id_p")) & (F.col("text_hash") == F.col("text_hash_p")) & (F.col("position") == F.col("position_p"))
    met = met.join(surrounded, here & (F.col("term") == F.col("term_p"))).select("term", "second2", "behind2", "doc_id", "text_hash", "position", F.split("around_p", " ").alias("around"))
    told = rare.join(windows, "window_id")
    paired = F.col("second").eqNullSafe(F.col("second2")) & F.col("behind").eqNullSafe(F.col("behind2"))
    before = F.least(F.col("position"), F.lit(reach))
    found = met.join(told, "term").filter(paired & (before >= F.col("offset")))
    exact = found.filter(F.slice("around", before - F.col("offset") + 1, F.col("length")) == F.col("words"))
    exact = exact.select("doc_id", "text_hash", (F.col("position") - F.col("offset")).alias("start"), "window_id", "length").distinct()
    if near is None:
        return exact
    close = told.join(postings.filter("around IS NOT NULL"), "term").withColumn("around", F.split("around", " "))
    close = close.filter(F.size(F.array_except("words", "around")) == 0)
    close = close.select("doc_id", "text_hash", F.col("position").alias("start"), "window_id", "length", F.lit(False).alias("exact"))
    return exact.withColumn("exact", F.lit(True)).unionByName(close)


def hits(found: DataFrame, held: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_hit, n_items, items_sha256) of the texts with occurrences; ``held`` tells the items of windows."""
    found = stored(found, "occurrences")
    spans = found.groupBy("doc_id", "text_hash", "start").agg(F.max("length").alias("length"))
    earlier = W.partitionBy("doc_id", "text_hash").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    new = end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(earlier), F.lit(0)))
    spans = spans.withColumn("new", F.greatest(new, F.lit(0)))
    words = spans.groupBy("doc_id", "text_hash").agg(F.sum("new").cast("long").alias("n_hit"))
    named = found.select("doc_id", "text_hash", "window_id").distinct().join(held, "window_id")
    named = named.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("ids"))
    named = named.select(
        F.col("doc_id").alias("doc_id2"),
        F.col("text_hash").alias("text_hash2"),
        F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("doc_id2")) & (F.col("text_hash") == F.col("text_hash2"))
    return words.join(named, same).drop("doc_id2", "text_hash2")


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, n_hit, n_items, items_sha256) of the texts in which a window of an item occurs."""
    windows, held = windows_of(items, window)
    return hits(occurrences(docs, windows, window), held)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): words, words inside an occurrence, items that occur, and the verdict."""
    marked = contaminated(docs, items, window)
    marked = marked.withColumnsRenamed({"doc_id": "doc_id2", "text_hash": "text_hash2"})
    text = F.coalesce("text", F.lit(""))
    all_docs = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"))
    same = F.col("doc_id").eqNullSafe(F.col("doc_id2")) & (F.col("text_hash") == F.col("text_hash2"))
    return all_docs.join(marked, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
