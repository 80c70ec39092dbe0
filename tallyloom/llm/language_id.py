"""Language identification with interpolated Kneser-Ney character models.

One model per language, over letters in lower case with single spaces between words. The log-probabilities of all n-grams
seen in any language lie in hash-sorted arrays, a column per language; an n-gram that no language saw falls back to the
shorter one with the context's weight, which lies in a second set of sorted arrays. A text goes to the language with the
lowest cross-entropy per character, and is rejected if that lies above what calibration texts of the language show.

Fitted on a sample of labelled rows of a documented size per language, since models of letters settle early; every text is
scored whole. What reaches the driver, and every worker as a broadcast, are the n-gram counts of that sample: bounded per language,
so they grow with the number of languages, not of rows. Calibration texts of every length count, short ones less; a language
without any is held to the limits of all languages together, and a sample without any to those of the texts learned from.

A null text or one without letters (Unicode category L) is ``und``, score 0, rejected. Without labelled rows every text is ``und``,
and none with letters is rejected: there is nothing to judge by. The score weighs the languages by their likelihood over at most
``EVIDENCE`` characters, since neighbouring characters are no independent witnesses. Ties go to the first language by name.
Repeated rows get equal results, an empty table none; other columns never matter.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import keep_only, stored

ORDER = 4
DISCOUNT = 0.75
PER_LANGUAGE = 1500  # expected number of labelled texts per language that are learned from; a fifth of them calibrates
BLOCK = 1_000_000  # characters scored at once
EVIDENCE = 200  # characters that a score is drawn from at most
SETTLED = 100  # characters at which a calibration text has half its weight
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*+")
STEP = np.uint64(0x9E3779B97F4A7C15)


def plain(text: str | None) -> str:
    """Letters in lower case, words parted by one space, padded so that every character has a full context."""
    words = LETTERS.findall(text.lower()) if text else []
    return " " * (ORDER - 1) + " ".join(words) + " " if words else ""


def keys_of(codes: np.ndarray, order: int, ends: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the n-grams that end at the given positions, at all by default; those before ``order - 1`` are of no use."""
    ends = np.arange(len(codes)) if ends is None else ends
    keys = np.full(len(ends), order, "uint64")
    for back in range(order - 1, -1, -1):
        keys *= STEP
        keys += codes[ends - back] + np.uint64(1)
        keys ^= keys >> np.uint64(29)
    return keys


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4").astype("uint64")


@dataclass
class Model:
    languages: list[str]
    unknown: np.ndarray  # per language: log-probability of a character never seen
    grams: dict[int, tuple[np.ndarray, np.ndarray]]  # order: sorted hashes, log-probabilities per language
    weights: dict[int, tuple[np.ndarray, np.ndarray]]  # length of the context: sorted hashes, log-weights per language
    # language, and None for all: mean and deviation of calibration texts, deviation of a character
    limits: dict[str | None, tuple[float, float, float]]

    def char_scores(self, codes: np.ndarray) -> np.ndarray:
        """Log-probability of each character, a column per language."""
        out = np.zeros((len(codes), len(self.languages)), "float32")
        open_at = np.arange(len(codes))
        for order in range(ORDER, 0, -1):
            sorted_keys, values = self.grams[order]
            keys = keys_of(codes, order, open_at)
            found = _lookup(sorted_keys, keys)
            hit = found >= 0
            out[open_at[hit]] += values[found[hit]]
            open_at = open_at[~hit]
            if order > 1 and len(open_at):
                contexts = keys_of(codes, order - 1, open_at - 1)
                at = _lookup(self.weights[order - 1][0], contexts)
                known = at >= 0
                out[open_at[known]] += self.weights[order - 1][1][at[known]]
        out[open_at] += self.unknown
        return out


def _lookup(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in a sorted array, or -1."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


def _interpolated(counts: dict[str, int]) -> tuple[dict[str, float], dict[str, float], int]:
    """Probabilities of all n-grams, weights of all contexts, and the number of characters, from counts of the longest n-grams."""
    levels: dict[int, dict[str, int]] = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):  # a shorter n-gram counts the characters that come before it
        levels[order] = Counter(gram[1:] for gram in levels[order + 1])
    alphabet = len(levels[1]) + 1
    probability, weight = {"": 1.0 / alphabet}, {}
    for order in range(1, ORDER + 1):
        total: dict[str, int] = defaultdict(int)
        kinds: dict[str, int] = defaultdict(int)
        for gram, count in levels[order].items():
            total[gram[:-1]] += count
            kinds[gram[:-1]] += 1
        for context in total:
            weight[context] = DISCOUNT * kinds[context] / total[context]
        for gram, count in levels[order].items():
            context = gram[:-1]
            probability[gram] = (count - DISCOUNT) / total[context] + weight[context] * probability[gram[1:]]
    return probability, weight, alphabet


def build(counts: dict[str, dict[str, int]]) -> Model:
    """A model from the counts of the longest n-grams per language."""
    languages = sorted(counts)
    tables = [_interpolated(counts[language]) for language in languages]
    grams, weights = {}, {}

    def value(table: tuple, gram: str) -> float:
        factor = 1.0
        while gram not in table[0]:
            factor *= table[1].get(gram[:-1], 1.0)
            gram = gram[1:]
        return factor * table[0][gram]

    for order in range(1, ORDER + 1):
        seen = sorted({gram for table in tables for gram in table[0] if len(gram) == order})
        grams[order] = _sorted_table(seen, order, [[np.log(value(table, gram)) for table in tables] for gram in seen], len(languages))
        if order < ORDER:
            contexts = sorted({c for table in tables for c in table[1] if len(c) == order})
            logs = [[np.log(table[1].get(c, 1.0)) for table in tables] for c in contexts]
            weights[order] = _sorted_table(contexts, order, logs, len(languages))
    unknown = np.log([table[1].get("", 1.0) / table[2] for table in tables]).astype("float32")
    return Model(languages, unknown, grams, weights, {})


def _sorted_table(grams: list[str], order: int, values: list[list[float]], width: int) -> tuple[np.ndarray, np.ndarray]:
    if not grams:
        return np.empty(0, "uint64"), np.empty((0, width), "float32")
    keys = keys_of(codes_of("".join(grams)), order)[order - 1 :: order]
    by_key = np.argsort(keys)
    return keys[by_key], np.array(values, "float32")[by_key]


def scored(texts: list[str | None], model: Model) -> Iterator[tuple[int, np.ndarray, float]]:
    """(characters, cross-entropy per language, deviation of a character in the best one) of each text, long ones block by block."""
    block: list[str] = []
    size = 0
    for text in texts:
        block.append(plain(text))
        size += len(block[-1])
        if size >= BLOCK:
            yield from _scored_block(block, model)
            block, size = [], 0
    yield from _scored_block(block, model)


def _scored_block(block: list[str], model: Model) -> Iterator[tuple[int, np.ndarray, float]]:
    skip = ORDER - 1
    pieces = []  # long texts in pieces that overlap by a context
    for number, text in enumerate(block):
        for start in range(0, max(len(text) - skip, 0), BLOCK):
            pieces.append((number, text[start : start + BLOCK + skip]))
    sums = np.zeros((len(block), len(model.languages)))
    squares = np.zeros_like(sums)
    counts = np.zeros(len(block), "int64")
    group: list[tuple[int, str]] = []

    def add() -> None:
        codes = codes_of("".join(piece for _, piece in group))
        each = model.char_scores(codes).astype("float64")
        ends = np.cumsum([len(piece) for _, piece in group])
        for (number, piece), end in zip(group, ends, strict=True):
            own = each[end - len(piece) + skip : end]
            sums[number] += own.sum(0)
            squares[number] += np.square(own).sum(0)
            counts[number] += len(own)

    size = 0
    for piece in pieces:
        group.append(piece)
        size += len(piece[1])
        if size >= BLOCK:
            add()
            group, size = [], 0
    if group:
        add()
    for n, total, square in zip(counts.tolist(), sums, squares, strict=True):
        entropy = -total / n if n else total
        best = int(entropy.argmin()) if n else 0
        yield n, entropy, float(np.sqrt(max(square[best] / n - entropy[best] ** 2, 0.0))) if n else 0.0


def is_held_out(doc_id: Column | str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from (doc_id, text, lang) rows; about ``per_language`` rows of each language are used, chosen by a hash of the id."""
    usable = labelled.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {row["lang"]: row["count"] for row in usable.groupBy("lang").count().collect()}  # one row per language
    if not sizes:
        return Model([], np.empty(0, "float32"), {}, {}, {})
    draw = F.pmod(F.xxhash64("doc_id", F.lit("draw")), F.lit(1_000_000))
    wanted = F.lit(False)
    for language, size in sizes.items():
        wanted = wanted | ((F.col("lang") == language) & (draw < F.lit(int(1_000_000 * min(1.0, per_language / size)))))
    calibrates = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(5)) == 0
    sample = stored(usable.filter(wanted).select("text", "lang", calibrates.alias("calibrates")), "language-sample")

    def gram_counts(batches: Iterator) -> Iterator:
        import pandas as pd

        for rows in batches:
            for language, texts in rows.groupby("lang")["text"]:
                found: Counter = Counter()
                for text in texts:
                    line = plain(text)
                    found.update([line[i : i + ORDER] for i in range(len(line) - ORDER + 1)])
                if found:
                    yield pd.DataFrame({"lang": language, "gram": list(found), "n": list(found.values())})

    counted = sample.filter(~F.col("calibrates")).select("text", "lang").mapInPandas(gram_counts, "lang string, gram string, n long")
    counts: dict[str, dict[str, int]] = {}
    for row in counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toLocalIterator():  # bounded by the sample
        counts.setdefault(row["lang"], {})[row["gram"]] = row["n"]
    if not counts:
        return Model([], np.empty(0, "float32"), {}, {}, {})
    model = build(counts)
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def entropies(batches: Iterator) -> Iterator:
        import pandas as pd

        for rows in batches:
            found = list(scored(rows["text"].tolist(), shared.value))
            places = [shared.value.languages.index(x) if x in shared.value.languages else -1 for x in rows["lang"]]
            own = [h[k] if k >= 0 and n else None for (n, h, _), k in zip(found, places, strict=True)]
            counts, spreads = [n for n, _, _ in found], [s for _, _, s in found]
            yield pd.DataFrame({"lang": rows["lang"], "n": counts, "entropy": pd.array(own, "Float64"), "spread": spreads})

    def limits(texts: DataFrame) -> dict[str | None, tuple[float, float, float]]:
        """Weighted mean and deviation per language, and under None of all; what the spread of characters explains is no deviation."""
        shown = texts.select("text", "lang").mapInPandas(entropies, "lang string, n long, entropy double, spread double")
        shown = shown.filter("entropy IS NOT NULL").withColumn("w", F.col("n") / (F.col("n") + SETTLED))
        mean = lambda what: F.sum(F.col("w") * what) / F.sum("w")
        h, s = F.col("entropy"), mean(F.col("spread"))
        explained = s * s * mean(1 / F.col("n"))
        deviation = F.sqrt(F.greatest(mean(h * h) - mean(h) * mean(h) - explained, F.lit(0.0)))
        found = shown.rollup("lang").agg(mean(h).alias("m"), deviation.alias("d"), s.alias("s"), F.grouping("lang").alias("all"))
        return {None if row["all"] else row["lang"]: (row["m"], row["d"], row["s"]) for row in found.collect() if row["m"] is not None}

    model.limits = limits(sample.filter("calibrates")) or limits(sample)
    return model


def limit(model: Model, language: str, characters: int) -> float:
    """The cross-entropy above which a text of that many characters is rejected: six deviations and a half nat beyond the mean."""
    mean, deviation, spread = model.limits.get(language) or model.limits[None]
    return mean + 0.5 + 6 * deviation + 6 * spread / characters**0.5


def identify(docs: DataFrame, model: Model, passing: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, lang_pred, score, cross_entropy, rejected) of every (doc_id, text) row, and the columns to pass on."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        keep_only("language_id")
        model = shared.value
        for rows in batches:
            names, scores, lowest, rejected = [], [], [], []
            texts = rows.column(1).to_pylist()
            for n, entropy, _ in scored(texts, model) if model.languages else ((len(plain(text)), None, 0.0) for text in texts):
                if not n or entropy is None:
                    names.append("und"), scores.append(0.0), lowest.append(None), rejected.append(not n)
                    continue
                best = int(entropy.argmin())
                share = np.exp(-np.minimum((entropy - entropy[best]) * min(n, EVIDENCE), 700.0))
                names.append(model.languages[best])
                scores.append(float(1.0 / share.sum()))
                lowest.append(float(entropy[best]))
                rejected.append(bool(entropy[best] > limit(model, names[-1], n)))
            columns = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(lowest, pa.float64()), pa.array(rejected, pa.bool_())]
            given = [rows.column(0), *rows.columns[2:]]
            yield pa.RecordBatch.from_arrays([*given, *columns], ["doc_id", *passing, "lang_pred", "score", "cross_entropy", "rejected"])

    given = docs.select("doc_id", F.col("text").alias("_text"), *passing)
    schema = T.StructType([field for field in given.schema if field.name != "_text"])
    for name, kind in (("lang_pred", "string"), ("score", "double"), ("cross_entropy", "double"), ("rejected", "boolean")):
        schema = schema.add(name, kind)
    return given.mapInArrow(run, schema)
