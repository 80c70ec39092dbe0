"""Fill-in-the-middle transformation by repeated-capture matching.

A text is a row of units, here lines. One ``regex`` full match of ``(unit)*`` keeps every repetition of its group: the ends of
the captures are the places between units, so their number and both cut offsets are read off one match and no line is visited.
Which places are cut, and the form of the output, come from a digest of the document's id, so a repeated task repeats them.

The plain form is the text itself; ``psm`` puts prefix, suffix and middle behind their marks, ``spm`` suffix, prefix and middle.
A text that holds a mark stays plain, so marks in an output are always the transformation's own, and ``restored`` rebuilds the
exact text from output and form alone. Nothing is shuffled and no row meets another.

A null or empty text has no units and gives a plain empty output. Very long texts are matched whole; the ends of their units are
held in memory, one text at a time. Rows without an id are cut by the digest of an empty id; rows that repeat an id are cut
alike. Empty tables give empty results; columns other than doc_id and text are left out, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINES = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
OUTPUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit numbers of a document."""
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def transform(docs: DataFrame, seed: int = 7, percent: int = 100, spm_percent: int = 50, unit: str = LINES) -> DataFrame:
    """The outputs of (doc_id, text) rows: ``percent`` of the texts in a changed form, ``spm_percent`` of those in ``spm``.

    ``unit`` is a regular expression that matches some characters and whose repetitions cover every text.
    """

    def changed(doc_id: int | None, text: str, units) -> tuple:
        ends = units.fullmatch(text).ends(1)
        n = len(ends)
        first, second, keep, kind = draws(doc_id, seed)
        if not n or any(mark in text for mark in MARKS) or keep % 100 >= percent:
            return doc_id, n, "plain", None, None, text
        low, high = (ends[cut - 1] if cut else 0 for cut in sorted((first % (n + 1), second % (n + 1))))
        prefix, middle, suffix = text[:low], text[low:high], text[high:]
        if kind % 100 < spm_percent:
            return doc_id, n, "spm", low, high - low, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
        return doc_id, n, "psm", low, high - low, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import regex

        units = regex.compile(f"({unit})*")
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.large_string())
        names = [field.split()[0] for field in OUTPUT.split(", ")]
        for rows in batches:
            done = [changed(doc.as_py(), text.as_py(), units) for doc, text in zip(rows.column(0), rows.column(1))]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*done), kinds)] if done else [pa.array([], kind) for kind in kinds]
            columns[-1] = columns[-1].cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, OUTPUT)


def restored(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text behind an output: its pieces between the marks, put back in order."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    piece = lambda i: F.get(F.split(output, "<[PSM]>", -1), F.lit(i))  # noqa: E731  the first piece is the empty one before a mark
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(piece(1), piece(3), piece(2)))
        .when(form == "spm", F.concat(piece(2), piece(3), piece(1)))
    )


def digests(outputs: DataFrame) -> DataFrame:
    """Digests of every output and of the text rebuilt from it, in place of the texts."""
    return outputs.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"),
    )
