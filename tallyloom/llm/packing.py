"""Packing of token ids into sequences by Karmarkar-Karp multiway differencing.

A document's ids are cut into whole sequences and smaller pieces. Each task gathers pieces into batches and splits every
batch into windows of nearly equal size: partial partitions are merged so that the largest window of one meets the smallest
of the other, those with the largest imbalance first. The number of windows starts at the least that could hold the batch
and rises whenever a window exceeds the capacity. No shuffle is needed; a task holds one batch at a time.

Nulls and empty texts give the end id alone. A very long text fills whole sequences one after the other. Rows without an id and
repeated rows are packed like any other, each by itself, and ties of size go by the order of pieces. An empty table gives no rows.
Every other column of the input is left out, so no name can clash.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame

from tallyloom.llm.encoding import encoder

CAPACITY = 2048
PIECE = 512  # a rest of a document longer than this is cut further, so that windows can be balanced
BATCH = 600  # pieces that are balanced together
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Split items into ``windows`` lists of item numbers with nearly equal sums.

    A partial partition is a list of (sum, items), largest first, without its empty windows.
    """
    heap: list[tuple[int, int, list[tuple[int, list[int]]]]] = []
    for number, size in enumerate(sizes):
        heap.append((-size, number, [(size, [number])]))
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        _, _, left = heapq.heappop(heap)
        _, _, right = heapq.heappop(heap)
        merged = _opposed(left, right, windows)
        spread = merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)
        heapq.heappush(heap, (-spread, made, merged))
        made += 1
    final = [items for _, items in heap[0][2]] if heap else []
    return final + [[] for _ in range(windows - len(final))]


def _opposed(left: list, right: list, windows: int) -> list:
    """Merge two partial partitions, the largest windows of one with the smallest of the other."""
    free = windows - len(left)
    if len(right) <= free:  # every window of the right one meets an empty window
        merged = left + right
    else:
        kept, meeting = right[:free], right[free:]  # largest of the right one into empty windows
        short = len(meeting)
        untouched, joined = left[: len(left) - short], left[len(left) - short :]
        merged = untouched + kept
        merged += [(a + b, x + y) for (a, x), (b, y) in zip(joined, reversed(meeting), strict=True)]
    merged.sort(key=lambda window: -window[0])
    return merged


def balanced(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``: as few as the sum allows, and one more whenever one is exceeded."""
    windows = math.ceil(sum(sizes) / capacity)
    while windows:
        found = differencing(sizes, windows)
        if max(sum(sizes[item] for item in items) for items in found) <= capacity:
            return [items for items in found if items]
        windows += 1
    return []


def cuts(length: int, capacity: int, piece: int) -> list[int]:
    """Lengths of a document's pieces: whole sequences first, then equal shares of the rest."""
    whole, rest = divmod(length, capacity)
    shares = math.ceil(rest / piece)
    return [capacity] * whole + [rest * (i + 1) // shares - rest * i // shares for i in range(shares)]


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = CAPACITY,
    piece: int = PIECE,
    batch: int = BATCH,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: where it comes from, its checksum, its sequence and its place there, and its ids if wanted.

    ``docs`` has doc_id and text. Sequence ids hold the number of the task in their upper bits.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encode = encoder(tokenizer)
        end = np.uint32(end_id).astype("<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 40
        small: list[tuple] = []

        def frame(rows: list[tuple]) -> pa.RecordBatch:
            names = SCHEMA.replace(" long", "").split(", ")
            columns = [pa.array([row[i] for row in rows], pa.int64()) for i in range(7)]
            if with_ids:
                columns.append(pa.array([np.frombuffer(row[7], "<i4") for row in rows], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)

        def windows(pieces: list[tuple]) -> list[tuple]:
            nonlocal sequence
            rows = []
            for items in balanced([one[2] for one in pieces], capacity):
                offset = 0
                for item in items:
                    doc, start, length, crc, tokens, ids = pieces[item]
                    rows.append((doc, start, length, crc, tokens, sequence, offset, ids))
                    offset += length
                sequence += 1
            return rows

        for rows in batches:
            full: list[tuple] = []
            for doc, text in zip(rows.column(0).to_pylist(), rows.column(1), strict=True):
                ids = encode.pack(text.as_py()) + end
                tokens, start = len(ids) // 4, 0
                for length in cuts(tokens, capacity, piece):
                    part = ids[4 * start : 4 * (start + length)]
                    one = (doc, start, length, zlib.crc32(part), tokens)
                    if length == capacity:
                        full.append((*one, sequence, 0, part if with_ids else None))
                        sequence += 1
                    else:
                        small.append((*one, part if with_ids else None))
                    start += length
                if len(small) >= batch:
                    full += windows(small)
                    small = []
                if len(full) >= 2000:
                    yield frame(full)
                    full = []
            if full:
                yield frame(full)
        if small:
            yield frame(windows(small))

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA + ", ids array<int>" * with_ids)
