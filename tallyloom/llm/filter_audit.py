"""How filters interact: every order of a set of filters, from one decision diagram per part of the corpus.

Each document's failures are one bit mask, found once in plain columns. Documents are counted by part, mask and label, and a
part's few counts become a decision diagram: one level per filter, an edge for passing and one for failing, equal nodes shared,
and leaves that hold counts. Every node carries the sums below it. In any order of the levels the all-pass path tells the
steps: what a node's fail edge holds is removed there, what its pass edge holds is kept. The diagram is brought from one order
to the next by swapping two adjacent levels, which touches the nodes of these two levels only; a walk through all orders by
adjacent swaps visits each once.

Texts stay in the scan: the shuffles move ids, digests, masks and counts. Whether an earlier document has the same text is
asked with (digest, least id) as join key, so thousands of copies of one text do not meet in a task; rows are counted before
they are dealt by part, so a part's task gets at most a row per mask and label. The number of parts is not bounded.

A null text is empty and fails the word count. A null part is the empty one. A row without an id counts as a copy of a row with
an id, never of another without; rows that repeat an id and a text are not copies of each other. Labels of one id that differ
count as good (toxic) if any is. Empty tables give no rows. Extra columns are left out before anything is joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
FILTERS = "ABCDE"
STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)
NOTHING = (0, 0, 0)  # documents, good ones, toxic ones


def failures() -> list[Column]:
    """Failure of the filters A to D over the measured columns."""
    return [
        F.col("n_words") < 200,
        F.col("n_distinct") * 100 < F.col("n_words") * 50,
        F.col("n_capitals") * 100 > F.col("n_points") * 2,
        F.col("has_symbol"),
    ]


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, bits) of (doc_id, text, source) rows; the bits are those of A to D."""
    text = F.coalesce("text", F.lit(""))
    words = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("source", F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.array_remove(F.split(text, SPACE), "").alias("words"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.char_length(text).cast("long").alias("n_points"),
        text.rlike("[#$%&*|]").alias("has_symbol"),
    )
    counted = words.select(
        "doc_id", "part", "digest", "n_capitals", "n_points", "has_symbol",
        F.size("words").cast("long").alias("n_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
    )
    bits = [F.when(failed, F.lit(1 << place)).otherwise(F.lit(0)) for place, failed in enumerate(failures())]
    return counted.select("doc_id", "part", "digest", sum(bits[1:], bits[0]).alias("bits"))


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, part, mask, good, toxic) per document: all failures as one mask, and its labels."""
    found = measured(docs)
    first = found.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    first = first.withColumnsRenamed({"digest": "first_digest", "doc_id": "first_id"})
    same = (F.col("digest") == F.col("first_digest")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    copy = F.when(F.col("is_first").isNull(), F.lit(1 << 4)).otherwise(F.lit(0))
    marked = found.join(first, same, "left").select(
        "doc_id", "part", F.col("bits").bitwiseOR(copy).alias("mask"),
        # rows without an id have no label; they are dealt by their text, not all to one task
        F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0)).alias("spread"),
    )
    truth = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"),
    ).withColumn("label_spread", F.lit(0).cast("long"))
    labelled = marked.join(truth, (F.col("doc_id") == F.col("label_id")) & (F.col("spread") == F.col("label_spread")), "left")
    return labelled.select("doc_id", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def by_adjacent_swaps(n: int) -> Iterator[int]:
    """Places to swap with their right neighbour, one after the other, so that all orders of ``n`` things come by once."""
    if n < 2:
        return
    down, up = list(range(n - 2, -1, -1)), list(range(n - 1))
    inner = by_adjacent_swaps(n - 1)
    while True:  # the last thing walks through the others; at either end those make one swap of their own
        yield from down
        place = next(inner, None)
        if place is None:
            return
        yield place + 1 if down[0] > 0 else place  # others stand behind it after a walk down
        down, up = up, down


class Diagram:
    """A decision diagram with shared nodes: ``nodes[i]`` is (pass, fail, sums); leaves have no children."""

    def __init__(self, order: str, counts: dict[int, tuple[int, int, int]]):
        self.order, self.nodes, self.known = list(order), [], {}
        level = [self.leaf(counts.get(mask, NOTHING)) for mask in range(1 << len(order))]
        for _ in order:  # the highest bit is the lowest level
            half = len(level) // 2
            level = [self.node(level[i], level[i + half]) for i in range(half)]
        self.root = level[0]

    def leaf(self, sums: tuple[int, int, int]) -> int:
        return self._shared((None, None, sums))

    def node(self, passed: int, failed: int) -> int:
        sums = tuple(a + b for a, b in zip(self.nodes[passed][2], self.nodes[failed][2]))
        return self._shared((passed, failed, sums))

    def _shared(self, entry: tuple) -> int:
        if entry not in self.known:
            self.known[entry] = len(self.nodes)
            self.nodes.append(entry)
        return self.known[entry]

    def swap(self, place: int) -> None:
        """Exchange the levels ``place`` and ``place + 1``; the nodes below stay, those above are hung on the new ones."""
        done: dict[int, int] = {}

        def hung(node: int, above: int) -> int:
            if node not in done:
                passed, failed, _ = self.nodes[node]
                if above:
                    done[node] = self.node(hung(passed, above - 1), hung(failed, above - 1))
                else:
                    (pp, pf, _), (fp, ff, _) = self.nodes[passed], self.nodes[failed]
                    done[node] = self.node(self.node(pp, fp), self.node(pf, ff))
            return done[node]

        self.root = hung(self.root, place)
        self.order[place], self.order[place + 1] = self.order[place + 1], self.order[place]

    def path(self) -> Iterator[tuple[str, tuple, tuple]]:
        """Filter, sums kept and sums removed, down the all-pass path."""
        node = self.root
        for name in self.order:
            passed, failed, _ = self.nodes[node]
            yield name, self.nodes[passed][2], self.nodes[failed][2]
            node = passed


def all_orders(names: str, counts: dict[int, tuple[int, int, int]]) -> Iterator[tuple]:
    """A row per order and step, for one part's counts by failure mask."""
    diagram = Diagram(names, counts)
    found = {"".join(diagram.order): list(diagram.path())}
    for place in by_adjacent_swaps(len(names)):
        diagram.swap(place)
        found["".join(diagram.order)] = list(diagram.path())
    # A filter that comes first removes all that fail it, one that comes last those that fail nothing else.
    failing = {path[0][0]: path[0][2][0] for path in found.values()}
    unique = {path[-1][0]: path[-1][2][0] for path in found.values()}
    shapley = dict.fromkeys(names, 0)
    for path in found.values():
        for name, _, removed in path:
            shapley[name] += removed[0]
    for order in map("".join, permutations(names)):
        for step, (name, kept, removed) in enumerate(found[order], 1):
            yield (order, step, kept[0], removed[0], failing[name] - removed[0], unique[name], removed[1], removed[2], shapley[name])


def audit(marked: DataFrame) -> DataFrame:
    """All orders and steps per part, from (part, mask, good, toxic) rows."""
    counts = marked.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").cast("long").alias("n_good"), F.sum("toxic").cast("long").alias("n_toxic")
    )

    def run(key, rows):
        import pandas as pd

        given = {int(r.mask): (int(r.n), int(r.n_good), int(r.n_toxic)) for r in rows.itertuples()}
        names = [field.split()[0] for field in STEPS.split(", ")]
        return pd.DataFrame([(key[0], *row) for row in all_orders(FILTERS, given)], columns=names)

    return counts.groupBy("part").applyInPandas(run, STEPS)
