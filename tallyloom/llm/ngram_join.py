"""N-gram Jaccard self-join with a prefix tree, and the groups its links make.

A document's set holds its distinct word n-grams. Two documents link if the shared n-grams are at least a given share of all.
Sets are ordered by one global order, rare n-grams first: sets that link must then share an n-gram among the first few of
both, the prefix. An n-gram that only one set has links nothing, so a set whose prefix holds only such is left out.

1. Documents with equal sets are one class from here on, a node of its own led by the least id; only class leaders are looked
   at. An id may lead several classes.
2. Each part of the texts sends the hashes of its n-grams, packed and counted, and learns which occur in several sets, and in
   how many. It sends on the sets whose prefix holds such n-grams: their shared n-grams in global order.
3. Sets that are joined, directly or through others, by n-grams in their prefixes form a cluster. No link crosses clusters.
   The clusters are found from pairs of a set and the least set with the same n-gram, by label propagation with pointer
   jumping.
4. Each cluster is joined in a prefix tree: sets lie in it in global order, sharing the nodes of what they begin with. A set
   is looked up by walking the tree; each node adds to the overlap of all sets below, and a subtree is left as soon as its
   remaining length, or the set's, cannot bring the overlap to what the sizes ask. Sets already known to be in one group are
   skipped. A large cluster is cut into blocks of a set number, and every two blocks meet in a task.
5. The groups of step 4, as pairs of a set and the least of its group, are merged; every document gets the least id of its group.
   Nodes are ordered by id first, so the least node has the least id.

Hashes have 64 bits; two n-grams with one hash are taken as one (under one chance in a million within ten million distinct
n-grams). Null and empty texts have empty sets and link with nothing. Rows are told apart by id and text: different texts under
one id, or without an id, link on their own. No id comes last. An empty table gives no rows. Columns other than doc_id and text
are left out.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import part_count, stored, text_hash
from tallyloom.llm.suffix_dedup import PrefixHashes, mixed

WORDS = 3
PERCENT = 90
BLOCK = 4096  # sets of one cluster that meet in a task at a time
TEXT_BLOCK = 1 << 20  # bytes hashed at once
NO_DOC = np.iinfo("int64").max
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(data: bytes) -> np.ndarray:
    """Hashes of the words of a text, A-Z in lower case; long texts are cut at spaces."""
    found = []
    begin = 0
    lower = data.lower()  # of bytes: A-Z only
    while begin < len(lower):
        end = min(begin + TEXT_BLOCK, len(lower))
        while end < len(lower) and not SPACE[lower[end]]:
            end += 1
        piece = np.frombuffer(lower, "uint8", end - begin, begin)
        space = np.concatenate([[True], SPACE[piece], [True]])
        edges = np.flatnonzero(space[1:] != space[:-1])
        starts, ends = edges[0::2], edges[1::2]
        lengths = ends - starts
        found.append(mixed(PrefixHashes(piece).of(starts, lengths) + lengths.astype("uint64")))
        begin = end
    return np.concatenate(found) if found else np.empty(0, "uint64")


def ngram_set(data: bytes, words: int) -> np.ndarray:
    """Sorted hashes of the distinct n-grams; a shorter text is one n-gram."""
    hashes = word_hashes(data)
    if not len(hashes):
        return hashes
    size = min(words, len(hashes))
    gram = np.full(len(hashes) - size + 1, size, "uint64")
    for i in range(size):
        gram = mixed(gram * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(gram)])
    return np.unique(gram)


def least_overlap(a: int, b: int, percent: int) -> int:
    """The least number of shared n-grams with which sets of these sizes link."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def set_digests(docs: DataFrame, words: int) -> DataFrame:
    """(doc, text_hash, n_shingles, digest) of (doc, text, text_hash) rows."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for rows in batches:
            sets = [ngram_set((text.as_py() or "").encode("utf-8", "surrogatepass"), words) for text in rows.column(1)]
            digests = [_digest(one) for one in sets]
            columns = [rows.column(0), rows.column(2), pa.array([len(one) for one in sets], pa.int64()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "text_hash", "n_shingles", "digest"])

    return docs.select("doc", "text", "text_hash").mapInArrow(run, "doc long, text_hash long, n_shingles long, digest binary")


def _digest(one: np.ndarray) -> bytes:
    return hashlib.blake2b(one.tobytes(), digest_size=16).digest()


def _leaders(rows: pd.DataFrame, leaders: pd.DataFrame, words: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(doc, node, set) of the part's class leaders; repeated rows count once."""
    wanted: dict[tuple[int, int], dict[bytes, int]] = {}
    for doc, text_hash, digest, node in zip(*(leaders[name] for name in ("doc", "text_hash", "digest", "node")), strict=True):
        wanted.setdefault((doc, text_hash), {})[bytes(digest)] = int(node)
    for doc, text_hash, text in zip(rows["doc"].tolist(), rows["text_hash"].tolist(), rows["text"], strict=True):
        nodes = wanted.get((doc, text_hash))
        if nodes:
            one = ngram_set((text or "").encode("utf-8", "surrogatepass"), words)
            node = nodes.pop(_digest(one), None)
            if node is not None:
                yield doc, node, one


def _short(keys: np.ndarray, buckets: int) -> np.ndarray:
    """48 bits of hashes within a bucket."""
    return (keys // np.uint64(buckets)) & np.uint64((1 << 48) - 1)


def _pack(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.view("uint8").reshape(-1, 8)[:, :6]).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), "uint8")
    wide[:, :6] = np.frombuffer(data, "uint8").reshape(-1, 6)
    return wide.view("uint64").ravel()


def _send_counts(rows: pd.DataFrame, leaders: pd.DataFrame, buckets: int, words: int) -> pd.DataFrame:
    """The part's distinct n-grams by bucket, with the number of sets that hold each."""
    names = ["bucket", "part", "keys", "counts"]
    sets = [one for _, _, one in _leaders(rows, leaders, words)]
    if not sets:
        return pd.DataFrame({name: [] for name in names})
    keys, counts = np.unique(np.concatenate(sets), return_counts=True)
    bucket, rest = (keys % np.uint64(buckets)).astype("int64"), _short(keys, buckets)
    order = np.lexsort((rest, bucket))
    bucket, rest, counts = bucket[order], rest[order], counts[order]
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    part = int(rows["part"].iloc[0])
    out = []
    for a, b in zip(cuts, [*cuts[1:], len(rest)], strict=True):
        more = counts[a:b] > 1  # most n-grams occur once: places and counts of the others follow
        several = np.stack([np.flatnonzero(more), counts[a:b][more]], 1).astype("int32")
        out.append((int(bucket[a]), part, _pack(rest[a:b]), several.tobytes()))
    return pd.DataFrame(out, columns=names)


def _shared(rows: pd.DataFrame) -> pd.DataFrame:
    """Answer each part which of its n-grams of this bucket several sets hold, and how many do."""
    lists = [_unpack(one) for one in rows["keys"]]
    weights = []
    for one, several in zip(lists, rows["counts"], strict=True):
        weight = np.ones(len(one), "int64")
        places = np.frombuffer(several, "int32").reshape(-1, 2)
        weight[places[:, 0]] = places[:, 1]
        weights.append(weight)
    keys, weight = np.concatenate(lists), np.concatenate(weights)
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))
    total = np.add.reduceat(weight[order], first)
    known, total = keys[order][first][total > 1], total[total > 1]
    bucket, out = int(rows["bucket"].iloc[0]), []
    for part, one in zip(rows["part"], lists, strict=True):
        if len(known):
            at = np.minimum(np.searchsorted(known, one), len(known) - 1)
            hit = known[at] == one
            if hit.any():
                out.append((int(part), bucket, _pack(one[hit]), np.minimum(total[at[hit]], 2**31 - 1).astype("int32").tobytes()))
    return pd.DataFrame(out, columns=["to_part", "bucket", "keys", "counts"])


def _send_sets(rows: pd.DataFrame, messages: pd.DataFrame, buckets: int, words: int, percent: int) -> pd.DataFrame:
    """Sets with a shared n-gram in their prefix: size, number of shared n-grams in the prefix, the shared ones in order."""
    lists = messages[messages["bucket"] >= 0]
    leaders = messages[messages["bucket"] < 0]
    keys = [_unpack(k) * np.uint64(buckets) + np.uint64(b) for k, b in zip(lists["keys"], lists["bucket"], strict=True)]
    names = ["doc", "node", "size", "in_prefix", "grams", "counts"]
    if not keys:
        return pd.DataFrame({name: [] for name in names})
    known = np.concatenate(keys)
    total = np.concatenate([np.frombuffer(c, "int32") for c in lists["counts"]])
    order = np.argsort(known)
    known, total = known[order], total[order]
    out = []
    for doc, node, one in _leaders(rows, leaders, words):
        if not len(one):
            continue
        wanted = _short(one, buckets) * np.uint64(buckets) + one % np.uint64(buckets)
        at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        hit = known[at] == wanted
        own = len(one) - int(hit.sum())  # n-grams of this set alone come first
        prefix = prefix_length(len(one), percent) - own
        if prefix <= 0 or not hit.any():
            continue
        grams, counts = wanted[hit], total[at[hit]]
        by = np.lexsort((grams, counts))
        out.append((doc, node, len(one), min(prefix, len(by)), grams[by].tobytes(), counts[by].astype("int32").tobytes()))
    return pd.DataFrame(out, columns=names)


def least_reachable(edges: DataFrame) -> DataFrame:
    """(node, least) from (node, other) pairs: the least node each one reaches, over as many rounds as labels still change.

    Every round takes the least label among neighbours and then the label of that label. Rounds are written to the shared
    folder, so a lost executor costs one round.
    """
    both = edges.select("node", "other").union(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    both = stored(both.filter("node <> other").distinct(), "edges")
    labels = both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("least"))
    labels = stored(labels, "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("other"), F.col("least").alias("near")), "other")
        around = around.groupBy("node").agg(F.min("near").alias("near"))
        next_labels = labels.join(around, "node").select("node", "least", F.least("least", "near").alias("nearer"))
        jump = labels.select(F.col("node").alias("nearer"), F.col("least").alias("jumped"))
        next_labels = next_labels.join(jump, "nearer").select("node", F.least("nearer", "jumped").alias("next"), "least")
        next_labels = stored(next_labels, "labels")
        changed = next_labels.filter("next <> least").limit(1).count()
        labels = next_labels.select("node", F.col("next").alias("least"))
        if not changed:
            return labels


class Node:
    """A node of the prefix tree: a run of n-grams that all sets below it share at this place."""

    __slots__ = ("children", "ends", "least_size", "most_left", "one", "run", "run_set")

    def __init__(self, run: list[int]):
        self.run, self.run_set = run, frozenset(run)
        self.children: dict[int, Node] = {}
        self.ends: list[int] = []  # sets that end here
        self.least_size, self.most_left = 1 << 62, 0  # least size of a set below, most n-grams below this node
        self.one = -1  # a set of the group that all sets below are in, if that is known


class PrefixTree:
    """Sets in global order, joined one by one with those put in before."""

    REVIEW = 64  # sets put in before nodes are reviewed for having one group below

    def __init__(self, percent: int):
        self.root, self.percent = Node([]), percent
        self.sizes: list[int] = []
        self.group: list[int] = []  # of each set, towards the least of its group
        self.new = 0

    def find(self, place: int) -> int:
        while self.group[place] != place:
            self.group[place] = self.group[self.group[place]]
            place = self.group[place]
        return place

    def add(self, size: int) -> int:
        self.sizes.append(size)
        self.group.append(len(self.group))
        return len(self.group) - 1

    def insert(self, grams: list[int], size: int) -> int:
        place, node, at = self.add(size), self.root, 0
        self._pass(node, size, len(grams))
        while at < len(grams):
            child = node.children.get(grams[at])
            if child is None:
                child = node.children[grams[at]] = Node(grams[at:])
                at = len(grams)
            else:
                run, same = child.run, 1
                while same < len(run) and at + same < len(grams) and run[same] == grams[at + same]:
                    same += 1
                if same < len(run):  # part the run
                    upper = Node(run[:same])
                    upper.least_size, upper.most_left = child.least_size, child.most_left + len(run) - same
                    child.run, child.run_set = run[same:], frozenset(run[same:])
                    upper.children[child.run[0]] = child
                    child = node.children[grams[at]] = upper
                at += same
            node = child
            self._pass(node, size, len(grams) - at)
        node.ends.append(place)
        self.new += 1
        if self.new >= self.REVIEW:
            self._review()
        return place

    def _pass(self, node: Node, size: int, left: int) -> None:
        node.least_size, node.most_left = min(node.least_size, size), max(node.most_left, left)
        node.one = -1

    def _review(self) -> None:
        """Note for every node whether the sets below are in one group."""
        self.new = 0
        below: list[Node] = []
        todo = [self.root]
        while todo:
            node = todo.pop()
            below.append(node)
            todo += node.children.values()
        for node in reversed(below):
            ones = [*node.ends, *(child.one for child in node.children.values())]
            groups = {self.find(one) if one >= 0 else -1 for one in ones}
            node.one = ones[0] if len(groups) == 1 and ones[0] >= 0 else -1

    def link(self, place: int, grams: list[int], size: int) -> None:
        """Join a set, itself put in or not, with the groups of all sets that it links with."""
        own = frozenset(grams)
        least = -(-self.percent * size // 100)
        todo: list[tuple[Node, int]] = [(self.root, 0)]
        while todo:
            node, overlap = todo.pop()
            if node.one >= 0 and self.find(node.one) == self.find(place):
                continue
            for other in node.ends:
                if other != place and 100 * overlap >= self.percent * (size + self.sizes[other] - overlap):
                    a, b = self.find(place), self.find(other)
                    self.group[max(a, b)] = min(a, b)
            for child in node.children.values():
                more = overlap + len(own & child.run_set)
                left = min(child.most_left, len(grams) - bisect_right(grams, child.run[-1]))
                if more + left >= least_overlap(size, max(child.least_size, least), self.percent):
                    todo.append((child, more))


def join_block(left: list[tuple[tuple, int, list[int]]], right: list[tuple[tuple, int, list[int]]], percent: int) -> list[tuple[tuple, tuple]]:
    """Groups by the links within ``left``, or between ``left`` and ``right``, of (node, size, grams in global order).

    A node is (doc, number of the class). Groups come as pairs of a node and the least one of its group.
    """
    tree = PrefixTree(percent)
    for _, size, grams in left:
        place = tree.insert(grams, size)
        if not right:
            tree.link(place, grams, size)
    for _, size, grams in right:
        tree.link(tree.add(size), grams, size)
    nodes = [node for node, _, _ in [*left, *right]]
    least: dict[int, tuple] = {}
    for place, node in enumerate(nodes):
        root = tree.find(place)
        least[root] = min(least.get(root, node), node)
    pairs = [(node, least[tree.find(place)]) for place, node in enumerate(nodes)]
    return [(node, first) for node, first in pairs if node != first]


def _join(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Groups among the sets of one task: one block of a cluster, or two."""
    grams = [np.frombuffer(one, "uint64") for one in rows["grams"]]
    counts = [np.frombuffer(one, "int32") for one in rows["counts"]]
    everything, where = np.unique(np.concatenate(grams), return_index=True)
    count = np.concatenate(counts)[where]
    rank = np.empty(len(everything), "int64")
    rank[np.lexsort((everything, count))] = np.arange(len(everything))  # the global order, as small numbers
    sets: dict[bool, list] = {False: [], True: []}
    nodes = zip(rows["doc"].tolist(), rows["node"].tolist(), strict=True)
    for node, size, one, second in zip(nodes, rows["size"].tolist(), grams, rows["second"].tolist(), strict=True):
        sets[second].append((node, size, rank[np.searchsorted(everything, one)].tolist()))
    for one in sets.values():
        one.sort(key=lambda x: (x[1], x[0]))
    links = join_block(sets[False], sets[True], percent)
    return pd.DataFrame([(*node, *first) for node, first in links], columns=["doc", "node", "other_doc", "other"])


def linked_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every (doc_id, text) row: the least id that links reach."""
    return _grouped(docs, words, percent, block).select(_or_null("doc").alias("doc_id"), "n_shingles", _or_null("component").alias("component_id"))


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """(doc_id, text_hash) of one text of each group, that of its least id; of texts without words, all."""
    return _grouped(docs, words, percent, block).filter("first").select(_or_null("doc").alias("doc_id"), "text_hash").distinct()


def _or_null(name: str) -> Column:
    return F.when(F.col(name) != NO_DOC, F.col(name))


def _grouped(docs: DataFrame, words: int, percent: int, block: int) -> DataFrame:
    """(doc, text_hash, n_shingles, component, first) of every row; ``first``: its text is the first of its group."""
    parts = part_count(docs)
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_DOC))
    docs = docs.select(doc.alias("doc"), "text", text_hash().alias("text_hash"))
    digests = stored(set_digests(docs, words), "set-digests")
    classes = digests.filter("n_shingles > 0").groupBy("digest").agg(F.min(F.struct("doc", "text_hash")).alias("leader"))
    part = F.pmod(F.xxhash64("doc", "text_hash"), F.lit(parts)).cast("int")  # texts without an id are dealt as well
    classes = classes.select("digest", "leader.*", F.monotonically_increasing_id().alias("node"))  # numbers hold once stored
    classes = stored(classes.withColumn("to_part", part), "classes")

    dealt = docs.withColumn("part", part)
    counted = (
        dealt.groupBy("part")
        .cogroup(classes.groupBy("to_part"))
        .applyInPandas(lambda rows, own: _send_counts(rows, own, parts, words), "bucket int, part int, keys binary, counts binary")
    )
    shared = counted.groupBy("bucket").applyInPandas(_shared, "to_part int, bucket int, keys binary, counts binary")
    messages = shared.unionByName(classes.withColumn("bucket", F.lit(-1)), allowMissingColumns=True)
    messages = messages.fillna(0, ["doc", "text_hash", "node"])  # pandas holds whole numbers with nulls as floats
    sets = (
        dealt.groupBy("part")
        .cogroup(messages.groupBy("to_part"))
        .applyInPandas(
            lambda rows, own: _send_sets(rows, own, parts, words, percent),
            "doc long, node long, size int, in_prefix int, grams binary, counts binary",
        )
    )
    sets = stored(sets, "sets")
    clusters = _clusters(sets)
    tasks = _tasks(sets, clusters, block)
    links = tasks.groupBy("cluster", "i", "j").applyInPandas(lambda rows: _join(rows, percent), "doc long, node long, other_doc long, other long")
    links = links.select(F.struct("doc", "node").alias("node"), F.struct(F.col("other_doc").alias("doc"), F.col("other").alias("node")).alias("other"))
    groups = least_reachable(links).select("node.node", F.col("least.doc").alias("component"), F.col("least.node").alias("of_node"))
    first = F.coalesce(F.col("of_node") == F.col("node"), F.lit(True))
    named = classes.join(groups, "node", "left").select(
        "digest", F.coalesce("component", "doc").alias("component"), F.when(first, F.struct("doc", "text_hash")).alias("first")
    )
    named = digests.join(named, "digest", "left")
    first = F.col("component").isNull() | F.coalesce(F.col("first") == F.struct("doc", "text_hash"), F.lit(False))
    return named.select("doc", "text_hash", "n_shingles", F.coalesce("component", "doc").alias("component"), first.alias("first"))


def _clusters(sets: DataFrame) -> DataFrame:
    """(node, cluster) of all sets that share an n-gram of their prefix with another."""

    def prefixes(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for rows in batches:
            grams = [np.frombuffer(g.as_py(), "int64")[: k.as_py()] for g, k in zip(rows.column(2), rows.column(1), strict=True)]
            nodes = np.repeat(rows.column(0).to_numpy(), [len(g) for g in grams])
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.concatenate(grams) if grams else nodes)], ["node", "gram"])

    placed = sets.select("node", "in_prefix", "grams").mapInArrow(prefixes, "node long, gram long")
    least = placed.groupBy("gram").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most")
    pairs = placed.join(least, "gram").filter("node <> least").select("node", F.col("least").alias("other")).distinct()
    return least_reachable(pairs).withColumnRenamed("least", "cluster")


def _tasks(sets: DataFrame, clusters: DataFrame, block: int) -> DataFrame:
    """Sets with the cluster's pairs of blocks they belong to; a cluster of one block is one task."""
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select(F.col("cluster").alias("of"), F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    placed = sets.join(clusters, "node").join(sizes, F.col("cluster") == F.col("of"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = placed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    i, j = F.least("own", "other"), F.greatest("own", "other")
    return placed.select("doc", "node", "size", "grams", "counts", "cluster", i.alias("i"), j.alias("j"), (F.col("own") > F.col("other")).alias("second"))
