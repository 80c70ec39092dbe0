"""Random forests grown inside one task from binned rows, as numpy arrays. Workers import this module alone, not the whole of Spark ML.

The trees are those that Spark's RandomForestClassifier grows on the same rows in one partition: same bins, bootstrap counts, sets of
predictors, order of nodes, ties and pruning. Spark keeps a histogram of every open node of every tree at once, writes each row into a
place far from the last one and shuffles the histograms after every level; here a tree's rows are counted predictor by predictor.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SAMPLED = 10000  # rows that Spark takes at least for the split candidates of a training set
HISTOGRAM_BYTES = 1 << 25
BLOCK = 1 << 16  # rows counted at once, so that what they need stays in a core's cache


@dataclass(frozen=True)
class Settings:
    """A forest to grow: ``width`` is the number of predictors tried at a split, ``columns`` are the predictors, None for all."""

    trees: int
    depth: int
    width: int
    seed: int
    least: int = 1
    gain: float = 0.0
    memory: int = 256 << 20
    columns: tuple[int, ...] | None = None


def thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """Split candidates of one predictor: between all neighbours if there are few values, else in strides of about equal numbers of rows."""
    found, counts = np.unique(values + 0.0, return_counts=True)  # -0.0 becomes 0.0
    middles = (found[:-1] + found[1:]) / 2.0
    if len(middles) <= bins - 1:
        return middles
    stride, passed = len(values) / bins, np.cumsum(counts).astype(float)
    kept, at, target = [], 1, stride
    while at < len(found):
        at = max(at, int(np.searchsorted(passed, target, "left")))
        while at < len(found) and not abs(passed[at - 1] - target) < abs(passed[at] - target):
            at += 1
        if at < len(found):
            kept.append(middles[at - 1])
            target += stride
            at += 1
    return np.array(kept)


def binned(values: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Number of candidates below each value, a column per predictor."""
    kind = np.uint8 if max((len(c) for c in cuts), default=0) < 256 else np.uint16
    return np.column_stack([np.searchsorted(c, values[:, f], "left").astype(kind) for f, c in enumerate(cuts)])


class _JavaRandom:
    """The sequence of java.util.Random's long integers, as unsigned ones."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def states(self, count: int) -> list[tuple[int, int]]:
        """The next numbers, each with the state that it leaves."""
        found, state = [], self.state
        for _ in range(count):
            parts = []
            for _ in range(2):
                state = (state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
                half = state >> 16
                parts.append(half - (1 << 32) if half >> 31 else half)
            found.append((((parts[0] << 32) + parts[1]) & ((1 << 64) - 1), state))
        return found


def _murmur(words: Sequence[np.ndarray], seed: np.ndarray) -> np.ndarray:
    h = seed.copy()
    for word in words:
        k = word * np.uint32(0xCC9E2D51)
        k = ((k << np.uint32(15)) | (k >> np.uint32(17))) * np.uint32(0x1B873593)
        h = h ^ k
        h = ((h << np.uint32(13)) | (h >> np.uint32(19))) * np.uint32(5) + np.uint32(0xE6546B64)
    h = h ^ np.uint32(8)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return h ^ (h >> np.uint32(16))


def subsets(numbers: Sequence[int], predictors: int, width: int) -> np.ndarray:
    """For each number the set of predictors that Spark's reservoir sampling draws with that seed, in its order."""
    seeds = np.array(numbers, dtype=np.uint64)
    words = [(seeds >> np.uint64(32)).astype(np.uint32).byteswap(), (seeds & np.uint64(0xFFFFFFFF)).astype(np.uint32).byteswap()]
    low = _murmur(words, np.full(len(seeds), 0x3C074A61, np.uint32))
    state = (_murmur(words, low).astype(np.uint64) << np.uint64(32)) | low.astype(np.uint64)

    def step() -> np.ndarray:
        nonlocal state
        state = state ^ (state << np.uint64(21))
        state = state ^ (state >> np.uint64(35))
        state = state ^ (state << np.uint64(4))
        return state

    chosen = np.tile(np.arange(width), (len(seeds), 1))
    for item in range(width, predictors):
        high = (step() & np.uint64((1 << 26) - 1)) << np.uint64(27)
        draw = (high + (step() & np.uint64((1 << 27) - 1))).astype(float) * 2.0**-53
        place = (draw * (item + 1)).astype(np.int64)
        hit = np.flatnonzero(place < width)
        chosen[hit, place[hit]] = item
    return chosen


def map_order(keys: Sequence[int]) -> list[int]:
    """The order in which a Scala map of these small whole numbers is walked through."""
    if len(keys) <= 4:
        return sorted(keys, key=lambda k: (k & 15, k))

    def improved(h: int) -> int:
        full = (1 << 32) - 1
        h = (h + (~(h << 9) & full)) & full
        h ^= h >> 14
        h = (h + (h << 4)) & full
        return h ^ (h >> 10)

    def walk(some: list[tuple[int, int]], shift: int) -> list[int]:
        places: dict[int, list[tuple[int, int]]] = {}
        for h, k in some:
            places.setdefault((h >> shift) & 31, []).append((h, k))
        alone = [places[p][0][1] for p in sorted(places) if len(places[p]) == 1]
        return alone + [k for p in sorted(places) if len(places[p]) > 1 for k in walk(places[p], shift + 5)]

    return walk([(improved(k), k) for k in keys], 0)


def _impurity(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Gini impurity over the second last axis, its classes taken out one by one; 0 for no rows."""
    found = np.ones_like(totals)
    for c in range(counts.shape[-2]):
        share = counts[..., c, :] / totals
        found -= share * share
    return np.where(totals == 0, 0.0, found)


class _Tree:
    """A growing tree: its nodes by number, children after their parents, and the rows that still lie in open nodes, with the times
    that they are drawn."""

    def __init__(self, counts: np.ndarray):
        self.rows = np.flatnonzero(counts).astype(np.int32)
        self.times = counts[self.rows]
        self.at = np.zeros(len(self.rows), np.int32)
        self.level, self.feature, self.cut, self.left, self.right, self.totals, self.open = [0], [-1], [0], [0], [0], [None], [True]

    def child(self, parent: int, totals: np.ndarray, opened: bool) -> int:
        new = (self.level[parent] + 1, -1, 0, 0, 0, totals, opened)
        for column, value in zip((self.level, self.feature, self.cut, self.left, self.right, self.totals, self.open), new):
            column.append(value)
        return len(self.level) - 1

    def pruned(self) -> None:
        """Leaves of one parent that predict the same become one, from the bottom up; then every node's shares of the classes."""
        for node in range(len(self.level) - 1, -1, -1):
            a, b = self.left[node], self.right[node]
            if self.feature[node] >= 0 and self.feature[a] < 0 and self.feature[b] < 0 and self.totals[a].argmax() == self.totals[b].argmax():
                self.feature[node] = -1
        self.feature, self.cut, self.left, self.right = (np.array(c) for c in (self.feature, self.cut, self.left, self.right))
        totals = np.array(self.totals)
        rows = totals.sum(1, keepdims=True)
        self.shares = np.divide(totals, rows, out=np.zeros_like(totals), where=rows != 0)

    def votes(self, columns: np.ndarray) -> np.ndarray:
        rows, node = np.arange(columns.shape[1]), np.zeros(columns.shape[1], np.int32)
        while len(rows):
            own = node[rows]
            rows = rows[self.feature[own] >= 0]
            own = node[rows]
            right = columns[self.feature[own], rows] > self.cut[own]
            node[rows] = np.where(right, self.right[own], self.left[own])
        return self.shares[node]


def _histograms(keys: np.ndarray, rows: np.ndarray, times: np.ndarray, slots: np.ndarray, nodes: int, chosen: np.ndarray | None, size: int) -> np.ndarray:
    """Drawn rows per predictor, node and key. The rows come node after node; some nodes, or a part of a large one, are counted at once."""
    width, n, flat = keys.shape[0] if chosen is None else chosen.shape[1], keys.shape[1], keys.ravel()
    found, ends, first = np.zeros((width, nodes, size)), np.searchsorted(slots, np.arange(nodes), "right"), 0
    while first < nodes:
        begin = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, begin + BLOCK, "right")))
        for at in range(begin, int(ends[last - 1]), BLOCK):
            part = slice(at, min(at + BLOCK, int(ends[last - 1])))
            own, weights = rows[part].astype(np.int64), times[part].astype(float)
            base = (slots[part] - first).astype(np.int64) * size
            for j in range(width):
                codes = keys[j].take(own) if chosen is None else flat.take((chosen[:, j] * n)[slots[part]] + own)
                found[j, first:last] += np.bincount(base + codes, weights, minlength=(last - first) * size).reshape(-1, size)
        first = last
    return found


def _best_splits(keys: np.ndarray, rows: np.ndarray, times: np.ndarray, slots: np.ndarray, nodes: int, chosen: np.ndarray | None, bins: int, classes: int, settings: Settings):
    """Per node the gain, place in its predictors, cut and class totals of the best split, those of the left side and both impurities.

    ``keys`` holds class * bins + bin, a row per predictor.
    """
    found = _histograms(keys, rows, times, slots, nodes, chosen, classes * bins).reshape(-1, nodes, classes, bins)
    width, size = len(found), classes * bins
    totals, out = found[0].sum(-1), []
    for begin in range(0, nodes, max(1, 100_000 // (width * size))):
        part = slice(begin, begin + max(1, 100_000 // (width * size)))
        left = np.cumsum(found[:, part], axis=-1)[..., :-1].transpose(1, 0, 2, 3)
        whole = totals[part][:, None, :, None]
        right, rows_left, all_rows = whole - left, left.sum(-2), whole.sum(-2)
        rows_right = all_rows - rows_left
        with np.errstate(divide="ignore", invalid="ignore"):
            left_impurity, right_impurity = _impurity(left, rows_left), _impurity(right, rows_right)
            gain = _impurity(whole, all_rows) - rows_left / all_rows * left_impurity - rows_right / all_rows * right_impurity
            bad = (rows_left < settings.least) | (rows_right < settings.least) | (gain < settings.gain)
        gain = np.where(bad, -np.inf, gain).reshape(len(left), -1)
        best = gain.argmax(1) if gain.shape[1] else np.zeros(len(left), int)
        for i, b in enumerate(best):
            if not gain.shape[1]:
                out.append((-np.inf, 0, 0, totals[begin + i], None, 0.0, 0.0))
                continue
            place, cut = divmod(int(b), bins - 1)
            out.append((gain[i, b], place, cut, totals[begin + i], left[i, place, :, cut].copy(), left_impurity[i, place, cut], right_impurity[i, place, cut]))
    return out


def grow(keys: np.ndarray, counts: np.ndarray, bins: int, classes: int, sizes: np.ndarray, settings: Settings) -> list[_Tree]:
    """A forest on rows given as class * bins + bin, a row per predictor. ``counts`` are the times each row (down) is drawn for each tree;
    ``sizes`` the bins of each predictor, by which Spark portions the nodes that it splits at once."""
    trees, draw, predictors = [_Tree(counts[:, t]) for t in range(settings.trees)], _JavaRandom(settings.seed), len(keys)
    waiting = [(t, 0) for t in range(settings.trees)]  # the last one is the next
    sampling = settings.width < predictors
    while waiting:
        if sampling:
            following = draw.states(len(waiting))
            chosen = subsets([number for number, _ in following], predictors, settings.width)
            used = np.cumsum(sizes[chosen].sum(1) * classes * 8)
            taken = max(1, int(np.searchsorted(used, settings.memory, "right")))
            draw.state = following[min(taken, len(waiting) - 1)][1]  # the node that no longer fits has drawn, too
        else:
            taken, chosen = len(waiting), None
        group: dict[int, list[tuple[int, int]]] = {}
        for i in range(taken):
            t, node = waiting.pop()
            group.setdefault(t, []).append((node, i))
        for t in map_order(list(group)):
            waiting.extend((t, node) for node in _split(trees[t], group[t], keys, chosen, bins, classes, settings))
    for tree in trees:
        tree.pruned()
    return trees


def _split(tree: _Tree, nodes: list[tuple[int, int]], keys: np.ndarray, chosen: np.ndarray | None, bins: int, classes: int, settings: Settings) -> list[int]:
    """Splits some nodes of a tree and moves their rows on; the children that may be split, in order."""
    opened: list[int] = []
    width = settings.width if chosen is not None else len(keys)
    some = max(1, HISTOGRAM_BYTES // (width * bins * classes * 8))
    for begin in range(0, len(nodes), some):
        own = nodes[begin : begin + some]
        lookup = np.full(len(tree.level), -1, np.int32)
        lookup[[node for node, _ in own]] = np.arange(len(own))
        slots = lookup[tree.at]
        here = np.flatnonzero(slots >= 0)
        here = here[np.argsort(slots[here].astype(np.uint16) if len(own) < 1 << 16 else slots[here], kind="stable")]
        slots, rows, times = slots[here], tree.rows[here], tree.times[here]
        sets = None if chosen is None else chosen[[i for _, i in own]]
        ids, features, cuts = [], np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        for s, (gain, place, cut, totals, left, left_impurity, right_impurity) in enumerate(_best_splits(keys, rows, times, slots, len(own), sets, bins, classes, settings)):
            node = own[s][0]
            tree.totals[node], tree.open[node] = totals, False
            if gain <= 0 or tree.level[node] == settings.depth:
                ids.append((node, node))
                continue
            features[s], cuts[s] = place if sets is None else sets[s, place], cut
            tree.feature[node], tree.cut[node] = int(features[s]), cut
            inner = tree.level[node] + 1 < settings.depth
            a = tree.left[node] = tree.child(node, left, inner and not abs(left_impurity) < 2.0**-52)
            b = tree.right[node] = tree.child(node, totals - left, inner and not abs(right_impurity) < 2.0**-52)
            ids.append((a, b))
            opened += [child for child in (a, b) if tree.open[child]]
        side = keys.ravel().take(features[slots] * keys.shape[1] + rows) % bins > cuts[slots]
        tree.at[here] = np.array(ids, np.int32)[slots, side.astype(np.int8)]
    kept = np.array(tree.open)[tree.at]
    tree.rows, tree.times, tree.at = tree.rows[kept], tree.times[kept], tree.at[kept]
    return opened


# --- functions for Spark's tasks --------------------------------------------------------------------


@dataclass(frozen=True)
class Part:
    """Rows to train on and to predict by outer and inner fold; without an inner fold the outer one is predicted."""

    outer: int
    inner: int | None
    rows: int
    classes: int

    def train(self, outer: np.ndarray, inner: np.ndarray) -> np.ndarray:
        return (outer != self.outer) & (True if self.inner is None else inner != self.inner)

    def test(self, outer: np.ndarray, inner: np.ndarray) -> np.ndarray:
        return outer == self.outer if self.inner is None else (outer != self.outer) & (inner == self.inner)


@dataclass(frozen=True)
class Unit:
    """What one task does: some forests on one part, by number."""

    part: int
    fits: tuple[tuple[int, Settings], ...]


def _values(column: pa.Array) -> np.ndarray:
    """Rows of a list column."""
    if column.null_count:
        raise ValueError("features must not be null")
    found = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    if not np.isfinite(found).all():
        raise ValueError("features must not be NaN or infinite")
    return found


def sampling(parts: Sequence[Part]) -> Callable:
    """(part, features) of the rows from (outer, inner, share, features) that give a part's split candidates: all of a small one."""
    def take(batches):
        for batch in batches:
            outer, inner, share = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            _values(batch.column(3))
            for i, part in enumerate(parts):
                own = batch.filter(pa.array(part.train(outer, inner) & (share < SAMPLED / max(SAMPLED, part.rows))))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(own.num_rows, i, "int32")), own.column(3)], ["part", "x"])
    return take


def candidates(parts: Sequence[Part], most: int) -> Callable:
    """(part, predictor, cuts) from the sampled rows, all of a part in one task."""
    def find(batches):
        seen: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            numbers, x = batch.column(0).to_numpy(), _values(batch.column(1))
            for i in np.unique(numbers):
                seen.setdefault(int(i), []).append(x[numbers == i])
        rows = []
        for i, some in seen.items():
            x = np.concatenate(some)
            rows += [{"part": i, "predictor": f, "cuts": thresholds(x[:, f], min(most, parts[i].rows)).tolist()} for f in range(x.shape[1])]
        schema = pa.schema([("part", pa.int32()), ("predictor", pa.int32()), ("cuts", pa.list_(pa.float64()))])
        yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return find


def dealing(parts: Sequence[Part], units: Sequence[Unit], cuts: Mapping[int, Sequence[np.ndarray]]) -> Callable:
    """(unit, position, tested, y, bins, others) from (outer, inner, position, y, features, others): each row binned for every part that
    trains on it or predicts it."""
    def deal(batches):
        for batch in batches:
            outer, inner = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(2))
            x = _values(batch.column(4))
            for i in sorted({unit.part for unit in units}):
                test = parts[i].test(outer, inner)
                here = test | parts[i].train(outer, inner)
                if not here.any():
                    continue
                own, codes = batch.filter(pa.array(here)), binned(x[here], cuts[i])
                begins = np.arange(len(codes) + 1, dtype=np.int32) * codes[0].nbytes
                lines = pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer(begins), pa.py_buffer(codes)])
                columns = [own.column(2), pa.array(test[here]), own.column(3), lines, *own.columns[5:]]
                for u, unit in enumerate(units):
                    if unit.part == i:
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), u, "int32")), *columns], ["unit", "position", "tested", "y", "bins", *batch.schema.names[5:]])
    return deal


def growing(parts: Sequence[Part], units: Sequence[Unit], cuts: Mapping[int, Sequence[np.ndarray]], draws, most: int, whole: bool) -> Callable:
    """Grows the forests of a unit's rows and predicts its tested ones: (fit, label, prediction, n), or with ``whole`` every tested row's
    other columns, prediction and outer fold."""
    def work(batches):
        found = list(batches)
        if not found:
            return
        table = pa.Table.from_batches(found)
        numbers = table.column("unit").to_numpy()
        for u in np.unique(numbers):
            own = table if (numbers == u).all() else table.filter(pa.array(numbers == u))
            yield from _grown(own, units[u], parts[units[u].part], cuts[units[u].part], draws.value, most, whole)
    return work


def _grown(table: pa.Table, unit: Unit, part: Part, cuts: Sequence[np.ndarray], draws: np.ndarray, most: int, whole: bool):
    order = np.argsort(table.column("position").to_numpy())
    tested = table.column("tested").to_numpy()[order]
    kind = np.uint8 if max(len(c) for c in cuts) < 256 else np.uint16
    lines = [np.frombuffer(c.buffers()[2], kind, len(c) * len(cuts), _first(c)).reshape(len(c), -1) for c in table.column("bins").chunks if len(c)]
    codes = np.concatenate(lines)[order]
    y = table.column("y").to_numpy()[order]
    bins, sizes = min(most, part.rows), np.array([len(c) + 1 for c in cuts])
    wide = np.uint16 if part.classes * bins < 1 << 16 else np.int32
    keys = np.ascontiguousarray((codes[~tested].astype(wide) + (y[~tested].astype(wide) * wide(bins))[:, None]).T)
    columns, actual = np.ascontiguousarray(codes[tested].T), y[tested]
    del codes, lines
    for number, settings in unit.fits:
        chosen = slice(None) if settings.columns is None else list(settings.columns)
        counts = draws[: keys.shape[1] * settings.trees].reshape(-1, settings.trees)
        votes = np.zeros((len(actual), part.classes))
        for tree in grow(keys[chosen], counts, bins, part.classes, sizes[chosen], settings):
            votes += tree.votes(columns[chosen])
        predicted = votes.argmax(1).astype(float)
        if whole:
            names = table.schema.names[5:]
            rows = table.select(names).take(pa.array(order[tested])).combine_chunks()
            for batch in rows.append_column("prediction", pa.array(predicted)).append_column("outer", pa.array(np.full(len(actual), part.outer, "int32"))).to_batches():
                yield batch
        else:
            pairs, n = np.unique(np.column_stack([actual, predicted]), axis=0, return_counts=True)
            columns_out = [np.full(len(n), number, "int32"), pairs[:, 0].copy(), pairs[:, 1].copy(), n.astype("int64")]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns_out], ["fit", "label", "prediction", "n"])


def _first(column: pa.Array) -> int:
    """Where a binary column's bytes begin."""
    return int(np.frombuffer(column.buffers()[1], np.int32)[column.offset])
