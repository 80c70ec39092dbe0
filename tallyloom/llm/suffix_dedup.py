"""Removal of repeated passages with a hash-compared suffix sort.

A byte goes if it is covered by a string of ``length`` bytes that also starts in a document with a smaller id. Two equal
strings of that length hold the same anchor at the same place: the k-byte string with the least hash in them. So suffixes are
dealt by anchors: an anchor that occurs in one document only is left out, and around every other one its surroundings, the
bytes of all strings that hold it, are compared.

0. Equal whole texts are one row from here on, that of their least document: the others share all its strings and are removed
   whole. So large groups of copies cost a digest each.
1. Each part of the texts sends the hashes of its anchors, packed and sorted, and learns which occur in several documents.
2. It sends the surroundings of those, each distinct one once with its least document. A task gathers the surroundings of its
   anchors. Equal ones are settled by their least document; of the different ones, the suffixes whose first ``length`` bytes have
   a hash that occurs more than once, one of each hash, are sorted by a merge sort that compares two suffixes through prefix polynomial hashes: a
   binary search finds how far they agree, the next byte decides. Neighbours that agree over ``length`` bytes form a class; the
   bytes are compared themselves, so a collision changes nothing. An anchor with very many different surroundings, counted
   before any is sent, is not gathered: its surroundings are cut into single strings, dealt by their own hash.
3. Each part looks its surroundings up among the answers and removes the covered bytes.

What is shuffled: a digest per text, the texts once (the same exchange serves all three steps), five bytes per anchor, and
surroundings once per part. Parts hold a few megabytes of text; rows are dealt to them by id and text, so that many rows without
an id, or of one id, do not meet. Texts are whole UTF-8 byte strings, null is empty; a document shorter than ``length`` stays as
it is. Rows that repeat an id do not count as different documents, nor do rows without one. An empty table gives no rows.
Columns other than doc_id and text are left out, so no name can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import KEPT, in_parts, keep_only, part_count, stored, text_hash

LENGTH = 50
ANCHOR = 20
HOT = 50_000  # an anchor with more different surroundings, 31 suffixes each, is dealt string by string: some 100 MB to sort
BLOCK = 1 << 18  # bytes whose anchors are found at once
BASE = np.uint64(0x9E3779B97F4A7C15)
LEADER, ANSWER = -2, -1  # kinds of messages; the others are numbers of buckets
NO_DOC = np.iinfo("int64").max

ANCHORS = "bucket int, part int, several boolean, keys binary, more binary"
SURROUNDINGS = "bucket int, part int, keys binary, docs binary, shared binary, left binary, sizes binary, data binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
MESSAGE = "to_part int, kind int, doc long, keys binary, docs binary, spans binary"


def _byte_values() -> np.ndarray:
    """A number per byte value, spread over 64 bits."""
    x = np.arange(1, 257, dtype="uint64") * BASE
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


VALUES = _byte_values()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


_TABLES = [np.ones(1, "uint64"), np.ones(1, "uint64")]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept by the worker up to the longest string so far."""
    if len(_TABLES[0]) <= n:
        KEPT["suffix_dedup"] = _forget
        size = max(n, BLOCK + 1000)
        for place, factor in enumerate((BASE, np.uint64(pow(int(BASE), -1, 1 << 64)))):
            _TABLES[place] = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size, factor))])
    return _TABLES[0], _TABLES[1]


def _forget() -> None:
    _TABLES[:] = [table[:1].copy() for table in _TABLES]


class PrefixHashes:
    """Polynomial hashes of all prefixes of a byte string, for the hash of any substring in constant time."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        powers, self.inverse = _powers(n)
        self.prefix = np.zeros(n + 1, "uint64")
        np.cumsum(VALUES[data] * powers[:n], out=self.prefix[1:])

    def of(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        return (self.prefix[starts + lengths] - self.prefix[starts]) * self.inverse[starts]

    def all_of(self, length: int) -> np.ndarray:
        """Hashes of the substrings of one length at every place."""
        n = len(self.prefix) - length
        return (self.prefix[length:] - self.prefix[:n]) * self.inverse[:n]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def anchors(data: np.ndarray, hashes: PrefixHashes, length: int, anchor: int) -> np.ndarray:
    """Places of the anchors of one text: where the least hash of some string of ``length`` bytes lies, ties included."""
    if len(data) < length:
        return np.empty(0, "int64")
    grams = mixed(hashes.all_of(anchor))
    width = length - anchor + 1
    least = sliding_min(grams, width)
    # A place is an anchor if it holds the minimum of one of the runs it lies in.
    padded = np.concatenate([np.zeros(width - 1, "uint64"), least, np.zeros(width - 1, "uint64")])
    highest = ~sliding_min(~padded, width)
    return np.flatnonzero(highest == grams)


class Text:
    """One text with its anchors, block by block, so that a long text needs no more memory than its bytes."""

    def __init__(self, doc: int, data: bytes, length: int, anchor: int):
        self.doc, self.data = doc, np.frombuffer(data, "uint8")
        self.length, self.anchor = length, anchor

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray, PrefixHashes, int]]:
        """(anchor places in the text, their hashes, hashes of the block, where the block begins)."""
        reach = 2 * self.length  # so that anchors near a cut see all strings that hold them
        for begin in range(0, max(len(self.data), 1), BLOCK):
            low, high = max(begin - reach, 0), min(begin + BLOCK + reach, len(self.data))
            hashes = PrefixHashes(self.data[low:high])
            places = anchors(self.data[low:high], hashes, self.length, self.anchor)
            places = places[(places + low >= begin) & (places + low < begin + BLOCK)]
            yield places + low, mixed(hashes.of(places, self.anchor)), hashes, low


class Surroundings:
    """The bytes around anchors that strings holding them reach, clipped at the ends of the text."""

    def __init__(self, text: Text, places: np.ndarray, hashes: PrefixHashes, low: int):
        self.left = np.minimum(places, text.length - text.anchor)
        self.right = np.minimum(len(text.data) - places, text.length)
        self.begin = places - self.left
        size = self.left + self.right
        key = mixed(hashes.of(self.begin - low, size) + self.left.astype("uint64") * VALUES[7])
        self.keys = mixed(key + size.astype("uint64") * VALUES[11])


def _packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def _leaders(messages: pd.DataFrame) -> set[int]:
    """The part's documents that are the least of their copies."""
    return set(messages.loc[messages["kind"] == LEADER, "doc"].tolist())


def _texts(rows: pd.DataFrame, leaders: set[int], length: int, anchor: int) -> Iterator[Text]:
    """The part's texts, without copies of earlier ones."""
    chosen = rows[rows["doc"].isin(leaders)]
    for doc, text in zip(chosen["doc"].tolist(), chosen["text"], strict=True):
        data = b"" if text is None else text.encode("utf-8", "surrogatepass")
        yield Text(doc, data, length, anchor)


def _send_anchors(rows: pd.DataFrame, messages: pd.DataFrame, buckets: int, length: int, anchor: int) -> pd.DataFrame:
    """Hashes of the part's anchors, packed by bucket: those of one document and those of several.

    ``more``: place and number of further different surroundings, for the few anchors that have such within the part.
    """
    keep_only("suffix_dedup")
    nothing = pd.DataFrame({name: [] for name in ("bucket", "part", "several", "keys", "more")})
    found, docs, around = [], [], []
    for text in _texts(rows, _leaders(messages), length, anchor):
        for places, keys, hashes, low in text.blocks():
            found.append(keys)
            docs.append(np.full(len(keys), text.doc))
            around.append(Surroundings(text, places, hashes, low).keys)
    if not sum(map(len, found)):
        return nothing
    keys, docs, around = map(np.concatenate, (found, docs, around))
    order = np.lexsort((around, keys))
    keys, docs, around = keys[order], docs[order], around[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (around[1:] != around[:-1])])
    more = np.add.reduceat(fresh.astype("int64"), first) - 1
    several = np.minimum.reduceat(docs, first) != np.maximum.reduceat(docs, first)
    keys = keys[first]
    out = []
    bucket = (keys % np.uint64(buckets)).astype("int64")
    for flag in (False, True):
        by = np.flatnonzero(several == flag)
        by = by[np.lexsort((_remainders(keys[by], buckets), bucket[by]))]
        to = bucket[by]
        cuts = np.flatnonzero(to[1:] != to[:-1]) + 1
        for a, b in zip([0, *cuts], [*cuts, len(to)], strict=True) if len(to) else ():
            # five bytes of each hash are enough to drop almost all anchors of one document; a chance match costs work only
            extra = np.flatnonzero(more[by[a:b]])
            extra = _packed(np.stack([extra, more[by[a:b]][extra]], 1).astype("int32")) if len(extra) else None
            out.append((int(to[a]), int(rows["part"].iloc[0]), flag, _short(keys[by[a:b]], buckets), extra))
    return pd.DataFrame(out, columns=nothing.columns)


def _remainders(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (keys // np.uint64(buckets)) & np.uint64((1 << 40) - 1)


def _short(keys: np.ndarray, buckets: int) -> bytes:
    """40-bit remainders of hashes within a bucket."""
    return _packed(np.ascontiguousarray(_remainders(keys, buckets)).view("uint8").reshape(-1, 8)[:, :5])


def _long(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 5, 8), "uint8")
    wide[:, :5] = np.frombuffer(data, "uint8").reshape(-1, 5)
    return wide.view("uint64").ravel()


def _repeated(rows: pd.DataFrame, hot: int) -> pd.DataFrame:
    """Answer each part which of its anchors of this bucket occur in several documents, and which of them have too many
    different surroundings to be gathered. These are counted per part, so the same one in two parts counts twice."""
    lists = [_long(keys) for keys in rows["keys"]]
    keys = np.concatenate(lists)
    weight = np.concatenate([np.full(len(one), 2 if flag else 1, "int32") for one, flag in zip(lists, rows["several"], strict=True)])
    kinds, begin = np.ones(len(keys), "int64"), 0
    for one, more in zip(lists, rows["more"], strict=True):
        if more is not None:
            place, number = np.frombuffer(more, "int32").reshape(-1, 2).T
            kinds[begin + place] += number
        begin += len(one)
    order = np.argsort(keys, kind="stable")
    keys, weight, kinds = keys[order], weight[order], kinds[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    total = np.add.reduceat(weight, first)
    known = keys[first][total > 1]
    spread = np.add.reduceat(kinds, first)[total > 1] > hot
    bucket = int(rows["bucket"].iloc[0])
    out = []
    for part, one in zip(rows["part"], lists, strict=True):
        at = np.searchsorted(known, one)
        at[at == len(known)] = 0
        hit = known[at] == one if len(known) else np.zeros(len(one), bool)
        if hit.any():
            data = _packed(one[hit].view("uint8").reshape(-1, 8)[:, :5])
            out.append((int(part), bucket, 0, data, None, _packed(spread[at[hit]].astype("uint8"))))
    return pd.DataFrame(out, columns=["to_part", "kind", "doc", "keys", "docs", "spans"])


class Repeated:
    """A part's anchors that occur in several documents."""

    def __init__(self, messages: pd.DataFrame, buckets: int):
        keys, hot = [], []
        for bucket, data, flags in zip(messages["kind"], messages["keys"], messages["spans"], strict=True):
            keys.append(_long(data) * np.uint64(buckets) + np.uint64(bucket))
            hot.append(np.frombuffer(flags, "uint8"))
        self.keys = np.concatenate(keys) if keys else np.empty(0, "uint64")
        self.hot = np.concatenate(hot).astype(bool) if hot else np.empty(0, bool)
        order = np.argsort(self.keys)
        self.keys, self.hot, self.buckets = self.keys[order], self.hot[order], np.uint64(buckets)

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is among them, and whether it is a hot one."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        wanted = ((keys // self.buckets) & np.uint64((1 << 40) - 1)) * self.buckets + keys % self.buckets
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = self.keys[at] == wanted
        return hit, hit & self.hot[at]


def _strings(text: Text, places: np.ndarray, hashes: PrefixHashes, low: int) -> tuple[np.ndarray, np.ndarray]:
    """(begin, key) of the single strings of ``length`` bytes around anchors that are hot."""
    around = places[:, None] - np.arange(text.length - text.anchor + 1)[None, :]
    begin = np.unique(around[(around >= 0) & (around + text.length <= len(text.data))])
    return begin, mixed(hashes.of(begin - low, text.length) + VALUES[13])


def _send_surroundings(rows: pd.DataFrame, messages: pd.DataFrame, buckets: int, compared: int, length: int, anchor: int) -> pd.DataFrame:
    """Distinct surroundings of repeated anchors with the least document of each, packed by bucket of these."""
    keep_only("suffix_dedup")
    known = Repeated(messages[messages["kind"] >= 0], buckets)
    keys, docs, to, left, sizes, data = [], [], [], [], [], []
    for text in _texts(rows, _leaders(messages), length, anchor):
        for places, hashed, hashes, low in text.blocks():
            hit, hot = known.of(hashed)
            cold = hit & ~hot
            around = Surroundings(text, places[cold], hashes, low)
            begin, single = _strings(text, places[hot], hashes, low)
            keys += [around.keys, single]
            to += [(one % np.uint64(compared)).astype("int64") for one in (hashed[cold], single)]
            left += [around.left, np.full(len(single), -1)]
            sizes += [around.left + around.right, np.full(len(single), length)]
            docs.append(np.full(len(around.keys) + len(single), text.doc))
            data += [text.data[a : a + n].tobytes() for a, n in zip(around.begin.tolist(), (around.left + around.right).tolist(), strict=True)]
            data += [text.data[a : a + length].tobytes() for a in begin.tolist()]
    names = ["bucket", "part", "keys", "docs", "shared", "left", "sizes", "data"]
    if not keys or not sum(map(len, keys)):
        return pd.DataFrame({name: [] for name in names})
    keys, docs, to, left, sizes = map(np.concatenate, (keys, docs, to, left, sizes))
    order = np.lexsort((docs, keys, to))
    first = np.concatenate([[True], (keys[order][1:] != keys[order][:-1]) | (to[order][1:] != to[order][:-1])])
    chosen = order[first]  # of each distinct one, the least document
    ends = np.append(np.flatnonzero(first)[1:], len(order)) - 1
    shared = np.zeros(len(keys), "uint8")
    shared[chosen] = docs[order[ends]] != docs[chosen]  # further documents of the part have it too
    cuts = np.flatnonzero(np.concatenate([[True], to[chosen][1:] != to[chosen][:-1]]))
    out = []
    for a, b in zip(cuts, [*cuts[1:], len(chosen)], strict=True):
        own = chosen[a:b]
        packed = [_packed(keys[own]), _packed(docs[own]), _packed(shared[own]), _packed(left[own].astype("int16")), _packed(sizes[own].astype("int16"))]
        out.append((int(to[own[0]]), int(rows["part"].iloc[0]), *packed, b"".join([data[i] for i in own.tolist()])))
    return pd.DataFrame(out, columns=names)


class SuffixSort:
    """Sorts suffixes of one byte string, each compared over at most ``depth`` bytes."""

    def __init__(self, data: np.ndarray, depth: int):
        self.data, self.depth = np.concatenate([data, np.zeros(depth, "uint8")]), depth
        self.hashes = PrefixHashes(self.data)

    def agreement(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning of two suffixes, at most ``depth``: a binary search over prefix hashes."""
        low = np.zeros(len(a), "int64")
        high = np.full(len(a), self.depth)
        while len(a) and (low < high).any():
            middle = (low + high + 1) // 2
            same = self.hashes.of(a, middle) == self.hashes.of(b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether suffix a sorts before suffix b; equal ones do not."""
        common = self.agreement(a, b)
        ends = common >= self.depth
        at = np.where(ends, 0, common)
        return np.where(ends, False, self.data[a + at] < self.data[b + at])

    def sort(self, suffixes: np.ndarray) -> np.ndarray:
        """Bottom-up merge sort, all pairs of runs of a level at once: the rank of each element in the other run is
        found by binary search with hash comparisons. Suffixes start out in the order of their first eight bytes, and only
        runs of equal ones among them are merged on."""
        head = np.zeros(len(suffixes), "uint64")
        for i in range(8):
            head = (head << np.uint64(8)) | self.data[suffixes + i].astype("uint64")
        order = np.argsort(head, kind="stable")
        suffixes, head = suffixes[order], head[order]
        group_start = np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1]])) if len(head) else np.empty(0, "int64")
        group_size = np.diff(np.append(group_start, len(head)))
        run = 1
        while (group_size > run).any():
            big = group_size > run
            starts, sizes = group_start[big], group_size[big]
            index = np.repeat(starts, sizes) + _ramp(sizes)
            base = np.repeat(starts, sizes)
            end = base + np.repeat(sizes, sizes)
            own = (index - base) // run
            mate_low = np.minimum(base + (own ^ 1) * run, end)
            mate_high = np.minimum(mate_low + run, end)
            is_left = own % 2 == 0
            rank = self._rank(suffixes, index, mate_low, mate_high, is_left)
            pair = base + (own // 2) * 2 * run
            target = pair + (index - (base + own * run)) + (rank - mate_low)
            merged = suffixes.copy()
            merged[target] = suffixes[index]
            suffixes = merged
            run *= 2
        return suffixes

    def sorted_repeats(self, suffixes: np.ndarray) -> np.ndarray:
        """Suffixes in order, without those whose first ``depth`` bytes have a hash of their own: they equal no other. Of those
        with one hash the comparison finds one place, so one is sorted and the others follow it."""
        hashes = self.hashes.of(suffixes, self.depth)
        order = np.argsort(hashes, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])) if len(order) else order
        sizes = np.diff(np.append(first, len(order)))
        first, sizes = first[sizes > 1], sizes[sizes > 1]
        lead = suffixes[order[first]]
        by_place = np.argsort(lead)
        at = by_place[np.searchsorted(lead[by_place], self.sort(lead))]
        return suffixes[order[np.repeat(first[at], sizes[at]) + _ramp(sizes[at])]]

    def _rank(self, suffixes: np.ndarray, index: np.ndarray, low: np.ndarray, high: np.ndarray, is_left: np.ndarray) -> np.ndarray:
        """Where each element goes in the other run: left elements before equal ones, right elements behind them."""
        low, high = low.copy(), high.copy()
        active = np.flatnonzero(low < high)
        while len(active):
            middle = (low[active] + high[active]) // 2
            mine, other = suffixes[index[active]], suffixes[middle]
            other_first = self.before(other, mine)
            right = np.flatnonzero(~is_left[active] & ~other_first)
            other_first[right] = ~self.before(mine[right], other[right])
            low[active] = np.where(other_first, middle + 1, low[active])
            high[active] = np.where(other_first, high[active], middle)
            active = active[low[active] < high[active]]
        return low

    def classes(self, ordered: np.ndarray) -> np.ndarray:
        """Class number of each sorted suffix; neighbours that agree over the depth share one. Bytes are compared at last."""
        if not len(ordered):
            return np.empty(0, "int64")
        same = self.hashes.of(ordered[:-1], self.depth) == self.hashes.of(ordered[1:], self.depth)
        at = np.flatnonzero(same)
        for begin in range(0, len(at), 1 << 16):  # collision check
            some = at[begin : begin + (1 << 16)]
            reach = np.arange(self.depth)
            same[some] = (self.data[ordered[some][:, None] + reach] == self.data[ordered[some + 1][:, None] + reach]).all(1)
        return np.concatenate([[0], np.cumsum(~same)])


def _ramp(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. for each size, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def _compare(rows: pd.DataFrame, length: int, anchor: int) -> pd.DataFrame:
    """Answer each part which bytes of its surroundings a document with a smaller id has.

    ``docs``: the least document with equal surroundings; ``spans``: for that document itself, the covered bytes among them.
    """
    keep_only("suffix_dedup")
    lists = [np.frombuffer(one, "uint64") for one in rows["keys"]]
    keys = np.concatenate(lists)
    docs = np.concatenate([np.frombuffer(one, "int64") for one in rows["docs"]])
    left = np.concatenate([np.frombuffer(one, "int16") for one in rows["left"]]).astype("int64")
    sizes = np.concatenate([np.frombuffer(one, "int16") for one in rows["sizes"]]).astype("int64")
    data = np.frombuffer(b"".join(rows["data"]), "uint8")
    starts = np.cumsum(sizes) - sizes
    order = np.lexsort((docs, keys))
    first = np.concatenate([[True], keys[order][1:] != keys[order][:-1]])
    chosen = order[first]  # distinct surroundings, each with its least document
    least = docs[chosen]
    false = _collisions(order, first, data, starts, sizes)
    # Different surroundings of one anchor meet in the sort of their suffixes; an anchor with one kind is settled.
    hashed = _anchor_hashes(data, starts[chosen], left[chosen], anchor)
    kinds = pd.Series(hashed).groupby(hashed).transform("size").to_numpy() if len(hashed) else np.empty(0)
    open_ones = np.flatnonzero((kinds > 1) & (sizes[chosen] >= length) & (left[chosen] >= 0))
    begin, stop = np.zeros(len(chosen), "int16"), np.zeros(len(chosen), "int16")
    for some in _groups(open_ones, hashed):
        _sort_open(some, chosen, data, starts, sizes, least, begin, stop, length)
    out = []
    at_key = keys[chosen]
    covered = stop > begin
    for part, one, own, shared in zip(rows["part"], lists, rows["docs"], rows["shared"], strict=True):
        at = np.searchsorted(at_key, one)
        useful = covered[at] | (np.frombuffer(own, "int64") != least[at]) | np.frombuffer(shared, "bool")
        at = np.unique(at[useful & ~false[at]])
        if len(at):
            out.append((int(part), ANSWER, 0, _packed(at_key[at]), _packed(least[at]), _packed(np.stack([begin[at], stop[at]], 1))))
    return pd.DataFrame(out, columns=["to_part", "kind", "doc", "keys", "docs", "spans"])


def _collisions(order: np.ndarray, first: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each distinct key whether its surroundings differ in their bytes; such a key settles nothing."""
    number = np.cumsum(first) - 1
    lead = order[first][number]
    others = np.flatnonzero(~first)
    wrong = np.zeros(int(first.sum()), bool)
    for begin in range(0, len(others), 1 << 14):
        some = others[begin : begin + (1 << 14)]
        one, two = order[some], lead[some]
        differ = sizes[one] != sizes[two]
        same = np.flatnonzero(~differ)
        ramp, size = _ramp(sizes[one][same]), sizes[one][same]
        unequal = data[np.repeat(starts[one][same], size) + ramp] != data[np.repeat(starts[two][same], size) + ramp]
        differ[same] = np.add.reduceat(unequal, np.cumsum(size) - size) > 0 if len(same) else False
        wrong[number[some[differ]]] = True
    return wrong


def _anchor_hashes(data: np.ndarray, starts: np.ndarray, left: np.ndarray, anchor: int) -> np.ndarray:
    """Polynomial hashes of the anchors alone; hashes of all prefixes would take many times the bytes."""
    places, powers = starts + np.maximum(left, 0), _powers(anchor)[0]
    sums = np.zeros(len(places), "uint64")
    for i in range(anchor):
        sums += VALUES[data[places + i]] * powers[i]
    return mixed(sums)


def _groups(places: np.ndarray, hashed: np.ndarray, most: int = 20_000) -> Iterator[np.ndarray]:
    """Surroundings sorted together: all of an anchor, and as many anchors as make about ``most``."""
    places = places[np.argsort(hashed[places], kind="stable")]
    own = hashed[places]
    cuts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.empty(0, "int64")
    begin = 0
    for cut in [*cuts[1:], len(places)] if len(cuts) else []:
        if cut - begin >= most or cut == len(places):
            yield places[begin:cut]
            begin = cut


def _sort_open(some, chosen, data, starts, sizes, least, begin, stop, length) -> None:
    """Sort all strings of ``length`` bytes in some surroundings and mark those that a smaller document has."""
    own_sizes = sizes[chosen[some]]
    offsets = np.cumsum(own_sizes) - own_sizes
    joined = np.concatenate([data[starts[i] : starts[i] + sizes[i]] for i in chosen[some].tolist()])
    counts = own_sizes - length + 1
    suffixes = np.repeat(offsets, counts) + _ramp(counts)
    sorter = SuffixSort(joined, length)
    ordered = sorter.sorted_repeats(suffixes)
    if not len(ordered):
        return
    classes = sorter.classes(ordered)
    owner = np.searchsorted(offsets, ordered, side="right") - 1
    doc = least[some][owner]
    best = np.full(classes[-1] + 1, NO_DOC)
    np.minimum.at(best, classes, doc)
    covered = best[classes] < doc
    place = (ordered - offsets[owner])[covered]
    low = np.full(len(some), 32767)
    high = np.zeros(len(some), "int64")
    np.minimum.at(low, owner[covered], place)
    np.maximum.at(high, owner[covered], place + length)
    begin[some] = np.where(high > 0, low, 0)  # all strings hold the anchor, so their union has no gap
    stop[some] = high


def _remove(rows: pd.DataFrame, messages: pd.DataFrame, buckets: int, length: int, anchor: int, with_kept: bool, passing: tuple[str, ...]) -> pd.DataFrame:
    """Remove covered bytes from the part's texts."""
    keep_only("suffix_dedup")
    known = Repeated(messages[messages["kind"] >= 0], buckets)
    answers = messages[messages["kind"] == ANSWER]
    leaders = _leaders(messages)
    keys = np.concatenate([np.frombuffer(x, "uint64") for x in answers["keys"]] or [np.empty(0, "uint64")])
    least = np.concatenate([np.frombuffer(x, "int64") for x in answers["docs"]] or [np.empty(0, "int64")])
    spans = np.concatenate([np.frombuffer(x, "int16").reshape(-1, 2) for x in answers["spans"]] or [np.empty((0, 2), "int16")]).astype("int64")
    order = np.argsort(keys)
    keys, least, spans = keys[order], least[order], spans[order]
    out = []
    for text in _texts(rows, set(rows["doc"].tolist()), length, anchor):
        change = np.zeros(len(text.data) + 1, "int32")
        copy = text.doc not in leaders
        if copy and len(text.data) >= length:
            change[[0, -1]] = 1, -1
        for places, hashed, hashes, low in text.blocks() if len(keys) and not copy else ():
            hit, hot = known.of(hashed)
            around = Surroundings(text, places[hit & ~hot], hashes, low)
            single_begin, single = _strings(text, places[hot], hashes, low)
            wanted = np.concatenate([around.keys, single])
            first = np.concatenate([around.begin, single_begin])
            size = np.concatenate([around.left + around.right, np.full(len(single), length)])
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            there = keys[at] == wanted
            whole = there & (least[at] < text.doc) & (size >= length)
            partly = there & (least[at] == text.doc) & (spans[at, 1] > 0)
            np.add.at(change, first[whole], 1)
            np.add.at(change, (first + size)[whole], -1)
            np.add.at(change, (first + spans[at, 0])[partly], 1)
            np.add.at(change, (first + spans[at, 1])[partly], -1)
        gone = np.cumsum(change[:-1]) > 0
        edges = np.diff(np.concatenate([[0], gone.view("int8")]))
        kept = text.data[~gone].tobytes()
        one = (text.doc, len(text.data), int(gone.sum()), int((edges > 0).sum()), hashlib.sha256(kept).hexdigest())
        out.append((*one, kept) if with_kept else one)
    result = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_kept)
    for name in passing:
        result[name] = rows[name].to_numpy()
    return result


def suffix_dedup(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT, with_kept: bool = True, passing: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of every (doc_id, text) row.

    ``doc_id`` is a whole number; rows without one count as one document that comes last. ``kept`` are the remaining bytes.
    ``passing`` names text columns to pass on.
    """
    parts = part_count(docs)
    # A row goes from each part to each bucket and back: fewer buckets for the short lists of anchors, more for surroundings.
    buckets, compared = parts // 4 + 1, parts // 2 + 1
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_DOC)).alias("doc"), "text", *(F.col(name).cast("string") for name in passing)
    )
    by_text = in_parts("doc", parts, "same")
    leaders = rows.select("doc", F.sha2(F.coalesce("text", F.lit("")), 256).alias("content"), text_hash().alias("same"))
    leaders = leaders.groupBy("content", "same").agg(F.min("doc").alias("doc"))
    leaders = leaders.select(by_text.alias("to_part"), F.lit(LEADER).alias("kind"), "doc").distinct()
    leaders = stored(leaders, "leaders")
    dealt = rows.withColumn("same", text_hash()).withColumn("part", by_text).drop("same")
    sent = (
        dealt.groupBy("part")
        .cogroup(leaders.groupBy("to_part"))
        .applyInPandas(lambda rows, messages: _send_anchors(rows, messages, buckets, length, anchor), ANCHORS)
    )
    repeated = sent.groupBy("bucket").applyInPandas(lambda rows: _repeated(rows, hot), MESSAGE)
    around = (
        dealt.groupBy("part")
        .cogroup(repeated.unionByName(leaders, allowMissingColumns=True).groupBy("to_part"))
        .applyInPandas(lambda rows, messages: _send_surroundings(rows, messages, buckets, compared, length, anchor), SURROUNDINGS)
    )
    answers = around.groupBy("bucket").applyInPandas(lambda rows: _compare(rows, length, anchor), MESSAGE)
    schema = RESULT + ", kept binary" * with_kept + "".join(f", `{name}` string" for name in passing)
    removed = (
        dealt.groupBy("part")
        .cogroup(repeated.unionByName(answers).unionByName(leaders, allowMissingColumns=True).groupBy("to_part"))
        .applyInPandas(lambda rows, messages: _remove(rows, messages, buckets, length, anchor, with_kept, passing), schema)
    )
    return removed.withColumn("doc_id", F.when(F.col("doc_id") != NO_DOC, F.col("doc_id")))
