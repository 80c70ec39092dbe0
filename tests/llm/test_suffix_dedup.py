import hashlib
import random

import numpy as np
import pytest

from tallyloom.llm.queries import QUERIES
from tallyloom.llm.suffix_dedup import SuffixSort, suffix_dedup


def brute(rows, length):
    first, out = {}, {}
    data = sorted((doc, (text or "").encode()) for doc, text in rows)
    for doc, text in data:
        for i in range(len(text) - length + 1):
            first.setdefault(text[i : i + length], doc)
    for doc, text in data:
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if first[text[i : i + length]] < doc:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(text, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc] = (len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [50_000, 20, 0])  # 20: frequent anchors are dealt string by string; 0: all are
def test_removed_bytes(frame, documents, hot):
    found = suffix_dedup(frame(documents), hot=hot).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found} == brute(documents, 50)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in found)


def test_long_text_across_blocks(frame):
    rnd = random.Random(3)
    long = "".join(rnd.choice("abcdefgh \n") for _ in range(1_300_000))
    cut = (1 << 20) - 40
    rows = [(1, long), (2, "x" * 30 + long[cut : cut + 200] + "y" * 30), (3, long[cut + 20 : cut + 69])]
    found = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in suffix_dedup(frame(rows)).collect()}
    assert found == {1: (0, 0), 2: (200, 1), 3: (0, 0)}


def test_empty_table_null_ids_and_repeated_rows(frame):
    assert suffix_dedup(frame([])).count() == 0
    text = "0123456789" * 6
    rows = [(7, text), (7, text), (None, text), (None, None)]
    found = sorted(((r["doc_id"] or 0), r["n_removed"]) for r in suffix_dedup(frame(rows)).collect())
    assert found == [(0, 0), (0, 60), (7, 0), (7, 0)]


def test_merge_sort_is_the_order_of_suffixes():
    rnd = random.Random(4)
    text = "".join(rnd.choice("ab") for _ in range(3000)).encode()
    sorter = SuffixSort(np.frombuffer(text, "uint8"), 50)
    starts = np.arange(len(text) - 50)
    ordered = sorter.sort(starts)
    keys = [text[i : i + 50] for i in ordered]
    assert keys == sorted(text[i : i + 50] for i in starts)
    assert len(np.unique(sorter.classes(ordered))) == len(set(keys))


def test_repeats_are_sorted_and_lone_suffixes_left_out():
    rnd = random.Random(6)
    text = "".join(rnd.choice("ab") for _ in range(700)).encode() * 2 + "".join(rnd.choice("abc") for _ in range(900)).encode()
    sorter = SuffixSort(np.frombuffer(text, "uint8"), 20)
    starts = np.arange(len(text) - 20)
    keys = [text[i : i + 20] for i in starts]
    want = sorted(key for key in keys if keys.count(key) > 1)
    ordered = sorter.sorted_repeats(starts)
    assert [text[i : i + 20] for i in ordered] == want and len(set(ordered.tolist())) == len(want)
    assert len(np.unique(sorter.classes(ordered))) == len(set(want))
    assert len(sorter.sorted_repeats(starts[:0])) == 0


def texts_around_an_anchor(n):
    """Texts with one passage in contexts of their own; some contexts return."""
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9)))
    contexts = [" ".join(word() for _ in range(12)) for _ in range(n // 3)]
    return [f"{rnd.choice(contexts)} published on a day in may by {' '.join(word() for _ in range(6))} {rnd.choice(contexts)}" for _ in range(n)]


@pytest.mark.parametrize("hot", [50_000, 100])
def test_hot_anchor(frame, hot):
    rows = list(enumerate(texts_around_an_anchor(600)))
    found = suffix_dedup(frame(rows), hot=hot).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found} == brute(rows, 50)


def test_many_rows_without_an_id_and_two_texts_under_one(spark, frame):
    texts = texts_around_an_anchor(120)
    rows = [(None, text) for text in texts[:60]] + [(5, text) for text in texts[60:90]] + list(enumerate(texts[90:], 100)) + [(None, texts[95])]
    # brute force: all rows without an id are one document behind the others, those of one id are one document
    plain = [(doc, text) for doc, text in rows if doc is not None]
    first = {}
    for doc, text in sorted(plain):
        data = text.encode()
        for i in range(len(data) - 49):
            first.setdefault(data[i : i + 50], doc)
    want = []
    for doc, text in rows:
        data, gone = text.encode(), bytearray(len(text.encode()))
        for i in range(len(data) - 49):
            if first.get(data[i : i + 50], float("inf")) < (float("inf") if doc is None else doc):
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        want.append((doc, sum(gone), hashlib.sha256(kept).hexdigest()))
    found = [(r["doc_id"], r["n_removed"], r["kept_sha256"]) for r in suffix_dedup(frame(rows)).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_query(spark, tmp_path, documents):
    spark.createDataFrame(documents, "doc_id long, text string").selectExpr("*", "'x' AS part").write.parquet(f"{tmp_path}/documents.parquet")
    df = QUERIES["op1_suffix_dedup"](spark, str(tmp_path))
    assert df.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string")]
    assert {r[0]: tuple(r)[1:] for r in df.collect()} == brute(documents, 50)
