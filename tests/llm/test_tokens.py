import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq

from tallyloom.llm import packing, token_counts, token_output
from tallyloom.llm.common import shared_folder
from tallyloom.llm.encoding import encoder

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def ids_of(path, text, end=None):
    ids = encoder(path).library.encode(text or "", add_special_tokens=False).ids
    return np.array(ids + ([] if end is None else [end]), "<u4")


def test_pieces_hold_every_id_once_and_sequences_have_no_gap(frame, documents):
    rows = packing.pack(frame(documents), WORD, end_id=1).collect()
    sequences, docs = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        docs.setdefault(r["doc_id"], []).append(r)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(docs) == len(documents)
    for doc, text in documents:
        want, at = ids_of(WORD, text, 1), 0
        for r in sorted(docs[doc], key=lambda r: r["start"]):
            part = want[at : at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids"]) == (at, len(want), part.tolist())
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
            at += r["length"]
        assert at == len(want)
    total = sum(r["length"] for r in rows)
    assert total > 0.95 * 2048 * (len(sequences) - 8)  # each of eight tasks may leave one window open


def test_rows_without_an_id_and_repeated_rows_are_packed_by_themselves(frame):
    rows = [(None, "one two"), (None, "one two"), (None, "three"), (4, None), (4, "five six seven"), (4, "five six seven"), (5, "word " * 9000)]
    found = packing.pack(frame(rows), WORD, end_id=1).collect()
    want = [(doc or 0, len(ids_of(WORD, text, 1))) for doc, text in rows]
    assert sorted((r["doc_id"] or 0, r["doc_tokens"]) for r in found if r["start"] == 0) == sorted(want)
    assert sum(r["length"] for r in found) == sum(n for _, n in want)
    assert len({(r["sequence_id"], r["offset"]) for r in found}) == len(found)


def test_differencing_balances_and_adds_windows():
    sizes = [8, 7, 6, 5, 4]
    assert sorted(sum(sizes[i] for i in items) for items in packing.differencing(sizes, 2)) == [14, 16]
    assert len(packing.balanced([6, 6, 6], 10)) == 3  # the sum asks for two, the capacity for three
    assert packing.balanced([], 10) == []
    many = [(37 * i) % 500 + 1 for i in range(600)]
    found = packing.balanced(many, 2048)
    assert sorted(i for items in found for i in items) == list(range(600))
    assert max(sum(many[i] for i in items) for items in found) <= 2048
    assert len(found) <= -(-sum(many) // 2048) + 1


def test_packing_of_nothing(frame):
    assert packing.pack(frame([]), WORD, end_id=1).count() == 0


def test_counts_come_from_the_cache_on_the_second_call(spark, frame, documents, monkeypatch):
    cache = shared_folder(spark, "cache")
    want = sorted((doc, len((text or "").encode()), len(ids_of(BYTE, text))) for doc, text in documents)
    assert sorted(tuple(r) for r in token_counts.token_counts(frame(documents), BYTE, cache).collect()) == want
    stored = spark.read.parquet(cache).count()
    assert stored == len({text or "" for _, text in documents})
    again = [*documents, (900, "new text"), (900, "new text"), (None, "new text")]
    found = token_counts.token_counts(frame(again), BYTE, cache).collect()
    assert len(found) == len(again)
    assert spark.read.parquet(cache).count() == stored + 1
    assert token_counts.token_counts(frame([]), BYTE, shared_folder(spark, "none")).count() == 0


def test_ids_are_read_back_in_order(spark, frame, documents):
    path = shared_folder(spark, "ids")
    token_output.write_ids(frame(documents), BYTE, 0, path)
    rows = token_output.read_ids(spark, path)
    crc = {r["doc_id"]: r["ids_crc32"] for r in token_output.checksums(rows).collect()}
    start = 0
    found = {r["doc_id"]: r for r in rows.collect()}
    for doc, text in sorted(documents):
        want = ids_of(BYTE, text, 0)
        assert (found[doc]["start"], found[doc]["n_tokens"], found[doc]["ids"]) == (start, len(want), want.tolist())
        assert crc[doc] == zlib.crc32(want.tobytes())
        start += len(want)


def test_rows_that_share_an_id_or_have_none_spread_and_keep_their_ids(spark, frame):
    texts = [f"text {i} " * (i % 7) for i in range(400)]
    rows = [(None, t) for t in texts] + [(3, t) for t in texts] + [(3, texts[5])] * 3 + [(4, None), (4, ""), (5, "word " * 60_000)]
    path = shared_folder(spark, "ids")
    token_output.write_ids(frame(rows), BYTE, 0, path)
    found = token_output.read_ids(spark, path).orderBy("start").collect()
    at = 0
    for r in found:
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]))
        at += r["n_tokens"]
    assert [r["doc_id"] or 0 for r in found] == sorted(doc or 0 for doc, _ in rows)
    assert sorted((r["doc_id"] or 0, r["ids"]) for r in found) == sorted((doc or 0, ids_of(BYTE, text, 0).tolist()) for doc, text in rows)
    parts = spark.read.parquet(path).filter("doc_id IS NULL").select("part").distinct().count()
    assert parts > 1


def test_file_format(spark, frame, documents):
    path = shared_folder(spark, "ids")
    token_output.write_ids(frame(documents).coalesce(1), BYTE, 0, path)
    files = [f for f in spark.read.parquet(path).inputFiles()]
    group = pq.ParquetFile(files[0].removeprefix("file://")).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert columns["ids.list.element"].has_dictionary_page and columns["ids.list.element"].has_offset_index
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    empty = shared_folder(spark, "ids")
    token_output.write_ids(frame([]), BYTE, 0, empty)
    assert token_output.read_ids(spark, empty).count() == 0
