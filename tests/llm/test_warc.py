import hashlib
import io
import random
import zlib

import pytest

from tallyloom.llm import warc
from tallyloom.llm.common import shared_folder


class File(io.BytesIO):
    def read_at(self, length, offset):
        self.seek(offset)
        return self.read(length)


def records(pages):
    return [warc.record(i, f"http://x/{i}", p, hashlib.sha256(p).hexdigest(), None) for i, p in enumerate(pages)]


def read(data):
    found = list(warc.salvaged(warc.Bytes(File(data), len(data))))
    at = 0
    for offset, length, _ in found:  # no hole, no overlap
        assert offset == at
        at += length
    assert at == len(data)
    return [one if isinstance(one, str) else warc.described(*one) for _, _, one in found]


PAGES = [b"", b"\x1f\x8b\x08 not a member", b"\r\n\r\nWARC/1.1\r\n in a page", "é".encode() * 70_000]


@pytest.mark.parametrize("pack", [warc.compressed, bytes])
def test_round_trip(pack):
    found = read(b"".join(pack(one) for one in records(PAGES)))
    assert [(f[0], f[5]) for f in found] == list(enumerate(PAGES))
    assert read(b"") == []


@pytest.mark.parametrize("damaged", [0, 1, 2, 3])
@pytest.mark.parametrize("how", ["flip", "cut", "insert"])
@pytest.mark.parametrize("pack", [warc.compressed, bytes])
def test_salvage_keeps_every_other_record(pack, damaged, how):
    stored = [pack(one) for one in records(PAGES)]
    one = bytearray(stored[damaged])
    middle = len(one) // 2
    if how == "flip":
        one[middle] ^= 0xFF
    elif how == "cut":
        one = one[:middle]
    else:
        one = one + b"rubbish between records"
    stored[damaged] = bytes(one)
    found = read(b"".join(stored))
    good = {f[0]: f[5] for f in found if not isinstance(f, str) and f[6]}
    lost = set(range(4)) - set(good)
    assert lost <= ({damaged} if how != "insert" else set())
    assert all(good[i] == PAGES[i] for i in good)
    if lost or how == "insert":
        assert any(isinstance(f, str) for f in found)


@pytest.mark.parametrize("size", [10, (1 << 20) - 100, (1 << 20) - 60, (1 << 20) - 20, 3 << 20])
def test_headers_are_searched_whole(size):
    first, second = records([b"long header", b"next"])
    line = b"X-Note: " + b"n" * size + b"\r\n"
    place = first.lower().index(b"content-length")
    long = first[:place] + line + first[place:]
    assert [f[5] for f in read(long + second)] == [b"long header", b"next"]
    assert [f[5] for f in read(warc.compressed(long) + warc.compressed(second))] == [b"long header", b"next"]


def test_every_record_of_a_member_is_read():
    stored = records(PAGES)
    found = read(warc.compressed(b"".join(stored)))
    assert [(f[0], f[5]) for f in found] == list(enumerate(PAGES))
    behind = read(warc.compressed(stored[0] + b"rubbish") + warc.compressed(stored[1]))
    assert [f if isinstance(f, str) else f[0] for f in behind] == [0, "no version line", 1]


@pytest.mark.parametrize("damaged", [0, 1, 2, 3])
def test_a_damaged_record_inside_a_member_is_the_only_loss(damaged):
    pages = [(f"page {i} " * 40_000).encode() for i in range(4)]
    stored = records(pages)
    stored[damaged] = stored[damaged].replace(b"page", b"pale", 50)
    found = read(warc.compressed(b"".join(stored)) + warc.compressed(records([b"next"])[0]))
    assert [f if isinstance(f, str) else f[0] for f in found] == [*range(damaged), "block digest differs", *range(damaged + 1, 4), 0]


def test_a_cut_member_keeps_the_records_before():
    rnd = random.Random(5)
    pages = [rnd.randbytes(50_000) for _ in range(4)]
    joined = warc.compressed(b"".join(records(pages)))
    for tail in (b"", warc.compressed(records([b"next"])[0])):
        found = read(joined[: len(joined) // 2 + 5000] + tail)
        assert [f[0] for f in found if not isinstance(f, str)] == [0, 1] + [0] * bool(tail)
        assert any(isinstance(f, str) for f in found)


@pytest.mark.parametrize("pages", [[b"a page"], PAGES, [random.Random(3).randbytes(300_000), b"last"]])
def test_records_of_a_member_with_a_wrong_checksum_are_marked(pages):
    stored = bytearray(warc.compressed(b"".join(records(pages))))
    stored[-6] ^= 1  # in the checksum; the content is whole
    found = read(bytes(stored) + warc.compressed(records([b"next"])[0]))
    assert [f if isinstance(f, str) else (*f[::5], f[6]) for f in found] == [*((i, p, False) for i, p in enumerate(pages)), "bad member", (0, b"next", True)]


def test_pages_through_archives(spark):
    copy = "<p>" + "é" * 60 + "</p>"
    rows = [(5, "u", copy), (2, "v w\n", copy), (9, None, copy), (9, None, copy), (3, "x", "short"), (4, "y", "short"), (1, "z", None), (None, "n", "q" * 200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' AS digest", "1 AS first")
    found = warc.archived(spark, pages, shared_folder(spark, "warc")).filter("gap IS NULL").collect()
    got = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in found)
    text = {page: html or "" for page, _, html in rows}
    sha = lambda page: hashlib.sha256(text[page].encode()).hexdigest()
    size = len(copy.encode())
    want = [(0, "response", None, 200, sha(None)), (1, "response", None, 0, sha(1)), (2, "response", None, size, sha(2))]
    want += [(3, "response", None, 5, sha(3)), (4, "response", None, 5, sha(4)), (5, "revisit", 2, size, sha(5))]
    assert got == want + [(9, "revisit", 2, size, sha(9))] * 2
    none = pages.limit(0)
    assert warc.archived(spark, none, shared_folder(spark, "warc")).count() == 0
