"""WARC archives: a writer, and a reader that salvages what is left of damaged ones.

Writing: pages with equal payloads of a least size are one response, of the least page id, and revisits of it. Each task writes
archives of compressed members, one record each, and returns a manifest; only files of a stored manifest count, so a task
that ran twice leaves nothing behind that would be read.

Reading: records are checked (member checksum, version line, lengths, block digest). After a failed check the reader searches
for the next member, or in plain archives the next version line, goes on from there, and reports the bytes between as a
quarantined gap. A member may hold many records: it is inflated a chunk at a time and read like a plain archive. All its records
have its offset, and the last one its length; a gap inside it has no length. Of a damaged member those records are kept whose block
digest holds; as the damage may lie in any header, they are marked: ``verified`` is false. The member's bytes are a gap all the
same. A record is held in memory, never an archive.

A null html is an empty payload, and always a response; a null page id is kept; repeated rows are records of their own. An empty table
writes no archive. Columns other than page_id, url and html are left out.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import stored

LEAST_REVISIT = 100  # bytes
ARCHIVE_BYTES = 32 << 20  # an archive is closed when it has grown to this
CHUNK = 1 << 20
LEVEL = 4
VERSION = b"WARC/1.1\r\n"
DATE = "2024-01-01T00:00:00Z"
SINGLE = {"warc-type", "warc-record-id", "content-length"}
MEMBER = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, n_records long, n_bytes long"
RECORD = (
    "archive string, offset long, length long, gap string, page_id long, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary, verified boolean"
)


def revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Pages (page_id, url, html, digest) with ``refers_to``. Copies meet by digest without their html."""
    html = F.coalesce("html", F.lit(""))
    pages = pages.select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("digest"))
    keyed = pages.select("page_id", "digest").filter(F.octet_length("html") >= least)
    first = keyed.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    again = keyed.join(first, "digest").filter(F.col("page_id") != F.col("first")).distinct()
    again = again.withColumnsRenamed({"page_id": "again_id", "digest": "again_digest"})
    same = (F.col("page_id") == F.col("again_id")) & (F.col("digest") == F.col("again_digest"))
    return pages.join(again, same, "left").select("page_id", "url", "html", "digest", F.col("first").alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One response or revisit record. A revisit keeps the HTTP head with the length of the payload it leaves out."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (b"" if refers_to is not None else payload)
    lines = [
        "WARC-Type: " + ("response" if refers_to is None else "revisit"),
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or ""),
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return VERSION + "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def compressed(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write (page_id, url, html, digest, refers_to) rows as archives below ``folder``; returns their stored manifest."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        path, sink, n, size, done = "", None, 0, 0, []
        for rows in batches:
            for page, url, html, digest, refers in zip(*(rows.column(i) for i in range(5)), strict=True):
                if sink is None:
                    path = f"{base}/{uuid.uuid4().hex}.warc.gz"  # another try of the task writes other files
                    sink, n, size = store.open_output_stream(path, compression=None), 0, 0
                payload = html.as_py().encode("utf-8", "surrogatepass")
                data = compressed(record(page.as_py(), url.as_py(), payload, digest.as_py(), refers.as_py()))
                sink.write(data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    sink.close()
                    done.append((path, n, size))
                    sink = None
        if sink is not None:
            sink.close()
            done.append((path, n, size))
        columns = [pa.array([x[0] for x in done], pa.string()), *(pa.array([x[i] for x in done], pa.int64()) for i in (1, 2))]
        yield pa.RecordBatch.from_arrays(columns, ["path", "n_records", "n_bytes"])

    return stored(pages.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(run, MANIFEST), "warc-manifest")


class Bytes:
    """Reads any range of a file, a chunk at a time."""

    def __init__(self, file, size: int):
        self.file, self.size, self.begin, self.chunk = file, size, 0, b""

    def at(self, offset: int, length: int) -> bytes:
        if not self.begin <= offset or offset + length > self.begin + len(self.chunk):
            self.begin, self.chunk = offset, self.file.read_at(min(max(length, CHUNK), max(self.size - offset, 0)), offset)
        return self.chunk[offset - self.begin : offset - self.begin + length]

    def find(self, wanted: bytes, offset: int) -> int:
        """Where ``wanted`` comes next, or the end."""
        while offset < self.size:
            data = self.at(offset, CHUNK)
            place = data.find(wanted)
            if place >= 0:
                return offset + place
            if len(data) < len(wanted) or offset + len(data) >= self.size:
                break
            offset += len(data) - len(wanted) + 1
        return self.size


def parsed(data: bytes) -> tuple[dict[str, str], bytes, int] | str:
    """Header fields, block and length of the record that begins ``data``; or what is wrong with it."""
    if not data.startswith(b"WARC/1."):
        return "no version line"
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return "no end of header"
    fields = {}
    for line in data[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "bad header line"
        key = name.decode("latin-1").strip().lower()
        if key in fields and key in SINGLE:
            return "header runs into another record"
        fields[key] = value.decode("utf-8", "replace").strip()
    if not fields.get("content-length", "").isdigit():
        return "no length"
    stop = end + 4 + int(fields["content-length"])
    block = data[end + 4 : stop]
    if data[stop : stop + 4] != b"\r\n\r\n":
        return "record cut off" if len(data) < stop + 4 else "bad length"
    digest = fields.get("warc-block-digest", "")
    if digest.startswith("sha256:") and hashlib.sha256(block).hexdigest() != digest[7:].lower():
        return "block digest differs"
    return fields, block, stop + 4


def inflated(source: Bytes, offset: int) -> Iterator[tuple[bytes, int]]:
    """(content, stored length so far) of the compressed member at an offset, a chunk at a time; an error if it ends too early."""
    unpacker, at = zlib.decompressobj(31), offset
    while not unpacker.eof:
        data = unpacker.unconsumed_tail
        if not data:
            data = source.at(at, 64 << 10)
            at += len(data)
        before = unpacker.copy()
        try:
            out = unpacker.decompress(data, CHUNK)
        except zlib.error:
            for out in _before_damage(before, data):
                yield out, at - offset
            raise
        if not data and not out and not unpacker.eof:
            raise EOFError
        yield out, at - len(unpacker.unused_data if unpacker.eof else unpacker.unconsumed_tail) - offset


def _before_damage(unpacker, data: bytes) -> Iterator[bytes]:
    """What can be inflated of data in which an error lies, which a larger step would withhold."""
    held = bytearray()
    for i in range(len(data)):
        try:
            held += unpacker.decompress(data[i : i + 1])
        except zlib.error:
            break
        if len(held) >= CHUNK:
            yield bytes(held)
            held.clear()
    yield bytes(held)


def member(source: Bytes, offset: int) -> tuple[int, int, str]:
    """Size and stored length of the compressed member at an offset, as far as it can be read, and what is wrong with it."""
    size = length = 0
    try:
        for out, length in inflated(source, offset):  # noqa: B007
            size += len(out)
    except EOFError:
        return size, length, "member cut off"
    except zlib.error:
        return size, length, "bad member"
    return size, length, ""


class Inflated:
    """The content of a member as a file; what lies before the last place read is not held."""

    def __init__(self, source: Bytes, offset: int):
        self.source, self.offset = source, offset
        self._restart()

    def _restart(self) -> None:
        self.stream, self.begin, self.held = inflated(self.source, self.offset), 0, bytearray()

    def read_at(self, length: int, offset: int) -> bytes:
        if offset < self.begin:
            self._restart()
        while len(self.held) < offset + length - self.begin:
            try:
                out = next(self.stream, None)
            except (EOFError, zlib.error):  # the content before it has been given
                out = None
            if out is None:
                break
            self.held += out[0]
            if self.begin < offset:
                past = min(offset - self.begin, len(self.held))
                del self.held[:past]
                self.begin += past
        past = min(offset - self.begin, len(self.held))
        del self.held[:past]
        self.begin += past
        return bytes(self.held[:length])


Found = tuple[int, int, str | tuple[dict[str, str], bytes, bool]]


def salvaged(source: Bytes) -> Iterator[Found]:
    """(offset, length, record or reason of a gap) for a whole archive, in order and without holes."""
    packed = source.at(0, 3) == MEMBER or (source.at(0, 7) != b"WARC/1." and source.find(MEMBER, 0) < source.find(b"WARC/1.", 0))
    return _in_members(source) if packed else _in_plain(source)


def _in_plain(source: Bytes) -> Iterator[Found]:
    offset, gap, reason = 0, -1, ""
    while offset < source.size:
        one = _plain_record(source, offset)
        if isinstance(one, str):
            if gap < 0:
                gap, reason = offset, one
            offset = source.find(b"WARC/1.", offset + 1)
            continue
        if gap >= 0:
            yield gap, offset - gap, reason
            gap = -1
        fields, block, length = one
        yield offset, length, (fields, block, True)
        offset += length
    if gap >= 0:
        yield gap, source.size - gap, reason


def _in_members(source: Bytes) -> Iterator[Found]:
    offset, gap, reason = 0, -1, ""
    while offset < source.size:
        size, length, problem = member(source, offset) if source.at(offset, 3) == MEMBER else (0, 0, "no member")
        content = (one for _, _, one in _in_plain(Bytes(Inflated(source, offset), size)))
        if problem:
            content = _unharmed(source, offset, size)
        lead = next(content, problem or "no version line")
        one = next(content, None) if isinstance(lead, str) else lead  # a gap is followed by a record
        if one is not None:
            if gap >= 0:
                yield gap, offset - gap, reason
                gap = -1
            if lead is not one:
                yield offset, 0, lead
            for later in content:
                yield offset, 0, one
                one = later
            yield offset, 0 if problem else length, one
        if one is not None and not problem:
            offset += length
        else:
            if gap < 0:
                gap, reason = offset, problem or lead
            offset = source.find(MEMBER, offset + 1)
    if gap >= 0:
        yield gap, source.size - gap, reason


def _unharmed(source: Bytes, offset: int, size: int) -> Iterator[tuple[dict[str, str], bytes, bool]]:
    """Records of a damaged member that carry a block digest, marked as not verified: their headers have no digest."""
    for _, _, one in _in_plain(Bytes(Inflated(source, offset), size)):
        if not isinstance(one, str) and one[0].get("warc-block-digest", "").startswith("sha256:"):
            yield *one[:2], False


def _plain_record(source: Bytes, offset: int) -> tuple[dict[str, str], bytes, int] | str:
    """The record at an offset of a plain archive."""
    if source.at(offset, 7) != b"WARC/1.":
        return "no version line"
    end = source.find(b"\r\n\r\n", offset)
    length = _stated_length(source, offset, end)
    if length is None:
        return "no length"
    return parsed(source.at(offset, end - offset + 4 + length + 4))


def _stated_length(source: Bytes, begin: int, end: int) -> int | None:
    """The Content-Length of a header, searched block by block: a damaged one may go on to the end of the archive."""
    while True:
        block = source.at(begin, min(end - begin, 1 << 20))
        last = begin + len(block) >= end or not block
        found = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)", block)
        if found and (last or found.end() < len(block)):
            return int(found[1]) if len(found[1]) < 20 else None
        if last or (found and not found.start()):
            return None
        begin += found.start() if found else len(block) - 64  # a field that a block's end cuts is read again


def _page(name: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name)
    return int(found[1]) if found else None


def described(fields: dict[str, str], block: bytes, verified: bool) -> tuple | str:
    """(page_id, record_type, refers_to, payload_bytes, payload_digest, payload, verified) of a record; or what is wrong with it."""
    kind, digest = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha256:").lower()
    head, _, payload = block.partition(b"\r\n\r\n")
    page = _page(fields.get("warc-record-id", ""))
    if kind == "revisit":
        length = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)", head)
        if not length:
            return "revisit without a length"
        return page, kind, _page(fields.get("warc-refers-to", "")), int(length[1]), digest, None, verified
    if digest and hashlib.sha256(payload).hexdigest() != digest:
        return "payload digest differs"
    return page, kind, None, len(payload), digest or hashlib.sha256(payload).hexdigest(), payload, verified


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records and gaps of the archives named in a column ``path``; ``gap`` is null for a record, else the reason."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.bool_()]
        names = [one.split(" ")[0] for one in RECORD.split(", ")]

        def frame(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)], names)

        for paths in batches:
            for path in paths.column(0).to_pylist():
                store, inner = fs.FileSystem.from_uri(path)
                held, size = [], 0
                with store.open_input_file(inner) as file:
                    for offset, length, one in salvaged(Bytes(file, file.size())):
                        what = one if isinstance(one, str) else described(*one)
                        if isinstance(what, str):
                            held.append((path, offset, length, what, *[None] * 7))
                        else:
                            payload = what[5] if with_payload else None
                            held.append((path, offset, length, None, *what[:5], payload, what[6]))
                            size += len(payload or b"")
                        if len(held) >= 5000 or size >= 8 << 20:
                            yield frame(held)
                            held, size = [], 0
                if held:
                    yield frame(held)

    return manifest.select("path").mapInArrow(run, RECORD)


def archived(spark: SparkSession, pages: DataFrame, folder: str) -> DataFrame:
    """Write pages and read the archives back: records and gaps, without payloads."""
    manifest = write_archives(revisits(pages), folder)
    archives = max(manifest.count(), 1)
    return read_archives(manifest.repartition(min(archives, 4 * spark.sparkContext.defaultParallelism, 10_000)), with_payload=False)
