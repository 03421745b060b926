"""WARC archives: written with one gzip member per record, read back as a stream.

``write_archives`` turns rows into archives in a shared folder. Each task writes its own files;
a file's name holds the attempt, and only the files of attempts that Spark committed are in the
manifest, so a repeated or lost task leaves at most a file that nobody reads.

``read_archives`` reads every archive once from its start: gzip members are decompressed in
small steps, a record ends where its Content-Length says, and block and payload digests are
computed on the way and compared. A truncated or altered archive fails the job, naming the
archive and the offset. No record need fit into memory unless its payload is asked for.

Folders are opened through ``pyarrow.fs``, so they may be local to all (a mounted file system)
or a store that it knows by its URI.

Edge cases: a null payload is an empty one; a null id or URI is left out of the record and read
back as null; a null id is neither referred to nor a revisit; rows repeated with their id
are written as often as they come, each a response if the id is its group's largest; an empty
table gives no archive and no row; other columns of the table are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import broadcast_if_few, own_columns, stored

ARCHIVE_BYTES = 64_000_000  # a task begins another archive beyond so many bytes
READ_BYTES = 1 << 16  # how much of an archive is decompressed at a time
ROWS_PER_BATCH = 1000
BATCH_BYTES = 8_000_000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST_SCHEMA = "path string, records long, bytes long"
RECORD_SCHEMA = (
    "record_type string, page_id long, url string, payload_bytes long, payload_digest string, "
    "refers_to long, payload binary"
)
_RECORD_FIELDS = pa.schema(
    [
        ("record_type", pa.string()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _base32(sha1) -> str:
    return base64.b32encode(sha1.digest()).decode()


def _urn(page_id: int) -> str:
    return f"<urn:x-page:{page_id}>"


def record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None
) -> bytes:
    """One record, not compressed: a response, or a revisit if it refers to another page."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{_base32(hashlib.sha1(payload))}"),
        ("WARC-Block-Digest", f"sha1:{_base32(hashlib.sha1(block))}"),
    ]
    if page_id is not None:
        fields.append(("WARC-Record-ID", _urn(page_id)))
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="")))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(rows: DataFrame, root: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows of (page_id, url, payload, refers_to) below ``root``; returns the manifest."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(root)
        store.create_dir(folder, recursive=True)
        task = TaskContext.get()
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        made, out = [], None
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to"))):
                page_id, url, payload, refers_to = (cell.as_py() for cell in row)
                if out is None:
                    made.append([f"{name}-{len(made):04d}.warc.gz", 0, 0])
                    out = store.open_output_stream(f"{folder}/{made[-1][0]}")
                member = _member(record(page_id, url, payload or b"", refers_to))
                out.write(member)
                made[-1][1] += 1
                made[-1][2] += len(member)
                if made[-1][2] >= archive_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        if made:
            names, counts, sizes = map(list, zip(*made))
            paths = [f"{root}/{x}" for x in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
                ["path", "records", "bytes"],
            )

    rows = own_columns(rows, "page_id", "url", "payload", "refers_to")
    return stored(rows.mapInArrow(write, MANIFEST_SCHEMA), "manifest")


class BrokenArchive(ValueError):
    """An archive whose framing or digests are wrong."""


class _Members:
    """The decompressed bytes of an archive, member by member."""

    def __init__(self, stream, where: str):
        self.stream, self.where = stream, where
        self.raw, self.raw_at, self.buffer = b"", 0, bytearray()
        self.unpacker = None

    def fail(self, what: str) -> BrokenArchive:
        return BrokenArchive(f"{self.where}, near byte {self.raw_at}: {what}")

    def _fill(self) -> bool:
        if not self.raw:
            self.raw = self.stream.read(READ_BYTES)
            self.raw_at += len(self.raw)
        return bool(self.raw)

    def next_member(self) -> bool:
        """Go to the next member; False at the end of the archive."""
        if not self._fill():
            return False
        self.unpacker = zlib.decompressobj(31)
        return True

    def more(self) -> bool:
        """Decompress some more of this member; False at its end."""
        if self.unpacker.eof:
            return False
        if not self._fill():
            raise self.fail("ends inside a record")
        try:
            # Bounded output: a small member may unpack to a very long text.
            self.buffer += self.unpacker.decompress(self.raw, 4 * READ_BYTES)
        except zlib.error as error:
            raise self.fail(f"bad gzip data ({error})") from None
        self.raw = self.unpacker.unconsumed_tail or self.unpacker.unused_data
        if not self.raw and not self.unpacker.eof:
            # What the bound held back inside the decompressor comes out with no input.
            while held := self.unpacker.decompress(b"", 4 * READ_BYTES):
                self.buffer += held
        return True

    def until(self, mark: bytes) -> bytes:
        """The bytes up to ``mark``, which is skipped."""
        at = self.buffer.find(mark)
        while at < 0:
            # However long a header is; what was looked at isn't looked at again.
            seen = max(len(self.buffer) - len(mark) + 1, 0)
            if not self.more():
                raise self.fail("a header does not end")
            at = self.buffer.find(mark, seen)
        taken = bytes(self.buffer[:at])
        del self.buffer[: at + len(mark)]
        return taken

    def pieces(self, length: int) -> Iterator[bytes]:
        """The next ``length`` bytes in pieces."""
        while length:
            if not self.buffer and not self.more():
                raise self.fail("a record is shorter than its Content-Length")
            piece = bytes(self.buffer[:length])
            del self.buffer[: len(piece)]
            length -= len(piece)
            if piece:
                yield piece


def _fields(head: bytes, first: bytes, members: _Members) -> dict[str, str]:
    lines = head.split(b"\r\n")
    if not lines[0].startswith(first):
        raise members.fail(f"no {first.decode()} line")
    pairs = (line.decode().partition(":") for line in lines[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _page(urn: str | None) -> int | None:
    return None if urn is None else int(urn.removeprefix("<urn:x-page:").removesuffix(">"))


def records(stream, where: str, payloads: bool = False) -> Iterator[tuple]:
    """The records of one archive in order, as RECORD_SCHEMA has them."""
    from urllib.parse import unquote

    members = _Members(stream, where)
    while members.next_member():
        fields = _fields(members.until(b"\r\n\r\n"), b"WARC/", members)
        left = int(fields["content-length"])
        block, payload, kept, size = hashlib.sha1(), hashlib.sha1(), [], 0
        http = bytearray()  # until its header is complete
        http_fields = None
        for piece in members.pieces(left):
            block.update(piece)
            if http_fields is None:
                http += piece
                if (at := http.find(b"\r\n\r\n")) < 0:
                    continue
                http_fields = _fields(bytes(http[:at]), b"HTTP/", members)
                piece = bytes(http[at + 4 :])
            payload.update(piece)
            size += len(piece)
            if payloads:
                kept.append(piece)
        if http_fields is None:
            raise members.fail("a block without an HTTP header")
        while members.more():
            pass
        if bytes(members.buffer) != b"\r\n\r\n":
            raise members.fail("a record is longer than its Content-Length")
        members.buffer.clear()
        if fields["warc-block-digest"] != f"sha1:{_base32(block)}":
            raise members.fail("the block digest differs")
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        revisit = fields["warc-type"] == "revisit"
        if not revisit and digest != _base32(payload):
            raise members.fail("the payload digest differs")
        if not revisit and int(http_fields["content-length"]) != size:
            raise members.fail("the payload's length differs")
        url = fields.get("warc-target-uri")
        yield (
            fields["warc-type"],
            _page(fields.get("warc-record-id")),
            None if url is None else unquote(url),
            int(http_fields["content-length"]),
            digest,
            _page(fields.get("warc-refers-to")),
            b"".join(kept) if payloads and not revisit else None,
        )


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """All records of the archives whose ``path`` is in the manifest."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_stream(name) as stream:
                    rows, held = [], 0
                    for row in records(stream, path, payloads):
                        rows.append(row)
                        held += len(row[-1] or b"")
                        if len(rows) == ROWS_PER_BATCH or held > BATCH_BYTES:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    paths = manifest.select("path")
    tasks = max(1, manifest.sparkSession.sparkContext.defaultParallelism)
    return paths.repartition(max(tasks, paths.count()), "path").mapInArrow(read, RECORD_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array(x, f.type) for x, f in zip(zip(*rows), _RECORD_FIELDS)]
    return pa.RecordBatch.from_arrays(arrays, schema=_RECORD_FIELDS)


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` as (page_id, url, payload, refers_to), ready to be written.

    Of pages with equal payloads of at least ``least_bytes`` bytes, that with the largest id is
    the response and the others refer to it. Payloads are equal if length and SHA-1 are. Only ids
    and digests are grouped; the pages themselves are shuffled only if there are too many
    revisits to broadcast.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = own_columns(pages, "page_id", "url", "html").select(
        "page_id", "url", payload.alias("payload"), F.sha1(payload).alias("_sha1")
    )
    keys = stored(rows.select("page_id", "_sha1", F.octet_length("payload").alias("_n")), "digests")
    keepers = (
        keys.where(F.col("_n") >= least_bytes)
        .groupBy("_sha1", "_n")
        .agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("_least"))
        .where(F.col("_least") < F.col("refers_to"))
        .drop("_least")
    )
    revisits = stored(
        keys.join(keepers, ["_sha1", "_n"])
        .where(F.col("page_id") < F.col("refers_to"))
        .select("page_id", "_sha1", "refers_to")
        .distinct(),
        "revisits",
    )
    return rows.join(broadcast_if_few(revisits), ["page_id", "_sha1"], "left").drop("_sha1")
