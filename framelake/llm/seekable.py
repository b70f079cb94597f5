"""WARC archives as seekable Zstandard bundles.

1. Digests: a payload's SHA-1 is taken where it is read; per digest, the least page_id and the count (pre-aggregated).
   Only digests of several pages matter from here on.
2. A page whose digest another page has is joined with it (`spread.facts`): digests of very many pages come by broadcast,
   pages whose payload is their own stay where they are, the others are shuffled.
3. Each task groups its records into frames of about FRAME bytes, compresses each frame on its own, and appends them to a
   bundle, which ends with a seek table (the public seekable format: a skippable frame with sizes and checksums). A new
   bundle starts after BUNDLE bytes. Rows of the index give each record's bundle, frame, and offset within the frame.
   A bundle's name is of its task attempt, and only what a finished attempt returned is in the index, so an attempt that
   was lost leaves at most a file that nothing names.
4. Reading: a task gets bundles, reads the table at the end, then frame by frame, checks checksums and digests, and parses
   the records. `fetch` reads only the frames that hold the records asked for.

Cases: a null payload is empty, as is a missing one. A null url is written as `urn:unknown`; what a header can't hold is
percent-encoded. A page with a null page_id is a revisit if its payload has a page with an id, else a response. Rows that
share the least page_id of a payload are each a response, under the same record id. An empty table writes no bundle.
Other columns are ignored. A payload is held whole by the task that writes or reads it; all else is bounded by FRAME.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import urllib.parse
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm import spread

FRAME, BUNDLE, LEVEL = 256 << 10, 64 << 20, 3
#: Fixed values of the seekable format.
SKIPPABLE, SEEKABLE, CHECKED = 0x184D2A5E, 0x8F92EAB1, 0x80
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

INDEX = "page_id long, record_id string, path string, frame int, offset long, length long"
RECORD = "page_id long, record_id string, record_type string, target_uri string, payload_digest string, payload_bytes long, refers_to long, path string, frame int, offset long"


def record_id(page: int | None, digest: bytes) -> str:
    """A version-8 UUID of 64 bits of page_id, a bit for null, and 57 bits of the digest."""
    v = ((page or 0) & (1 << 64) - 1) << 58 | (page is None) << 57 | int.from_bytes(digest[:8]) >> 7
    return str(uuid.UUID(int=(v >> 74) << 80 | 8 << 76 | (v >> 62 & 0xFFF) << 64 | 2 << 62 | v & (1 << 62) - 1))


def page_of(record: str) -> int | None:
    """The page_id in a record id."""
    u = uuid.UUID(record).int
    v = (u >> 80) << 74 | (u >> 64 & 0xFFF) << 62 | u & (1 << 62) - 1
    page = v >> 58
    return None if v >> 57 & 1 else page - (1 << 64 if page >> 63 else 0)


def _where(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith(("file:", "/")) else (pafs.LocalFileSystem(), path)


def record(page: int | None, url: str | None, payload: bytes, digest: bytes, least: int | None, date: str = DATE) -> bytes:
    """A response, or with `least` the revisit of that page's."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if least is None else http
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if least is None else 'revisit'}", f"WARC-Record-ID: <urn:uuid:{record_id(page, digest)}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {urllib.parse.quote(url, safe=''':/?#[]@!$&'()*+,;=%~''') if url else 'urn:unknown'}", f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
    ]
    if least is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:uuid:{record_id(least, digest)}>"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Bundle:
    """Frames appended to a file; `close` adds the seek table."""

    def __init__(self, out: BinaryIO, level: int = LEVEL):
        self.out, self.zip = out, zstandard.ZstdCompressor(level=level)
        self.table: list[tuple[int, int, int]] = []
        self.size = 0

    def frame(self, data: bytes) -> int:
        got = self.zip.compress(data)
        self.out.write(got)
        self.table.append((len(got), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.size += len(data)
        return len(self.table) - 1

    def close(self) -> None:
        rows = b"".join(struct.pack("<III", *r) for r in self.table)
        foot = struct.pack("<IBI", len(self.table), CHECKED, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(rows) + len(foot)) + rows + foot)
        self.out.close()


class Frames:
    """Frames of an open file by number, found through its seek table."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.zip = file, zstandard.ZstdDecompressor()
        end = file.size()
        if end < 17:
            raise ValueError("not a seekable bundle")
        file.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE:
            raise ValueError("not a seekable bundle")
        width = 12 if flags & CHECKED else 8
        file.seek(end - 9 - n * width)
        table = file.read(n * width)
        self.rows, at = [], 0
        for size, full, *check in struct.iter_unpack("<III" if width == 12 else "<II", table):
            self.rows.append((at, size, full, check[0] if check else None))
            at += size

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, i: int) -> bytes:
        at, size, full, check = self.rows[i]
        self.file.seek(at)
        data = self.zip.decompress(self.file.read(size), max_output_size=full)
        if len(data) != full or (check is not None and xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check):
            raise ValueError(f"frame {i} is damaged")
        return data


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at an offset, and the next one's offset."""
    head = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:head].decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines)
    a = head + 4
    b = a + int(fields["Content-Length"])
    if data[b : b + 4] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    return fields, data[a:b], b + 4


def described(fields: dict[str, str], block: bytes) -> tuple[tuple, bytes | None]:
    """RECORD's columns up to refers_to, and the payload (None for a revisit). The payload must have its digest and length."""
    head, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is not what was written")
    ids = [fields[k].removeprefix("<urn:uuid:").removesuffix(">") for k in ("WARC-Record-ID", "WARC-Refers-To") if k in fields]
    return (page_of(ids[0]), ids[0], kind, fields["WARC-Target-URI"], digest, size, page_of(ids[1]) if len(ids) > 1 else None), payload if kind == "response" else None


def dated(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest (hex), `least`: the response's page_id if another page has the payload. Payloads under
    least_bytes are never looked up."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.sha1("payload"))
    alike = rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("least")).where("n > 1 AND least IS NOT NULL")
    got = spread.facts(rows, spread.stash(alike), ["digest"], "n", "least")
    return got.select("page_id", "url", "payload", "digest", F.when(F.octet_length("payload") >= least_bytes, F.col("least")).alias("least"))


def write(pages: DataFrame, folder: str, least_bytes: int = 0, frame: int = FRAME, bundle: int = BUNDLE) -> DataFrame:
    """Archives of the pages in `folder`; INDEX rows, written once."""
    spread.small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _where(folder)
        fs.create_dir(root, recursive=True)
        task = TaskContext.get()
        now: Bundle | None = None
        path, made = "", 0
        held: list[bytes] = []
        rows: list[list] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, rows, size, now
            if held:
                k = now.frame(b"".join(held))
                names = [c.split()[0] for c in INDEX.split(", ")]
                cols = list(zip(*[(p, r, path, k, o, n) for p, r, o, n in rows], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names)
                held, rows, size = [], [], 0
            if now is not None and now.size >= bundle:
                now.close()
                now = None

        for batch in batches:
            for page, url, payload, hex_, least in zip(*(batch.column(i) for i in range(5)), strict=True):
                page, least, digest, payload = page.as_py(), least.as_py(), bytes.fromhex(hex_.as_py()), payload.as_py()
                made_ = record(page, url.as_py(), payload, digest, None if least is None or least == page else least)
                if held and size + len(made_) > frame:
                    yield from flush()
                if now is None:
                    name = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{made:04d}.warc.zst"
                    path, made = f"{folder.rstrip('/')}/{name}", made + 1
                    now = Bundle(fs.open_output_stream(f"{root.rstrip('/')}/{name}", compression=None))
                rows.append([page, record_id(page, digest), size, len(made_)])
                held.append(made_)
                size += len(made_)
        yield from flush()
        if now is not None:
            now.close()

    return spread.stash(dated(pages, least_bytes).mapInArrow(run, INDEX))


def _records(rows: list[tuple], payloads: list[bytes | None] | None) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}
    spec = [c.split() for c in RECORD.split(", ")]
    cols = list(zip(*rows, strict=True)) or [()] * len(spec)
    out = [pa.array(c, kinds[k]) for c, (_, k) in zip(cols, spec, strict=True)]
    names = [n for n, _ in spec]
    return pa.RecordBatch.from_arrays([*out, pa.array(payloads, pa.binary())], [*names, "payload"]) if payloads is not None else pa.RecordBatch.from_arrays(out, names)


def _opened(path: str) -> Frames:
    fs, at = _where(path)
    return Frames(fs.open_input_file(at))


def _dealt(rows: DataFrame, n: int, *key: str) -> DataFrame:
    """rows dealt to about n tasks, which isn't changed when they turn out few."""
    return rows.repartition(max(1, min(n, 100_000)), *key)


def read(index: DataFrame, payload: bool = False) -> DataFrame:
    """RECORD rows of all records in the index's bundles, read from the files; with their payloads if asked."""
    bundles = spread.stash(index.select("path").distinct())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                frames = _opened(path)
                for i in range(len(frames)):
                    data, at, rows, bodies = frames[i], 0, [], []
                    while at < len(data):
                        fields, block, after = parse(data, at)
                        row, body = described(fields, block)
                        rows.append((*row, path, i, at))
                        bodies.append(body)
                        at = after
                    yield _records(rows, bodies if payload else None)

    return _dealt(bundles, bundles.count(), "path").mapInArrow(run, RECORD + (", payload binary" if payload else ""))


def fetch(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """RECORD rows with payloads of the index rows whose record_id is in `wanted` (record_id): only their frames are read."""
    rows = spread.stash(index.join(wanted.select("record_id").distinct().hint("shuffle_hash"), "record_id", "left_semi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames, now, data = None, (None, None), b""
        for batch in batches:
            out, bodies = [], []
            for path, frame, offset in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if path != now[0]:
                    frames = _opened(path)
                if (path, frame) != now:
                    data, now = frames[frame], (path, frame)
                fields, block, _ = parse(data, offset)
                row, body = described(fields, block)
                out.append((*row, path, frame, offset))
                bodies.append(body)
            yield _records(out, bodies)

    n = rows.select("path", "frame").distinct().count()
    return _dealt(rows.select("path", "frame", "offset"), min(n, 4 * rows.sparkSession.sparkContext.defaultParallelism), "path", "frame").sortWithinPartitions("path", "frame", "offset").mapInArrow(run, RECORD + ", payload binary")


def archive(pages: DataFrame, **kw) -> tuple[DataFrame, str]:
    """The index of new archives in the shared folder, and their folder."""
    folder = f"{spread.shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    return write(pages, folder, **kw), folder


def op11_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, _ = archive(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return read(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def oracle() -> str:
    """The same in SQL; twenty bits of a digest are five letters of hex and four of base32."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    five = "list_transform(range(0, 8), lambda g: CAST('0x' || substr(h, CAST(5 * g + 1 AS INTEGER), 5) AS BIGINT))"
    text = f"array_to_string(list_transform({five}, lambda v: array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('{letters}', CAST(((v >> s) & 31) + 1 AS INTEGER), 1)), '')), '')"
    return f"""WITH p AS (SELECT page_id, coalesce(html, '') AS x FROM pages), q AS (SELECT page_id, strlen(x) AS payload_bytes, sha1(x) AS h, min(page_id) OVER (PARTITION BY x) AS least FROM p)
        SELECT page_id, payload_bytes, {text} AS payload_digest, CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> least THEN least END AS refers_to FROM q"""
