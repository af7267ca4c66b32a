"""WARC records in ZIP-packaged archives: written in parallel, and read back by ranges without extraction.

An archive is a ZIP file with the stored members ``archive/data.warc.gz`` (one gzip member for each record),
``indexes/index.cdxj`` (a line with offset and length for each record) and ``datapackage.json``. The reader parses the
end record and the central directory, with their ZIP64 forms, finds where the stored members begin, reads the index, and
then reads runs of records straight out of the archive, many tasks to an archive.

Writing: of pages with equal payloads of at least ``MIN_REVISIT`` bytes, that with the largest id becomes a response, the
others revisits that name it and carry no payload; smaller pages are all responses. The first page of a payload is a
grouped maximum; only digests are shuffled for it. Every attempt of a task writes files of its own names, and the written
manifest names those of the attempts that counted, so a lost executor leaves no half archive in the result.

Files are opened with Arrow's file systems in the folder that all executors share (``spark.checkpoint.dir``).

Defined cases: null html is an empty payload, a null URL becomes ``urn:page``. Null ids never count as the largest and
are written without an id; payloads that only such pages have are all responses. Repeated rows of the largest id are all
responses. No pages give no archive and no records. Extra columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.session import scratch_path, settle, ship_package

MIN_REVISIT = 1000
ARCHIVE_BYTES = 256_000_000  # an archive that has reached this size is closed
SPAN_BYTES = 4_000_000  # records that are read at once
LEVEL = 3

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# Archive bytes that one task reads back.
TASK_BYTES = 32_000_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- writing ---------------------------------------------------------------------------------------------------------


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    date: str = "2024-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives. Returns the manifest: path, records and bytes of each."""
    spark = pages.sparkSession
    ship_package(spark)
    folder = folder or scratch_path(spark, "archives")
    html = F.coalesce("html", F.lit(""))
    whole = pages.select(F.col("page_id").cast("long"), "url", html.alias("html"))
    digest = F.when(F.octet_length("html") >= MIN_REVISIT, F.sha1("html"))
    originals = settle(
        whole.select("page_id", digest.alias("digest"))
        .where(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & F.col("original").isNotNull())
        .select("digest", "original"),
        "original-pages",
    )
    rows = whole.withColumn("digest", digest).join(originals, "digest", "left").select(
        "page_id", "url", "html", F.when(~F.col("original").eqNullSafe(F.col("page_id")), F.col("original")).alias("of")
    )
    written = rows.mapInArrow(
        lambda batches: _write(batches, folder, date, archive_bytes), "path string, records bigint, bytes bigint"
    )
    return settle(written, "archive-manifest")


def _write(batches: Iterator[pa.RecordBatch], folder: str, date: str, limit: int) -> Iterator[pa.RecordBatch]:
    archive = None
    for batch in batches:
        for page_id, url, html, of in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            archive = archive or _Archive(folder)
            archive.add(page_id, url, html.encode(), of, date)
            if archive.size >= limit:
                yield archive.close()
                archive = None
    if archive:
        yield archive.close()


class _Sink:
    """What zipfile needs of an object store's output: it can only be written to."""

    def __init__(self, out):
        self.write, self.flush, self.closed = out.write, lambda: None, False


class _Archive:
    def __init__(self, folder: str):
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}.wacz"
        self.path, self.lines, self.size = f"{folder}/{name}", [], 0
        self.out = system.open_output_stream(f"{base}/{name}")
        self.zip = zipfile.ZipFile(_Sink(self.out), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)

    def add(self, page_id: int | None, url: str | None, payload: bytes, of: int | None, date: str) -> None:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        target = quote(url, safe=":/?#[]@!$&'()*+,;=%") if url else "urn:page"
        kind = "response" if of is None else "revisit"
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
        if of is None:
            block += payload
        fields = {
            "WARC-Type": kind,
            "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{self.path}#{len(self.lines)}')}>",
            "WARC-Date": date,
            "WARC-Target-URI": target,
            "WARC-Payload-Digest": f"sha1:{digest}",
            "WARC-Page-ID": page_id,
            "WARC-Profile": None if of is None else PROFILE,
            "WARC-Refers-To-Page-ID": of,
            "Content-Type": "application/http; msgtype=response",
            "Content-Length": len(block),
        }
        head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        record = packer.compress(f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n") + packer.flush()
        place = {"url": target, "digest": f"sha1:{digest}", "mime": "warc/revisit" if of is not None else "text/html"}
        place |= {"offset": str(self.size), "length": str(len(record)), "filename": "data.warc.gz"}
        self.lines.append(f"{target} {date} {json.dumps(place)}\n")
        self.data.write(record)
        self.size += len(record)

    def close(self) -> pa.RecordBatch:
        self.data.close()
        with self.zip.open(INDEX, "w", force_zip64=True) as member:
            for line in self.lines:
                member.write(line.encode())
        members = [{"name": DATA.split("/")[1], "path": DATA, "bytes": self.size}]
        package = {"profile": "data-package", "wacz_version": "1.1.1", "resources": members}
        self.zip.writestr("datapackage.json", json.dumps(package))
        self.zip.close()
        self.out.close()
        found = {"path": [self.path], "records": [len(self.lines)], "bytes": [self.size]}
        return pa.RecordBatch.from_pydict(found, schema=_MANIFEST)


_MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


# --- reading ---------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    method: int  # 0: stored
    packed: int
    size: int
    header: int  # where its local header is


def zip_members(file) -> list[Member]:
    """The members of a ZIP file, from its central directory. ``file`` has ``size()``, ``seek`` and ``read``."""
    count, size, start = _directory_place(file)
    raw, at, members = _read_at(file, start, size), 0, []
    for _ in range(count):
        if raw[at : at + 4] != b"PK\x01\x02":
            raise ValueError("a central directory entry is damaged")
        method = struct.unpack_from("<H", raw, at + 10)[0]
        packed, unpacked = struct.unpack_from("<II", raw, at + 20)
        name_len, extra_len, comment_len = struct.unpack_from("<HHH", raw, at + 28)
        header = struct.unpack_from("<I", raw, at + 42)[0]
        name = raw[at + 46 : at + 46 + name_len].decode("utf-8", "replace")
        extra = raw[at + 46 + name_len : at + 46 + name_len + extra_len]
        wide = iter(_wide_values(extra))
        # In this order, each only where the narrow field is full.
        unpacked, packed, header = (next(wide) if v == 0xFFFFFFFF else v for v in (unpacked, packed, header))
        members.append(Member(name, method, packed, unpacked, header))
        at += 46 + name_len + extra_len + comment_len
    return members


def member_start(file, member: Member) -> int:
    """Where the bytes of a member begin: behind its local header, whose own name and extra field may differ."""
    raw = _read_at(file, member.header, 30)
    if raw[:4] != b"PK\x03\x04":
        raise ValueError(f"no local header for {member.name}")
    name_len, extra_len = struct.unpack_from("<HH", raw, 26)
    return member.header + 30 + name_len + extra_len


def _directory_place(file) -> tuple[int, int, int]:
    """Entries, size and start of the central directory."""
    total = file.size()
    tail_at = max(0, total - 65_557)
    tail = _read_at(file, tail_at, total - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and (at + 22 > len(tail) or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("not a ZIP file")
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    end = tail_at + at
    if (count == 0xFFFF or size == 0xFFFFFFFF or start == 0xFFFFFFFF) and end >= 20:
        locator = _read_at(file, end - 20, 20)
        if locator[:4] == b"PK\x06\x07":
            record = _read_at(file, struct.unpack_from("<Q", locator, 8)[0], 56)
            if record[:4] != b"PK\x06\x06":
                raise ValueError("the ZIP64 end record is damaged")
            count, size, start = struct.unpack_from("<QQQ", record, 32)
    return count, size, start


def _wide_values(extra: bytes) -> tuple[int, ...]:
    """The 64-bit values of the ZIP64 extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            return struct.unpack_from(f"<{size // 8}Q", extra, at + 4)
        at += 4 + size
    return ()


def _read_at(file, start: int, size: int) -> bytes:
    file.seek(start)
    raw = file.read(size)
    if len(raw) != size:
        raise ValueError("the archive ends too early")
    return raw


def read_archives(archives: DataFrame, payloads: bool = True, span_bytes: int = SPAN_BYTES) -> DataFrame:
    """The records of archives named in the column ``path``, with their payloads if asked for.

    Archives of other writers are read too: any number of data members below ``archive/``, and indexes below ``indexes/``,
    gzipped or not. Records that are neither responses nor revisits come without a payload. Digests of responses are
    compared with their payloads; a difference is an error.
    """
    ship_package(archives.sparkSession)
    spans = archives.select("path").mapInArrow(
        lambda batches: _find_records(batches, span_bytes),
        "path string, start bigint, offsets array<bigint>, lengths array<bigint>",
    )
    schema = (
        "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint, payload binary"
    )
    # A row is a few numbers but stands for megabytes, so the number of tasks follows the archives' bytes, not the rows'.
    spark = archives.sparkSession
    size = archives.agg(F.sum("bytes")).first()[0] if "bytes" in archives.columns else None
    tasks = max(spark.sparkContext.defaultParallelism, -(-(size or 0) // TASK_BYTES))
    records = spans.repartition(tasks, F.xxhash64("path", "start")).mapInArrow(
        lambda batches: _read_spans(batches, payloads), schema
    )
    return records if payloads else records.drop("payload")


def _open(path: str):
    system, base = fs.FileSystem.from_uri(path)
    return system.open_input_file(base)


def _find_records(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with _open(path) as file:
                places = _indexed_places(file, path)
            spans: list[tuple[int, list[int], list[int]]] = []
            for offset, length in sorted(places):
                if not spans or offset + length - spans[-1][0] > limit:
                    spans.append((offset, [], []))
                start, offsets, lengths = spans[-1]
                offsets.append(offset - start)
                lengths.append(length)
            columns = [[path] * len(spans), *map(list, zip(*spans, strict=True))] if spans else [[], [], [], []]
            kinds = [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["path", "start", "offsets", "lengths"],
            )


def _indexed_places(file, path: str) -> list[tuple[int, int]]:
    """Where each indexed record of an archive starts in its file, and its length."""
    members = zip_members(file)
    data = {m.name.rsplit("/", 1)[1]: m for m in members if m.name.startswith("archive/") and not m.name.endswith("/")}
    indexes = [m for m in members if re.fullmatch(r"indexes/.*\.cdxj?(\.gz)?", m.name)]
    if not data or not indexes:
        raise ValueError(f"{path} has no data below archive/ or no index below indexes/")
    if any(m.method for m in (*data.values(), *indexes)):
        raise ValueError(f"the members of {path} are not stored")
    starts = {name: member_start(file, m) for name, m in data.items()}
    found = set()
    for member in indexes:
        raw = _read_at(file, member_start(file, member), member.size)
        text = gzip.decompress(raw) if member.name.endswith(".gz") else raw
        for line in text.decode().splitlines():
            if " {" not in line:
                continue
            place = json.loads(line[line.index(" {") + 1 :])
            name = place.get("filename", "").rsplit("/", 1)[-1] or next(iter(data))
            if name not in starts:
                raise ValueError(f"the index of {path} names {name}, which is not in it")
            found.add((starts[name] + int(place["offset"]), int(place["length"])))
    return list(found)


_RECORDS = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _read_spans(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start, offsets, lengths in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            with _open(path) as file:
                raw = _read_at(file, start, offsets[-1] + lengths[-1])
            rows = [parse_record(raw[o : o + n]) for o, n in zip(offsets, lengths, strict=True)]
            if not payloads:
                rows = [(*row[:-1], None) for row in rows]
            columns = map(list, zip(*rows, strict=True))
            arrays = [pa.array(c, f.type) for c, f in zip(columns, _RECORDS, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_RECORDS)


def parse_record(packed: bytes) -> tuple:
    """One gzipped record as a row of the reader."""
    head, _, rest = zlib.decompress(packed, 31).partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = _named(lines)
    kind, url = fields["warc-type"], fields.get("warc-target-uri")
    block = rest[: int(fields["content-length"])]
    if kind not in ("response", "revisit"):
        return None, url, len(block), None, kind, None, None
    http, _, payload = block.partition(b"\r\n\r\n")
    declared = _named(http.decode("utf-8", "replace").split("\r\n")[1:])
    noted = fields.get("warc-payload-digest", "")
    digest = base64.b32decode(noted.removeprefix("sha1:")).hex() if noted.startswith("sha1:") else None
    # A response's own length is what counts: other writers may have taken a transfer's coding off.
    size = int(declared["content-length"]) if kind == "revisit" and "content-length" in declared else len(payload)
    if kind == "response":
        actual = hashlib.sha1(payload).hexdigest()
        if digest not in (None, actual):
            raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
        digest = actual
    page, of = fields.get("warc-page-id"), fields.get("warc-refers-to-page-id")
    return (
        int(page) if page else None,
        url,
        size,
        digest,
        kind,
        int(of) if of else None,
        payload if kind == "response" else None,
    )


def _named(lines: list[str]) -> dict[str, str]:
    """Header fields by their names in lower case."""
    pairs = [line.partition(":") for line in lines if ":" in line]
    return {name.strip().lower(): value.strip() for name, _, value in pairs}
