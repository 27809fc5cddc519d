"""Web archives: WARC records in ZIP packages, written by tasks and read back by ranges.

A package is a ZIP file whose members are stored without compression:
``archive/data.warc.gz`` (each record a gzip member of its own), ``indexes/index.cdxj``
(a line for each record: key, time, and JSON with offset, length, digest and target) and
``datapackage.json``. ZIP64 records are written where a size or offset needs them, or
always with ``zip64=True``.

**Reading.** The end of the central directory is found in the last bytes of a package,
through its ZIP64 locator where there is one; the central directory gives the members;
a stored member's bytes follow its local header. The index is read by its range and gives
the records' ranges; ranges that follow each other are read together, a bounded number of
bytes at a time. Nothing is extracted to a file.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes that with the least id
is a ``response``, and the others are ``revisit`` records, without payload, that refer to it.

Files go to the shared folder through ``pyarrow.fs``, so local, HDFS and object stores
work alike. A task writes to a name of its own attempt and then moves the file to its
final name, so a task that is run again, or twice, leaves one complete package.

Defined cases: a null payload is the empty payload; records that repeat both payload and
id are one capture, so all of them are responses where it is; null ids are the largest,
and a payload that only null ids have is a response in each; an empty table gives no
packages and no rows; very long payloads are a package of their own at most; other
columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import arrow_map, checkpointed, shared_dir, slices, small_enough

REVISIT_BYTES = 100
PACKAGE_BYTES = 32 << 20  # of compressed records, but for one record that alone has more
READ_BYTES = 4 << 20  # of records read at once, but for one longer record
BROADCAST_ROWS = 500_000
DATE = "2024-01-01T00:00:00Z"
_DATA, _INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# Signatures and markers of the ZIP format.
_LOCAL, _CENTRAL, _END, _END64, _LOCATOR64 = (
    0x04034B50,
    0x02014B50,
    0x06054B50,
    0x06064B50,
    0x07064B50,
)
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF


# -- ZIP


def zip_package(members: list[tuple[str, bytes]], zip64: bool = False) -> Iterator[bytes]:
    """The bytes of a ZIP file with ``members`` stored, part by part."""
    at, entries = 0, []
    for name, data in members:
        raw, crc, size = name.encode(), zlib.crc32(data), len(data)
        wide = zip64 or size >= _FULL32
        extra = struct.pack("<HHQQ", 1, 16, size, size) if wide else b""
        short = _FULL32 if wide else size
        head = struct.pack(
            "<IHHHHHIIIHH", _LOCAL, 45 if wide else 20, 0x800, 0, 0, 0x21, crc, short, short, len(raw), len(extra)
        )
        yield head + raw + extra
        yield data
        entries.append((raw, crc, size, at))
        at += len(head) + len(raw) + len(extra) + size
    start = at
    for raw, crc, size, offset in entries:
        wide = zip64 or size >= _FULL32 or offset >= _FULL32
        extra = struct.pack("<HHQQQ", 1, 24, size, size, offset) if wide else b""
        short, where = (_FULL32, _FULL32) if wide else (size, offset)
        entry = struct.pack(
            "<IHHHHHHIIIHHHHHII",
            _CENTRAL, 45, 45 if wide else 20, 0x800, 0, 0, 0x21, crc, short, short,
            len(raw), len(extra), 0, 0, 0, 0, where,
        )
        yield entry + raw + extra
        at += len(entry) + len(raw) + len(extra)
    n, size = len(entries), at - start
    if zip64 or n >= _FULL16 or start >= _FULL32:
        yield struct.pack("<IQHHIIQQQQ", _END64, 44, 45, 45, 0, 0, n, n, size, start)
        yield struct.pack("<IIQI", _LOCATOR64, 0, at, 1)
        n, size, start = _FULL16, _FULL32, _FULL32
    yield struct.pack("<IHHHHIIH", _END, 0, 0, n, n, size, start, 0)


@dataclass(frozen=True)
class Member:
    name: str
    offset: int  # of the local header
    size: int
    stored: bool


class ZipReader:
    """Members of a ZIP file by ranges; ``file`` has ``size()`` and ``read_at(n, offset)``."""

    def __init__(self, file: pa.NativeFile):
        self.file = file
        size = file.size()
        tail_at = max(0, size - 65_557)
        tail = self.read(tail_at, size - tail_at)
        end = tail.rfind(struct.pack("<I", _END))
        # The comment of the true end record runs to the end of the file.
        while end >= 0 and (
            end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)
        ):
            end = tail.rfind(struct.pack("<I", _END), 0, end)
        if end < 0:
            raise ValueError("not a ZIP file")
        count, length, start = struct.unpack_from("<HII", tail, end + 10)
        if (count == _FULL16 or length == _FULL32 or start == _FULL32) and end >= 20:
            mark, _, where, _ = struct.unpack_from("<IIQI", tail, end - 20)
            if mark == _LOCATOR64:
                record = self.read(where, 56)
                if struct.unpack_from("<I", record)[0] != _END64:
                    raise ValueError("broken ZIP64 end record")
                count, length, start = struct.unpack_from("<QQQ", record, 32)
        self.members = dict(self._central(self.read(start, length), count))

    def read(self, offset: int, length: int) -> bytes:
        data = self.file.read_at(length, offset)
        if len(data) != length:
            raise ValueError("the file ends too early")
        return bytes(data)

    @staticmethod
    def _central(data: bytes, count: int) -> Iterator[tuple[str, Member]]:
        at = 0
        for _ in range(count):
            if struct.unpack_from("<I", data, at)[0] != _CENTRAL:
                raise ValueError("broken central directory")
            (method,) = struct.unpack_from("<H", data, at + 10)
            packed, size, n, extra, comment = struct.unpack_from("<IIHHH", data, at + 20)
            (offset,) = struct.unpack_from("<I", data, at + 42)
            name = data[at + 46 : at + 46 + n].decode()
            field, end = at + 46 + n, at + 46 + n + extra
            while field + 4 <= end:
                kind, length = struct.unpack_from("<HH", data, field)
                if kind == 1:
                    # Only the values that the entry has no room for, in this order.
                    wide = list(struct.unpack_from(f"<{length // 8}Q", data, field + 4))
                    size = wide.pop(0) if size == _FULL32 else size
                    packed = wide.pop(0) if packed == _FULL32 else packed
                    offset = wide.pop(0) if offset == _FULL32 else offset
                field += 4 + length
            yield name, Member(name, offset, packed, method == 0)
            at = end + comment

    def start_of(self, name: str) -> int:
        """Where the bytes of a stored member begin."""
        member = self.members[name]
        if not member.stored:
            raise ValueError(f"{name} is not stored")
        mark, n, extra = struct.unpack("<I22xHH", self.read(member.offset, 30))
        if mark != _LOCAL:
            raise ValueError("broken local header")
        return member.offset + 30 + n + extra


# -- WARC


def _record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", compresslevel=1, mtime=0)


def _digest(payload: bytes) -> str:
    return "sha256:" + base64.b32encode(hashlib.sha256(payload).digest()).decode().rstrip("=")


def _hex(digest: str) -> str:
    base = digest.removeprefix("sha256:")
    return base64.b32decode(base + "=" * (-len(base) % 8)).hex()


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields, with lower-case names, and the block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines[1:])}
    return fields, rest[: int(fields["content-length"])]


def payload_of(block: bytes) -> bytes:
    return block.partition(b"\r\n\r\n")[2]


def _line(value: str | None) -> str:
    """A header value: no line breaks."""
    return " ".join((value or "").split()) or "about:blank"


# -- writing


def _open(root: str) -> tuple[fs.FileSystem, str]:
    if "://" not in root and not root.startswith("file:"):
        return fs.LocalFileSystem(), root
    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(root)


def write_packages(
    pages: DataFrame,
    root: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    package_bytes: int = PACKAGE_BYTES,
    zip64: bool = False,
) -> DataFrame:
    """Write all pages to packages under ``root``; ``path`` and ``records`` of each package."""
    source = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("string").cast("binary"), F.lit("").cast("binary")).alias("payload"),
    ).withColumn("sha", F.unhex(F.sha2("payload", 256)))
    same = source.select("page_id", "sha").filter(F.length("payload") >= REVISIT_BYTES)
    same = same.groupBy("sha").agg(F.count("*").alias("n"), F.min("page_id").alias("first"))
    same = checkpointed(same.filter("n > 1 and first is not null").select("sha", "first"))
    rows = source.join(small_enough(same, BROADCAST_ROWS), "sha", "left").select(
        "page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers")
    )
    stem = uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _open(root)
        context = TaskContext.get()
        part, count = context.partitionId(), 0
        data, lines, size = [], [], 0

        def close() -> pa.RecordBatch:
            name = f"{folder}/part-{part:06d}-{count:04d}.wacz"
            index = "\n".join(sorted(lines)).encode()
            about = json.dumps({"profile": "data-package", "resources": [_DATA, _INDEX]}).encode()
            members = [(_DATA, b"".join(data)), (_INDEX, index), ("datapackage.json", about)]
            attempt = f"{name}.{context.taskAttemptId()}.{stem}"
            store.create_dir(folder, recursive=True)
            with store.open_output_stream(attempt) as out:
                for piece in zip_package(members, zip64):
                    out.write(piece)
            store.move(attempt, name)
            return pa.RecordBatch.from_pydict(
                {"path": [f"{root}/{name.rsplit('/', 1)[1]}"], "records": pa.array([len(lines)], pa.int64())}
            )

        for whole in batches:
            for batch in slices(whole, "payload", 4 << 20):
                for row in batch.to_pylist():
                    payload, url = row["payload"], _line(row["url"])
                    digest, number = _digest(payload), size
                    page = "" if row["page_id"] is None else str(row["page_id"])
                    fields = [
                        ("WARC-Record-ID", f"<urn:uuid:{uuid_of(part, count, len(lines))}>"),
                        ("WARC-Date", DATE),
                        ("WARC-Target-URI", url),
                        ("WARC-Payload-Digest", digest),
                        ("X-Page-ID", page),
                    ]
                    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
                    if row["refers"] is None:
                        kind, block = "response", head + payload
                    else:
                        kind, block = "revisit", head
                        fields += [
                            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                            ("X-Refers-To-Page-ID", str(row["refers"])),
                        ]
                    record = _record(kind, [*fields, ("Content-Type", "application/http; msgtype=response")], block)
                    data.append(record)
                    note = {"url": url, "digest": digest, "filename": "data.warc.gz", "offset": str(number), "length": str(len(record))}
                    lines.append(f"{_key(url)} 20240101000000 {json.dumps(note)}")
                    size += len(record)
                    if size >= package_bytes:
                        yield close()
                        count += 1
                        data, lines, size = [], [], 0
        if lines:
            yield close()

    return arrow_map(rows, run, "path string, records bigint")


def uuid_of(part: int, count: int, number: int) -> str:
    name = hashlib.sha256(f"{part}.{count}.{number}".encode()).hexdigest()
    return f"{name[:8]}-{name[8:12]}-4{name[13:16]}-8{name[17:20]}-{name[20:32]}"


def _key(url: str) -> str:
    """A sortable key: host parts backwards, then the path."""
    rest = url.split("://", 1)[-1].replace(" ", "%20")
    host, _, path = rest.partition("/")
    return ",".join(reversed(host.lower().split("."))) + ")/" + path


# -- reading


def records_of(file: pa.NativeFile, read_bytes: int = READ_BYTES) -> Iterator[tuple[dict[str, str], bytes]]:
    """All records of a package, located by its index and read by ranges."""
    package = ZipReader(file)
    base = package.start_of(_DATA)
    index = package.read(package.start_of(_INDEX), package.members[_INDEX].size).decode()
    ranges = []
    for line in index.split("\n"):
        if line:
            note = json.loads(line.split(" ", 2)[2])
            ranges.append((int(note["offset"]), int(note["length"])))
    ranges.sort()
    at = 0
    while at < len(ranges):
        first, upto = ranges[at][0], at
        while upto < len(ranges) and (
            upto == at
            or (ranges[upto][0] == sum(ranges[upto - 1]) and sum(ranges[upto]) - first <= read_bytes)
        ):
            upto += 1
        data = package.read(base + first, sum(ranges[upto - 1]) - first)
        for offset, length in ranges[at:upto]:
            yield parse_record(gzip.decompress(data[offset - first : offset - first + length]))
        at = upto


def read_packages(packages: DataFrame) -> DataFrame:
    """``page_id, url, record_type, payload, payload_digest, refers_to`` of each record of
    ``packages (path)``; the digest is SHA-256 in hex, of a revisit that of the full payload."""
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("record_type", pa.string()),
            ("payload", pa.binary()),
            ("payload_digest", pa.string()),
            ("refers_to", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, name = _open(path)
                rows, size = [], 0
                with store.open_input_file(name) as file:
                    for fields, block in records_of(file):
                        page, refers = fields["x-page-id"], fields.get("x-refers-to-page-id")
                        kind = fields["warc-type"]
                        payload = payload_of(block) if kind == "response" else None
                        if payload is not None and _digest(payload) != fields["warc-payload-digest"]:
                            raise ValueError(f"broken payload in {path}")
                        rows.append(
                            {
                                "page_id": int(page) if page else None,
                                "url": fields["warc-target-uri"],
                                "record_type": kind,
                                "payload": payload,
                                "payload_digest": _hex(fields["warc-payload-digest"]),
                                "refers_to": int(refers) if refers else None,
                            }
                        )
                        size += len(payload or b"")
                        if size >= READ_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    spread = packages.select("path").repartition(packages.count() or 1, "path")
    return arrow_map(
        spread,
        run,
        "page_id bigint, url string, record_type string, payload binary, payload_digest string, "
        "refers_to bigint",
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    root = f"{shared_dir(spark)}/packages-{uuid4().hex}"
    # Writing is done once here; its result is the list of packages.
    packages = checkpointed(write_packages(pages, root))
    records = read_packages(packages).select(
        "page_id",
        F.length("payload").cast("long").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )
    records = checkpointed(records)
    # A revisit has as many bytes as the response it refers to.
    responses = records.filter("record_type = 'response'")
    revisits = records.filter("record_type = 'revisit'").drop("payload_bytes")
    full = responses.select(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes")
    full = full.dropDuplicates(["refers_to", "payload_digest"])
    found = revisits.join(full, ["refers_to", "payload_digest"])
    return responses.unionByName(found.select(responses.columns))


OP4_SQL = """
with p as (
  select page_id, coalesce(html, '') as payload, octet_length(encode(coalesce(html, ''))) as n
  from pages
), f as (
  select *, min(page_id) over (partition by payload) as first from p
)
select page_id,
       cast(n as bigint) as payload_bytes,
       sha256(payload) as payload_digest,
       case when n < 100 or page_id is not distinct from first then 'response' else 'revisit' end as record_type,
       case when n < 100 or page_id is not distinct from first then null else first end as refers_to
from f
"""
