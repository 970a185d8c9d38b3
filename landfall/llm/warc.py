"""WARC archives as a Spark data source, and pages written into and read from them.

``spark.read.format("warc")`` (or ``read_warc``) reads WARC 1.0 and 1.1 files, plain (``.warc``) or with a gzip member a record
(``.warc.gz``). Files are planned into partitions of about ``partition_bytes``; those that are written here are cut at places that
their writer noted, others are read whole. Conditions on ``record_type`` and the other columns that
come from a record's headers are pushed down: headers are parsed first, and the block of a record that does not qualify,
or whose payload is not asked for (``payload=false``), is passed over. In a plain file that is a seek; in a gzip member the
length that writers may leave in its header (subfield ``sl``) is, and without one the member is inflated but not looked at.

Writing makes archives of up to about ``file_bytes`` in each task, with a gzip member a record and its length. Tasks write under names of
their own and the driver lists them when all are done, so tasks that were lost, repeated or broken off leave nothing that is
read. A folder without such a list, from elsewhere, is read whole.

Files are reached by ``pyarrow.fs`` from the executors: local or shared paths, ``file:``, ``hdfs:``, ``s3a:`` and ``gs:``. One record is
held in memory at a time. A file that is no WARC file or ends within a record raises an error with its place.

``page_records`` makes records of pages. Of pages with equal payloads (the HTML in UTF-8, null: empty) the one of least ``page_id`` is a
response and the others are revisits that refer to it, without a payload of their own; rows that share the least ``page_id`` are all
responses, and so are all pages where none has an id; pages without an id revisit those with one. Payloads of fewer than
``least_bytes`` are all responses. Control characters and blanks in a URL are percent-encoded, a null URL is left out. Further columns are ignored; no
rows give an archive without records.
"""

import json
import operator
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, datasource as ds, functions as F
from pyspark.sql.types import StructType

from landfall.llm.tables import stored

LEAST_BYTES = 0
FILE_BYTES = 1 << 30
PARTITION_BYTES = 32 << 20
# So far apart are the places at which a file may be cut for reading.
MARK_BYTES = 8 << 20
LEVEL = 6
CHUNK = 1 << 16

RECORD = (
    "record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, "
    "content_type string, payload_bytes long, headers map<string,string>, http_headers map<string,string>, payload binary, archive string, at long"
)
_NAMES = [c.split()[0] for c in RECORD.split(", ")]
_MAP = pa.map_(pa.string(), pa.string())
_TYPES = {"payload_bytes": pa.int64(), "at": pa.int64(), "headers": _MAP, "http_headers": _MAP, "payload": pa.binary()}
_SCHEMA = pa.schema([(n, _TYPES.get(n, pa.string())) for n in _NAMES])

# Named fields of the format and the columns that they fill.
FIELDS = {
    "warc-type": "record_type",
    "warc-record-id": "record_id",
    "warc-target-uri": "target_uri",
    "warc-date": "date",
    "warc-refers-to": "refers_to",
    "warc-payload-digest": "payload_digest",
    "content-type": "content_type",
}
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http"
PAGE, FIRST_PAGE = "page-id", "refers-to-page-id"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path there."""
    if re.match(r"file:/+", path):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


# --- predicates -----------------------------------------------------------------------------

_COMPARE: dict[type, Callable] = {
    ds.EqualTo: operator.eq,
    ds.GreaterThan: operator.gt,
    ds.GreaterThanOrEqual: operator.ge,
    ds.LessThan: operator.lt,
    ds.LessThanOrEqual: operator.le,
    ds.StringStartsWith: str.startswith,
    ds.StringEndsWith: str.endswith,
    ds.StringContains: operator.contains,
}


@dataclass(frozen=True)
class Predicate:
    """A pushed condition. ``of`` is true, false or, where a null is compared, None."""

    column: str
    kind: str
    value: object = None
    negated: bool = False

    def of(self, row: dict) -> bool | None:
        own = row[self.column]
        if self.kind == "null":
            found = own is None
        elif self.kind == "same":
            found = own == self.value
        elif own is None:
            return None
        elif self.kind == "in":
            found = own in self.value
            if not found and None in self.value:
                return None
        else:
            found = next(f for t, f in _COMPARE.items() if t.__name__ == self.kind)(own, self.value)
        return found != self.negated


def predicate(condition: ds.Filter) -> Predicate | None:
    """The condition as one on headers, None where it is none."""
    if isinstance(condition, ds.Not):
        inner = predicate(condition.child)
        return inner and Predicate(inner.column, inner.kind, inner.value, not inner.negated)
    column = getattr(condition, "attribute", ())
    if len(column) != 1 or column[0] not in {*FIELDS.values(), "payload_bytes"}:
        return None
    if isinstance(condition, (ds.IsNull, ds.IsNotNull)):
        return Predicate(column[0], "null", negated=isinstance(condition, ds.IsNotNull))
    if isinstance(condition, ds.EqualNullSafe):
        return Predicate(column[0], "same", condition.value)
    if isinstance(condition, ds.In):
        return Predicate(column[0], "in", tuple(condition.value))
    if type(condition) in _COMPARE and condition.value is not None:
        return Predicate(column[0], type(condition).__name__, condition.value)
    return None


# --- reading --------------------------------------------------------------------------------


class _Member:
    """The bytes of one gzip member, inflated as far as they are asked for."""

    def __init__(self, file, start: int) -> None:
        self.file, self.start, self.length = file, start, None
        file.seek(start)
        head = file.read(12)
        if head[:3] != b"\x1f\x8b\x08":
            raise ValueError("no gzip member")
        if len(head) == 12 and head[3] & 4:
            extra = file.read(struct.unpack("<H", head[10:])[0])
            while len(extra) >= 4:
                name, size = extra[:2], struct.unpack("<H", extra[2:4])[0]
                if name == b"sl" and size == 8:
                    self.length = struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + size :]
        file.seek(start)
        self.inflate, self.ready = zlib.decompressobj(31), b""

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        # A first look takes little, as headers may be all that is wanted.
        raw = self.file.read(CHUNK if self.ready or self.length is None else 2048)
        if not raw:
            raise ValueError("the file ends within a record")
        self.ready += self.inflate.decompress(raw)
        return True

    def until(self, mark: bytes) -> bytes:
        while mark not in self.ready:
            if not self._more():
                raise ValueError("no end of headers")
        head, self.ready = self.ready.split(mark, 1)
        return head

    def take(self, n: int) -> bytes:
        parts, left = [], n
        while True:
            parts.append(self.ready[:left])
            left -= len(parts[-1])
            self.ready = self.ready[len(parts[-1]) :]
            if not left:
                return b"".join(parts)
            if not self._more():
                raise ValueError("the file ends within a record")

    def end(self) -> int:
        """Where the next member starts."""
        if self.length is not None:
            return self.start + self.length
        while not self.inflate.eof:
            self.ready = b""
            self._more()
        return self.file.tell() - len(self.inflate.unused_data)


class _Plain:
    """The bytes of one record of a plain file."""

    def __init__(self, file, start: int) -> None:
        self.file, self.at, self.ready = file, start, b""
        file.seek(start)

    def until(self, mark: bytes) -> bytes:
        held = b""
        while mark not in held:
            raw = self.file.read(2048)
            if not raw:
                raise ValueError("no end of headers")
            held += raw
        head = held.split(mark, 1)[0]
        self.at += len(head) + len(mark)
        self.file.seek(self.at)
        return head

    def take(self, n: int) -> bytes:
        found = self.file.read(n)
        if len(found) < n:
            raise ValueError("the file ends within a record")
        self.at += n
        return found


def _fields(head: bytes) -> dict[str, str]:
    """Named fields by name in lower case; a line that starts with a blank goes on the one before."""
    found: dict[str, str] = {}
    name = None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            found[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            found[name] = value.strip()
    return found


def _is_http(row: dict) -> bool:
    return (row["content_type"] or "").startswith(HTTP)


def _record(source, wanted: list[Predicate], payload: bool) -> tuple[dict | None, int, int]:
    """The row if it qualifies, the length of the block and what has been read of it."""
    head = source.until(b"\r\n\r\n")
    if not head.lstrip().startswith(b"WARC/"):
        raise ValueError("no WARC record")
    fields = _fields(head.lstrip())
    row = dict.fromkeys(_NAMES) | {c: fields.get(name) for name, c in FIELDS.items()}
    if row["payload_digest"]:
        row["payload_digest"] = row["payload_digest"].split(":", 1)[-1]
    row["headers"] = list(fields.items())
    size = int(fields["content-length"])
    row["payload_bytes"] = size
    if not all(p.of(row) for p in wanted if p.column != "payload_bytes"):
        return None, size, 0
    read = 0
    if _is_http(row) and size:
        http = source.until(b"\r\n\r\n")
        read = len(http) + 4
        row["http_headers"] = list(_fields(http).items())
        # A revisit has no payload; its HTTP headers tell that of the payload it stands for.
        row["payload_bytes"] = size - read
        if row["record_type"] == "revisit":
            length = dict(row["http_headers"]).get("content-length", "")
            row["payload_bytes"] = int(length) if length.isdigit() else None
    if not all(p.of(row) for p in wanted):
        return None, size, read
    if payload and row["record_type"] != "revisit":
        row["payload"] = source.take(size - read)
        read = size
    return row, size, read


def read_archive(
    system: fs.FileSystem, path: str, wanted: list[Predicate] = (), payload: bool = True, start: int = 0, stop: int | None = None
) -> Iterator[dict]:
    """The records of one archive that qualify, in order; of those that begin from ``start`` to before ``stop``."""
    with system.open_input_file(path) as file:
        end, at = file.size(), start
        gzip = file.read(2) == b"\x1f\x8b"
        while at < (end if stop is None else stop):
            try:
                source = _Member(file, at) if gzip else _Plain(file, at)
                row, size, read = _record(source, wanted, payload)
                if gzip:
                    after = source.end()
                else:
                    after = source.at + size - read + 4
                    if after > end + 4:
                        raise ValueError("the file ends within a record")
            except (ValueError, KeyError, zlib.error) as error:
                raise ValueError(f"{path} at {at}: {error}") from error
            if row is not None:
                row["archive"], row["at"] = path, at
                yield row
            at = after


class Archives(ds.InputPartition):
    """Stretches of archives, each a path, where it starts and where it stops."""

    def __init__(self, stretches: list[tuple[str, int, int]]) -> None:
        super().__init__(stretches)
        self.stretches = stretches


class WarcReader(ds.DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.most = int(options.get("partition_bytes", PARTITION_BYTES))
        self.wanted: list[Predicate] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:
        for condition in filters:
            found = predicate(condition)
            if found is None:
                yield condition
            else:
                self.wanted.append(found)

    def partitions(self) -> list[Archives]:
        system, root = file_system(self.path)
        groups, held = [[]], 0
        for path, size, marks in archives(system, root):
            for start, stop in zip([0, *marks], [*marks, size]):
                if groups[-1] and held + stop - start > self.most:
                    groups.append([])
                    held = 0
                groups[-1].append((path, start, stop))
                held += stop - start
        return [Archives(g) for g in groups]

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.path)
        rows, held = [], 0
        for path, start, stop in partition.stretches:
            for row in read_archive(system, path, self.wanted, self.payload, start, stop):
                rows.append(row)
                held += len(row["payload"] or b"") + 512
                if held > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                    rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, _SCHEMA)


def archives(system: fs.FileSystem, root: str) -> list[tuple[str, int, list[int]]]:
    """Paths, sizes and noted places of the archives of a file or folder; of those that its lists name, where it has any."""
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        return [(info.path, info.size, [])]
    files = [f for f in system.get_file_info(fs.FileSelector(root)) if f.type == fs.FileType.File]
    lists = [f.path for f in files if f.base_name.startswith("_archives-")]
    if lists:
        found = []
        for path in lists:
            with system.open_input_file(path) as file:
                found += [(f"{root.rstrip('/')}/{a['name']}", a["bytes"], a["marks"]) for a in json.loads(file.read())]
    else:
        found = [(f.path, f.size, []) for f in files if re.search(r"\.warc(\.gz)?$", f.base_name)]
    return sorted(found)


# --- writing --------------------------------------------------------------------------------


def _line(text: str) -> str:
    """Text that is safe in a header."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record_bytes(row: dict, date: str) -> bytes:
    """A record as it stands in a plain file."""
    payload = row["payload"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    block = http if row["record_type"] == "revisit" else http + payload
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", row["record_id"]),
        ("WARC-Date", date),
        ("WARC-Target-URI", row["target_uri"] and _line(row["target_uri"])),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
        ("WARC-Refers-To", row["refers_to"]),
        ("WARC-Profile", SAME_PAYLOAD if row["record_type"] == "revisit" else None),
        *[(_line(name), value and _line(value)) for name, value in row["headers"] or ()],
        ("Content-Type", f"{HTTP};msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(raw: bytes, level: int = LEVEL) -> bytes:
    """A gzip member that tells its length in the subfield ``sl``, if 32 bits hold it."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(raw) + squeeze.flush()
    tail = struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)
    whole = 24 + len(body) + 8
    if max(whole, len(raw)) > 0xFFFFFFFF:
        return b"\x1f\x8b\x08\0\0\0\0\0\0\xff" + body + tail
    extra = b"sl" + struct.pack("<HII", 8, whole, len(raw))
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + tail


@dataclass
class Written(ds.WriterCommitMessage):
    files: list[dict]


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path, self.overwrite = options["path"], overwrite
        self.most, self.apart = int(options.get("file_bytes", FILE_BYTES)), int(options.get("mark_bytes", MARK_BYTES))
        self.date = options.get("date") or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = file_system(self.path)
        system.create_dir(root, recursive=True)
        files, file = [], None
        for batch in iterator:
            for row in batch.to_pylist():
                if file is None:
                    files.append({"name": f"{uuid.uuid4().hex}.warc.gz", "bytes": 0, "marks": []})
                    file = system.open_output_stream(f"{root}/{files[-1]['name']}", compression=None)
                member = gzip_member(record_bytes(row, self.date))
                file.write(member)
                if files[-1]["bytes"] - (files[-1]["marks"] or [0])[-1] >= self.apart:
                    files[-1]["marks"].append(files[-1]["bytes"])
                files[-1]["bytes"] += len(member)
                if files[-1]["bytes"] >= self.most:
                    file.close()
                    file = None
        if file is not None:
            file.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = file_system(self.path)
        system.create_dir(root, recursive=True)
        before = [f.path for f in system.get_file_info(fs.FileSelector(root)) if f.base_name.startswith("_archives-")]
        files = [f for m in messages if m is not None for f in m.files]
        with system.open_output_stream(f"{root}/_archives-{uuid.uuid4().hex}", compression=None) as out:
            out.write(json.dumps(files).encode())
        if self.overwrite:
            for path in before:
                system.delete_file(path)

    def abort(self, messages: list[Written | None]) -> None:
        system, root = file_system(self.path)
        for file in [f for m in messages if m is not None for f in m.files]:
            system.delete_file(f"{root}/{file['name']}")


class Warc(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return RECORD

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make the source known to a session, with filters pushed down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Warc)


def read_warc(spark: SparkSession, path: str, payload: bool = True, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """The records under a path. Without ``payload`` that column is null and no block is read."""
    register(spark)
    options = {"payload": str(payload).lower(), "partition_bytes": str(partition_bytes)}
    return spark.read.format("warc").options(**options).load(path)


# --- pages ----------------------------------------------------------------------------------


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of bytes as 32 characters of base32."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    hexed = F.sha1(payload)
    twenty = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.substring(hexed, 5 * i + 1, F.lit(5)), 16, 10).cast("int"))
    letter = lambda v, s: F.substring(letters, F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1))
    text = F.array_join(F.transform(twenty, lambda v: F.concat(*[letter(v, s) for s in (15, 10, 5, 0)])), "")
    return F.when(hexed.isNotNull(), text)


def _record_id(page: Column, digest: Column) -> Column:
    """A name that page and payload determine."""
    h = F.md5(F.concat_ws(" ", page.cast("string"), digest))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def page_records(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """The records of pages, as ``Warc`` writes them: one a row.

    Digests alone are shuffled to find what repeats. Only repeated digests are joined to the pages.
    """
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    own = own.select("*", F.length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"))
    groups = own.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes")
    groups = groups.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null").drop("n")
    own = own.join(stored(groups, "repeated-payloads"), ["payload_digest", "payload_bytes"], "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    first = F.when(again, F.col("first"))
    return own.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        _record_id(F.col("page_id"), F.col("payload_digest")).alias("record_id"),
        F.col("url").cast("string").alias("target_uri"),
        F.when(again, _record_id(first, F.col("payload_digest"))).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        F.create_map(F.lit(PAGE), F.col("page_id").cast("string"), F.lit(FIRST_PAGE), first.cast("string")).alias("headers"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def write_pages(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, file_bytes: int = FILE_BYTES, date: str = "") -> None:
    """The pages as archives under a path, beside what it has."""
    register(pages.sparkSession)
    records = page_records(pages, least_bytes)
    records.write.format("warc").mode("append").options(file_bytes=str(file_bytes), date=date).save(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to`` of every record that ``write_pages`` left.

    Payloads of responses are read and digested anew; revisits are told by their headers alone.
    """
    whole = read_warc(spark, path).filter(F.col("record_type") == "response")
    whole = whole.withColumns({"payload_bytes": F.length("payload").cast("long"), "payload_digest": base32_sha1(F.col("payload"))})
    again = read_warc(spark, path, payload=False).filter(F.col("record_type") == "revisit")
    page = lambda name: F.col("headers")[name].cast("long")
    return whole.unionAll(again).select(
        page(PAGE).alias("page_id"), F.col("target_uri").alias("url"), "payload", "payload_bytes", "payload_digest", "record_type", page(FIRST_PAGE).alias("refers_to")
    )
