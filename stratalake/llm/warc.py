"""WARC archives: a Spark Python data source ("warc"), and writing pages with revisits.

Reading plans partitions of files (small files together, a file never split). A task
parses each record's headers first, decoding only the first few kilobytes of a record,
and tests the pushed predicates on record type and headers; the payload of a record that
is not wanted, or of which no payload column is read, is never decoded. Compressed
records written here carry their length in the gzip header ("sl" field), so such a
record is stepped over; other files are inflated without being kept. Predicates come from
the options ``record_types`` and ``fields`` and, when the session enables
``spark.sql.python.filterPushdown.enabled``, from filters of the DataFrame.

Writing gives each task files of its own. A manifest written last names the files of the
tasks that succeeded; files that a lost or repeated attempt leaves are in none and are not read.

Paths are opened with ``pyarrow.fs`` (local and shared folders, HDFS, object stores).
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, In, InputPartition, IsNotNull, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from ..sources.storage import scratch_path
from .common import join_unique, staged

#: Column -> named field of a record's header.
FIELDS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "content_type": "Content-Type", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
}
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

READ = (
    "record_id string, record_type string, target_uri string, date string, content_type string, payload_digest string,"
    " refers_to string, fields map<string,string>, http_fields map<string,string>, payload binary, payload_bytes long,"
    " payload_sha1 string, file string, offset long"
)
DECODED = ("payload", "payload_bytes", "payload_sha1")
FILE_BYTES = 1 << 30
PARTITION_BYTES = 128 << 20
HEAD_BYTES = 4096
BUFFER = 1 << 20
ROWS, ROWS_BYTES = 500, 8 << 20


class WarcError(ValueError):
    """A file that does not hold WARC records from its first byte to its last."""


def _open(path: str):
    """(file system, path in it) of a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


# ---------------------------------------------------------------------------
# One record
# ---------------------------------------------------------------------------
def _clean(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def encode_record(row: dict) -> bytes:
    """A record; ``payload`` None (a revisit) has HTTP headers alone."""
    payload = row.get("payload")
    size = len(payload) if payload is not None else row.get("payload_bytes")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: {row.get('content_type') or 'text/html; charset=utf-8'}\r\n"
    http = (http + (f"Content-Length: {size}\r\n" if size is not None else "") + "\r\n").encode()
    block = http + (payload or b"")
    head = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["date"])]
    head += [("WARC-Target-URI", row.get("target_uri")), ("WARC-Payload-Digest", row.get("payload_digest")), ("WARC-Refers-To", row.get("refers_to"))]
    head += [("WARC-Profile", IDENTICAL if row["record_type"] == "revisit" else None)]
    head += [*dict(row.get("fields") or ()).items(), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {_clean(v)}\r\n" for k, v in head if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def compress_record(raw: bytes, level: int = 6) -> bytes:
    """A gzip member whose header says how long it is."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(raw) + z.flush()
    size = 24 + len(body) + 8
    sizes = (size, len(raw)) if max(size, len(raw)) < 1 << 32 else (0, 0)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, *sizes)
    return head + body + struct.pack("<II", zlib.crc32(raw), len(raw) & 0xFFFFFFFF)


def parse_fields(head: bytes) -> dict[str, str]:
    """Named fields by lower-case name; repeated ones are joined by a comma, folded lines by a space."""
    found: dict[str, str] = {}
    name = None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            found[name] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        name = name.strip().lower()
        if colon:
            found[name] = f"{found[name]}, {value.strip()}" if name in found else value.strip()
    return found


class _Bytes:
    """Windows of a file by position, read ahead in order."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.held = file, size, 0, b""

    def get(self, pos: int, n: int) -> bytes:
        n = min(n, self.size - pos)
        if n <= 0:
            return b""
        if not (self.at <= pos and pos + n <= self.at + len(self.held)):
            self.file.seek(pos)
            self.at, self.held = pos, self.file.read(min(max(n, BUFFER), self.size - pos))
        return self.held[pos - self.at : pos - self.at + n]


class _Member:
    """A gzip member that is inflated as far as asked."""

    def __init__(self, data: _Bytes, pos: int):
        self.data, self.pos, self.start = data, pos, pos
        self.z, self.raw = zlib.decompressobj(31), bytearray()
        head = data.get(pos, 24)
        if head[:3] != b"\x1f\x8b\x08":
            raise WarcError(f"no gzip member at byte {pos}")
        sized = len(head) == 24 and head[3] & 4 and head[10:16] == b"\x0c\0sl\x08\0"
        self.length = struct.unpack("<I", head[16:20])[0] if sized else 0

    def until(self, n: int) -> bool:
        """Inflate to ``n`` bytes; False if the member ends before."""
        while len(self.raw) < n and not self.z.eof:
            more = self.z.unconsumed_tail
            if not more:
                more = self.data.get(self.pos, HEAD_BYTES if len(self.raw) < HEAD_BYTES else BUFFER)
                self.pos += len(more)
            try:
                got = self.z.decompress(more, max(n - len(self.raw), HEAD_BYTES))
            except zlib.error as e:
                raise WarcError(f"the member at byte {self.start} is damaged: {e}") from e
            if not (more or got or self.z.eof):
                raise WarcError(f"the member at byte {self.start} is cut off")
            self.raw += got
        return len(self.raw) >= n

    def end(self) -> int:
        if self.length and not self.z.eof:
            if self.start + self.length > self.data.size:
                raise WarcError(f"the member at byte {self.start} is cut off")
            return self.start + self.length
        while not self.z.eof:  # inflate and drop what is left
            del self.raw[:]
            self.until(BUFFER)
        return self.pos - len(self.z.unused_data)


class _Plain:
    """An uncompressed record, with the interface of a member."""

    def __init__(self, data: _Bytes, pos: int):
        self.data, self.start, self.raw, self.total = data, pos, b"", None

    def until(self, n: int) -> bool:
        if len(self.raw) < n:
            self.raw = self.data.get(self.start, n)
        return len(self.raw) >= n

    def end(self) -> int:
        if self.start + self.total > self.data.size:
            raise WarcError(f"the record at byte {self.start} is cut off")
        return self.start + self.total


def _head(record, start: int) -> int:
    """Where the header that begins at ``start`` of the record ends (behind its empty line)."""
    n = start + HEAD_BYTES
    while True:
        more = record.until(n)
        at = record.raw.find(b"\r\n\r\n", start)
        if at >= 0:
            return at + 4
        if not more:
            return -1
        n += max(HEAD_BYTES, n)


def records(path: str, wanted, decode: bool) -> Iterator[dict]:
    """Records of a file whose header fields ``wanted`` accepts: fields, http_fields, offset, and, if ``decode``, payload."""
    files, inner = _open(path)
    with files.open_input_file(inner) as f:
        data = _Bytes(f, f.size())
        kind = _Member if data.get(0, 2) == b"\x1f\x8b" else _Plain
        pos = 0
        while pos < data.size:
            record = kind(data, pos)
            end = _head(record, 0)
            if end < 0 or bytes(record.raw[:5]) != b"WARC/":
                raise WarcError(f"{path}: no record at byte {pos}")
            fields = parse_fields(bytes(record.raw[: end - 4]))
            length = fields.get("content-length", "")
            if not length.isdigit():
                raise WarcError(f"{path}: the record at byte {pos} does not say its length")
            total = end + int(length)
            if kind is _Plain:
                record.total = total + 4
            if wanted(fields):
                http, body = {}, end
                if fields.get("content-type", "").replace(" ", "").startswith("application/http"):
                    at = _head(record, end)
                    if 0 <= at <= total:
                        http, body = parse_fields(bytes(record.raw[end : at - 4])), at
                row = {"fields": fields, "http_fields": http, "offset": pos}
                if decode and fields.get("warc-type") != "revisit":
                    if not record.until(total):
                        raise WarcError(f"{path}: the record at byte {pos} is shorter than it says")
                    row["payload"] = bytes(record.raw[body:total])
                    if kind is _Member and record.until(total + 5):  # to its end, where its checksum is tested
                        raise WarcError(f"{path}: the record at byte {pos} is longer than it says")
                yield row
            pos = record.end()


# ---------------------------------------------------------------------------
# The data source
# ---------------------------------------------------------------------------
class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class Written(WriterCommitMessage):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path = schema, options["path"]
        self.most = int(options.get("partition_bytes", PARTITION_BYTES))
        # lower-case name of a field -> the values allowed (None: any, but there)
        self.allowed: list[tuple[str, list | None]] = [(k.lower(), v) for k, v in json.loads(options.get("fields", "{}")).items()]
        if options.get("record_types"):
            self.allowed.append(("warc-type", json.loads(options["record_types"])))

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        files, inner = _open(self.path)
        found = files.get_file_info(fs.FileSelector(inner, allow_not_found=False))
        notes = [x.path for x in found if x.base_name.startswith("_files-")]
        if notes:
            named = []
            for n in sorted(notes):
                with files.open_input_stream(n) as f:
                    named += [(f"{inner}/{name}", size) for name, size in json.loads(f.read())]
        else:  # archives of others
            named = [(x.path, x.size) for x in found if x.is_file and x.base_name.endswith((".warc", ".warc.gz"))]
        root = self.path.rstrip("/")[: -len(inner.rstrip("/"))] if self.path.rstrip("/").endswith(inner.rstrip("/")) else ""
        parts, some, size = [], [], 0
        for path, n in sorted(named):
            if some and size + n > self.most:
                parts.append(Files(some))
                some, size = [], 0
            some, size = [*some, root + path], size + n
        return [*parts, Files(some)] if some else parts

    def wanted(self, fields: dict) -> bool:
        return all(name in fields and (values is None or fields[name] in values) for name, values in self.allowed)

    def read(self, partition: Files) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        names = self.schema.fieldNames()
        types = [(n, to_arrow_type(f.dataType)) for n, f in zip(names, self.schema.fields)]
        decode = any(n in DECODED for n in names)
        rows: list[dict] = []
        held = 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in types], names)

        for path in partition.paths if partition else ():  # without files Spark still reads once
            for r in records(path, self.wanted, decode):
                payload = r.get("payload")
                out = {c: r["fields"].get(f.lower()) for c, f in FIELDS.items()}
                out |= {"file": path, "offset": r["offset"], "payload": payload}
                for c in ("fields", "http_fields"):
                    if c in names:
                        out[c] = list(r[c].items())
                if payload is not None:
                    out["payload_bytes"] = len(payload)
                    if "payload_sha1" in names:
                        out["payload_sha1"] = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                rows.append(out)
                held += len(payload or b"") if "payload" in names else 0
                if len(rows) >= ROWS or held >= ROWS_BYTES:
                    yield batch()
                    rows, held = [], 0
        if rows:
            yield batch()


class PushingWarcReader(WarcReader):
    """Takes equality, membership and presence filters on the columns that are header fields."""

    def pushFilters(self, filters):
        for f in filters:
            name = FIELDS.get(f.attribute[0]) if len(getattr(f, "attribute", ())) == 1 else None
            if name and isinstance(f, (EqualTo, EqualNullSafe)) and f.value is not None:
                self.allowed.append((name.lower(), [f.value]))
            elif name and isinstance(f, In):
                self.allowed.append((name.lower(), [v for v in f.value if v is not None]))
            elif name and isinstance(f, IsNotNull):
                self.allowed.append((name.lower(), None))
            else:
                yield f


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.level = options["path"], int(options.get("level", 6))
        self.most = int(options.get("file_bytes", FILE_BYTES))

    def write(self, iterator: Iterator) -> Written:
        files, inner = _open(self.path)
        files.create_dir(inner, recursive=True)
        made: list[tuple[str, int]] = []
        out, size = None, 0
        try:
            for batch in iterator:
                for at in range(0, batch.num_rows, ROWS):
                    for row in batch.slice(at, ROWS).to_pylist():
                        raw = compress_record(encode_record(row), self.level)
                        if out is not None and size + len(raw) > self.most:
                            out.close()
                            made[-1], out = (made[-1][0], size), None
                        if out is None:
                            made.append((f"{uuid.uuid4().hex}.warc.gz", 0))
                            out, size = files.open_output_stream(f"{inner}/{made[-1][0]}", compression=None), 0
                        out.write(raw)
                        size += len(raw)
        finally:
            if out is not None:
                out.close()
        if made:
            made[-1] = (made[-1][0], size)
        return Written(made)

    def commit(self, messages: list) -> None:
        files, inner = _open(self.path)
        files.create_dir(inner, recursive=True)
        named = sorted(x for m in messages if m for x in m.files)
        part = f"{inner}/.files-{uuid.uuid4().hex}"
        with files.open_output_stream(part) as f:
            f.write(json.dumps(named).encode())
        files.move(part, f"{inner}/_files-{uuid.uuid4().hex}.json")

    def abort(self, messages: list) -> None:
        files, inner = _open(self.path)
        for m in messages:
            for name, _ in m.files if m else ():
                files.delete_file(f"{inner}/{name}")


class WarcSource(DataSource):
    """Options: path; record_types and fields (JSON), partition_bytes; file_bytes and level for writing."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ

    def reader(self, schema: StructType) -> WarcReader:
        return (PushingWarcReader if self.options.get("pushdown") == "true" else WarcReader)(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are added to, not replaced: write in mode append to a folder of your own")
        return WarcWriter(dict(self.options))


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None, record_types=None, fields: dict | None = None, **options) -> DataFrame:
    """Records of the archives in a folder, ``columns`` of :data:`READ` (payloads are decoded only for ``DECODED`` ones).

    ``record_types`` and ``fields`` (named field -> allowed values, or None: present) choose
    records by their headers. A file that is no archive or is cut off fails the read.
    """
    spark.dataSource.register(WarcSource)
    whole = StructType.fromDDL(READ)
    reader = spark.read.format("warc").schema(StructType([whole[c] for c in columns]) if columns else whole)
    if record_types:
        reader = reader.option("record_types", json.dumps(list(record_types)))
    if fields:
        reader = reader.option("fields", json.dumps(fields))
    pushes = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false").lower()
    return reader.options(pushdown=pushes, **options).load(path)


def write_warc(rows: DataFrame, path: str, **options) -> None:
    """Add a record for each row: record_id, record_type, date, and any of target_uri, payload_digest,
    refers_to, content_type (of the payload), fields (further named fields), payload, payload_bytes."""
    rows.sparkSession.dataSource.register(WarcSource)
    rows.write.format("warc").mode("append").options(**options).save(path)


# ---------------------------------------------------------------------------
# Pages
# ---------------------------------------------------------------------------
def base32(digest: Column) -> Column:
    """Bare upper-case base32 of a 20-byte digest: four characters for each five hexadecimal digits."""
    parts = []
    for i in range(8):
        n = F.conv(F.substring(F.hex(digest), 5 * i + 1, 5), 16, 10).cast("int")
        parts += [F.substring(F.lit(BASE32), F.shiftright(n, 15 - 5 * k).bitwiseAND(31) + 1, F.lit(1)) for k in range(4)]
    return F.concat(*parts)


def _urn(*of) -> Column:
    h = F.md5(F.to_json(F.struct(*of)))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def with_revisits(pages: DataFrame, id_col: str, url_col: str, text_col: str, least: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Rows for :func:`write_warc`: one response for each payload of at least ``least`` bytes, the others revisit it.

    The response is the row with the smallest id (null last), then url (null last); of
    rows equal in both, one. Smaller payloads are all responses. A null text is an empty
    payload. Ids and what a revisit refers to go into the fields X-Page-ID and X-Refers-To-Page-ID.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("payload")
    )
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long"))
    rows = rows.withColumn("digest", F.when(F.col("bytes") >= least, F.unhex(F.sha1("payload"))))
    copies = rows.where("digest is not null").groupBy("digest", "page", "url").agg(F.count("*").alias("copies"))
    order = F.struct(F.col("page").isNull().alias("a"), F.col("page").alias("first_page"), F.col("url").isNull().alias("b"), F.col("url").alias("first_url"), F.col("copies").alias("firsts"))
    same = copies.groupBy("digest").agg(F.min(order).alias("first"), F.sum("copies").alias("many")).where("many > 1")
    same = staged(same.select("digest", "many", "first.first_page", "first.first_url", "first.firsts"), "warc-same")
    # small payloads have no digest to meet by; a digest of their own keeps them apart in the shuffle
    keyed = rows.withColumn("digest", F.coalesce("digest", F.unhex(F.md5(F.to_json(F.struct("page", "url"))))))
    met = join_unique(keyed, same, ["digest"], "many", "left").withColumn(
        "first", F.col("page").eqNullSafe(F.col("first_page")) & F.col("url").eqNullSafe(F.col("first_url"))
    )
    whole = ["digest", "page", "url", "bytes", "first_page", "first_url"]
    met = met.withColumn("kind", F.when(F.col("many").isNull() | F.col("first"), "response").otherwise("revisit"))
    if not same.where("firsts > 1").isEmpty():  # equal rows share the first place: one of them has it
        tied = met.where("first and firsts > 1").groupBy(*whole, "many", "firsts", "first").agg(F.any_value("payload").alias("payload"))
        tied = tied.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("firsts").cast("int"))))
        tied = tied.withColumn("kind", F.when(F.col("nth") == 1, "response").otherwise("revisit")).select(*met.columns)
        met = met.where("not (coalesce(first, false) and coalesce(firsts, 0) > 1)").unionByName(tied)
    revisit = F.col("kind") == "revisit"
    response = _urn(F.hex("digest"), F.col("first_page"), F.col("first_url"))
    fields = F.map_filter(
        F.create_map(F.lit("X-Page-ID"), F.col("page").cast("string"), F.lit("X-Refers-To-Page-ID"), F.when(revisit, F.col("first_page").cast("string"))),
        lambda k, v: v.isNotNull(),
    )
    return met.select(
        F.when(F.col("many").isNotNull() & ~revisit, response).otherwise(F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))).alias("record_id"),
        F.col("kind").alias("record_type"), F.lit(date).alias("date"), F.col("url").alias("target_uri"),
        F.concat(F.lit("sha1:"), base32(F.unhex(F.sha1("payload")))).alias("payload_digest"), F.when(revisit, response).alias("refers_to"),
        fields.alias("fields"), F.when(~revisit, F.col("payload")).alias("payload"), F.col("bytes").alias("payload_bytes"),
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to (page id) of archived pages.

    Size and digest of a response are those of the payload that is read back, and of a
    revisit those that its headers give, as its payload is not there.
    """
    page = lambda name: F.try_element_at("fields", F.lit(name)).cast("long")
    whole = read_warc(spark, path, ["fields", "record_type", *DECODED[1:]], ["response"])
    again = read_warc(spark, path, ["fields", "http_fields", "record_type", "payload_digest"], ["revisit"])
    return whole.select(
        page("x-page-id").alias("page_id"), "payload_bytes", F.col("payload_sha1").alias("payload_digest"), "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    ).unionByName(again.select(
        page("x-page-id").alias("page_id"), F.try_element_at("http_fields", F.lit("content-length")).cast("long").alias("payload_bytes"),
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type", page("x-refers-to-page-id").alias("refers_to"),
    ))


def archived(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", least: int = 0) -> DataFrame:
    """Write a record for each page to ``path`` (default: the session's scratch folder) and read the archives back.

    Nulls, repeated rows and ties as in :func:`with_revisits`. An empty table gives no
    rows. Other columns are ignored. Ids must be whole numbers.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_warc(with_revisits(pages, id_col, url_col, text_col, least), path)
    return read_pages(spark, path)


#: SHA-1 in base32 by five hexadecimal digits at a time.
SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM d)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(digest, 5 * (i // 4) + 1, 5))::INT >> (15 - 5 * (i % 4))::INT & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

