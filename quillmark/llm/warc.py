"""WARC archives written from and read as a chunked record table.

A payload is a run of rows (record identifier, chunk number, bytes), each with
the SHA-1 of all bytes up to its end. Neither writing nor reading holds a whole
record: both go chunk by chunk, compressed as a gzip member for each record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, scratch, small_batches

CHUNK = 1 << 20
FILE_BYTES = 64 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def with_roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``record_id, uri, payload binary, payload_bytes, sha1, record_type, refers_to`` for each row of ``page_id, url, html``.

    Of equal payloads of ``min_bytes`` or more, the record with the largest
    record_id is the response (all of them if rows repeat it; a null id counts
    as the least); the others are revisits of it and carry no payload.
    Payloads are told apart by SHA-1 and length. The largest id of a payload is
    found by a combining aggregation; the join back may be skewed by a payload
    that many pages share, which adaptive execution splits.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("record_id"), F.col("url").cast("string").alias("uri"), F.coalesce(F.encode("html", "utf-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    last = rows.groupBy("sha1", "payload_bytes").agg(F.max("record_id").alias("response_id"))
    rows = rows.join(last, ["sha1", "payload_bytes"])
    again = (F.col("payload_bytes") >= min_bytes) & ~F.col("record_id").eqNullSafe(F.col("response_id"))
    return rows.select(
        "record_id", "uri", F.when(again, F.lit(b"")).otherwise(F.col("payload")).alias("payload"), "payload_bytes", "sha1",
        F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("response_id")).alias("refers_to"),
    )


def to_chunks(records: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """Payloads as rows of at most ``chunk_bytes``, one at least for each record, in the JVM and in order."""
    last = F.greatest(F.ceil(F.octet_length("payload") / F.lit(chunk_bytes)) - 1, F.lit(0)).cast("int")
    rows = records.withColumn("last_chunk", last).withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last)))
    return rows.select("record_id", "uri", "payload_bytes", "sha1", "record_type", "refers_to", "chunk_no", (F.col("chunk_no") == F.col("last_chunk")).alias("last"), F.expr(f"substring(payload, chunk_no * {chunk_bytes} + 1, {chunk_bytes})").alias("data"))


def _header(r: dict, date: str) -> bytes:
    http = _HTTP.format(r["payload_bytes"])
    size = len(http) + (r["payload_bytes"] if r["record_type"] == "response" else 0)
    uri = "".join(c for c in r["uri"] or "" if c not in "\r\n")
    lines = ["WARC/1.1", f"WARC-Type: {r['record_type']}", f"WARC-Record-ID: <urn:record:{r['record_id']}>", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{base32(bytes.fromhex(r['sha1']))}"]
    if r["record_type"] == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:record:{r['refers_to']}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {size}", "", ""]
    return "\r\n".join(lines).encode() + http.encode()


def write_archives(chunks: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z", file_bytes: int = FILE_BYTES, level: int = 6) -> DataFrame:
    """Writes chunk rows (contiguous and in order for each record) as .warc.gz files under ``folder``, a path or URI that all executors share.

    Returns the written manifest ``path, records, bytes``. File names are new
    for each attempt of a task and only those of attempts that ended are in the
    manifest, so a lost executor leaves at most files that nothing reads.
    """

    small_batches(chunks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        out, name, records, size, gz, digest = None, "", 0, 0, None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([records], pa.int64()), pa.array([size], pa.int64())], names=["path", "records", "bytes"])

        for batch in batches:
            for k in range(batch.num_rows):
                r = {n: batch.column(n)[k].as_py() for n in batch.schema.names}
                if r["chunk_no"] == 0:
                    if out is not None and size >= file_bytes:
                        out.close()
                        yield row()
                        out = None
                    if out is None:
                        name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    gz, digest = zlib.compressobj(level, wbits=31), hashlib.sha1()
                    size += out.write(gz.compress(_header(r, date))) or 0
                digest.update(r["data"])
                size += out.write(gz.compress(r["data"])) or 0
                if r["last"]:
                    if r["record_type"] == "response" and digest.hexdigest() != r["sha1"]:
                        raise ValueError(f"record {r['record_id']}: its chunks don't have its digest")
                    out.write(gz.compress(b"\r\n\r\n") + gz.flush())
                    records += 1
                    size = out.tell()
        if out is not None:
            out.close()
            yield row()

    return materialise(chunks.mapInArrow(run, "path string, records long, bytes long"), "manifest")


class _Stream:
    """Bytes of a file of gzip members, a piece at a time."""

    def __init__(self, raw, piece: int):
        self.raw, self.piece, self.buffer, self.gz, self.rest = raw, piece, bytearray(), zlib.decompressobj(31), b""

    def fill(self) -> bool:
        while True:
            data = self.rest or self.raw.read(min(self.piece, 1 << 18))
            if not data:
                return False
            if self.gz.eof:
                self.gz = zlib.decompressobj(31)
            got = self.gz.decompress(data, self.piece)
            self.rest = self.gz.unused_data if self.gz.eof else self.gz.unconsumed_tail
            if got:
                self.buffer += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        at = self.buffer.find(mark)
        while at < 0:
            if not self.fill():
                if self.buffer:
                    raise ValueError("the archive ends within a record")
                return None
            at = self.buffer.find(mark)
        found = bytes(self.buffer[:at])
        del self.buffer[: at + len(mark)]
        return found

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self.fill():
                raise ValueError("the archive ends within a record")
        found = bytes(self.buffer[:n])
        del self.buffer[:n]
        return found


def records_of(raw, chunk_bytes: int) -> Iterator[tuple]:
    """Chunk rows of an open archive: record_id, chunk_no, record_type, uri, refers_to, end_byte, data, digest, last, digest_ok."""
    stream = _Stream(raw, chunk_bytes)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/1."):
            raise ValueError("no WARC record where one should start")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        name = lambda key: (fields.get(key) or "").removeprefix("<urn:record:").removesuffix(">")
        http = stream.until(b"\r\n\r\n")
        left = int(fields["content-length"]) - len(http) - 4
        said = fields["warc-payload-digest"].removeprefix("sha1:")
        common = (fields["warc-type"], fields.get("warc-target-uri"), name("warc-refers-to") or None)
        if fields["warc-type"] == "revisit":
            length = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
            yield name("warc-record-id"), 0, *common, length, b"", said, True, True
        else:
            digest, no, done = hashlib.sha1(), 0, 0
            while True:
                data = stream.take(min(chunk_bytes, left))
                digest.update(data)
                left, done = left - len(data), done + len(data)
                so_far = base32(digest.copy().digest())
                yield name("warc-record-id"), no, *common, done, data, so_far, not left, bool(left) or so_far == said
                no += 1
                if not left:
                    break
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("a record doesn't end where its length says")


_CHUNK_ROW = "record_id string, chunk_no int, record_type string, uri string, refers_to string, end_byte long, data binary, digest string, last boolean, digest_ok boolean"


def read_chunks(manifest: DataFrame, chunk_bytes: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunked record table of the archives listed in ``manifest.path``.

    A row for each chunk of at most ``chunk_bytes``: ``digest`` is the base32
    SHA-1 of the payload up to ``end_byte``, so the last row has that of the
    whole payload, and ``digest_ok`` says that it is the one in the record's
    header. Revisits give one row with the length and digest of the payload
    they refer to. ``with_data=False`` leaves the bytes out of the rows.
    """
    schema = pa.schema([("record_id", pa.string()), ("chunk_no", pa.int32()), ("record_type", pa.string()), ("uri", pa.string()), ("refers_to", pa.string()), ("end_byte", pa.int64()), ("data", pa.binary()), ("digest", pa.string()), ("last", pa.bool_()), ("digest_ok", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, at = pyarrow.fs.FileSystem.from_uri(path)
                with fs.open_input_stream(at, compression=None) as raw:
                    for row in records_of(raw, chunk_bytes):
                        rows.append(row if with_data else (*row[:6], None, *row[7:]))
                        held += len(rows[-1][6] or b"")
                        if len(rows) >= 2000 or held >= 4 * chunk_bytes:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    files = manifest.select("path")
    return files.repartition(max(1, manifest.count()), F.xxhash64("path")).mapInArrow(run, _CHUNK_ROW)


def archive_pages(pages: DataFrame, min_bytes: int = 0, chunk_bytes: int = CHUNK, folder: str | None = None) -> DataFrame:
    """Writes a record for each page, then reads the archives: ``page_id, payload_bytes, payload_digest, record_type, refers_to, digest_ok``.

    Null html is an empty payload, null url an empty one; repeated rows are
    written each; an empty table gives no archive and no rows.
    """
    manifest = write_archives(to_chunks(with_roles(pages, min_bytes), chunk_bytes), folder or scratch(pages.sparkSession, "warc"))
    done = read_chunks(manifest, chunk_bytes, with_data=False).where("last")
    number = lambda c: F.expr(f"try_cast({c} as bigint)")
    return done.select(number("record_id").alias("page_id"), F.col("end_byte").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", number("refers_to").alias("refers_to"), "digest_ok")


#: DuckDB: base32 of a SHA-1 in hexadecimal digits, five bits at a time out of two digits.
SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS h FROM p),
w AS (SELECT *, max(page_id) OVER (PARTITION BY h, payload_bytes) AS last_id FROM d)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((
    (((instr('0123456789abcdef', substr(h, ((5 * i) // 4)::INT + 1, 1)) - 1) * 16 + instr('0123456789abcdef', substr(h, ((5 * i) // 4)::INT + 2, 1)) - 1)
    >> (3 - (5 * i) % 4)::INT) & 31))::INT, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = last_id THEN NULL ELSE last_id END AS refers_to,
  true AS digest_ok
FROM w
"""
