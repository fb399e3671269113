"""Work by batches of documents that ask parts of a key space and get answers back.

A batch is a run of rows of bounded size. It speaks once for each of its keys,
however many rows have them, so a key of a third of all rows costs a message
for each batch.
"""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

BATCH_BYTES = 16 << 20
PART_BYTES = 8 << 20


def released(work):
    """``work`` for a group, after which the worker's free memory goes back to the system: workers stay alive, idle, between stages."""

    def free(out: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)
        return out

    if work.__code__.co_argcount == 1:  # Spark counts the arguments
        return lambda rows: free(work(rows))
    return lambda rows, replies: free(work(rows, replies))


def total_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0


def parts_for(total: int, part_bytes: int) -> int:
    return max(1, -(-total // part_bytes))


def free_name(docs: DataFrame, name: str = "_batch") -> str:
    """A column name that ``docs`` hasn't, in whatever case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def batched(docs: DataFrame, batch_bytes: int, total: int, column: str = "_batch") -> DataFrame:
    """Writes ``docs`` with a first ``column`` of runs of rows of about ``batch_bytes`` of text.

    The table is bucketed by it, so what works by batch reads it without a
    shuffle; writing needs none either.
    """
    spark = docs.sparkSession
    small_batches(spark)
    place = docs.columns.index("text")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = TaskContext.get().partitionId() << 24, 0
        for b in rows:
            bytes_of = pa.compute.fill_null(pa.compute.binary_length(b.column(place)), 0).to_numpy(zero_copy_only=False).astype("int64")
            lot = (size + bytes_of.cumsum()) // batch_bytes
            size += int(bytes_of.sum())
            yield pa.RecordBatch.from_arrays([pa.array(number + lot, pa.int64()), *b.columns], names=[column, *b.schema.names])

    schema = f"`{column}` long, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    name = f"quillmark_batches_{uuid.uuid4().hex}"
    n = max(1, min(50_000, -(-total // (2 * batch_bytes))))
    docs.mapInArrow(run, schema).write.option("compression", "zstd").bucketBy(n, column).saveAsTable(name, format="parquet")
    return spark.table(name)


def pack(*arrays) -> bytes:
    """One compressed message of byte strings and numpy arrays."""
    parts = [x if isinstance(x, bytes) else x.tobytes() for x in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(len(b).to_bytes(8, "little") + b for b in parts))


def unpack(blob: bytes) -> list[bytes]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(raw):
        n = int.from_bytes(raw[at : at + 8], "little")
        out.append(raw[at + 8 : at + 8 + n])
        at += 8 + n
    return out


def as_table(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
    return pa.table({n: pa.array(c, k) for (n, k), c in zip(kinds.items(), cols, strict=True)})
