"""What several operators share: words, the shared folder, written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of bytes outside this set, which is what ``bytes.split()`` splits on.
ASCII_SPACE = b" \t\n\x0b\x0c\r"


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8 bytes; none for null."""
    return text.encode().split() if text else []


def crc_mod(column: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty string."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(mod)).cast("int")


def crc_mod_py(doc_id: int | None, mod: int) -> int:
    """The driver-side twin of :func:`crc_mod`."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % mod


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``. Where that is unset, a temporary one in local mode and an error on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="quillmark-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/quillmark-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet under the shared folder and reads it back, which cuts its lineage."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of two numbers that are broadcast; larger tables are joined by shuffle.
BROADCAST_ROWS = 400_000


def small(df: DataFrame) -> DataFrame:
    """``df``, of rows of a few numbers, with a hint to broadcast it if a count shows that it has few."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def drop_table(df: DataFrame) -> None:
    """Deletes the files of a table that :func:`materialise` wrote and nothing reads any more."""
    spark = df.sparkSession
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/quillmark-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(hadoop).delete(path, True)


#: Bytes of rows that a task hands to a Python worker at once, where the session doesn't say otherwise.
BATCH_BYTES = "8m"


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of the session. Spark's own 64 MB exist several times over in each executor's JVM and workers."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("67108864b", "67108864", "64MB", "64m"):
        spark.conf.set(key, BATCH_BYTES)


def map_rows(df: DataFrame, columns: list[str], start: Callable[[], Callable[..., Iterable[list]]], schema: str) -> DataFrame:
    """``mapInArrow`` for per-document work.

    ``start()`` runs once a task and returns a function of the columns' Python
    lists (one Arrow batch) giving the output columns as lists or Arrow arrays. Only the named
    columns are read, so others may have any name or type.
    """
    small_batches(df.sparkSession)
    names = [part.split()[0] for part in schema.split(",")]
    kinds = [pa_type(part.split()[1]) for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            if batch.num_rows:
                out = work(*[c.to_pylist() for c in batch.columns])
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=t) for c, t in zip(out, kinds, strict=True)], names=names)

    return df.select(*columns).mapInArrow(run, schema)


def pa_type(name: str) -> pa.DataType:
    return {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}[name]
