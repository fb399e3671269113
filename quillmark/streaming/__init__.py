"""Matching over a stream of documents: it has no state, so batch operators serve as they are."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def each_batch(source: DataFrame, work: Callable[[DataFrame], DataFrame], path: str, checkpoint: str):
    """Starts a query that maps every micro-batch of a file stream by ``work`` and appends the result as Parquet.

    The batch number is in the folder's name, so a batch that is repeated after
    a failure replaces what it wrote.
    """

    def run(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return source.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def documents(spark: SparkSession, path: str, schema: str = "doc_id long, text string, lang string, source string, n_chars long") -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)
