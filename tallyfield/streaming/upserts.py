"""Continuous upsert of arriving listings by key: each micro-batch is one commit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyfield.operators import commits

WRITER = "stream"


def start_upserts(stream: DataFrame, path: str, checkpoint: str, key: str = "url", order: tuple[str, ...] = ("crawled_at", "seq"), once: bool = False) -> StreamingQuery:
    """Keep under path the newest row of each key; an older row never replaces a newer one, and a batch that is run again changes nothing."""

    def merge(batch: DataFrame, number: int) -> None:
        commits.commit(batch, path, key, order, newest=True, batch=(WRITER, number), counts=False)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table after the last whole batch."""
    return commits.read(spark, path)
