"""Tails a folder of snapshot files and keeps a deduplicated table of the newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stintlake.sources.bucketed import upsert_table


def tail_upsert(spark: SparkSession, source: str, schema: str, table: str, keys: Sequence[str], checkpoint: str, once: bool = True) -> StreamingQuery:
    """New Parquet files below `source` go into `table` by keyed upsert, one version a micro-batch,
    which rewrites the buckets that the batch's keys fall into.

    A batch that is run again after a failure writes the version of a new attempt, and readers
    (bucketed.read_current) only see committed ones. once=True works off what is there and stops.
    """
    import uuid

    def apply(batch: DataFrame, number: int) -> None:
        upsert_table(batch, table, keys, f"batch-{number}-{uuid.uuid4().hex[:8]}")

    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(source)
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
