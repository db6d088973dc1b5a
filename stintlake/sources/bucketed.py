"""A stored table with keyed upserts that rewrite only the buckets they touch (copy on write).

A table's folder has

    data/<version>/_bucket=<k>/...   the rows of bucket k as version <version> wrote them
    manifests/seq=<n>/...            the n-th state: for each bucket the version that holds it

A key's bucket is a hash of its values as text, so it doesn't depend on integer widths. An upsert reads
the buckets that its rows fall into, merges them, writes them under a new version and then commits a
manifest in which the other buckets still name the files they had. The manifest is one small file whose
rename makes the new state visible, so a writer that dies leaves the table as it was; two writers of one
state collide on the folder of the next one, and the later gets an error. Nothing that a reader has open
is changed. Old versions stay until someone deletes them.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintlake.operators.dedupe import upsert

#: Buckets of a new table. A bucket is what the smallest upsert reads and writes.
BUCKETS = 64
_MANIFEST = "bucket int, version string, buckets int, schema string"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys]), F.lit(buckets)).cast("int")


def _state(spark: SparkSession, path: str) -> tuple[int, list]:
    """(number, rows) of the last manifest; (0, []) if the table doesn't exist."""
    try:
        all_ = spark.read.schema(f"{_MANIFEST}, seq int").parquet(f"{path}/manifests")
        last = all_.agg(F.max("seq")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, []
    return (last, all_.where(F.col("seq") == last).collect()) if last else (0, [])  # at most a row a bucket


def _schema(state: list) -> T.StructType:
    return T.StructType.fromJson(json.loads(state[0].schema))


def _read(spark: SparkSession, path: str, state: list, chosen: Sequence[int] | None = None) -> DataFrame:
    paths = [f"{path}/data/{r.version}/_bucket={r.bucket}" for r in state if chosen is None or r.bucket in chosen]
    return spark.read.schema(_schema(state)).parquet(*paths) if paths else spark.createDataFrame([], _schema(state))


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The table's present rows; columns that older buckets don't have are null there."""
    _, state = _state(spark, path)
    if not state:
        raise ValueError(f"{path} is no bucketed table")
    return _read(spark, path, state)


def upsert_table(new: DataFrame, path: str, keys: Sequence[str], version: str, buckets: int = BUCKETS) -> list[int]:
    """Takes the rows of `new` into the table, the newest of each key, and returns the buckets that were
    rewritten. `version` is a name that was not used before. `buckets` holds for a table's first upsert.

    Columns that only one side has are null in the rows of the other; number types widen. An empty `new`
    changes nothing.
    """
    spark = new.sparkSession
    number, state = _state(spark, path)
    buckets = state[0].buckets if state else buckets
    place = bucket_of(keys, buckets)
    touched = {r[0] for r in new.select(place).distinct().collect()}  # at most `buckets` numbers
    if not touched:
        return []
    merged = upsert(_read(spark, path, state, touched) if state else None, new, keys)
    # a bucket is split or put together with others by its size when it is written
    merged.withColumn("_bucket", place).hint("rebalance", F.col("_bucket")).write.mode("errorifexists").partitionBy("_bucket").parquet(f"{path}/data/{version}")
    schema = merged.schema.json()
    rows = [(r.bucket, r.version, buckets, schema) for r in state if r.bucket not in touched] + [(k, version, buckets, schema) for k in sorted(touched)]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("errorifexists").parquet(f"{path}/manifests/seq={number + 1}")
    return sorted(touched)
