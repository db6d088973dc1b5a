"""Tables that cut lineage: Parquet in the folder that spark.checkpoint.dir names.

The folder is shared by all machines of a cluster, so a lost executor loses none of it. Only where the
setting is missing (tests on one machine) a temporary folder is used.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="stintlake-"))
    return _own[0]


def keep(df: DataFrame) -> DataFrame:
    """Writes df as a table of its own and reads it back."""
    path = f"{folder(df.sparkSession)}/stintlake-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
