"""Profiles that are kept per partition and merged: a new partition doesn't need the others read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2^12 registers: a standard error of about 1.6 %.
SKETCH_BITS = 12


def _countable(name: str, kind: str) -> Column:
    """A column as what a distinct sketch takes: integers and texts as they are, others as text."""
    c = F.col(f"`{name}`")
    return c if kind in ("int", "bigint", "string", "binary") else c.cast("bigint") if kind in ("smallint", "tinyint") else F.to_json(F.struct(c)) if kind.startswith(("struct", "array", "map")) else c.cast("string")


def sketch_profile(df: DataFrame, table_name: str, partition: Column | str) -> DataFrame:
    """table_name, partition, column_name, data_type, n_rows, n_null, sketch of every column and partition.

    One pass and one row a partition. The sketches are mergeable, so the rows can be stored and those of
    new partitions added. `partition` gives the name of a row's partition (null is one of its own).
    """
    part = F.col(partition) if isinstance(partition, str) else partition
    fields = [f for f in df.schema.fields if f.dataType.typeName() not in ("variant", "void")]
    kinds = [f.dataType.simpleString() for f in fields]
    counts = [F.count(F.when(F.col(f"`{f.name}`").isNull(), 1)).alias(f"n_{i}") for i, f in enumerate(fields)]
    sketches = [F.hll_sketch_agg(_countable(f.name, k), F.lit(SKETCH_BITS)).alias(f"s_{i}") for i, (f, k) in enumerate(zip(fields, kinds, strict=True))]
    found = df.groupBy(part.cast("string").alias("_partition")).agg(F.count("*").alias("_rows"), *counts, *sketches)
    each = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(k).alias("data_type"), F.col("_rows").alias("n_rows"), F.col(f"n_{i}").alias("n_null"), F.col(f"s_{i}").alias("sketch")) for i, (f, k) in enumerate(zip(fields, kinds, strict=True))])
    return found.select(F.lit(table_name).alias("table_name"), F.col("_partition").alias("partition"), F.explode(each).alias("x")).select("table_name", "partition", "x.*")


def merge_profiles(profiles: DataFrame) -> DataFrame:
    """table_name, column_name, data_type, n_rows, n_null, n_distinct (estimated) over all partitions."""
    merged = profiles.groupBy("table_name", "column_name", "data_type").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_null").alias("n_null"), F.hll_union_agg("sketch").alias("_sketch"))
    return merged.withColumn("n_distinct", F.hll_sketch_estimate("_sketch")).drop("_sketch")
