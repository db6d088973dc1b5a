"""Slowly changing dimensions of type 2."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

META = ("valid_from", "valid_to", "is_current", "loaded_at")


def scd2_apply(existing: DataFrame | None, new: DataFrame, key: str, as_of: str, meta: Sequence[str] = META) -> DataFrame:
    """History after one load of the current state `new`.

    First load: every row opens at as_of. Later: a changed key (null-safe comparison of every other
    column) has its open row closed at as_of and a new one opened; an unchanged key only gets a new
    loaded_at; a key without an open row is opened; keys absent from new stay as they are.
    """
    start, end, current, loaded = meta
    now = F.lit(as_of).cast("date")
    fresh = new.withColumns({start: now, end: F.lit(None).cast("date"), current: F.lit(True), loaded: now})
    if existing is None:
        return fresh
    columns = [c for c in new.columns if c != key]
    stamped = new.select(key, F.struct(*columns).alias("_new"))
    shared = [c for c in columns if c in existing.columns]
    joined = existing.join(stamped, key, "left")
    differ = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_new.{c}")) for c in shared], F.lit(False))
    for c in columns:
        if c not in shared:
            differ = differ | F.col(f"_new.{c}").isNotNull()
    joined = joined.withColumn("_state", F.when(~F.col(current) | F.col("_new").isNull(), "keep").when(differ, "close").otherwise("same"))
    old = joined.withColumns({
        end: F.when(F.col("_state") == "close", now).otherwise(F.col(end)),
        current: F.col(current) & (F.col("_state") != "close"),
        loaded: F.when(F.col("_state") == "same", now).otherwise(F.col(loaded)),
    })
    unchanged = joined.where("_state = 'same'").select(key).distinct()
    opened = fresh.join(unchanged, key, "left_anti")
    return old.select(*existing.columns).unionByName(opened, allowMissingColumns=True)
