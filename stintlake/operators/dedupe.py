"""Keyed choice of one row among several, always under an explicit and complete order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField


def _tied(df: DataFrame, skip: Sequence[str]) -> list[StructField]:
    return [f for f in df.schema.fields if f.name not in skip and f.dataType.typeName() not in ("map", "variant")]


def _tie(df: DataFrame, skip: Sequence[str]) -> list[Column]:
    """All comparable columns, so that the order has no ties between different rows."""
    return [F.col(f.name) for f in _tied(df, skip)]


#: Types whose descending order is an ascending order of a number.
_TURNED = {"date": F.unix_date, "timestamp": F.unix_micros, "boolean": lambda c: c.cast("int")}
_NUMBERS = ("byte", "short", "integer", "long", "float", "double", "decimal")
#: Types whose grouping key is the value itself (of floats it is a normalised one).
_PLAIN = ("string", "boolean", "tinyint", "smallint", "int", "bigint", "date", "timestamp", "timestamp_ntz")


def _best(df: DataFrame, keys: Sequence[str], order: Sequence[str], descending: bool) -> DataFrame | None:
    """One row a key as an aggregate, which needs no sort of a whole key in one task; None if the order can't
    be turned into ascending ones. Keys come from the grouping, so that what follows knows how rows are dealt,
    and the rest out of the order itself, unless a column can't be compared and has to be carried beside it."""
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    first: list[Column] = []
    for name in order:
        if not descending:
            first.append(F.col(name))
        elif types.get(name) in _TURNED or types.get(name) in _NUMBERS:
            number = _TURNED.get(types[name], lambda c: c.cast("decimal(20,0)") if types[name] == "long" else c)(F.col(name))  # noqa: B023
            if types[name] in ("float", "double"):  # descending orders have NaN first
                first.append(~F.coalesce(F.isnan(name), F.lit(False)))
            first += [F.col(name).isNull(), -number]  # and nulls last
        else:
            return None
    line = F.struct(*[c.alias(f"_{i}") for i, c in enumerate([*first, *_tie(df, keys)] or [F.lit(0)])])
    grouped = [f.name for f in df.schema.fields if f.name in keys and f.dataType.simpleString() in _PLAIN]
    place = {f.name: f"_{len(first) + i}" for i, f in enumerate(_tied(df, keys))}
    rest = [c for c in df.columns if c not in grouped]
    if all(c in place for c in rest):
        best = F.min(line)
    else:
        best, place = F.min_by(F.struct(*[df[c] for c in rest]), line), {c: f"`{c}`" for c in rest}
    return df.groupBy(*keys).agg(best.alias("_row")).select(*[F.col(c) if c in grouped else F.col(f"_row.{place[c]}").alias(c) for c in df.columns])


def _numbered(df: DataFrame, keys: Sequence[str], columns: Sequence[Column]) -> DataFrame:
    line = Window.partitionBy(*keys).orderBy(*columns, *_tie(df, keys))
    return df.withColumn("_n", F.row_number().over(line)).where("_n = 1").drop("_n")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in `order`; remaining ties go by all columns, ascending."""
    return df.dropDuplicates() if set(df.columns) == set(keys) else _best(df, keys, order, False)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in `order` (names; nulls come first); remaining ties go by all columns, ascending."""
    best = _best(df, keys, order, True)
    return _numbered(df, keys, [F.desc(o) for o in order]) if best is None else best


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union by column name; missing columns are null and number types widen."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def stack_latest(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Stacks frames; for each key the row of the last frame that has it holds."""
    tagged = union_by_name(*[f.withColumn("_from", F.lit(i)) for i, f in enumerate(frames)])
    return keep_last(tagged, keys, ["_from"]).drop("_from")


def precedence_union(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Stacks feeds, the preferred one first; a later feed only adds keys that none before has."""
    tagged = union_by_name(*[f.withColumn("_from", F.lit(i)) for i, f in enumerate(frames)])
    return keep_first(tagged, keys, ["_from"]).drop("_from")


def gap_fill(main: DataFrame, archive: DataFrame, key: str) -> DataFrame:
    """main, and those rows of archive whose id main doesn't have at all."""
    return union_by_name(main, archive.join(main.select(key).distinct(), key, "left_anti"))


def merge_full_and_incremental(full: DataFrame, incremental: DataFrame, key: str = "league_id", preserve: Sequence[str] = ()) -> DataFrame:
    """One row a key, the incremental one if there is one; `preserve` columns always come from full."""
    merged = stack_latest([full, incremental], [key])
    present = [c for c in preserve if c in full.columns]
    if not present:
        return merged
    kept = keep_first(full.select(key, *present), [key], [])
    return merged.drop(*present).join(kept, key, "left").select(*merged.columns)


def upsert(existing: DataFrame | None, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keyed upsert: the newest row of each key. Without an existing table it only dedupes."""
    return stack_latest([new] if existing is None else [existing, new], keys)


def duplicated(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value in `column` occurs more than once."""
    return df.withColumn("_n", F.count("*").over(Window.partitionBy(column))).where("_n > 1").drop("_n")
