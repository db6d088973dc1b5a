"""As-of joins without a range join: one union, one window, and ranges of time for hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A key is hot if it has more rows than this on one side and more than a partition's share of them.
HOT_ROWS = 250_000
#: Quantiles of time that are looked at for each hot key: the most ranges that a key is cut into.
MOST_RANGES = 1024
_ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def asof_join(left: DataFrame, right: DataFrame, on: str, by: Sequence[str] = (), right_on: str | None = None, strict: bool = False, hot_rows: int | None = HOT_ROWS, ranges: int | None = None) -> DataFrame:
    """For every left row the most recent right row with right_on <= on (strict: <) and equal `by`.

    The right row is carried as a whole, so nulls in it are kept. Its columns besides `by` and right_on
    follow the left ones; a left row without a match has nulls there. Several right rows of one time:
    the greatest by all columns. Null times on the right never match; left rows with null times stay,
    without a match.

    A key's rows are one window, unless the key is hot: more than hot_rows rows on a side, and more than
    the side's rows / ranges (by default the number of shuffle partitions). Hot keys, of which there are
    fewer than twice `ranges`, are found by one count over each side's keys. Their time is cut at
    quantiles into ranges of about a partition's share each; a range is a window of its own, and the last
    right row before it is carried over from the ranges before. Rows of one time are never cut apart.
    hot_rows=None leaves the count out, for inputs known to have few rows of each key. Times that have no
    quantiles (strings) are not cut.
    """
    right_on = right_on or on
    by, extra = list(by), [c for c in right.columns if c not in (*by, right_on)]
    rows = right.where(F.col(right_on).isNotNull()).select(*by, F.col(right_on).alias("_t"), F.struct(F.col(right_on).alias("_t"), *extra).alias("_r"))
    probes = left.select(*by, F.col(on).alias("_t"), F.struct(*left.columns).alias("_l"))
    kind = probes.select("_t").union(rows.select("_t")).schema["_t"].dataType  # the type that both fit
    rows, probes = (side.withColumn("_t", F.col("_t").cast(kind)) for side in (rows, probes))
    cuts = None
    if hot_rows is not None and isinstance(kind, _ORDERED):
        cuts = _hot_cuts([probes, rows], by, hot_rows, ranges or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if cuts is None:
        matched = _latest(probes, rows, by, strict)
    else:
        rows, probes = (_placed(side, cuts, by) for side in (rows, probes))
        matched = _latest(probes, rows, [*by, "_b"], strict)
        # one row for each range, so the table of what is carried is small
        lasts = rows.where("_b >= 0").groupBy(*by, "_b").agg(F.max("_r").alias("_r"))
        line = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        every = _ranges(cuts, by).join(lasts.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_b").alias("_bb"), "_r"), [*_same(by), F.col("_b") == F.col("_bb")], "left")
        carried = every.select(*[F.col(c) for c in by], "_b", "_r").withColumn("_earlier", F.last("_r", ignorenulls=True).over(line)).where("_earlier IS NOT NULL")
        carried = carried.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_b").alias("_bb"), "_earlier")
        matched = matched.join(F.broadcast(carried), [*_same(by), F.col("_b") == F.col("_bb")], "left")  # at most a row for each range
        matched = matched.withColumn("_m", F.coalesce("_m", "_earlier"))
    return matched.select("_l.*", *[F.when(F.col("_t").isNotNull(), F.col(f"_m.{c}")).alias(c) for c in extra])


def _same(by: list[str]) -> list:
    return [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]


def _latest(probes: DataFrame, rows: DataFrame, by: list[str], strict: bool) -> DataFrame:
    """Adds _m, the last _r at or before (strict: before) _t."""
    line = Window.partitionBy(*by).orderBy("_t", "_side", "_r").rowsBetween(Window.unboundedPreceding, 0)
    both = probes.withColumn("_side", F.lit(0 if strict else 1)).unionByName(rows.withColumn("_side", F.lit(1 if strict else 0)), allowMissingColumns=True)
    return both.withColumn("_m", F.last("_r", ignorenulls=True).over(line)).where("_l IS NOT NULL").drop("_r", "_side")


def _hot_cuts(sides: list[DataFrame], by: list[str], hot_rows: int, ranges: int) -> DataFrame | None:
    """(_by_..., _cuts): the hot keys with ascending first times of their ranges but the first; None
    without hot keys. At most 2 * ranges keys, with at most 4 * ranges cuts together."""
    spark, found = sides[0].sparkSession, {}
    for side in sides:
        counts = side.groupBy(*by).agg(F.count("*").alias("_n"))
        total = counts.agg(F.sum("_n").alias("_all"))
        large = counts.where(F.col("_n") > hot_rows).crossJoin(F.broadcast(total)).where(F.col("_n") * ranges > F.col("_all"))  # one row
        keys = large.collect()  # fewer than `ranges`
        if not keys:
            continue
        schema = T.StructType([T.StructField(f"_by_{c}", side.schema[c].dataType) for c in by])
        hot = spark.createDataFrame([tuple(r[c] for c in by) for r in keys], schema) if by else None
        mine = side.join(F.broadcast(hot), _same(by), "left_semi") if by else side
        levels = min(MOST_RANGES, 2 * ranges)
        marks = mine.groupBy(*by).agg(F.percentile_approx("_t", F.array(*[F.lit(k / levels) for k in range(1, levels)]), F.lit(10 * levels)).alias("_q"))
        share = {tuple(r[c] for c in by): -(-r["_n"] * ranges // r["_all"]) for r in keys}
        for r in marks.collect():
            key = tuple(r[c] for c in by)
            step = max(1, levels // (share[key] + 1))
            found.setdefault(key, set()).update((r["_q"] or [])[step - 1 :: step])
    if not found:
        return None
    kinds = [T.StructField(f"_by_{c}", sides[0].schema[c].dataType) for c in by]
    schema = T.StructType([*kinds, T.StructField("_cuts", T.ArrayType(sides[1].schema["_t"].dataType))])
    return spark.createDataFrame([(*k, sorted(v)) for k, v in found.items()], schema)


def _placed(side: DataFrame, cuts: DataFrame, by: list[str]) -> DataFrame:
    """Adds _b: the range of the row's time, -1 for keys that aren't hot. Null times are in range 0."""
    met = side.join(F.broadcast(cuts), _same(by), "left") if by else side.crossJoin(F.broadcast(cuts))  # one row
    place = F.size(F.filter("_cuts", lambda c: c <= F.col("_t")))
    return met.withColumn("_b", F.when(F.col("_cuts").isNotNull(), place).otherwise(F.lit(-1))).drop("_cuts", *[f"_by_{c}" for c in by])


def _ranges(cuts: DataFrame, by: list[str]) -> DataFrame:
    """(by, _b): every range of every hot key."""
    return cuts.select(*[F.col(f"_by_{c}").alias(c) for c in by], F.explode(F.sequence(F.lit(0), F.size("_cuts"))).alias("_b"))


def backfill_first(df: DataFrame, series: DataFrame, by: Sequence[str], value: str, date_col: str) -> DataFrame:
    """Nulls in df's `value` take the first price the key ever has in series."""
    first = series.where(F.col(value).isNotNull()).groupBy(*by).agg(F.min(F.struct(date_col, value)).getField(value).alias("_first"))
    return df.join(first, list(by), "left").withColumn(value, F.coalesce(value, "_first")).drop("_first")
