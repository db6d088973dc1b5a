"""Half-open intervals [valid_from, valid_to) from snapshots and events; null valid_to means open."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def build_snapshot_intervals(present: DataFrame, keys: Sequence[str], date_col: str = "snapshot_date", grid_by: Sequence[str] = ()) -> DataFrame:
    """Gaps and islands of presence over the dates on which snapshots exist.

    The grid of dates is that of the whole table; with `grid_by` (a part of keys) each group has its own.
    A stint ends at the first snapshot without the key.
    """
    line = Window.partitionBy(*grid_by).orderBy("_d") if grid_by else Window.orderBy("_d")
    rows = present.select(*keys, F.col(date_col).cast("date").alias("_d")).distinct()
    dates = rows.select(*grid_by, "_d").distinct().select(*grid_by, "_d", F.row_number().over(line).alias("_i"), F.lead("_d").over(line).alias("_next"))
    placed = rows.join(dates, [*grid_by, "_d"])
    island = F.col("_i") - F.row_number().over(Window.partitionBy(*keys).orderBy("_d"))
    stints = placed.withColumn("_island", island).groupBy(*keys, "_island").agg(F.min("_d").alias("valid_from"), F.max_by("_next", "_i").alias("valid_to"))
    return stints.select(*keys, "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))


def build_event_intervals(events: DataFrame, keys: Sequence[str], ts_col: str = "ts", date_col: str = "date", action_col: str = "action") -> DataFrame:
    """Add and drop events to stints: a drop sorts before an add of the same time, repeated adds are one
    stint, drops without an add do nothing."""
    line = Window.partitionBy(*keys).orderBy(ts_col, "_add", date_col)
    rows = events.where(F.col(action_col).isin("add", "drop")).select(*keys, ts_col, date_col, (F.col(action_col) == "add").alias("_add"))
    rows = rows.withColumn("_before", F.coalesce(F.lag("_add").over(line), F.lit(False)))
    turns = rows.where("_add != _before")
    stints = turns.withColumn("valid_to", F.lead(F.col(date_col).cast("date")).over(line)).where("_add")
    return stints.select(*keys, F.col(date_col).cast("date").alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current"))


def clip_at(intervals: DataFrame, boundary: Column | str) -> DataFrame:
    """The part of every interval before the boundary; empty ones go."""
    b = F.lit(boundary).cast("date") if isinstance(boundary, str) else boundary
    out = intervals.where(F.col("valid_from") < b).withColumn("valid_to", F.least(F.coalesce("valid_to", b), b))
    return out.where("valid_from < valid_to").withColumn("is_current", F.lit(False))


def combine_eras(present: DataFrame, events: DataFrame, boundary: str, keys: Sequence[str], date_col: str = "snapshot_date") -> DataFrame:
    """Snapshots from the boundary on, events before it; the two are not stitched together."""
    later = build_snapshot_intervals(present.where(F.col(date_col).cast("date") >= F.lit(boundary).cast("date")), keys, date_col)
    return later.unionByName(clip_at(build_event_intervals(events, keys), boundary))


def drop_empty(intervals: DataFrame) -> DataFrame:
    return intervals.where("valid_to IS NULL OR valid_from < valid_to")


def held_on(ledger: DataFrame, date: str | Column) -> DataFrame:
    """Intervals that hold on one date."""
    d = F.lit(date).cast("date") if isinstance(date, str) else date
    return ledger.where((F.col("valid_from") <= d) & (F.col("valid_to").isNull() | (F.col("valid_to") > d)))


def holdings_by_date(ledger: DataFrame, dates: DataFrame, date_col: str = "date") -> DataFrame:
    """Every interval on every date of an irregular grid on which it holds.

    A range join without a join: the grid, which has at most one entry for a day of the calendar, becomes
    a sorted array, and an array over its days tells how many dates lie at or before each. Two lookups turn
    an interval into a range of places in the grid, and that slice is the result. Intervals are neither
    copied nor shuffled, however long they are and however sparse or dense the grid is. Both arrays are
    scalar subqueries. The grid's last date bounds open intervals; intervals without a start hold nowhere.
    """
    grid = dates.select(F.col(date_col).cast("date").alias("_d")).where("_d IS NOT NULL")
    places = grid.agg(F.array_sort(F.collect_set("_d")).alias("d"))  # collect_set: distinct before the shuffle
    days_to_next = "coalesce(datediff(get(d, i + 1), x), 1)"
    counts = places.select(F.expr(f"flatten(transform(d, (x, i) -> array_repeat(i + 1, {days_to_next})))").alias("n"))
    all_dates, upto = places.scalar(), counts.scalar()
    first, last = F.get(all_dates, F.lit(0)), F.get(all_dates, F.size(all_dates) - 1)
    low, high = F.greatest("valid_from", first), F.least(F.coalesce(F.date_sub("valid_to", 1), last), last)
    place = lambda day: F.coalesce(F.get(upto, F.datediff(day, first)), F.lit(0))  # noqa: E731  dates at or before
    held = ledger.where(F.col("valid_from").isNotNull() & (low <= high))
    before = place(F.date_sub(low, 1))
    return held.select(*ledger.columns, F.explode(F.slice(all_dates, before + 1, place(high) - before)).alias(date_col))


def holdings_on_grid(ledger: DataFrame, start: str, end: str, step_days: int, date_col: str = "date") -> DataFrame:
    """The same on the regular grid start, start + step, ... up to end: no join, linear in the result."""
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    skip = F.greatest(F.ceil(F.datediff("valid_from", s) / F.lit(step_days)), F.lit(0)).cast("int") * F.lit(step_days)
    low, high = F.date_add(s, skip), F.least(F.coalesce(F.date_sub("valid_to", 1), e), e)
    return ledger.where(low <= high).withColumn(date_col, F.explode(F.sequence(low, high, F.expr(f"interval {int(step_days)} days"))))


def weekly_dates(spark, start: str, end: str) -> DataFrame:
    """Every seventh day from start to end, and end itself: one column, date."""
    return spark.range(1).select(F.explode(F.array_union(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 7 days")), F.array(F.lit(end).cast("date")))).alias("date"))


def trim_ramp(holdings: DataFrame, group: Sequence[str], date_col: str = "date", count_col: str = "n", share: float = 0.95) -> DataFrame:
    """Drops a group's first dates, up to the first with at least share x its median count."""
    middle = holdings.groupBy(*group).agg(F.median(count_col).alias("_median"))
    start = holdings.join(middle, list(group)).where(F.col(count_col) >= F.lit(share) * F.col("_median")).groupBy(*group).agg(F.min(date_col).alias("_start"))
    return holdings.join(start, list(group)).where(F.col(date_col) >= F.col("_start")).select(*holdings.columns)
