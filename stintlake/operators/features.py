"""Historical analytics and season features."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Replacement ranks by category.
REPLACEMENT = {"QB": 32, "RB": 36, "WR": 36, "TE": 16}
#: Sizes of the top groups by category.
TOP_SIZES = {"QB": 20, "RB": 40, "WR": 40, "TE": 20}


def category_mean_pivot(df: DataFrame, index: str, category: str, value: str, categories: Sequence[str]) -> DataFrame:
    """Mean value by index, a column for each category."""
    return df.groupBy(index).pivot(category, list(categories)).agg(F.avg(value))


def top_n_by_category(df: DataFrame, by: Sequence[str], category: str, value: str, sizes: dict[str, int], tie: Sequence[str]) -> DataFrame:
    """The top rows of every group and category; how many depends on the category (none if unnamed)."""
    n = F.coalesce(*[F.when(F.col(category) == c, F.lit(k)) for c, k in sizes.items()], F.lit(0))
    line = Window.partitionBy(*by, category).orderBy(F.desc(value), *tie)
    return df.withColumn("_n", F.row_number().over(line)).where(F.col("_n") <= n).drop("_n")


def normalised_difference(df: DataFrame, by: str, category: str, value: str, categories: Sequence[str]) -> DataFrame:
    """(value - group mean) / group sample deviation, averaged by category, pivoted."""
    group = Window.partitionBy(by)
    z = (F.col(value) - F.avg(value).over(group)) / F.nullif(F.stddev_samp(value).over(group), F.lit(0.0))
    return df.withColumn("_z", z).groupBy(by).pivot(category, list(categories)).agg(F.avg("_z"))


def season_totals(df: DataFrame, keys: Sequence[str], value: str, categories: Sequence[str], category: str = "position", kind: str = "season_type", regular: str = "REG") -> DataFrame:
    """Season sums of the regular season in the given categories."""
    return df.where((F.col(kind) == regular) & F.col(category).isin(*categories)).groupBy(*keys).agg(F.sum(value).alias(f"total_{value}"))


def recode(df: DataFrame, column: str, mapping: dict[str, str]) -> DataFrame:
    return df.replace(mapping, subset=[column])


def sum_mean_pivot(df: DataFrame, index: str, category: str, value: str, categories: Sequence[str]) -> DataFrame:
    """Sum and mean by index, columns <category>_sum and <category>_mean."""
    return df.groupBy(index).pivot(category, list(categories)).agg(F.sum(value).alias("sum"), F.avg(value).alias("mean"))


def linear_trend(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares slope and intercept, and the slope in percent of the first value."""
    fit = df.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.min_by(y, x).alias("_first"))
    return fit.withColumn("slope_pct", F.col("slope") / F.nullif(F.col("_first").cast("double"), F.lit(0.0)) * 100).drop("_first")


def optimal_bin_size(n: int) -> int:
    """Twice the cube root of the smallest group's size."""
    return int(2 * np.cbrt(n))


def bin_right_closed(df: DataFrame, column: str, size: int, bins: int, per_round: int = 32, out: str = "bin") -> DataFrame:
    """Bins (k * size, (k + 1) * size] for k < bins, labelled `round.first - round.last`; null outside.

    Two bins make a round: bin k is of round k div 2 + 1 and starts at place k * size mod per_round + 1.
    """
    k = F.ceil(F.col(column) / F.lit(size)).cast("int") - 1
    start = (k * size) % per_round
    label = F.format_string("%d.%d - %d.%d", F.floor(k / 2).cast("int") + 1, start + 1, F.floor(k / 2).cast("int") + 1, start + size)
    return df.withColumn(out, F.when((F.col(column) > 0) & (k < bins), label))


def bin_mean_pivot(df: DataFrame, bin: str, category: str, value: str, categories: Sequence[str]) -> DataFrame:
    return df.where(F.col(bin).isNotNull()).groupBy(bin).pivot(category, list(categories)).agg(F.avg(value))


def career_totals(stats: DataFrame, players: DataFrame, key: str, value: str) -> DataFrame:
    """Players with their career total and mean per game."""
    return players.join(stats.groupBy(key).agg(F.sum(value).alias(f"total_{value}"), F.avg(value).alias(f"mean_{value}")), key)


def recent_latest(df: DataFrame, key: str, value: str, date: str, as_of: str, days: int) -> DataFrame:
    """The latest value of every key within the last `days` days before as_of."""
    d, end = F.col(date).cast("date"), F.lit(as_of).cast("date")
    recent = df.where((d >= F.date_sub(end, days)) & (d <= end))
    return recent.groupBy(key).agg(F.max(F.struct(date, value)).alias("_x")).select(key, F.col(f"_x.{date}").alias(date), F.col(f"_x.{value}").alias(value))


def front_fill_range(df: DataFrame, key: str, date: str, start: str, end: str) -> DataFrame:
    """Adds, for every day from start to end, each group's first row (by date, then all columns)."""
    rest = [c for c in df.columns if c not in (key, date)]
    first = df.groupBy(key).agg(F.min(F.struct(F.col(date).alias("_d"), *rest)).alias("_x"))
    days = F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day")))
    added = first.select(key, *[F.col(f"_x.{c}").alias(c) for c in rest], days.alias(date)).withColumn(date, F.col(date).cast(df.schema[date].dataType))
    return df.unionByName(added.select(*df.columns))


def savgol_weights(window: int, degree: int) -> tuple[list[list[float]], list[float]]:
    """(weights of a window's values for the fit at each of its places, those for its middle)."""
    middle = window // 2 if window % 2 else window / 2 - 0.5
    places = np.arange(window) - middle
    fit = np.linalg.pinv(np.vander(places, degree + 1, increasing=True))
    at = lambda x: (np.vander(x, degree + 1, increasing=True) @ fit).tolist()
    return at(places), at([0.0 if window % 2 else 0.5])[0]


def savgol(df: DataFrame, by: Sequence[str], order_col: str, value: str, window: int = 20, degree: int = 3, out: str = "smooth") -> DataFrame:
    """Savitzky-Golay smoothing of each group: a polynomial fitted to a moving window, the window's ends by
    the fits of the first and last window. Groups shorter than the window stay as they are.

    The fit at a place is a fixed weighted sum of the window's values, so a row needs the window - 1 rows on
    either side of it, a sliding frame, and never its whole series. A null among the values of a window
    gives null. Rows of one order value are in the order of their values.
    """
    weights, inner = savgol_weights(window, degree)
    head, array = window // 2, lambda ws: F.array(*[F.lit(float(w)) for w in ws])
    line = Window.partitionBy(*by).orderBy(order_col, value)
    near = F.collect_list(F.struct(F.col(value).cast("double").alias("y"))).over(line.rowsBetween(1 - window, window - 1))
    rows = df.withColumns({"_near": near, "_before": F.count(F.lit(1)).over(line.rowsBetween(1 - window, -1)).cast("int")})
    rows = rows.withColumn("_after", F.size("_near") - F.col("_before") - 1)
    last = F.col("_after") < window - 1 - head  # the window can't reach further: the last one
    start = F.when(last, F.size("_near") - window).when(F.col("_before") >= head, F.col("_before") - head).otherwise(0)
    rows = rows.withColumn("_start", start)
    place = F.col("_before") - F.col("_start")
    chosen = F.when(~last & (place == head), array(inner)).otherwise(F.get(F.array(*[array(w) for w in weights]), place))
    fitted = F.aggregate(F.zip_with(chosen, F.slice("_near", F.col("_start") + 1, window), lambda w, x: w * x["y"]), F.lit(0.0), lambda t, x: t + x)
    smooth = F.when(F.size("_near") < window, F.col(value).cast("double")).otherwise(fitted)
    return rows.withColumn(out, smooth).select(*df.columns, out)


def recency_counts(players: DataFrame, values: DataFrame, key: str, date: str, as_of: str, thresholds: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """(players with their latest value date and days since; counts of players beyond each threshold)."""
    last = values.groupBy(key).agg(F.max(date).alias("latest_date"))
    df = players.join(last, key, "left").withColumn("days_since", F.datediff(F.lit(as_of).cast("date"), F.col("latest_date").cast("date")))
    counts = df.agg(*[F.count(F.when(F.col("days_since") > t, 1)).alias(f"over_{t}") for t in thresholds], F.count(F.when(F.col("latest_date").isNull(), 1)).alias("never"))
    return df, counts


def retired_flag(df: DataFrame, key: str, season: str = "season", latest: str = "latest_date") -> DataFrame:
    """is_retired: no value at all and no season as late as the table's last."""
    top = df.agg(F.max(season).alias("_top"))
    own = F.max(season).over(Window.partitionBy(key))
    return df.crossJoin(F.broadcast(top)).withColumn("is_retired", F.col(latest).isNull() & (own < F.col("_top"))).drop("_top")  # one row


def season_features(df: DataFrame, key: str, season: str, points: str, sums: Sequence[str], firsts: Sequence[str], order: str) -> DataFrame:
    """One row a key and season: statistics of points, sums, and the first value of each attribute."""
    points_of = [F.avg(points).alias("avg_points"), F.max(points).alias("max_points"), F.min(points).alias("min_points"), F.stddev_samp(points).alias("std_points"), F.sum(points).alias("total_points"), F.count(points).alias("games_played")]
    first = [F.min(F.when(F.col(c).isNotNull(), F.struct(order, c))).getField(c).alias(c) for c in firsts]
    return df.groupBy(key, season).agg(*first, *points_of, *[F.sum(c).alias(f"{c}_sum") for c in sums])


def impute(df: DataFrame, key: str, season: str, birth: str, std: str, category: str) -> DataFrame:
    """age = season - birth year, else 22 + seasons since the first; missing deviations take the category's
    median, then the median of all rows with a category."""
    first = F.min(season).over(Window.partitionBy(key))
    by = df.where(F.col(category).isNotNull()).groupBy(category).agg(F.median(std).alias("_own"))
    every = df.where(F.col(category).isNotNull()).agg(F.median(std).alias("_all"))
    out = df.withColumn("age", F.coalesce(F.col(season) - F.year(birth), F.col(season) - first + 22).cast("int"))
    out = out.join(by, category, "left").crossJoin(F.broadcast(every))  # one row
    return out.withColumn(std, F.coalesce(std, "_own", "_all")).drop("_own", "_all").select(*df.columns, "age")


def vorp(df: DataFrame, season: str, category: str, value: str, levels: dict[str, int] = REPLACEMENT, out: str = "vorp") -> DataFrame:
    """Value over the n-th best (the last if there are fewer) of each season and category in `levels`."""
    group = Window.partitionBy(season, category)
    n = F.coalesce(*[F.when(F.col(category) == c, F.lit(k)) for c, k in levels.items()])
    place = F.row_number().over(group.orderBy(F.desc(value)))
    df = df.where(F.col(category).isin(*levels)).withColumns({"_place": place, "_count": F.count("*").over(group)})
    level = F.max(F.when(F.col("_place") == F.least(n, F.col("_count")), F.col(value))).over(group)
    return df.withColumn(out, F.col(value) - level).drop("_place", "_count")


def cumulative(df: DataFrame, key: str, order: str, columns: Sequence[str]) -> DataFrame:
    """Running sums as cumulative_<column>, and the row's number as career_length."""
    line = Window.partitionBy(key).orderBy(order)
    upto = line.rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({**{f"cumulative_{c}": F.sum(c).over(upto) for c in columns}, "career_length": F.row_number().over(line)})


def career_join(df: DataFrame, key: str, order: str) -> DataFrame:
    """Every cumulative_<c> column's last value as <c>_career_total, and total_career_length."""
    whole = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = {f"{c.removeprefix('cumulative_')}_career_total": F.last(c).over(whole) for c in df.columns if c.startswith("cumulative_")}
    return df.withColumns({**totals, "total_career_length": F.max("career_length").over(Window.partitionBy(key))})


def remaining_value(df: DataFrame, key: str, order: str, value: str = "vorp") -> DataFrame:
    """Cumulative, total and remaining value of a career; nulls are 0."""
    line = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    v = F.coalesce(value, F.lit(0.0))
    df = df.withColumns({value: v, f"cumulative_{value}": F.sum(v).over(line), f"total_career_{value}": F.sum(v).over(Window.partitionBy(key))})
    return df.withColumn(f"remaining_career_{value}", F.col(f"total_career_{value}") - F.col(f"cumulative_{value}"))


def null_audit(df: DataFrame) -> DataFrame:
    """column_name, n_null, share of every column, in one pass."""
    counts = df.agg(F.count("*").alias("_n"), *[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("n_null")) for c in df.columns])
    return counts.select("_n", F.explode(rows).alias("x")).select("x.column_name", "x.n_null", F.coalesce(F.col("x.n_null") / F.nullif("_n", F.lit(0)), F.lit(0.0)).alias("share"))


def feature_sequences(df: DataFrame, key: str, order: str, features: Sequence[str], target: str, length: int = 5) -> DataFrame:
    """Standardised features (population deviation; constant ones are 0) of each key's last `length` rows as
    array<array<double>>, zero rows in front of shorter ones, and the last row's target."""
    stats = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in features], *[F.stddev_pop(c).alias(f"_s_{c}") for c in features])
    scaled = df.crossJoin(F.broadcast(stats))  # one row
    vector = F.array(*[F.coalesce((F.col(c) - F.col(f"_m_{c}")) / F.nullif(f"_s_{c}", F.lit(0.0)), F.lit(0.0)) for c in features])
    line = Window.partitionBy(key).orderBy(F.desc(order))
    last = scaled.withColumns({"_v": vector, "_n": F.row_number().over(line)}).where(F.col("_n") <= length)
    rows = last.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col("_v").alias("v")))), lambda x: x["v"]).alias("_rows"), F.max(F.struct(F.col(order).alias("o"), F.col(target).alias("t"))).getField("t").alias("target"))
    zero = F.array(*[F.lit(0.0) for _ in features])
    return rows.select(key, F.concat(F.array_repeat(zero, F.lit(length) - F.size("_rows")), F.col("_rows")).alias("sequence"), "target")


def split(df: DataFrame, fraction: float, key: str, seed: int = 42) -> DataFrame:
    """Adds is_train: a share `fraction` of the keys, decided by eight digits of md5(seed:key) alone. A null
    key is hashed as the text 'null'."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null")))), 1, 8)
    return df.withColumn("is_train", F.conv(digits, 16, 10).cast("long") % 10_000 < int(fraction * 10_000))
