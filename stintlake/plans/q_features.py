"""Queries of historical analytics and season features (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stintlake.operators import dedupe, features
from stintlake.plans.registry import derive, query

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
SPENT = "SELECT CAST(o_orderdate AS DATE) AS date, c_mktsegment AS position, o_orderkey AS id, CAST(floor(o_totalprice) AS BIGINT) AS value FROM {orders} JOIN {customer} ON o_custkey = c_custkey"


def _pivot(expr: str, names=SEGMENTS, category: str = "position") -> str:
    return ", ".join(f"{expr.format(c=f'{category} = {chr(39)}{n}{chr(39)}')} AS {n}" for n in names)


def _spent(spark, d):
    return derive(spark, d, SPENT)


@query(f"SELECT date, {_pivot('avg(value) FILTER ({c})')} FROM s GROUP BY date", s=SPENT)
def h1_category_mean_pivot(spark, d):
    return features.category_mean_pivot(_spent(spark, d), "date", "position", "value", SEGMENTS)


SIZES = {"AUTOMOBILE": 2, "BUILDING": 4, "FURNITURE": 4, "HOUSEHOLD": 1}
_TOP = "t AS (SELECT *, row_number() OVER (PARTITION BY date, position ORDER BY value DESC, id) AS rn FROM s), top AS (SELECT date, position, id, value FROM t WHERE rn <= CASE position WHEN 'AUTOMOBILE' THEN 2 WHEN 'BUILDING' THEN 4 WHEN 'FURNITURE' THEN 4 WHEN 'HOUSEHOLD' THEN 1 ELSE 0 END)"


def _top(spark, d):
    return features.top_n_by_category(_spent(spark, d), ["date"], "position", "value", SIZES, ["id"])


@query(f"WITH {_TOP} SELECT * FROM top", s=SPENT)
def h2_top_n_by_category(spark, d):
    return _top(spark, d)


@query(f"WITH {_TOP}, z AS (SELECT date, position, (value - avg(value) OVER w) / nullif(stddev_samp(value) OVER w, 0) AS z FROM top WINDOW w AS (PARTITION BY date)) SELECT date, {_pivot('round(avg(z) FILTER ({c}), 6) + 0.0', tuple(SIZES))} FROM z GROUP BY date", s=SPENT)
def h3_normalised_difference(spark, d):
    out = features.normalised_difference(_top(spark, d), "date", "position", "value", tuple(SIZES))
    return out.select("date", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in SIZES])


#: Lines as games: a part is a player, its ship year the season, the quantity the points.
GAMES = """SELECT l_partkey AS id, CAST(year(l_shipdate) AS INT) AS season, l_orderkey * 10 + l_linenumber AS game, CASE p_partkey % 6 WHEN 0 THEN 'QB' WHEN 1 THEN 'HB' WHEN 2 THEN 'RB' WHEN 3 THEN 'WR' WHEN 4 THEN 'TE' ELSE 'FB' END AS position,
  CASE WHEN l_linestatus = 'O' THEN 'REG' ELSE 'POST' END AS season_type, CAST(l_quantity AS BIGINT) AS points, l_suppkey AS yards, p_size AS height FROM {lineitem} JOIN {part} ON l_partkey = p_partkey"""
KINDS = ("QB", "RB", "WR", "TE")


def _games(spark, d):
    return derive(spark, d, GAMES)


@query("SELECT id, season, position, CAST(sum(points) AS BIGINT) AS total_points FROM g WHERE season_type = 'REG' AND position IN ('QB', 'RB', 'WR', 'TE') GROUP BY ALL", g=GAMES)
def h4_season_totals(spark, d):
    return features.season_totals(_games(spark, d), ["id", "season", "position"], "points", KINDS)


@query("SELECT CASE WHEN position IN ('HB', 'FB') THEN 'RB' ELSE position END AS position, count(*) AS n FROM g GROUP BY 1", g=GAMES)
def h5_recode(spark, d):
    return features.recode(_games(spark, d), "position", {"HB": "RB", "FB": "RB"}).groupBy("position").agg(F.count("*").alias("n"))


@query("SELECT season, " + ", ".join(f"CAST(sum(points) FILTER (position = '{k}') AS BIGINT) AS {k}_sum, avg(points) FILTER (position = '{k}') AS {k}_mean" for k in KINDS) + " FROM g GROUP BY season", g=GAMES)
def h6_sum_mean_pivot(spark, d):
    return features.sum_mean_pivot(_games(spark, d), "season", "position", "points", KINDS)


@query("WITH t AS (SELECT position, season, CAST(sum(points) AS BIGINT) AS total FROM g GROUP BY ALL) SELECT position, round(regr_slope(total, season), 4) AS slope, round(regr_intercept(total, season), 0) AS intercept, round(regr_slope(total, season) / arg_min(total, season) * 100, 4) AS slope_pct FROM t GROUP BY position", g=GAMES)
def h7_linear_trend(spark, d):
    totals = _games(spark, d).groupBy("position", "season").agg(F.sum("points").alias("total"))
    out = features.linear_trend(totals, "season", "total", ["position"])
    return out.select("position", F.round("slope", 4).alias("slope"), F.round("intercept", 0).alias("intercept"), F.round("slope_pct", 4).alias("slope_pct"))


PICKED = "SELECT p_partkey AS id, CAST(p_partkey % 150 AS INT) AS draft_number, CASE p_partkey % 4 WHEN 0 THEN 'QB' WHEN 1 THEN 'RB' WHEN 2 THEN 'WR' ELSE 'TE' END AS position, CAST(floor(p_retailprice) AS BIGINT) AS ppg FROM {part}"
_BINS = "k AS (SELECT *, CAST(ceil(draft_number / 16.0) AS INT) - 1 AS k FROM p), b AS (SELECT id, draft_number, position, ppg, CASE WHEN draft_number > 0 AND k < 8 THEN format('{}.{} - {}.{}', k // 2 + 1, k * 16 % 32 + 1, k // 2 + 1, k * 16 % 32 + 16) END AS bin FROM k)"


def _bins(spark, d):
    return features.bin_right_closed(derive(spark, d, PICKED), "draft_number", 16, 8)


@query("WITH " + _BINS.replace("{}", "@@") + " SELECT * FROM b", p=PICKED)
def h8_bin_right_closed(spark, d):
    return _bins(spark, d)


@query("WITH " + _BINS.replace("{}", "@@") + f" SELECT bin, {_pivot('avg(ppg) FILTER ({c})', KINDS)} FROM b WHERE bin IS NOT NULL GROUP BY bin", p=PICKED)
def h9_bin_mean_pivot(spark, d):
    return features.bin_mean_pivot(_bins(spark, d), "bin", "position", "ppg", KINDS)


@query("SELECT p_partkey AS id, p_name, CAST(sum(points) AS BIGINT) AS total_points, avg(points) AS mean_points FROM g JOIN part ON p_partkey = id GROUP BY ALL", g=GAMES)
def h10_career_totals(spark, d):
    players = derive(spark, d, "SELECT p_partkey AS id, p_name FROM {part}")
    return features.career_totals(_games(spark, d), players, "id", "points")


DAYS = "SELECT user_id, CAST(ts AS DATE) AS date, CAST(floor(max(value) * 100) AS BIGINT) AS value FROM {events} GROUP BY user_id, CAST(ts AS DATE)"


@query("SELECT user_id, max(date) AS date, arg_max(value, date) AS value FROM v WHERE date BETWEEN DATE '2024-01-25' - 5 AND DATE '2024-01-25' GROUP BY user_id", v=DAYS)
def h11_recent_latest(spark, d):
    return features.recent_latest(derive(spark, d, DAYS), "user_id", "value", "date", "2024-01-25", 5)


@query("SELECT p_partkey, p_name FROM part QUALIFY count(*) OVER (PARTITION BY p_name) > 1")
def h12_duplicated(spark, d):
    return dedupe.duplicated(derive(spark, d, "SELECT p_partkey, p_name FROM {part}"), "p_name")


@query("WITH f AS (SELECT user_id, arg_min(value, date) AS value FROM v GROUP BY user_id) SELECT user_id, date, value FROM v UNION ALL SELECT user_id, CAST(unnest(generate_series(DATE '2023-12-25', DATE '2023-12-31', INTERVAL 1 DAY)) AS DATE), value FROM f", v=DAYS)
def h13_front_fill_range(spark, d):
    return features.front_fill_range(derive(spark, d, DAYS), "user_id", "date", "2023-12-25", "2023-12-31")


_WEIGHTS, _MIDDLE = features.savgol_weights(9, 3)


@query(
    f"""WITH n AS (SELECT *, list(value) OVER (PARTITION BY user_id ORDER BY date ROWS BETWEEN 8 PRECEDING AND 8 FOLLOWING) AS near, CAST(count(*) OVER (PARTITION BY user_id ORDER BY date ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS BIGINT) AS b FROM v),
s AS (SELECT *, CASE WHEN len(near) - b - 1 < 4 THEN len(near) - 9 WHEN b >= 4 THEN b - 4 ELSE 0 END AS st FROM n),
w AS (SELECT *, CASE WHEN len(near) - b - 1 >= 4 AND b - st = 4 THEN {_MIDDLE} ELSE {_WEIGHTS}[b - st + 1] END AS c FROM s)
SELECT user_id, date, value, round(CASE WHEN len(near) < 9 THEN value ELSE list_sum(list_transform(range(1, 10), lambda i: CAST(c[i] AS DOUBLE) * near[st + i])) END, 6) AS smooth FROM w""",
    v=DAYS,
)
def h14_savgol(spark, d):
    return features.savgol(derive(spark, d, DAYS), ["user_id"], "date", "value", 9).withColumn("smooth", F.round("smooth", 6))


LAST = "SELECT c_custkey AS id, c_name FROM {customer}"
SEEN = "SELECT o_custkey AS id, CAST(o_orderdate AS DATE) AS date FROM {orders} WHERE o_custkey % 7 <> 0"
_LATEST = "l AS (SELECT id, max(date) AS latest_date FROM s GROUP BY id), r AS (SELECT c.id, c_name, latest_date, CAST(date_diff('day', latest_date, DATE '1998-12-31') AS INT) AS days_since FROM c LEFT JOIN l USING (id))"


@query(f"WITH {_LATEST} SELECT * FROM r", c=LAST, s=SEEN)
def h15_recency(spark, d):
    return features.recency_counts(derive(spark, d, LAST), derive(spark, d, SEEN), "id", "date", "1998-12-31", (30, 90, 365))[0]


@query(f"WITH {_LATEST} SELECT count(*) FILTER (days_since > 30) AS over_30, count(*) FILTER (days_since > 90) AS over_90, count(*) FILTER (days_since > 365) AS over_365, count(*) FILTER (latest_date IS NULL) AS never FROM r", c=LAST, s=SEEN)
def h15_recency_counts(spark, d):
    return features.recency_counts(derive(spark, d, LAST), derive(spark, d, SEEN), "id", "date", "1998-12-31", (30, 90, 365))[1]


SEASONS = "SELECT DISTINCT l_partkey AS id, CAST(year(l_shipdate) AS INT) AS season, CASE WHEN l_partkey % 3 <> 0 THEN CAST('1998-01-01' AS DATE) END AS latest_date FROM {lineitem}"


@query("SELECT *, latest_date IS NULL AND max(season) OVER (PARTITION BY id) < (SELECT max(season) FROM s) AS is_retired FROM s", s=SEASONS)
def h16_retired_flag(spark, d):
    return features.retired_flag(derive(spark, d, SEASONS), "id")


_FEATURES = "f AS (SELECT id, season, arg_min(position, game) AS position, arg_min(height, game) AS height, avg(points) AS avg_points, max(points) AS max_points, min(points) AS min_points, stddev_samp(points) AS std_points, CAST(sum(points) AS BIGINT) AS total_points, count(points) AS games_played, CAST(sum(yards) AS BIGINT) AS yards_sum FROM g GROUP BY id, season)"


def _features(spark, d):
    return features.season_features(_games(spark, d), "id", "season", "points", ["yards"], ["position", "height"], "game")


@query(f"WITH {_FEATURES} SELECT id, season, position, height, round(avg_points, 6) AS avg_points, max_points, min_points, round(std_points, 6) AS std_points, total_points, games_played, yards_sum FROM f", g=GAMES)
def h17_season_features(spark, d):
    return _features(spark, d).withColumns({"avg_points": F.round("avg_points", 6), "std_points": F.round("std_points", 6)})





@query(
    f"""WITH {_FEATURES}, b AS (SELECT id, season, CASE WHEN id % 9 <> 0 THEN position END AS position, round(std_points, 6) AS std_points, CASE WHEN id % 4 <> 0 THEN make_date(1970 + CAST(id % 15 AS INT), 5, 1) END AS birth_date FROM f),
m AS (SELECT position, median(std_points) AS o FROM b WHERE position IS NOT NULL GROUP BY position), a AS (SELECT median(std_points) AS al FROM b WHERE position IS NOT NULL)
SELECT id, season, b.position, round(coalesce(std_points, o, al), 3) AS std_points, birth_date, CAST(coalesce(season - year(birth_date), season - min(season) OVER (PARTITION BY id) + 22) AS INT) AS age FROM b LEFT JOIN m ON m.position = b.position CROSS JOIN a""",
    g=GAMES,
)
def h18_impute(spark, d):
    f = _features(spark, d).select("id", "season", F.when(F.col("id") % 9 != 0, F.col("position")).alias("position"), F.round("std_points", 6).alias("std_points"), F.when(F.col("id") % 4 != 0, F.make_date((1970 + F.col("id") % 15).cast("int"), F.lit(5), F.lit(1))).alias("birth_date"))
    return features.impute(f, "id", "season", "birth_date", "std_points", "position").withColumn("std_points", F.round("std_points", 3))


_VORP = """st AS (SELECT id, season, arg_min(position, game) AS position, CAST(sum(points) AS BIGINT) AS total_points, CAST(sum(yards) AS BIGINT) AS yards FROM g GROUP BY id, season),
vp AS (SELECT *, row_number() OVER (PARTITION BY season, position ORDER BY total_points DESC) AS pl, count(*) OVER (PARTITION BY season, position) AS n FROM st WHERE position IN ('QB', 'RB', 'WR', 'TE')),
vo AS (SELECT id, season, position, total_points, yards, total_points - max(CASE WHEN pl = least(CASE position WHEN 'QB' THEN 32 WHEN 'TE' THEN 16 ELSE 36 END, n) THEN total_points END) OVER (PARTITION BY season, position) AS vorp FROM vp)"""


def _vorp(spark, d):
    f = _games(spark, d).groupBy("id", "season").agg(F.min(F.struct("game", "position")).getField("position").alias("position"), F.sum("points").alias("total_points"), F.sum("yards").alias("yards"))
    return features.vorp(f, "season", "position", "total_points")


@query(f"WITH {_VORP} SELECT * FROM vo", g=GAMES)
def h19_vorp(spark, d):
    return _vorp(spark, d)


_CUM = f"{_VORP}, cu AS (SELECT *, CAST(sum(total_points) OVER w AS BIGINT) AS cumulative_total_points, CAST(sum(yards) OVER w AS BIGINT) AS cumulative_yards, CAST(row_number() OVER w AS INT) AS career_length FROM vo WINDOW w AS (PARTITION BY id ORDER BY season))"


def _cumulative(spark, d):
    return features.cumulative(_vorp(spark, d), "id", "season", ["total_points", "yards"])


@query(f"WITH {_CUM} SELECT * FROM cu", g=GAMES)
def h20_cumulative(spark, d):
    return _cumulative(spark, d)


@query(f"WITH {_CUM} SELECT *, CAST(sum(total_points) OVER (PARTITION BY id) AS BIGINT) AS total_points_career_total, CAST(sum(yards) OVER (PARTITION BY id) AS BIGINT) AS yards_career_total, max(career_length) OVER (PARTITION BY id) AS total_career_length FROM cu", g=GAMES)
def h21_career_join(spark, d):
    return features.career_join(_cumulative(spark, d), "id", "season")


@query(
    f"WITH {_VORP} SELECT id, season, position, total_points, yards, CAST(vorp AS DOUBLE) AS vorp, CAST(sum(vorp) OVER (PARTITION BY id ORDER BY season) AS DOUBLE) AS cumulative_vorp, CAST(sum(vorp) OVER (PARTITION BY id) AS DOUBLE) AS total_career_vorp, CAST(sum(vorp) OVER (PARTITION BY id) - sum(vorp) OVER (PARTITION BY id ORDER BY season) AS DOUBLE) AS remaining_career_vorp FROM vo",
    g=GAMES,
)
def h22_remaining_value(spark, d):
    return features.remaining_value(_vorp(spark, d).withColumn("vorp", F.col("vorp").cast("double")), "id", "season")


HOLES = "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name END AS p_name, CASE WHEN p_partkey % 7 = 0 THEN p_size END AS p_size FROM {part}"


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null, (count(*) - count({c})) / count(*) AS share FROM h" for c in ("p_partkey", "p_name", "p_size")), h=HOLES)
def h23_null_audit(spark, d):
    return features.null_audit(derive(spark, d, HOLES))


@query(
    f"""WITH {_VORP}, s AS (SELECT avg(total_points) AS m1, stddev_pop(total_points) AS s1, avg(yards) AS m2, stddev_pop(yards) AS s2 FROM vo), z AS (SELECT id, season, vorp, (total_points - m1) / s1 AS a, (yards - m2) / s2 AS b, row_number() OVER (PARTITION BY id ORDER BY season DESC) AS rn FROM vo CROSS JOIN s)
SELECT id, round(sum(a), 5) AS sum_points, round(sum(b), 5) AS sum_yards, 5::INT AS n_rows, CAST(5 - count(*) AS INT) AS n_padded, arg_max(vorp, season) AS target FROM z WHERE rn <= 5 GROUP BY id""",
    g=GAMES,
)
def h24_feature_sequences(spark, d):
    out = features.feature_sequences(_vorp(spark, d), "id", "season", ["total_points", "yards"], "vorp")
    total = lambda i: F.round(F.aggregate("sequence", F.lit(0.0), lambda t, x: t + x[i]), 5)
    padded = F.size(F.filter("sequence", lambda x: (x[0] == 0.0) & (x[1] == 0.0)))
    return out.select("id", total(0).alias("sum_points"), total(1).alias("sum_yards"), F.size("sequence").alias("n_rows"), padded.alias("n_padded"), "target")


@query("SELECT c_custkey, c_name, CAST('0x' || substr(md5('42:' || CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 10000 < 8000 AS is_train FROM customer")
def h25_split(spark, d):
    return features.split(derive(spark, d, "SELECT c_custkey, c_name FROM {customer}"), 0.8, "c_custkey")
