import datetime as dt

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from stintlake.functions import coerce
from stintlake.operators import calendar, dedupe, features, intervals, measures, values


def test_pick_names(spark):
    daily = spark.createDataFrame([("2025-01-01", "2026 Early 1st", 6299, 5629), ("2025-01-01", "2027 Mid 3rd", 10, None), ("2025-01-01", "Kenny Pickett", 1, 1)], "valuation_date string, playerName string, sf_value long, oneqb_value long")
    out = rows(values.parse_season_tier_round(daily), "season", "round", "tier", "qb_format", "value")
    assert out == [(2026, 1, "Early", "1QB", 5629.0), (2026, 1, "Early", "SF", 6299.0), (2027, 3, "Mid", "SF", 10.0)]
    old = spark.createDataFrame([("Early 2026 1st", dt.datetime(2024, 1, 1), 5), ("Early 2026 1st", dt.datetime(2099, 1, 1), 6)], "display_name string, date timestamp, value short")
    assert rows(values.parse_tier_season_round(old, "2025-01-01"), "valuation_date", "value") == [("2024-01-01", 5.0)]
    feed = spark.createDataFrame([("2025-01-01", "PICK", "2026 1st", 3), ("2025-01-01", "PICK", "2026 Pick 1.09", 4), ("2025-01-01", "QB", "2026 1st", 9)], "valuation_date string, position string, name string, value long")
    assert rows(values.parse_round_generic(feed), "season", "tier", "value") == [(2026, "NA", 3.0)]
    assert rows(values.parse_exact_slot(feed, date="valuation_date"), "season", "round", "slot", "value") == [("2026", 1, 9, 4)]


def test_precedence_of_feeds(spark):
    s = ", ".join(f"{c} {'double' if c == 'value' else 'long' if c in ('season', 'round') else 'string'}" for c in values.LONG)
    row = lambda season, v: ("2025-01-01", season, 1, "Mid", "DYNASTY", "SF", "Standard", v)
    out = values.build_pick_values(spark.createDataFrame([row(2026, 1.0)], s), spark.createDataFrame([row(2026, 9.0), row(2027, 2.0)], s))
    assert rows(out, "season", "value") == [(2026, 1.0), (2027, 2.0)]


def test_unknown_tier_source(spark):
    with pytest.raises(ValueError, match="unknown value source"):
        values.tier_proxy(spark.createDataFrame([("Mid",)], "tier string"), "other", {"a": "Mid"})


def test_single_source_pivot_has_both_columns(spark):
    df = spark.createDataFrame([("2025-01-01", "1", "DYNASTY", "SF", "Standard", "ktc", 5)], "valuation_date string, player_id string, market_type string, qb_format string, te_premium string, source_system string, value long")
    assert rows(values.build_fact(df, {"ktc": "ktc_value", "fc": "fc_value"}), "ktc_value", "fc_value", "value_diff") == [(5.0, 0.0, 5.0)]


def test_ambiguous_names_go_to_quarantine(spark):
    players = spark.createDataFrame([("1", "A", 11), ("2", "A", None), ("3", "B", None)], "player_id string, name string, ktc_id long")
    staging = spark.createDataFrame([("ktc", "11", None), ("fc", "x", "A"), ("fc", "y", "B"), ("ktc", "99", None)], "source_system string, source_id string, asset_name string")
    good, bad = values.resolve_and_split(staging, players, "ktc", "fc")
    assert rows(good, "source_id", "player_id") == [("11", "1"), ("y", "3")]
    assert rows(bad) == [("fc", "A"), ("ktc", "99")]


def test_calendar_phases(spark):
    games = spark.createDataFrame([(2023, "REG", "2023-09-07"), (2023, "REG", "2024-01-07"), (2023, "WC", "2024-01-13"), (2023, "SB", "2024-02-11"), (2024, "REG", "2024-09-05"), (2024, "REG", "2025-01-05")], "season long, game_type string, gameday string")
    got = {str(r["date"]): (r["phase"], r["season"]) for r in calendar.build_dim_dates(games, end="2025-02-01").collect()}
    assert got["2023-09-07"] == ("regular", 2023) and got["2024-01-13"] == ("playoffs", 2023) and got["2024-03-01"] == ("offseason", 2024) and got["2025-01-20"] == ("playoffs", 2024)
    assert len(got) == (dt.date(2025, 2, 1) - dt.date(2023, 9, 7)).days + 1


def test_draft_slots(spark):
    table = spark.createDataFrame([("L", 1, 5, 10), ("L", 2, 3, 20), ("L", 3, 3, 10)], "league_id string, roster_id long, wins long, fpts long")
    league = spark.createDataFrame([("L", "2024", 3)], "league_id string, season string, total_rosters long")
    assert rows(measures.compute_draft_slots(table, league), "roster_id", "slot", "tier", "draft_season") == [(1, 3, "Late", 2025), (2, 2, "Mid", 2025), (3, 1, "Early", 2025)]


def test_coercers(spark):
    df = spark.createDataFrame([(" 12 ",), ("",), ("N/A",), ("1,200.5",), ("x",), (None,)], "t string")
    assert [tuple(r) for r in df.select(coerce.to_int_or_null("t"), coerce.to_float_or_null("t"), coerce.to_str_or_null("t")).collect()] == [(12, 12.0, "12"), (None, None, None), (None, None, "N/A"), (None, 1200.5, "1,200.5"), (None, None, "x"), (None, None, None)]
    assert [r[0] for r in spark.range(1).select(coerce.ms_to_iso("id")).collect()] == ["1970-01-01T00:00:00+00:00"]


def test_smoothing_reproduces_cubics(spark):
    points = [("k", i, float(i**3 - 5 * i)) for i in range(40)] + [("short", i, float(i)) for i in range(5)]
    out = features.savgol(spark.createDataFrame(points, "k string, i int, y double"), ["k"], "i", "y")
    assert all(abs(r["smooth"] - r["y"]) < 1e-6 * max(1, abs(r["y"])) for r in out.collect())


def test_replacement_level_and_sequences(spark):
    df = spark.createDataFrame([(i, 2020, "QB", 10 * i) for i in range(1, 5)], "id int, season int, position string, pts int")
    assert rows(features.vorp(df, "season", "position", "pts", {"QB": 3}), "id", "vorp") == [(1, -10), (2, 0), (3, 10), (4, 20)]
    seq = features.feature_sequences(df, "id", "season", ["pts"], "pts", 3).collect()
    assert all(len(r["sequence"]) == 3 and r["sequence"][0] == [0.0] for r in seq)


def test_split_is_a_function_of_the_key(spark):
    df = spark.range(4000).selectExpr("id", "id % 1000 AS player")
    of = lambda frame: {r["player"]: r["is_train"] for r in features.split(frame, 0.8, "player").collect()}
    marks = of(df)
    assert features.split(df, 0.8, "player").select("player", "is_train").distinct().count() == 1000  # no key on both sides
    assert 0.75 < sum(marks.values()) / 1000 < 0.85
    assert of(df.orderBy(F.desc("id")).repartition(5)) == marks


@pytest.mark.parametrize(("window", "degree"), [(7, 2), (9, 3)])
def test_smoothing_is_a_local_fit(spark, window, degree):
    values_ = [float((k * 37) % 11) for k in range(25)]
    df = spark.createDataFrame([("a", k, v) for k, v in enumerate(values_)], "s string, k int, v double")
    got = {r["k"]: r["smooth"] for r in features.savgol(df, ["s"], "k", "v", window, degree).collect()}
    half = window // 2
    for k in range(25):
        middle = min(max(k, half), 24 - half)  # the ends take the fit of the first and last window
        x = np.arange(-half, half + 1)
        assert abs(got[k] - np.polyval(np.polyfit(x, values_[middle - half : middle + half + 1], degree), k - middle)) < 1e-8


def test_kept_rows_are_those_of_a_numbered_window(spark):
    rows = [(k % 3, None if k % 5 == 0 else k % 4, dt.date(2024, 1, 1 + k % 6) if k % 7 else None, float("nan") if k == 11 else k / 3, "abc"[k % 3], k % 2 == 0) for k in range(40)]
    df = spark.createDataFrame(rows, "id int, n int, d date, f double, t string, b boolean")
    for column in ("n", "d", "f", "t", "b"):
        for keep, order in ((dedupe.keep_first, F.col(column)), (dedupe.keep_last, F.desc(column))):
            line = Window.partitionBy("id").orderBy(order, "n", "d", "f", "t", "b")
            want = df.withColumn("_n", F.row_number().over(line)).where("_n = 1").drop("_n")
            assert sorted(map(str, keep(df, ["id"], [column]).collect())) == sorted(map(str, want.collect())), column


def test_unknown_franchises_stay_in_the_index(spark):
    held = spark.sql("SELECT * FROM VALUES ('f1', 'p', 'player', date'2024-01-01'), ('f2', 'p', 'player', date'2024-01-01') AS t(franchise_id, asset_id, asset_type, snapshot_date)")
    ledger = intervals.build_snapshot_intervals(held, ["franchise_id", "asset_id", "asset_type"])
    prices = spark.sql("SELECT 'p' AS player_id, date'2023-12-01' AS valuation_date, 5000L AS value")
    known = spark.sql("SELECT 'f1' AS franchise_id, 'L' AS league_lineage_id")
    out = measures.team_power_index(ledger, intervals.weekly_dates(spark, "2024-01-01", "2024-01-01"), prices, known)
    assert {(r["franchise_id"], r["league_lineage_id"], r["power_index"]) for r in out.collect()} == {("f1", "L", 99), ("f2", None, 99)}
