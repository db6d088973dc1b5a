"""What one task has to hold at once: operators that keep as much as their rows must not pile up in it."""

from __future__ import annotations

from collections import defaultdict
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stintlake.operators import dedupe, flatten, intervals, measures
from stintlake.plans import ledger, q_sources


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_power_index_holds_no_map_of_rows_beside_a_sort(spark):
    day, other = date(2024, 1, 1), date(2024, 1, 2)
    assets = [("t1", "L", day, f"a{i}", 100 * i) for i in range(1, 6)] + [("t2", "L", day, "b1", 900), ("t2", "L", day, "b2", 0), ("t3", None, day, "c1", 50), ("t3", None, day, "c2", 50), ("t1", "L", other, "a1", 70), ("t4", "M", other, "d1", 5), ("t4", "L", other, "d2", 9)]
    df = measures.power_index(spark.createDataFrame(assets, "franchise_id string, league_lineage_id string, date date, asset_id string, value bigint"))
    slots, sums, best = defaultdict(list), defaultdict(float), defaultdict(float)
    own = defaultdict(list)
    for team, league, d, asset, v in assets:
        if v > 0:
            own[d, team].append((-v, asset, league))
    placed = [(team, league, d, i, -v) for (d, team), x in own.items() for i, (v, _, league) in enumerate(sorted(x, key=lambda r: r[:2]))]
    for _, league, d, i, v in placed:
        slots[league, d, i].append(v)
    for team, league, d, i, v in placed:
        a = sum(slots[league, d, i]) / len(slots[league, d, i])
        s = max(a, 0.1)
        sums[team, league, d] += (0.05 * (v / 10100.0) ** 1.3 + 0.05 * (v / (1.05 * s)) + 0.1) * v * ((2.0 * (v / 10200.0) ** 1.3 + (s / 10200.0) ** 1.2) / 3.0 * 0.7 + 0.3)
    for (_, league, d), v in sums.items():
        best[league, d] = max(best[league, d], v)
    want = sorted(((t, lg, d, round(v, 6), int(v / best[lg, d] * 99)) for (t, lg, d), v in sums.items()), key=repr)
    assert rows(df.withColumn("adj_total", F.round("adj_total", 6)), "franchise_id", "league_lineage_id", "date", "adj_total", "power_index") == want
    assert "Aggregate" not in plan(df)


def test_pick_intervals_derive_trades_once(spark):
    life = spark.createDataFrame([("N", "N_1", "2026:1:1", 10, date(2024, 1, 1), None)], "league_lineage_id string, franchise_id string, pick_id string, mint_ts bigint, mint_date date, consume_date date")
    trades = spark.range(2).selectExpr("'N' AS league_lineage_id", "'2026:1:1' AS pick_id", "concat('N_', id + 1) AS prev_franchise", "concat('N_', id + 2) AS new_franchise", "20 + id AS ts", "date_add(DATE '2024-02-01', CAST(id AS INT)) AS date")
    df = ledger.reconstruct_pick_intervals(life, trades)
    assert rows(df, "franchise_id", "valid_from", "valid_to") == [("N_1", date(2024, 1, 1), date(2024, 2, 1)), ("N_2", date(2024, 2, 1), date(2024, 2, 2)), ("N_3", date(2024, 2, 2), None)]
    assert plan(df).count("Range (") == 1


def test_trade_events_shuffle_items_once(spark):
    items = spark.range(8).selectExpr("concat('T', id % 3) AS transaction_id", "'L' AS league_id", "'2026' AS season", "1 AS round", "id % 2 AS roster_id", "id AS owner_id", "9 AS previous_owner_id")
    txns = spark.createDataFrame([("T0", "complete", 5), ("T1", "complete", 6), ("T1", "complete", 4), ("T2", "failed", 7)], "transaction_id string, status string, created bigint")
    names = spark.createDataFrame([("L", "N")], "league_id string, league_lineage_id string")
    df = ledger.pick_trade_events(items, None, None, txns, names.hint("broadcast"))
    assert rows(df, "pick_id", "new_franchise", "ts") == [("2026:1:0", "N_0", 5), ("2026:1:0", "N_4", 4), ("2026:1:1", "N_1", 4), ("2026:1:1", "N_3", 5)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(ledger.pick_trade_events(items, None, None, txns, names.hint("broadcast")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Exchange hashpartitioning") - text.count("Exchange hashpartitioning(league_id") == 2  # items, transactions


def test_repeated_items_change_no_stint(spark):
    txns = spark.createDataFrame([("T0", "complete", 5), ("T1", "complete", 900_000_000)], "transaction_id string, status string, created bigint")
    moves = spark.createDataFrame([("T0", "L", 1, "p", "add")] * 3 + [("T1", "L", 1, "p", "drop")] * 2 + [("T1", "L", 2, "p", "add")], "transaction_id string, league_id string, roster_id bigint, player_id string, action string")
    drafts = spark.createDataFrame([("D", "L", None, 1)], "draft_id string, league_id string, last_picked bigint, start_time bigint")
    chosen = spark.createDataFrame([("D", 3, "q")], "draft_id string, roster_id bigint, player_id string")
    names = spark.createDataFrame([("L", "N")], "league_id string, league_lineage_id string")
    once, all_ = (ledger.player_events(txns, moves, drafts, chosen, names, repeated=r) for r in (False, True))
    key = ["league_lineage_id", "franchise_id", "player_id"]
    assert (once.count(), all_.count()) == (4, 7)
    assert rows(intervals.build_event_intervals(all_, key)) == rows(intervals.build_event_intervals(once, key))


def test_keyed_choice_keeps_rows_where_their_keys_are(spark):
    df = spark.createDataFrame([(1, "b", 2.0, {"m": 1}), (1, "a", 3.0, {"m": 2}), (2, None, 1.0, None)], "k bigint, t string, x double, m map<string,int>")
    assert rows(dedupe.keep_first(df, ["k"], []), "k", "t", "x", "m") == [(1, "a", 3.0, {"m": 2}), (2, None, 1.0, None)]
    assert rows(dedupe.keep_last(df.drop("m"), ["k"], ["x"])) == [(1, "a", 3.0), (2, None, 1.0)]
    zero = spark.createDataFrame([(-0.0, "z")], "x double, t string")
    assert str(dedupe.keep_first(zero, ["x"], []).first()["x"]) == "-0.0"
    joined = dedupe.keep_first(df.drop("m"), ["k"], []).join(spark.range(3).withColumnRenamed("id", "k").hint("merge"), "k")
    assert plan(joined).count("Exchange hashpartitioning") == 2


def test_draft_picks_are_parsed_once_and_sorted_apart_from_their_grouping(spark, tmp_path):
    lines = [(o, n, float(o % 50), o * 7 + n, "R" if o % 2 else "N", "F", 0.01 * (o % 9)) for o in (1, 2, 501, 502, 1001) for n in (1, 2)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_quantity double, l_partkey bigint, l_returnflag string, l_linestatus string, l_tax double").write.parquet(f"{tmp_path}/lineitem.parquet")
    df = q_sources.b11_draft_picks(spark, str(tmp_path))
    assert rows(df, "draft_id", "pick_no", "player_id", "player_news_updated_iso") == [("1", 1, "7008", "2023-11-14T22:13:20+00:00"), ("1", 2, "7009", "2023-11-14T22:13:20+00:00"), ("2", 1, "3515", "2023-11-14T22:13:20+00:00"), ("2", 2, "3516", "2023-11-14T22:13:20+00:00")]
    text = plan(df)
    assert text.count("from_json(") == 1
    assert [s.count("Sort [") for s in text.split("Exchange hashpartitioning")] == [1, 1, 1, 1]


def test_parse_leaves_out_missing_documents_and_keeps_bad_ones_null(spark):
    docs = spark.createDataFrame([(1, '{"a": "x", "b": 2}'), (2, None), (3, "no json"), (4, "{}"), (5, "")], "arrival int, doc string")
    old = docs.select("arrival", F.from_json("doc", "a string, b bigint").alias("d")).where("d IS NOT NULL").select("arrival", "d.*")
    assert rows(flatten.parse(docs, "a string, b bigint", ["arrival"])) == rows(old)


@pytest.mark.parametrize("entity", ["draft_picks", "matchups", "drafts", "traded_picks", "rosters", "transactions", "users"])
def test_harvest_broadcasts_no_documents(spark, entity):
    key = {"transactions": "transaction_id", "users": "user_id", "drafts": "draft_id", "draft_picks": "player_id"}.get(entity, "roster_id")
    listed = spark.range(9).groupBy((F.col("id") % 3).alias("n")).agg(F.collect_list(F.create_map(F.lit(key), "id", F.lit("week"), F.col("id") % 3)).alias(entity))
    docs = listed.select(F.to_json(F.struct(F.concat(F.lit("L"), "n").alias("league_id"), entity)).alias("doc"))
    lineage = spark.range(1000).selectExpr("concat('L', 1 + id % 500) AS league_id", "concat('R', id DIV 500) AS league_lineage_id")  # none of L0, two of the others
    df = flatten.harvest_tables(docs, lineage)[entity]
    assert rows(df, "league_id", key, "league_lineage_id") == sorted((f"L{i % 3}", str(i), f"R{r}") for i in range(9) if i % 3 for r in (0, 1))
    assert "BroadcastExchange" not in plan(df)
