import inspect
import json

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stintlake.operators import flatten
from stintlake.plans import q_ledger
from stintlake.sources import bucketed, io, profiles


def docs(spark, *items):
    return spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(items)], "arrival long, doc string")


def test_roster_lists_may_be_missing(spark):
    out = flatten.flatten_roster_players(docs(spark, {"league_id": "L", "roster_id": 1, "players": ["a", "b"], "taxi": ["b"], "starters": None}, {"league_id": "L", "roster_id": 2, "players": None}))
    assert rows(out, "player_id", "is_starter", "is_taxi", "is_active") == [("a", False, False, True), ("b", False, True, False)]


def test_last_traded_pick_holds(spark):
    item = {"season": "2026", "round": 1, "roster_id": 3, "owner_id": 4}
    out = flatten.flatten_traded_picks_current(docs(spark, item, item | {"owner_id": "5"}), "L")
    assert rows(out, "original_roster_id", "owner_roster_id") == [(3, 5)]


def test_league_without_id_fails(spark):
    with pytest.raises(PySparkException):
        flatten.flatten_league(docs(spark, {"name": "x", "settings": {}}), [], [])[0].collect()


def test_bulk_pick_text(spark):
    txn = {"transaction_id": "t", "league_id": "L", "draft_picks": ["3,2026,1,7,9"]}
    assert rows(flatten.flatten_transactions_bulk(docs(spark, txn))[2], "roster_id", "season", "round", "owner_id", "previous_owner_id") == [(3, "2026", 1, 7, 9)]


TXN = {
    "transaction_id": 17, "league_id": "L", "type": "trade", "status": "complete", "created": 5, "status_updated": "6", "creator": None, "leg": 2, "api_week": "x", "settings": {"waiver_bid": 3}, "metadata": {"notes": "a b"}, "waiver_budget": [{"a": 1, "b": "x y"}], "roster_ids": [1, 2],
    "adds": {"p1": 1, "p2": "no"}, "drops": {"p3": 2}, "player_map": {"p1": {"first_name": "Al", "number": 7, "years_exp": "x"}}, "draft_picks": [{"season": 2026, "round": "1", "roster_id": 3, "owner_id": 4}, None],
}


def test_transactions_are_parsed_once(spark, tmp_path):
    feed = docs(spark, TXN, {"transaction_id": "bare"}).union(spark.createDataFrame([(8, "{no json"), (9, None)], "arrival long, doc string"))
    parts = flatten.flatten_transactions(feed)
    for part in parts:
        plan = part._jdf.queryExecution().optimizedPlan().toString().lower()
        assert plan.count("parsejson") + plan.count("parse_json") == 1 and "from_json" not in plan
    head, moves, picks = ([tuple(r) for r in p.orderBy("transaction_id").collect()] for p in parts)
    assert head == [("17", "L", "trade", "complete", 5, 6, None, 2, None, 3, None, '[{"a":1,"b":"xy"}]', "a b", "[]", "[1,2]"), ("bare", *[None] * 10, "null", None, "[]", "[]")]
    assert {(r[2], r[3], r[4], r[5], r[9], r[12]) for r in moves} == {("p1", 1, "add", "Al", 7, None), ("p2", None, "add", None, None, None), ("p3", 2, "drop", None, None, None)}
    assert sorted(picks, key=repr) == sorted([("17", "L", "2026", 1, 3, None, 4), ("17", "L", None, None, None, None, None)], key=repr)
    # a table that keeps the parsed documents serves all three without a parse
    flatten.as_variant(feed).write.parquet(f"{tmp_path}/v")
    stored = flatten.flatten_transactions(spark.read.parquet(f"{tmp_path}/v"))
    for a, b in zip(parts, stored, strict=True):
        assert rows(a) == rows(b) and "parsejson" not in b._jdf.queryExecution().optimizedPlan().toString().lower()


def test_names_from_data_are_bounded(spark):
    feed = docs(spark, *[{"league_id": f"L{i}", "settings": {f"s{i}": i, "leg": 1}, "roster_positions": ["QB", f"P{i}", None]} for i in range(12)])
    assert len(flatten.flatten_league(feed)[1].columns) == 14
    parsed = flatten._leagues(feed)
    assert flatten.names_of(parsed, F.map_keys("settings"), 13) == sorted({"leg", *(f"s{i}" for i in range(12))})
    with pytest.raises(ValueError, match="more than 12"):
        flatten.names_of(parsed, F.map_keys("settings"), 12)
    assert "P3" in flatten.flatten_roster_slots(feed).columns


def test_value_history_aligns_dates(spark):
    item = {"player_id": "1", "position": "RDP", "one_qb_value": [{"d": "240101", "v": 5}, {"d": "240101", "v": 6}], "sf_pos_rank": [{"d": "240102", "v": 1}], "sf_value": [{"d": "240103", "v": 2}]}
    assert rows(flatten.value_history(docs(spark, item), "2024-02-01").withColumn("d", F.col("ranking_date").cast("string")), "d", "one_qb_value", "sf_value") == [("2024-01-01", 6.0, None), ("2024-01-03", None, 2.0)]


def test_value_history_parses_a_document_once(spark):
    item = {"player_id": "p", "position": "RDP", "one_qb_value": [{"d": "240101", "v": 5}, None], "sf_value": None, "sf_pos_rank": [{"d": "240101", "v": 1}]}
    got = flatten.value_history(docs(spark, item), "2024-02-01")
    assert rows(got.withColumn("d", F.col("ranking_date").cast("string")), "d", "one_qb_value", "sf_pos_rank") == [("2024-01-01", 5.0, None), (None, None, None)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and "Union" not in plan


def test_value_history_of_invalid_documents_is_empty(spark):
    texts = ['{"player_id": "p", "position": "RDP", "sf_value": [{"d": "240101", "v": 5}]}', '{"player_id": "q"}', None, "no json", "", "[]"]
    df = flatten.value_history(spark.createDataFrame([(x,) for x in texts], "doc string"), "2024-02-01")
    assert rows(df, "player_id", "sf_value", "one_qb_value") == [("p", 5.0, None)]


def test_projection_pages(spark):
    good = '<table id="data"><thead><tr><th>Player</th><th>FPTS</th></tr></thead><tr><td>x</td><td>1</td></tr><tbody><tr><td><a class="fp-id-7">Al B</a> KC</td><td>1,200.5</td></tr><tr><td colspan=2>ad</td></tr></tbody></table>'
    bad = good.replace("<td>1,200.5</td>", "<td>1</td><td>2</td>")
    pages = spark.createDataFrame([(1, good), (2, bad), (3, "<p>none</p>"), (4, None)], "page_id int, html string")
    parsed = flatten.parse_projection_pages(pages, ["page_id"])
    assert {r["page_id"]: r["status"] for r in parsed.collect()} == {1: "ok", 2: "parse_fail", 3: "empty", 4: "empty"}
    assert rows(flatten.projection_rows(parsed, ["page_id"])) == [(1, "7", "Al B", "KC", "fpts", 1200.5)]


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024"), (2, "2025")], "id int, season string")
    assert io.write_seasons(df, f"{tmp_path}/s", "2024-01-01") == "season"
    assert io.read_prefix(spark, f"{tmp_path}/s").count() == 2
    assert io.read_prefix(spark, f"{tmp_path}/none", "a int").count() == 0
    assert io.write_bronze(df.limit(0), str(tmp_path), "x", "2024-01-01") is None
    with pytest.raises(ValueError, match="no partition"):
        io.latest_partition(df.limit(0).withColumn("load_date", F.lit("x")))


def _files(spark, path):
    """Bucket -> the files that hold it now."""
    found = {}
    for r in bucketed.read_current(spark, path).select("_metadata.file_path").distinct().collect():
        found.setdefault(int(r.file_path.split("_bucket=")[1].split("/")[0]), set()).add(r.file_path)
    return found


def test_upserts_leave_untouched_buckets_alone(spark, tmp_path):
    path = f"{tmp_path}/u"
    frame = lambda ids, v, kind="bigint": spark.createDataFrame([(i, v) for i in ids], f"id {kind}, v string")
    assert len(bucketed.upsert_table(frame(range(200), "old"), path, ["id"], "v1", buckets=16)) == 16
    before = _files(spark, path)
    # a narrower key type falls into the same bucket
    touched = bucketed.upsert_table(frame([5, 77, 500], "new", "int"), path, ["id"], "v2")
    after = _files(spark, path)
    assert 1 <= len(touched) <= 3 and all(after[k] == before[k] for k in range(16) if k not in touched) and all(not after[k] & before[k] for k in touched)
    want = {i: "new" if i in (5, 77) else "old" for i in range(200)} | {500: "new"}
    assert dict(rows(bucketed.read_current(spark, path))) == want
    assert bucketed.upsert_table(frame([], "x"), path, ["id"], "v3") == [] and _files(spark, path) == after
    # a new column is null in older buckets; null keys are one key; repeated keys leave one row
    more = spark.createDataFrame([(5, "w", 1.5), (None, "n", 2.0), (None, "n", 2.0)], "id bigint, v string, extra double")
    bucketed.upsert_table(more, path, ["id"], "v4")
    now = {r["id"]: (r["v"], r["extra"]) for r in bucketed.read_current(spark, path).collect()}
    assert now == {i: (v, None) for i, v in want.items()} | {5: ("w", 1.5), None: ("n", 2.0)}


def test_unfinished_upserts_are_not_seen(spark, tmp_path):
    path = f"{tmp_path}/u"
    with pytest.raises(ValueError, match="no bucketed table"):
        bucketed.read_current(spark, path)
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    bucketed.upsert_table(df, path, ["id"], "v1", buckets=4)
    df.write.parquet(f"{path}/data/v2/_bucket=0")  # of a writer that died before its manifest
    assert rows(bucketed.read_current(spark, path)) == [(1, "a")]
    with pytest.raises(PySparkException):
        bucketed.upsert_table(df, path, ["id"], "v1")  # a version is never written twice
    bucketed.upsert_table(spark.createDataFrame([(1, "b")], "id int, v string"), path, ["id"], "v3")
    assert rows(bucketed.read_current(spark, path)) == [(1, "b")]


def test_sketches_of_partitions_are_merged(spark, tmp_path):
    df = spark.range(6000).selectExpr("id", "id % 3 AS part", "CAST(id % 700 AS SMALLINT) AS few", "IF(id % 2 = 0, NULL, CAST(id % 50 AS DOUBLE)) AS half", "array(id % 9) AS list")
    for part in range(3):  # a partition at a time, the earlier ones aren't read again
        profiles.sketch_profile(df.where(F.col("part") == part), "t", "part").write.mode("append").parquet(f"{tmp_path}/p")
    stored = spark.read.parquet(f"{tmp_path}/p")
    assert stored.count() == 3 * 5
    got = {r.column_name: r for r in profiles.merge_profiles(stored).collect()}
    for name, kinds in (("id", 6000), ("part", 3), ("few", 700), ("half", 25), ("list", 9)):
        assert got[name].n_rows == 6000 and abs(got[name].n_distinct - kinds) <= 0.06 * kinds
    assert got["half"].n_null == 3000 and got["few"].data_type == "smallint"
    exact = {r["column_name"]: r["n_distinct"] for r in io.profile({"t": df}, exact=True).collect()}
    assert exact == {"id": 6000, "part": 3, "few": 700, "half": 25, "list": 9}


def test_registered_queries_have_sql():
    from stintlake.plans import registry

    without = set(registry.QUERIES) - set(registry.ORACLES)
    assert not without


def test_queries_read_whole_tables():
    """No registered input keeps a slice of its table by a remainder of a key of that table's rows."""
    source = inspect.getsource(q_ledger)
    for slice_ in ("event_id % 10 = 0", "event_id % 4 = 0", "event_id % 2 = 0", "o_orderkey % 11 = 0", "l_partkey % 13 = 0"):
        assert f"WHERE {slice_}" not in source


def test_profile_counts_and_sizes(spark, tmp_path):
    spark.range(100).selectExpr("id", "IF(id < 10, NULL, id % 7) AS k").repartition(3).write.parquet(f"{tmp_path}/a")
    spark.range(5).write.parquet(f"{tmp_path}/b")
    tables = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in "ab"}
    rows = {(r["table_name"], r["column_name"]): r for r in io.profile(tables).collect()}
    assert (rows["a", "k"]["n_rows"], rows["a", "k"]["n_null"], rows["a", "k"]["n_distinct"]) == (100, 10, 7)
    sizes = {r["table_name"]: r for r in io.profile_sizes(tables).collect()}
    on_disk = {n: [p.stat().st_size for p in (tmp_path / n).glob("*.parquet")] for n in "ab"}
    assert all((sizes[n]["n_files"], sizes[n]["n_bytes"]) == (len(on_disk[n]), sum(on_disk[n])) for n in "ab")
    assert (sizes[None]["n_files"], sizes[None]["n_bytes"]) == (sum(map(len, on_disk.values())), sum(map(sum, on_disk.values())))


def test_relational_table_in_parallel_parts(spark):
    url = "jdbc:derby:memory:values;create=true"
    spark.range(200).selectExpr("id AS ID", "id % 9 AS PLAYER_ID").write.jdbc(url, "VALUES_T", mode="overwrite")
    df = io.read_jdbc(spark, url, "VALUES_T", "ID", (0, 200, 4))
    assert df.rdd.getNumPartitions() == 4 and df.count() == 200
    players = spark.createDataFrame([(1, "one")], "PLAYER_ID long, name string")
    assert io.values_with_players(df.toDF("id", "player_id"), players.toDF("player_id", "name")).where("name = 'one'").count() == 23
