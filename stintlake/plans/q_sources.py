"""Queries of sources (S), flatteners (B), graph operators (G) and coercers (U)."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from stintlake.functions import coerce
from stintlake.operators import flatten, graph
from stintlake.plans.registry import derive, query, table
from stintlake.sources import bucketed, io, profiles

# --- flatteners: documents are built from the tables as JSON text, then taken apart again ---------------

ROSTER = """SELECT o_custkey, to_json(named_struct('league_id', concat('L', CAST(o_custkey % 20 AS STRING)), 'roster_id', o_custkey, 'owner_id', CASE WHEN o_custkey % 4 <> 0 THEN concat('U', CAST(o_custkey AS STRING)) END,
  'players', collect_list(CAST(o_orderkey AS STRING)), 'starters', CASE WHEN o_custkey % 3 <> 0 THEN collect_list(CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderkey AS STRING) END) END, 'taxi', collect_list(CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_orderkey AS STRING) END),
  'reserve', collect_list(CASE WHEN o_orderpriority = '2-HIGH' THEN CAST(o_orderkey AS STRING) END), 'metadata', map('team_name', concat('Team ', CAST(o_custkey AS STRING)), 'record', 'WLW', 'p_nick_77', 'Ace', 'p_nick_KC', ''), 'settings', map('wins', count(*), 'fpts', sum(o_orderkey), 'losses', 3L))) AS doc FROM {orders} GROUP BY o_custkey"""
_OWNER = "concat('L', CAST(o_custkey % 20 AS VARCHAR)) AS league_id, o_custkey AS roster_id, CASE WHEN o_custkey % 4 <> 0 THEN concat('U', CAST(o_custkey AS VARCHAR)) END AS owner_id"


@query(f"""SELECT {_OWNER}, CAST(o_orderkey AS VARCHAR) AS player_id, o_custkey % 3 <> 0 AND o_orderstatus = 'O' AS is_starter, o_orderpriority = '1-URGENT' AS is_taxi, o_orderpriority = '2-HIGH' AS is_reserve, o_orderpriority NOT IN ('1-URGENT', '2-HIGH') AS is_active FROM orders""")
def b1_roster_players(spark, d):
    return flatten.flatten_roster_players(derive(spark, d, ROSTER))


_NULLS = ", ".join(f"CAST(NULL AS BIGINT) AS {c}" for c in ("division", "ties", "fpts_decimal", "fpts_against", "fpts_against_decimal", "ppts", "ppts_decimal", "total_moves", "waiver_position", "waiver_budget_used"))


@query(f"SELECT {_OWNER}, 'Team ' || CAST(o_custkey AS VARCHAR) AS team_name, 'WLW' AS record, CAST(NULL AS VARCHAR) AS streak, count(*) AS wins, CAST(3 AS BIGINT) AS losses, CAST(sum(o_orderkey) AS BIGINT) AS fpts, {_NULLS} FROM orders GROUP BY o_custkey")
def b2_team_state(spark, d):
    return flatten.flatten_team_state(derive(spark, d, ROSTER))


@query(f"SELECT DISTINCT {_OWNER}, k AS meta_key, v AS nickname_raw, substr(k, 8) AS subject_id, t AS subject_type FROM orders, (VALUES ('p_nick_77', 'Ace', 'player'), ('p_nick_KC', '', 'team')) AS x(k, v, t)")
def b3_nicknames(spark, d):
    return flatten.flatten_nicknames(derive(spark, d, ROSTER))


TRADED = """SELECT o_orderkey AS arrival, to_json(named_struct('season', CAST(2024 + o_custkey % 3 AS STRING), 'round', CASE WHEN o_orderkey % 9 = 0 THEN 'NA' ELSE CAST(1 + o_custkey % 4 AS STRING) END, 'roster_id', concat(' ', CAST(o_custkey % 30 AS STRING)), 'owner_id', o_custkey, 'previous_owner_id', '')) AS doc FROM {orders}"""


@query(
    """WITH t AS (SELECT o_orderkey AS a, CAST(2024 + o_custkey % 3 AS VARCHAR) AS season, CASE WHEN o_orderkey % 9 <> 0 THEN 1 + o_custkey % 4 END AS round, o_custkey % 30 AS original_roster_id, o_custkey AS owner_roster_id FROM orders)
SELECT 'X' AS league_id, season, round, original_roster_id, arg_max(owner_roster_id, a) AS owner_roster_id, CAST(NULL AS BIGINT) AS previous_owner_roster_id FROM t GROUP BY season, round, original_roster_id"""
)
def b4_traded_picks_current(spark, d):
    return flatten.flatten_traded_picks_current(derive(spark, d, TRADED), "X")


USERS = "SELECT o_orderkey AS arrival, to_json(named_struct('user_id', concat(' ', CAST(o_custkey AS STRING)), 'display_name', CASE WHEN o_orderkey % 4 = 0 THEN '  ' ELSE concat('name ', CAST(o_orderkey AS STRING)) END, 'avatar', '', 'metadata', map('team_name', o_orderpriority))) AS doc FROM {orders}"


@query("""SELECT 'X' AS league_id, CAST(o_custkey AS VARCHAR) AS user_id, CASE WHEN max(o_orderkey) % 4 <> 0 THEN 'name ' || CAST(max(o_orderkey) AS VARCHAR) END AS display_name, arg_max(o_orderpriority, o_orderkey) AS user_team_name, CAST(NULL AS VARCHAR) AS avatar FROM orders GROUP BY o_custkey""")
def b5_users(spark, d):
    return flatten.flatten_users(derive(spark, d, USERS), "X")


LEAGUE = """SELECT to_json(named_struct('league_id', CAST(c_custkey AS STRING), 'name', c_name, 'season', '2024', 'status', 'complete', 'season_type', 'regular', 'total_rosters', 12L, 'draft_id', NULL, 'bracket_id', NULL, 'previous_league_id', CASE WHEN c_custkey > 10 THEN CAST(c_custkey - 10 AS STRING) END,
  'settings', CASE WHEN c_custkey % 2 = 0 THEN map('leg', 5, 'taxi_slots', CAST(c_nationkey AS INT)) ELSE map('num_teams', 10, 'reserve_slots', 2) END, 'scoring_settings', CASE WHEN c_custkey % 3 <> 0 THEN map('pass_td', 4.5D, 'rec', 1.0D) END,
  'roster_positions', CASE WHEN c_custkey % 5 = 0 THEN array('QB', 'RB', 'RB', 'BN') ELSE array('QB', 'WR', 'BN', 'BN') END)) AS doc FROM {customer}"""


@query("SELECT CAST(c_custkey AS VARCHAR) AS league_id, c_name AS league_name, '2024' AS season, 'complete' AS status, 'regular' AS season_type, CAST(12 AS BIGINT) AS total_rosters, CAST(NULL AS VARCHAR) AS draft_id, CAST(NULL AS VARCHAR) AS bracket_id, CAST(CASE WHEN c_custkey % 2 = 0 THEN 5 END AS BIGINT) AS leg, CAST(NULL AS BIGINT) AS last_scored_leg, CASE WHEN c_custkey > 10 THEN CAST(c_custkey - 10 AS VARCHAR) END AS previous_league_id FROM customer")
def b6_leagues(spark, d):
    return flatten.flatten_league(derive(spark, d, LEAGUE))[0]


@query("SELECT CAST(c_custkey AS VARCHAR) AS league_id, CAST(CASE WHEN c_custkey % 2 = 0 THEN 5 END AS BIGINT) AS leg, CAST(CASE WHEN c_custkey % 2 = 1 THEN 10 END AS BIGINT) AS num_teams, CAST(CASE WHEN c_custkey % 2 = 1 THEN 2 END AS BIGINT) AS reserve_slots, CAST(CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END AS BIGINT) AS taxi_slots FROM customer")
def b6_settings(spark, d):
    return flatten.flatten_league(derive(spark, d, LEAGUE))[1]


@query("SELECT CAST(c_custkey AS VARCHAR) AS league_id, CAST(CASE WHEN c_custkey % 3 <> 0 THEN 4.5 END AS DOUBLE) AS pass_td, CAST(CASE WHEN c_custkey % 3 <> 0 THEN 1 END AS DOUBLE) AS rec FROM customer")
def b6_scoring(spark, d):
    return flatten.flatten_league(derive(spark, d, LEAGUE))[2]


_SLOTS = 'CAST(CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 2 END AS BIGINT) AS "BN", CAST(1 AS BIGINT) AS "QB", CAST(CASE WHEN c_custkey % 5 = 0 THEN 2 ELSE 0 END AS BIGINT) AS "RB", CAST(CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 1 END AS BIGINT) AS "WR", CAST(CASE WHEN c_custkey % 2 = 0 THEN c_nationkey ELSE 0 END AS BIGINT) AS "TAXI", CAST(CASE WHEN c_custkey % 2 = 1 THEN 2 ELSE 0 END AS BIGINT) AS "IR"'


@query(f"SELECT CAST(c_custkey AS VARCHAR) AS league_id, {_SLOTS} FROM customer")
def b7_roster_slots(spark, d):
    return flatten.flatten_roster_slots(derive(spark, d, LEAGUE))


@query(f"SELECT CAST(c_custkey AS VARCHAR) AS league_id, {_SLOTS}, CAST(1 + (c_custkey - 1) % 10 AS VARCHAR) AS league_lineage_id, CAST(1 + (c_custkey - 1) // 10 AS BIGINT) AS season_number FROM customer WHERE c_custkey >= 1")
def b8_lineage_slots(spark, d):
    chain = graph.walk_back(derive(spark, d, "SELECT CAST(c_custkey AS STRING) AS league_id, CASE WHEN c_custkey > 10 THEN CAST(c_custkey - 10 AS STRING) END AS previous_league_id FROM {customer} WHERE c_custkey >= 1"))
    return flatten.flatten_lineage(derive(spark, d, LEAGUE), chain)[1]


DRAFT = """SELECT to_json(named_struct('draft_id', CAST(o_orderkey AS STRING), 'league_id', CAST(o_custkey AS STRING), 'created', 1700000000000L + o_orderkey * 1000, 'start_time', CASE WHEN o_orderkey % 3 = 0 THEN 1700000000000L + o_orderkey END, 'season', '2024', 'status', o_orderstatus,
  'metadata', map('name', o_orderpriority), 'settings', map('rounds', o_custkey, 'teams', 12L), 'draft_order', CASE WHEN o_orderkey % 2 = 0 THEN map(concat('u', CAST(o_custkey AS STRING)), 1L, concat('v', CAST(o_custkey AS STRING)), 2L) END)) AS doc FROM {orders}"""


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS draft_id, CAST(o_custkey AS VARCHAR) AS league_id, strftime(make_timestamp((1700000000000 + o_orderkey * 1000) * 1000), '%Y-%m-%dT%H:%M:%S+00:00') AS created_iso,
CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 1000 = 0 THEN strftime(make_timestamp((1700000000000 + o_orderkey) * 1000), '%Y-%m-%dT%H:%M:%S+00:00') ELSE strftime(make_timestamp((1700000000000 + o_orderkey) * 1000), '%Y-%m-%dT%H:%M:%S.%f+00:00') END END AS start_time_iso,
o_orderstatus AS status, o_orderpriority AS draft_name, o_custkey AS rounds, CAST(12 AS BIGINT) AS teams, CAST(NULL AS BIGINT) AS pick_timer FROM orders"""
)
def b9_drafts(spark, d):
    return flatten.flatten_drafts(derive(spark, d, DRAFT)).select("draft_id", "league_id", "created_iso", "start_time_iso", "status", "draft_name", "rounds", "teams", "pick_timer")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS draft_id, CAST(o_custkey AS VARCHAR) AS league_id, p || CAST(o_custkey AS VARCHAR) AS user_id, CAST(s AS BIGINT) AS slot FROM orders, (VALUES ('u', 1), ('v', 2)) AS x(p, s) WHERE o_orderkey % 2 = 0")
def b10_draft_order(spark, d):
    return flatten.flatten_draft_order(derive(spark, d, DRAFT))


PICK = """SELECT l_orderkey * 10 + l_linenumber AS arrival, to_json(named_struct('draft_id', CAST(l_orderkey % 500 AS STRING), 'pick_no', l_linenumber, 'round', CASE WHEN l_quantity > 40 THEN 'x' ELSE '2' END, 'player_id', l_partkey, 'is_keeper', l_returnflag = 'R', 'metadata', map('first_name', l_linestatus, 'number', CASE WHEN l_tax > 0.05 THEN '' ELSE ' 12 ' END, 'news_updated', '1700000000000'))) AS doc FROM (SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity, max(l_partkey) AS l_partkey, max(l_returnflag) AS l_returnflag, max(l_linestatus) AS l_linestatus, max(l_tax) AS l_tax FROM {lineitem} GROUP BY l_orderkey, l_linenumber) AS x"""


@query(
    """WITH t AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey % 500, l_linenumber ORDER BY l_orderkey DESC) AS rn FROM (SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity, max(l_partkey) AS l_partkey, max(l_returnflag) AS l_returnflag, max(l_linestatus) AS l_linestatus, max(l_tax) AS l_tax FROM lineitem GROUP BY l_orderkey, l_linenumber))
SELECT CAST(l_orderkey % 500 AS VARCHAR) AS draft_id, CAST(l_linenumber AS BIGINT) AS pick_no, CAST(CASE WHEN l_quantity <= 40 THEN 2 END AS BIGINT) AS round, CAST(l_partkey AS VARCHAR) AS player_id, l_returnflag = 'R' AS is_keeper, l_linestatus AS player_first_name, CAST(CASE WHEN l_tax <= 0.05 THEN 12 END AS BIGINT) AS player_number, '2023-11-14T22:13:20+00:00' AS player_news_updated_iso FROM t WHERE rn = 1"""
)
def b11_draft_picks(spark, d):
    docs = derive(spark, d, PICK).repartition("arrival")  # else a task holds its documents twice, sorted as grouped here and by their pick
    return flatten.flatten_draft_picks(docs).select("draft_id", "pick_no", "round", "player_id", "is_keeper", "player_first_name", "player_number", "player_news_updated_iso")


DRAFT_TRADE = "SELECT o_orderkey AS arrival, to_json(named_struct('draft_id', 'D', 'season', CAST(o_custkey % 9 AS STRING), 'round', 1 + o_custkey % 4, 'roster_id', o_custkey % 12, 'owner_id', o_custkey)) AS doc FROM {orders}"


@query("SELECT 'D' AS draft_id, CAST(o_custkey % 9 AS VARCHAR) AS season, CAST(1 + o_custkey % 4 AS BIGINT) AS round, CAST(o_custkey % 12 AS BIGINT) AS roster_id, arg_max(o_custkey, o_orderkey) AS owner_roster_id, CAST(NULL AS BIGINT) AS previous_owner_roster_id FROM orders GROUP BY o_custkey % 9, 1 + o_custkey % 4, o_custkey % 12")
def b12_traded_draft_picks(spark, d):
    return flatten.flatten_traded_draft_picks(derive(spark, d, DRAFT_TRADE))


TXN = """SELECT to_json(named_struct('transaction_id', CAST(o_orderkey AS STRING), 'league_id', 'L', 'type', 'trade', 'status', o_orderstatus, 'created', o_orderkey, 'settings', CASE WHEN o_orderkey % 2 = 0 THEN map('waiver_bid', o_custkey) END, 'adds', map(CAST(o_custkey AS STRING), 1L), 'drops', CASE WHEN o_orderkey % 3 = 0 THEN map(CAST(o_custkey + 1 AS STRING), 2L) END,
  'player_map', map(CAST(o_custkey AS STRING), map('first_name', o_orderpriority, 'number', '7')), 'roster_ids', array(1, 2), 'draft_picks', CASE WHEN o_orderkey % 5 = 0 THEN array(named_struct('season', '2025', 'round', 1L, 'roster_id', 3L, 'previous_owner_id', 3L, 'owner_id', o_custkey)) END)) AS doc FROM {orders}"""


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, 'L' AS league_id, 'trade' AS type, o_orderstatus AS status, o_orderkey AS created, CAST(NULL AS BIGINT) AS status_updated, CAST(NULL AS VARCHAR) AS creator, CAST(NULL AS BIGINT) AS leg, CAST(NULL AS BIGINT) AS api_week, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS waiver_bid, CAST(NULL AS BIGINT) AS waiver_seq,
'null' AS waiver_budget, CAST(NULL AS VARCHAR) AS metadata_notes, '[]' AS consenter_ids, '[1,2]' AS roster_ids FROM orders""")
def b13_transactions(spark, d):
    return flatten.flatten_transactions(derive(spark, d, TXN))[0]


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, 'L' AS league_id, CAST(o_custkey AS VARCHAR) AS player_id, CAST(1 AS BIGINT) AS roster_id, 'add' AS action, o_orderpriority AS player_first_name, CAST(7 AS BIGINT) AS player_number FROM orders
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'L', CAST(o_custkey + 1 AS VARCHAR), 2, 'drop', NULL, NULL FROM orders WHERE o_orderkey % 3 = 0"""
)
def b13_transaction_players(spark, d):
    return flatten.flatten_transactions(derive(spark, d, TXN))[1].select("transaction_id", "league_id", "player_id", "roster_id", "action", "player_first_name", "player_number")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, 'L' AS league_id, '2025' AS season, CAST(1 AS BIGINT) AS round, CAST(3 AS BIGINT) AS roster_id, CAST(3 AS BIGINT) AS previous_owner_id, o_custkey AS owner_id FROM orders WHERE o_orderkey % 5 = 0")
def b13_transaction_picks(spark, d):
    return flatten.flatten_transactions(derive(spark, d, TXN))[2]


BULK = "SELECT to_json(named_struct('transaction_id', CAST(o_orderkey AS STRING), 'league_id', 'L', 'type', 'trade', 'status', 'complete', 'created', o_orderkey, 'draft_picks', array(concat(CAST(o_custkey % 12 AS STRING), ',2026,', CAST(1 + o_custkey % 4 AS STRING), ',', CAST(o_custkey AS STRING), ',9')))) AS doc FROM {orders}"


@query("SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, 'L' AS league_id, concat(o_custkey % 12, ',2026,', 1 + o_custkey % 4, ',', o_custkey, ',9') AS draft_pick_id, o_custkey % 12 AS roster_id, '2026' AS season, 1 + o_custkey % 4 AS round, CAST(9 AS BIGINT) AS previous_owner_id, o_custkey AS owner_id FROM orders")
def b14_transactions_bulk(spark, d):
    return flatten.flatten_transactions_bulk(derive(spark, d, BULK))[2]


DICTIONARY = "SELECT to_json(map_from_entries(collect_list(struct(CAST(p_partkey AS STRING) AS k, map('name', p_name, 'position', p_brand) AS v)))) AS doc FROM {part} GROUP BY p_size"


@query("SELECT CAST(p_partkey AS VARCHAR) AS player_id, p_name AS name, p_brand AS position, CAST(NULL AS VARCHAR) AS team FROM part")
def b15_players(spark, d):
    return flatten.flatten_players(derive(spark, d, DICTIONARY), ["name", "position", "team"])


@query(r"WITH p AS (SELECT page_id, html, CASE WHEN page_id % 3 = 0 THEN 'data = [{""id"": ' || CAST(page_id AS VARCHAR) || '}];' END AS t FROM pages) SELECT page_id, page_id AS id FROM p WHERE t IS NOT NULL".replace('""', '"'))
def b16_embedded_json(spark, d):
    script = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('<script>var playersArray = [{"id": '), F.col("page_id").cast("string"), F.lit("}];</script>")))
    pages = table(spark, d, "pages").withColumn("html", F.concat("html", F.coalesce(script, F.lit(""))))
    found, _ = flatten.extract_embedded_json(pages, "players", "array<struct<id:bigint>>")
    return found.select("page_id", F.explode("data").alias("x")).select("page_id", "x.id")


HISTORY = """SELECT to_json(named_struct('player_id', CAST(l_partkey AS STRING), 'player_name', 'x', 'position', CASE WHEN l_partkey % 7 = 0 THEN 'RDP' ELSE 'QB' END, 'slug', 's', 'one_qb_value', array_sort(collect_list(CASE WHEN l_linenumber % 2 = 0 THEN named_struct('d', date_format(l_shipdate, 'yyMMdd'), 'v', l_quantity) END)),
  'sf_pos_rank', array_sort(collect_list(CASE WHEN l_linenumber % 2 = 1 THEN named_struct('d', date_format(l_shipdate, 'yyMMdd'), 'v', CAST(l_linenumber AS DOUBLE)) END)))) AS doc FROM {lineitem} GROUP BY l_partkey"""


@query(
    """WITH t AS (SELECT CAST(l_partkey AS VARCHAR) AS player_id, CASE WHEN l_partkey % 7 = 0 THEN 'RDP' ELSE 'QB' END AS position, CAST(l_shipdate AS DATE) AS ranking_date, CASE WHEN l_linenumber % 2 = 0 THEN l_quantity END AS a, CASE WHEN l_linenumber % 2 = 1 AND l_partkey % 7 <> 0 THEN CAST(l_linenumber AS BIGINT) END AS b FROM lineitem)
SELECT player_id, position, ranking_date, max(a) AS one_qb_value, max(b) AS sf_pos_rank FROM t WHERE a IS NOT NULL OR b IS NOT NULL GROUP BY ALL"""
)
def b17_value_history(spark, d):
    return flatten.value_history(derive(spark, d, HISTORY), "2024-01-01").select("player_id", "position", "ranking_date", "one_qb_value", "sf_pos_rank")


MARKET = "SELECT to_json(named_struct('playerName', p_name, 'playerID', p_partkey, 'slug', concat('x-', CAST(p_partkey AS STRING)), 'position', p_brand, 'positionID', 1, 'isTrending', p_partkey % 2 = 0, 'oneQBValues', CASE WHEN p_partkey % 3 <> 0 THEN named_struct('value', p_size, 'rank', p_partkey, 'tep', CASE WHEN p_partkey % 5 = 0 THEN named_struct('value', p_size + 1, 'rank', 3) END) END, 'superflexValues', named_struct('value', 2 * p_size, 'isOutThisWeek', false))) AS doc FROM {part}"
_MARKET = ("playerName", "playerID", "slug", "isTrending", "oneqb_value", "oneqb_rank", "oneqb_tep_value", "oneqb_tepp_value", "sf_value", "sf_isOutThisWeek")


@query("SELECT p_name AS playerName, CAST(p_partkey AS VARCHAR) AS playerID, 'x-' || CAST(p_partkey AS VARCHAR) AS slug, CASE WHEN p_partkey % 2 = 0 THEN 'true' ELSE 'false' END AS isTrending, CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_size AS VARCHAR) END AS oneqb_value, CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS oneqb_rank, CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 5 = 0 THEN CAST(p_size + 1 AS VARCHAR) END AS oneqb_tep_value, CAST(NULL AS VARCHAR) AS oneqb_tepp_value, CAST(2 * p_size AS VARCHAR) AS sf_value, 'false' AS sf_isOutThisWeek FROM part")
def b18_market_page(spark, d):
    return flatten.flatten_market(derive(spark, d, MARKET)).select(*_MARKET)


@query("SELECT p_name AS playerName, CAST(p_partkey AS VARCHAR) AS playerID, 'x-' || CAST(p_partkey AS VARCHAR) AS slug, p_partkey % 2 = 0 AS isTrending, CAST(CASE WHEN p_partkey % 3 <> 0 THEN p_size END AS FLOAT) AS oneqb_value, CAST(CASE WHEN p_partkey % 3 <> 0 THEN p_partkey END AS INT) AS oneqb_rank, CAST(CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 5 = 0 THEN p_size + 1 END AS FLOAT) AS oneqb_tep_value, CAST(NULL AS FLOAT) AS oneqb_tepp_value, CAST(2 * p_size AS FLOAT) AS sf_value, false AS sf_isOutThisWeek FROM part")
def b19_cast_map(spark, d):
    return flatten.cast_map(flatten.flatten_market(derive(spark, d, MARKET))).select(*_MARKET)


FEED = "SELECT 1 + p_partkey % 2 AS n_qb, 12 AS n_teams, to_json(named_struct('player', named_struct('id', p_partkey, 'name', p_name, 'sleeperId', CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_partkey AS STRING) END, 'maybeAge', 25.5D), 'value', p_size, 'overallRank', p_partkey, 'maybeTier', NULL)) AS doc FROM {part}"


@query("SELECT p_partkey AS id, p_name AS name, CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS sleeper_id, CAST(25.5 AS DOUBLE) AS age, CAST(p_size AS DOUBLE) AS value, CAST(p_partkey AS DOUBLE) AS overall_rank, CAST(NULL AS DOUBLE) AS tier, 1 + p_partkey % 2 AS n_qb, 12 AS n_teams FROM part")
def b20_value_feed(spark, d):
    return flatten.flatten_value_feed(derive(spark, d, FEED)).select("id", "name", "sleeper_id", "age", "value", "overall_rank", "tier", "n_qb", "n_teams")


#: Projection tables made from suppliers: two header rows for one position, one for the other.
PROJECTION = """SELECT s_nationkey AS page_id, CASE WHEN s_nationkey % 2 = 0 THEN 'QB' ELSE 'RB' END AS position, concat('<html><table id="data"><thead>', CASE WHEN s_nationkey % 2 = 0 THEN '<tr><th></th><th colspan="2">PASSING</th><th>MISC</th></tr><tr><th>Player</th><th>ATT</th><th>YDS</th><th>FPTS</th></tr>' ELSE '<tr><th>Player</th><th>RUSH ATT</th><th>FPTS</th></tr>' END, '</thead><tbody>',
  array_join(collect_list(concat('<tr><td><a class="fp-player-link fp-id-', CAST(s_suppkey AS STRING), '" fp-player-name="', s_name, '">', s_name, '</a> KC</td><td>1,', CAST(100 + s_suppkey % 900 AS STRING), '.5</td>', CASE WHEN s_nationkey % 2 = 0 THEN '<td>-</td>' ELSE '' END, '<td>', CAST(s_suppkey AS STRING), '</td></tr>')), ''), '</tbody></table></html>') AS html FROM {supplier} GROUP BY s_nationkey"""


@query(
    """SELECT s_nationkey AS page_id, CASE WHEN s_nationkey % 2 = 0 THEN 'QB' ELSE 'RB' END AS position, CAST(s_suppkey AS VARCHAR) AS fp_id, s_name AS player, 'KC' AS team, stat, CASE stat WHEN 'fpts' THEN CAST(s_suppkey AS DOUBLE) WHEN 'passing_yds' THEN NULL ELSE CAST(1100.5 + s_suppkey % 900 AS DOUBLE) END AS value
FROM supplier JOIN (VALUES (0, 'passing_att'), (0, 'passing_yds'), (0, 'fpts'), (1, 'rush_att'), (1, 'fpts')) AS x(m, stat) ON s_nationkey % 2 = m"""
)
def b22_projection_rows(spark, d):
    parsed = flatten.parse_projection_pages(derive(spark, d, PROJECTION), ["page_id", "position"])
    return flatten.projection_rows(parsed, ["page_id", "position"])


@query("SELECT DISTINCT CASE WHEN s_nationkey % 2 = 0 THEN 'QB' ELSE 'RB' END AS position, CASE WHEN s_nationkey % 2 = 0 THEN 'player,passing_att,passing_yds,fpts' ELSE 'player,rush_att,fpts' END AS layouts, 1 AS n_layouts FROM supplier")
def b23_header_drift(spark, d):
    drift = flatten.header_drift(flatten.parse_projection_pages(derive(spark, d, PROJECTION), ["page_id", "position"]))
    return drift.withColumn("layouts", F.array_join("layouts", ";"))


@query("SELECT s_suppkey AS id, CASE WHEN s_nationkey % 2 = 0 THEN s_acctbal END AS passing, CASE WHEN s_nationkey % 2 = 1 THEN s_acctbal END AS rushing, CASE WHEN s_nationkey % 2 = 0 THEN 'QB' ELSE 'RB' END AS position, 2024 AS season, 3 AS week, 'PPR' AS scoring FROM supplier")
def b24_assemble_projections(spark, d):
    part = lambda m, name: table(spark, d, "supplier").where(f"s_nationkey % 2 = {m}").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias(name))
    return flatten.assemble_projections({"QB": part(0, "passing"), "RB": part(1, "rushing")}, 2024, 3, "PPR")


@query("SELECT CAST(c_custkey AS VARCHAR) AS league_id, c_name AS name, CAST(12 AS BIGINT) AS total_rosters, CASE WHEN c_custkey % 2 = 0 THEN '{\"leg\":5,\"taxi_slots\":' || CAST(c_nationkey AS VARCHAR) || '}' ELSE '{\"num_teams\":10,\"reserve_slots\":2}' END AS settings, CASE WHEN c_custkey % 5 = 0 THEN '[\"QB\",\"RB\",\"RB\",\"BN\"]' ELSE '[\"QB\",\"WR\",\"BN\",\"BN\"]' END AS roster_positions FROM customer")
def b25_crawl_rows(spark, d):
    return flatten.crawl_league_rows(derive(spark, d, LEAGUE)).select("league_id", "name", "total_rosters", "settings", "roster_positions")


CRAWLED = "SELECT to_json(named_struct('league_id', concat('L', CAST(c_nationkey AS STRING)), 'roster_id', c_custkey, 'owner_id', c_name, 'players', array(c_mktsegment, 'x'), 'settings', named_struct('wins', c_nationkey))) AS doc FROM {customer}"


@query("SELECT 'L' || CAST(c_nationkey AS VARCHAR) AS league_id, CAST(c_custkey AS BIGINT) AS roster_id, c_name AS owner_id, '[\"' || c_mktsegment || '\",\"x\"]' AS players, CAST(NULL AS VARCHAR) AS taxi, '{\"wins\":' || CAST(c_nationkey AS VARCHAR) || '}' AS settings FROM customer")
def b25_crawl_rosters(spark, d):
    return flatten.crawl_roster_rows(derive(spark, d, CRAWLED)).select("league_id", "roster_id", "owner_id", "players", "taxi", "settings")


@query("SELECT event_id, CAST(json_extract_string(props, '$.page') AS VARCHAR) AS page FROM events")
def b26_text_to_nested(spark, d):
    nested = flatten.text_to_nested(table(spark, d, "events"), "props", "map<string,string>", "p")
    return nested.select("event_id", F.col("p")["page"].alias("page"))


SEASON = """SELECT to_json(named_struct('league_id', concat('L', CAST(o_custkey AS STRING)), 'season', '2024', 'name', 'n', 'settings', CASE WHEN o_custkey % 2 = 0 THEN named_struct('playoff_week_start', 4) END, 'matchups', collect_list(named_struct('week', CAST(o_orderkey % 20 AS STRING), 'roster_id', CAST(o_orderkey AS STRING), 'points', o_orderstatus)),
  'winners_bracket', array(map('r', '1', 'm', '2', 't1', '3')))) AS doc FROM {orders} GROUP BY o_custkey"""


@query("SELECT 'L' || CAST(o_custkey AS VARCHAR) AS league_id, '2024' AS season, CAST(o_orderkey % 20 AS VARCHAR) AS week, CAST(o_orderkey AS VARCHAR) AS roster_id, o_orderstatus AS points, 'R' || CAST(o_custkey % 3 AS VARCHAR) AS league_lineage_id FROM orders WHERE o_orderkey % 20 <= CASE WHEN o_custkey % 2 = 0 THEN 3 ELSE 14 END")
def b27_harvest_matchups(spark, d):
    lineage = derive(spark, d, "SELECT DISTINCT concat('L', CAST(o_custkey AS STRING)) AS league_id, concat('R', CAST(o_custkey % 3 AS STRING)) AS league_lineage_id FROM {orders}")
    return flatten.harvest_tables(derive(spark, d, SEASON), lineage)["matchups"].select("league_id", "season", "week", "roster_id", "points", "league_lineage_id")


@query("SELECT DISTINCT 'L' || CAST(o_custkey AS VARCHAR) AS league_id, '2024' AS season, 'winners' AS bracket, '1' AS round, '2' AS match_id, '3' AS t1, 'R' || CAST(o_custkey % 3 AS VARCHAR) AS league_lineage_id FROM orders")
def b27_harvest_brackets(spark, d):
    lineage = derive(spark, d, "SELECT DISTINCT concat('L', CAST(o_custkey AS STRING)) AS league_id, concat('R', CAST(o_custkey % 3 AS STRING)) AS league_lineage_id FROM {orders}")
    return flatten.harvest_tables(derive(spark, d, SEASON), lineage)["brackets"].select("league_id", "season", "bracket", "round", "match_id", "t1", "league_lineage_id")


#: The other tables of a season document: entity -> {field: its value, in words that both engines know}.
_HARVEST = {
    "transactions": {"leg": "CAST(o_orderkey % 17 AS STRING)", "transaction_id": "concat('T', CAST(o_orderkey AS STRING))", "type": "o_orderstatus", "status": "o_orderpriority"},
    "rosters": {"roster_id": "CAST(o_orderkey AS STRING)", "owner_id": "concat('O', CAST(o_custkey AS STRING))", "players": "o_orderpriority"},
    "users": {"user_id": "concat('U', CAST(o_orderkey AS STRING))", "display_name": "o_orderpriority", "is_owner": "'true'"},
    "traded_picks": {"season": "'2025'", "round": "CAST(1 + o_orderkey % 4 AS STRING)", "roster_id": "CAST(o_orderkey AS STRING)", "previous_owner_id": "'1'", "owner_id": "'2'"},
    "drafts": {"draft_id": "concat('D', CAST(o_orderkey AS STRING))", "type": "'snake'", "status": "o_orderstatus"},
    "draft_picks": {"draft_id": "concat('D', CAST(o_orderkey AS STRING))", "pick_no": "CAST(o_orderkey % 40 AS STRING)", "round": "'1'", "player_id": "CAST(o_orderkey AS STRING)"},
}
_FIELDS = ", ".join(f"'{e}', collect_list(map({', '.join(f"'{k}', {v}" for k, v in fields.items())}))" for e, fields in _HARVEST.items())
SEASON_ARRAYS = f"SELECT to_json(named_struct('league_id', concat('L', CAST(o_custkey AS STRING)), 'season', '2024', 'name', 'n', 'total_rosters', 12, 'settings', named_struct('playoff_teams', o_custkey % 7), {_FIELDS})) AS doc FROM {{orders}} GROUP BY o_custkey"
_LINEAGES = "SELECT DISTINCT concat('L', CAST(o_custkey AS STRING)) AS league_id, concat('R', CAST(o_custkey % 3 AS STRING)) AS league_lineage_id FROM {orders}"


def _harvested(entity: str, fields: dict[str, str]) -> None:
    renamed = {k: "pick_season" if entity == "traded_picks" and k == "season" else k for k in fields}

    def harvest(spark, d):
        out = flatten.harvest_tables(derive(spark, d, SEASON_ARRAYS), derive(spark, d, _LINEAGES))[entity]
        return out.select("league_id", "season", *renamed.values(), "league_lineage_id")

    harvest.__name__ = f"b27_harvest_{entity}"
    columns = ", ".join(f"{v.replace('STRING', 'VARCHAR')} AS {renamed[k]}" for k, v in fields.items())
    query(f"SELECT 'L' || CAST(o_custkey AS VARCHAR) AS league_id, '2024' AS season, {columns}, 'R' || CAST(o_custkey % 3 AS VARCHAR) AS league_lineage_id FROM orders")(harvest)


for _entity, _fields in _HARVEST.items():
    _harvested(_entity, _fields)


@query("SELECT DISTINCT 'L' || CAST(o_custkey AS VARCHAR) AS league_id, '2024' AS season, 'n' AS name, CAST(12 AS BIGINT) AS total_rosters, CAST(o_custkey % 7 AS BIGINT) AS playoff_teams, CAST(NULL AS BIGINT) AS num_teams, 'R' || CAST(o_custkey % 3 AS VARCHAR) AS league_lineage_id FROM orders")
def b27_harvest_season_meta(spark, d):
    out = flatten.harvest_tables(derive(spark, d, SEASON_ARRAYS), derive(spark, d, _LINEAGES))["season_meta"]
    return out.select("league_id", "season", "name", "total_rosters", "playoff_teams", "num_teams", "league_lineage_id")


LOOSE = "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN ' 12 ' WHEN 2 THEN 'NA' WHEN 3 THEN '1,234.5' WHEN 4 THEN 'abc' ELSE CAST(o_custkey AS STRING) END AS t FROM {orders}"


@query("SELECT o_orderkey, CAST(CASE o_orderkey % 6 WHEN 1 THEN 12 WHEN 5 THEN o_custkey END AS BIGINT) AS i, CAST(CASE o_orderkey % 6 WHEN 1 THEN 12 WHEN 3 THEN 1234.5 WHEN 5 THEN o_custkey END AS DOUBLE) AS f, nullif(trim(t), '') AS s FROM (SELECT o_orderkey, o_custkey, CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN ' 12 ' WHEN 2 THEN 'NA' WHEN 3 THEN '1,234.5' WHEN 4 THEN 'abc' ELSE CAST(o_custkey AS VARCHAR) END AS t FROM orders)")
def u1_coercers(spark, d):
    return derive(spark, d, LOOSE).select("o_orderkey", coerce.to_int_or_null("t").alias("i"), coerce.to_float_or_null("t").alias("f"), coerce.to_str_or_null("t").alias("s"))


# --- graph ---------------------------------------------------------------------------------------------

CHAIN = "SELECT CAST(o_orderkey AS STRING) AS league_id, CAST(lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS STRING) AS previous_league_id FROM {orders}"
_PLACES = "SELECT CAST(o_orderkey AS VARCHAR) AS league_id, CAST(first_value(o_orderkey) OVER w AS VARCHAR) AS root, row_number() OVER w - 1 AS depth, o_custkey FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"


@query(f"SELECT 'L' || league_id AS league_id, 'L' || root AS root, depth FROM ({_PLACES})")
def g1_walk_back(spark, d):
    return graph.walk_back(derive(spark, d, "SELECT concat('L', league_id) AS league_id, concat('L', previous_league_id) AS previous_league_id FROM (" + CHAIN + ") AS c"))


NAMED = "SELECT league_id, previous_league_id, CASE WHEN previous_league_id IS NULL AND CAST(league_id AS BIGINT) % 2 = 0 THEN concat('R', league_id) END AS league_lineage_id FROM (" + CHAIN + ") AS c"


@query(f"WITH p AS ({_PLACES}) SELECT p.league_id, q.league_id AS previous_league_id, CASE WHEN CAST(p.root AS BIGINT) % 2 = 0 AND p.depth <= 12 THEN 'R' || p.root ELSE p.league_id END AS league_lineage_id FROM p LEFT JOIN p q ON q.o_custkey = p.o_custkey AND q.depth = p.depth - 1")
def g2_backfill_lineage(spark, d):
    return graph.backfill_lineage(derive(spark, d, NAMED))


KNOWN = "SELECT league_id, league_lineage_id, CAST(2000 + depth AS STRING) AS season FROM (SELECT CAST(o_orderkey AS STRING) AS league_id, CAST(o_custkey AS STRING) AS league_lineage_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS depth FROM {orders}) AS k WHERE depth <= 2"
MEMBERS = "SELECT CAST(o_orderkey AS STRING) AS league_id, concat('U', CAST(o_custkey AS STRING)) AS user_id FROM {orders}"


@query(f"WITH p AS ({_PLACES}) SELECT p.league_id, q.league_id AS previous_league_id, CAST(p.o_custkey AS VARCHAR) AS league_lineage_id, CAST(p.depth - 1 AS INT) AS hop FROM p JOIN p q ON q.o_custkey = p.o_custkey AND q.depth = p.depth - 1 WHERE p.depth BETWEEN 2 AND 6")
def g3_discover_forward(spark, d):
    return graph.discover_forward(derive(spark, d, KNOWN), derive(spark, d, CHAIN), derive(spark, d, MEMBERS))


#: Suppliers meet in orders. The crawl starts from the first supplier, under its default cap.
USER_LEAGUE = "SELECT DISTINCT concat('U', CAST(l_suppkey AS STRING)) AS user_id, concat('P', CAST(l_orderkey AS STRING)) AS league_id FROM {lineitem}"
SEEDS = "SELECT concat('U', CAST(min(l_suppkey) AS STRING)) AS user_id FROM {lineitem}"
_HOPS = """l0 AS (SELECT DISTINCT league_id FROM e JOIN s USING (user_id)), u1 AS (SELECT DISTINCT user_id FROM e JOIN l0 USING (league_id)), l1 AS (SELECT DISTINCT league_id FROM e JOIN u1 USING (user_id)),
u2 AS (SELECT DISTINCT user_id FROM e JOIN l1 USING (league_id)), l2 AS (SELECT DISTINCT league_id FROM e JOIN u2 USING (user_id)), u3 AS (SELECT DISTINCT user_id FROM e JOIN l2 USING (league_id)), l3 AS (SELECT DISTINCT league_id FROM e JOIN u3 USING (user_id))"""


@query(f"WITH {_HOPS} SELECT league_id, CAST(min(hop) AS INT) AS hop FROM (SELECT *, 0 AS hop FROM l0 UNION ALL SELECT *, 1 FROM l1 UNION ALL SELECT *, 2 FROM l2 UNION ALL SELECT *, 3 FROM l3) GROUP BY league_id ORDER BY hop, league_id LIMIT 10000", e=USER_LEAGUE, s=SEEDS)
def g4_bfs_crawl(spark, d):
    edges = derive(spark, d, USER_LEAGUE)
    return graph.bfs_crawl(derive(spark, d, SEEDS), edges, edges)


# --- sources: round trips through the session's scratch folder ------------------------------------------


def _folder(spark) -> str:
    """A folder that all machines share; a temporary one only on a single machine."""
    import uuid

    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{named}/stintlake-{uuid.uuid4().hex}" if named else tempfile.mkdtemp(prefix="stintlake-")


@query("SELECT * FROM customer")
def s1_read_table(spark, d):
    return io.read_table(spark, f"{d}/customer.parquet")


@query("SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INT) AS season FROM orders")
def s2_read_prefix(spark, d):
    path = _folder(spark)
    io.write_partitioned(derive(spark, d, "SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INT) AS season FROM {orders}"), f"{path}/t", ["season"])
    return io.read_prefix(spark, f"{path}/t")


@query("SELECT o_orderstatus AS kind, count(*) AS n FROM orders GROUP BY 1")
def s3_partition_columns(spark, d):
    path = _folder(spark)
    table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("kind")).write.partitionBy("kind").parquet(f"{path}/t")
    flat = spark.read.option("recursiveFileLookup", True).parquet(f"{path}/t")
    return io.partition_columns(flat, ["kind"]).groupBy("kind").agg(F.count("*").alias("n"))


DATED = "SELECT user_id, value, CAST(ts AS DATE) AS load_date FROM {events}"


@query("SELECT user_id, value, CAST(ts AS DATE) AS load_date FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)")
def s4_latest_partition(spark, d):
    path = _folder(spark)
    io.write_partitioned(derive(spark, d, DATED), f"{path}/t", ["load_date"])
    return io.latest_partition(io.read_prefix(spark, f"{path}/t"))


@query("SELECT max(o_orderstatus) AS newest, max(o_orderstatus) AS greatest FROM orders")
def s5_s6_latest_files(spark, d):
    path = _folder(spark)
    for status in sorted(r[0] for r in table(spark, d, "orders").select("o_orderstatus").distinct().collect()):  # three values
        table(spark, d, "orders").where(F.col("o_orderstatus") == status).coalesce(1).write.parquet(f"{path}/t/kind={status}")
    df = io.read_prefix(spark, f"{path}/t")
    pick = lambda p: F.regexp_extract(F.lit(p), "kind=([A-Z])", 1)
    return spark.range(1).select(pick(io.latest_by_mtime(df)).alias("newest"), pick(io.latest_file(df)).alias("greatest"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(ts AS DATE) ELSE DATE '2024-06-01' END AS snapshot_date FROM events")
def s7_snapshot_date(spark, d):
    path = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("a/load_date="), F.col("ts").cast("date").cast("string"), F.lit(".parquet"))).otherwise("a/b.parquet")
    return table(spark, d, "events").select("event_id", io.snapshot_date(path, "2024-06-01").alias("snapshot_date"))


@query("SELECT p_partkey, p_size FROM part WHERE p_size > 10")
def s8_read_glob(spark, d):
    return io.read_glob(spark, f"{d}/part*.parquet", "p_partkey bigint, p_size int").where("p_size > 10")


@query("SELECT o_orderpriority, count(*) AS n, max(o_orderkey) AS top FROM orders GROUP BY 1")
def s9_write_partitioned(spark, d):
    path = _folder(spark)
    io.write_partitioned(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), f"{path}/t", ["o_orderpriority"])
    return spark.read.parquet(f"{path}/t").groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("top"))


@query("SELECT DATE '2024-01-09' AS load_date, count(*) AS n FROM customer WHERE c_custkey % 2 = 0")
def s10_write_bronze(spark, d):
    path = _folder(spark)
    for part, day in ((table(spark, d, "customer"), "2024-01-10"), (table(spark, d, "customer").where("c_custkey % 2 = 0"), "2024-01-15"), (table(spark, d, "customer").limit(0), "2024-01-22")):
        out = io.write_bronze(part, path, "users", day, "weekly") or out  # noqa: F821
    return spark.read.parquet(out).groupBy("load_date").agg(F.count("*").alias("n"))


@query("SELECT CAST(year(o_orderdate) AS INT) AS season, count(*) AS n FROM orders GROUP BY 1")
def s11_write_seasons(spark, d):
    path = _folder(spark)
    io.write_seasons(derive(spark, d, "SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS season FROM {orders}"), path, "2024-01-01")
    return spark.read.parquet(path).groupBy("season").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'second' ELSE 'first' END AS state FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 <> 0")
def s12_upsert_table(spark, d):
    path, customers = _folder(spark), table(spark, d, "customer").select("c_custkey")
    bucketed.upsert_table(customers.where("c_custkey % 3 <> 0").withColumn("state", F.lit("first")), path, ["c_custkey"], "v1")
    bucketed.upsert_table(customers.where("c_custkey % 2 = 0").withColumn("state", F.lit("second")), path, ["c_custkey"], "v2")
    return bucketed.read_current(spark, path)


@query("SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year, CAST(week(o_orderdate) AS INT) AS week FROM orders WHERE year(o_orderdate) NOT IN (1993, 1995)")
def s13_resume(spark, d):
    weeks = derive(spark, d, "SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year, CAST(weekofyear(o_orderdate) AS INT) AS week FROM {orders}")
    return io.resume(weeks, weeks.where("year IN (1993, 1995)"), ["year", "week"])


RECORDS = "SELECT to_json(named_struct('k', o_orderkey, 'n', CASE WHEN o_orderkey % 5 = 0 THEN 'bad' ELSE CAST(o_custkey AS STRING) END, 'd', CAST(o_orderdate AS DATE), 't', o_orderpriority)) AS doc FROM {orders}"


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS n, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS t FROM orders")
def s15_records_to_table(spark, d):
    return io.records_to_table(derive(spark, d, RECORDS), "doc", "k bigint, n bigint, d date, t string")


@query("SELECT c_custkey, CAST(NULL AS VARCHAR) AS note FROM customer")
def s16_empty_frame(spark, d):
    empty = io.empty_frame(spark, "c_custkey bigint, note string")
    return table(spark, d, "customer").select("c_custkey").join(empty, "c_custkey", "left")


@query("SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS player_id, l_quantity AS value, p_name AS name FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_partkey % 4 <> 0) ON p_partkey = l_partkey")
def s17_values_with_players(spark, d):
    values = derive(spark, d, "SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS player_id, l_quantity AS value FROM {lineitem}")
    return io.values_with_players(values, derive(spark, d, "SELECT p_partkey AS player_id, p_name AS name FROM {part} WHERE p_partkey % 4 <> 0"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def s18_csv_round_trip(spark, d):
    path = _folder(spark)
    io.write_csv(table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"), f"{path}/t")
    return io.read_csv(spark, f"{path}/t", "c_custkey bigint, c_name string, c_acctbal double")


@query("SELECT o_orderkey, m.label FROM orders JOIN (VALUES ('O', 'open'), ('F', 'filled')) AS m(code, label) ON o_orderstatus = code")
def s19_static_table(spark, d):
    names = io.static_table(spark, [("O", "open"), ("F", "filled")], "o_orderstatus string, label string")
    return table(spark, d, "orders").join(names, "o_orderstatus").select("o_orderkey", "label")


@query("SELECT c_custkey, coalesce(n_name, 'none') AS n_name, CAST(NULL AS VARCHAR) AS alias FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey")
def s20_mapping(spark, d):
    path = _folder(spark)
    io.write_csv(table(spark, d, "nation").select("n_nationkey", "n_name"), f"{path}/m")
    known = io.read_mapping(spark, f"{path}/m", "n_nationkey int, n_name string")
    missing = io.read_mapping(spark, f"{path}/none", "n_nationkey int, alias string")
    df = table(spark, d, "customer").join(known, F.col("c_nationkey") == known["n_nationkey"], "left").join(missing, F.col("c_nationkey") == missing["n_nationkey"], "left")
    return df.select("c_custkey", F.coalesce("n_name", F.lit("none")).alias("n_name"), "alias")


_COLUMN = "SELECT '{t}' AS table_name, '{c}' AS column_name, '{k}' AS data_type, count(*) AS n_rows, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct, true AS estimate_is_near FROM {t}"
_PROFILED = [("nation", "n_name", "string"), ("orders", "o_orderkey", "bigint"), ("orders", "o_custkey", "bigint"), ("orders", "o_orderstatus", "string")]


@query(" UNION ALL ".join(_COLUMN.format(t=t, c=c, k=k) for t, c, k in _PROFILED))
def s21_profile(spark, d):
    """Exact profiles, and whether the estimate from sketches merged over partitions is within a twelfth."""
    tables = {t: table(spark, d, t).select(*[c for u, c, _ in _PROFILED if u == t]) for t in ("nation", "orders")}
    exact = io.profile(tables, exact=True)
    stored = profiles.sketch_profile(tables["orders"], "orders", "o_orderstatus").unionByName(profiles.sketch_profile(tables["nation"], "nation", F.substring("n_name", 1, 1)))
    near = profiles.merge_profiles(stored).select("table_name", "column_name", F.col("n_distinct").alias("_estimate"))
    return exact.join(near, ["table_name", "column_name"]).withColumn("estimate_is_near", F.abs(F.col("_estimate") - F.col("n_distinct")) * 12 <= F.col("n_distinct")).drop("_estimate")


def _bad(df):
    return F.when(F.col("o_totalprice") < 1000, "small").when(F.col("o_orderstatus") == "P", "pending")


@query("SELECT CASE WHEN o_totalprice < 1000 THEN 'small' ELSE 'pending' END AS error, count(*) AS n FROM orders WHERE o_totalprice < 1000 OR o_orderstatus = 'P' GROUP BY 1 UNION ALL SELECT 'none', count(*) FROM orders WHERE NOT (o_totalprice < 1000 OR o_orderstatus = 'P')")
def s22_split_bad_records(spark, d):
    good, bad = io.split_bad_records(table(spark, d, "orders"), _bad)
    return bad.groupBy("error").agg(F.count("*").alias("n")).union(good.groupBy(F.lit("none").alias("error")).agg(F.count("*").alias("n")))
