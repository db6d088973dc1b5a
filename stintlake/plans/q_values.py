"""Queries of dimensions (D) and value alignment (V)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stintlake.functions.coerce import week_start
from stintlake.operators import calendar, dedupe, dimensions, scd2, values
from stintlake.plans.registry import derive, query, table

# --- dimensions ----------------------------------------------------------------------------------------

FULL = "SELECT CAST(c_custkey AS STRING) AS league_id, concat('L', CAST(c_custkey % 50 AS STRING)) AS league_lineage_id, CAST(floor(c_acctbal) AS BIGINT) AS val FROM {customer} WHERE c_custkey % 3 <> 0"
INCREMENTAL = "SELECT CAST(c_custkey AS STRING) AS league_id, CAST(floor(c_acctbal) AS BIGINT) + 1 AS val FROM {customer} WHERE c_custkey % 2 = 0"


@query("SELECT coalesce(i.league_id, f.league_id) AS league_id, f.league_lineage_id, coalesce(i.val, f.val) AS val FROM f FULL JOIN i ON f.league_id = i.league_id", f=FULL, i=INCREMENTAL)
def d1_merge_full_and_incremental(spark, d):
    return dedupe.merge_full_and_incremental(derive(spark, d, FULL), derive(spark, d, INCREMENTAL), "league_id", ["league_lineage_id"])


#: Orders as a chain: every order points to the same customer's order before it.
CHAIN = """SELECT CAST(o_orderkey AS STRING) AS league_id, CAST(lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS STRING) AS previous_league_id,
  CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INT) AS place, o_custkey, o_orderstatus FROM {orders}"""
META_FULL = "SELECT league_id, previous_league_id, CASE WHEN place = 1 THEN league_id END AS league_lineage_id, CAST(2000 + place AS STRING) AS season, CASE WHEN o_orderstatus = 'F' THEN 'complete' ELSE 'in_season' END AS status, 10 AS total_rosters, place, o_custkey FROM (" + CHAIN + ") AS c"
META_STATUS = "SELECT league_id, 'complete' AS status FROM (" + CHAIN + ") AS c WHERE place = 2"


@query(
    """WITH g AS (SELECT f.*, first_value(league_id) OVER (PARTITION BY o_custkey ORDER BY place) AS first_id FROM f), r AS (SELECT *, CASE WHEN place <= 13 THEN first_id ELSE league_id END AS root FROM g)
SELECT r.league_id, root AS league_lineage_id, CAST(NULL AS VARCHAR) AS league_name, season, coalesce(s.status, r.status) AS status, CAST(NULL AS VARCHAR) AS season_type, total_rosters, CAST(NULL AS VARCHAR) AS draft_id, CAST(NULL AS VARCHAR) AS bracket_id,
CAST(NULL AS VARCHAR) AS leg, CAST(NULL AS VARCHAR) AS last_scored_leg, previous_league_id, r.league_id = root AS is_original, coalesce(s.status, r.status) <> 'complete' AS is_active FROM r LEFT JOIN s ON s.league_id = r.league_id""",
    f=META_FULL, s=META_STATUS,
)
def d2_dim_leagues_meta(spark, d):
    full = derive(spark, d, META_FULL)
    return dimensions.dim_leagues_meta(full, full.limit(0), derive(spark, d, META_STATUS))


OLD = "SELECT c_custkey AS league_id, CAST(floor(c_acctbal) AS BIGINT) AS teams, c_mktsegment AS kind FROM {customer} WHERE c_custkey % 5 <> 0"
NEW = "SELECT c_custkey AS league_id, CASE WHEN c_custkey % 4 = 0 THEN CAST(floor(c_acctbal) AS BIGINT) + 1 ELSE CAST(floor(c_acctbal) AS BIGINT) END AS teams, CASE WHEN c_custkey % 9 = 0 THEN CAST(NULL AS STRING) ELSE c_mktsegment END AS kind FROM {customer} WHERE c_custkey % 7 <> 0"


@query(
    """WITH j AS (SELECT o.*, n.league_id AS nk, n.league_id IS NOT NULL AND (o.teams IS DISTINCT FROM n.teams OR o.kind IS DISTINCT FROM n.kind) AS ch FROM o LEFT JOIN n USING (league_id))
SELECT league_id, teams, kind, DATE '2024-01-01' AS valid_from, CASE WHEN ch THEN DATE '2024-02-01' END AS valid_to, NOT ch AS is_current, CASE WHEN nk IS NOT NULL AND NOT ch THEN DATE '2024-02-01' ELSE DATE '2024-01-01' END AS loaded_at FROM j
UNION ALL SELECT league_id, teams, kind, DATE '2024-02-01', NULL, true, DATE '2024-02-01' FROM n WHERE league_id NOT IN (SELECT league_id FROM j WHERE nk IS NOT NULL AND NOT ch)""",
    o=OLD, n=NEW,
)
def d3_scd2_apply(spark, d):
    first = scd2.scd2_apply(None, derive(spark, d, OLD), "league_id", "2024-01-01")
    return scd2.scd2_apply(first, derive(spark, d, NEW), "league_id", "2024-02-01")


SCORING = "SELECT c_custkey AS league_id, c_custkey % 9 AS league_lineage_id, CAST(c_nationkey AS DOUBLE) AS pass_td FROM {customer}"
SLOT_COUNTS = "SELECT c_custkey AS league_id, c_custkey % 9 AS league_lineage_id, CASE WHEN c_custkey % 2 = 0 THEN 1 END AS QB, 2 AS RB, CAST(c_nationkey % 4 AS BIGINT) AS TAXI FROM {customer}"
RULES = "SELECT c_custkey AS league_id, c_custkey % 9 AS league_lineage_id, 10 + c_nationkey % 3 AS num_teams, c_nationkey AS leg FROM {customer} WHERE c_custkey % 6 <> 0"
RULES_NEW = "SELECT c_custkey AS league_id, 14 AS num_teams, 3 AS leg FROM {customer} WHERE c_custkey % 10 = 1"


@query(
    """SELECT s.league_id, s.league_lineage_id, pass_td, CAST(coalesce(QB, 0) AS BIGINT) AS qb_slots, CAST(RB AS BIGINT) AS rb_slots, TAXI AS taxi_slots, coalesce(n.num_teams, r.num_teams) AS num_teams
FROM sc s LEFT JOIN sl ON sl.league_id = s.league_id LEFT JOIN r ON r.league_id = s.league_id LEFT JOIN n ON n.league_id = s.league_id""",
    sc=SCORING, sl=SLOT_COUNTS, r=RULES, n=RULES_NEW,
)
def d4_league_constitution(spark, d):
    get = lambda text: derive(spark, d, text)
    return dimensions.league_constitution((get(SCORING), get(SCORING).limit(0)), (get(SLOT_COUNTS), get(SLOT_COUNTS).limit(0)), (get(RULES), get(RULES_NEW)))


PLAYERS = "SELECT CAST(p_partkey AS STRING) AS player_id, CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS first_name, CASE WHEN p_partkey % 7 <> 0 THEN p_type END AS last_name, 'a.png' AS avatar, CASE WHEN p_partkey % 3 = 0 THEN '1990-05-01' END AS birth_date FROM {part}"
IDS = "SELECT CAST(p_partkey AS STRING) AS sleeper_id, concat('G', CAST(p_partkey AS STRING)) AS gsis_id, p_partkey * 10 AS ktc_id, p_partkey * 100 AS espn_id, p_name AS name, CASE WHEN p_partkey % 4 = 0 THEN '2015' END AS draft_year FROM {part} WHERE p_partkey % 5 <> 0"
BIO = "SELECT concat('G', CAST(p_partkey AS STRING)) AS gsis_id, concat('Bio ', p_name) AS display_name, CASE WHEN p_partkey % 2 = 0 THEN 'head.png' END AS headshot, CASE WHEN p_partkey % 6 = 0 THEN 2012 END AS draft_year, '1985-02-03' AS birth_date FROM {part} WHERE p_partkey % 11 <> 0"


@query(
    """SELECT p.player_id, first_name, last_name, coalesce(p.birth_date, b.birth_date) AS birth_date, coalesce(nullif(trim(concat_ws(' ', first_name, last_name)), ''), b.display_name, i.name) AS name, coalesce(b.headshot, p.avatar) AS avatar,
CAST(coalesce(b.draft_year, CAST(i.draft_year AS INT), CAST(substr(coalesce(p.birth_date, b.birth_date), 1, 4) AS INT) + 22) AS INT) AS draft_year, i.gsis_id, ktc_id, espn_id, p.player_id AS player_key FROM p LEFT JOIN i ON i.sleeper_id = p.player_id LEFT JOIN b ON b.gsis_id = i.gsis_id""",
    p=PLAYERS, i=IDS, b=BIO,
)
def d5_dim_players_master(spark, d):
    return dimensions.dim_players_master(derive(spark, d, PLAYERS), derive(spark, d, IDS), derive(spark, d, BIO))


USERS = "SELECT CAST(o_custkey AS STRING) AS user_id, CASE WHEN o_custkey % 5 <> 0 THEN concat('user', CAST(o_orderkey AS STRING)) END AS display_name, CAST(NULL AS STRING) AS avatar, o_orderkey AS timestamp FROM {orders}"
NAMES = "SELECT CAST(c_custkey AS STRING) AS user_id, CASE WHEN c_custkey % 3 = 0 THEN '  ' ELSE c_name END AS real_name FROM {customer} WHERE c_custkey % 2 = 0"
_USERS = """lu AS (SELECT user_id, display_name, avatar FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY timestamp DESC) AS rn FROM us) WHERE rn = 1),
du AS (SELECT lu.user_id, display_name, avatar, nullif(trim(real_name), '') AS real_name, coalesce(nullif(trim(real_name), ''), display_name, 'Unknown') AS name FROM lu LEFT JOIN nm USING (user_id))"""


@query(f"WITH {_USERS} SELECT * FROM du", us=USERS, nm=NAMES)
def d6_dim_users(spark, d):
    return dimensions.dim_users(derive(spark, d, USERS), derive(spark, d, NAMES))


OWNERS = "SELECT concat('N', CAST(c_nationkey AS STRING), '_', CAST(2023 + c_custkey % 2 AS STRING)) AS league_id, c_custkey AS roster_id, CASE WHEN c_custkey % 8 <> 0 THEN CAST(c_custkey AS STRING) END AS owner_id FROM {customer}"


@query(
    f"""WITH {_USERS} SELECT league_lineage_id || '_' || CAST(roster_id AS VARCHAR) AS franchise_id, league_lineage_id, r.league_id, roster_id, owner_id, coalesce(name, 'Orphan Roster ' || CAST(roster_id AS VARCHAR)) AS franchise_name, owner_id IS NULL AS is_orphan
FROM r JOIN (SELECT league_lineage_id, arg_max(league_id, CAST(season AS INT)) AS league_id FROM leagues GROUP BY league_lineage_id) c ON c.league_id = r.league_id LEFT JOIN du ON du.user_id = owner_id""",
    us=USERS, nm=NAMES, r=OWNERS, leagues="SELECT concat('N', CAST(n_nationkey AS STRING), '_', CAST(y AS STRING)) AS league_id, concat('N', CAST(n_nationkey AS STRING)) AS league_lineage_id, CAST(y AS STRING) AS season FROM {nation}, (SELECT 2023 AS y UNION ALL SELECT 2024) AS ys",
)
def d7_dim_franchises_meta(spark, d):
    leagues = derive(spark, d, "SELECT concat('N', CAST(n_nationkey AS STRING), '_', CAST(y AS STRING)) AS league_id, concat('N', CAST(n_nationkey AS STRING)) AS league_lineage_id, CAST(y AS STRING) AS season FROM {nation}, (SELECT 2023 AS y UNION ALL SELECT 2024) AS ys")
    return dimensions.dim_franchises_meta(derive(spark, d, OWNERS), leagues, d6_dim_users(spark, d))


#: Orders as a schedule: the year's second half has the regular games, early winter the others.
SCHEDULE = """SELECT CAST(year(o_orderdate) AS INT) AS season, CASE WHEN month(o_orderdate) < 11 THEN 'REG' ELSE 'WC' END AS game_type, CAST(o_orderdate AS DATE) AS gameday, CAST(1 + day(o_orderdate) % 18 AS INT) AS week
  FROM {orders} WHERE month(o_orderdate) >= 6 AND NOT (year(o_orderdate) = 1998 AND month(o_orderdate) >= 11)"""
_BOUNDS = "b AS (SELECT season, min(gameday) FILTER (game_type = 'REG') AS season_start, max(gameday) FILTER (game_type = 'REG') AS reg_end, min(gameday) FILTER (game_type <> 'REG') AS playoff_start, max(gameday) FILTER (game_type <> 'REG') AS playoff_end FROM sc GROUP BY season HAVING season_start IS NOT NULL)"


@query(f"WITH {_BOUNDS} SELECT * FROM b", sc=SCHEDULE)
def d8_season_boundaries(spark, d):
    return calendar.season_boundaries(derive(spark, d, SCHEDULE))


_SPINE = "sp AS (SELECT CAST(unnest(generate_series((SELECT min(season_start) FROM b), (SELECT max(greatest(season_start, coalesce(reg_end, season_start), coalesce(playoff_end, season_start))) FROM b) + 400, INTERVAL 1 DAY)) AS DATE) AS date)"


@query(f"WITH {_BOUNDS}, {_SPINE} SELECT * FROM sp", sc=SCHEDULE)
def d9_date_spine(spark, d):
    return calendar.date_spine(calendar.season_boundaries(derive(spark, d, SCHEDULE)))


@query(
    f"""WITH {_BOUNDS}, {_SPINE}, x AS (SELECT sp.date, b.*, CASE WHEN sp.date <= reg_end THEN 'regular' WHEN playoff_end IS NULL OR sp.date <= playoff_end THEN 'playoffs' ELSE 'offseason' END AS phase FROM sp ASOF LEFT JOIN b ON sp.date >= b.season_start)
SELECT date, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, CAST(day(date) AS INT) AS day, CAST(isodow(date) AS INT) AS day_of_week, CAST(week(date) AS INT) AS week_of_year, CASE WHEN phase = 'offseason' THEN season + 1 ELSE season END AS season, phase,
date = season_start AS is_season_start, coalesce(date = playoff_start, false) AS is_playoff_start, coalesce(date = playoff_end, false) AS is_playoff_end FROM x""",
    sc=SCHEDULE,
)
def d10_dim_dates(spark, d):
    return calendar.build_dim_dates(derive(spark, d, SCHEDULE))


DRAFTS = """SELECT CAST(o_orderkey AS STRING) AS draft_id, concat('L', CAST(o_custkey AS STRING)) AS league_id, CAST(year(o_orderdate) AS INT) AS season, CAST(1 + o_orderkey % 12 AS BIGINT) AS rounds,
  CASE WHEN o_orderkey % 3 <> 0 THEN CAST(800000000000 + o_orderkey * 1000000 AS BIGINT) END AS start_time, CASE WHEN o_orderkey % 2 = 0 THEN CAST(800100000000 + o_orderkey * 1000000 AS BIGINT) END AS last_picked FROM {orders}"""
DRAFT_LEAGUES = "SELECT concat('L', CAST(c_custkey AS STRING)) AS league_id, concat('R', CAST(c_custkey % 100 AS STRING)) AS league_lineage_id, CAST(1992 + c_custkey % 6 AS STRING) AS season FROM {customer} WHERE c_custkey % 13 <> 0"
_DRAFT_EVENTS = "de AS (SELECT league_lineage_id, league_id, dr.season, CASE WHEN rounds > 7 THEN 'startup_draft' ELSE 'rookie_draft' END AS event_type, CAST(make_timestamp(coalesce(start_time, last_picked) * 1000) AS DATE) AS event_date FROM dr JOIN (SELECT DISTINCT league_id, league_lineage_id FROM le) USING (league_id))"


@query(f"WITH {_DRAFT_EVENTS} SELECT * FROM de", dr=DRAFTS, le=DRAFT_LEAGUES)
def d11_draft_events(spark, d):
    return calendar.draft_events(derive(spark, d, DRAFTS), derive(spark, d, DRAFT_LEAGUES))


PLAYOFFS = "SELECT concat('L', CAST(c_custkey AS STRING)) AS league_id, 13 + c_custkey % 3 AS playoff_week_start, 4 + c_custkey % 5 AS playoff_teams, c_custkey % 10 <> 0 AS is_current FROM {customer}"
_ENDS = """wk AS (SELECT season, week, max(gameday) AS event_date FROM sc WHERE game_type = 'REG' GROUP BY season, week),
fe AS (SELECT league_lineage_id, po.league_id, CAST(le.season AS INT) AS season, 'fantasy_end' AS event_type, event_date FROM po JOIN le ON le.league_id = po.league_id LEFT JOIN wk ON wk.season = CAST(le.season AS INT) AND wk.week = playoff_week_start + ceil(log2(playoff_teams)) - 1 WHERE is_current)"""


def _ends(spark, d):
    return calendar.fantasy_end_events(derive(spark, d, PLAYOFFS), derive(spark, d, DRAFT_LEAGUES), derive(spark, d, SCHEDULE))


@query(f"WITH {_ENDS} SELECT * FROM fe", sc=SCHEDULE, po=PLAYOFFS, le=DRAFT_LEAGUES)
def d12_fantasy_end_events(spark, d):
    return _ends(spark, d)


@query(f"WITH {_DRAFT_EVENTS}, {_ENDS} SELECT * FROM (SELECT * FROM de UNION ALL SELECT * FROM fe) WHERE event_date IS NOT NULL", sc=SCHEDULE, po=PLAYOFFS, le=DRAFT_LEAGUES, dr=DRAFTS)
def d13_dim_league_events(spark, d):
    return calendar.build_dim_league_events(derive(spark, d, DRAFTS), derive(spark, d, PLAYOFFS), derive(spark, d, DRAFT_LEAGUES), derive(spark, d, SCHEDULE))


@query(f"WITH {_ENDS} SELECT league_lineage_id, season, season_start, event_date AS season_end FROM fe JOIN (SELECT season, min(gameday) AS season_start FROM sc WHERE game_type = 'REG' GROUP BY season) USING (season)", sc=SCHEDULE, po=PLAYOFFS, le=DRAFT_LEAGUES)
def d14_season_windows(spark, d):
    return calendar.season_windows(derive(spark, d, SCHEDULE), _ends(spark, d))


@query("SELECT CAST(d - CAST((isodow(d) - 2 + 7) % 7 AS INT) AS DATE) AS week_start, count(*) AS n FROM (SELECT CAST(ts AS DATE) AS d FROM events) GROUP BY 1")
def d15_week_bucket(spark, d):
    return derive(spark, d, "SELECT CAST(ts AS DATE) AS d FROM {events}").groupBy(week_start("d", "tuesday").alias("week_start")).agg(F.count("*").alias("n"))


# --- values --------------------------------------------------------------------------------------------

#: A wide feed of players and picks made from parts.
WIDE = """SELECT CAST(l_shipdate AS DATE) AS valuation_date, concat('name-', CAST(l_partkey AS STRING)) AS slug,
  CASE WHEN l_partkey % 5 = 0 THEN concat(CAST(2024 + l_suppkey % 3 AS STRING), CASE WHEN l_suppkey % 2 = 0 THEN ' Early ' ELSE ' Late ' END, CASE l_partkey % 3 WHEN 0 THEN '1st' WHEN 1 THEN '2nd' ELSE '3rd' END) ELSE concat('Player ', CAST(l_partkey AS STRING)) END AS playerName,
  CAST(max(l_quantity) AS BIGINT) AS oneqb_value, CAST(min(l_quantity) AS BIGINT) AS oneqb_tep_value, CAST(floor(max(l_extendedprice)) AS BIGINT) AS sf_value, CASE WHEN l_partkey % 2 = 0 THEN CAST(floor(min(l_extendedprice)) AS BIGINT) END AS sf_tep_value
  FROM {lineitem} GROUP BY l_shipdate, l_partkey, l_suppkey"""
_LONG = """lo AS (SELECT valuation_date, slug, playerName, '1QB' AS qb_format, 'Standard' AS te_premium, oneqb_value AS value FROM w UNION ALL SELECT valuation_date, slug, playerName, '1QB', 'TEP', oneqb_tep_value FROM w
UNION ALL SELECT valuation_date, slug, playerName, 'SF', 'Standard', sf_value FROM w UNION ALL SELECT valuation_date, slug, playerName, 'SF', 'TEP', sf_tep_value FROM w)"""


@query(f"WITH {_LONG} SELECT valuation_date, 'wide_feed' AS source_system, slug AS source_id, playerName AS asset_name, 'PLAYER' AS asset_type, 'DYNASTY' AS market_type, qb_format, te_premium, CAST(value AS DOUBLE) AS value FROM lo WHERE value IS NOT NULL", w=WIDE)
def v1_melt_values(spark, d):
    return values.melt_values(derive(spark, d, WIDE), "DYNASTY")


SIMPLE = "SELECT p_partkey AS id, CASE WHEN p_partkey % 4 = 0 THEN concat('2026 Pick 1.', CAST(p_partkey % 12 + 1 AS STRING)) ELSE p_name END AS name, CAST('2024-01-05' AS DATE) AS valuation_date, p_retailprice AS price FROM {part}"


@query(r"SELECT valuation_date, 'simple' AS source_system, CAST(id AS VARCHAR) AS source_id, name AS asset_name, CASE WHEN regexp_matches(name, '(?i)pick|round|1st|2nd|3rd|4th|20[2-9][0-9]') THEN 'PICK' ELSE 'PLAYER' END AS asset_type, 'REDRAFT' AS market_type, 'SF' AS qb_format, 'Standard' AS te_premium, price AS value FROM s", s=SIMPLE)
def v2_standardize_simple(spark, d):
    return values.standardize_simple(derive(spark, d, SIMPLE), "simple", "REDRAFT", "SF", "Standard", "price")


FRESH = "SELECT l_partkey AS id, l_shipdate AS day, l_quantity AS v FROM {lineitem} WHERE l_returnflag = 'A'"
ARCHIVE = "SELECT l_partkey AS id, l_shipdate AS day, l_quantity AS v FROM {lineitem} WHERE l_returnflag = 'R'"


@query("SELECT * FROM m UNION ALL SELECT * FROM a WHERE id NOT IN (SELECT id FROM m)", m=FRESH, a=ARCHIVE)
def v3_gap_fill(spark, d):
    return dedupe.gap_fill(derive(spark, d, FRESH), derive(spark, d, ARCHIVE), "id")


@query("SELECT c_custkey, try_cast(split_part(c_name || CASE WHEN c_custkey % 3 = 0 THEN '-x' ELSE '-' || CAST(c_custkey AS VARCHAR) END, '-', -1) AS BIGINT) AS id FROM customer")
def v4_trailing_id(spark, d):
    slug = F.concat("c_name", F.when(F.col("c_custkey") % 3 == 0, "-x").otherwise(F.concat(F.lit("-"), F.col("c_custkey").cast("string"))))
    return table(spark, d, "customer").select("c_custkey", values.trailing_id(slug).alias("id"))


@query("WITH s AS (SELECT *, 0 AS o FROM a UNION ALL SELECT *, 1 FROM m) SELECT id, arg_max(struct_pack(day := day, v := v), (o, day, v)).day AS day, arg_max(v, (o, day, v)) AS v FROM s GROUP BY id", m=FRESH, a=ARCHIVE)
def v5_stack_latest(spark, d):
    both = [f.groupBy("id").agg(F.max(F.struct("day", "v")).alias("x")).select("id", "x.day", "x.v") for f in (derive(spark, d, ARCHIVE), derive(spark, d, FRESH))]
    return dedupe.stack_latest(both, ["id"])


STAGING = """SELECT CAST(l_shipdate AS DATE) AS valuation_date, CASE WHEN l_linenumber % 2 = 0 THEN 'ktc' ELSE 'fc' END AS source_system, CAST(l_partkey AS STRING) AS source_id, concat('P', CAST(l_partkey % 900 AS STRING)) AS asset_name, 'DYNASTY' AS market_type,
  CASE WHEN l_suppkey % 2 = 0 THEN 'SF' ELSE '1QB' END AS qb_format, 'Standard' AS te_premium, CAST(floor(l_extendedprice) AS BIGINT) AS value FROM {lineitem}"""
PLAYER_DIM = "SELECT CAST(p_partkey AS STRING) AS player_id, concat('P', CAST(p_partkey % 1500 AS STRING)) AS name, CASE WHEN p_partkey % 6 <> 0 THEN p_partkey END AS ktc_id FROM {part}"
_RESOLVED = """un AS (SELECT name, any_value(player_id) AS pid FROM pd GROUP BY name HAVING count(*) = 1),
rs AS (SELECT st.*, CASE WHEN source_system = 'ktc' THEN k.player_id WHEN source_system = 'fc' THEN un.pid END AS player_id FROM st LEFT JOIN pd k ON CAST(k.ktc_id AS VARCHAR) = source_id LEFT JOIN un ON un.name = asset_name)"""


def _split(spark, d):
    return values.resolve_and_split(derive(spark, d, STAGING), derive(spark, d, PLAYER_DIM), "ktc", "fc")


@query(f"WITH {_RESOLVED} SELECT * FROM rs WHERE player_id IS NOT NULL", st=STAGING, pd=PLAYER_DIM)
def v6_resolved(spark, d):
    return _split(spark, d)[0]


@query(f"WITH {_RESOLVED} SELECT DISTINCT source_system, coalesce(asset_name, source_id) AS asset_name FROM rs WHERE player_id IS NULL", st=STAGING, pd=PLAYER_DIM)
def v6_quarantine(spark, d):
    return _split(spark, d)[1]


@query(
    f"""WITH {_RESOLVED}, p AS (SELECT valuation_date, player_id, market_type, qb_format, te_premium, CAST(coalesce(max(value) FILTER (source_system = 'ktc'), 0) AS DOUBLE) AS ktc_value, CAST(coalesce(max(value) FILTER (source_system = 'fc'), 0) AS DOUBLE) AS fc_value FROM rs WHERE player_id IS NOT NULL GROUP BY ALL)
SELECT *, ktc_value - fc_value AS value_diff FROM p""",
    st=STAGING, pd=PLAYER_DIM,
)
def v7_build_fact(spark, d):
    return values.build_fact(_split(spark, d)[0], {"ktc": "ktc_value", "fc": "fc_value"})


_RND = "CASE {0} WHEN '1st' THEN 1 WHEN '2nd' THEN 2 WHEN '3rd' THEN 3 WHEN '4th' THEN 4 END"
_V8 = rf"""v8 AS (SELECT CAST(valuation_date AS VARCHAR) AS valuation_date, CAST(regexp_extract(playerName, '^(20\d\d)', 1) AS BIGINT) AS season, CAST({_RND.format("split_part(playerName, ' ', 3)")} AS BIGINT) AS round, split_part(playerName, ' ', 2) AS tier, 'DYNASTY' AS market_type, qb_format, te_premium, CAST(value AS DOUBLE) AS value
FROM lo WHERE value IS NOT NULL AND regexp_full_match(playerName, '20\d\d\s+(Early|Mid|Late)\s+(1st|2nd|3rd|4th)'))"""
ARCHIVED = """SELECT concat(CASE p_partkey % 3 WHEN 0 THEN 'Early ' WHEN 1 THEN 'Mid ' ELSE 'Late ' END, CAST(2024 + p_size % 4 AS STRING), CASE p_partkey % 4 WHEN 0 THEN ' 1st' WHEN 1 THEN ' 2nd' WHEN 2 THEN ' 4th' ELSE ' 5th' END) AS display_name,
  CAST(concat('2024-0', CAST(1 + p_partkey % 9 AS STRING), '-10') AS DATE) AS date, CAST(max(p_size) AS INT) AS value FROM {part} GROUP BY p_partkey, p_size"""
_V9 = rf"""v9 AS (SELECT CAST(date AS VARCHAR) AS valuation_date, CAST(split_part(display_name, ' ', 2) AS BIGINT) AS season, CAST({_RND.format("split_part(display_name, ' ', 3)")} AS BIGINT) AS round, split_part(display_name, ' ', 1) AS tier, 'DYNASTY' AS market_type, 'SF' AS qb_format, 'Standard' AS te_premium, CAST(value AS DOUBLE) AS value
FROM ar WHERE regexp_full_match(display_name, '(Early|Mid|Late)\s+20\d\d\s+(1st|2nd|3rd|4th)') AND CAST(date AS VARCHAR) <= '2024-07-01')"""


@query(f"WITH {_LONG}, {_V8} SELECT * FROM v8", w=WIDE)
def v8_parse_season_tier_round(spark, d):
    return values.parse_season_tier_round(derive(spark, d, WIDE))


@query(f"WITH {_V9} SELECT * FROM v9", ar=ARCHIVED)
def v9_parse_tier_season_round(spark, d):
    return values.parse_tier_season_round(derive(spark, d, ARCHIVED), "2024-07-01")


FEED = """SELECT CASE WHEN p_partkey % 6 = 0 THEN 'QB' ELSE 'PICK' END AS position, CASE WHEN p_partkey % 2 = 0 THEN concat(CAST(2025 + p_size % 3 AS STRING), CASE p_partkey % 4 WHEN 0 THEN ' 1st' ELSE ' 3rd' END) ELSE concat(CAST(2025 + p_size % 3 AS STRING), ' Pick ', CAST(1 + p_partkey % 4 AS STRING), '.', CAST(10 + p_size % 3 AS STRING)) END AS name,
  CAST(p_partkey AS BIGINT) AS value, CAST(concat('2024-01-', CAST(10 + p_partkey % 20 AS STRING)) AS DATE) AS load_date, CAST(concat('2024-01-', CAST(10 + p_partkey % 20 AS STRING)) AS DATE) AS valuation_date FROM {part}"""


@query(rf"SELECT CAST(valuation_date AS VARCHAR) AS valuation_date, CAST(split_part(name, ' ', 1) AS BIGINT) AS season, CAST({_RND.format('split_part(name, chr(32), 2)')} AS BIGINT) AS round, 'NA' AS tier, 'DYNASTY' AS market_type, 'SF' AS qb_format, 'Standard' AS te_premium, CAST(value AS DOUBLE) AS value FROM fe WHERE position = 'PICK' AND regexp_full_match(name, '20\d\d\s+(1st|2nd|3rd|4th)')", fe=FEED)
def v10_parse_round_generic(spark, d):
    return values.parse_round_generic(derive(spark, d, FEED))


_KEY = "valuation_date, season, round, tier, market_type, qb_format, te_premium"


@query(f"WITH {_LONG}, {_V8}, {_V9}, s AS (SELECT *, 0 AS o FROM v8 UNION ALL SELECT *, 1 FROM v9) SELECT {_KEY}, arg_min(value, (o, value)) AS value FROM s GROUP BY {_KEY}", w=WIDE, ar=ARCHIVED)
def v11_build_pick_values(spark, d):
    return values.build_pick_values(v8_parse_season_tier_round(spark, d), v9_parse_tier_season_round(spark, d))


@query(r"SELECT split_part(name, ' ', 1) AS season, CAST(regexp_extract(name, 'Pick (\d+)\.(\d+)', 1) AS BIGINT) AS round, CAST(regexp_extract(name, 'Pick (\d+)\.(\d+)', 2) AS BIGINT) AS slot, load_date AS valuation_date, value FROM fe WHERE position = 'PICK' AND name LIKE '% Pick %'", fe=FEED)
def v12_parse_exact_slot(spark, d):
    return values.parse_exact_slot(derive(spark, d, FEED))


_ROUND_ROWS = rf"rw AS (SELECT split_part(name, ' ', 1) AS season, CAST({_RND.format('split_part(name, chr(32), 2)')} AS BIGINT) AS round, load_date AS valuation_date, value FROM fe WHERE position = 'PICK' AND regexp_full_match(name, '\d\d\d\d\s+(1st|2nd|3rd|4th)'))"


@query(f"WITH {_ROUND_ROWS} SELECT * FROM rw", fe=FEED)
def v13_parse_round_rows(spark, d):
    return values.parse_round_rows(derive(spark, d, FEED))


@query(
    f"WITH {_RESOLVED}, p AS (SELECT valuation_date, player_id, qb_format, coalesce(max(value) FILTER (source_system = 'ktc'), 0) AS ktc_value FROM rs WHERE player_id IS NOT NULL GROUP BY ALL) SELECT player_id, valuation_date, CAST(ktc_value AS DOUBLE) AS value FROM p WHERE qb_format = 'SF' AND ktc_value > 0",
    st=STAGING, pd=PLAYER_DIM,
)
def v14_value_lens(spark, d):
    return values.value_lens(v7_build_fact(spark, d), "ktc_value")


LATE = "SELECT l_partkey AS player_id, CAST(l_shipdate AS DATE) AS valuation_date, l_quantity AS value FROM {lineitem} WHERE l_shipdate >= '1996-01-01' AND l_linenumber = 1"
EARLY = "SELECT l_partkey AS player_id, CAST(l_shipdate AS DATE) AS valuation_date, l_tax AS value FROM {lineitem} WHERE l_linenumber = 2"


@query("SELECT * FROM a UNION ALL SELECT * FROM b WHERE valuation_date < (SELECT min(valuation_date) FROM a)", a=LATE, b=EARLY)
def v15_era_blend(spark, d):
    return values.era_blend(derive(spark, d, LATE), derive(spark, d, EARLY))


@query(f"WITH {_ROUND_ROWS} SELECT * FROM rw UNION ALL SELECT CAST(CAST(season AS INT) + k AS VARCHAR), round, CAST(valuation_date + to_years(CAST(k AS INT)) AS DATE), value FROM rw, generate_series(1, 2) AS g(k) WHERE CAST(season AS INT) = (SELECT max(CAST(season AS INT)) FROM rw)", fe=FEED)
def v16_carry_forward(spark, d):
    return values.carry_forward(v13_parse_round_rows(spark, d))


@query(f"WITH {_V9} SELECT * FROM v9 WHERE tier = 'Mid'", ar=ARCHIVED)
def v17_tier_proxy(spark, d):
    return values.tier_proxy(v9_parse_tier_season_round(spark, d), "archive", {"archive": "Mid", "feed": "NA"})


SELECTED = "SELECT CAST(l_orderkey AS STRING) AS draft_id, l_linenumber AS pick_no, 1 + l_linenumber * (1 + l_orderkey % 2) AS round, CAST(l_partkey AS STRING) AS player_id, l_suppkey AS draft_slot FROM {lineitem}"
DRAFT_HEADS = "SELECT CAST(o_orderkey AS STRING) AS draft_id, CAST(year(o_orderdate) AS STRING) AS season FROM {orders}"


@query(
    """WITH r AS (SELECT draft_id, max(round) AS mr FROM s GROUP BY draft_id) SELECT CAST(season AS BIGINT) AS season, CAST(round AS BIGINT) AS round, CAST(pick_no AS BIGINT) AS pick_no, CAST(draft_slot AS BIGINT) AS draft_slot, player_id, draft_id, mr > 7 AS is_startup
FROM (SELECT *, row_number() OVER (PARTITION BY draft_id, pick_no ORDER BY round, player_id, draft_slot) AS rn FROM s) x JOIN h USING (draft_id) JOIN r USING (draft_id) WHERE rn = 1""",
    s=SELECTED, h=DRAFT_HEADS,
)
def v18_rookie_selections(spark, d):
    return values.rookie_selections(derive(spark, d, DRAFT_HEADS), derive(spark, d, SELECTED))


LEFT_NAMES = "SELECT l_orderkey, l_linenumber, concat('P', CAST(l_partkey % 1800 AS STRING)) AS name FROM {lineitem}"


@query("SELECT name, l_orderkey, l_linenumber, pid AS player_id FROM l JOIN (SELECT name, any_value(player_id) AS pid FROM pd GROUP BY name HAVING count(*) = 1) USING (name)", l=LEFT_NAMES, pd=PLAYER_DIM)
def v19_linked(spark, d):
    return values.link_by_unique_name(derive(spark, d, LEFT_NAMES), derive(spark, d, PLAYER_DIM))[0]


@query("SELECT DISTINCT name FROM l WHERE name NOT IN (SELECT name FROM pd GROUP BY name HAVING count(*) = 1)", l=LEFT_NAMES, pd=PLAYER_DIM)
def v19_not_found(spark, d):
    return values.link_by_unique_name(derive(spark, d, LEFT_NAMES), derive(spark, d, PLAYER_DIM))[1]


KNOWN = "SELECT concat('G', CAST(p_partkey AS STRING)) AS gsis_id, p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN p_partkey END AS espn_id FROM {part}"
FEED_IDS = "SELECT concat('G', CAST(p_partkey * 2 AS STRING)) AS gsis_id, p_partkey + 5 AS espn_id, p_brand AS team FROM {part}"


@query("SELECT gsis_id, name, coalesce(k.espn_id, f.espn_id) AS espn_id, team FROM k LEFT JOIN f USING (gsis_id)", k=KNOWN, f=FEED_IDS)
def v20_enrich_ids(spark, d):
    return values.enrich_ids(derive(spark, d, KNOWN), derive(spark, d, FEED_IDS))[0]


@query("SELECT gsis_id, espn_id, team FROM f WHERE gsis_id NOT IN (SELECT gsis_id FROM k)", k=KNOWN, f=FEED_IDS)
def v20_unmatched(spark, d):
    return values.enrich_ids(derive(spark, d, KNOWN), derive(spark, d, FEED_IDS))[1]


@query("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RE%'")
def v21_search_name(spark, d):
    return values.search_name(table(spark, d, "part").select("p_partkey", "p_name"), "Re", "p_name")
