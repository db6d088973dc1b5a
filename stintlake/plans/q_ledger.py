"""Queries of intervals (L), ownership (O) and measures over holdings (M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stintlake.operators import asof, intervals, measures, overlay
from stintlake.plans import ledger
from stintlake.plans.registry import derive, query

PRESENT = "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS snapshot_date FROM {events} WHERE user_id % 3 <> 0 OR day(ts) % 5 <> 0"
MOVES = """SELECT user_id, event_id % 5 AS asset_id, ts, CAST(ts AS DATE) AS date,
  CASE WHEN event_type IN ('purchase', 'signup') THEN 'add' WHEN event_type IN ('error', 'view') THEN 'drop' ELSE 'other' END AS action FROM {events}"""
#: One price a day and asset, in whole cents.
PRICES = "SELECT event_type AS player_id, CAST(ts AS DATE) AS valuation_date, CAST(floor(max(value) * 100) AS BIGINT) AS value FROM {events} GROUP BY event_type, CAST(ts AS DATE)"
FRANCHISES = "SELECT DISTINCT CAST(user_id AS STRING) AS franchise_id, concat('L', CAST(user_id % 4 AS STRING)) AS league_lineage_id FROM {events}"
#: Players that a franchise holds on the days of its events, and picks (season:round:roster).
HOLD = """SELECT DISTINCT CAST(user_id AS STRING) AS franchise_id, event_type AS asset_id, 'player' AS asset_type, CAST(ts AS DATE) AS snapshot_date FROM {events} WHERE user_id % 3 <> 0 OR day(ts) % 5 <> 0
  UNION SELECT DISTINCT CAST(user_id AS STRING), concat(CAST(2024 + event_id % 3 AS STRING), ':', CAST(1 + event_id % 4 AS STRING), ':', CAST(user_id % 12 AS STRING)), 'pick', CAST(ts AS DATE) FROM {events}"""
#: Prices of rounds. The feed starts on day 9, and never prices the fourth round of 2026.
PICK_PRICES = """SELECT CAST(2024 + event_id % 3 AS STRING) AS season, CAST(1 + event_id % 4 AS BIGINT) AS round, CAST(ts AS DATE) AS valuation_date, CAST(floor(max(value) * 30) AS BIGINT) AS value FROM {events}
  WHERE day(ts) >= 9 AND NOT (event_id % 3 = 2 AND event_id % 4 = 3) GROUP BY CAST(2024 + event_id % 3 AS STRING), CAST(1 + event_id % 4 AS BIGINT), CAST(ts AS DATE)"""

_ISLANDS = """d AS (SELECT snapshot_date, row_number() OVER (ORDER BY snapshot_date) AS i, lead(snapshot_date) OVER (ORDER BY snapshot_date) AS nx FROM (SELECT DISTINCT snapshot_date FROM present)),
p AS (SELECT k.*, d.i, d.nx, d.i - row_number() OVER (PARTITION BY user_id, event_type ORDER BY k.snapshot_date) AS isl FROM present k JOIN d USING (snapshot_date)),
stints AS (SELECT user_id, event_type, min(snapshot_date) AS valid_from, arg_max(coalesce(nx, DATE '9999-01-01'), i) AS vt FROM p GROUP BY user_id, event_type, isl),
led AS (SELECT user_id, event_type, valid_from, nullif(vt, DATE '9999-01-01') AS valid_to, vt = DATE '9999-01-01' AS is_current FROM stints)"""
_STINTS = """r AS (SELECT *, action = 'add' AS a, coalesce(lag(action = 'add') OVER (PARTITION BY user_id, asset_id ORDER BY ts, action = 'add', date), false) AS b FROM moves WHERE action IN ('add', 'drop')),
t AS (SELECT *, lead(date) OVER (PARTITION BY user_id, asset_id ORDER BY ts, a, date) AS valid_to FROM r WHERE a <> b),
ev AS (SELECT user_id, asset_id, date AS valid_from, valid_to, valid_to IS NULL AS is_current FROM t WHERE a)"""


def _islands(p: str, source: str, key: str, where: str = "true") -> str:
    """Common tables that end in {p}s: snapshot stints of `source` by `key`, over the days there are."""
    return f"""{p}k AS (SELECT * FROM {source} WHERE {where}),
{p}d AS (SELECT snapshot_date, row_number() OVER (ORDER BY snapshot_date) AS i, lead(snapshot_date) OVER (ORDER BY snapshot_date) AS nx FROM (SELECT DISTINCT snapshot_date FROM {p}k)),
{p}p AS (SELECT k.*, i, nx, i - row_number() OVER (PARTITION BY {key} ORDER BY k.snapshot_date) AS isl FROM {p}k k JOIN {p}d USING (snapshot_date)),
{p}s AS (SELECT {key}, min(snapshot_date) AS valid_from, nullif(arg_max(coalesce(nx, DATE '9999-01-01'), i), DATE '9999-01-01') AS valid_to FROM {p}p GROUP BY {key}, isl)"""


def _stints(p: str, source: str, key: str) -> str:
    """Common tables that end in {p}s: stints of the add and drop events of `source` by `key`."""
    return f"""{p}r AS (SELECT *, action = 'add' AS a, coalesce(lag(action = 'add') OVER (PARTITION BY {key} ORDER BY ts, action = 'add', date), false) AS b FROM {source} WHERE action IN ('add', 'drop')),
{p}t AS (SELECT *, lead(date) OVER (PARTITION BY {key} ORDER BY ts, a, date) AS valid_to FROM {p}r WHERE a <> b),
{p}s AS (SELECT {key}, date AS valid_from, valid_to FROM {p}t WHERE a)"""


def _present(spark, d):
    return derive(spark, d, PRESENT)


def _ledger(spark, d):
    return intervals.build_snapshot_intervals(_present(spark, d), ["user_id", "event_type"])


@query(f"WITH {_ISLANDS} SELECT * FROM led", present=PRESENT)
def l1_snapshot_intervals(spark, d):
    return _ledger(spark, d)


@query(f"WITH {_STINTS} SELECT * FROM ev", moves=MOVES)
def l2_event_intervals(spark, d):
    return intervals.build_event_intervals(derive(spark, d, MOVES), ["user_id", "asset_id"])


KEYED = "SELECT DISTINCT user_id, event_id % 5 AS asset_id, CAST(ts AS DATE) AS snapshot_date FROM {events}"


@query(
    f"""WITH {_STINTS}, pr AS (SELECT * FROM keyed WHERE snapshot_date >= DATE '2024-01-16'),
d AS (SELECT snapshot_date, row_number() OVER (ORDER BY snapshot_date) AS i, lead(snapshot_date) OVER (ORDER BY snapshot_date) AS nx FROM (SELECT DISTINCT snapshot_date FROM pr)),
p AS (SELECT k.*, d.i, d.nx, d.i - row_number() OVER (PARTITION BY user_id, asset_id ORDER BY k.snapshot_date) AS isl FROM pr k JOIN d USING (snapshot_date)),
s AS (SELECT user_id, asset_id, min(snapshot_date) AS valid_from, arg_max(coalesce(nx, DATE '9999-01-01'), i) AS vt FROM p GROUP BY user_id, asset_id, isl)
SELECT user_id, asset_id, valid_from, nullif(vt, DATE '9999-01-01') AS valid_to, vt = DATE '9999-01-01' AS is_current FROM s
UNION ALL SELECT user_id, asset_id, valid_from, least(coalesce(valid_to, DATE '2024-01-16'), DATE '2024-01-16'), false FROM ev
WHERE valid_from < DATE '2024-01-16' AND valid_from < least(coalesce(valid_to, DATE '2024-01-16'), DATE '2024-01-16')""",
    moves=MOVES, keyed=KEYED,
)
def l3_combine_eras(spark, d):
    return intervals.combine_eras(derive(spark, d, KEYED), derive(spark, d, MOVES), "2024-01-16", ["user_id", "asset_id"])


@query(f"WITH {_STINTS} SELECT user_id, asset_id, valid_from, least(coalesce(valid_to, DATE '2024-01-16'), DATE '2024-01-16') AS valid_to, false AS is_current FROM ev WHERE valid_from < least(coalesce(valid_to, DATE '2024-01-16'), DATE '2024-01-16')", moves=MOVES)
def l4_clip_at(spark, d):
    return intervals.clip_at(l2_event_intervals(spark, d), "2024-01-16")


@query(f"WITH {_ISLANDS} SELECT * FROM led WHERE valid_from <= DATE '2024-01-12' AND (valid_to IS NULL OR valid_to > DATE '2024-01-12')", present=PRESENT)
def l13_held_on(spark, d):
    return intervals.held_on(_ledger(spark, d), "2024-01-12")


_WEEKS = "SELECT DISTINCT CAST(x AS DATE) AS date FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 7 DAY)) AS x UNION ALL SELECT DATE '2024-01-30')"


@query(f"WITH {_ISLANDS}, g AS ({_WEEKS}) SELECT led.*, g.date FROM led JOIN g ON valid_from <= g.date AND (valid_to IS NULL OR valid_to > g.date)", present=PRESENT)
def l14_holdings_by_date(spark, d):
    return intervals.holdings_by_date(_ledger(spark, d), intervals.weekly_dates(spark, "2024-01-01", "2024-01-30"))


@query(f"WITH {_ISLANDS}, g AS (SELECT CAST(unnest(generate_series(DATE '2024-01-02', DATE '2024-01-30', INTERVAL 4 DAY)) AS DATE) AS date) SELECT led.*, g.date FROM led JOIN g ON valid_from <= g.date AND (valid_to IS NULL OR valid_to > g.date)", present=PRESENT)
def l14_holdings_regular_grid(spark, d):
    return intervals.holdings_on_grid(_ledger(spark, d), "2024-01-02", "2024-01-30", 4)


SPAN = "SELECT CAST(min(ts) AS DATE) AS a, CAST(max(ts) AS DATE) AS b FROM {events}"


@query("WITH x AS (SELECT a, b, CAST(unnest(generate_series(a, b, INTERVAL 7 DAY)) AS DATE) AS dt FROM s) SELECT date, count(*) AS n_events FROM (SELECT dt AS date FROM x UNION SELECT b FROM s) g JOIN events e ON CAST(e.ts AS DATE) = g.date GROUP BY date", s=SPAN)
def l15_weekly_dates(spark, d):
    a, b = derive(spark, d, SPAN).first()
    days = derive(spark, d, "SELECT CAST(ts AS DATE) AS date FROM {events}")
    return intervals.weekly_dates(spark, str(a), str(b)).join(days, "date").groupBy("date").agg(F.count("*").alias("n_events"))


COUNTS = "SELECT concat('L', CAST(user_id % 4 AS STRING)) AS league, CAST(ts AS DATE) AS date, count(DISTINCT user_id) AS n FROM {events} GROUP BY concat('L', CAST(user_id % 4 AS STRING)), CAST(ts AS DATE)"


@query("WITH m AS (SELECT league, median(n) AS md FROM c GROUP BY league), s AS (SELECT league, min(date) AS st FROM c JOIN m USING (league) WHERE n >= 0.95 * md GROUP BY league) SELECT league, date, n FROM c JOIN s USING (league) WHERE date >= st", c=COUNTS)
def l17_trim_ramp(spark, d):
    return intervals.trim_ramp(derive(spark, d, COUNTS), ["league"])


# --- rollovers: a lineage's snapshots pause, events go on ----------------------------------------------

SNAPS = """SELECT DISTINCT concat('L', CAST(user_id % 4 AS STRING)) AS league_lineage_id, concat('L', CAST(user_id % 4 AS STRING), '_', CAST(user_id AS STRING)) AS franchise_id,
  event_type AS player_id, CAST(ts AS DATE) AS snapshot_date FROM {events} WHERE user_id % 4 = 3 OR day(ts) < 12 + user_id % 4 OR day(ts) >= 18 + user_id % 4"""
SNAP_MOVES = """SELECT concat('L', CAST(user_id % 4 AS STRING)) AS league_lineage_id, concat('L', CAST(user_id % 4 AS STRING), '_', CAST(user_id AS STRING)) AS franchise_id, event_type AS player_id,
  event_id AS ts, CAST(ts AS DATE) AS date, CASE WHEN event_id % 3 = 0 THEN 'drop' ELSE 'add' END AS action FROM {events} WHERE day(ts) >= 14"""
_WINDOWS = """dd AS (SELECT league_lineage_id, snapshot_date AS d, lead(snapshot_date) OVER (PARTITION BY league_lineage_id ORDER BY snapshot_date) AS nx FROM (SELECT DISTINCT league_lineage_id, snapshot_date FROM snaps)),
gg AS (SELECT *, row_number() OVER (PARTITION BY league_lineage_id ORDER BY nx - d DESC, d) AS rn FROM dd WHERE nx IS NOT NULL),
ff AS (SELECT league_lineage_id, min(date) AS f FROM mv GROUP BY league_lineage_id),
w0 AS (SELECT g.league_lineage_id, coalesce(f, CAST(d + 1 AS DATE)) AS window_start, nx AS window_end FROM gg g LEFT JOIN ff USING (league_lineage_id) WHERE rn = 1 AND nx - d >= 3),
w AS (SELECT w0.league_lineage_id, max(dd.d) AS carry_date, window_start, window_end FROM w0 JOIN dd ON dd.league_lineage_id = w0.league_lineage_id AND dd.d < window_start WHERE window_start < window_end GROUP BY w0.league_lineage_id, window_start, window_end)"""


@query(f"WITH {_WINDOWS} SELECT league_lineage_id, carry_date, window_start, window_end FROM w", snaps=SNAPS, mv=SNAP_MOVES)
def l10_rollover_windows(spark, d):
    return ledger.rollover_windows(derive(spark, d, SNAPS), derive(spark, d, SNAP_MOVES))


_REPLAY = """e AS (SELECT league_lineage_id, franchise_id, player_id, -1 AS ts, window_start AS date, 'add' AS action FROM snaps JOIN w USING (league_lineage_id) WHERE snapshot_date = carry_date
  UNION ALL SELECT m.league_lineage_id, franchise_id, player_id, ts, date, action FROM mv m JOIN w USING (league_lineage_id) WHERE date < window_end),
days AS (SELECT league_lineage_id, CAST(unnest(generate_series(window_start, window_end - 1, INTERVAL 1 DAY)) AS DATE) AS snapshot_date FROM w),
last AS (SELECT e.league_lineage_id, franchise_id, player_id, snapshot_date, arg_max(action, ts * 2 + CASE WHEN action = 'add' THEN 1 ELSE 0 END) AS act FROM e JOIN days ON days.league_lineage_id = e.league_lineage_id AND e.date <= snapshot_date GROUP BY ALL),
held AS (SELECT league_lineage_id, franchise_id, player_id, snapshot_date FROM last WHERE act = 'add')"""


@query(f"WITH {_WINDOWS}, {_REPLAY} SELECT DISTINCT * FROM (SELECT s.* FROM snaps s LEFT JOIN w USING (league_lineage_id) WHERE window_start IS NULL OR snapshot_date < window_start OR snapshot_date >= window_end UNION ALL SELECT * FROM held)", snaps=SNAPS, mv=SNAP_MOVES)
def l11_rollover_presence(spark, d):
    return ledger.reconstruct_rollover_presence(derive(spark, d, SNAPS), derive(spark, d, SNAP_MOVES))[0]


SNAP_STINTS = """SELECT concat('L', CAST(user_id % 4 AS STRING)) AS league_lineage_id, concat('L', CAST(user_id % 4 AS STRING), '_', CAST(user_id AS STRING)) AS franchise_id, event_type AS player_id,
  min(CAST(ts AS DATE)) AS valid_from, CASE WHEN user_id % 2 = 0 THEN max(CAST(ts AS DATE)) END AS valid_to FROM {events} GROUP BY user_id, event_type"""


@query(
    f"""WITH {_WINDOWS} SELECT DISTINCT * FROM (SELECT s.* FROM snaps s LEFT JOIN w USING (league_lineage_id) WHERE window_start IS NULL OR snapshot_date < window_start OR snapshot_date >= window_end
UNION ALL SELECT i.league_lineage_id, franchise_id, player_id, CAST(g.x AS DATE) AS snapshot_date FROM st i JOIN w USING (league_lineage_id), generate_series(window_start, window_end - 1, INTERVAL 1 DAY) AS g(x) WHERE valid_from <= g.x AND (valid_to IS NULL OR valid_to > g.x))""",
    snaps=SNAPS, mv=SNAP_MOVES, st=SNAP_STINTS,
)
def l12_rollover_pick_presence(spark, d):
    present, moves = derive(spark, d, SNAPS), derive(spark, d, SNAP_MOVES)
    return ledger.reconstruct_rollover_pick_presence(present, derive(spark, d, SNAP_STINTS), ledger.rollover_windows(present, moves))


# --- ownership over a league built from suppliers and parts --------------------------------------------

LEAGUES = """SELECT concat('N', CAST(n_nationkey AS STRING), '_', CAST(y AS STRING)) AS league_id, concat('N', CAST(n_nationkey AS STRING)) AS league_lineage_id, CAST(y AS STRING) AS season,
  CASE WHEN y < 2024 THEN 'complete' ELSE 'in_season' END AS status, 6 + n_nationkey % 3 AS total_rosters FROM {nation}, (SELECT 2022 AS y UNION ALL SELECT 2023 UNION ALL SELECT 2024) AS ys"""
DRAFTS = """SELECT concat('D', CAST(n_nationkey AS STRING), '_', CAST(y AS STRING)) AS draft_id, concat('N', CAST(n_nationkey AS STRING), '_', CAST(y AS STRING)) AS league_id, CAST(y AS STRING) AS season,
  CASE WHEN y < 2024 OR n_nationkey % 2 = 0 THEN 'complete' ELSE 'pre_draft' END AS status, CAST(CASE WHEN y = 2022 THEN 15 ELSE 3 + n_nationkey % 2 END AS BIGINT) AS rounds,
  CAST(1651363200000 + (y - 2022) * CAST(31536000000 AS BIGINT) + n_nationkey * CAST(86400000 AS BIGINT) AS BIGINT) AS start_time,
  CASE WHEN n_nationkey % 5 <> 0 THEN CAST(1651366800000 + (y - 2022) * CAST(31536000000 AS BIGINT) + n_nationkey * CAST(86400000 AS BIGINT) AS BIGINT) END AS last_picked
  FROM {nation}, (SELECT 2022 AS y UNION ALL SELECT 2023 UNION ALL SELECT 2024) AS ys"""
TRADED = """SELECT concat('N', CAST(c_nationkey AS STRING), '_', CAST(2023 + o_orderkey % 2 AS STRING)) AS league_id, CAST(2024 + o_orderkey % 4 AS STRING) AS season, 1 + o_orderkey % 3 AS round, 1 + o_orderkey % 6 AS original_roster_id,
  1 + o_custkey % 6 AS owner_roster_id, CAST(o_orderkey AS BIGINT) AS ord, o_orderdate AS timestamp FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""
TXN_PICKS = """SELECT concat('T', CAST(l_orderkey AS STRING)) AS transaction_id, concat('N', CAST(l_suppkey % 25 AS STRING), '_2024') AS league_id, CAST(2025 + l_partkey % 3 AS STRING) AS season, 1 + l_partkey % 3 AS round, 1 + l_partkey % 6 AS roster_id,
  1 + l_suppkey % 6 AS owner_id, 1 + l_partkey % 5 AS previous_owner_id, CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS ts FROM {lineitem}"""
OVERRIDES = """SELECT concat('N', CAST(s_nationkey AS STRING), '_2023') AS league_id, CAST(2025 + s_suppkey % 2 AS STRING) AS season, 1 + s_suppkey % 3 AS round, 1 + s_suppkey % 6 AS roster_id, 1 + (s_suppkey + 2) % 6 AS from_team_id,
  1 + (s_suppkey + 3) % 6 AS to_team_id, CAST(1700000000000 + s_suppkey * 1000 AS BIGINT) AS created FROM {supplier}"""
_LINEAGE = """lt AS (SELECT league_lineage_id, max(CAST(season AS INT)) AS ms, max(CASE WHEN status = 'complete' THEN CAST(season AS INT) END) AS latest_completed_season FROM leagues GROUP BY league_lineage_id),
lm AS (SELECT l.league_id, l.league_lineage_id, c.league_id AS current_league_id, c.total_rosters, latest_completed_season FROM leagues l JOIN lt USING (league_lineage_id) JOIN leagues c ON c.league_lineage_id = l.league_lineage_id AND CAST(c.season AS INT) = lt.ms)"""
_CUTOFFS = """dc AS (SELECT current_league_id AS league_id, CAST(season AS INT) AS season, rounds FROM drafts JOIN lm USING (league_id) WHERE drafts.status = 'complete'),
cut AS (SELECT league_id, max(season) AS cutoff_season FROM dc GROUP BY league_id),
rr AS (SELECT league_id, min(rounds) AS rookie_rounds FROM dc JOIN cut USING (league_id) WHERE season = cutoff_season GROUP BY league_id)"""


def _lineage_map(spark, d):
    from stintlake.operators.graph import build_lineage_map

    return build_lineage_map(derive(spark, d, LEAGUES))


@query(f"WITH {_LINEAGE} SELECT * FROM lm", leagues=LEAGUES)
def g5_build_lineage_map(spark, d):
    return _lineage_map(spark, d)


STANDINGS = """SELECT concat('N', CAST(s_nationkey AS STRING), '_2024') AS league_id, s_suppkey AS roster_id, CAST(floor(s_acctbal / 1000) AS BIGINT) AS wins, CAST(floor(s_acctbal) AS BIGINT) AS fpts FROM {supplier}"""


@query(
    """WITH r AS (SELECT s.league_id, roster_id, CAST(season AS INT) + 1 AS draft_season, row_number() OVER (PARTITION BY s.league_id ORDER BY wins, fpts, roster_id) AS slot, total_rosters FROM st s JOIN leagues USING (league_id))
SELECT league_id, roster_id, draft_season, slot, CASE WHEN (slot - 1) * 3 // total_rosters = 0 THEN 'Early' WHEN (slot - 1) * 3 // total_rosters = 1 THEN 'Mid' ELSE 'Late' END AS tier FROM r""",
    leagues=LEAGUES, st=STANDINGS,
)
def m1_draft_slots(spark, d):
    return measures.compute_draft_slots(derive(spark, d, STANDINGS), derive(spark, d, LEAGUES))


@query("SELECT *, league_lineage_id || '_' || CAST(roster_id AS VARCHAR) AS franchise_id FROM (SELECT s.*, league_lineage_id FROM st s JOIN (SELECT DISTINCT league_id, league_lineage_id FROM leagues) USING (league_id))", leagues=LEAGUES, st=STANDINGS)
def g6_lineage_franchise(spark, d):
    from stintlake.operators.graph import lineage_franchise

    return lineage_franchise(derive(spark, d, STANDINGS), _lineage_map(spark, d))


@query(f"WITH {_LINEAGE} SELECT current_league_id AS league_id, t.season, round, original_roster_id, owner_roster_id, ord, timestamp FROM tr t JOIN lm USING (league_id)", leagues=LEAGUES, tr=TRADED)
def g7_relabel_current(spark, d):
    from stintlake.operators.graph import relabel_current

    return relabel_current(derive(spark, d, TRADED), _lineage_map(spark, d))


@query("SELECT arg_max(league_id, CAST(season AS INT)) AS league_id, league_lineage_id, max(CAST(season AS INT)) AS season FROM leagues GROUP BY league_lineage_id", leagues=LEAGUES)
def g8_current_per_lineage(spark, d):
    from stintlake.operators.graph import current_per_lineage

    return current_per_lineage(derive(spark, d, LEAGUES))


ROSTERS = """SELECT concat('N', CAST(c_nationkey AS STRING), '_2024') AS league_id, 1 + o_custkey % 9 AS roster_id, CAST(o_orderkey % 400 AS STRING) AS player_id, CAST(o_custkey AS STRING) AS owner_id, o_orderpriority = '1-URGENT' AS is_starter, o_orderstatus = 'P' AS is_taxi
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""
FRANCHISE_DIM = "SELECT DISTINCT concat('N', CAST(n_nationkey AS STRING), '_2024') AS league_id, r AS roster_id, concat('N', CAST(n_nationkey AS STRING), '_', CAST(r AS STRING)) AS franchise_id FROM {nation}, (SELECT CAST(p_partkey AS BIGINT) AS r FROM {part} WHERE p_partkey BETWEEN 1 AND 8) AS rs"
PLAYER_DIM = "SELECT CAST(p_partkey AS STRING) AS player_key, p_brand AS position FROM {part} WHERE p_partkey % 10 <> 3"


@query(
    """SELECT r.league_id, r.roster_id, franchise_id, 'PLAYER' AS asset_type, player_id AS asset_id, player_key, position, is_starter, is_taxi, CAST(NULL AS BOOLEAN) AS is_reserve, CAST(NULL AS BOOLEAN) AS is_active,
CAST(NULL AS VARCHAR) AS season, CAST(NULL AS BIGINT) AS round, CAST(NULL AS BIGINT) AS original_roster_id FROM r LEFT JOIN f USING (league_id, roster_id) LEFT JOIN pl ON player_key = player_id""",
    r=ROSTERS, f=FRANCHISE_DIM, pl=PLAYER_DIM,
)
def o1_player_membership(spark, d):
    return ledger.build_player_membership(derive(spark, d, ROSTERS), derive(spark, d, FRANCHISE_DIM), derive(spark, d, PLAYER_DIM))


@query("SELECT league_id, season, CAST(round AS BIGINT) AS round, roster_id, from_team_id, to_team_id, created, CAST(roster_id AS BIGINT) AS original_roster_id FROM ov", ov=OVERRIDES)
def o2_norm_pick_keys(spark, d):
    return ledger.norm_pick_keys(derive(spark, d, OVERRIDES), "roster_id")


@query(f"WITH {_LINEAGE}, {_CUTOFFS} SELECT * FROM cut", leagues=LEAGUES, drafts=DRAFTS)
def o3_drafted_cutoffs(spark, d):
    return ledger.drafted_cutoffs(derive(spark, d, DRAFTS), _lineage_map(spark, d))


@query(f"WITH {_LINEAGE}, {_CUTOFFS} SELECT * FROM rr", leagues=LEAGUES, drafts=DRAFTS)
def o4_rookie_rounds(spark, d):
    return ledger.rookie_rounds(derive(spark, d, DRAFTS), _lineage_map(spark, d))


@query("SELECT * FROM drafts WHERE start_time IS NULL OR CAST(make_timestamp(start_time * 1000) AS DATE) <= DATE '2023-05-10'", drafts=DRAFTS)
def o5_drafts_completed_by(spark, d):
    return ledger.drafts_completed_by(derive(spark, d, DRAFTS), "2023-05-10")


META = "SELECT concat('N', CAST(n_nationkey AS STRING), '_2024') AS league_id, 6 + n_nationkey % 3 AS total_rosters, 2023 + n_nationkey % 2 AS cutoff_season, CASE WHEN n_nationkey = 7 THEN 0 ELSE 3 END AS rookie_rounds FROM {nation}"
_UNIVERSE = """g AS (SELECT league_id, cutoff_season + s AS season, rd AS round, total_rosters, cutoff_season FROM meta, generate_series(1, 3) AS a(s), generate_series(1, rookie_rounds) AS b(rd)),
o AS (SELECT DISTINCT league_id, CAST(season AS INT) AS season, round, total_rosters, cutoff_season FROM obs JOIN meta USING (league_id)),
u AS (SELECT DISTINCT league_id, CAST(season AS VARCHAR) AS season, CAST(round AS BIGINT) AS round, CAST(r AS BIGINT) AS original_roster_id FROM (SELECT * FROM g UNION SELECT * FROM o), generate_series(1, total_rosters) AS c(r) WHERE season > cutoff_season)"""


@query(f"WITH {_UNIVERSE} SELECT * FROM u", meta=META, obs=TRADED)
def o6_pick_universe(spark, d):
    return ledger.build_pick_universe(derive(spark, d, TRADED), derive(spark, d, META))


_RESOLVED = f"""{_LINEAGE}, {_CUTOFFS},
tr AS (SELECT current_league_id AS league_id, t.season, CAST(round AS BIGINT) AS round, CAST(original_roster_id AS BIGINT) AS original_roster_id, owner_roster_id AS own, epoch_us(timestamp) AS ts, 3 AS pri, 'traded' AS nm FROM traded t JOIN lm USING (league_id)),
ev AS (SELECT current_league_id AS league_id, t.season, CAST(round AS BIGINT) AS round, CAST(roster_id AS BIGINT) AS original_roster_id, owner_id AS own, ts, 2 AS pri, 'event' AS nm FROM txn t JOIN lm USING (league_id)),
ov AS (SELECT current_league_id AS league_id, t.season, CAST(round AS BIGINT) AS round, CAST(roster_id AS BIGINT) AS original_roster_id, to_team_id AS own, created AS ts, 1 AS pri, 'override' AS nm FROM overrides t JOIN lm USING (league_id)),
src AS (SELECT * FROM tr UNION ALL SELECT * FROM ev UNION ALL SELECT * FROM ov),
meta AS (SELECT DISTINCT current_league_id AS league_id, total_rosters, coalesce(cutoff_season, lm.latest_completed_season, lt.ms - 1) AS cutoff_season, coalesce(rookie_rounds, 3) AS rookie_rounds FROM lm JOIN lt USING (league_lineage_id) LEFT JOIN cut ON cut.league_id = current_league_id LEFT JOIN rr ON rr.league_id = current_league_id),
obs AS (SELECT league_id, season, round FROM src), {_UNIVERSE.replace("lm.latest_completed_season", "latest_completed_season")},
best AS (SELECT *, row_number() OVER (PARTITION BY league_id, season, round, original_roster_id ORDER BY pri, ts DESC, own) AS rn FROM src),
res AS (SELECT u.*, coalesce(own, u.original_roster_id) AS owner_roster_id, coalesce(nm, 'base') AS owner_source FROM u LEFT JOIN (SELECT * FROM best WHERE rn = 1) USING (league_id, season, round, original_roster_id))"""


def _resolved(spark, d):
    return ledger.resolve_pick_ownership(derive(spark, d, TRADED), derive(spark, d, TXN_PICKS), derive(spark, d, OVERRIDES), derive(spark, d, LEAGUES), derive(spark, d, DRAFTS))


@query(f"WITH {_RESOLVED} SELECT * FROM res", leagues=LEAGUES, drafts=DRAFTS, traded=TRADED, txn=TXN_PICKS, overrides=OVERRIDES)
def o7_pick_ownership(spark, d):
    return _resolved(spark, d)


BASE = "SELECT p_partkey AS k, CAST(p_size AS BIGINT) AS owner FROM {part}"
STRONG = "SELECT l_partkey AS k, l_orderkey AS ts, CAST(l_suppkey AS BIGINT) AS own FROM {lineitem} WHERE l_returnflag = 'R' AND l_shipdate >= '1997-01-01'"
WEAK = "SELECT l_partkey AS k, l_orderkey AS ts, CAST(l_linenumber AS BIGINT) AS own FROM {lineitem} WHERE l_returnflag = 'N'"


@query(
    """WITH s AS (SELECT *, 1 AS pri, 'returns' AS nm FROM a UNION ALL SELECT *, 2, 'open' FROM w), b AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY pri, ts DESC, own) AS rn FROM s)
SELECT base.k, coalesce(own, owner) AS owner, coalesce(nm, 'base') AS owner_source FROM base LEFT JOIN (SELECT * FROM b WHERE rn = 1) x USING (k)""",
    base=BASE, a=STRONG, w=WEAK,
)
def o8_overlay(spark, d):
    return overlay.overlay(derive(spark, d, BASE), [(derive(spark, d, STRONG), "ts", "own"), (derive(spark, d, WEAK), "ts", "own")], ["k"], names=["returns", "open"])


_PICK_MEMBERS = """pm AS (SELECT res.league_id, owner_roster_id AS roster_id, franchise_id, 'PICK' AS asset_type, season || ':' || CAST(round AS VARCHAR) || ':' || CAST(original_roster_id AS VARCHAR) AS asset_id, season, round, original_roster_id
  FROM res LEFT JOIN f ON f.league_id = res.league_id AND f.roster_id = owner_roster_id)"""


@query(f"WITH {_RESOLVED}, {_PICK_MEMBERS} SELECT * FROM pm", leagues=LEAGUES, drafts=DRAFTS, traded=TRADED, txn=TXN_PICKS, overrides=OVERRIDES, f=FRANCHISE_DIM)
def o9_pick_membership(spark, d):
    return ledger.build_pick_membership(_resolved(spark, d), derive(spark, d, FRANCHISE_DIM))


MEMBERS = """SELECT DISTINCT concat('N', CAST(c_nationkey AS STRING), '_2024') AS league_id, CASE WHEN o_orderkey % 29 = 0 THEN CAST(NULL AS STRING) ELSE concat('F', CAST(o_custkey % 9 AS STRING)) END AS franchise_id, 'PLAYER' AS asset_type,
  CAST(o_orderkey % 3000 AS STRING) AS asset_id, CASE WHEN o_orderkey % 17 = 0 THEN CAST(NULL AS STRING) ELSE CAST(o_orderkey % 3000 AS STRING) END AS player_key FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""
PICKS = "SELECT DISTINCT concat('N', CAST(s_nationkey AS STRING), '_2024') AS league_id, concat('F', CAST(s_suppkey % 7 AS STRING)) AS franchise_id, 'PICK' AS asset_type, concat('2025:1:', CAST(s_suppkey AS STRING)) AS asset_id FROM {supplier}"
_DUP = """b AS (SELECT league_id, franchise_id, asset_type, asset_id, player_key FROM members UNION ALL SELECT league_id, franchise_id, asset_type, asset_id, NULL FROM picks),
dup AS (SELECT league_id, asset_type, asset_id, count(DISTINCT franchise_id) + max(CASE WHEN franchise_id IS NULL THEN 1 ELSE 0 END) AS n_owners FROM b GROUP BY ALL HAVING n_owners > 1),
bad AS (SELECT league_id, asset_type, asset_id FROM dup UNION SELECT league_id, asset_type, asset_id FROM b WHERE franchise_id IS NULL),
fact AS (SELECT * FROM b WHERE (league_id, asset_type, asset_id) NOT IN (SELECT league_id, asset_type, asset_id FROM bad)),
quar AS (SELECT b.*, 'duplicate_ownership' AS reason FROM b JOIN dup USING (league_id, asset_type, asset_id) UNION ALL SELECT *, 'unresolved_franchise' FROM b WHERE franchise_id IS NULL UNION ALL SELECT *, 'unmapped_player' FROM b WHERE asset_type = 'PLAYER' AND player_key IS NULL)"""
_CURRENT = "SELECT * FROM (" + LEAGUES + ") AS x WHERE season = '2024'"


def _reconciled(spark, d):
    return overlay.reconcile(derive(spark, d, MEMBERS), derive(spark, d, PICKS), derive(spark, d, _CURRENT))


@query(f"WITH {_DUP} SELECT * FROM dup", members=MEMBERS, picks=PICKS)
def o10_duplicate_owners(spark, d):
    both = derive(spark, d, MEMBERS).unionByName(derive(spark, d, PICKS), allowMissingColumns=True)
    return overlay.duplicate_owners(both, ["league_id", "asset_type", "asset_id"], "franchise_id").withColumn("n_owners", F.col("n_owners").cast("long"))


@query(f"WITH {_DUP} SELECT * FROM fact", members=MEMBERS, picks=PICKS)
def o11_reconcile_fact(spark, d):
    return _reconciled(spark, d)[0]


@query(f"WITH {_DUP} SELECT * FROM quar", members=MEMBERS, picks=PICKS)
def o12_reconcile_quarantine(spark, d):
    return _reconciled(spark, d)[1]


@query(f"WITH {_RESOLVED} SELECT league_id, season, round, count(*) AS n_picks, CAST(any_value(meta.total_rosters) AS BIGINT) AS n_expected, count(*) = any_value(meta.total_rosters) AS ok FROM res JOIN meta USING (league_id) GROUP BY league_id, season, round", leagues=LEAGUES, drafts=DRAFTS, traded=TRADED, txn=TXN_PICKS, overrides=OVERRIDES)
def o13_conservation(spark, d):
    current = _lineage_map(spark, d).select(F.col("current_league_id").alias("league_id"), "total_rosters").distinct()
    return overlay.conservation(_resolved(spark, d), current, ["season", "round"], "league_id", "total_rosters")


DAILY = """SELECT DISTINCT CAST(ts AS DATE) AS snapshot_date, concat('N', CAST(user_id % 25 AS STRING), '_2024') AS league_id, CAST(2025 + event_id % 2 AS STRING) AS season, 1 + event_id % 2 AS round, 1 + event_id % 6 AS original_roster_id, 1 + user_id % 6 AS owner_roster_id
  FROM {events}"""


_PICK_PRESENCE = """st AS (SELECT DISTINCT snapshot_date, current_league_id AS league_id, t.season, CAST(round AS BIGINT) AS round, CAST(original_roster_id AS BIGINT) AS original_roster_id, CAST(owner_roster_id AS BIGINT) AS own FROM daily t JOIN lm USING (league_id)),
dy AS (SELECT DISTINCT snapshot_date, league_id FROM st),
dn AS (SELECT current_league_id AS league_id, CAST(season AS INT) AS season, rounds, CAST(make_timestamp(start_time * 1000) AS DATE) AS sd FROM drafts JOIN lm USING (league_id) WHERE drafts.status = 'complete'),
cu AS (SELECT snapshot_date, dy.league_id, max(dn.season) AS cs, arg_max(rounds, dn.season) AS rr FROM dy LEFT JOIN dn ON dn.league_id = dy.league_id AND (sd IS NULL OR sd <= snapshot_date) GROUP BY snapshot_date, dy.league_id),
me AS (SELECT DISTINCT snapshot_date, cu.league_id, total_rosters, coalesce(cs, latest_completed_season) AS cutoff, coalesce(rr, 3) AS rr, league_lineage_id FROM cu JOIN lm ON lm.current_league_id = cu.league_id),
uu AS (SELECT DISTINCT snapshot_date, league_id, league_lineage_id, season, round, r FROM (SELECT me.*, cutoff + s AS season, rd AS round FROM me, generate_series(1, 3) AS a(s), generate_series(1, rr) AS b(rd) UNION SELECT me.*, CAST(st.season AS INT), st.round FROM me JOIN st USING (snapshot_date, league_id)), generate_series(1, total_rosters) AS c(r) WHERE season > cutoff),
ow AS (SELECT snapshot_date, league_id, season, round, original_roster_id, min(own) AS own FROM st GROUP BY ALL),
pp AS (SELECT uu.snapshot_date, league_lineage_id, league_lineage_id || '_' || CAST(coalesce(own, uu.r) AS VARCHAR) AS franchise_id, CAST(uu.season AS VARCHAR) || ':' || CAST(uu.round AS VARCHAR) || ':' || CAST(uu.r AS VARCHAR) AS pick_id
FROM uu LEFT JOIN ow ON ow.snapshot_date = uu.snapshot_date AND ow.league_id = uu.league_id AND ow.season = CAST(uu.season AS VARCHAR) AND ow.round = uu.round AND ow.original_roster_id = uu.r)"""


@query(f"WITH {_LINEAGE}, {_PICK_PRESENCE} SELECT * FROM pp", leagues=LEAGUES, drafts=DRAFTS, daily=DAILY)
def o14_pick_presence(spark, d):
    return ledger.pick_presence(derive(spark, d, DAILY), None, derive(spark, d, LEAGUES), derive(spark, d, DRAFTS))


# --- pick history --------------------------------------------------------------------------------------

ROUNDS = "SELECT concat('N', CAST(n_nationkey AS STRING)) AS league_lineage_id, 2 + n_nationkey % 3 AS rounds FROM {nation} WHERE n_nationkey <> 4"
TXNS = "SELECT concat('T', CAST(o_orderkey AS STRING)) AS transaction_id, CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'complete' END AS status, CAST(1690000000000 + o_orderkey * 100000 AS BIGINT) AS created FROM {orders}"
_TRADES = """tx AS (SELECT transaction_id, created FROM txns WHERE status = 'complete'),
it AS (SELECT *, row_number() OVER (PARTITION BY transaction_id, season, round, roster_id ORDER BY league_id, owner_id, previous_owner_id) AS rn FROM (SELECT transaction_id, league_id, season, round, roster_id, owner_id, previous_owner_id FROM txn)),
al AS (SELECT league_id, season, round, roster_id, owner_id AS nw, previous_owner_id AS pv, created AS ts FROM it JOIN tx USING (transaction_id) WHERE rn = 1 UNION ALL SELECT league_id, season, round, roster_id, to_team_id, from_team_id, created FROM overrides),
trades AS (SELECT league_lineage_id, al.season || ':' || CAST(round AS VARCHAR) || ':' || CAST(roster_id AS VARCHAR) AS pick_id, league_lineage_id || '_' || CAST(pv AS VARCHAR) AS prev_franchise, league_lineage_id || '_' || CAST(nw AS VARCHAR) AS new_franchise, ts, CAST(make_timestamp(ts * 1000) AS DATE) AS date FROM al JOIN (SELECT DISTINCT league_id, league_lineage_id FROM leagues) USING (league_id))"""
_LIFE = """cp AS (SELECT league_lineage_id, CAST(d.season AS INT) AS ds, max(coalesce(last_picked, start_time)) AS dts FROM drafts d JOIN (SELECT DISTINCT league_id, league_lineage_id FROM leagues) USING (league_id) GROUP BY ALL),
mt AS (SELECT league_lineage_id, min(CAST(season AS INT)) AS su, max(total_rosters) AS n FROM leagues GROUP BY league_lineage_id),
ld AS (SELECT league_lineage_id, max(ds) AS la FROM cp GROUP BY league_lineage_id),
pk AS (SELECT mt.league_lineage_id, s, rd, ro, greatest(s - 3, su) AS ms FROM mt JOIN ld USING (league_lineage_id) LEFT JOIN rounds USING (league_lineage_id), generate_series(su + 1, la + 3) AS a(s), generate_series(1, coalesce(rounds, 3)) AS b(rd), generate_series(1, n) AS c(ro)),
life AS (SELECT pk.league_lineage_id, pk.league_lineage_id || '_' || CAST(ro AS VARCHAR) AS franchise_id, CAST(s AS VARCHAR) || ':' || CAST(rd AS VARCHAR) || ':' || CAST(ro AS VARCHAR) AS pick_id, m.dts AS mint_ts, CAST(make_timestamp(m.dts * 1000) AS DATE) AS mint_date, CAST(make_timestamp(u.dts * 1000) AS DATE) AS consume_date
  FROM pk JOIN cp m ON m.league_lineage_id = pk.league_lineage_id AND m.ds = pk.ms LEFT JOIN cp u ON u.league_lineage_id = pk.league_lineage_id AND u.ds = pk.s)"""


def _trades(spark, d):
    return ledger.pick_trade_events(derive(spark, d, TXN_PICKS), None, derive(spark, d, OVERRIDES), derive(spark, d, TXNS), _lineage_map(spark, d))


def _life(spark, d):
    return ledger.synthesize_pick_lifecycle(derive(spark, d, DRAFTS), derive(spark, d, LEAGUES), _lineage_map(spark, d), derive(spark, d, ROUNDS))


@query(f"WITH {_LIFE} SELECT * FROM life", drafts=DRAFTS, leagues=LEAGUES, rounds=ROUNDS)
def l5_pick_lifecycle(spark, d):
    return _life(spark, d)


_PICK_STINTS = """pe AS (SELECT league_lineage_id, franchise_id, pick_id, mint_ts AS ts, mint_date AS date, true AS a FROM life UNION ALL SELECT league_lineage_id, prev_franchise, pick_id, ts, date, false FROM trades UNION ALL SELECT league_lineage_id, new_franchise, pick_id, ts, date, true FROM trades),
pr_ AS (SELECT *, coalesce(lag(a) OVER (PARTITION BY league_lineage_id, franchise_id, pick_id ORDER BY ts, a, date), false) AS b FROM pe),
pt AS (SELECT *, lead(date) OVER (PARTITION BY league_lineage_id, franchise_id, pick_id ORDER BY ts, a, date) AS vt FROM pr_ WHERE a <> b),
us AS (SELECT league_lineage_id, pick_id, max(consume_date) AS used FROM life GROUP BY ALL),
pi AS (SELECT league_lineage_id, franchise_id, pick_id, date AS valid_from, least(coalesce(vt, used), coalesce(used, vt)) AS valid_to FROM pt LEFT JOIN us USING (league_lineage_id, pick_id) WHERE a),
pints AS (SELECT *, valid_to IS NULL AS is_current FROM pi WHERE valid_to IS NULL OR valid_from < valid_to)"""


@query(f"WITH {_LIFE}, {_TRADES}, {_PICK_STINTS} SELECT * FROM pints", drafts=DRAFTS, leagues=LEAGUES, rounds=ROUNDS, txn=TXN_PICKS, txns=TXNS, overrides=OVERRIDES)
def l6_pick_intervals(spark, d):
    return ledger.reconstruct_pick_intervals(_life(spark, d), _trades(spark, d))


MOVE_ITEMS = "SELECT concat('T', CAST(l_orderkey AS STRING)) AS transaction_id, concat('N', CAST(l_suppkey % 25 AS STRING), '_2024') AS league_id, 1 + l_suppkey % 6 AS roster_id, CAST(l_partkey AS STRING) AS player_id, CASE WHEN l_linenumber % 2 = 0 THEN 'drop' ELSE 'add' END AS action FROM {lineitem}"
DRAFT_PICKS = "SELECT concat('D', CAST(s_nationkey AS STRING), '_2024') AS draft_id, 1 + s_suppkey % 6 AS roster_id, CAST(s_suppkey AS STRING) AS player_id FROM {supplier}"


_PLAYER_EVENTS = """pa_ AS (SELECT DISTINCT league_id, roster_id, player_id, created AS ts, action, transaction_id FROM items JOIN txns USING (transaction_id) WHERE status = 'complete'
UNION ALL SELECT DISTINCT league_id, roster_id, player_id, coalesce(last_picked, start_time), 'add', draft_id FROM dp JOIN drafts USING (draft_id)),
pev AS (SELECT league_lineage_id, league_lineage_id || '_' || CAST(roster_id AS VARCHAR) AS franchise_id, player_id, ts, CAST(make_timestamp(ts * 1000) AS DATE) AS date, action FROM pa_ JOIN (SELECT DISTINCT league_id, league_lineage_id FROM leagues) USING (league_id))"""


@query(f"WITH {_PLAYER_EVENTS} SELECT * FROM pev", items=MOVE_ITEMS, txns=TXNS, dp=DRAFT_PICKS, drafts=DRAFTS, leagues=LEAGUES)
def l7_player_events(spark, d):
    return ledger.player_events(derive(spark, d, TXNS), derive(spark, d, MOVE_ITEMS), derive(spark, d, DRAFTS), derive(spark, d, DRAFT_PICKS), _lineage_map(spark, d))


@query(f"WITH {_TRADES} SELECT * FROM trades", leagues=LEAGUES, txn=TXN_PICKS, txns=TXNS, overrides=OVERRIDES)
def l8_pick_trade_events(spark, d):
    return _trades(spark, d)


ROSTER_DAYS = "SELECT concat('N', CAST(user_id % 25 AS STRING), '_2024') AS league_id, user_id % 6 + 1 AS roster_id, event_type AS player_id, CAST(ts AS DATE) AS snapshot_date FROM {events}"


_PLAYER_PRESENCE = "ppl AS (SELECT DISTINCT league_lineage_id, league_lineage_id || '_' || CAST(roster_id AS VARCHAR) AS franchise_id, player_id, snapshot_date FROM rd JOIN (SELECT DISTINCT league_id, league_lineage_id FROM leagues) USING (league_id))"


@query(f"WITH {_PLAYER_PRESENCE} SELECT * FROM ppl", rd=ROSTER_DAYS, leagues=LEAGUES)
def l9_player_presence(spark, d):
    return ledger.player_presence(derive(spark, d, ROSTER_DAYS), _lineage_map(spark, d))


_OWNER = "league_lineage_id, franchise_id"
_ERA = "DATE '2024-01-10'"
_CLIPPED = "valid_from, least(coalesce(valid_to, {0}), {0}) AS valid_to, false AS is_current FROM {1} WHERE valid_from < {0} AND valid_from < least(coalesce(valid_to, {0}), {0})"


@query(
    f"""WITH {_LINEAGE}, {_PLAYER_PRESENCE}, {_PLAYER_EVENTS}, {_PICK_PRESENCE}, {_LIFE}, {_TRADES}, {_PICK_STINTS},
{_islands("e", "ppl", _OWNER + ", player_id", f"snapshot_date >= {_ERA}")}, {_stints("b", "pev", _OWNER + ", player_id")}, {_islands("q", "pp", _OWNER + ", pick_id", f"snapshot_date >= {_ERA}")},
al_ AS (SELECT {_OWNER}, player_id AS asset_id, 'player' AS asset_type, valid_from, valid_to, valid_to IS NULL AS is_current FROM es
UNION ALL SELECT {_OWNER}, player_id, 'player', {_CLIPPED.format(_ERA, "bs")}
UNION ALL SELECT {_OWNER}, pick_id, 'pick', valid_from, valid_to, valid_to IS NULL FROM qs
UNION ALL SELECT {_OWNER}, pick_id, 'pick', {_CLIPPED.format(_ERA, "pints")})
SELECT *, CASE WHEN valid_from < {_ERA} THEN 'events' ELSE 'snapshots' END AS source, DATE '2024-02-01' AS loaded_at FROM al_""",
    leagues=LEAGUES, drafts=DRAFTS, daily=DAILY, rounds=ROUNDS, txn=TXN_PICKS, txns=TXNS, overrides=OVERRIDES, rd=ROSTER_DAYS, items=MOVE_ITEMS, dp=DRAFT_PICKS,
)
def l16_ledger(spark, d):
    lineages = _lineage_map(spark, d)
    present = ledger.player_presence(derive(spark, d, ROSTER_DAYS), lineages)
    moves = ledger.player_events(derive(spark, d, TXNS), derive(spark, d, MOVE_ITEMS), derive(spark, d, DRAFTS), derive(spark, d, DRAFT_PICKS), lineages, repeated=True)
    picks = ledger.pick_presence(derive(spark, d, DAILY), None, derive(spark, d, LEAGUES), derive(spark, d, DRAFTS))
    return ledger.assemble_ledger(present, moves, picks, ledger.reconstruct_pick_intervals(_life(spark, d), _trades(spark, d)), "2024-01-10", "2024-02-01")


# --- measures ------------------------------------------------------------------------------------------


def _team_ledger(spark, d):
    return intervals.build_snapshot_intervals(derive(spark, d, HOLD), ["franchise_id", "asset_id", "asset_type"])


_TEAM_LEDGER = """dts AS (SELECT snapshot_date, row_number() OVER (ORDER BY snapshot_date) AS i, lead(snapshot_date) OVER (ORDER BY snapshot_date) AS nx FROM (SELECT DISTINCT snapshot_date FROM hold)),
pp AS (SELECT k.*, i, nx, i - row_number() OVER (PARTITION BY franchise_id, asset_id ORDER BY k.snapshot_date) AS isl FROM hold k JOIN dts USING (snapshot_date)),
tl AS (SELECT franchise_id, asset_id, asset_type, min(snapshot_date) AS valid_from, nullif(arg_max(coalesce(nx, DATE '9999-01-01'), i), DATE '9999-01-01') AS valid_to FROM pp GROUP BY franchise_id, asset_id, asset_type, isl)"""
_VALUED = f"""{_TEAM_LEDGER}, g AS ({_WEEKS}), hd AS (SELECT tl.franchise_id, asset_id, asset_type, split_part(asset_id, ':', 1) AS season, TRY_CAST(split_part(asset_id, ':', 2) AS BIGINT) AS round, g.date FROM tl JOIN g ON valid_from <= g.date AND (valid_to IS NULL OR valid_to > g.date)),
pc AS (SELECT * FROM prices WHERE value > 0), fp AS (SELECT season, round, arg_min(value, valuation_date) AS first_value FROM pick_prices GROUP BY ALL),
vp AS (SELECT hp.*, pc.value FROM (SELECT * FROM hd WHERE asset_type = 'player') hp ASOF LEFT JOIN pc ON hp.asset_id = pc.player_id AND hp.date >= pc.valuation_date),
vk AS (SELECT hk.*, k.value FROM (SELECT * FROM hd WHERE asset_type = 'pick') hk ASOF LEFT JOIN pick_prices k ON hk.season = k.season AND hk.round = k.round AND hk.date >= k.valuation_date),
va AS (SELECT franchise_id, asset_id, asset_type, date, value FROM vp UNION ALL SELECT franchise_id, asset_id, asset_type, date, coalesce(value, first_value) FROM vk LEFT JOIN fp USING (season, round))"""
_SUMS = """CAST(coalesce(sum(value) FILTER (asset_type = 'player'), 0) AS DOUBLE) AS player_value, CAST(coalesce(sum(value) FILTER (asset_type = 'pick'), 0) AS DOUBLE) AS pick_value,
count(*) FILTER (asset_type = 'player' AND value > 0) AS n_player, count(*) FILTER (asset_type = 'pick' AND value > 0) AS n_pick, CAST(coalesce(sum(value), 0) AS DOUBLE) AS total_value"""


def _dates(spark):
    return intervals.weekly_dates(spark, "2024-01-01", "2024-01-30")


EVENT_KEYS = "SELECT event_id, user_id, CAST(ts AS DATE) AS date FROM {events}"
USER_PRICES = "SELECT user_id, CAST(ts AS DATE) AS valuation_date, max(value) AS value FROM {events} GROUP BY user_id, CAST(ts AS DATE)"


@query("SELECT k.*, p.value FROM k ASOF LEFT JOIN p ON k.user_id = p.user_id AND k.date >= p.valuation_date", k=EVENT_KEYS, p=USER_PRICES)
def m2_asof_join(spark, d):
    return asof.asof_join(derive(spark, d, EVENT_KEYS), derive(spark, d, USER_PRICES), "date", ["user_id"], "valuation_date")


@query("SELECT k.*, p.value FROM k ASOF LEFT JOIN p ON k.user_id = p.user_id AND k.date > p.valuation_date", k=EVENT_KEYS, p=USER_PRICES)
def m2_asof_strict_bucketed(spark, d):
    return asof.asof_join(derive(spark, d, EVENT_KEYS), derive(spark, d, USER_PRICES), "date", ["user_id"], "valuation_date", strict=True, hot_rows=0, ranges=2000)  # cuts every user with more than a 2000th of the rows


@query("SELECT k.event_id, k.user_id, k.date, coalesce(p.value, f.v) AS value FROM k ASOF LEFT JOIN p ON k.user_id = p.user_id AND k.date >= p.valuation_date LEFT JOIN (SELECT user_id, arg_min(value, valuation_date) AS v FROM p GROUP BY user_id) f ON f.user_id = k.user_id", k=EVENT_KEYS, p=USER_PRICES)
def m3_backfill_first(spark, d):
    prices = derive(spark, d, USER_PRICES)
    found = asof.asof_join(derive(spark, d, EVENT_KEYS), prices, "date", ["user_id"], "valuation_date")
    return asof.backfill_first(found, prices, ["user_id"], "value", "valuation_date")


@query(f"WITH {_VALUED} SELECT franchise_id, date, {_SUMS} FROM va GROUP BY franchise_id, date", hold=HOLD, prices=PRICES, pick_prices=PICK_PRICES)
def m4_team_value(spark, d):
    return measures.team_value_timeseries(_team_ledger(spark, d), _dates(spark), derive(spark, d, PRICES), derive(spark, d, PICK_PRICES))


_ADJ = "(0.05 * pow(v / 10100.0, 1.3) + 0.05 * (v / (1.05 * greatest(a, 0.1))) + 0.1) * v * ((2.0 * pow(v / 10200.0, 1.3) + pow(greatest(a, 0.1) / 10200.0, 1.2)) / 3.0 * 0.7 + 0.3)"
ASSETS = "SELECT concat('S', CAST(l_suppkey AS STRING)) AS franchise_id, concat('N', CAST(s_nationkey AS STRING)) AS league_lineage_id, CAST(l_shipdate AS DATE) AS date, concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS asset_id, CAST(floor(l_extendedprice / 10) AS BIGINT) AS value FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey"


@query(f"WITH s AS (SELECT *, row_number() OVER (PARTITION BY date, franchise_id ORDER BY value DESC, asset_id) AS slot FROM a WHERE value > 0), t AS (SELECT asset_id, CAST(value AS DOUBLE) AS v, avg(value) OVER (PARTITION BY league_lineage_id, date, slot) AS a FROM s) SELECT asset_id, round({_ADJ}, 4) AS adjval FROM t", a=ASSETS)
def m5_adjusted_value(spark, d):
    from pyspark.sql import Window

    s = derive(spark, d, ASSETS).where("value > 0").withColumn("slot", F.row_number().over(Window.partitionBy("date", "franchise_id").orderBy(F.desc("value"), "asset_id")))
    s = s.withColumn("a", F.avg("value").over(Window.partitionBy("league_lineage_id", "date", "slot")))
    return s.select("asset_id", F.round(measures.pr_adjval(F.col("value").cast("double"), F.col("a")), 4).alias("adjval"))


@query(
    f"""WITH s AS (SELECT *, row_number() OVER (PARTITION BY date, franchise_id ORDER BY value DESC, asset_id) AS slot FROM a WHERE value > 0), t AS (SELECT franchise_id, league_lineage_id, date, CAST(value AS DOUBLE) AS v, avg(value) OVER (PARTITION BY league_lineage_id, date, slot) AS a FROM s),
u AS (SELECT franchise_id, league_lineage_id, date, sum({_ADJ}) AS adj FROM t GROUP BY ALL) SELECT franchise_id, league_lineage_id, date, round(adj, 3) AS adj_total, CAST(floor(adj / max(adj) OVER (PARTITION BY league_lineage_id, date) * 99) AS INT) AS power_index FROM u""",
    a=ASSETS,
)
def m6_power_index(spark, d):
    return measures.power_index(derive(spark, d, ASSETS)).withColumn("adj_total", F.round("adj_total", 3))


@query(
    f"""WITH {_VALUED}, u AS (SELECT franchise_id, league_lineage_id, date, sum({_ADJ}) AS adj FROM (SELECT franchise_id, league_lineage_id, date, CAST(value AS DOUBLE) AS v, avg(value) OVER (PARTITION BY league_lineage_id, date, slot) AS a
FROM (SELECT va.*, league_lineage_id, row_number() OVER (PARTITION BY date, franchise_id ORDER BY value DESC, asset_id) AS slot FROM va JOIN fr USING (franchise_id) WHERE value > 0)) GROUP BY ALL)
SELECT franchise_id, league_lineage_id, date, round(adj, 3) AS adj_total, CAST(floor(adj / max(adj) OVER (PARTITION BY league_lineage_id, date) * 99) AS INT) AS power_index FROM u""",
    hold=HOLD, prices=PRICES, pick_prices=PICK_PRICES, fr=FRANCHISES,
)
def m6_team_power_index(spark, d):
    out = measures.team_power_index(_team_ledger(spark, d), _dates(spark), derive(spark, d, PRICES), derive(spark, d, FRANCHISES), derive(spark, d, PICK_PRICES))
    return out.withColumn("adj_total", F.round("adj_total", 3))


_TV = f"{_VALUED}, tv AS (SELECT va.franchise_id, league_lineage_id, date, {_SUMS} FROM va JOIN fr USING (franchise_id) GROUP BY ALL)"


def _tv(spark, d):
    return m4_team_value(spark, d).join(derive(spark, d, FRANCHISES), "franchise_id")


@query(
    f"""WITH {_TV}, ag AS (SELECT league_lineage_id, date, avg(total_value) AS league_mean, sum(total_value) AS league_total, CAST(sum(n_player) AS BIGINT) AS lg_players_valued, count(*) AS n_teams FROM tv GROUP BY ALL)
SELECT *, league_total / greatest(lg_players_valued, 1) AS val_per_valued, round((league_mean / nullif(lag(league_mean) OVER w, 0) - 1) * 100, 1) AS wow_pct, lg_players_valued - lag(lg_players_valued) OVER w AS d_players FROM ag WINDOW w AS (PARTITION BY league_lineage_id ORDER BY date)""",
    hold=HOLD, prices=PRICES, pick_prices=PICK_PRICES, fr=FRANCHISES,
)
def m7_league_diagnostics(spark, d):
    return measures.league_diagnostics(_tv(spark, d))[1]


@query(
    f"""WITH {_TV}, b AS (SELECT franchise_id, arg_min(total_value, date) AS base FROM tv WHERE total_value > 0 GROUP BY franchise_id)
SELECT tv.franchise_id, date, league_lineage_id, round(total_value / nullif(avg(total_value) OVER w, 0), 6) AS share, round(total_value / base * 100, 6) AS idx, round(99 * player_value / nullif(max(player_value) OVER w, 0), 0) AS player_index, round(99 * total_value / nullif(max(total_value) OVER w, 0), 0) AS total_index
FROM tv LEFT JOIN b USING (franchise_id) WINDOW w AS (PARTITION BY league_lineage_id, date)""",
    hold=HOLD, prices=PRICES, pick_prices=PICK_PRICES, fr=FRANCHISES,
)
def m7_team_diagnostics(spark, d):
    plus = measures.league_diagnostics(_tv(spark, d))[0]
    return plus.select("franchise_id", "date", "league_lineage_id", F.round("share", 6).alias("share"), F.round("idx", 6).alias("idx"), "player_index", "total_index")


@query(f"WITH {_TV} SELECT franchise_id, league_lineage_id, date, total_value, round(100 * total_value / nullif(avg(total_value) OVER (PARTITION BY league_lineage_id, date), 0), 6) AS total_value_rel FROM tv", hold=HOLD, prices=PRICES, pick_prices=PICK_PRICES, fr=FRANCHISES)
def m8_relative_to_mean(spark, d):
    out = measures.relative_to_mean(_tv(spark, d), "total_value", ["league_lineage_id", "date"])
    return out.select("franchise_id", "league_lineage_id", "date", "total_value", F.round("total_value_rel", 6).alias("total_value_rel"))


@query(
    f"""WITH {_TEAM_LEDGER}, held AS (SELECT franchise_id, asset_id, asset_type FROM tl WHERE valid_from <= DATE '2024-01-20' AND (valid_to IS NULL OR valid_to > DATE '2024-01-20')),
lt AS (SELECT player_id, CAST(arg_max(value, valuation_date) AS DOUBLE) AS v FROM prices WHERE valuation_date <= DATE '2024-01-20' AND value > 0 GROUP BY player_id),
lk AS (SELECT season || ':' || CAST(round AS VARCHAR) AS k, CAST(arg_max(value, valuation_date) AS DOUBLE) AS v FROM pick_prices WHERE valuation_date <= DATE '2024-01-20' GROUP BY ALL),
hv AS (SELECT franchise_id, nullif(coalesce(lt.v, lk.v), 0) AS v FROM held LEFT JOIN lt ON asset_type = 'player' AND player_id = asset_id LEFT JOIN lk ON asset_type = 'pick' AND starts_with(asset_id, k || ':'))
SELECT franchise_id, array_to_string(list(CAST(v AS BIGINT) ORDER BY v DESC) FILTER (v > 0), ',') AS bag, coalesce(sum(v), 0.0) AS naive_sum, count(v) AS n FROM hv GROUP BY franchise_id""",
    hold=HOLD, prices=PRICES, pick_prices=PICK_PRICES,
)
def m9_team_bags(spark, d):
    bags = measures.team_bags(_team_ledger(spark, d), "2024-01-20", derive(spark, d, PRICES), derive(spark, d, PICK_PRICES))
    text = F.array_join(F.transform("values", lambda v: v.cast("bigint").cast("string")), ",")
    return bags.select("franchise_id", F.when(F.col("n") > 0, text).alias("bag"), "naive_sum", "n")


@query(f"WITH {_TV} SELECT franchise_id, max(date) AS date, arg_max(total_value, date) AS total_value FROM tv GROUP BY franchise_id", hold=HOLD, prices=PRICES, pick_prices=PICK_PRICES, fr=FRANCHISES)
def m10_latest_ranked(spark, d):
    return measures.latest_ranked(_tv(spark, d), "total_value")


SERIES = "SELECT p_brand AS position, CAST(l_partkey AS STRING) AS player_id, CAST(l_shipdate AS DATE) AS valuation_date, CAST(floor(l_extendedprice) AS BIGINT) AS value, CAST(1992 + p_partkey % 4 AS INT) AS draft_year FROM {lineitem} JOIN {part} ON l_partkey = p_partkey"


@query("SELECT position, CAST(date_trunc('month', valuation_date) AS DATE) AS month, CAST(median(value) AS DOUBLE) AS median_value FROM s GROUP BY ALL", s=SERIES)
def m11_monthly_median(spark, d):
    return measures.monthly_median(derive(spark, d, SERIES), "value")


SELECTIONS = "SELECT p_partkey AS pick_no, CAST(1 + p_partkey % 4 AS BIGINT) AS round, CAST(1993 + p_partkey % 3 AS BIGINT) AS season, CAST(p_partkey AS STRING) AS player_id FROM {part}"
DAY_VALUES = "SELECT CAST(l_partkey AS STRING) AS player_id, CAST(l_shipdate AS DATE) AS valuation_date, CAST(floor(max(l_extendedprice)) AS BIGINT) AS value FROM {lineitem} GROUP BY l_partkey, CAST(l_shipdate AS DATE)"
_CAPITAL = "x AS (SELECT s.*, CAST(h AS INT) AS horizon, make_date(CAST(season + h AS BIGINT), 6, 1) AS on_date FROM s, generate_series(1, 3) AS g(h)), cap AS (SELECT x.*, coalesce(v.value, 0) AS value FROM x ASOF LEFT JOIN v ON x.player_id = v.player_id AND x.on_date >= v.valuation_date)"


def _capital(spark, d):
    return measures.horizon_values(derive(spark, d, SELECTIONS), derive(spark, d, DAY_VALUES))


@query(f"WITH {_CAPITAL} SELECT pick_no, round, season, player_id, horizon, on_date, value FROM cap", s=SELECTIONS, v=DAY_VALUES)
def m12_horizon_values(spark, d):
    return _capital(spark, d)


@query(f"WITH {_CAPITAL} SELECT round, horizon, avg(value) AS mean_value, CAST(median(value) AS DOUBLE) AS median_value, count(*) AS n FROM cap GROUP BY round, horizon", s=SELECTIONS, v=DAY_VALUES)
def m13_pick_ev(spark, d):
    return measures.pick_ev(_capital(spark, d))


@query("SELECT position, CAST(year(valuation_date) - draft_year AS INT) AS years, CAST(median(value) AS DOUBLE) AS median_value, count(*) AS n FROM s WHERE year(valuation_date) - draft_year BETWEEN 0 AND 15 GROUP BY ALL", s=SERIES)
def m14_career_curve(spark, d):
    s = derive(spark, d, SERIES)
    return measures.career_curve(s.select("player_id", "valuation_date", "value"), s.select("player_id", "position", "draft_year").distinct())
