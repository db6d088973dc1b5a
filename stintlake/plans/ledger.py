"""The ownership ledger: membership, pick ownership, and the two eras joined into stints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintlake.functions.coerce import ms_to_date
from stintlake.operators.dedupe import keep_first
from stintlake.operators.graph import build_lineage_map, franchise_id, lineage_franchise, relabel_current
from stintlake.operators.intervals import build_event_intervals, build_snapshot_intervals, clip_at, combine_eras, drop_empty
from stintlake.operators.overlay import overlay

PICK = ["league_id", "season", "round", "original_roster_id"]
FLAGS = ("is_starter", "is_taxi", "is_reserve", "is_active")


def build_player_membership(rosters: DataFrame, franchises: DataFrame, players: DataFrame) -> DataFrame:
    """Roster rows with franchise and player dimension; player_key is null for unmapped players."""
    df = rosters.withColumns({c: F.lit(None).cast("boolean") for c in FLAGS if c not in rosters.columns})
    f = keep_first(franchises.select("league_id", "roster_id", "franchise_id"), ["league_id", "roster_id"], [])
    p = keep_first(players.select(F.col("player_key").alias("player_id"), F.col("player_key"), "position"), ["player_id"], [])
    joined = df.join(f, ["league_id", "roster_id"], "left").join(p, "player_id", "left")
    none = lambda c, t: F.lit(None).cast(t).alias(c)
    return joined.select("league_id", "roster_id", "franchise_id", F.lit("PLAYER").alias("asset_type"), F.col("player_id").alias("asset_id"), "player_key", "position", *FLAGS, none("season", "string"), none("round", "bigint"), none("original_roster_id", "bigint"))


def norm_pick_keys(df: DataFrame, original: str) -> DataFrame:
    """The pick key with its types: league and season text, round and original roster numbers."""
    return df.withColumns({"league_id": F.col("league_id").cast("string"), "season": F.col("season").cast("string"), "round": F.col("round").cast("bigint"), "original_roster_id": F.col(original).cast("bigint")})


def _completed(drafts: DataFrame, lineage_map: DataFrame) -> DataFrame:
    done = drafts.where("status = 'complete'").withColumn("season", F.col("season").cast("int"))
    return done.join(lineage_map.select("league_id", "current_league_id").distinct(), "league_id")


def drafted_cutoffs(drafts: DataFrame, lineage_map: DataFrame) -> DataFrame:
    """league_id (current), cutoff_season: the last season whose draft is complete."""
    return _completed(drafts, lineage_map).groupBy(F.col("current_league_id").alias("league_id")).agg(F.max("season").alias("cutoff_season"))


def rookie_rounds(drafts: DataFrame, lineage_map: DataFrame) -> DataFrame:
    """league_id (current), rookie_rounds: the rounds of the last complete draft (the fewest on ties)."""
    last = F.max(F.struct("season", (-F.col("rounds")).alias("r")))
    return _completed(drafts, lineage_map).groupBy(F.col("current_league_id").alias("league_id")).agg(last.alias("_x")).select("league_id", (-F.col("_x.r")).alias("rookie_rounds"))


def drafts_completed_by(drafts: DataFrame, day: str | Column) -> DataFrame:
    """Drafts that started by a day; those without a start are kept."""
    d = F.lit(day).cast("date") if isinstance(day, str) else day
    return drafts.where(F.col("start_time").isNull() | (ms_to_date("start_time") <= d))


def build_pick_universe(observed: DataFrame, current: DataFrame, years_ahead: int = 3, extra: tuple[str, ...] = ()) -> DataFrame:
    """All picks of current leagues: (cutoff, cutoff + years_ahead] x rounds x rosters, and every observed
    (season, round) x rosters, later than the cutoff.

    current: league_id, total_rosters, cutoff_season, rookie_rounds. `extra` key columns (a snapshot date)
    are carried along. Empty ranges give nothing.
    """
    keys = [*extra, "league_id"]
    span = lambda low, high: F.when(high >= low, F.sequence(low.cast("int"), high.cast("int")))
    grid = current.select(*keys, "total_rosters", "cutoff_season", F.explode(span(F.col("cutoff_season") + 1, F.col("cutoff_season") + years_ahead)).alias("season"), "rookie_rounds")
    grid = grid.select(*keys, "total_rosters", "cutoff_season", "season", F.explode(span(F.lit(1), F.col("rookie_rounds"))).alias("round"))
    seen = observed.select(*keys, F.col("season").cast("int").alias("season"), F.col("round").cast("int").alias("round")).distinct().join(current.select(*keys, "total_rosters", "cutoff_season"), keys)
    both = grid.select(*keys, "season", "round", "total_rosters", "cutoff_season").union(seen.select(*keys, "season", "round", "total_rosters", "cutoff_season")).distinct()
    picks = both.where("season > cutoff_season").select(*keys, "season", "round", F.explode(span(F.lit(1), F.col("total_rosters"))).alias("original_roster_id"))
    return picks.select(*keys, F.col("season").cast("string").alias("season"), F.col("round").cast("bigint").alias("round"), F.col("original_roster_id").cast("bigint").alias("original_roster_id")).distinct()


def _current_meta(leagues: DataFrame, drafts: DataFrame | None, lineage_map: DataFrame) -> DataFrame:
    """Current leagues with roster count, cutoff and rounds; the season before the current one and 3 rounds
    where no draft is complete."""
    top = lineage_map.select(F.col("current_league_id").alias("league_id"), "total_rosters", "latest_completed_season").distinct()
    season = leagues.select("league_id", (F.col("season").cast("int") - 1).alias("_before")).dropDuplicates(["league_id"])
    df = top.join(season, "league_id", "left")
    if drafts is None:
        return df.select("league_id", "total_rosters", F.coalesce("latest_completed_season", "_before").alias("cutoff_season"), F.lit(3).alias("rookie_rounds"))
    df = df.join(drafted_cutoffs(drafts, lineage_map), "league_id", "left").join(rookie_rounds(drafts, lineage_map), "league_id", "left")
    return df.select("league_id", "total_rosters", F.coalesce("cutoff_season", "latest_completed_season", "_before").alias("cutoff_season"), F.coalesce("rookie_rounds", F.lit(3)).alias("rookie_rounds"))


def resolve_pick_ownership(traded: DataFrame, events: DataFrame | None, overrides: DataFrame | None, leagues: DataFrame, drafts: DataFrame | None = None, years_ahead: int = 3) -> DataFrame:
    """The owner of every pick of the universe: override > event log > traded state > original roster.

    traded: league_id, season, round, original_roster_id, owner_roster_id, timestamp. events: league_id,
    season, round, roster_id, owner_id, ts. overrides: league_id, season, round, roster_id, to_team_id,
    created. Rows under an older league of a lineage count for its current one.
    """
    lineage_map = build_lineage_map(leagues)
    state = relabel_current(norm_pick_keys(traded, "original_roster_id"), lineage_map)
    sources, names, observed = [], [], [state.select("league_id", "season", "round")]
    for frame, name, original, ts, owner in ((overrides, "override", "roster_id", "created", "to_team_id"), (events, "event", "roster_id", "ts", "owner_id")):
        if frame is not None:
            keyed = relabel_current(norm_pick_keys(frame, original), lineage_map)
            sources.append((keyed, ts, owner))
            names.append(name)
            observed.append(keyed.select("league_id", "season", "round"))
    sources.append((state.withColumn("_ts", F.unix_micros(F.col("timestamp").cast("timestamp"))), "_ts", "owner_roster_id"))
    names.append("traded")
    seen = observed[0]
    for o in observed[1:]:
        seen = seen.union(o)
    base = build_pick_universe(seen, _current_meta(leagues, drafts, lineage_map), years_ahead).withColumn("owner_roster_id", F.col("original_roster_id"))
    return overlay(base, [(f.withColumn(o, F.col(o).cast("bigint")), t, o) for f, t, o in sources], PICK, "owner_roster_id", names)


def build_pick_membership(resolved: DataFrame, franchises: DataFrame) -> DataFrame:
    """Picks as assets season:round:original roster of their owner's franchise."""
    f = keep_first(franchises.select("league_id", F.col("roster_id").alias("owner_roster_id"), "franchise_id"), ["league_id", "owner_roster_id"], [])
    df = resolved.join(f, ["league_id", "owner_roster_id"], "left")
    return df.select("league_id", F.col("owner_roster_id").alias("roster_id"), "franchise_id", F.lit("PICK").alias("asset_type"), F.concat_ws(":", "season", F.col("round").cast("string"), F.col("original_roster_id").cast("string")).alias("asset_id"), "season", "round", "original_roster_id")


def pick_presence(traded_daily: DataFrame, overrides: DataFrame | None, leagues: DataFrame, drafts: DataFrame, years_ahead: int = 3) -> DataFrame:
    """Pick ownership on every snapshot day in one pass: the day is a part of every key.

    A day only knows its own traded state, and drafts that started by then decide its cutoff. Result:
    snapshot_date, league_lineage_id, franchise_id, pick_id.
    """
    lineage_map = build_lineage_map(leagues)
    state = relabel_current(norm_pick_keys(traded_daily, "original_roster_id"), lineage_map)
    names = lineage_map.select(F.col("current_league_id").alias("league_id"), "league_lineage_id", "total_rosters", "latest_completed_season").distinct()
    days = state.select("snapshot_date", "league_id").distinct()
    done = _completed(drafts, lineage_map).select(F.col("current_league_id").alias("league_id"), "season", "rounds", ms_to_date("start_time").alias("_start"))
    by_day = days.join(done, "league_id").where("_start IS NULL OR _start <= snapshot_date").groupBy("snapshot_date", "league_id").agg(F.max(F.struct("season", (-F.col("rounds")).alias("r"))).alias("_x"))
    before = leagues.select("league_id", (F.col("season").cast("int") - 1).alias("_before")).dropDuplicates(["league_id"])
    current = days.join(names, "league_id").join(before, "league_id", "left").join(by_day, ["snapshot_date", "league_id"], "left")
    current = current.select("snapshot_date", "league_id", "total_rosters", F.coalesce("_x.season", "latest_completed_season", "_before").alias("cutoff_season"), F.coalesce(-F.col("_x.r"), F.lit(3)).alias("rookie_rounds"))
    base = build_pick_universe(state, current, years_ahead, ("snapshot_date",)).withColumn("owner_roster_id", F.col("original_roster_id"))
    sources, labels = [(state.withColumn("_ts", F.lit(0)), "_ts", "owner_roster_id")], ["traded"]
    if overrides is not None:
        moved = relabel_current(norm_pick_keys(overrides, "roster_id"), lineage_map).join(days, "league_id").where(ms_to_date("created") <= F.col("snapshot_date"))
        sources, labels = [(moved.withColumn("to_team_id", F.col("to_team_id").cast("bigint")), "created", "to_team_id"), *sources], ["override", *labels]
    owned = overlay(base, sources, ["snapshot_date", *PICK], "owner_roster_id", labels).join(names.select("league_id", "league_lineage_id"), "league_id")
    return owned.select("snapshot_date", "league_lineage_id", franchise_id("league_lineage_id", "owner_roster_id").alias("franchise_id"), F.concat_ws(":", "season", F.col("round").cast("string"), F.col("original_roster_id").cast("string")).alias("pick_id"))


# --- history -----------------------------------------------------------------------------------------


def player_presence(rosters: DataFrame, lineage_map: DataFrame) -> DataFrame:
    """Daily snapshots as (league_lineage_id, franchise_id, player_id, snapshot_date)."""
    return lineage_franchise(rosters, lineage_map).select("league_lineage_id", "franchise_id", F.col("player_id").cast("string").alias("player_id"), F.col("snapshot_date").cast("date").alias("snapshot_date")).distinct()


def player_events(transactions: DataFrame, moves: DataFrame, drafts: DataFrame, draft_picks: DataFrame, lineage_map: DataFrame, repeated: bool = False) -> DataFrame:
    """Adds and drops of completed transactions and drafts: lineage, franchise, player, ts, date, action.

    An item counts once a transaction; with `repeated` as often as it is there, which saves a shuffle of all
    items where the events become stints (a repeated event changes none).
    """
    done = keep_first(transactions.where("status = 'complete'"), ["transaction_id"], []).select("transaction_id", F.col("created").cast("bigint").alias("ts"))
    items = moves.select("transaction_id", "league_id", "roster_id", F.col("player_id").cast("string").alias("player_id"), "action")
    items = items if repeated else items.distinct()
    traded = items.join(done, "transaction_id").select("league_id", "roster_id", "player_id", "ts", "action")
    times = keep_first(drafts, ["draft_id"], []).select("draft_id", "league_id", F.coalesce("last_picked", "start_time").cast("bigint").alias("ts"))
    drafted = draft_picks.select("draft_id", "roster_id", F.col("player_id").cast("string").alias("player_id")).distinct().join(times, "draft_id").select("league_id", "roster_id", "player_id", "ts", F.lit("add").alias("action"))
    both = lineage_franchise(traded.union(drafted).where("ts IS NOT NULL AND player_id IS NOT NULL"), lineage_map)
    return both.select("league_lineage_id", "franchise_id", "player_id", "ts", ms_to_date("ts").alias("date"), "action")


def pick_trade_events(full: DataFrame | None, daily: DataFrame | None, overrides: DataFrame | None, transactions: DataFrame, lineage_map: DataFrame) -> DataFrame:
    """Changes of pick owners from three feeds: lineage, pick_id, prev_franchise, new_franchise, ts, date.

    The full load names the new owner owner_id; its older layout has the labels swapped, so there
    from_team_id is the new owner. Overrides name it to_team_id. Only completed transactions count.
    """
    def part(frame: DataFrame, new: str, prev: str, *rest: str) -> DataFrame:
        return frame.select("league_id", F.col("season").cast("string").alias("season"), F.col("round").cast("bigint").alias("round"), F.col("roster_id").cast("bigint").alias("roster_id"), F.col(new).cast("bigint").alias("_new"), F.col(prev).cast("bigint").alias("_prev"), *rest)

    items = None
    for frame in (full, daily):
        if frame is not None:
            new, prev = ("owner_id", "previous_owner_id") if "owner_id" in frame.columns else ("from_team_id", "to_team_id")
            own = part(frame, new, prev, "transaction_id")
            items = own if items is None else items.unionByName(own)
    done = keep_first(transactions.where("status = 'complete'"), ["transaction_id"], []).select("transaction_id", F.col("created").cast("bigint").alias("ts"))
    events = None
    if items is not None:
        # joined first: the choice then needs no shuffle of its own
        events = keep_first(items.join(done, "transaction_id"), ["transaction_id", "season", "round", "roster_id"], []).drop("transaction_id")
    if overrides is not None:
        moved = part(overrides, "to_team_id", "from_team_id", F.col("created").cast("bigint").alias("ts"))
        events = moved if events is None else events.unionByName(moved)
    named = events.join(lineage_map.select("league_id", "league_lineage_id").distinct(), "league_id")
    pick = F.concat_ws(":", "season", F.col("round").cast("string"), F.col("roster_id").cast("string"))
    return named.select("league_lineage_id", pick.alias("pick_id"), franchise_id("league_lineage_id", "_prev").alias("prev_franchise"), franchise_id("league_lineage_id", "_new").alias("new_franchise"), "ts", ms_to_date("ts").alias("date"))


def synthesize_pick_lifecycle(drafts: DataFrame, leagues: DataFrame, lineage_map: DataFrame, rounds: DataFrame, years_out: int = 3) -> DataFrame:
    """Mint and consumption of every pick: lineage, franchise_id, pick_id, mint_ts, mint_date, consume_date.

    Picks of season S come into being with the draft of season S - years_out (at the earliest the
    lineage's first season) and are used up by the draft of season S.
    """
    names = lineage_map.select("league_id", "league_lineage_id").distinct()
    done = keep_first(drafts, ["draft_id"], []).join(names, "league_id").groupBy("league_lineage_id", F.col("season").cast("int").alias("dseason")).agg(F.max(F.coalesce("last_picked", "start_time").cast("bigint")).alias("dts"))
    base = leagues.groupBy("league_lineage_id").agg(F.min(F.col("season").cast("int")).alias("startup"), F.max(F.col("total_rosters").cast("int")).alias("n"))
    last = done.groupBy("league_lineage_id").agg(F.max("dseason").alias("_last"))
    r = rounds.groupBy("league_lineage_id").agg(F.max(F.col("rounds").cast("int")).alias("r"))
    meta = base.join(last, "league_lineage_id").join(r, "league_lineage_id", "left").withColumn("r", F.coalesce("r", F.lit(3)))
    span = lambda low, high: F.when(high >= low, F.sequence(low, high))
    picks = meta.withColumn("s", F.explode(span(F.col("startup") + 1, F.col("_last") + years_out))).withColumn("rnd", F.explode(span(F.lit(1), F.col("r")))).withColumn("roster", F.explode(span(F.lit(1), F.col("n"))))
    picks = picks.withColumn("mint_season", F.greatest(F.col("s") - years_out, F.col("startup")))
    mint = done.select("league_lineage_id", F.col("dseason").alias("mint_season"), F.col("dts").alias("mint_ts"), ms_to_date("dts").alias("mint_date"))
    used = done.select("league_lineage_id", F.col("dseason").alias("s"), ms_to_date("dts").alias("consume_date"))
    out = picks.join(mint, ["league_lineage_id", "mint_season"]).join(used, ["league_lineage_id", "s"], "left")
    pick = F.concat_ws(":", F.col("s").cast("string"), F.col("rnd").cast("string"), F.col("roster").cast("string"))
    return out.select("league_lineage_id", franchise_id("league_lineage_id", "roster").alias("franchise_id"), pick.alias("pick_id"), "mint_ts", "mint_date", "consume_date")


def reconstruct_pick_intervals(lifecycle: DataFrame, trades: DataFrame) -> DataFrame:
    """Stints of picks: minted to their roster, moved by trades, ended when used.

    Minting is an add, a trade a drop and an add; an open stint is capped at the pick's own use within its
    lineage; empty stints go.
    """
    mints = lifecycle.select("league_lineage_id", "franchise_id", "pick_id", F.col("mint_ts").alias("ts"), F.col("mint_date").cast("date").alias("date"), F.lit("add").alias("action"))
    side = lambda f, a: F.struct(F.col(f).alias("franchise_id"), F.lit(a).alias("action"))
    sides = F.inline(F.array(side("prev_franchise", "drop"), side("new_franchise", "add")))  # trades are derived once
    moved = trades.select("league_lineage_id", "pick_id", "ts", F.col("date").cast("date").alias("date"), sides)
    stints = build_event_intervals(mints.unionByName(moved), ["league_lineage_id", "franchise_id", "pick_id"])
    used = lifecycle.groupBy("league_lineage_id", "pick_id").agg(F.max(F.col("consume_date").cast("date")).alias("_used"))
    capped = stints.join(used, ["league_lineage_id", "pick_id"], "left").withColumn("valid_to", F.least("valid_to", "_used")).withColumn("is_current", F.col("valid_to").isNull())
    return drop_empty(capped).select("league_lineage_id", "franchise_id", "pick_id", "valid_from", "valid_to", "is_current")


def rollover_windows(present: DataFrame, events: DataFrame, least_gap: int = 3) -> DataFrame:
    """league_lineage_id, carry_date, window_start, window_end of lineages whose snapshots have a gap.

    The longest gap between two consecutive snapshots (the first on ties) counts if it has least_gap days
    or more. The window runs from the first event day (else the day after the last old snapshot) to the
    first new snapshot; it is skipped if that is empty or no older snapshot can be carried over.
    """
    days = present.select("league_lineage_id", F.col("snapshot_date").cast("date").alias("d")).distinct()
    line = Window.partitionBy("league_lineage_id").orderBy("d")
    gaps = days.withColumn("_next", F.lead("d").over(line)).where("_next IS NOT NULL").withColumn("_gap", F.datediff("_next", "d"))
    top = gaps.groupBy("league_lineage_id").agg(F.max(F.struct("_gap", F.negative(F.unix_date("d")).alias("_early"), "d", "_next")).alias("_x")).where(F.col("_x._gap") >= least_gap)
    first = events.groupBy("league_lineage_id").agg(F.min(F.col("date").cast("date")).alias("_first"))
    w = top.join(first, "league_lineage_id", "left").select("league_lineage_id", F.coalesce("_first", F.date_add("_x.d", 1)).alias("window_start"), F.col("_x._next").alias("window_end")).where("window_start < window_end")
    carry = days.join(w, "league_lineage_id").where("d < window_start").groupBy("league_lineage_id").agg(F.max("d").alias("carry_date"))
    return w.join(carry, "league_lineage_id").select("league_lineage_id", "carry_date", "window_start", "window_end")


def _outside(present: DataFrame, windows: DataFrame) -> DataFrame:
    """Presence without the stale days inside windows."""
    w = windows.select("league_lineage_id", "window_start", "window_end")
    return present.join(w, "league_lineage_id", "left").where("window_start IS NULL OR snapshot_date < window_start OR snapshot_date >= window_end").select(*present.columns)


def _daily(intervals: DataFrame, windows: DataFrame) -> DataFrame:
    """The days of intervals inside their lineage's window."""
    w = windows.select("league_lineage_id", "window_start", "window_end")
    low, high = F.greatest("valid_from", "window_start"), F.date_sub(F.least(F.coalesce("valid_to", "window_end"), "window_end"), 1)
    return intervals.join(w, "league_lineage_id").where(low <= high).withColumn("snapshot_date", F.explode(F.sequence(low, high, F.expr("interval 1 day"))))


def reconstruct_rollover_presence(present: DataFrame, events: DataFrame, least_gap: int = 3) -> tuple[DataFrame, DataFrame]:
    """(presence, windows): the stale days of rollover windows replaced by a replay of the events.

    The roster of the carry-over date counts as adds before all events; a stint [add day, drop day)
    covers exactly the days at whose end the asset is held.
    """
    windows = rollover_windows(present, events, least_gap)
    start = present.join(windows.select("league_lineage_id", "carry_date", "window_start"), "league_lineage_id").where("snapshot_date = carry_date")
    start = start.select("league_lineage_id", "franchise_id", "player_id", F.lit(-(1 << 62)).alias("ts"), F.col("window_start").alias("date"), F.lit("add").alias("action"))
    moves = events.join(windows.select("league_lineage_id", "window_end"), "league_lineage_id").where("date < window_end").select("league_lineage_id", "franchise_id", "player_id", "ts", "date", "action")
    stints = build_event_intervals(start.unionByName(moves), ["league_lineage_id", "franchise_id", "player_id"])
    replayed = _daily(stints, windows).select("league_lineage_id", "franchise_id", "player_id", "snapshot_date")
    return _outside(present, windows).unionByName(replayed.select(*present.columns)).distinct(), windows


def reconstruct_rollover_pick_presence(present: DataFrame, intervals: DataFrame, windows: DataFrame) -> DataFrame:
    """Pick presence with the days of windows taken from reconstructed intervals."""
    return _outside(present, windows).unionByName(_daily(intervals, windows).select(*present.columns)).distinct()


def assemble_ledger(player_present: DataFrame, player_ev: DataFrame, pick_present: DataFrame, pick_intervals: DataFrame, boundary: str, as_of: str) -> DataFrame:
    """Stints of players and picks in one table: both eras, source and load date stamped."""
    key = ["league_lineage_id", "franchise_id"]
    rename = lambda df, c, t: df.withColumnRenamed(c, "asset_id").withColumn("asset_type", F.lit(t))
    players = rename(combine_eras(player_present, player_ev, boundary, [*key, "player_id"]), "player_id", "player")
    later = build_snapshot_intervals(pick_present.where(F.col("snapshot_date") >= F.lit(boundary).cast("date")), [*key, "pick_id"])
    picks = rename(later.unionByName(clip_at(pick_intervals, boundary).select(*later.columns)), "pick_id", "pick")
    source = F.when(F.col("valid_from") < F.lit(boundary).cast("date"), "events").otherwise("snapshots")
    return players.unionByName(picks).withColumns({"source": source, "loaded_at": F.lit(as_of).cast("date")})
