"""Nested JSON documents to relational tables.

Every function takes a frame with a JSON text column `doc`, one document (object) a row, and gives flat
tables. Documents that are no valid JSON give no rows with a key; missing fields are null. Where several
rows compete for a key, `arrival` (a column of docs) says which came last; without it the order is that of
the content.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintlake.functions.coerce import ms_to_iso, to_float_or_null, to_int_or_null, to_str_or_null
from stintlake.operators.dedupe import keep_last, union_by_name

_TEXT_MAP = "map<string,string>"


def parse(docs: DataFrame, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """The document's fields as columns; invalid documents are left out.

    The fields leave a generator, so a document is parsed once and not again for the filter.
    """
    return docs.select(*keep, F.inline(F.array_compact(F.array(F.from_json("doc", schema)))))


def as_variant(docs: DataFrame) -> DataFrame:
    """docs with `doc` as VARIANT, parsed once; invalid and null documents are left out.

    A column that is VARIANT already (a table that keeps its documents parsed) is taken as it is. The
    parsed value leaves a generator, so neither the filter nor the fields that are read from it repeat the
    parse.
    """
    if isinstance(docs.schema["doc"].dataType, T.VariantType):
        return docs.where("doc IS NOT NULL")
    valid = F.filter(F.array(F.try_parse_json("doc")), lambda v: v.isNotNull())
    return docs.select(*[c for c in docs.columns if c != "doc"], F.explode(valid).alias("doc"))


def _field(path: str, kind: str = "string", doc: str = "doc") -> Column:
    """A field of a VARIANT column; null if it is missing or can't be read as `kind`."""
    return F.try_variant_get(doc, f"$.{path}", kind)


#: The most names that a wide table takes from the data; beyond it the caller has to name its columns.
MOST_NAMES = 2000


def names_of(rows: DataFrame, names: Column, most: int = MOST_NAMES) -> list[str]:
    """The distinct non-null names in a column of name arrays, ascending; more than `most` are an error."""
    found = rows.select(F.explode(names).alias("n")).where("n IS NOT NULL").distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} different names: pass the ones to be columns")
    return sorted(r.n for r in found)


def json_array_docs(df: DataFrame, column: str) -> DataFrame:
    """A JSON array of documents to one row each (doc, arrival = place in the array)."""
    return df.select(F.posexplode(F.from_json(column, "array<string>")).alias("arrival", "doc"))


def _drop(df: DataFrame) -> DataFrame:
    return df.drop("arrival") if "arrival" in df.columns else df


def _arrival(docs: DataFrame) -> list[str]:
    return [c for c in ("arrival",) if c in docs.columns]


# --- rosters -----------------------------------------------------------------------------------------

_ROSTER = f"league_id string, roster_id bigint, owner_id string, players array<string>, starters array<string>, taxi array<string>, reserve array<string>, metadata {_TEXT_MAP}, settings map<string,bigint>"
_TEAM_TEXT = ("team_name", "record", "streak")
_TEAM_NUMBERS = ("division", "wins", "losses", "ties", "fpts", "fpts_decimal", "fpts_against", "fpts_against_decimal", "ppts", "ppts_decimal", "total_moves", "waiver_position", "waiver_budget_used")


def flatten_roster_players(docs: DataFrame) -> DataFrame:
    """A row for each player of each roster, with flags; missing lists are empty."""
    rows = parse(docs, _ROSTER)
    has = lambda c: F.array_contains(F.coalesce(c, F.array().cast("array<string>")), F.col("player_id"))
    players = rows.select("league_id", "roster_id", "owner_id", "starters", "taxi", "reserve", F.explode("players").alias("player_id"))
    players = players.withColumns({"is_starter": has("starters"), "is_taxi": has("taxi"), "is_reserve": has("reserve")})
    return players.select("league_id", "roster_id", "owner_id", "player_id", "is_starter", "is_taxi", "is_reserve", (~F.col("is_taxi") & ~F.col("is_reserve")).alias("is_active"))


def flatten_team_state(docs: DataFrame) -> DataFrame:
    """A row for each roster: names from its metadata, numbers from its settings."""
    rows = parse(docs, _ROSTER)
    return rows.select("league_id", "roster_id", "owner_id", *[F.col("metadata")[c].alias(c) for c in _TEAM_TEXT], *[F.col("settings")[c].alias(c) for c in _TEAM_NUMBERS])


def flatten_nicknames(docs: DataFrame, prefix: str = "p_nick_") -> DataFrame:
    """Metadata entries with the prefix (empty values too); a suffix of digits is a player, else a team."""
    rows = parse(docs, _ROSTER).select("league_id", "roster_id", "owner_id", F.explode(F.map_filter("metadata", lambda k, v: F.startswith(k, F.lit(prefix)))).alias("meta_key", "nickname_raw"))
    rows = rows.withColumn("subject_id", F.substring("meta_key", len(prefix) + 1, 1_000))
    return rows.withColumn("subject_type", F.when(F.col("subject_id").rlike(r"^\d+$"), "player").otherwise("team"))


def flatten_traded_picks_current(docs: DataFrame, league_id: str | Column) -> DataFrame:
    """Current owners of traded picks, the last of each (league, season, round, original roster)."""
    rows = parse(docs, "season string, round string, roster_id string, owner_id string, previous_owner_id string", _arrival(docs))
    league = F.lit(league_id) if isinstance(league_id, str) else league_id
    rows = rows.select(*_arrival(docs), league.cast("string").alias("league_id"), "season", to_int_or_null("round").alias("round"), to_int_or_null("roster_id").alias("original_roster_id"), to_int_or_null("owner_id").alias("owner_roster_id"), to_int_or_null("previous_owner_id").alias("previous_owner_roster_id"))
    return _drop(keep_last(rows, ["league_id", "season", "round", "original_roster_id"], _arrival(docs)))


def flatten_users(docs: DataFrame, league_id: str | Column) -> DataFrame:
    """Users with trimmed names (blank is null), the last of each (league, user)."""
    rows = parse(docs, f"user_id string, display_name string, avatar string, metadata {_TEXT_MAP}", _arrival(docs))
    league = F.lit(league_id) if isinstance(league_id, str) else league_id
    rows = rows.select(*_arrival(docs), league.cast("string").alias("league_id"), to_str_or_null("user_id").alias("user_id"), to_str_or_null("display_name").alias("display_name"), to_str_or_null(F.col("metadata")["team_name"]).alias("user_team_name"), to_str_or_null("avatar").alias("avatar"))
    return _drop(keep_last(rows, ["league_id", "user_id"], _arrival(docs)))


# --- leagues -----------------------------------------------------------------------------------------

_LEAGUE = "league_id string, name string, season string, status string, season_type string, total_rosters bigint, draft_id string, bracket_id string, previous_league_id string, settings map<string,double>, scoring_settings map<string,double>, roster_positions array<string>"


def _leagues(docs: DataFrame) -> DataFrame:
    """Parsed leagues; a league without an id stops the job."""
    rows = parse(docs, _LEAGUE)
    checked = F.when(F.col("league_id").isNull(), F.raise_error(F.lit("a league without league_id"))).otherwise(F.col("league_id"))
    return rows.withColumn("league_id", checked)


def _map_columns(rows: DataFrame, column: str, keys: Sequence[str] | None, kind: str) -> DataFrame:
    """A map's keys as columns; keys: the known ones, else those found in the data (MOST_NAMES at most)."""
    keys = names_of(rows, F.map_keys(column)) if keys is None else keys
    return rows.select("league_id", *[F.col(column)[k].cast(kind).alias(k) for k in keys])


def flatten_league(docs: DataFrame, setting_keys: Sequence[str] | None = None, scoring_keys: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(leagues, settings, scoring): header, and the two maps as columns; without scoring only the id."""
    rows = _leagues(docs)
    leagues = rows.select("league_id", F.col("name").alias("league_name"), "season", "status", "season_type", "total_rosters", "draft_id", "bracket_id", F.col("settings")["leg"].cast("bigint").alias("leg"), F.col("settings")["last_scored_leg"].cast("bigint").alias("last_scored_leg"), "previous_league_id")
    return leagues, _map_columns(rows, "settings", setting_keys, "bigint"), _map_columns(rows, "scoring_settings", scoring_keys, "double")


def flatten_roster_slots(docs: DataFrame, positions: Sequence[str] | None = None) -> DataFrame:
    """A row for each league with the number of slots of every position; TAXI and IR from the settings."""
    rows = _leagues(docs)
    if positions is None:
        positions = names_of(rows, F.col("roster_positions"))
    count = lambda p: F.size(F.filter(F.coalesce("roster_positions", F.array().cast("array<string>")), lambda x: x == p)).cast("long")
    number = lambda k: F.coalesce(F.col("settings")[k], F.lit(0)).cast("long")
    return rows.select("league_id", *[count(p).alias(p) for p in positions if p not in ("TAXI", "IR")], number("taxi_slots").alias("TAXI"), number("reserve_slots").alias("IR"))


def flatten_lineage(docs: DataFrame, chain: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leagues, slots) of lineages with league_lineage_id and season_number (1 for the first league).

    chain: (league_id, root, depth), as graph.walk_back gives it.
    """
    stamp = chain.where("root IS NOT NULL").select("league_id", F.col("root").alias("league_lineage_id"), (F.col("depth") + 1).alias("season_number"))
    leagues, _, _ = flatten_league(docs, [], [])
    return leagues.join(stamp, "league_id"), flatten_roster_slots(docs).join(stamp, "league_id")


# --- drafts ------------------------------------------------------------------------------------------

_TIMES = ("created", "last_message_time", "last_picked", "start_time")
_DRAFT_SETTINGS = ("rounds", "teams", "pick_timer", "nomination_timer", "enforce_position_limits", "reversal_round", "player_type")
_DRAFT = f"draft_id string, league_id string, created bigint, last_message_time bigint, last_picked bigint, start_time bigint, season string, season_type string, status string, type string, sport string, metadata {_TEXT_MAP}, settings map<string,bigint>, creators array<string>, draft_order map<string,bigint>"


def flatten_drafts(docs: DataFrame) -> DataFrame:
    """A row for each draft: ids, times also as ISO text, names and settings, raw creators and order."""
    rows = parse(docs, _DRAFT)
    return rows.select(
        "draft_id", "league_id", *_TIMES, *[ms_to_iso(c).alias(f"{c}_iso") for c in _TIMES], "season", "season_type", "status", "type", "sport",
        F.col("metadata")["name"].alias("draft_name"), F.col("metadata")["description"].alias("draft_description"), F.col("metadata")["scoring_type"].alias("scoring_type"),
        *[F.col("settings")[c].alias(c) for c in _DRAFT_SETTINGS], F.coalesce("creators", F.array().cast("array<string>")).alias("creators_raw"), F.coalesce("draft_order", F.create_map().cast("map<string,bigint>")).alias("draft_order_raw"),
    )


def flatten_draft_order(docs: DataFrame) -> DataFrame:
    """A row for each user of a draft's order."""
    return parse(docs, _DRAFT).select("draft_id", "league_id", F.explode("draft_order").alias("user_id", "slot"))


def flatten_draft_picks(docs: DataFrame) -> DataFrame:
    """Picks with leniently typed fields, the last of each (draft, pick)."""
    rows = parse(docs, f"draft_id string, pick_no string, round string, draft_slot string, picked_by string, roster_id string, player_id string, is_keeper string, metadata {_TEXT_MAP}", _arrival(docs))
    meta = lambda k: F.col("metadata")[k]
    text = ("first_name", "last_name", "position", "team", "status")
    out = rows.select(
        *_arrival(docs), to_str_or_null("draft_id").alias("draft_id"), to_int_or_null("pick_no").alias("pick_no"), to_int_or_null("round").alias("round"), to_int_or_null("draft_slot").alias("draft_slot"),
        to_str_or_null("picked_by").alias("picked_by"), to_int_or_null("roster_id").alias("roster_id"), to_str_or_null("player_id").alias("player_id"), F.when(F.col("is_keeper").isin("true", "false"), F.col("is_keeper").try_cast("boolean")).alias("is_keeper"),
        *[to_str_or_null(meta(k)).alias(f"player_{k}") for k in text], to_int_or_null(meta("years_exp")).alias("player_years_exp"), to_int_or_null(meta("number")).alias("player_number"), to_str_or_null(meta("injury_status")).alias("player_injury_status"),
        to_int_or_null(meta("news_updated")).alias("player_news_updated_ms"), ms_to_iso(to_int_or_null(meta("news_updated"))).alias("player_news_updated_iso"), to_str_or_null(meta("team_changed_at")).alias("player_team_changed_at"), to_str_or_null(meta("team_abbr")).alias("player_team_abbr"),
    )
    return _drop(keep_last(out, ["draft_id", "pick_no"], _arrival(docs)))


def flatten_traded_draft_picks(docs: DataFrame) -> DataFrame:
    """Traded picks of drafts, the last of each (draft, season, round, roster)."""
    rows = parse(docs, "draft_id string, season string, round string, roster_id string, owner_id string, previous_owner_id string", _arrival(docs))
    out = rows.select(*_arrival(docs), "draft_id", "season", to_int_or_null("round").alias("round"), to_int_or_null("roster_id").alias("roster_id"), to_int_or_null("owner_id").alias("owner_roster_id"), to_int_or_null("previous_owner_id").alias("previous_owner_roster_id"))
    return _drop(keep_last(out, ["draft_id", "season", "round", "roster_id"], _arrival(docs)))


# --- transactions ------------------------------------------------------------------------------------

_PLAYER_FIELDS = ("first_name", "last_name", "position", "team", "number", "status", "injury_status", "years_exp")
_TRADE = {"season": "string", "round": "bigint", "roster_id": "bigint", "previous_owner_id": "bigint", "owner_id": "bigint"}
_TEXTS = "map<string,string>"


def _header(rows: DataFrame, league: Column, api_week: bool) -> DataFrame:
    text = lambda c, none: F.coalesce(F.regexp_replace(_field(c), r"\s", ""), F.lit(none)).alias(c)
    number = lambda c: _field(c, "bigint").alias(c)
    return rows.select(
        _field("transaction_id").alias("transaction_id"), league, *[_field(c).alias(c) for c in ("type", "status")], number("created"), number("status_updated"), _field("creator").alias("creator"), number("leg"), *([number("api_week")] if api_week else []),
        _field("settings.waiver_bid", "bigint").alias("waiver_bid"), _field("settings.seq", "bigint").alias("waiver_seq"), text("waiver_budget", "null"), _field("metadata.notes").alias("metadata_notes"), text("consenter_ids", "[]"), text("roster_ids", "[]"),
    )


def _moves(rows: DataFrame, league: Column) -> DataFrame:
    """Adds and drops of one pass: both maps of a transaction become one list."""
    none = F.create_map().cast(_TEXTS)
    side = lambda c, action: F.transform(F.map_entries(F.coalesce(_field(c, _TEXTS), none)), lambda e: F.struct(e["key"].alias("player_id"), e["value"].try_cast("bigint").alias("roster_id"), F.lit(action).alias("action")))
    both = rows.select(_field("transaction_id").alias("transaction_id"), league, _field("player_map", f"map<string,{_TEXTS}>").alias("_players"), F.explode(F.concat(side("adds", "add"), side("drops", "drop"))).alias("m"))
    info = F.col("_players")[F.col("m.player_id")]
    kinds = {"number": "bigint", "years_exp": "bigint"}
    return both.select("transaction_id", "league_id", "m.*", *[info[k].try_cast(kinds.get(k, "string")).alias(f"player_{k}") for k in _PLAYER_FIELDS])


def _traded(rows: DataFrame, league: Column, element: str) -> DataFrame:
    return rows.select(_field("transaction_id").alias("transaction_id"), league, F.explode(_field("draft_picks", f"array<{element}>")).alias("p"))


def flatten_transactions(docs: DataFrame, league_id: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(headers, player moves, traded picks) of the daily feed.

    Each document is parsed once, into VARIANT, whatever is read from it. Whoever needs several of the
    three tables writes as_variant(docs) as a table first and passes that, so that they share one parse.
    """
    rows, league = as_variant(docs), (_field("league_id") if league_id is None else F.lit(league_id)).alias("league_id")
    picks = _traded(rows, league, "variant").select("transaction_id", "league_id", *[_field(c, kind, "p").alias(c) for c, kind in _TRADE.items()])
    return _header(rows, league, True), _moves(rows, league), picks


def flatten_transactions_bulk(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same of the bulk feed, whose picks are texts `roster,season,round,new owner,previous owner`."""
    rows, league = as_variant(docs), _field("league_id").alias("league_id")
    parts = F.split("p", ",")
    number = lambda i: F.get(parts, F.lit(i)).try_cast("bigint")
    picks = _traded(rows, league, "string")
    picks = picks.select("transaction_id", "league_id", F.col("p").alias("draft_pick_id"), number(0).alias("roster_id"), F.get(parts, F.lit(1)).alias("season"), number(2).alias("round"), number(4).alias("previous_owner_id"), number(3).alias("owner_id"))
    return _header(rows, league, False), _moves(rows, league), picks


def flatten_players(docs: DataFrame, fields: Sequence[str]) -> DataFrame:
    """A dictionary id -> player as a table of text fields with player_id."""
    rows = docs.select(F.explode(F.from_json("doc", f"map<string,{_TEXT_MAP}>")).alias("player_id", "p"))
    return rows.select("player_id", *[F.col("p")[k].alias(k) for k in fields if k != "player_id"])


# --- market feeds ------------------------------------------------------------------------------------

# The variables of a page that hold data as JSON literals, as the pages name them.
PAGE_VARIABLES = {"players": r"(?s)playersArray\s*=\s*(\[.*?\]);", "oneqb": r"(?s)var\s+playerOneQB\s*=\s*(\{.*?\});", "superflex": r"(?s)var\s+playerSuperflex\s*=\s*(\{.*?\});"}


def extract_embedded_json(pages: DataFrame, variable: str, schema: str, html: str = "html") -> tuple[DataFrame, DataFrame]:
    """(pages with the parsed variable as `data`, pages without it): data embedded in page scripts."""
    pattern = PAGE_VARIABLES.get(variable, variable)
    found = pages.withColumn("_json", F.when(F.col(html).rlike(pattern), F.regexp_extract(html, pattern, 1)))
    found = found.withColumn("data", F.from_json("_json", schema))
    bad = F.col("data").isNull()
    return found.where(~bad).drop("_json"), found.where(bad).withColumn("error", F.when(F.col("_json").isNull(), "missing").otherwise("invalid")).drop("_json", "data")


def value_history(docs: DataFrame, scrape_date: str) -> DataFrame:
    """Up to six {d: yymmdd, v} arrays of each asset aligned on the date; the last v of a date holds.

    Picks (position RDP) have no positional ranks. Dates may also be yyyy-mm-dd.
    """
    series = {"one_qb_value": "double", "one_qb_overall_rank": "bigint", "one_qb_pos_rank": "bigint", "sf_value": "double", "sf_overall_rank": "bigint", "sf_pos_rank": "bigint"}
    point = "array<struct<d:string,v:double>>"
    fields = "player_id string, player_name string, position string, slug string, " + ", ".join(f"{s} {point}" for s in series)
    rows = docs.select(F.from_json("doc", fields).alias("d")).select("d.*")  # invalid documents have no points
    ids = ["player_id", "player_name", "position", "slug"]
    # all series leave one generator, so a document is derived and parsed once
    tag = lambda s: F.coalesce(F.transform(s, lambda p, i: F.struct(F.lit(s).alias("_s"), i.alias("_i"), p.alias("_p"))), F.array())
    pick = F.col("position").eqNullSafe(F.lit("RDP"))
    points = F.flatten(F.array(*[F.when(~pick, tag(s)).otherwise(F.array()) if s.endswith("pos_rank") else tag(s) for s in series]))
    tagged = rows.select(*ids, F.explode(points).alias("_e")).select(*ids, "_e.*")
    century = F.when(F.substring("_p.d", 1, 2) >= "69", "19").otherwise("20")  # two-digit years: 1969 to 2068
    day = F.coalesce(F.when(F.length("_p.d") == 6, F.try_to_date(F.concat(century, "_p.d"), "yyyyMMdd")), F.try_to_date("_p.d", "yyyy-MM-dd"))
    last = lambda s: F.max_by(F.when(F.col("_s") == s, F.col("_p.v")), F.when(F.col("_s") == s, F.col("_i")))
    return tagged.groupBy(*ids, day.alias("ranking_date")).agg(*[last(s).cast(t).alias(s) for s, t in series.items()]).withColumn("scrape_date", F.lit(scrape_date).cast("date"))


#: Fields of a format's block in the market page, with their types; and those of its premium blocks.
MARKET = {"startSitValue": "float", "overallTrend": "float", "positionalTrend": "float", "overall7DayTrend": "float", "positional7DayTrend": "float", "kept": "int", "traded": "int", "cut": "int", "diff": "float", "isOutThisWeek": "boolean", "adp": "float", "avgAuctionPercentage": "float", "startupAdp": "float", "startupAvgAuctionPercentage": "float", "rawLiquidity": "float", "stdLiquidity": "float", "tradeCount": "int", "value": "float", "rank": "int", "positionalRank": "int", "overallTier": "int", "positionalTier": "int"}
PREMIUM = ("value", "rank", "positionalRank", "overallTier", "positionalTier")
FORMATS = {"oneqb": "oneQBValues", "sf": "superflexValues"}
TIERS = ("tep", "tepp", "teppp")


def market_types() -> dict[str, str]:
    """Type of every column of flatten_market."""
    out = {"positionID": "int", "isTrending": "boolean"}
    for f in FORMATS:
        out |= {f"{f}_{k}": t for k, t in MARKET.items()} | {f"{f}_{p}_{k}": MARKET[k] for p in TIERS for k in PREMIUM}
    return out


def flatten_market(docs: DataFrame) -> DataFrame:
    """Market players: base fields, 22 fields of each format and 5 of each premium, still as text."""
    block = "struct<" + ",".join(f"{k}:string" for k in MARKET) + "," + ",".join(f"{p}:struct<{','.join(f'{k}:string' for k in PREMIUM)}>" for p in TIERS) + ">"
    rows = parse(docs, "playerName string, playerID string, slug string, position string, positionID string, isTrending string, " + ", ".join(f"{v} {block}" for v in FORMATS.values()))
    columns = [F.col(f"{v}.{k}").alias(f"{f}_{k}") for f, v in FORMATS.items() for k in MARKET] + [F.col(f"{v}.{p}.{k}").alias(f"{f}_{p}_{k}") for f, v in FORMATS.items() for p in TIERS for k in PREMIUM]
    return rows.select("playerName", "playerID", "slug", "position", "positionID", "isTrending", *columns)


def cast_map(df: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Casts the columns that are there; what doesn't fit is null."""
    types = market_types() if types is None else types
    number = lambda c, t: F.col(c).try_cast("double").cast(t) if t == "int" and isinstance(df.schema[c].dataType, T.StringType) else F.col(c).try_cast(t)
    return df.withColumns({c: number(c, t) for c, t in types.items() if c in df.columns})


# Fixed names: fields of the nested value feed and the columns they become.
FEED_PLAYER = {"id": "id", "name": "name", "mflId": "mfl_id", "sleeperId": "sleeper_id", "position": "position", "espnId": "espn_id", "fleaflickerId": "fleaflicker_id", "maybeBirthday": "birthday", "maybeHeight": "height", "maybeWeight": "weight", "maybeCollege": "college", "maybeTeam": "team", "maybeAge": "age", "maybeYoe": "years_exp"}
FEED_ROOT = {"value": "value", "overallRank": "overall_rank", "positionRank": "position_rank", "trend30Day": "trend_30_day", "redraftDynastyValueDifference": "redraft_dynasty_value_difference", "redraftDynastyValuePercDifference": "redraft_dynasty_value_perc_difference", "redraftValue": "redraft_value", "combinedValue": "combined_value", "maybeTier": "tier", "maybeAdp": "adp", "maybeTradeFrequency": "trade_frequency", "maybeMovingStandardDeviation": "moving_std_dev", "maybeMovingStandardDeviationPerc": "moving_std_dev_perc", "maybeMovingStandardDeviationAdjusted": "moving_std_dev_adjusted"}
_FEED_TEXT = ("name", "mflId", "sleeperId", "position", "espnId", "fleaflickerId", "maybeBirthday", "maybeHeight", "maybeCollege", "maybeTeam")


def flatten_value_feed(docs: DataFrame, settings: Sequence[str] = ("n_qb", "n_teams", "ppr")) -> DataFrame:
    """The value feed: player and root fields in 28 columns, and the request's settings, which tell the
    up to 24 rows of a player and day apart."""
    player = "struct<" + ",".join(f"{k}:{'string' if k in _FEED_TEXT else 'double' if k in ('maybeAge', 'maybeWeight') else 'bigint'}" for k in FEED_PLAYER) + ">"
    present = [c for c in settings if c in docs.columns]
    rows = parse(docs, f"player {player}, " + ", ".join(f"{k} double" for k in FEED_ROOT), present)
    return rows.select(*[F.col(f"player.{k}").alias(v) for k, v in FEED_PLAYER.items()], *[F.col(k).alias(v) for k, v in FEED_ROOT.items()], *present)


# --- projection pages --------------------------------------------------------------------------------


class _Table(HTMLParser):
    """Cells of the table with id=data: rows of (text, colspan, link text, link classes, link name)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.head, self.body, self.found = [], [], False
        self.part = self.row = self.cell = self.link = None
        self.depth = 0

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "table" and (self.depth or (a.get("id") == "data" and not self.found)):
            self.depth, self.found = self.depth + 1, True
        if not self.depth:
            return
        if tag in ("thead", "tbody"):
            self.part = self.head if tag == "thead" else self.body
        elif tag == "tr" and self.part is not None:
            self.row = []
            self.part.append(self.row)
        elif tag in ("td", "th") and self.row is not None:
            self.cell = {"text": [], "span": int(a["colspan"]) if str(a.get("colspan", "")).isdigit() else 1, "links": []}
            self.row.append(self.cell)
        elif tag == "a" and self.cell is not None:
            self.link = {"classes": (a.get("class") or "").split(), "name": a.get("fp-player-name"), "text": []}
            self.cell["links"].append(self.link)

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            self.depth -= 1
        elif tag in ("thead", "tbody"):
            self.part = self.row = self.cell = None
        elif tag in ("td", "th", "tr"):
            self.cell = self.link = None
        elif tag == "a":
            self.link = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell["text"].append(data.strip())
            if self.link is not None:
                self.link["text"].append(data.strip())


def stat_key(group: str, stat: str) -> str:
    """`group_stat` in small letters and single underscores; player and fpts have no group."""
    if stat.lower() in ("player", "fpts"):
        return stat.lower()
    return re.sub(r"[^a-z0-9]+", "_", f"{group} {stat}".strip().lower()).strip("_")


def _page(html: str | None) -> tuple[str, list[str], list[dict]]:
    table = _Table()
    table.feed(html or "")
    text = lambda c: "".join(c["text"])
    if not table.found:
        return "empty", [], []
    if not table.head:
        return "parse_fail", [], []
    labels = [text(c) for c in table.head[1 if len(table.head) > 1 else 0]]
    groups = [text(c) for c in table.head[0] for _ in range(c["span"])] if len(table.head) > 1 else []
    keys = [stat_key(g, s) for g, s in zip(groups + [""] * len(labels), labels, strict=False)]
    if not keys or keys[0] != "player" or "fpts" not in keys:
        return "parse_fail", keys, []
    rows = []
    for cells in table.body:
        if len(cells) <= 1:
            continue
        if len(cells) != len(keys):
            return "parse_fail", keys, rows
        link = next((x for x in cells[0]["links"] if "fp-player-link" in x["classes"]), cells[0]["links"][0] if cells[0]["links"] else None)
        shown = "".join(link["text"]) if link else ""
        name = (link["name"] or shown) if link else text(cells[0])
        if not name:
            continue
        id_ = next((m[1] for c in (link["classes"] if link else []) if (m := re.fullmatch(r"fp-id-(\d+)", c))), None)
        team = (text(cells[0]).replace(shown, "", 1).strip() or None) if link else None
        rows.append({"fp_id": id_, "player": name, "team": team, "stats": {k: text(c) for k, c in zip(keys[1:], cells[1:], strict=True)}})
    return ("ok" if rows else "empty"), keys, rows


def parse_projection_pages(pages: DataFrame, keep: Sequence[str], html: str = "html") -> DataFrame:
    """keep, status (ok, empty, parse_fail), keys and rows of each page's projection table.

    The header decides the columns; a row of another width fails the page instead of being guessed.
    """
    kind = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parsed = [_page(h) for h in batch[html]]
            out = batch[list(keep)].copy()
            out["status"], out["keys"], out["rows"] = ([p[i] for p in parsed] for i in range(3))
            yield out

    return pages.select(*keep, html).mapInPandas(run, f"{kind}, status string, keys array<string>, rows array<struct<fp_id:string,player:string,team:string,stats:map<string,string>>>")


def projection_rows(parsed: DataFrame, keep: Sequence[str]) -> DataFrame:
    """keep, player fields, stat and value: a row for each number of the parsed pages."""
    rows = parsed.where("status = 'ok'").select(*keep, F.explode("rows").alias("r"))
    return rows.select(*keep, "r.fp_id", "r.player", "r.team", F.explode("r.stats").alias("stat", "_v")).select(*keep, "fp_id", "player", "team", "stat", to_float_or_null("_v").alias("value"))


def header_drift(parsed: DataFrame, by: str = "position") -> DataFrame:
    """Distinct header layouts of each position and their number."""
    layouts = parsed.where("status != 'empty'").groupBy(by).agg(F.sort_array(F.collect_set(F.array_join("keys", ","))).alias("layouts"))
    return layouts.withColumn("n_layouts", F.size("layouts"))


def assemble_projections(tables: dict[str, DataFrame], season: int, week: int | None, scoring: str) -> DataFrame:
    """Positions with differing columns in one table, stamped with season, week, position and scoring."""
    stamp = lambda p, df: df.withColumns({"season": F.lit(season), "week": F.lit(week).cast("int"), "position": F.lit(p), "scoring": F.lit(scoring)})
    return union_by_name(*[stamp(p, df) for p, df in tables.items()])


# --- crawl rows and history --------------------------------------------------------------------------


def nested_to_text(df: DataFrame, scalars: Sequence[str], nested: Sequence[str]) -> DataFrame:
    """Scalar columns, and nested ones as JSON text (null stays null)."""
    return df.select(*scalars, *[F.to_json(c).alias(c) for c in nested])


def crawl_league_rows(docs: DataFrame) -> DataFrame:
    """Leagues as crawl rows: scalars, and settings, scoring and positions as JSON text."""
    rows = parse(docs, "league_id string, name string, season string, season_type string, sport string, status string, total_rosters bigint, previous_league_id string, draft_id string, settings string, scoring_settings string, roster_positions string")
    return rows


def crawl_roster_rows(docs: DataFrame) -> DataFrame:
    """Rosters as crawl rows: scalars, and lists and settings as JSON text."""
    return parse(docs, "league_id string, roster_id bigint, owner_id string, co_owners string, players string, starters string, reserve string, taxi string, keepers string, settings string")


def text_to_nested(df: DataFrame, column: str, schema: str, out: str) -> DataFrame:
    """JSON text to nested values; text that is no such JSON gives null."""
    return df.withColumn(out, F.from_json(column, schema))


#: Entities of a history document: array field -> {column: field}; brackets and picks are apart.
HISTORY = {
    "matchups": ("week", "roster_id", "matchup_id", "points", "custom_points", "players", "starters", "players_points", "starters_points"),
    "transactions": ("leg", "transaction_id", "type", "status", "created", "roster_ids", "consenter_ids", "adds", "drops", "draft_picks", "waiver_budget", "settings", "metadata"),
    "rosters": ("roster_id", "owner_id", "co_owners", "players", "starters", "reserve", "taxi", "keepers", "settings"),
    "users": ("user_id", "display_name", "avatar", "is_owner", "metadata"),
    "traded_picks": ("season", "round", "roster_id", "previous_owner_id", "owner_id"),
    "drafts": ("draft_id", "type", "status", "start_time", "settings", "metadata", "draft_order", "slot_to_roster_id"),
    "draft_picks": ("draft_id", "pick_no", "round", "draft_slot", "roster_id", "player_id", "picked_by", "is_keeper", "metadata"),
}
_BRACKET = {"r": "round", "m": "match_id", "t1": "t1", "t2": "t2", "w": "w", "l": "l", "p": "p", "t1_from": "t1_from", "t2_from": "t2_from"}
REGULAR_WEEKS = 18


def last_regular_week(playoff_start: Column) -> Column:
    """The week before the playoffs (week 15 if unset), from 1 to REGULAR_WEEKS."""
    return F.least(F.greatest(F.coalesce(playoff_start, F.lit(15)) - 1, F.lit(1)), F.lit(REGULAR_WEEKS))


def harvest_tables(docs: DataFrame, lineage: DataFrame) -> dict[str, DataFrame]:
    """The nine history tables of league-season documents, each row with its league_lineage_id.

    A document has the league's header, settings and an array for each entity. Nested values are JSON
    text. Matchups after the last regular week are left out. lineage: (league_id, league_lineage_id).
    """
    fields = "league_id string, season string, name string, sport string, status string, total_rosters bigint, previous_league_id string, draft_id string, bracket_id string, loser_bracket_id string, settings string, scoring_settings string, roster_positions string"
    arrays = ", ".join(f"{e} array<{_TEXT_MAP}>" for e in [*HISTORY, "winners_bracket", "losers_bracket"])
    # without the hint the documents themselves are broadcast: by estimate a parsed one is smaller than its text, which counts as 20 bytes
    names = lineage.select("league_id", "league_lineage_id").distinct().hint("shuffle_hash")
    rows = parse(docs, f"{fields}, {arrays}").join(names, "league_id")
    setting = lambda k: F.get_json_object("settings", f"$.{k}").try_cast("bigint")
    head = ["league_id", "season"]
    out = {"season_meta": rows.select(*head, *[f.split()[0] for f in fields.split(", ")[2:10]], *[setting(k).alias(k) for k in ("playoff_week_start", "playoff_teams", "num_teams")], "settings", "scoring_settings", "roster_positions", "league_lineage_id")}
    for entity, columns in HISTORY.items():
        each = rows.withColumn("_last", last_regular_week(setting("playoff_week_start"))).select(*head, "_last", "league_lineage_id", F.explode(entity).alias("e"))
        name = lambda c, e=entity: "pick_season" if e == "traded_picks" and c == "season" else c
        table = each.select(*head, *[F.col("e")[c].alias(name(c)) for c in columns], "league_lineage_id", "_last")
        out[entity] = (table.where(F.col("week").try_cast("int") <= F.col("_last")) if entity == "matchups" else table).drop("_last")
    sides = [rows.select(*head, "league_lineage_id", F.lit(kind).alias("bracket"), F.explode(f"{kind}_bracket").alias("e")) for kind in ("winners", "losers")]
    out["brackets"] = sides[0].union(sides[1]).select(*head, "bracket", *[F.col("e")[k].alias(v) for k, v in _BRACKET.items()], "league_lineage_id")
    return out
