"""Alignment of several price feeds into long and wide value tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.operators.dedupe import keep_first, precedence_union

# The four value columns of the wide feed with the formats they stand for.
VALUE_COLUMNS = {"oneqb_value": ("1QB", "Standard"), "oneqb_tep_value": ("1QB", "TEP"), "sf_value": ("SF", "Standard"), "sf_tep_value": ("SF", "TEP")}
# Round words of pick names.
ROUND_WORDS = {"1st": 1, "2nd": 2, "3rd": 3, "4th": 4}
# Fixed pattern: names that stand for picks.
PICK_NAME = "(?i)pick|round|1st|2nd|3rd|4th|20[2-9][0-9]"
# Fixed names: columns of the long pick layout, and its key.
LONG = ("valuation_date", "season", "round", "tier", "market_type", "qb_format", "te_premium", "value")
PICK_KEY = ("valuation_date", "season", "round", "tier", "market_type", "qb_format", "te_premium")


def asset_type(name: str | Column) -> Column:
    return F.when((F.col(name) if isinstance(name, str) else name).rlike(PICK_NAME), "PICK").otherwise("PLAYER")


def unpivot_values(df: DataFrame, index: Sequence[str], columns: dict[str, tuple[str, str]] = VALUE_COLUMNS) -> DataFrame:
    """The value columns that are there, as rows with qb_format, te_premium and value; nulls go."""
    present = [c for c in columns if c in df.columns]
    long = df.select(*index, *[F.col(c).cast("double").alias(c) for c in present]).unpivot(list(index), present, "_column", "value").where("value IS NOT NULL")
    pick = lambda i: F.coalesce(*[F.when(F.col("_column") == c, columns[c][i]) for c in present])
    return long.select(*index, pick(0).alias("qb_format"), pick(1).alias("te_premium"), "value")


def melt_values(df: DataFrame, market_type: str, source: str = "wide_feed") -> DataFrame:
    """The wide feed (valuation_date, slug, playerName, value columns) in the long staging layout.

    The whole slug is the source_id (trailing_id cuts it later) and every row counts as a player's."""
    long = unpivot_values(df, ["valuation_date", "slug", "playerName"])
    return long.select("valuation_date", F.lit(source).alias("source_system"), F.col("slug").cast("string").alias("source_id"), F.col("playerName").alias("asset_name"), F.lit("PLAYER").alias("asset_type"), F.lit(market_type).alias("market_type"), "qb_format", "te_premium", "value")


def standardize_simple(df: DataFrame, source: str, market: str, qb_format: str, te_premium: str, value: str, id: str = "id", name: str = "name", date: str = "valuation_date") -> DataFrame:
    """A feed with one value column in the long staging layout."""
    return df.select(F.col(date).alias("valuation_date"), F.lit(source).alias("source_system"), F.col(id).cast("string").alias("source_id"), F.col(name).alias("asset_name"), asset_type(name).alias("asset_type"), F.lit(market).alias("market_type"), F.lit(qb_format).alias("qb_format"), F.lit(te_premium).alias("te_premium"), F.col(value).cast("double").alias("value"))


def trailing_id(slug: str | Column) -> Column:
    """The number after the last dash of a slug, null if it isn't one."""
    return F.element_at(F.split(F.col(slug) if isinstance(slug, str) else slug, "-"), -1).try_cast("bigint")


def unique_names(players: DataFrame, name: str = "name") -> DataFrame:
    """Players whose name no other player has."""
    single = players.where(F.col(name).isNotNull()).groupBy(name).count().where("count = 1").select(name)
    return players.join(single, name, "left_semi")


def resolve_and_split(staging: DataFrame, players: DataFrame, id_source: str, name_source: str) -> tuple[DataFrame, DataFrame]:
    """(rows with player_id, quarantine). One source is joined by its id, the other by unique names.

    The quarantine has each unmapped (source_system, name) once; a missing name is replaced by the id.
    """
    by_id = keep_first(players.where("ktc_id IS NOT NULL"), ["ktc_id"], []).select(F.col("ktc_id").cast("string").alias("source_id"), F.col("player_id").alias("_by_id"))
    by_name = unique_names(players).select(F.col("name").alias("asset_name"), F.col("player_id").alias("_by_name"))
    joined = staging.join(by_id, "source_id", "left").join(by_name, "asset_name", "left")
    player = F.when(F.col("source_system") == id_source, F.col("_by_id")).when(F.col("source_system") == name_source, F.col("_by_name"))
    joined = joined.withColumn("player_id", player).select(*staging.columns, "player_id")
    lost = joined.where("player_id IS NULL").select("source_system", F.coalesce("asset_name", "source_id").alias("asset_name")).distinct()
    return joined.where("player_id IS NOT NULL"), lost


def build_fact(valid: DataFrame, sources: dict[str, str]) -> DataFrame:
    """Wide by source: one value column for each of `sources` (system -> column), 0 where there is none,
    and value_diff = first - second. Several rows of a key and source: the greatest value."""
    keys = ["valuation_date", "player_id", "market_type", "qb_format", "te_premium"]
    wide = valid.groupBy(*keys).pivot("source_system", list(sources)).agg(F.max("value"))
    first, second = list(sources.values())[:2]
    return wide.select(*keys, *[F.coalesce(F.col(f"`{s}`").cast("double"), F.lit(0.0)).alias(c) for s, c in sources.items()]).withColumn("value_diff", F.col(first) - F.col(second))


def _round(word: Column) -> Column:
    return F.coalesce(*[F.when(word == w, F.lit(n)) for w, n in ROUND_WORDS.items()]).cast("long")


def _parsed(df: DataFrame, name: str, pattern: str, groups: dict[str, int]) -> DataFrame:
    """Rows whose name matches, with the groups season, round and tier as columns."""
    hit = df.where(F.col(name).rlike(pattern))
    got = {k: F.regexp_extract(name, pattern, i) for k, i in groups.items()}
    out = {"season": got["season"].cast("long"), "round": _round(got["round"]), "tier": got.get("tier", F.lit("NA"))}
    return hit.withColumns(out)


def parse_season_tier_round(df: DataFrame, name: str = "playerName") -> DataFrame:
    """Names like `2026 Early 1st`, unpivoted over the value columns that are there."""
    hit = _parsed(df, name, r"^(20\d{2})\s+(Early|Mid|Late)\s+(1st|2nd|3rd|4th)$", {"season": 1, "tier": 2, "round": 3})
    long = unpivot_values(hit.withColumn("valuation_date", F.col("valuation_date").cast("string")), ["valuation_date", "season", "round", "tier"])
    return long.withColumn("market_type", F.lit("DYNASTY")).select(*LONG)


def _constant(df: DataFrame, date: Column) -> DataFrame:
    return df.withColumns({"valuation_date": date, "market_type": F.lit("DYNASTY"), "qb_format": F.lit("SF"), "te_premium": F.lit("Standard"), "value": F.col("value").cast("double")}).select(*LONG)


def parse_tier_season_round(df: DataFrame, max_date: str, name: str = "display_name") -> DataFrame:
    """Names like `Early 2026 1st` of an archive; rows dated after max_date are errors and go."""
    hit = _parsed(df, name, r"^(Early|Mid|Late)\s+(20\d{2})\s+(1st|2nd|3rd|4th)$", {"tier": 1, "season": 2, "round": 3})
    return _constant(hit, F.col("date").cast("date").cast("string")).where(F.col("valuation_date") <= max_date)


def parse_round_generic(df: DataFrame, name: str = "name") -> DataFrame:
    """PICK rows with names like `2026 1st` (tier NA); exact slots are left out."""
    hit = _parsed(df.where("position = 'PICK'"), name, r"^(20\d{2})\s+(1st|2nd|3rd|4th)$", {"season": 1, "round": 2})
    return _constant(hit, F.col("valuation_date").cast("string"))


def build_pick_values(*feeds: DataFrame) -> DataFrame:
    """Feeds by precedence: a later one only adds keys that those before lack."""
    return precedence_union(feeds, PICK_KEY).select(*LONG)


def parse_exact_slot(df: DataFrame, name: str = "name", date: str = "load_date") -> DataFrame:
    """PICK rows named `2026 Pick 1.09`: season, round, slot, valuation_date, value."""
    pattern, text = r"^(\d{4})\s+Pick\s+(\d+)\.(\d+)$", F.trim(name)
    hit = df.where((F.col("position") == "PICK") & text.rlike(pattern))
    return hit.select(F.regexp_extract(text, pattern, 1).alias("season"), F.regexp_extract(text, pattern, 2).cast("long").alias("round"), F.regexp_extract(text, pattern, 3).cast("long").alias("slot"), F.col(date).cast("date").alias("valuation_date"), F.col("value").cast("long").alias("value"))


def parse_round_rows(df: DataFrame, name: str = "name", date: str = "load_date") -> DataFrame:
    """PICK rows named `2027 1st`: season, round, valuation_date, value."""
    pattern, text = r"^(\d{4})\s+(1st|2nd|3rd|4th)$", F.trim(name)
    hit = df.where((F.col("position") == "PICK") & text.rlike(pattern))
    return hit.select(F.regexp_extract(text, pattern, 1).alias("season"), _round(F.regexp_extract(text, pattern, 2)).alias("round"), F.col(date).cast("date").alias("valuation_date"), F.col("value").cast("long").alias("value"))


def value_lens(df: DataFrame, value: str, market: str = "DYNASTY", qb_format: str = "SF", te_premium: str = "Standard", id: str = "player_id") -> DataFrame:
    """One market, format and premium as (id, valuation_date, value); unpriced rows (0) go."""
    chosen = df.where((F.col("market_type") == market) & (F.col("qb_format") == qb_format) & (F.col("te_premium") == te_premium) & (F.col(value) > 0))
    return chosen.select(id, F.col("valuation_date").cast("date").alias("valuation_date"), F.col(value).alias("value"))


def era_blend(preferred: DataFrame, fallback: DataFrame, date: str = "valuation_date") -> DataFrame:
    """The preferred series from its first date on, the fallback before."""
    first = preferred.agg(F.min(date).alias("_first"))
    early = fallback.crossJoin(F.broadcast(first)).where(F.col("_first").isNull() | (F.col(date) < F.col("_first"))).drop("_first")  # one row
    return preferred.unionByName(early.select(*preferred.columns))


def carry_forward(series: DataFrame, seasons: int = 2, season: str = "season", date: str = "valuation_date") -> DataFrame:
    """Adds proxies for classes that aren't priced yet: the k-th class after the furthest one has the
    furthest one's history, k years later."""
    furthest = series.agg(F.max(F.col(season).cast("int")).alias("_last"))
    base = series.crossJoin(F.broadcast(furthest)).where(F.col(season).cast("int") == F.col("_last")).drop("_last")  # one row
    ahead = base.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(seasons)))) if seasons > 0 else base.withColumn("_k", F.lit(0)).limit(0)
    kind = series.schema[season].dataType
    ahead = ahead.withColumns({season: (F.col(season).cast("int") + F.col("_k")).cast(kind), date: F.add_months(date, F.col("_k") * 12)})
    return series.unionByName(ahead.drop("_k").select(*series.columns))


def tier_proxy(picks: DataFrame, source: str, tiers: dict[str, str]) -> DataFrame:
    """Rows of the tier that stands for a whole round in this source; an unknown source is an error."""
    if source not in tiers:
        raise ValueError(f"unknown value source {source!r}; known: {sorted(tiers)}")
    return picks.where(F.col("tier") == tiers[source])


def rookie_selections(drafts: DataFrame, picks: DataFrame, startup_rounds: int = 7) -> DataFrame:
    """Selections of all drafts; is_startup if the draft has more than startup_rounds rounds."""
    d = keep_first(drafts, ["draft_id"], []).select("draft_id", F.col("season").cast("long").alias("season"))
    p = keep_first(picks.select("draft_id", F.col("round").cast("long").alias("round"), F.col("pick_no").cast("long").alias("pick_no"), F.col("player_id").cast("string").alias("player_id"), F.col("draft_slot").cast("long").alias("draft_slot")), ["draft_id", "pick_no"], [])
    rounds = p.groupBy("draft_id").agg(F.max("round").alias("_rounds"))
    return p.join(d, "draft_id").join(rounds, "draft_id", "left").select("season", "round", "pick_no", "draft_slot", "player_id", "draft_id", (F.col("_rounds") > startup_rounds).alias("is_startup"))


def link_by_unique_name(left: DataFrame, players: DataFrame, name: str = "name", id: str = "player_id") -> tuple[DataFrame, DataFrame]:
    """(left rows with the id of the only player of that name, names not found or ambiguous)."""
    linked = left.join(unique_names(players, name).select(name, F.col(id).alias("_id")), name, "left")
    return linked.where("_id IS NOT NULL").withColumnRenamed("_id", id), linked.where("_id IS NULL").select(name).distinct()


def enrich_ids(players: DataFrame, feed: DataFrame, key: str = "gsis_id") -> tuple[DataFrame, DataFrame]:
    """(players with ids filled from the feed, feed rows without a player). Own ids win."""
    new = keep_first(feed.where(F.col(key).isNotNull()), [key], [])
    shared = [c for c in new.columns if c != key and c in players.columns]
    added = [c for c in new.columns if c != key and c not in players.columns]
    joined = players.join(new.withColumnsRenamed({c: f"_new_{c}" for c in shared}), key, "left")
    filled = joined.select(*[F.coalesce(c, f"_new_{c}").alias(c) if c in shared else F.col(c) for c in players.columns], *added)
    return filled, new.join(players, key, "left_anti")


def search_name(players: DataFrame, text: str, name: str = "name") -> DataFrame:
    """Players whose name contains the text, in any case; %, _ and backslashes count as themselves."""
    return players.where(F.contains(F.lower(name), F.lit(text.lower())))
