"""Conformed dimensions: leagues, settings, players, users, franchises."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.operators.dedupe import keep_first, keep_last, merge_full_and_incremental
from stintlake.operators.graph import backfill_lineage, current_per_lineage

LEAGUE_COLUMNS = ("league_id", "league_lineage_id", "league_name", "season", "status", "season_type", "total_rosters", "draft_id", "bracket_id", "leg", "last_scored_leg", "previous_league_id", "is_original", "is_active")
#: Fixed names: position counts of the source and the slot columns they become.
SLOTS = {"QB": "qb_slots", "RB": "rb_slots", "WR": "wr_slots", "TE": "te_slots", "FLEX": "flex_slots", "SUPER_FLEX": "superflex_slots", "BN": "bench_slots", "TAXI": "taxi_slots", "IR": "ir_slots", "K": "k_slots", "DEF": "def_slots"}
#: Columns that change weekly and would bloat the history.
CHURN = ("leg", "last_scored_leg")


def dim_leagues_meta(full: DataFrame, incremental: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """One row a league-season: merged feeds, lineage filled from predecessors, flags, fixed columns.

    is_original: the lineage's first league; is_active: not complete. Missing columns become null.
    """
    df = merge_full_and_incremental(full, incremental, "league_id", ["league_lineage_id"])
    if "league_lineage_id" not in df.columns:
        df = df.withColumn("league_lineage_id", F.lit(None).cast("string"))
    df = backfill_lineage(df)
    if status is not None:
        fresh = status.select("league_id", F.col("status").alias("_status")).dropDuplicates(["league_id"])
        df = df.join(fresh, "league_id", "left").withColumn("status", F.coalesce("_status", "status") if "status" in df.columns else F.col("_status")).drop("_status")
    df = df.withColumn("is_original", F.col("league_id") == F.col("league_lineage_id")).withColumn("is_active", F.coalesce(F.col("status") != "complete", F.lit(True)))
    for c in LEAGUE_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df.select(*LEAGUE_COLUMNS)


def league_constitution(scoring: tuple[DataFrame, DataFrame], slots: tuple[DataFrame, DataFrame], settings: tuple[DataFrame, DataFrame], key: str = "league_id", lineage: str = "league_lineage_id") -> DataFrame:
    """Scoring, roster slots and settings of each league in one row; each pair is (full, incremental)."""
    base, counts, rules = (merge_full_and_incremental(a, b, key, [lineage]) for a, b in (scoring, slots, settings))
    counts = counts.withColumnsRenamed({k: v for k, v in SLOTS.items() if k in counts.columns})
    counts = counts.withColumns({v: F.coalesce(F.col(v), F.lit(0)).cast("long") for v in SLOTS.values() if v in counts.columns})
    rules = rules.drop(*CHURN, lineage)
    clash = set(base.columns) & (set(counts.columns) | set(rules.columns)) - {key, lineage}
    return base.drop(*clash).join(counts.drop(lineage), key, "left").join(rules.drop(*(set(counts.columns) - {key})), key, "left")


def dim_players_master(players: DataFrame, ids: DataFrame, bio: DataFrame) -> DataFrame:
    """Players with the id bridge (first row of a sleeper_id) and biography (first row of a gsis_id).

    Names, avatar and draft year take the first source that has them; without a draft year it is the birth
    year + 22.
    """
    bridge = keep_first(ids.where("sleeper_id IS NOT NULL"), ["sleeper_id"], []).select(F.col("sleeper_id").cast("string").alias("player_id"), F.col("gsis_id").alias("_gsis"), "ktc_id", "espn_id", F.col("name").alias("_bridge_name"), F.col("draft_year").alias("_bridge_year"))
    life = keep_first(bio.where("gsis_id IS NOT NULL"), ["gsis_id"], []).select(F.col("gsis_id").alias("_gsis"), F.col("display_name").alias("_bio_name"), "headshot", F.col("draft_year").alias("_bio_year"), F.col("birth_date").alias("_bio_birth"))
    df = players.join(bridge, "player_id", "left").join(life, "_gsis", "left")
    full = F.nullif(F.trim(F.concat_ws(" ", "first_name", "last_name")), F.lit(""))
    born = F.coalesce(F.col("birth_date").cast("string"), F.col("_bio_birth").cast("string"))
    year = F.coalesce(F.col("_bio_year").try_cast("int"), F.col("_bridge_year").try_cast("int"), F.substring(born, 1, 4).try_cast("int") + 22)
    own = [c for c in players.columns if c not in ("birth_date", "avatar")]
    avatar = F.coalesce("headshot", "avatar") if "avatar" in players.columns else F.col("headshot")
    return df.select(*own, born.alias("birth_date"), F.coalesce(full, "_bio_name", "_bridge_name").alias("name"), avatar.alias("avatar"), year.alias("draft_year"), F.col("_gsis").alias("gsis_id"), "ktc_id", "espn_id", F.col("player_id").alias("player_key"))


def dim_users(users: DataFrame, names: DataFrame, order: Sequence[str] = ("timestamp",)) -> DataFrame:
    """One row a user (the last by order); the name is the real one, the shown one, or Unknown."""
    last = keep_last(users, ["user_id"], [o for o in order if o in users.columns])
    real = keep_first(names, ["user_id"], []).select("user_id", F.nullif(F.trim("real_name"), F.lit("")).alias("real_name"))
    return last.join(real, "user_id", "left").select("user_id", "display_name", "avatar", "real_name", F.coalesce("real_name", "display_name", F.lit("Unknown")).alias("name"))


def dim_franchises_meta(rosters: DataFrame, leagues: DataFrame, users: DataFrame) -> DataFrame:
    """Lineage x roster with a stable id and the current owner's name; ownerless ones are orphans."""
    current = current_per_lineage(leagues)
    df = rosters.select("league_id", "roster_id", "owner_id").join(current.select("league_id", "league_lineage_id"), "league_id")
    named = df.join(users.select(F.col("user_id").alias("owner_id"), F.col("name").alias("_name")), "owner_id", "left")
    return named.select(
        F.concat_ws("_", "league_lineage_id", F.col("roster_id").cast("string")).alias("franchise_id"), "league_lineage_id", "league_id", "roster_id", "owner_id",
        F.coalesce("_name", F.format_string("Orphan Roster %d", F.col("roster_id"))).alias("franchise_name"), F.col("owner_id").isNull().alias("is_orphan"),
    )
