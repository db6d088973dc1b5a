"""Precedence overlays, reconciliation with quarantine, and conservation checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.operators.dedupe import keep_first, keep_last


def overlay(base: DataFrame, sources: Sequence[tuple[DataFrame, str, str]], key: Sequence[str], owner: str = "owner", names: Sequence[str] | None = None) -> DataFrame:
    """Base rows with the owner of the first source that has the key; else their own.

    sources: (frame, time column, owner column), the strongest first. Within a source the last row of a
    key by time holds. `owner_source` says where the owner comes from.
    """
    names = names or [f"source_{i + 1}" for i in range(len(sources))]
    ranked = None
    for i, (frame, ts, own) in enumerate(sources):
        part = keep_last(frame.select(*key, F.col(ts).cast("double").alias("_ts"), F.col(own).alias("_owner")).where("_owner IS NOT NULL"), key, ["_ts"]).withColumns({"_rank": F.lit(i), "_name": F.lit(names[i])})
        ranked = part if ranked is None else ranked.unionByName(part)
    best = keep_first(ranked, key, ["_rank"]).select(*key, "_owner", "_name")
    out = base.join(best, list(key), "left")
    return out.withColumns({owner: F.coalesce("_owner", owner), "owner_source": F.coalesce("_name", F.lit("base"))}).drop("_owner", "_name").select(*base.columns, "owner_source")


def duplicate_owners(membership: DataFrame, asset: Sequence[str], owner: str) -> DataFrame:
    """Assets with more than one owner; a null owner counts as one."""
    n = F.countDistinct(owner) + F.max(F.col(owner).isNull().cast("int"))
    return membership.groupBy(*asset).agg(n.alias("n_owners")).where("n_owners > 1")


def reconcile(players: DataFrame, picks: DataFrame, leagues: DataFrame, owner: str = "franchise_id") -> tuple[DataFrame, DataFrame]:
    """(fact, quarantine) of player and pick membership.

    Assets with several owners (duplicate_ownership) and assets without one (unresolved_franchise) leave
    the fact as a whole; players without a player_key (unmapped_player) are listed and stay. Leagues that
    are not in `leagues` are left out of both. The quarantine is the log: one row for each reason.
    """
    both = players.unionByName(picks, allowMissingColumns=True).join(leagues.select("league_id").distinct(), "league_id", "left_semi")
    asset = ["league_id", "asset_type", "asset_id"]
    nobody = F.max(F.col(owner).isNull())
    marks = both.groupBy(*asset).agg((F.countDistinct(owner) + nobody.cast("int") > 1).alias("_twice"), nobody.alias("_nobody"))
    marked = both.join(marks, asset)
    reasons = F.array(
        F.when(F.col("_twice"), "duplicate_ownership"),
        F.when(F.col(owner).isNull(), "unresolved_franchise"),
        F.when((F.col("asset_type") == "PLAYER") & F.col("player_key").isNull(), "unmapped_player"),
    )
    listed = marked.withColumn("reason", F.explode(F.array_compact(reasons)))
    return marked.where("NOT _twice AND NOT _nobody").select(*both.columns), listed.select(*both.columns, "reason")


def conservation(picks: DataFrame, expected: DataFrame, group: Sequence[str], by: str, size: str) -> DataFrame:
    """Groups of picks with their count, the expected one and whether they agree."""
    n = picks.groupBy(by, *group).agg(F.count("*").alias("n_picks"))
    return n.join(expected.select(by, F.col(size).cast("long").alias("n_expected")), by, "left").withColumn("ok", F.col("n_picks").eqNullSafe(F.col("n_expected")))
