"""Lineages (chains of predecessor pointers) and bipartite frontiers, as equi-joins."""

from __future__ import annotations

import tempfile
import uuid
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NullType


#: One node in RULERS is a ruler: chains are first walked to the next ruler, then over rulers only.
RULERS = 8


def _contract(state: DataFrame, rounds: int = 60, counts: list[int] | None = None) -> DataFrame:
    """Pointer doubling in which settled nodes leave: state has (n, at, depth, settled), settled rows being
    what others may end at. Returns the settled rows; those that never settle (cycles, or pointers to what
    isn't in state) are left out. counts, if given, gets the number of rows that each round starts with.
    """
    state = _cut(state)
    total, settled, active = state.count(), state.where("settled"), state.where("NOT settled")
    left = active.count()
    for k in range(rounds):
        if not left or 2**k > total:  # a pointer that is longer than all nodes goes round a cycle
            break
        if counts is not None:
            counts.append(left)
        ahead = settled.unionByName(active).select(F.col("n").alias("at"), F.col("at").alias("_at"), F.col("depth").alias("_depth"), F.col("settled").alias("_settled"))
        moved = _cut(active.join(ahead, "at").select("n", F.col("_at").alias("at"), (F.col("depth") + F.col("_depth")).alias("depth"), F.col("_settled").alias("settled")))
        settled, active = settled.unionByName(moved.where("settled")), moved.where("NOT settled")
        left = active.count()
    return settled


def walk_back(nodes: DataFrame, id: str = "league_id", prev: str = "previous_league_id", counts: list[int] | None = None) -> DataFrame:
    """(id, root, depth): the end of each node's chain of predecessors, and the steps to it.

    List contraction: each node walks to the next ruler (one node in RULERS, chosen by hash, and all ends)
    by pointer doubling, and leaves when it is there, so each round has fewer rows. Chains are then walked
    over the rulers only, and one join gives every node its ruler's end. A predecessor that is not a node,
    is null, blank or '0' ends the chain. A node that reaches a cycle has a null root (no end).
    """
    key = nodes.select(F.col(id).cast("string").alias("n"), F.col(prev).cast("string").alias("p")).distinct()
    known = key.select(F.col("n").alias("p"), F.lit(True).alias("_known")).distinct()
    step = key.join(known, "p", "left").select("n", F.when(F.col("_known") & ~F.col("p").isin("", "0"), F.col("p")).alias("p"))
    ruler = lambda c: F.pmod(F.xxhash64(c), F.lit(RULERS)) == 0
    start = step.select("n", F.coalesce("p", "n").alias("at"), F.col("p").isNotNull().cast("long").alias("depth"), (F.col("p").isNull() | ruler("p")).alias("settled"))
    near = _contract(start, counts=counts)
    # an end is its own ruler, at depth 0
    rulers = near.where(ruler("n") | (F.col("depth") == 0)).withColumn("settled", F.col("depth") == 0)
    # a pointer at a ruler that is no end goes on; one at an end is resolved by the end's own row
    far = _contract(rulers, counts=counts).select(F.col("n").alias("at"), F.col("at").alias("root"), F.col("depth").alias("_depth"))
    ends = near.join(far, "at").select("n", "root", (F.col("depth") + F.col("_depth")).alias("depth"))
    return key.select("n").distinct().join(ends, "n", "left").select(F.col("n").alias(id), "root", "depth")


_own: list[str] = []


def _cut(df: DataFrame) -> DataFrame:
    """Cuts lineage by a table in the shared folder spark.checkpoint.dir (a temporary one only in tests).
    A table's size is known, while the estimates of a plan multiply with each join of a loop."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="stintlake-"))
        base = _own[0]
    path = f"{base}/stintlake-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def backfill_lineage(leagues: DataFrame, rounds: int = 12, id: str = "league_id", prev: str = "previous_league_id", lineage: str = "league_lineage_id", counts: list[int] | None = None) -> DataFrame:
    """A null lineage takes that of the nearest predecessor which has one, at most `rounds` steps away; else
    the league itself. Only leagues without a lineage are walked, and leave when they have met one. An id
    with several lineages has the least; its predecessor, if it has none, is the least too. The leagues are
    read three times, so they are stored first (but for columns without a type, which no table can hold)."""
    if not any(isinstance(f.dataType, NullType) for f in leagues.schema.fields):
        leagues = _cut(leagues)
    ids = leagues.groupBy(F.col(id).alias("n")).agg(F.min(lineage).alias("_own"), F.min(prev).alias("_prev")).where("n IS NOT NULL AND (_own IS NOT NULL OR _prev IS NOT NULL)")
    ids = _cut(ids)
    has = F.col("_own").isNotNull()
    start = ids.select("n", F.when(has, F.col("n")).otherwise(F.col("_prev")).alias("at"), F.when(has, 0).otherwise(1).cast("long").alias("depth"), has.alias("settled"))
    found = _contract(start, max(rounds - 1, 1).bit_length(), counts).join(ids.select(F.col("n").alias("at"), "_own"), "at")
    near = found.where(F.col("depth") < rounds).select(F.col("n").alias(prev), F.col("_own").alias("_inherited"))
    missing = leagues.where(F.col(lineage).isNull()).join(near, prev, "left").withColumn(lineage, F.coalesce("_inherited", id)).select(*leagues.columns)
    return leagues.where(F.col(lineage).isNotNull()).unionByName(missing)


def discover_forward(known: DataFrame, candidates: DataFrame, members: DataFrame, hops: int = 5, id: str = "league_id", prev: str = "previous_league_id", lineage: str = "league_lineage_id", season: str = "season") -> DataFrame:
    """New leagues that continue a known lineage: (league_id, previous, lineage, hop).

    From each lineage's latest league, candidate leagues of its members (members: league_id, user_id)
    whose predecessor is in the frontier and which are not known yet become the next frontier. Which
    candidates share a member with their predecessor does not depend on the hop: these steps are found once
    and stored, without the members. A hop only joins its frontier with them, and what it finds, which is
    stored too, is disjoint from the hops before it.
    """
    frontier, found = current_per_lineage(known, lineage, season, id), None
    offered = candidates.join(known.select(id), id, "left_anti").join(members.select(id, "user_id"), id).select(id, prev, "user_id")
    before = members.select(F.col(id).alias("_from"), F.col("user_id").alias("_user"))
    steps = _cut(offered.join(before, (F.col(prev) == F.col("_from")) & (F.col("user_id") == F.col("_user"))).select(id, prev).distinct())
    for hop in range(1, hops + 1):
        step = steps.join(frontier.select(F.col(id).alias(prev), F.col(lineage)), prev).select(id, prev, lineage).distinct()
        if found is not None:
            step = step.join(found.select(id), id, "left_anti")
        step = _cut(step.withColumn("hop", F.lit(hop)))
        found = step if found is None else found.unionByName(step)
        if not step.limit(1).count():
            break
        frontier = step.select(id, lineage)
    return found


def bfs_crawl(seeds: DataFrame, user_league: DataFrame, league_owner: DataFrame, cap: int = 10_000) -> DataFrame:
    """(league_id, hop) reached from seed users over leagues and their owners, at most `cap` of them.

    A league's hop is the round that first met it; the cap (the crawl's own feature) keeps the first ones
    by (hop, id).
    """
    users = seeds.select("user_id").distinct()
    leagues, new_users = None, users
    for hop in count():
        step = user_league.join(new_users, "user_id", "left_semi").select("league_id").distinct()
        if leagues is not None:
            step = step.join(leagues, "league_id", "left_anti")
        step = _cut(step.withColumn("hop", F.lit(hop)))
        if not step.limit(1).count():
            break
        leagues = step if leagues is None else leagues.unionByName(step)
        if leagues.count() >= cap:
            break
        new_users = _cut(league_owner.join(step, "league_id", "left_semi").select("user_id").distinct().join(users, "user_id", "left_anti"))
        users = users.union(new_users)
    if leagues is None:
        return user_league.select("league_id").limit(0).withColumn("hop", F.lit(0))
    return leagues.orderBy("hop", "league_id").limit(cap)


def build_lineage_map(leagues: DataFrame) -> DataFrame:
    """league_id, league_lineage_id, current_league_id, total_rosters, latest_completed_season.

    The current league is that of the greatest season (then id); the rosters are the current one's.
    """
    top = leagues.groupBy("league_lineage_id").agg(
        F.max(F.struct(F.col("season").cast("int").alias("s"), "league_id", "total_rosters")).alias("_top"),
        F.max(F.when(F.col("status") == "complete", F.col("season").cast("int"))).alias("latest_completed_season"),
    )
    top = top.select("league_lineage_id", F.col("_top.league_id").alias("current_league_id"), F.col("_top.total_rosters").alias("total_rosters"), "latest_completed_season")
    return leagues.select("league_id", "league_lineage_id").distinct().join(top, "league_lineage_id").select("league_id", "league_lineage_id", "current_league_id", "total_rosters", "latest_completed_season")


def franchise_id(lineage: str | Column = "league_lineage_id", roster: str | Column = "roster_id") -> Column:
    return F.concat_ws("_", lineage, F.col(roster).cast("string") if isinstance(roster, str) else roster.cast("string"))


def lineage_franchise(df: DataFrame, lineage_map: DataFrame) -> DataFrame:
    """Adds league_lineage_id and franchise_id; rows of unknown leagues go."""
    return df.join(lineage_map.select("league_id", "league_lineage_id").distinct(), "league_id").withColumn("franchise_id", franchise_id())


def relabel_current(df: DataFrame, lineage_map: DataFrame) -> DataFrame:
    """league_id replaced by the lineage's current league; rows of unknown leagues go."""
    names = lineage_map.select("league_id", "current_league_id").distinct()
    return df.join(names, "league_id").withColumn("league_id", F.col("current_league_id")).select(*df.columns)


def current_per_lineage(leagues: DataFrame, lineage: str = "league_lineage_id", season: str = "season", id: str = "league_id") -> DataFrame:
    """The league of the last season of each lineage (then the greatest id)."""
    top = leagues.groupBy(lineage).agg(F.max(F.struct(F.col(season).cast("int").alias("s"), id)).alias("_top"))
    return top.select(F.col(f"_top.{id}").alias(id), lineage, F.col("_top.s").alias(season))
