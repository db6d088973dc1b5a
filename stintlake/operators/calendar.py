"""Calendar and event dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stintlake.functions.coerce import ms_to_date
from stintlake.operators.asof import asof_join

#: A draft of more rounds fills whole rosters: it is the startup draft.
STARTUP_ROUNDS = 7


def season_boundaries(schedules: DataFrame) -> DataFrame:
    """season with first and last day of its regular games (season_start, reg_end) and of the others
    (playoff_start, playoff_end; null while they aren't scheduled)."""
    day, regular = F.col("gameday").cast("date"), F.col("game_type") == "REG"
    return (
        schedules.groupBy(F.col("season").cast("int").alias("season"))
        .agg(
            F.min(F.when(regular, day)).alias("season_start"), F.max(F.when(regular, day)).alias("reg_end"),
            F.min(F.when(~regular, day)).alias("playoff_start"), F.max(F.when(~regular, day)).alias("playoff_end"),
        )
        .where("season_start IS NOT NULL")
    )


def date_spine(bounds: DataFrame, start: str | None = None, end: str | None = None, days_after: int = 400) -> DataFrame:
    """Every day from start (default: the first season's) to end (default: days_after past the latest boundary)."""
    low = F.lit(start).cast("date") if start else F.min("season_start")
    high = F.lit(end).cast("date") if end else F.date_add(F.max(F.greatest("season_start", "reg_end", "playoff_end")), days_after)
    edges = bounds.agg(F.min("season_start").alias("_any"), low.alias("_low"), high.alias("_high"))
    return edges.select(F.explode(F.sequence("_low", "_high", F.expr("interval 1 day"))).alias("date"))


def build_dim_dates(schedules: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """A row a day: calendar parts, season, phase (regular, playoffs, offseason) and three flags.

    A day belongs to the last season that began by then. While a season's playoff end is unknown, all days
    after its last regular game are playoffs. In the offseason `season` is already the next one.
    """
    bounds = season_boundaries(schedules).withColumn("_on", F.col("season_start"))
    days = asof_join(date_spine(bounds, start, end), bounds, "date", right_on="_on", hot_rows=None)  # a row a day
    d = F.col("date")
    phase = F.when(d <= F.col("reg_end"), "regular").when(F.col("playoff_end").isNull() | (d <= F.col("playoff_end")), "playoffs").otherwise("offseason")
    same = lambda c: F.coalesce(d == F.col(c), F.lit(False))
    return days.withColumn("phase", phase).select(
        "date", F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"), (F.weekday(d) + 1).alias("day_of_week"), F.weekofyear(d).alias("week_of_year"),
        F.when(F.col("phase") == "offseason", F.col("season") + 1).otherwise(F.col("season")).alias("season"), "phase",
        same("season_start").alias("is_season_start"), same("playoff_start").alias("is_playoff_start"), same("playoff_end").alias("is_playoff_end"),
    )


def draft_events(drafts: DataFrame, leagues: DataFrame, times: tuple[str, ...] = ("start_time", "last_picked")) -> DataFrame:
    """Startup and rookie drafts as events; the date is the first of `times` that is set."""
    kind = F.when(F.col("rounds") > STARTUP_ROUNDS, "startup_draft").otherwise("rookie_draft")
    out = drafts.select("draft_id", "league_id", F.col("season").cast("int").alias("season"), kind.alias("event_type"), ms_to_date(F.coalesce(*times)).alias("event_date"))
    return out.join(leagues.select("league_id", "league_lineage_id").distinct(), "league_id").select("league_lineage_id", "league_id", "season", "event_type", "event_date")


def final_week(start: str | Column = "playoff_week_start", teams: str | Column = "playoff_teams") -> Column:
    """The week of the last playoff round: a knock-out of n teams takes ceil(log2 n) weeks."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return (c(start) + F.ceil(F.log2(c(teams).cast("double"))) - 1).cast("int")


def fantasy_end_events(settings: DataFrame, leagues: DataFrame, schedules: DataFrame) -> DataFrame:
    """The end of each league's season: the last regular game of its final week."""
    weeks = schedules.where("game_type = 'REG'").groupBy(F.col("season").cast("int").alias("season"), F.col("week").cast("int").alias("_week")).agg(F.max(F.col("gameday").cast("date")).alias("event_date"))
    current = settings.where("is_current").select("league_id", final_week().alias("_week"))
    ends = current.join(leagues.select("league_id", "league_lineage_id", F.col("season").cast("int").alias("season")), "league_id")
    return ends.join(weeks, ["season", "_week"], "left").select("league_lineage_id", "league_id", "season", F.lit("fantasy_end").alias("event_type"), "event_date")


def build_dim_league_events(drafts: DataFrame, settings: DataFrame, leagues: DataFrame, schedules: DataFrame) -> DataFrame:
    """All events with a date, in order."""
    both = draft_events(drafts, leagues).unionByName(fantasy_end_events(settings, leagues, schedules))
    return both.where("event_date IS NOT NULL").orderBy("league_lineage_id", "event_date", "event_type", "league_id")


def season_windows(schedules: DataFrame, events: DataFrame) -> DataFrame:
    """From the season's first game to the league's end: lineage, season, season_start, season_end."""
    starts = schedules.where("game_type = 'REG'").groupBy(F.col("season").cast("int").alias("season")).agg(F.min(F.col("gameday").cast("date")).alias("season_start"))
    ends = events.where("event_type = 'fantasy_end'").select("league_lineage_id", "season", F.col("event_date").alias("season_end"))
    return ends.join(starts, "season").select("league_lineage_id", "season", "season_start", "season_end")
