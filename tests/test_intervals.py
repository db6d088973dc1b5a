import datetime as dt
import random

from conftest import rows
from pyspark.sql import functions as F

from stintlake.operators import asof, intervals
from stintlake.plans import ledger

D = lambda s: dt.date.fromisoformat(s)


def presence(spark, triples):
    return spark.createDataFrame([(d, r, p) for d, r, p in triples], "snapshot_date string, roster_id long, player_id string")


def test_gaps_split_stints(spark):
    df = presence(spark, [("2025-01-01", 1, "A"), ("2025-01-02", 1, "A"), ("2025-01-03", 1, "A"), ("2025-01-01", 1, "B"), ("2025-01-03", 1, "B")])
    out = rows(intervals.build_snapshot_intervals(df, ["roster_id", "player_id"]), "player_id", "valid_from", "valid_to", "is_current")
    assert out == [("A", D("2025-01-01"), None, True), ("B", D("2025-01-01"), D("2025-01-02"), False), ("B", D("2025-01-03"), None, True)]


def test_repeated_presence_is_one_stint(spark):
    df = presence(spark, [("2025-01-01", 1, "A")] * 3)
    assert intervals.build_snapshot_intervals(df, ["roster_id", "player_id"]).count() == 1


def test_intervals_cover_exactly_the_presence(spark):
    rng = random.Random(4)
    days = [f"2025-03-{d:02d}" for d in rng.sample(range(1, 29), 14)]
    triples = {(d, r, p) for d in days for r in range(2) for p in "ABC" if rng.random() < 0.5}
    grid = {D(d) for d, _, _ in triples}
    out = intervals.build_snapshot_intervals(presence(spark, triples), ["roster_id", "player_id"])
    covered = {(d, r["roster_id"], r["player_id"]) for r in out.collect() for d in grid if r["valid_from"] <= d and (r["valid_to"] is None or d < r["valid_to"])}
    assert covered == {(D(d), r, p) for d, r, p in triples}


def events(spark, items):
    return spark.createDataFrame([(ts, d, 1, "A", a) for ts, d, a in items], "ts long, date string, roster_id long, player_id string, action string")


def test_event_stints(spark):
    key = ["roster_id", "player_id"]
    run = lambda items: rows(intervals.build_event_intervals(events(spark, items), key), "valid_from", "valid_to")
    assert run([(100, "2025-01-01", "add"), (500, "2025-01-05", "drop"), (900, "2025-01-09", "add")]) == [(D("2025-01-01"), D("2025-01-05")), (D("2025-01-09"), None)]
    assert run([(100, "2025-01-01", "add"), (200, "2025-01-02", "add")]) == [(D("2025-01-01"), None)]
    assert run([(50, "2025-01-01", "drop")]) == []
    # a drop and an add at one time leave the asset held
    assert run([(100, "2025-01-01", "add"), (500, "2025-01-05", "add"), (500, "2025-01-05", "drop")])[-1] == (D("2025-01-05"), None)


def test_eras_split_at_the_boundary(spark):
    ev = events(spark, [(1, "2025-10-01", "add")])
    present = presence(spark, [("2025-10-16", 1, "A"), ("2025-10-17", 1, "A")])
    out = rows(intervals.combine_eras(present, ev, "2025-10-16", ["roster_id", "player_id"]), "valid_from", "valid_to")
    assert out == [(D("2025-10-01"), D("2025-10-16")), (D("2025-10-16"), None)]


def test_grids_agree(spark):
    led = spark.createDataFrame([("a", D("2025-01-01"), D("2025-02-10")), ("b", D("2025-01-20"), None), ("c", D("2025-03-01"), None)], "k string, valid_from date, valid_to date")
    grid = spark.createDataFrame([(D("2025-01-06") + dt.timedelta(days=7 * i),) for i in range(6)], "date date")
    a = rows(intervals.holdings_by_date(led, grid), "k", "date")
    assert a == rows(intervals.holdings_on_grid(led, "2025-01-06", "2025-02-10", 7), "k", "date")
    assert {x[0] for x in a} == {"a", "b"}


def test_long_stints_on_sparse_and_dense_grids(spark):
    """Stints of 30 years on grids from one date a decade to one a day, against a loop; the plan neither
    copies nor shuffles the ledger."""
    rng = random.Random(6)
    day = lambda n: D("1990-01-01") + dt.timedelta(days=n)
    stints = [(k, day(a), None if rng.random() < 0.2 else day(a + n)) for k, (a, n) in enumerate([(0, 30 * 365), (5, 1), (9, 0), *[(rng.randrange(11_000), rng.choice([1, 3, 40, 9000])) for _ in range(60)]])]
    stints.append((99, None, day(50)))
    led = spark.createDataFrame(stints, "k int, valid_from date, valid_to date")
    for step in (1, 7, 31, 365, 3650):
        grid = [day(n) for n in range(3, 12_000, step)] + ([day(n) for n in rng.sample(range(12_000), 5)] if step > 1 else [])
        got = intervals.holdings_by_date(led, spark.createDataFrame([(x,) for x in [*grid, grid[0], None]], "date date"))
        want = [(k, x) for k, a, b in stints for x in set(grid) if a and a <= x and (b is None or x < b)]
        assert sorted((r["k"], r["date"]) for r in got.select("k", "date").collect()) == sorted(want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Generate explode(slice(") == 1
    for none in ([], [(None,)]):
        assert intervals.holdings_by_date(led, spark.createDataFrame(none, "date date")).count() == 0


def test_asof_keeps_null_values_and_unmatched_rows(spark):
    left = spark.createDataFrame([(1, 5), (1, 1), (2, 9), (1, None)], "k int, t int")
    right = spark.createDataFrame([(1, 2, 10.0), (1, 5, None), (3, 1, 7.0)], "k int, u int, v double")
    assert rows(asof.asof_join(left, right, "t", ["k"], "u")) == sorted([(1, 5, None), (1, 1, None), (2, 9, None), (1, None, None)], key=repr)
    assert (1, 5, 10.0) in rows(asof.asof_join(left, right, "t", ["k"], "u", strict=True))


def test_asof_of_a_hot_key(spark):
    """One key with nine tenths of the rows of either side is cut into ranges: the rows are the same as without."""
    rng = random.Random(2)
    key = lambda: 1 if rng.random() < 0.9 else rng.choice([2, 3, 4, None])
    day = lambda: None if rng.random() < 0.02 else D("2024-01-01") + dt.timedelta(days=int(200 * rng.random() ** 3))
    left = spark.createDataFrame([(key(), day(), i) for i in range(3000)], "k int, t date, i int")
    right = spark.createDataFrame([(key(), day(), float(i) if i % 7 else None) for i in range(900)], "k long, u date, v double")
    for strict in (False, True):
        plain = rows(asof.asof_join(left, right, "t", ["k"], "u", strict, hot_rows=None))
        assert rows(asof.asof_join(left, right, "t", ["k"], "u", strict)) == plain  # nothing is hot here
        for ranges in (2, 12, 500):
            assert rows(asof.asof_join(left, right, "t", ["k"], "u", strict, hot_rows=0, ranges=ranges)) == plain
    # a side that is empty, no key at all, times of unlike types
    assert rows(asof.asof_join(left, right.limit(0), "t", ["k"], "u", hot_rows=0, ranges=8)) == rows(left.selectExpr("k", "t", "i", "double(null)"))
    assert asof.asof_join(left.limit(0), right, "t", ["k"], "u", hot_rows=0, ranges=8).count() == 0
    stamps = right.select(F.col("u").cast("timestamp").alias("u"), "v")
    assert rows(asof.asof_join(left, stamps, "t", [], "u", hot_rows=0, ranges=8)) == rows(asof.asof_join(left, stamps, "t", [], "u", hot_rows=None))


def test_ranges_of_a_hot_key_are_even(spark):
    left = spark.range(40_000).selectExpr("if(id % 10 = 0, id, 7) AS k", "pow(id, 2) AS t")
    right = left.selectExpr("k", "t + 1 AS u", "t AS v")
    sides = [side.select("k", F.col(c).alias("_t")) for side, c in ((left, "t"), (right, "u"))]
    cuts = asof._hot_cuts(sides, ["k"], 1000, 20)
    assert [r["_by_k"] for r in cuts.collect()] == [7]
    for side in sides:
        sizes = [r["count"] for r in asof._placed(side, cuts, ["k"]).where("_b >= 0").groupBy("_b").count().collect()]
        assert len(sizes) >= 18 and max(sizes) <= 40_000 / 20 * 1.1 and sum(sizes) == 36_000
    # the carry is one row for each range, and the window's groups are ranges
    got = asof.asof_join(left, right, "t", ["k"], "u", hot_rows=1000, ranges=20)
    assert rows(got) == rows(asof.asof_join(left, right, "t", ["k"], "u", hot_rows=None))


def test_rollover_replay(spark):
    present = spark.createDataFrame([("L", "L_1", "A", D(d)) for d in ("2025-01-01", "2025-01-02", "2025-01-10")] + [("L", "L_1", "B", D("2025-01-02"))], "league_lineage_id string, franchise_id string, player_id string, snapshot_date date")
    ev = spark.createDataFrame([("L", "L_1", "B", 1, D("2025-01-04"), "drop"), ("L", "L_1", "C", 2, D("2025-01-06"), "add")], "league_lineage_id string, franchise_id string, player_id string, ts long, date date, action string")
    out, windows = ledger.reconstruct_rollover_presence(present, ev)
    assert rows(windows, "carry_date", "window_start", "window_end") == [(D("2025-01-02"), D("2025-01-04"), D("2025-01-10"))]
    held = {(p, d.day) for _, _, p, d in rows(out)}
    assert ("B", 4) not in held and ("C", 5) not in held and ("C", 6) in held and ("A", 9) in held


def test_pick_intervals_use_their_own_lineage(spark):
    life = spark.createDataFrame([(x, f"{x}_1", "2025:1:1", 1, "2024-05-01", c) for x, c in (("X", "2025-05-01"), ("Y", None))], "league_lineage_id string, franchise_id string, pick_id string, mint_ts long, mint_date string, consume_date string")
    trades = spark.createDataFrame([("X", "2025:1:1", "X_1", "X_2", 9, "2024-08-01")], "league_lineage_id string, pick_id string, prev_franchise string, new_franchise string, ts long, date string")
    out = rows(ledger.reconstruct_pick_intervals(life, trades), "franchise_id", "valid_from", "valid_to")
    assert out == [("X_1", D("2024-05-01"), D("2024-08-01")), ("X_2", D("2024-08-01"), D("2025-05-01")), ("Y_1", D("2024-05-01"), None)]
