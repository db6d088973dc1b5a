from conftest import rows

from stintlake.operators import overlay, scd2
from stintlake.operators.dedupe import merge_full_and_incremental
from stintlake.operators.graph import backfill_lineage, walk_back
from stintlake.plans import ledger


def leagues(spark, rosters=6):
    return spark.createDataFrame([("L24", "R", "2024", "complete", rosters), ("L25", "R", "2025", "in_season", rosters)], "league_id string, league_lineage_id string, season string, status string, total_rosters long")


def traded(spark, items=()):
    return spark.createDataFrame(list(items), "league_id string, season string, round long, original_roster_id long, owner_roster_id long, timestamp timestamp")


def drafts(spark):
    return spark.createDataFrame([("D1", "L25", "2025", "complete", 3, 1_746_000_000_000)], "draft_id string, league_id string, season string, status string, rounds long, start_time long")


def overrides(spark, items):
    return spark.createDataFrame(items, "league_id string, season string, round long, roster_id long, from_team_id long, to_team_id long, created long")


def test_untraded_grid_has_54_picks(spark):
    out = ledger.resolve_pick_ownership(traded(spark), None, None, leagues(spark), drafts(spark))
    assert out.count() == 54 and out.where("owner_roster_id = original_roster_id AND owner_source = 'base'").count() == 54
    assert {r[0] for r in rows(out, "season")} == {"2026", "2027", "2028"}


def test_override_beats_traded_state_and_old_league_ids_count(spark):
    import datetime as dt

    state = traded(spark, [("L25", "2026", 1, 1, 2, dt.datetime(2025, 6, 1))])
    out = ledger.resolve_pick_ownership(state, None, overrides(spark, [("L24", "2026", 1, 1, 2, 5, 1_700_000_000_000)]), leagues(spark), drafts(spark))
    assert rows(out.where("season = '2026' AND round = 1 AND original_roster_id = 1"), "league_id", "owner_roster_id", "owner_source") == [("L25", 5, "override")]


def test_future_drafts_do_not_spend_earlier_picks(spark):
    assert ledger.drafts_completed_by(drafts(spark), "2025-01-01").count() == 0
    assert ledger.drafts_completed_by(drafts(spark), "2025-12-31").count() == 1


def test_reconcile(spark):
    cols = "league_id string, franchise_id string, asset_type string, asset_id string, player_key string"
    players = spark.createDataFrame([("L", "F1", "PLAYER", "1", "1"), ("L", "F2", "PLAYER", "1", "1"), ("L", None, "PLAYER", "2", "2"), ("L", "F1", "PLAYER", "3", None), ("L", "F1", "PLAYER", "4", "4"), ("L", None, "PLAYER", "4", "4")], cols)
    picks = spark.createDataFrame([("L", "F1", "PICK", "2026:1:1")], "league_id string, franchise_id string, asset_type string, asset_id string")
    fact, bad = overlay.reconcile(players, picks, spark.createDataFrame([("L",)], "league_id string"))
    assert {r[0] for r in rows(fact, "asset_id")} == {"3", "2026:1:1"}
    reasons = {(r["asset_id"], r["reason"]) for r in bad.collect()}
    assert {("1", "duplicate_ownership"), ("2", "unresolved_franchise"), ("3", "unmapped_player"), ("4", "duplicate_ownership")} <= reasons


def test_conservation(spark):
    out = ledger.resolve_pick_ownership(traded(spark), None, None, leagues(spark), drafts(spark))
    expected = spark.createDataFrame([("L25", 6)], "league_id string, total_rosters long")
    assert overlay.conservation(out, expected, ["season", "round"], "league_id", "total_rosters").where("NOT ok").count() == 0


def test_scd2(spark):
    new = lambda *r: spark.createDataFrame(list(r), "id string, a int, b string")
    first = scd2.scd2_apply(None, new(("x", 1, None), ("y", 1, "q"), ("gone", 1, "z")), "id", "2024-01-01")
    second = scd2.scd2_apply(first, new(("x", 1, None), ("y", 2, "q"), ("new", 9, "n")), "id", "2024-02-01")
    got = {(r["id"], r["a"], r["is_current"], str(r["valid_from"]), r["valid_to"] and str(r["valid_to"]), str(r["loaded_at"])) for r in second.collect()}
    assert got == {
        ("x", 1, True, "2024-01-01", None, "2024-02-01"), ("y", 1, False, "2024-01-01", "2024-02-01", "2024-01-01"), ("y", 2, True, "2024-02-01", None, "2024-02-01"),
        ("gone", 1, True, "2024-01-01", None, "2024-01-01"), ("new", 9, True, "2024-02-01", None, "2024-02-01"),
    }


def test_merge_preserves_lineage(spark):
    full = spark.createDataFrame([("1", 1, "A"), ("2", 2, "B")], "league_id string, val int, league_lineage_id string")
    new = spark.createDataFrame([("2", 9, None), ("3", 3, None)], "league_id string, val int, league_lineage_id string")
    assert rows(merge_full_and_incremental(full, new, "league_id", ["league_lineage_id"])) == [("1", 1, "A"), ("2", 9, "B"), ("3", 3, None)]


def test_chains_and_cycles(spark):
    nodes = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "c"), ("p", "q"), ("q", "p"), ("z", "0")], "league_id string, previous_league_id string")
    got = {r["league_id"]: (r["root"], r["depth"]) for r in walk_back(nodes).collect()}
    assert got == {"a": ("a", 0), "b": ("a", 1), "c": ("a", 2), "d": ("a", 3), "p": (None, None), "q": (None, None), "z": ("z", 0)}


def test_lineage_backfill(spark):
    df = spark.createDataFrame([("a", None, "R"), ("b", "a", None), ("c", "b", None), ("x", "missing", None)], "league_id string, previous_league_id string, league_lineage_id string")
    assert {r[0]: r[2] for r in rows(backfill_lineage(df))} == {"a": "R", "b": "R", "c": "R", "x": "x"}


def test_contraction_of_long_chains_and_cycles(spark):
    """Chains up to 600 long, branches, cycles with tails and blank predecessors, against a loop; every
    round of either part starts with fewer rows than the one before."""
    import random

    rng = random.Random(7)
    prev = {}
    for c, length in enumerate((600, 90, 40, 1, 2)):
        for k in range(length):
            prev[f"c{c}_{k}"] = f"c{c}_{k - 1}" if k else rng.choice([None, "", "0", "unknown"])
    for k in range(300):  # trees: many successors of one node
        prev[f"t{k}"] = f"t{rng.randrange(k)}" if k else None
    for k in range(90):
        prev[f"y{k}"] = f"y{(k + 1) % 60}" if k < 60 else f"y{k - 60}"
    prev["self"] = "self"
    want = {}
    for n in prev:
        at, depth = n, 0
        while prev[at] in prev and depth <= 1000:
            at, depth = prev[at], depth + 1
        want[n] = (None, None) if depth > 1000 else (at, depth)
    counts: list[int] = []
    nodes = spark.createDataFrame([(n, p) for n, p in prev.items()] * 2, "league_id string, previous_league_id string")
    got = walk_back(nodes, counts=counts)
    assert got.count() == len(prev) and {r["league_id"]: (r["root"], r["depth"]) for r in got.collect()} == want
    falls = [k for k in range(1, len(counts)) if counts[k] > counts[k - 1]]
    assert len(falls) <= 1  # where the second part, over rulers only, begins
    assert counts[4] < counts[0] / 2


def test_backfill_walks_at_most_its_rounds(spark):
    chain = [(f"n{k}", f"n{k - 1}" if k else None, "R" if k == 0 else "S" if k == 20 else None) for k in range(40)]
    df = spark.createDataFrame([*chain, ("a", "b", None), ("b", "a", None)], "league_id string, previous_league_id string, league_lineage_id string")
    for rounds in (1, 5, 12):
        counts: list[int] = []
        got = {r[0]: r[2] for r in rows(backfill_lineage(df, rounds, counts=counts))}
        for k in range(40):
            base, name = (20, "S") if k >= 20 else (0, "R")
            assert got[f"n{k}"] == (name if k - base <= rounds else f"n{k}")
        assert (got["a"], got["b"]) == ("a", "b") and all(b <= a for a, b in zip(counts, counts[1:], strict=False))


def test_discover_forward_stores_steps_without_members(spark, monkeypatch):
    from stintlake.operators import graph

    known = spark.createDataFrame([("a", "A", "2020")], "league_id string, league_lineage_id string, season string")
    chain = spark.createDataFrame([("b", "a"), ("c", "b"), ("d", "c"), ("x", "a"), ("a", None)], "league_id string, previous_league_id string")
    members = spark.createDataFrame([(n, u) for n in "abc" for u in ("u", "v")] + [("d", "w"), ("x", "w")], "league_id string, user_id string")
    stored, cut = [], graph._cut
    monkeypatch.setattr(graph, "_cut", lambda df: stored.append(df.columns) or cut(df))
    got = sorted((r.league_id, r.previous_league_id, r.league_lineage_id, r.hop) for r in graph.discover_forward(known, chain, members).collect())
    assert got == [("b", "a", "A", 1), ("c", "b", "A", 2)]
    assert not any("user_id" in c for c in stored)


def test_backfill_lineage_derives_its_leagues_once(spark):
    leagues = spark.createDataFrame([("a", None, "A"), ("b", "a", None), ("c", None, None)], "league_id string, previous_league_id string, league_lineage_id string").selectExpr("*", "row_number() OVER (PARTITION BY league_id ORDER BY league_lineage_id) AS n")
    got = backfill_lineage(leagues)
    assert sorted((r.league_id, r.league_lineage_id) for r in got.collect()) == [("a", "A"), ("b", "A"), ("c", "c")]
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
