"""Physical-plan shape checks: the plans the operators were designed for."""

from __future__ import annotations

import datetime as dt

from strata.operators import activity, quality, scd
from strata.plans import queries as Q
from strata.sources import testdata as src


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(plan: str, token: str) -> int:
    return plan.count(token)


def test_backfill_has_one_exchange_no_join_no_window(spark, sf_dir):
    seasons = src.entity_periods(spark, sf_dir).select("entity_id", "period", "gp", "pts", "reb", "ast", "name", "segment", "top_priority")
    snap = Q.cumulative.cumulative_backfill(seasons, Q.ENTITY_SPEC, last=2001)
    p = plan_of(snap)
    # exchanges come only from the source view (orders aggregate + customer join)
    # and the one group-by of the backfill; none from a join or a window
    assert "Window" not in p
    assert "NestedLoop" not in p
    assert "Generate explode" in p


def test_scd_windows_share_one_exchange(spark, sf_dir):
    snaps = Q.entity_backfill(spark, sf_dir, last=2001)
    base = count(plan_of(snaps), "Exchange")
    full = scd.scd2_full(snaps, "entity_id", "current_season", list(Q.SCD_ATTRS), as_of=2001)
    # the backfill is already hash-partitioned by entity: window + group-by add no exchange
    assert count(plan_of(full), "Exchange") == base


def test_dedup_limits_before_shuffle(spark, sf_dir):
    li = src.read_table(spark, sf_dir, "lineitem")
    p = plan_of(quality.dedup_first(li, ["l_orderkey", "l_linenumber"], Q.LINEITEM_ORDER))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_bitmap_has_no_join_and_no_exchange(spark):
    snap = spark.createDataFrame([(1, [dt.date(2024, 1, 1)], dt.date(2024, 1, 2))], "user_id long, dates_active array<date>, date date")
    p = plan_of(activity.activity_bitmap(snap, dt.date(2024, 1, 2)))
    assert "Join" not in p and "Exchange" not in p


def test_day_filter_pushed_to_scan(spark, sf_dir):
    h = src.hits(spark, sf_dir)
    p = plan_of(activity.active_users(h, dt.date(2024, 1, 6)))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-06T00:00)" in p or (
        "GreaterThanOrEqual(ts" in p and "LessThan(ts" in p
    )


def test_no_broadcast_before_sizes_are_measured(spark, sf_dir):
    assert count(plan_of(src.game_details(spark, sf_dir)), "BroadcastExchange") == 0


def test_hot_suppliers_are_reduced_below_their_join(spark, sf_dir):
    """Lines are limited or counted per (game, player) before the exchange; the player join comes after."""
    for df in (src.player_games(spark, sf_dir), Q.fact_df(spark, sf_dir)):
        p = plan_of(df)
        join, limit = p.index("SortMergeJoin"), p.index("WindowGroupLimit")
        assert join < limit and "Partial" in p[limit:]  # a plan's text starts at its top
        assert "Window" not in p[:join]
    p = plan_of(Q.q_grain_check(spark, sf_dir))
    assert p.index("SortMergeJoin") < p.index("partial_count")


def test_pairs_run_no_job_while_planning_and_read_lines_once(spark, sf_dir):
    games = Q.player_games(spark, sf_dir)
    p = plan_of(Q.graph.vertex_edge_report(Q.player_vertices(games), Q.pair_edges(games)))
    assert "lineitem.parquet" not in p and "/strata/" in p  # a plan cuts long paths short


def test_pairs_of_small_groups_join_plainly_and_are_made_once(spark, sf_dir):
    """No sizes are joined where the largest group is one cell; the report's order samples stored edges, not the pairs."""
    games = Q.player_games(spark, sf_dir)
    n = Q.largest_group(games, ["game_id"])
    assert n == games.groupBy("game_id").count().agg({"count": "max"}).first()[0]
    kw = dict(member="player_id", group="game_id", side="team_abbreviation", measure="pts", order=None)
    rows = {}
    for chunk in (n, n - 1):
        edges = Q.graph.cooccurrence_edges(games, **kw, chunk_rows=chunk, largest=n)
        assert ("_nsalt" in plan_of(edges)) == (chunk < n)
        rows[chunk] = sorted(map(str, edges.collect()))
    assert rows[n] == rows[n - 1] and rows[n]
    for q in (Q.q_graph_edges_pairs, Q.q_graph_pair_report):
        assert "_nsalt" not in plan_of(q(spark, sf_dir))
    assert count(Q.q_graph_pair_report(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString(), "Join ") == 1
    empty = games.limit(0)
    assert Q.largest_group(empty, ["game_id"]) == 0 and Q.pair_edges(empty, largest=0).isEmpty()


def test_month_arrays_and_bitmaps_scan_events_once(spark, sf_dir):
    h = src.hits(spark, sf_dir)
    arrays = Q.metrics.array_metric_backfill(h, dt.date(2024, 1, 1), dt.date(2024, 3, 31), Q.metric_exprs())
    bits = activity.activity_bitmap_from_events(h, dt.date(2024, 1, 30))
    for df in (arrays, bits):
        p = plan_of(df)
        assert p.count("FileScan") == 1 and "Join" not in p and "Union" not in p


def test_scd_increment_is_one_join_on_stored_tables(spark, sf_dir):
    from strata.plans import jobs
    from strata.session import state_path
    from strata.sources.snapshots import SnapshotTable

    players, history = Q._stored_players(spark, sf_dir), state_path(spark, "plan-scd")
    table = jobs.scd_full(spark, players, history, Q.ENTITY_SPEC, as_of=2000)
    snaps = SnapshotTable.open(spark, players, "current_season")
    p = plan_of(
        scd.scd2_incremental(table.read(as_of=2000), snaps.read(as_of=2001), "entity_id", list(Q.SCD_ATTRS), period=2001)
    )
    assert p.count("SortMergeJoin") == 1 and "Window" not in p and p.count("Exchange hashpartitioning") == 2


def _exchanges(plan: str) -> int:
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") + plan.count(
        "Exchange SinglePartition"
    )


def test_exact_exchange_counts_on_stored_tables(spark, sf_dir):
    """SURVEY 7.3 step 10: one exchange for the backfill, one for the SCD2 rebuild."""
    from strata.sources.snapshots import SnapshotTable

    staged = SnapshotTable.scratch(spark, "plan-seasons", "period")
    staged.write(src.entity_periods(spark, sf_dir))
    seasons = staged.read()
    snap = Q.cumulative.cumulative_backfill(seasons, Q.ENTITY_SPEC, last=2001)
    assert _exchanges(plan_of(snap)) == 1

    players = SnapshotTable.scratch(spark, "plan-players", "current_season")
    players.write(snap)
    full = scd.scd2_full(players.read(), "entity_id", "current_season", list(Q.SCD_ATTRS), as_of=2001)
    p = plan_of(full)
    assert _exchanges(p) == 1 and "Window" in p


def test_events_bitmap_is_a_hash_aggregate(spark, sf_dir):
    h = src.hits(spark, sf_dir)
    p = plan_of(activity.activity_bitmap_from_events(h, dt.date(2024, 1, 30)))
    assert "ObjectHashAggregate" not in p and "SortAggregate" not in p and "collect_list" not in p
    assert "bit_or" in p and "NestedLoop" not in p and "Cartesian" not in p
