"""Hand-computed micro fixtures (FIXTURES.md section C) for every edge rule."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions.columns import tier
from strata.operators import activity, cumulative, facts, graph, metrics, scd
from strata.operators.cumulative import CumulativeSpec

from .conftest import rows_of

SPEC = CumulativeSpec(
    key="player_name", period="season", dims=("college",), stats=("gp", "pts", "reb", "ast"), measure="pts"
)
SEASON_SCHEMA = "player_name string, season int, college string, gp int, pts double, reb double, ast double"
D = dt.date(2023, 1, 31)


def days_before(n):
    return D - dt.timedelta(days=n)


@pytest.fixture(scope="module")
def c1(spark):
    src = spark.createDataFrame(
        [("A", 1996, "X", 1, 21.0, 1.0, 1.0), ("A", 1997, None, 1, 21.0, 1.0, 1.0), ("A", 1999, "Y", 1, 9.0, 1.0, 1.0)],
        SEASON_SCHEMA,
    )
    return cumulative.cumulative_backfill(src, SPEC, last=2000)


def test_c1_backfill(c1):
    got = rows_of(c1, "current_season", "scoring_class", "years_since_last_season", "is_active", F.size("season_stats"))
    assert got == [
        (1996, "star", 0, True, 1),
        (1997, "star", 0, True, 2),
        (1998, "star", 1, False, 2),
        (1999, "bad", 0, True, 3),
        (2000, "bad", 1, False, 3),
    ]


def test_c1_fold_equals_backfill(spark, c1):
    src = spark.createDataFrame(
        [("A", 1996, "X", 1, 21.0, 1.0, 1.0), ("A", 1997, None, 1, 21.0, 1.0, 1.0), ("A", 1999, "Y", 1, 9.0, 1.0, 1.0)],
        SEASON_SCHEMA,
    )
    prev = None
    snaps = []
    for p in range(1996, 2001):
        prev = cumulative.cumulative_step(prev, src, SPEC, p)
        snaps.append(prev)
    cols = ["player_name", "current_season", "season_stats", "scoring_class", "years_since_last_season", "is_active"]
    folded = snaps[0]
    for s in snaps[1:]:
        folded = folded.unionByName(s)
    assert rows_of(folded, *cols) == rows_of(c1, *cols)
    # newest non-NULL dimension wins in the fold; 1997 had NULL college
    assert rows_of(folded, "current_season", "college") == [
        (1996, "X"), (1997, "X"), (1998, "X"), (1999, "Y"), (2000, "Y")
    ]
    latest = cumulative.cumulative_backfill(src, SPEC, last=2000, dims_mode="latest")
    assert rows_of(latest, "current_season", "college") == rows_of(folded, "current_season", "college")


def test_c2_scd_full(c1):
    out = scd.scd2_full(c1, "player_name", "current_season", ["scoring_class", "is_active"], as_of=2000)
    assert rows_of(out, "scoring_class", "is_active", "start_season", "end_season") == sorted(
        [("star", True, 1996, 1997), ("star", False, 1998, 1998), ("bad", True, 1999, 1999), ("bad", False, 2000, 2000)]
    )


def test_c3_scd_incremental(c1):
    attrs = ["scoring_class", "is_active"]
    prev = scd.scd2_full(c1, "player_name", "current_season", attrs, as_of=1997)
    out = scd.scd2_incremental(prev, c1, "player_name", attrs, period=1998)
    assert rows_of(out, "scoring_class", "is_active", "start_season", "end_season", "current_season") == sorted(
        [("star", True, 1996, 1997, 1998), ("star", False, 1998, 1998, 1998)]
    )


def test_c4_unchanged_and_new(spark):
    prev = spark.createDataFrame(
        [("A", "good", True, 1996, 1997, 1997)],
        "player_name string, scoring_class string, is_active boolean, start_season int, end_season int, current_season int",
    )
    snap = spark.createDataFrame(
        [("A", "good", True, 1998), ("B", "bad", True, 1998)],
        "player_name string, scoring_class string, is_active boolean, current_season int",
    )
    out = scd.scd2_incremental(prev, snap, "player_name", ["scoring_class", "is_active"], period=1998)
    assert rows_of(out, "player_name", "scoring_class", "is_active", "start_season", "end_season") == [
        ("A", "good", True, 1996, 1998),
        ("B", "bad", True, 1998, 1998),
    ]


def test_c5_class_thresholds(spark):
    df = spark.createDataFrame([(20.0,), (15.0,), (10.0,), (None,), (20.5,)], "pts double")
    from strata.functions.columns import REFERENCE_TIERS

    got = [r[0] for r in df.select(tier("pts", REFERENCE_TIERS)).collect()]
    assert got == ["good", "avg", "bad", "bad", "star"]


def test_c6_first_vs_latest(spark):
    rows = [("a", [(1, 1, 0.0, 0.0, 0.0), (2, 1, 5.0, 0.0, 0.0)]), ("b", [(1, 1, 4.0, 0.0, 0.0), (2, 1, 6.0, 0.0, 0.0)]),
            ("c", [(1, 1, None, 0.0, 0.0), (2, 1, 6.0, 0.0, 0.0)])]
    schema = (
        "player_name string, season_stats array<struct<season:int,gp:int,pts:double,reb:double,ast:double>>"
    )
    snap = spark.createDataFrame(rows, schema).withColumn("current_season", F.lit(2)).withColumn(
        "scoring_class", F.lit("star")
    )
    out = cumulative.first_vs_latest(snap, SPEC, as_of=2)
    assert rows_of(out, "player_name", "improvement") == [("a", 5.0), ("b", 1.5), ("c", None)]


def test_c7_pair_edges(spark):
    fact = spark.createDataFrame(
        [
            (1, "g", "T1", 10, 1),
            (1, "g", "T1", 10, 2),  # duplicate (player 1, game g)
            (2, "g", "T1", 5, 1),
            (1, "h", "T1", 7, 1),
            (2, "h", "T2", 3, 1),
        ],
        "player_id long, game_id string, team string, pts int, ord int",
    )
    e = graph.cooccurrence_edges(fact, "player_id", "game_id", "team", "pts", order=["ord"])
    got = rows_of(
        e.select(
            "subject_identifier",
            "object_identifier",
            "edge_type",
            F.get_json_object("properties", "$.num_games").cast("int"),
            F.get_json_object("properties", "$.subject_points").cast("int"),
            F.get_json_object("properties", "$.object_points").cast("int"),
        )
    )
    assert got == [("2", "1", "plays_against", 1, 3, 7), ("2", "1", "shares_team", 1, 5, 10)]


def test_c8_numeric_max(spark):
    v = spark.createDataFrame([("1", "player", '{"player_name":"p"}')], "identifier string, type string, properties string")
    e = spark.createDataFrame(
        [("1", "player", "1", "game", "plays_in", '{"pts":9}'), ("1", "player", "2", "game", "plays_in", '{"pts":10}')],
        "subject_identifier string, subject_type string, object_identifier string, object_type string, "
        "edge_type string, properties string",
    )
    out = graph.vertex_edge_max(v, e, "pts", "player_name", dtype="int")
    assert rows_of(out, "player_name", "max_pts") == [("p", 10)]


def test_c9_fact_parsing(spark):
    details = spark.createDataFrame(
        [
            (1, 1, 1, "a", "F", "DNP - x", "34:56", 1),
            (1, 1, 2, "b", "F", None, None, 1),
            (1, 1, 3, "c", "F", None, "34", 1),
            (1, 1, 4, "d", "F", None, "x:1", 1),
        ],
        "game_id long, team_id int, player_id long, player_name string, start_position string, comment string, "
        "min string, ord int",
    )
    games = spark.createDataFrame([(1, dt.date(2020, 1, 1), 2020, 1)], "game_id long, game_date_est date, season int, home_team_id int")
    out = facts.build_fact(details, games, order=["ord"], measures={"ord": "m_ord"})
    got = rows_of(out, "dim_player_id", "m_minutes", "dim_did_not_play", "dim_is_playing_at_home")
    assert got[0][1] == pytest.approx(34 + 56 / 60)
    assert [g[1] for g in got[1:]] == [None, None, None]
    assert [g[2] for g in got] == [True, False, False, False]
    assert all(g[3] for g in got)


def test_c10_activity_step(spark):
    d = dt.date(2023, 1, 10)
    prev = spark.createDataFrame(
        [(1, [d - dt.timedelta(days=1)], d - dt.timedelta(days=1)), (2, [d - dt.timedelta(days=1)], d - dt.timedelta(days=1))],
        "user_id long, dates_active array<date>, date date",
    )
    ev = spark.createDataFrame(
        [(1, dt.datetime(2023, 1, 10, 5)), (1, dt.datetime(2023, 1, 10, 6)), (3, dt.datetime(2023, 1, 10, 7)),
         (None, dt.datetime(2023, 1, 10, 8))],
        "user_id long, event_time timestamp_ntz",
    )
    out = activity.activity_step(prev, ev, d)
    got = {r.user_id: r.dates_active for r in out.collect()}
    assert got == {1: [d, d - dt.timedelta(days=1)], 2: [d - dt.timedelta(days=1)], 3: [d]}


def _bitmap(spark, dates):
    snap = spark.createDataFrame([(1, dates, D)], "user_id long, dates_active array<date>, date date")
    return activity.activity_bitmap(snap, D).collect()[0]


def test_c11_bitmap(spark):
    r = _bitmap(spark, [D, days_before(1), days_before(7), days_before(31), days_before(32)])
    assert r.activity_bits == (1 << 31) | (1 << 30) | (1 << 24) | 1
    assert r.dim_monthly_active_for_n_days == 4
    assert r.dim_is_weekly_active and r.dim_is_daily_active and r.dim_is_monthly_active


def test_c12_bitmap_week_boundary(spark):
    r = _bitmap(spark, [days_before(7)])
    assert (r.dim_is_weekly_active, r.dim_is_monthly_active, r.dim_is_daily_active) == (False, True, False)


def test_bitmap_literal_exponent(spark):
    snap = spark.createDataFrame([(1, [D, days_before(1)], D)], "user_id long, dates_active array<date>, date date")
    r = activity.activity_bitmap(snap, D, anchor_bit=32).collect()[0]
    # the as-of day's bit falls off the 32-bit map: one day counted, and the
    # day before lands on the top bit, so "daily" reports yesterday
    assert r.dim_monthly_active_for_n_days == 1
    assert r.dim_is_daily_active


def _hits(spark, rows):
    return spark.createDataFrame(rows, "user_id long, event_time timestamp_ntz")


def _arrays(df):
    return {(r.user_id, r.month_start): r.metric_array for r in df.collect()}


def test_c13_c14_metric_arrays(spark):
    ev = _hits(spark, [(7, dt.datetime(2023, 1, 6, h)) for h in range(3)])
    day5 = metrics.array_metric_step(None, ev, dt.date(2023, 1, 6))
    assert _arrays(day5) == {(7, dt.date(2023, 1, 1)): [0, 0, 0, 0, 0, 3]}
    day6 = metrics.array_metric_step(day5, ev, dt.date(2023, 1, 7))
    assert _arrays(day6) == {(7, dt.date(2023, 1, 1)): [0, 0, 0, 0, 0, 3, 0]}
    # rerun of day 6 from the same prior: same result
    again = metrics.array_metric_step(day5, ev, dt.date(2023, 1, 7))
    assert _arrays(again) == _arrays(day6)
    # day 7 with day 6 skipped: prior is day 5's arrays (as of 2023-01-06)
    skipped = metrics.array_metric_step(day5.withColumn("as_of", F.lit(dt.date(2023, 1, 7))), ev, dt.date(2023, 1, 8))
    arr = _arrays(skipped)[(7, dt.date(2023, 1, 1))]
    assert len(arr) == 8 and arr[6] == 0 and arr[5] == 3


def test_c15_daily_sum(spark):
    arrays = spark.createDataFrame(
        [(1, dt.date(2023, 1, 1), "site_hits", [1, 2]), (2, dt.date(2023, 1, 1), "site_hits", [0, 5, 7])],
        "user_id long, month_start date, metric_name string, metric_array array<bigint>",
    )
    out = metrics.array_metric_daily(arrays)
    assert rows_of(out, "metric_date", "value") == [
        (dt.date(2023, 1, 1), 1),
        (dt.date(2023, 1, 2), 7),
        (dt.date(2023, 1, 3), 7),
    ]


def test_c16_new_month(spark):
    ev = _hits(spark, [(7, dt.datetime(2023, 1, 31, 1)), (7, dt.datetime(2023, 2, 1, 1))])
    jan31 = metrics.array_metric_step(None, ev, dt.date(2023, 1, 31))
    assert len(_arrays(jan31)[(7, dt.date(2023, 1, 1))]) == 31
    feb1 = metrics.array_metric_step(jan31, ev, dt.date(2023, 2, 1))
    assert _arrays(feb1) == {(7, dt.date(2023, 2, 1)): [1]}


def test_c17_conditional_rate(spark):
    fact = spark.createDataFrame([("p", True), ("p", False), ("p", False)], "dim_player_name string, dim_not_with_team boolean")
    r = facts.conditional_rate(fact, "dim_player_name", "dim_not_with_team").collect()[0]
    assert (r.times_nwt, r.total_games_played) == (1, 3)
    assert r.bailed_pct == pytest.approx(1 / 3)


def test_backfill_skips_entities_starting_after_last(spark):
    src = spark.createDataFrame(
        [("A", 1996, "X", 1, 21.0, 1.0, 1.0), ("B", 1999, "Y", 1, 9.0, 1.0, 1.0)], SEASON_SCHEMA
    )
    out = cumulative.cumulative_backfill(src, SPEC, last=1997)
    assert rows_of(out, "player_name", "current_season") == [("A", 1996), ("A", 1997)]
    only = cumulative.cumulative_backfill(src, SPEC, first=1998, last=1998)
    assert rows_of(only, "player_name", "current_season") == [("A", 1998)]


def test_c14_fold_carries_state_over_a_skipped_day(spark):
    from strata.plans.fold import fold
    from strata.sources.snapshots import SnapshotTable

    ev = _hits(spark, [(7, dt.datetime(2023, 1, 6, h)) for h in range(3)] + [(7, dt.datetime(2023, 1, 8, 1))])
    table = SnapshotTable.scratch(spark, "c14", "as_of")
    days = [dt.date(2023, 1, 6), dt.date(2023, 1, 8)]  # day 7 skipped
    fold(table, days, lambda prev, d: metrics.array_metric_step(prev, ev, d), lambda d: d - dt.timedelta(days=1),
         carry_latest=True)
    assert _arrays(table.read(as_of=dt.date(2023, 1, 8))) == {(7, dt.date(2023, 1, 1)): [0, 0, 0, 0, 0, 3, 0, 1]}
    # rerun of day 8: same partition content
    fold(table, days[1:], lambda prev, d: metrics.array_metric_step(prev, ev, d), lambda d: d - dt.timedelta(days=1),
         carry_latest=True)
    assert _arrays(table.read(as_of=dt.date(2023, 1, 8))) == {(7, dt.date(2023, 1, 1)): [0, 0, 0, 0, 0, 3, 0, 1]}


def test_metric_step_leaves_other_metrics_alone(spark):
    ev = _hits(spark, [(7, dt.datetime(2023, 1, 2, 1))])
    prev = spark.createDataFrame(
        [(7, dt.date(2023, 1, 1), "purchases", [4], dt.date(2023, 1, 1)),
         (7, dt.date(2023, 1, 1), "site_hits", [2], dt.date(2023, 1, 1))],
        "user_id long, month_start date, metric_name string, metric_array array<bigint>, as_of date",
    )
    out = metrics.array_metric_step(prev, ev, dt.date(2023, 1, 2))
    assert {(r.metric_name, tuple(r.metric_array)) for r in out.collect()} == {("site_hits", (2, 1))}


def test_change_detection_null_semantics(spark):
    snap = spark.createDataFrame(
        [("A", 1, "x"), ("A", 2, None), ("A", 3, None), ("A", 4, "y")], "k string, p int, c string"
    )
    safe = rows_of(scd.detect_changes(snap, "k", "p", ["c"]), "p", "c_change_indicator")
    literal = rows_of(scd.detect_changes(snap, "k", "p", ["c"], null_safe=False), "p", "c_change_indicator")
    assert safe == [(1, 0), (2, 1), (3, 0), (4, 1)]
    assert literal == [(1, 0), (2, 0), (3, 0), (4, 0)]  # `<>` with NULL never fires


def test_history_explode_one_entity_and_lookup_predicates(spark, c1):
    one = cumulative.history_explode(c1, SPEC, as_of=2000, key_value="A")
    assert rows_of(one, "season", "pts") == [(1996, 21.0), (1997, 21.0), (1999, 9.0)]
    assert cumulative.history_explode(c1, SPEC, as_of=2000, key_value="nobody").isEmpty()
    stars = cumulative.snapshot_lookup(
        c1, "current_season", 1998, predicates=[F.col("scoring_class") == "star"], cols=["player_name", "is_active"]
    )
    assert rows_of(stars) == [("A", False)]
    assert cumulative.snapshot_lookup(c1, "current_season", 1999, [F.col("scoring_class") == "star"]).isEmpty()


def test_reports_order_desc_with_nulls_first(spark):
    rows = [("a", [(1, 1, 0.0, 0.0, 0.0), (2, 1, 5.0, 0.0, 0.0)]), ("b", [(1, 1, 4.0, 0.0, 0.0), (2, 1, 6.0, 0.0, 0.0)]),
            ("c", [(1, 1, None, 0.0, 0.0), (2, 1, 6.0, 0.0, 0.0)])]
    schema = "player_name string, season_stats array<struct<season:int,gp:int,pts:double,reb:double,ast:double>>"
    snap = spark.createDataFrame(rows, schema).withColumn("current_season", F.lit(2)).withColumn(
        "scoring_class", F.lit("star")
    )
    ordered = [r.player_name for r in cumulative.first_vs_latest(snap, SPEC, as_of=2).collect()]
    assert ordered == ["c", "a", "b"]  # NULL first (as in a DESC sort with NULLS FIRST), then 5.0, 1.5
    fact = spark.createDataFrame(
        [("p", True), ("p", False), ("q", True), ("r", False)], "dim_player_name string, dim_not_with_team boolean"
    )
    rates = [(r.dim_player_name, r.bailed_pct) for r in facts.conditional_rate(fact, "dim_player_name", "dim_not_with_team").collect()]
    assert rates == [("q", 1.0), ("p", 0.5), ("r", 0.0)]


def test_grain_check_and_period_bounds(spark):
    from strata.operators import quality

    df = spark.createDataFrame([(1, "x", 1995), (1, "x", 1996), (2, "y", 1997), (1, "z", 1995)], "k int, a string, p int")
    assert rows_of(quality.grain_check(df, ["k", "a"])) == [(1, "x", 2)]
    assert quality.grain_check(df, ["k", "a", "p"]).isEmpty()
    assert rows_of(quality.period_bounds(df, "p")) == [(1995, 1997)]
    assert quality.bounds_of(df, "p") == (1995, 1997)


DETAIL = "game_id long, team_id int, player_id long, player_name string, start_position string, comment string, min string, ord int"
HEADER = "game_id long, game_date_est date, season int, home_team_id int"


def test_fact_keeps_its_grain_with_repeated_headers(spark):
    details = spark.createDataFrame([(1, 1, 1, "a", "F", None, "1:00", 2), (1, 1, 1, "a", "F", None, "2:00", 1)], DETAIL)
    games = spark.createDataFrame([(1, dt.date(2020, 1, 2), 2020, 1), (1, dt.date(2020, 1, 1), 2019, 2)], HEADER)
    out = facts.build_fact(details, games, order=["ord"], measures={"ord": "m_ord"})
    assert rows_of(out, "dim_game_date", "dim_season", "m_ord") == [(dt.date(2020, 1, 1), 2019, 1)]


def test_fact_rejects_missing_measures(spark):
    details, games = spark.createDataFrame([], DETAIL), spark.createDataFrame([], HEADER)
    with pytest.raises(ValueError, match="fgm"):
        facts.build_fact(details, games, order=["ord"])


def test_one_vertex_for_an_id_with_two_names(spark):
    rows = spark.createDataFrame([(1, "Old", 3), (1, "New", 4)], "player_id long, player_name string, pts int")
    v = graph.aggregate_vertices(rows, "player_id", "player", {"total_points": F.sum("pts")}, static=["player_name"])
    assert rows_of(v, "identifier", "properties") == [("1", '{"player_name":"Old","total_points":7}')]
