"""Registered queries: each runs one operator of the inventory over the whole
testdata tables (through the adapter views) and returns a scalar-only report.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names and types match its SQL twin in ``strata.plans.oracle``. Arrays are
rendered as delimited text and dates as ISO text so two engines can be
compared value by value.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..functions.columns import ENTITY_PERIOD_TIERS, iso_date, json_struct, render_list
from ..operators import activity, cumulative, facts, graph, metrics, quality, scd
from ..operators.cumulative import CumulativeSpec
from ..operators.skew import largest_group
from ..plans import jobs
from ..plans.fold import fold
from ..sources import footers
from ..sources import testdata as src
from ..session import state_path
from ..sources.changes import ChangeTable
from ..sources.snapshots import SnapshotTable

ENTITY_SPEC = CumulativeSpec(
    key="entity_id",
    period="period",
    dims=("name", "segment", "top_priority"),
    stats=("gp", "pts", "reb", "ast"),
    measure="pts",
    tiers=ENTITY_PERIOD_TIERS,
)
SCD_ATTRS = ("scoring_class", "is_active")
LINEITEM_ORDER = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]


# ---------------------------------------------------------------- helpers


def _entity_bounds(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """First and last order year: one aggregate over one column, no join."""
    lo, hi = quality.bounds_of(src.read_table(spark, sf_dir, "orders").select("o_orderdate"), "o_orderdate")
    return lo.year, hi.year


def _hit_day_bounds(hits: DataFrame) -> tuple[dt.date, dt.date]:
    days = hits.where(F.col("user_id").isNotNull()).select(F.to_date("event_time").alias("d"))
    return quality.bounds_of(days, "d")


def _days(lo: dt.date, hi: dt.date) -> list[dt.date]:
    return [lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)]


def snapshot_report(snap: DataFrame, spec: CumulativeSpec = ENTITY_SPEC) -> DataFrame:
    h = F.col(spec.history)
    return snap.select(
        spec.key,
        spec.as_of,
        *spec.dims,
        F.size(h).cast("int").alias("n_seasons"),
        render_list(h, spec.period).alias("seasons"),
        *[render_list(h, c).alias(f"{c}_history") for c in spec.stats],
        spec.cls,
        spec.idle,
        spec.active,
    )


def entity_backfill(spark: SparkSession, sf_dir: str, first=None, last=None, dims_mode="max") -> DataFrame:
    return cumulative.cumulative_backfill(
        src.entity_periods(spark, sf_dir), ENTITY_SPEC, first=first, last=last, dims_mode=dims_mode
    )


def entity_fold(spark: SparkSession, sf_dir: str) -> SnapshotTable:
    """Snapshot table built with O01 steps, one for every period; each is one written partition.

    The source is staged once as a table partitioned by period (as a
    player-seasons table would be stored), so each step reads exactly one
    source partition and one snapshot partition.
    """
    staged = SnapshotTable.scratch(spark, "player_seasons", ENTITY_SPEC.period, sort_cols=[ENTITY_SPEC.key])
    staged.write(src.entity_periods(spark, sf_dir))
    seasons = staged.read()
    present = staged.periods()  # from the partition listing, no job
    table = SnapshotTable.scratch(spark, "players", ENTITY_SPEC.as_of, sort_cols=[ENTITY_SPEC.key])
    return fold(
        table,
        range(present[0], present[-1] + 1),
        lambda prev, p: cumulative.cumulative_step(prev, seasons, ENTITY_SPEC, p),
        previous_of=lambda p: p - 1,
    )


def graph_vertices_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    teams = graph.build_vertices(
        src.teams(spark, sf_dir),
        "team_id",
        "team",
        {
            "abbreviation": "abbreviation",
            "nickname": "nickname",
            "city": "city",
            "arena": "arena",
            "year_founded": "yearfounded",
        },
        order=["ord_supp"],
    )
    return teams.unionByName(player_vertices(src.player_games(spark, sf_dir))).unionByName(game_vertices(spark, sf_dir))


def player_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Game details at one row per (player, game), written once to the shared folder.

    Player vertices, plays_in edges and pair edges all start from this table.
    """
    path = state_path(spark, "player_games")
    rows = src.player_games(spark, sf_dir).select(
        "player_id", "game_id", "player_name", "team_id", "team_abbreviation", "start_position", "pts"
    )
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def player_vertices(games_of_players: DataFrame, typed: bool = False) -> DataFrame:
    return graph.aggregate_vertices(
        games_of_players,
        "player_id",
        "player",
        {"number_of_games": F.count(F.lit(1)), "total_points": F.sum("pts")},
        static=["player_name"],
        typed=typed,
    )


def game_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.build_vertices(
        src.games(spark, sf_dir),
        "game_id",
        "game",
        {"game_date": "game_date_est", "season": "season", "home_team_id": "home_team_id"},
    )


def plays_in_edges(games_of_players: DataFrame, typed: bool = False) -> DataFrame:
    return graph.bipartite_edges(
        games_of_players,
        "player_id",
        "player",
        "game_id",
        "game",
        "plays_in",
        {
            "start_position": "start_position",
            "pts": "pts",
            "team_id": "team_id",
            "team_abbreviation": "team_abbreviation",
        },
        typed=typed,
    )


def pair_edges(games_of_players: DataFrame, typed: bool = False, largest: int | None = None) -> DataFrame:
    return graph.cooccurrence_edges(
        games_of_players,
        member="player_id",
        group="game_id",
        side="team_abbreviation",
        measure="pts",
        order=None,
        typed=typed,
        largest=largest,
    )


def fact_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a player has one team: the first line per (game, player) is the one per (game, team, player)
    return facts.build_fact(src.player_games(spark, sf_dir), src.games(spark, sf_dir), order=None)


def _month_last_days(days: list[dt.date]) -> list[dt.date]:
    last = {}
    for d in days:
        last[metrics.month_start(d)] = d
    return sorted(last.values())


def metric_exprs() -> dict:
    """Two metrics of one job: hits, and kinds of events, per user and day."""
    return {**metrics.default_metrics(), "event_kinds": F.countDistinct("event_type")}


def metric_fold(spark: SparkSession, sf_dir: str) -> tuple[SnapshotTable, list[dt.date]]:
    """Month arrays built with O19 steps, one for every day; the table and each month's last day."""
    h = src.hits(spark, sf_dir)
    days = _days(*_hit_day_bounds(h))
    table = SnapshotTable.scratch(spark, "array_metrics", "as_of", sort_cols=["user_id"])
    fold(
        table,
        days,
        lambda prev, d: metrics.array_metric_step(prev, h, d, metric_exprs()),
        previous_of=lambda d: d - dt.timedelta(days=1),
        carry_latest=True,
    )
    return table, _month_last_days(days)


def activity_fold(spark: SparkSession, sf_dir: str) -> SnapshotTable:
    """Date-list table built with O17 steps, one for every day."""
    h = src.hits(spark, sf_dir)
    table = SnapshotTable.scratch(spark, "users_cumulated", "date", sort_cols=["user_id"])
    return fold(
        table,
        _days(*_hit_day_bounds(h)),
        lambda prev, d: activity.activity_step(prev, h, d),
        previous_of=lambda d: d - dt.timedelta(days=1),
        carry_latest=True,
    )


COMPACT_DAYS = 10  # a base is written after so many days of changes


def _change_days(table: ChangeTable, days: list[dt.date], write) -> ChangeTable:
    """A partition of change rows for every day; after each run of days a new base."""
    for at in range(0, len(days), COMPACT_DAYS):
        run = days[at : at + COMPACT_DAYS]
        write(run[0], run[-1])
        if at + COMPACT_DAYS < len(days):
            table.compact(run[-1])
    return table


def metric_days(spark: SparkSession, sf_dir: str) -> tuple[ChangeTable, list[dt.date]]:
    """Month arrays (O19) from every day's change rows; the table and each month's last day."""
    h = src.hits(spark, sf_dir)
    days = _days(*_hit_day_bounds(h))
    table = jobs.metric_changes(spark)
    _change_days(table, days, lambda lo, hi: jobs.metric_change_days(table, h, lo, hi, metric_exprs()))
    return table, _month_last_days(days)


def activity_days(spark: SparkSession, sf_dir: str) -> tuple[ChangeTable, dt.date]:
    """Packed day sets (O17) from every day's change rows; the table and the last day."""
    h = src.hits(spark, sf_dir)
    days = _days(*_hit_day_bounds(h))
    table = jobs.activity_changes(spark)
    _change_days(table, days, lambda lo, hi: jobs.activity_change_days(table, h, lo, hi))
    return table, days[-1]


# ---------------------------------------------------------------- queries


def q_period_bounds(spark, sf_dir):
    return quality.period_bounds(src.order_periods(spark, sf_dir), "period")


def q_period_bounds_stored(spark, sf_dir):
    """On the stored table of seasons: from the file footers."""
    path = state_path(spark, "player_seasons")
    src.entity_periods(spark, sf_dir).write.parquet(path)
    return footers.stored_bounds(spark, path, "period")


def q_grain_check(spark, sf_dir):
    return src.game_detail_counts(spark, sf_dir).where("num_rows > 1")


def q_grain_check_lineitem(spark, sf_dir):
    return quality.grain_check(src.read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_grain_check_player(spark, sf_dir):
    """The dimension that lines are joined with: players that stand in it more than once."""
    return src.player_dimension_counts(spark, sf_dir).where("num_rows > 1")


def q_grain_check_player_game(spark, sf_dir):
    return src.game_detail_counts(spark, sf_dir).where("num_rows > 1").drop("team_id")


def q_grain_counts(spark, sf_dir):
    return src.game_detail_counts(spark, sf_dir).drop("team_id")


def q_dedup_first(spark, sf_dir):
    li = src.read_table(spark, sf_dir, "lineitem")
    out = quality.dedup_first(li, ["l_orderkey", "l_linenumber"], LINEITEM_ORDER)
    return out.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


def q_cumulative_step(spark, sf_dir):
    return snapshot_report(entity_fold(spark, sf_dir).read())


def q_cumulative_backfill(spark, sf_dir):
    return snapshot_report(entity_backfill(spark, sf_dir))


def _last_period(spark, sf_dir) -> int:
    """The last period: one tiny aggregate row read on the driver.

    (A scalar subquery would keep it inside the plan, but each use of it
    inlines another copy of the subquery plan.)
    """
    return _entity_bounds(spark, sf_dir)[1]


def q_history_explode(spark, sf_dir):
    hi = _last_period(spark, sf_dir)
    snap = entity_backfill(spark, sf_dir, first=hi, last=hi)
    return cumulative.history_explode(snap, ENTITY_SPEC, as_of=hi)


def q_first_vs_latest(spark, sf_dir):
    hi = _last_period(spark, sf_dir)
    snap = entity_backfill(spark, sf_dir, first=hi, last=hi)
    return cumulative.first_vs_latest(snap, ENTITY_SPEC, as_of=hi, cls="star")


def q_history_explode_one(spark, sf_dir):
    """The unnested history of one entity, the first of the stored snapshot's names."""
    hi = _last_period(spark, sf_dir)
    one = src.read_table(spark, sf_dir, "orders").agg(F.min("o_custkey")).first()[0]
    snap = entity_backfill(spark, sf_dir, first=hi, last=hi)
    return cumulative.history_explode(snap, ENTITY_SPEC, as_of=hi, key_value=one)


_STORED: dict[tuple[str, str], str] = {}


def _stored_players(spark, sf_dir) -> str:
    """Path of the players table, stored once per application and source: lookups and increments start from it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        path = state_path(spark, "players_backfill")
        jobs.players_backfill(spark, src.entity_periods(spark, sf_dir), path, ENTITY_SPEC)
        _STORED[key] = path
    return _STORED[key]


def _lookup(spark, sf_dir, *predicates):
    # the as-of of a lookup is a known value, so the read is a static
    # partition-pruned scan of the written snapshot table
    players = SnapshotTable.open(spark, _stored_players(spark, sf_dir), ENTITY_SPEC.as_of)
    return cumulative.snapshot_lookup(
        players.read(),
        ENTITY_SPEC.as_of,
        players.periods()[-1],
        predicates,
        cols=[ENTITY_SPEC.key, "scoring_class", "is_active"],
    )


def q_snapshot_columns(spark, sf_dir):
    """Snapshots whose columns change halfway: one is renamed, one is added, later seasons are stepped on."""
    seasons = src.entity_periods(spark, sf_dir)
    lo, hi = _entity_bounds(spark, sf_dir)
    half = (lo + hi) // 2
    before = replace(ENTITY_SPEC, cls="scorer_class")
    table = SnapshotTable.scratch(spark, "players", ENTITY_SPEC.as_of, sort_cols=[ENTITY_SPEC.key])
    table.write(cumulative.cumulative_backfill(seasons, before, last=half))
    table.rename_column("scorer_class", ENTITY_SPEC.cls)
    table.add_column("games_so_far", LongType())
    table = SnapshotTable.open(spark, table.path, ENTITY_SPEC.as_of, sort_cols=[ENTITY_SPEC.key])

    def step(prev, period):
        games = F.aggregate(ENTITY_SPEC.history, F.lit(0).cast("bigint"), lambda n, x: n + x["gp"])
        snap = cumulative.cumulative_step(prev, seasons, ENTITY_SPEC, period)
        return snap.withColumn("games_so_far", games)

    rows = fold(table, range(half + 1, hi + 1), step, lambda p: p - 1).read()
    return rows.select("entity_id", "current_season", "scoring_class", "is_active", "games_so_far")


def q_snapshot_lookup(spark, sf_dir):
    return _lookup(spark, sf_dir)


def q_snapshot_lookup_star(spark, sf_dir):
    """Predicated lookup: the active members of one class."""
    return _lookup(spark, sf_dir, F.col("scoring_class") == "star", F.col("is_active"))


def q_detect_changes(spark, sf_dir):
    return scd.detect_changes(entity_backfill(spark, sf_dir), "entity_id", "current_season", SCD_ATTRS)


def q_streaks(spark, sf_dir):
    # a report: ordered by entity like the reference's streak query
    return scd.streaks(entity_backfill(spark, sf_dir), "entity_id", "current_season", SCD_ATTRS).orderBy("entity_id")


def q_scd2_full(spark, sf_dir):
    hi = _last_period(spark, sf_dir)
    return scd.scd2_full(entity_backfill(spark, sf_dir, last=hi), "entity_id", "current_season", SCD_ATTRS, as_of=hi)


def _last_snapshot(spark, sf_dir) -> tuple[DataFrame, int]:
    """The stored snapshots' last partition, and its as-of."""
    players = SnapshotTable.open(spark, _stored_players(spark, sf_dir), ENTITY_SPEC.as_of)
    hi = players.periods()[-1]
    return players.read(as_of=hi), hi


def q_changes_from_history(spark, sf_dir):
    return scd.changes_from_history(*_of_last(spark, sf_dir))


def q_streaks_from_history(spark, sf_dir):
    return scd.streaks_from_history(*_of_last(spark, sf_dir))


def q_scd2_from_history(spark, sf_dir):
    return scd.scd2_from_history(*_of_last(spark, sf_dir))


def _of_last(spark, sf_dir) -> tuple[DataFrame, CumulativeSpec, int]:
    snap, hi = _last_snapshot(spark, sf_dir)
    return snap, ENTITY_SPEC, hi


def q_scd2_catch_up(spark, sf_dir):
    """On stored tables: SCD2 three seasons ago, then the three seasons at once."""
    players, history = _stored_players(spark, sf_dir), state_path(spark, "players_scd")
    periods = SnapshotTable.open(spark, players, ENTITY_SPEC.as_of).periods()
    jobs.scd_full(spark, players, history, ENTITY_SPEC, as_of=periods[max(0, len(periods) - 4)], attrs=SCD_ATTRS)
    return jobs.scd_catch_up(spark, players, history, ENTITY_SPEC, season=periods[-1], attrs=SCD_ATTRS).read(as_of=periods[-1])


def q_scd2_incremental(spark, sf_dir):
    """On stored tables: SCD2 as of the last period but one, then one increment."""
    players, history = _stored_players(spark, sf_dir), state_path(spark, "players_scd")
    hi = SnapshotTable.open(spark, players, ENTITY_SPEC.as_of).periods()[-1]
    jobs.scd_full(spark, players, history, ENTITY_SPEC, as_of=hi - 1, attrs=SCD_ATTRS)
    return jobs.scd_increment(spark, players, history, ENTITY_SPEC, season=hi, attrs=SCD_ATTRS).read(as_of=hi)


def q_fact_game_details(spark, sf_dir):
    return fact_df(spark, sf_dir).withColumn("dim_game_date", iso_date("dim_game_date"))


def q_bailed_pct(spark, sf_dir):
    # neither game date nor home team matters: the fact's lines without its header
    flags = facts.comment_flags(src.player_games(spark, sf_dir)).withColumnRenamed("player_name", "dim_player_name")
    return facts.conditional_rate(flags, "dim_player_name", "dim_not_with_team")


def q_graph_vertices(spark, sf_dir):
    v = graph_vertices_df(spark, sf_dir)
    kv = F.from_json("properties", "map<string,string>")
    return v.select("identifier", "type", F.explode(kv).alias("prop_key", "prop_value"))


def q_graph_vertex_counts(spark, sf_dir):
    return graph.vertex_type_counts(graph_vertices_df(spark, sf_dir))


def q_graph_vertex_counts_stored(spark, sf_dir):
    """On the stored vertices, a folder per type: from the file footers."""
    path = state_path(spark, "vertices")
    graph_vertices_df(spark, sf_dir).write.partitionBy("type").parquet(path)
    return footers.stored_counts(spark, path, ["type"], "num_vertices")


def q_graph_edges_plays_in(spark, sf_dir):
    e = plays_in_edges(src.player_games(spark, sf_dir))
    props = json_struct("properties", "start_position string, pts int, team_id int, team_abbreviation string")
    return e.select(
        "subject_identifier", "subject_type", "object_identifier", "object_type", "edge_type", props.alias("p")
    ).select("subject_identifier", "subject_type", "object_identifier", "object_type", "edge_type", "p.*")


def q_graph_edges_pairs(spark, sf_dir):
    games = player_games(spark, sf_dir)
    e = pair_edges(games, largest=largest_group(games, ["game_id"]))
    props = json_struct("properties", "num_games bigint, subject_points bigint, object_points bigint")
    return e.select(
        "subject_identifier", "subject_type", "object_identifier", "object_type", "edge_type", props.alias("p")
    ).select("subject_identifier", "subject_type", "object_identifier", "object_type", "edge_type", "p.*")


def q_graph_max_points(spark, sf_dir):
    games = player_games(spark, sf_dir)
    best = graph.vertex_edge_max(
        player_vertices(games, typed=True),
        plays_in_edges(games, typed=True),
        "pts",
        "player_name",
        dtype="int",
        edge_type="plays_in",
        out_value="max_pts",
    )
    return best.orderBy(F.col("max_pts").desc_nulls_first())


def q_graph_pair_report(spark, sf_dir):
    games = player_games(spark, sf_dir)
    edges, path = pair_edges(games, typed=True, largest=largest_group(games, ["game_id"])), state_path(spark, "pair_edges")
    edges.write.parquet(path)  # the order's sample of names reads them: the pairs are not made twice
    edges = spark.read.schema(edges.schema).parquet(path)
    report = graph.vertex_edge_report(player_vertices(games, typed=True), edges)
    return report.orderBy("player_name")


def q_activity_datelist(spark, sf_dir):
    table, last = activity_days(spark, sf_dir)
    s = activity.datelists(table.read(last), last)
    return s.select(
        "user_id",
        iso_date("date").alias("snapshot_date"),
        render_list("dates_active").alias("dates_active"),
        F.size("dates_active").cast("int").alias("n_dates"),
    )


def q_activity_bitmap(spark, sf_dir):
    h = src.hits(spark, sf_dir)
    _, hi = _hit_day_bounds(h)
    snap = activity.activity_backfill(h, hi, snapshots_from=hi)
    bm = activity.activity_bitmap(snap, hi).withColumn("date", iso_date("date")).withColumnRenamed("date", "snapshot_date")
    return bm.orderBy(F.col("dim_monthly_active_for_n_days").desc_nulls_first())


ROLL_DAYS = 6  # days that a step of the rolling bitmaps takes in


def q_activity_bitmap_rolling(spark, sf_dir):
    """O18 kept as one LONG per user, stepped through the days; the last day's flags."""
    h = src.hits(spark, sf_dir)
    path = state_path(spark, "rolling-bitmaps")
    days = _days(*_hit_day_bounds(h))
    for day in days[::-1][::ROLL_DAYS][::-1]:  # the last step ends on the last day
        table = jobs.bitmap_day(spark, h, path, day)
    bm = activity.bitmap_flags(table.read(as_of=day)).withColumn("date", iso_date("date"))
    return bm.withColumnRenamed("date", "snapshot_date").orderBy(F.col("dim_monthly_active_for_n_days").desc_nulls_first())


def q_activity_bitmap_events(spark, sf_dir):
    """O18 computed from events with a ``bit_or`` aggregate (same result as ``activity_bitmap``)."""
    h = src.hits(spark, sf_dir)
    _, hi = _hit_day_bounds(h)
    bm = activity.activity_bitmap_from_events(h, hi).withColumn("date", iso_date("date"))
    return bm.withColumnRenamed("date", "snapshot_date").orderBy(F.col("dim_monthly_active_for_n_days").desc_nulls_first())


def q_activity_bitmap_literal(spark, sf_dir):
    """O18 with the literal exponent 32 - n over a 31-day series (the reference's own numbers)."""
    h = src.hits(spark, sf_dir)
    _, hi = _hit_day_bounds(h)
    bm = activity.activity_bitmap_from_events(h, hi, anchor_bit=32, window_days=31)
    return bm.select(
        "user_id",
        "activity_bits",
        "dim_monthly_active_for_n_days",
        "dim_is_monthly_active",
        "dim_is_weekly_active",
        "dim_is_daily_active",
    ).orderBy(F.col("dim_monthly_active_for_n_days").desc_nulls_first())


def q_array_metrics(spark, sf_dir):
    table, month_last = metric_days(spark, sf_dir)
    s = table.read(month_last[0])
    for day in month_last[1:]:
        s = s.unionByName(table.read(day))
    return s.select(
        "user_id",
        iso_date("month_start").alias("month_start"),
        "metric_name",
        F.posexplode("metric_array").alias("day_index", "value"),
    )


def q_array_metrics_daily(spark, sf_dir):
    h = src.hits(spark, sf_dir)
    lo, hi = _hit_day_bounds(h)
    arrays = metrics.array_metric_backfill(h, metrics.month_start(lo), hi, metric_exprs())
    return metrics.array_metric_daily(arrays).withColumn("metric_date", iso_date("metric_date"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "period_bounds": q_period_bounds,
    "period_bounds_stored": q_period_bounds_stored,
    "grain_check": q_grain_check,
    "grain_check_lineitem": q_grain_check_lineitem,
    "grain_check_player": q_grain_check_player,
    "grain_check_player_game": q_grain_check_player_game,
    "grain_counts": q_grain_counts,
    "dedup_first": q_dedup_first,
    "cumulative_step": q_cumulative_step,
    "cumulative_backfill": q_cumulative_backfill,
    "history_explode": q_history_explode,
    "history_explode_one": q_history_explode_one,
    "first_vs_latest": q_first_vs_latest,
    "snapshot_columns": q_snapshot_columns,
    "snapshot_lookup": q_snapshot_lookup,
    "snapshot_lookup_star": q_snapshot_lookup_star,
    "detect_changes": q_detect_changes,
    "streaks": q_streaks,
    "scd2_full": q_scd2_full,
    "scd2_incremental": q_scd2_incremental,
    "scd2_catch_up": q_scd2_catch_up,
    "changes_from_history": q_changes_from_history,
    "streaks_from_history": q_streaks_from_history,
    "scd2_from_history": q_scd2_from_history,
    "fact_game_details": q_fact_game_details,
    "bailed_pct": q_bailed_pct,
    "graph_vertices": q_graph_vertices,
    "graph_vertex_counts": q_graph_vertex_counts,
    "graph_vertex_counts_stored": q_graph_vertex_counts_stored,
    "graph_edges_plays_in": q_graph_edges_plays_in,
    "graph_edges_pairs": q_graph_edges_pairs,
    "graph_max_points": q_graph_max_points,
    "graph_pair_report": q_graph_pair_report,
    "activity_datelist": q_activity_datelist,
    "activity_bitmap": q_activity_bitmap,
    "activity_bitmap_rolling": q_activity_bitmap_rolling,
    "activity_bitmap_events": q_activity_bitmap_events,
    "activity_bitmap_literal": q_activity_bitmap_literal,
    "array_metrics": q_array_metrics,
    "array_metrics_daily": q_array_metrics_daily,
}
