"""State kept small: packed day sets, change rows with bases, rolling bitmaps, versioned tables, SCD2 without windows."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from strata.functions import dateset
from strata.operators import activity, cumulative, graph, metrics, scd
from strata.plans import jobs
from strata.plans import queries as Q
from strata.session import state_path
from strata.sources import footers
from strata.sources import testdata as src
from strata.sources.snapshots import ColumnMismatchError, SnapshotTable
from strata.sources.versions import VersionedTable

from .conftest import rows_of, same_rows

EVENTS = "user_id long, event_time timestamp, event_type string"


def day(n: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def events_of(spark, rows):
    """rows: (user, day number), several per day possible."""
    return spark.createDataFrame([(u, dt.datetime.combine(day(n), dt.time(12)), "x") for u, n in rows], EVENTS)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------ packed day sets


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(-200, 20_000), max_size=12), min_size=1, max_size=6))
def test_day_sets_round_trip(spark, lists):
    epoch = dt.date(1970, 1, 1)
    rows = [(i, [epoch + dt.timedelta(days=n) for n in x] or None) for i, x in enumerate(lists)]
    df = spark.createDataFrame(rows, "id int, d array<date>").withColumn("s", dateset.pack("d"))
    cut = epoch + dt.timedelta(days=9_000)
    got = df.select(
        "id",
        dateset.unpack("s").alias("back"),
        dateset.size("s").alias("n"),
        dateset.unpack(dateset.upto("s", F.lit(cut))).alias("upto"),
        dateset.window_bits("s", F.lit(cut)).alias("bits"),
    )
    for r in got.collect():
        days = sorted(set(rows[r.id][1] or []))
        if not days:
            assert r.back is None and r.n is None
            continue
        assert r.back == days and r.n == len(days)
        assert r.upto == [d for d in days if d <= cut]
        assert r.bits == sum(1 << (31 - (cut - d).days) for d in days if 0 <= (cut - d).days < 32)


def test_day_set_takes_six_words_a_year(spark):
    dates = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(366)]
    s = spark.createDataFrame([(dates,)], "d array<date>").select(dateset.pack("d").alias("s"))
    assert s.select(F.size("s.words")).first()[0] in (6, 7)  # 8 bytes each; a year spans at most 7


# ------------------------------------------------------------ change rows


HITS = [(1, 0), (1, 0), (1, 2), (2, 2), (3, 5), (1, 5), (1, 33), (2, 70), (4, 70), (None, 3)]


def test_activity_changes_equal_the_date_lists(spark):
    h = events_of(spark, HITS)
    table = jobs.activity_changes(spark)
    jobs.activity_change_days(table, h, day(0), day(9))
    table.compact(day(9))
    for n in range(10, 71, 10):
        jobs.activity_change_days(table, h, day(n), day(min(n + 9, 70)))
    table.compact(day(40))
    for n in (0, 2, 9, 10, 40, 70):
        lists = activity.datelists(table.read(day(n)), day(n)).where(F.col("date") == F.lit(day(n)))
        assert same_rows(lists, activity.activity_backfill(h, day(n), snapshots_from=day(n)))
    assert table.base.written == [day(9), day(40)]
    assert table.base_before(day(39)) == day(9)


def test_a_day_writes_only_its_changed_keys_and_can_be_run_again(spark):
    h = events_of(spark, HITS)
    table = jobs.metric_changes(spark)
    for n in (0, 2, 5, 33):
        jobs.metric_change_days(table, h, day(n))
    assert {p: table.changes.read(as_of=p).count() for p in table.changes.written} == {
        day(0): 1, day(2): 2, day(5): 2, day(33): 1,
    }
    table.compact(day(5))
    before = rows_of(table.read(day(5)))
    folded = None
    for n in range(6):
        folded = metrics.array_metric_step(folded, h, day(n))
    assert before == rows_of(folded.select(*table.read(day(5)).columns))
    # day 2 again, with other events: the base that had taken it in goes, later reads see the new rows
    jobs.metric_change_days(table, events_of(spark, [(1, 2), (1, 2), (9, 2)]), day(2))
    assert table.base.written == []
    again = {r.user_id: r.metric_array for r in table.read(day(5)).collect()}
    assert again == {1: [2, 0, 2, 0, 0, 1], 9: [0, 0, 1, 0, 0, 0], 3: [0, 0, 0, 0, 0, 1]}
    # a range without events any more is cleared, whatever was there
    jobs.metric_change_days(table, events_of(spark, [(7, 1)]), day(0), day(4))
    assert table.changes.written == [day(1), day(5), day(33)]
    table.compact(day(5))
    table.forget(day(6))
    assert table.changes.written == [day(33)] and table.base.written == [day(5)]
    assert {r.user_id: r.metric_array for r in table.read(day(6)).collect()} == {
        7: [0, 1, 0, 0, 0, 0, 0], 3: [0, 0, 0, 0, 0, 1, 0], 1: [0, 0, 0, 0, 0, 1, 0],
    }
    # a new month starts anew; the table is found again by its path
    reopened = jobs.metric_changes(spark, table.path)
    assert {r.user_id: r.metric_array for r in reopened.read(day(33)).collect()} == {1: [0, 0, 1]}


def test_reading_a_change_table_joins_nothing(spark):
    table = jobs.activity_changes(spark)
    h = events_of(spark, HITS)
    jobs.activity_change_days(table, h, day(0), day(5))
    table.compact(day(3))
    p = plan_of(table.read(day(5)))
    assert "Join" not in p and "partial_bit_or" in p


# ------------------------------------------------------------ rolling bitmaps


@pytest.mark.parametrize("stride", [1, 4])
def test_rolling_bitmaps_equal_the_bitmaps_of_every_day(spark, stride):
    h = events_of(spark, [r for r in HITS if r[1] != 33])
    path = state_path(spark, "rolling")
    for n in [*range(0, 9, stride), 34, 40, 75]:  # gaps shorter and longer than the window
        table = jobs.bitmap_day(spark, h, path, day(n))
        listed = activity.activity_backfill(h, day(n), snapshots_from=day(n))
        plain = activity.activity_bitmap(listed, day(n)).select("user_id", "activity_bits", "date")
        assert same_rows(table.read(as_of=day(n)), plain)
    # a day run again starts from the day before it, not from itself
    jobs.bitmap_day(spark, h, path, day(40))
    assert table.read(as_of=day(40)).count() == 3


# ------------------------------------------------------------ SCD2 from histories, and several seasons at once


def snapshots(spark, sf_dir):
    return Q.entity_backfill(spark, sf_dir)


def test_scd2_from_one_snapshot_without_exchange(spark, sf_dir):
    snap, spec, hi = Q._of_last(spark, sf_dir)
    every = SnapshotTable.open(spark, Q._stored_players(spark, sf_dir), spec.as_of).read()
    pairs = [
        (scd.scd2_from_history(snap, spec, hi), scd.scd2_full(every, spec.key, spec.as_of, list(Q.SCD_ATTRS), as_of=hi)),
        (scd.streaks_from_history(snap, spec, hi), scd.streaks(every, spec.key, spec.as_of, list(Q.SCD_ATTRS))),
        (scd.changes_from_history(snap, spec, hi), scd.detect_changes(every, spec.key, spec.as_of, list(Q.SCD_ATTRS))),
    ]
    for mine, plain in pairs:
        p = plan_of(mine)
        assert "Exchange" not in p and "Window" not in p and "Sort" not in p and p.count("FileScan") == 1
        assert same_rows(mine, plain)


def test_scd2_from_history_with_gaps_and_null_measures(spark):
    rows = [(1, 2000, 40), (1, 2001, 40), (1, 2004, 5), (2, 2003, None), (2, 2004, 1), (3, 2005, 99)]
    seasons = spark.createDataFrame([(e, p, "n", "s", "t", 1, m and m * 1_000_000, 1, 1) for e, p, m in rows], TYPES)
    every = cumulative.cumulative_backfill(seasons, Q.ENTITY_SPEC, last=2006)
    one = every.where("current_season = 2006")
    full = scd.scd2_full(every, "entity_id", "current_season", list(Q.SCD_ATTRS), as_of=2006)
    assert same_rows(scd.scd2_from_history(one, Q.ENTITY_SPEC, 2006), full)


TYPES = "entity_id int, period int, name string, segment string, top_priority string, gp int, pts long, reb long, ast long"
SNAP = "entity_id int, scoring_class string, is_active boolean, current_season int"


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5])
@pytest.mark.parametrize("missing", [(), (2,), (3, 4)])
def test_scd2_catch_up_equals_the_rebuild(spark, k, missing):
    import random

    rng = random.Random(7 * k + len(missing))
    rows = [
        (e, rng.choice(["star", "bad", None]), rng.random() < 0.7, p)
        for e in range(12)
        for p in range(rng.randint(0, 5), 9)
        if p not in missing
    ]
    snaps = spark.createDataFrame(rows, SNAP)
    full = lambda upto, of=snaps: scd.scd2_full(of, "entity_id", "current_season", list(Q.SCD_ATTRS), as_of=upto)
    done = 8 - k
    out = scd.scd2_catch_up(full(done), snaps, "entity_id", list(Q.SCD_ATTRS), first=done + 1, as_of=8)
    assert same_rows(out, full(8))
    # a season in the past is corrected: its tail is taken anew
    fixed = snaps.where("not (current_season = 5 and entity_id < 6)").unionByName(
        spark.createDataFrame([(e, "good", True, 5) for e in range(6)], SNAP)
    )
    before = max(p for p in range(5) if p not in missing)
    out = scd.scd2_catch_up(full(8), fixed, "entity_id", list(Q.SCD_ATTRS), first=5, as_of=8, before=before)
    assert same_rows(out, full(8, fixed))


def test_scd2_catch_up_on_stored_tables(spark):
    seasons = spark.createDataFrame(
        [(e, p, "n", "s", "t", 1, (e * p % 5) * 10_000_000, 1, 1) for e in range(8) for p in range(2000, 2009) if (e + p) % 3],
        TYPES,
    )
    players, history = state_path(spark, "catch-players"), state_path(spark, "catch-scd")
    jobs.players_backfill(spark, seasons, players, Q.ENTITY_SPEC)
    jobs.scd_full(spark, players, history, Q.ENTITY_SPEC, as_of=2003)
    every = SnapshotTable.open(spark, players, "current_season").read()
    full = scd.scd2_full(every, "entity_id", "current_season", list(Q.SCD_ATTRS), as_of=2008)
    assert same_rows(jobs.scd_catch_up(spark, players, history, Q.ENTITY_SPEC, 2008).read(as_of=2008), full)
    fixed = seasons.where("period <> 2004")
    jobs.players_backfill(spark, fixed, players, Q.ENTITY_SPEC)
    out = jobs.scd_catch_up(spark, players, history, Q.ENTITY_SPEC, 2008, corrected=2004).read(as_of=2008)
    every = SnapshotTable.open(spark, players, "current_season").read()
    assert same_rows(out, scd.scd2_full(every, "entity_id", "current_season", list(Q.SCD_ATTRS), as_of=2008))


# ------------------------------------------------------------ versioned tables


def test_a_refused_load_keeps_the_old_table(spark):
    schema = "identifier string, type string, properties string"
    path = state_path(spark, "versioned")
    jobs.store_table(spark.createDataFrame([("1", "player", "{}")], schema), "vertices", path)
    for bad, error in (([("2", "game", "{}")] * 2, jobs.DuplicateKeyError), ([("2", "coach", "{}")], Exception)):
        with pytest.raises(error):
            jobs.store_table(spark.createDataFrame(bad, schema), "vertices", path)
        assert rows_of(jobs.read_table(spark, "vertices", path)) == [("1", "player", "{}")]
    reader = jobs.read_table(spark, "vertices", path)
    jobs.store_table(spark.createDataFrame([("3", "game", "{}")], schema), "vertices", path)
    assert rows_of(reader) == [("1", "player", "{}")]  # a reader keeps the version it started with
    table = VersionedTable(spark, path)
    assert rows_of(table.read()) == [("3", "game", "{}")]
    assert len([f for f in table.folder.folders() if f.startswith("version-")]) == 2  # refused ones are gone
    table.forget()
    assert len(table.folder.folders()) == 1 and rows_of(table.read()) == [("3", "game", "{}")]
    with pytest.raises(ValueError, match="not been loaded"):
        VersionedTable(spark, state_path(spark, "never")).read()


def test_a_shorter_backfill_leaves_no_old_season(spark):
    rows = [(e, p, "n", "s", "t", 1, 1, 1, 1) for e in (1, 2) for p in (2000, 2001, 2002)]
    path = state_path(spark, "shorter")
    jobs.players_backfill(spark, spark.createDataFrame(rows, TYPES), path, Q.ENTITY_SPEC)
    late = spark.createDataFrame([r for r in rows if r[1] > 2000], TYPES)
    assert jobs.players_backfill(spark, late, path, Q.ENTITY_SPEC).written == [2001, 2002]
    assert SnapshotTable.open(spark, path, "current_season").periods() == [2001, 2002]


# ------------------------------------------------------------ columns of stored snapshots


def test_columns_change_over_several_periods(spark):
    path = state_path(spark, "columns")
    table = SnapshotTable(spark, path, "p", sort_cols=["k"])
    table.write(spark.createDataFrame([(1, "a", 2000), (2, "b", 2000)], "k int, label string, p int"))
    files = table.files_of(2000)
    table.rename_column("label", "grade")
    assert table.read().columns == ["k", "grade", "p"]
    table = SnapshotTable.open(spark, path, "p", sort_cols=["k"])  # another session's driver
    table.write_period(spark.createDataFrame([(1, "c", 2001)], "k int, grade string, p int"), 2001)
    table.add_column("label", IntegerType())  # the name that the files use for another column
    table.write_period(spark.createDataFrame([(1, "d", 7, 2002)], "k int, grade string, label int, p int"), 2002)
    table.rename_column("k", "key")
    want = [(1, "a", None, 2000), (1, "c", None, 2001), (1, "d", 7, 2002), (2, "b", None, 2000)]
    for t in (table, SnapshotTable.open(spark, path, "p", sort_cols=["key"])):
        assert sorted(t.read().collect(), key=lambda r: (r.key, r.p)) == sorted(want, key=lambda r: (r[0], r[3]))
        assert rows_of(t.read(as_of=2002)) == [(1, "d", 7, 2002)]
        assert t.written == [2000, 2001, 2002] and t.files_of(2000) == files  # no file was rewritten
    filtered = table.read(as_of=2000).where("grade = 'b'")
    assert "EqualTo(label,b)" in plan_of(filtered)  # the filter reaches the scan under the file's name
    rows = spark.createDataFrame([(5, "e", 1, 2003)], "key int, grade string, label int, p int")
    table.replace(rows)
    assert rows_of(SnapshotTable.open(spark, path, "p").read()) == [(5, "e", 1, 2003)]
    assert SnapshotTable.open(spark, path, "p").stored_names == {}


def test_rows_of_other_columns_are_refused(spark):
    path = state_path(spark, "columns")
    table = SnapshotTable(spark, path, "p")
    table.write(spark.createDataFrame([(1, 2000)], "k int, p int"))
    for schema, row in (("k int, extra int, p int", (1, 1, 2001)), ("p int", (2001,)), ("k string, p int", ("x", 2001))):
        for write in (table.write, table.replace, lambda df: table.write_period(df, 2001)):
            with pytest.raises(ColumnMismatchError):
                write(spark.createDataFrame([row], schema))
    for change in (
        lambda: table.rename_column("k", "p"),
        lambda: table.rename_column("p", "q"),
        lambda: table.rename_column("absent", "q"),
        lambda: table.add_column("k", IntegerType()),
        lambda: table.widen_column("k", StringType()),
    ):
        with pytest.raises(ColumnMismatchError):
            change()
    assert rows_of(SnapshotTable.open(spark, path, "p").read()) == [(1, 2000)]
    with pytest.raises(ValueError, match="not been written"):
        SnapshotTable(spark, state_path(spark, "never"), "p").rename_column("k", "q")


def test_a_history_gets_a_new_stat(spark):
    seasons = spark.createDataFrame([(e, p, "n", "s", "t", 1, 1, 1, 1) for e in (1, 2) for p in (2000, 2001)], TYPES)
    path = state_path(spark, "new-stat")
    jobs.season_step(spark, seasons, path, 2000, Q.ENTITY_SPEC)
    table = SnapshotTable.open(spark, path, "current_season", sort_cols=["entity_id"])
    entry = table.schema["season_stats"].dataType.elementType
    more = ArrayType(StructType([*entry.fields, StructField("steals", IntegerType())]))
    with pytest.raises(ColumnMismatchError, match="loses"):
        table.widen_column("season_stats", ArrayType(StructType(entry.fields[:-1])))
    table.widen_column("season_stats", more)
    spec = replace(Q.ENTITY_SPEC, stats=(*Q.ENTITY_SPEC.stats, "steals"))
    late = seasons.withColumn("steals", F.lit(9)).where("period = 2001 and entity_id = 1")
    jobs.season_step(spark, late, path, 2001, spec)
    rows = SnapshotTable.open(spark, path, "current_season").read().selectExpr(
        "current_season", "entity_id", "transform(season_stats, x -> coalesce(x.steals, -1)) steals",
        "transform(season_stats, x -> x.pts) pts",
    )
    assert rows_of(rows) == [
        (2000, 1, [-1], [1]), (2000, 2, [-1], [1]), (2001, 1, [-1, 9], [1, 1]), (2001, 2, [-1], [1]),
    ]


def test_columns_of_a_bucketed_table(spark):
    path = state_path(spark, "bucketed-columns")
    table = SnapshotTable(spark, path, "p", sort_cols=["k"], buckets=2)
    table.write_period(spark.createDataFrame([(1, "a", 2000)], "k int, label string, p int"), 2000)
    table.rename_column("label", "grade")
    table.add_column("n", IntegerType())
    table.write_period(spark.createDataFrame([(1, "b", 3, 2001)], "k int, grade string, n int, p int"), 2001)
    again = SnapshotTable.open(spark, path, "p", sort_cols=["k"], buckets=2)
    want = [(1, "a", None, 2000), (1, "b", 3, 2001)]
    assert [tuple(r) for r in again.read().orderBy("p").collect()] == want
    with pytest.raises(ColumnMismatchError, match="bucketed"):
        again.widen_column("grade", StringType())


# ------------------------------------------------------------ counts and bounds from footers


def test_footers_answer_counts_and_bounds(spark, sf_dir):
    path = state_path(spark, "footers")
    schema = "id long, d date, name string, kind string"
    rows = [(i, day(i % 7), str(i), "ab"[i % 2]) for i in range(20)] + [(None, None, None, "c")]
    spark.createDataFrame(rows, schema).repartition(3).write.partitionBy("kind").parquet(path)
    counts = footers.stored_counts(spark, path, ["kind"])
    assert rows_of(counts) == [("a", 10), ("b", 10), ("c", 1)]
    assert rows_of(footers.stored_bounds(spark, path, "d", "lo", "hi")) == [(day(0), day(6))]  # kind c has no bounds
    bounds = footers.footer_bounds(spark, f"{path}/kind=a", "d")
    assert rows_of(bounds) == [(day(0), day(6))]
    assert rows_of(footers.stored_counts(spark, path)) == [(21,)]
    assert "PushedAggregation: [COUNT(*)]" in formatted(counts) and "PushedGroupBy: [kind]" in formatted(counts)
    assert "PushedAggregation: [MIN(d), MAX(d)]" in formatted(bounds)
    with pytest.raises(TypeError, match="no exact bounds"):
        footers.stored_bounds(spark, path, "name")
    empty = state_path(spark, "footers-empty")
    spark.createDataFrame([], "d date").write.parquet(empty)
    assert rows_of(footers.stored_bounds(spark, empty, "d")) == [(None, None)]
    assert rows_of(footers.stored_counts(spark, empty)) == [(0,)]
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")  # the caller's session is as it was
    assert "PushedAggregation: [COUNT(*)]" in formatted(Q.q_graph_vertex_counts_stored(spark, sf_dir))
    assert rows_of(Q.q_period_bounds_stored(spark, sf_dir)) == rows_of(Q.q_period_bounds(spark, sf_dir))


def formatted(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


# ------------------------------------------------------------ typed property bags


def test_typed_bags_are_neither_rendered_nor_parsed(spark, sf_dir):
    games = Q.player_games(spark, sf_dir)
    for q in (Q.q_graph_max_points, Q.q_graph_pair_report):
        p = q(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "variant" in p and not any(f in p for f in ("to_json", "structstojson", "from_json", "jsontostructs", "get_json"))
    for typed, text in (
        (Q.player_vertices(games, typed=True), Q.player_vertices(games)),
        (Q.plays_in_edges(games, typed=True), Q.plays_in_edges(games)),
    ):
        fields = F.from_json("properties", "map<string,string>").alias("m")
        keys = [c for c in text.columns if c != "properties"]
        entries = [x.select(*keys, F.explode(fields)) for x in (graph.with_text(typed), graph.with_text(text))]
        assert same_rows(*entries) and not entries[0].isEmpty()


def test_typed_bags_keep_nulls(spark):
    df = spark.createDataFrame([("1", None, 2.5), ("2", 3, None)], "id string, a int, b double")
    bag = graph.build_vertices(df, "id", "team", {"a": "a", "b": "b"}, typed=True)
    assert [r.properties for r in graph.with_text(bag).orderBy("identifier").collect()] == [
        '{"a":null,"b":2.5}', '{"a":3,"b":null}',
    ]
    edges = graph.bipartite_edges(df, "id", "team", "id", "game", "plays_in", {"pts": "a"}, typed=True)
    assert rows_of(graph.vertex_edge_max(bag, edges, "pts", "b", out_label="b", out_value="m").where("m is not null")) == [
        ("2", None, 3)
    ]


# ------------------------------------------------------------ keys and dimensions


def test_rows_without_a_key_have_no_snapshot(spark):
    seasons = spark.createDataFrame([(e, p, "n", "s", "t", 1, 1, 1, 1) for e in (None, 1) for p in (2000, 2001)], TYPES)
    path = state_path(spark, "null-keys")
    for season in (2000, 2001):
        jobs.season_step(spark, seasons, path, season, Q.ENTITY_SPEC)
    stepped = SnapshotTable.open(spark, path, "current_season").read()
    back = cumulative.cumulative_backfill(seasons, Q.ENTITY_SPEC, last=2001, dims_mode="latest")
    assert same_rows(stepped, back) and stepped.where("entity_id is null").count() == 0


def test_a_repeated_supplier_repeats_no_line(spark, sf_dir, tmp_path):
    for name in ("supplier", "nation", "region", "orders", "customer", "lineitem"):
        table = src.read_table(spark, sf_dir, name)
        if name == "supplier":
            one = table.where("s_suppkey = 1")
            table = table.unionByName(one).unionByName(one.withColumn("s_name", F.lit("another name")))
        table.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    twice = str(tmp_path)
    assert rows_of(Q.q_grain_check_player(spark, twice)) == [(1, 3)]
    assert Q.q_grain_check_player(spark, sf_dir).isEmpty()
    fact = Q.fact_df(spark, twice)
    assert fact.count() == Q.fact_df(spark, sf_dir).count()
    assert fact.groupBy("dim_game_date", "dim_team_id", "dim_player_id").count().where("count > 1").count() == (
        Q.fact_df(spark, sf_dir).groupBy("dim_game_date", "dim_team_id", "dim_player_id").count().where("count > 1").count()
    )
    assert Q.q_graph_edges_plays_in(spark, twice).count() == Q.q_graph_edges_plays_in(spark, sf_dir).count()
    assert same_rows(Q.q_grain_counts(spark, twice), Q.q_grain_counts(spark, sf_dir))


def test_daily_totals_sum_by_place(spark, sf_dir):
    h = src.hits(spark, sf_dir)
    arrays = metrics.array_metric_backfill(h, dt.date(2024, 1, 1), dt.date(2024, 1, 30), Q.metric_exprs())
    p = plan_of(metrics.array_metric_daily(arrays))
    assert "posexplode" not in p and "Expand" in p  # rows are made from the sums, not before them
    odd = spark.createDataFrame([("m", dt.date(2024, 2, 1), [1, None, 3]), ("m", dt.date(2024, 2, 1), [4]), ("n", dt.date(2024, 2, 1), [])],
                                "metric_name string, month_start date, metric_array array<bigint>")
    assert rows_of(metrics.array_metric_daily(odd)) == [("m", dt.date(2024, 2, 1), 5), ("m", dt.date(2024, 2, 3), 3)]
