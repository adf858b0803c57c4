"""Table-level jobs run period by period on stored tables, as a user would."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strata.operators import activity, quality, scd
from strata.plans import jobs
from strata.plans import queries as Q
from strata.session import state_path
from strata.sources import testdata as src

from .conftest import same_rows


def test_season_steps_then_scd_increments(spark, sf_dir):
    seasons = src.entity_periods(spark, sf_dir)
    lo, hi = quality.bounds_of(seasons, "period")
    players, scd_path = state_path(spark, "jobs-players"), state_path(spark, "jobs-scd")
    for season in range(lo, hi + 1):  # run by hand, one season at a time
        jobs.season_step(spark, seasons, players, season, Q.ENTITY_SPEC)
    jobs.scd_full(spark, players, scd_path, Q.ENTITY_SPEC, as_of=hi - 1)
    inc = jobs.scd_increment(spark, players, scd_path, Q.ENTITY_SPEC, season=hi)
    full = scd.scd2_full(Q.entity_backfill(spark, sf_dir), "entity_id", "current_season", list(Q.SCD_ATTRS), as_of=hi)
    assert same_rows(inc.read(as_of=hi), full)
    # rerunning a season replaces its partition
    jobs.scd_increment(spark, players, scd_path, Q.ENTITY_SPEC, season=hi)
    assert inc.read(as_of=hi).count() == full.count()


def test_daily_jobs_with_a_skipped_day(spark, sf_dir):
    h = src.hits(spark, sf_dir)
    days = [dt.date(2024, 1, d) for d in (1, 2, 3, 5)]  # the 4th is skipped
    dl, ma = state_path(spark, "jobs-datelist"), state_path(spark, "jobs-metrics")
    for d in days:
        jobs.activity_day(spark, h, dl, d)
        jobs.metric_day(spark, h, ma, d)
    from strata.sources.snapshots import SnapshotTable

    lists = SnapshotTable.open(spark, dl, "date").read(as_of=days[-1])
    back = activity.activity_backfill(h.where(F.to_date("event_time") != F.lit(dt.date(2024, 1, 4))), days[-1])
    assert same_rows(lists, back.where(F.col("date") == F.lit(days[-1])))
    arrays = SnapshotTable.open(spark, ma, "as_of").read(as_of=days[-1])
    assert arrays.where(F.size("metric_array") != 5).isEmpty()
    assert arrays.where(F.col("metric_array")[3] != 0).isEmpty()  # the skipped day holds 0


def test_bucketed_state_avoids_shuffling_the_state(spark, sf_dir):
    """Bucketed by key, the previous snapshot is read hash-partitioned: the step's
    full outer join shuffles only the new season's rows, and results are unchanged."""
    from strata.operators import cumulative
    from strata.sources.snapshots import SnapshotTable

    seasons = src.entity_periods(spark, sf_dir)
    lo, hi = quality.bounds_of(seasons, "period")
    plain, bucketed = state_path(spark, "jobs-plain"), state_path(spark, "jobs-bucketed")
    for season in range(lo, lo + 3):
        jobs.season_step(spark, seasons, plain, season, Q.ENTITY_SPEC)
        jobs.season_step(spark, seasons, bucketed, season, Q.ENTITY_SPEC, buckets=8)
    a = SnapshotTable.open(spark, plain, "current_season").read()
    b = SnapshotTable.open(spark, bucketed, "current_season", ["entity_id"], buckets=8).read()
    assert same_rows(a, b)

    def exchanges(table):
        step = cumulative.cumulative_step(table.read(as_of=lo + 2), seasons, Q.ENTITY_SPEC, lo + 3)
        plan = step._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning"), "Bucketed: true" in plan

    n_plain, _ = exchanges(SnapshotTable.open(spark, plain, "current_season"))
    n_bucketed, bucket_scan = exchanges(SnapshotTable.open(spark, bucketed, "current_season", ["entity_id"], buckets=8))
    assert bucket_scan and n_bucketed == n_plain - 1  # the state side is no longer shuffled


def test_bucketed_table_is_registered_again_in_a_new_catalog(spark, sf_dir):
    from strata.sources.snapshots import SnapshotTable

    h = src.hits(spark, sf_dir)
    path = state_path(spark, "jobs-bucketed-dl")
    for d in (dt.date(2024, 1, 1), dt.date(2024, 1, 2)):
        jobs.activity_day(spark, h, path, d, buckets=8)
    table = SnapshotTable.open(spark, path, "date", ["user_id"], buckets=8)
    before = sorted(tuple(r) for r in table.read().collect())
    spark.sql(f"DROP TABLE {table.table_name}")  # external table: the files stay
    again = SnapshotTable.open(spark, path, "date", ["user_id"], buckets=8)
    assert again.written == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    assert sorted(tuple(r) for r in again.read().collect()) == before
    jobs.activity_day(spark, h, path, dt.date(2024, 1, 3), buckets=8)  # continues after re-registration
    assert SnapshotTable.open(spark, path, "date", ["user_id"], buckets=8).written[-1] == dt.date(2024, 1, 3)


def test_replace_truncates_other_periods(spark):
    from strata.sources.snapshots import SnapshotTable

    for buckets in (None, 4):
        t = SnapshotTable.scratch(spark, "replace", "p", sort_cols=["k"], buckets=buckets)
        t.write(spark.createDataFrame([(1, 1), (2, 1), (1, 2)], "k int, p int"))
        t.write(spark.createDataFrame([(3, 2)], "k int, p int"))  # dynamic: replaces period 2 only
        assert sorted(tuple(r) for r in t.read().collect()) == [(1, 1), (2, 1), (3, 2)]
        t.replace(spark.createDataFrame([(9, 3)], "k int, p int"))  # static: the table now holds period 3 only
        assert sorted(tuple(r) for r in t.read().collect()) == [(9, 3)]
        assert t.written == [3]


def test_sql_over_a_stored_snapshot_table(spark, sf_dir):
    from strata.sources.snapshots import SnapshotTable

    seasons = src.entity_periods(spark, sf_dir)
    path = state_path(spark, "jobs-sql-players")
    jobs.players_backfill(spark, seasons, path, Q.ENTITY_SPEC)
    players = SnapshotTable.open(spark, path, "current_season").read()
    players.createOrReplaceTempView("players")
    q = spark.sql("SELECT entity_id, scoring_class, is_active FROM players WHERE current_season = 2001")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(current_season" in plan and "= 2001)" in plan
    expected = Q.q_snapshot_lookup(spark, sf_dir)
    assert same_rows(q, expected)


SEASONS = "entity_id int, period int, name string, segment string, top_priority string, gp int, pts long, reb long, ast long"


def _seasons(spark, *rows):
    return spark.createDataFrame([(e, p, "n", "s", "t", 1, 1, 1, 1) for e, p in rows], SEASONS)


def test_a_missing_previous_season_is_an_error(spark):
    from strata.plans.fold import MissingPeriodError

    seasons = _seasons(spark, (1, 2000), (2, 2000), (1, 2002))
    path, scd_path = state_path(spark, "gap-players"), state_path(spark, "gap-scd")
    jobs.season_step(spark, seasons, path, 2000, Q.ENTITY_SPEC)
    with pytest.raises(MissingPeriodError, match="2001"):
        jobs.season_step(spark, seasons, path, 2002, Q.ENTITY_SPEC)
    jobs.scd_full(spark, path, scd_path, Q.ENTITY_SPEC, as_of=2000)
    jobs.season_step(spark, seasons, path, 2001, Q.ENTITY_SPEC)
    jobs.season_step(spark, seasons, path, 2002, Q.ENTITY_SPEC)
    with pytest.raises(MissingPeriodError, match="2001"):
        jobs.scd_increment(spark, path, scd_path, Q.ENTITY_SPEC, season=2002)
    jobs.scd_increment(spark, path, scd_path, Q.ENTITY_SPEC, season=2001)
    out = jobs.scd_increment(spark, path, scd_path, Q.ENTITY_SPEC, season=2002).read(as_of=2002)
    assert out.select("entity_id").distinct().count() == 2


@pytest.mark.parametrize("buckets", [None, 4])
def test_an_empty_rerun_clears_its_period(spark, buckets):
    from strata.sources.snapshots import SnapshotTable

    t = SnapshotTable.scratch(spark, "rerun", "p", sort_cols=["k"], buckets=buckets)
    for period in (1, 2):
        t.write_period(spark.createDataFrame([(1, period), (2, period)], "k int, p int"), period)
    t.write_period(spark.createDataFrame([], "k int, p int"), 2)
    assert t.written == t.periods() == [1]
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, 1), (2, 1)]
    t.write_period(spark.createDataFrame([(7, 2)], "k int, p int"), 2)
    assert sorted(tuple(r) for r in t.read(as_of=2).collect()) == [(7, 2)]


def test_null_periods_and_unreadable_tables(spark, tmp_path):
    from strata.sources.snapshots import SnapshotTable

    t = SnapshotTable.scratch(spark, "nulls", "p")
    t.write(spark.createDataFrame([(1, 1), (2, None)], "k int, p int"))
    assert SnapshotTable.open(spark, t.path, "p").written == [1, None]
    assert SnapshotTable.at(spark, str(tmp_path / "absent"), "p").written == []
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        SnapshotTable.at(spark, str(tmp_path / "broken"), "p")
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):  # a folder without files is not "nothing written yet"
        SnapshotTable.at(spark, str(tmp_path / "empty"), "p")


def test_declared_tables_enforce_domains_and_keys(spark):
    schema = "identifier string, type string, properties string, extra int"
    good = [("1", "player", "{}", 0), ("1", "game", "{}", 0)]
    stored = jobs.store_table(spark.createDataFrame(good, schema), "vertices", state_path(spark, "v"))
    assert stored.columns == ["identifier", "type", "properties"] and stored.count() == 2
    with pytest.raises(jobs.DuplicateKeyError, match="identifier"):
        jobs.store_table(spark.createDataFrame([*good, good[0]], schema), "vertices", state_path(spark, "v"))
    with pytest.raises(Exception, match="outside its domain: coach"):
        jobs.store_table(spark.createDataFrame([("1", "coach", "{}", 0)], schema), "vertices", state_path(spark, "v"))


def test_launcher_keeps_its_master(tmp_path):
    """Under spark-submit the session is the launcher's."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "job.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {root!r})\n"
        "from strata.session import get_session\n"
        "s = get_session()\n"
        "print('MASTER', s.sparkContext.master, s.conf.get('spark.driver.memory', 'unset'))\n"
    )
    submit = os.path.join(os.path.dirname(__import__("pyspark").__file__), "bin", "spark-submit")
    env = os.environ | {"PYSPARK_PYTHON": sys.executable, "PYSPARK_DRIVER_PYTHON": sys.executable}
    env.pop("PYSPARK_GATEWAY_PORT", None)
    command = [submit, "--master", "local[2]", "--conf", "spark.ui.enabled=false", "--driver-memory", "1g", str(script)]
    out = subprocess.run(command, env=env, capture_output=True, text=True, timeout=120)
    assert "MASTER local[2] 1g" in out.stdout, out.stderr[-1500:]
