"""Table-level jobs: one period of one modelling job, on stored tables.

These are the statements a user runs period by period (a season, a day),
each reading the previous partition of its state table and writing one
partition. Every job is idempotent -- rerunning a period replaces its
partition -- and touches only the partitions it needs (pruned reads).
Paths should live on shared storage (e.g. under ``spark.checkpoint.dir``
or a warehouse folder).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import activity, cumulative, metrics, quality, scd
from ..operators.cumulative import CumulativeSpec
from ..sources.changes import ChangeTable
from ..sources.snapshots import SnapshotTable
from ..sources.versions import VersionedTable
from .fold import MissingPeriodError, fold


def season_step(
    spark: SparkSession,
    seasons: DataFrame,
    players_path: str,
    season: int,
    spec: CumulativeSpec,
    buckets: int | None = None,
) -> SnapshotTable:
    """O01 for one season: snapshot ``season`` from snapshot ``season - 1`` (empty before the first).

    With ``buckets`` the snapshot table is bucketed by the key, so each
    season's full outer join shuffles only that season's rows.
    """
    table = SnapshotTable.at(spark, players_path, spec.as_of, sort_cols=[spec.key], buckets=buckets)
    return fold(table, [season], lambda prev, p: cumulative.cumulative_step(prev, seasons, spec, p), lambda p: p - 1)


def players_backfill(
    spark: SparkSession, seasons: DataFrame, players_path: str, spec: CumulativeSpec, last: int | None = None
) -> SnapshotTable:
    """Every snapshot up to ``last`` in one job, written as one partition per season.

    The table afterwards holds this backfill and nothing else: a season that
    the source has lost leaves no old snapshots behind.
    """
    table = SnapshotTable.at(spark, players_path, spec.as_of, sort_cols=[spec.key])
    table.replace(cumulative.cumulative_backfill(seasons, spec, last=last))
    return table


def scd_full(
    spark: SparkSession,
    players_path: str,
    scd_path: str,
    spec: CumulativeSpec,
    as_of: int,
    attrs: Sequence[str] = ("scoring_class", "is_active"),
) -> SnapshotTable:
    """Rebuild the SCD2 table as of ``as_of`` from the stored snapshots (partition ``as_of``)."""
    players = SnapshotTable.open(spark, players_path, spec.as_of)
    snaps = players.read().where(F.col(spec.as_of) <= F.lit(as_of))
    out = scd.scd2_full(snaps, spec.key, spec.as_of, list(attrs), as_of=as_of, as_of_col=spec.as_of)
    table = SnapshotTable.at(spark, scd_path, spec.as_of, sort_cols=[spec.key])
    table.write_period(out, as_of)
    return table


def scd_increment(
    spark: SparkSession,
    players_path: str,
    scd_path: str,
    spec: CumulativeSpec,
    season: int,
    attrs: Sequence[str] = ("scoring_class", "is_active"),
) -> SnapshotTable:
    """SCD2 partition ``season`` from SCD2 partition ``season - 1`` and snapshot ``season``."""
    players = SnapshotTable.open(spark, players_path, spec.as_of)
    table = SnapshotTable.open(spark, scd_path, spec.as_of, sort_cols=[spec.key])
    for name, stored, period in (("players", players, season), ("SCD2", table, season - 1)):
        if not stored.has(period):
            raise MissingPeriodError(f"{name} table {stored.path}: {period} was never written")
    out = scd.scd2_incremental(
        table.read(as_of=season - 1),
        players.read(as_of=season),
        spec.key,
        list(attrs),
        period=season,
        snap_period_col=spec.as_of,
        as_of_col=spec.as_of,
    )
    table.write_period(out, season)
    return table


def scd_catch_up(
    spark: SparkSession,
    players_path: str,
    scd_path: str,
    spec: CumulativeSpec,
    season: int,
    corrected: int | None = None,
    attrs: Sequence[str] = ("scoring_class", "is_active"),
) -> SnapshotTable:
    """SCD2 partition ``season`` from the latest SCD2 partition before it and all snapshots since, at once.

    Seasons in between need no SCD2 partition of their own, and seasons without
    a snapshot are skipped over. ``corrected`` names the first season whose
    snapshot was written anew: everything from there on is taken from the
    snapshots again.
    """
    players = SnapshotTable.open(spark, players_path, spec.as_of)
    table = SnapshotTable.open(spark, scd_path, spec.as_of, sort_cols=[spec.key])
    done = max((p for p in table.written if p is not None and p < season), default=None)
    if done is None:
        raise MissingPeriodError(f"SCD2 table {scd_path}: nothing before {season} was written")
    if not players.has(season):
        raise MissingPeriodError(f"players table {players_path}: {season} was never written")
    first = done + 1 if corrected is None else min(corrected, done + 1)
    before = max((p for p in players.written if p is not None and p < first), default=first - 1)
    wanted = [p for p in players.written if p is not None and first <= p <= season]
    out = scd.scd2_catch_up(
        table.read(as_of=done),
        players.read(as_of_in=wanted),
        spec.key,
        list(attrs),
        first=first,
        as_of=season,
        before=before,
        snap_period_col=spec.as_of,
        as_of_col=spec.as_of,
    )
    table.write_period(out, season)
    return table


def bitmap_day(
    spark: SparkSession,
    events: DataFrame,
    state_path: str,
    day: dt.date,
    user_col: str = "user_id",
    ts_col: str = "event_time",
    buckets: int | None = None,
) -> SnapshotTable:
    """O18 as state as of ``day``: the rolling bitmaps from the latest earlier day's and the events since."""
    table = SnapshotTable.at(spark, state_path, "date", sort_cols=[user_col], buckets=buckets)
    earlier = max((d for d in table.written if d is not None and d < day), default=None)
    prev = None if earlier is None else table.read(as_of=earlier)
    table.write_period(activity.rolling_bitmap_step(prev, events, day, user_col, ts_col), day)
    return table


def activity_changes(spark: SparkSession, path: str | None = None, user_col: str = "user_id") -> ChangeTable:
    """O17's state as packed day sets: a base and the users of each day since (a scratch table without ``path``)."""

    def merge(base: DataFrame | None, changes: DataFrame, as_of: dt.date) -> DataFrame:
        return activity.merge_day_sets(base, changes, as_of, user_col)

    if path is None:
        return ChangeTable.scratch(spark, "activity-sets", "date", [user_col], merge)
    return ChangeTable(spark, path, "date", [user_col], merge)


def activity_change_days(
    table: ChangeTable,
    events: DataFrame,
    first: dt.date,
    last: dt.date | None = None,
    user_col: str = "user_id",
    ts_col: str = "event_time",
) -> None:
    """O17 for one day, or for each day of a range in one job: write the days' users, and nothing else."""
    last = last or first
    table.write_range(activity.day_users(events, first, last, user_col, ts_col), first, last)


def metric_changes(spark: SparkSession, path: str | None = None, user_col: str = "user_id") -> ChangeTable:
    """O19's state: month arrays as a base and the values of each day since (a scratch table without ``path``)."""

    def merge(base: DataFrame | None, changes: DataFrame, as_of: dt.date) -> DataFrame:
        return metrics.merge_month_arrays(base, changes, as_of, user_col)

    keys = [user_col, "metric_name"]
    if path is None:
        return ChangeTable.scratch(spark, "metric-arrays", "as_of", keys, merge)
    return ChangeTable(spark, path, "as_of", keys, merge)


def metric_change_days(
    table: ChangeTable,
    events: DataFrame,
    first: dt.date,
    last: dt.date | None = None,
    metric_exprs: dict[str, Column] | None = None,
    user_col: str = "user_id",
    ts_col: str = "event_time",
) -> None:
    """O19 for one day, or for each day of a range in one job: write the days' values, and nothing else."""
    last = last or first
    table.write_range(metrics.day_values(events, first, last, metric_exprs, user_col, ts_col), first, last)


def activity_day(
    spark: SparkSession,
    events: DataFrame,
    state_path: str,
    day: dt.date,
    user_col: str = "user_id",
    ts_col: str = "event_time",
    buckets: int | None = None,
) -> SnapshotTable:
    """O17 for one day (a skipped day carries the latest earlier state).

    With ``buckets`` the state is bucketed by user: the day's join shuffles
    only the day's distinct users, not the whole user table.
    """
    table = SnapshotTable.at(spark, state_path, "date", sort_cols=[user_col], buckets=buckets)
    return fold(
        table,
        [day],
        lambda prev, d: activity.activity_step(prev, events, d, user_col, ts_col),
        lambda d: d - dt.timedelta(days=1),
        carry_latest=True,
    )


def metric_day(
    spark: SparkSession,
    events: DataFrame,
    state_path: str,
    day: dt.date,
    metric_exprs: dict[str, Column] | None = None,
    user_col: str = "user_id",
    ts_col: str = "event_time",
    buckets: int | None = None,
) -> SnapshotTable:
    """O19 for one day: upsert today's values into the month arrays (bucketed by user with ``buckets``)."""
    table = SnapshotTable.at(spark, state_path, "as_of", sort_cols=[user_col], buckets=buckets)
    return fold(
        table,
        [day],
        lambda prev, d: metrics.array_metric_step(prev, events, d, metric_exprs, user_col, ts_col),
        lambda d: d - dt.timedelta(days=1),
        carry_latest=True,
    )


class DuplicateKeyError(ValueError):
    """A stored table holds a key more than once."""


def store_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Load ``df`` as the declared table ``name``: columns by name, enum domains and primary key enforced.

    The rows are written as a new version beside the old one; the key is
    checked on the written rows with one partial aggregate, and only then is
    the table switched to them. A refused load leaves the old rows in place.
    """
    rows = schemas.conform(df, schemas.TABLES[name])
    keys = schemas.PRIMARY_KEYS[name]

    def check(written: DataFrame) -> None:
        if repeated := quality.grain_check(written, keys).first():
            raise DuplicateKeyError(f"{name} at {path}: {repeated.asDict()}")

    checked = schemas.enforce_domains(rows, schemas.DOMAINS.get(name, {}))
    VersionedTable(df.sparkSession, path).load(checked, check)
    return read_table(df.sparkSession, name, path)


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The declared table stored at ``path``, its last accepted load."""
    return VersionedTable(spark, path).read(schemas.TABLES[name])
