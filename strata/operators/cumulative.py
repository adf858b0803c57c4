"""Cumulative snapshot tables with array-of-struct history.

A snapshot row is one entity as of one period: static dimensions, the
ordered history of per-period stats (oldest first), a class computed from
the latest stats, periods since the entity was last seen, an active flag and
the as-of period.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import REFERENCE_DEFAULT_TIER, REFERENCE_TIERS, lit_of, safe_ratio, tier
from .quality import bounds_of


@dataclass(frozen=True)
class CumulativeSpec:
    """Column roles of a source table at (key, period) grain and of its snapshots."""

    key: str
    period: str
    dims: Sequence[str]
    stats: Sequence[str]
    measure: str
    tiers: Sequence[tuple[str, float]] = REFERENCE_TIERS
    default_tier: str = REFERENCE_DEFAULT_TIER
    history: str = "season_stats"
    cls: str = "scoring_class"
    idle: str = "years_since_last_season"
    active: str = "is_active"
    as_of: str = "current_season"

    @property
    def struct_fields(self) -> list[str]:
        return [self.period, *self.stats]

    @property
    def snapshot_columns(self) -> list[str]:
        return [self.key, *self.dims, self.history, self.cls, self.idle, self.active, self.as_of]


def _field(name: str):
    return lambda x: x[name]


def _stats_struct(spec: CumulativeSpec, prefix: str) -> Column:
    return F.struct(*[F.col(f"{prefix}.{c}").alias(c) for c in spec.struct_fields])


def empty_snapshot(cur: DataFrame, spec: CumulativeSpec) -> DataFrame:
    """A typed, empty snapshot table (the state before the first period)."""
    return cur.where(F.lit(False)).select(
        spec.key,
        *spec.dims,
        F.array(F.struct(*[F.col(c) for c in spec.struct_fields])).alias(spec.history),
        F.lit(None).cast("string").alias(spec.cls),
        F.lit(0).alias(spec.idle),
        F.lit(True).alias(spec.active),
        F.lit(0).alias(spec.as_of),
    )


def cumulative_step(prev: DataFrame | None, cur: DataFrame, spec: CumulativeSpec, period: int) -> DataFrame:
    """Snapshot at ``period`` from the snapshot at ``period - 1`` and this period's rows.

    Full outer join on the key: dimensions take the newest non-NULL value,
    the history gets this period's struct appended (or is carried forward),
    the class is recomputed from this period's measure (or carried), idle
    periods count up when the entity is absent, and the as-of is the literal
    ``period`` so the output lands in one prunable partition. Both inputs are
    filtered before the join (filters cannot pass a full outer join). Rows
    without a key are no entity: they have no snapshot.
    """
    if prev is None:
        prev = empty_snapshot(cur, spec)
    y = prev.where(F.col(spec.as_of) == F.lit(period - 1)).alias("y")
    t = cur.where((F.col(spec.period) == F.lit(period)) & F.col(spec.key).isNotNull()).alias("t")
    present = F.col(f"t.{spec.period}").isNotNull()
    new_entry = F.array(_stats_struct(spec, "t"))
    history = (
        F.when(F.col(f"y.{spec.history}").isNull(), new_entry)
        .when(present, F.concat(F.col(f"y.{spec.history}"), new_entry))
        .otherwise(F.col(f"y.{spec.history}"))
    )
    cls = F.when(present, tier(F.col(f"t.{spec.measure}"), spec.tiers, spec.default_tier)).otherwise(
        F.col(f"y.{spec.cls}")
    )
    idle = F.when(present, F.lit(0)).otherwise(F.col(f"y.{spec.idle}") + 1)
    joined = y.join(t, F.col(f"y.{spec.key}") == F.col(f"t.{spec.key}"), "full_outer")
    return joined.select(
        F.coalesce(F.col(f"t.{spec.key}"), F.col(f"y.{spec.key}")).alias(spec.key),
        *[F.coalesce(F.col(f"t.{d}"), F.col(f"y.{d}")).alias(d) for d in spec.dims],
        history.alias(spec.history),
        cls.alias(spec.cls),
        idle.alias(spec.idle),
        (idle == 0).alias(spec.active),
        F.lit(period).alias(spec.as_of),
    )


def cumulative_backfill(
    src: DataFrame,
    spec: CumulativeSpec,
    first: int | Column | None = None,
    last: int | Column | None = None,
    dims_mode: str = "max",
) -> DataFrame:
    """Every snapshot from each entity's first period up to ``last`` in one pass.

    Plan: one group-by on the key collects the entity's (bounded, one per
    period) history, ``explode(sequence(first, last))`` fans it out to one row
    per as-of period, and ``filter`` keeps the history up to that period.
    One exchange, no theta join, no window. ``first``/``last`` restrict the
    as-of range (e.g. ``first=last=P`` builds only snapshot P); either may
    be a Column. ``last`` defaults to the source's last period (one tiny
    aggregate row read on the driver). Rows without a key are no entity.

    ``dims_mode='max'`` takes each dimension's maximum over all periods (the
    reference's backfill); ``'latest'`` takes the newest non-NULL value up to
    the as-of (what the step-by-step fold produces).
    """
    if last is None:
        _, last = bounds_of(src, spec.period)
    last = lit_of(last)
    if dims_mode not in ("max", "latest"):
        raise ValueError("dims_mode must be 'max' or 'latest'")
    fields = spec.struct_fields + (list(spec.dims) if dims_mode == "latest" else [])
    aggs = [
        F.min(spec.period).alias("_first"),
        F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in fields]))).alias("_all"),
    ]
    if dims_mode == "max":
        aggs += [F.max(d).alias(d) for d in spec.dims]
    grouped = src.where(F.col(spec.key).isNotNull()).groupBy(spec.key).agg(*aggs)
    lo = F.col("_first") if first is None else F.greatest(F.col("_first"), lit_of(first))
    # entities that start after the last as-of have no snapshot (and
    # ``sequence`` would count down for them)
    exploded = grouped.where(lo <= last).select(
        spec.key,
        *(spec.dims if dims_mode == "max" else []),
        "_all",
        F.explode(F.sequence(lo, last)).alias(spec.as_of),
    )
    upto = F.filter(F.col("_all"), lambda x: x[spec.period] <= F.col(spec.as_of))
    with_hist = exploded.select(
        spec.key,
        *(spec.dims if dims_mode == "max" else []),
        spec.as_of,
        upto.alias("_hist"),
    )
    latest = F.try_element_at(F.col("_hist"), F.lit(-1))
    if dims_mode == "latest":
        dim_cols = [
            F.try_element_at(
                F.filter(F.transform(F.col("_hist"), _field(d)), lambda v: v.isNotNull()), F.lit(-1)
            ).alias(d)
            for d in spec.dims
        ]
    else:
        dim_cols = [F.col(d) for d in spec.dims]
    history = F.transform(F.col("_hist"), lambda x: F.struct(*[x[c].alias(c) for c in spec.struct_fields]))
    return with_hist.select(
        spec.key,
        *dim_cols,
        history.alias(spec.history),
        tier(latest[spec.measure], spec.tiers, spec.default_tier).alias(spec.cls),
        (F.col(spec.as_of) - latest[spec.period]).cast("int").alias(spec.idle),
        (latest[spec.period] == F.col(spec.as_of)).alias(spec.active),
        F.col(spec.as_of).cast("int").alias(spec.as_of),
    )


def history_explode(snap: DataFrame, spec: CumulativeSpec, as_of=None, key_value=None) -> DataFrame:
    """One row per history element with the struct expanded to columns.

    Map-only (``inline``); the optional filters on as-of and key run before
    the unnest and prune partitions of a written snapshot table.
    """
    df = snap
    if as_of is not None:
        df = df.where(F.col(spec.as_of) == lit_of(as_of))
    if key_value is not None:
        df = df.where(F.col(spec.key) == F.lit(key_value))
    return df.select(spec.key, F.inline(spec.history))


def first_vs_latest(
    snap: DataFrame,
    spec: CumulativeSpec,
    as_of,
    cls: str | None = None,
    first_col: str = "first_season",
    latest_col: str = "latest_season",
    ratio_col: str = "improvement",
) -> DataFrame:
    """First and latest value of the measure and their zero-guarded ratio.

    Per-row array access only; the single sort at the end is the only shuffle.
    """
    df = snap.where(F.col(spec.as_of) == lit_of(as_of))
    if cls is not None:
        df = df.where(F.col(spec.cls) == F.lit(cls))
    h = F.col(spec.history)
    first = F.get(h, 0)[spec.measure]
    latest = F.try_element_at(h, F.lit(-1))[spec.measure]
    return df.select(
        spec.key,
        first.alias(first_col),
        latest.alias(latest_col),
        safe_ratio(latest, first).alias(ratio_col),
    ).orderBy(F.col(ratio_col).desc_nulls_first())


def snapshot_lookup(
    snap: DataFrame,
    as_of_col: str,
    as_of,
    predicates: Sequence[Column] = (),
    cols: Sequence[str] | None = None,
) -> DataFrame:
    """Filtered read of one snapshot (partition pruning on the as-of column)."""
    df = snap.where(F.col(as_of_col) == lit_of(as_of))
    for p in predicates:
        df = df.where(p)
    return df.select(*cols) if cols else df
