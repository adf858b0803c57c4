"""Change detection, streaks and slowly changing dimensions type 2."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import all_null_safe_equal, any_of, lit_of, tier
from .cumulative import CumulativeSpec


def _previous(c: str) -> str:
    return f"previous_{c}"


def _indicator(c: str) -> str:
    return f"{c}_change_indicator"


def _changed(cur: Column, prev: Column, has_prev: Column, null_safe: bool) -> Column:
    if null_safe:
        return has_prev & ~cur.eqNullSafe(prev)
    # the reference's ``a <> prev``: NULL on either side is "no change"
    return F.coalesce(cur != prev, F.lit(False))


def detect_changes(
    snap: DataFrame, key: str, period: str, attrs: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """Previous value of each attribute and a 0/1 change indicator per attribute.

    One window (partition by key, order by period); the first row of a key
    has NULL previous values and indicator 0. With ``null_safe`` a change to
    or from NULL counts as a change (``<=>``), otherwise ``<>`` semantics.
    """
    w = Window.partitionBy(key).orderBy(period)
    has_prev = F.lag(F.lit(1), 1).over(w).isNotNull()
    prev_cols = [F.lag(F.col(a), 1).over(w).alias(_previous(a)) for a in attrs]
    with_prev = snap.select(key, period, *attrs, *prev_cols, has_prev.alias("_has_prev"))
    return with_prev.select(
        key,
        period,
        *attrs,
        *[_previous(a) for a in attrs],
        *[
            F.when(_changed(F.col(a), F.col(_previous(a)), F.col("_has_prev"), null_safe), F.lit(1))
            .otherwise(F.lit(0))
            .alias(_indicator(a))
            for a in attrs
        ],
    )


def with_streaks(
    snap: DataFrame, key: str, period: str, attrs: Sequence[str], null_safe: bool = True, streak_col: str = "streak_identifier"
) -> DataFrame:
    """Any-attribute change indicator and its running sum (the streak id).

    ``lag`` and the running ``sum`` share one window spec, so Spark plans a
    single exchange and a single sort for both.
    """
    w = Window.partitionBy(key).orderBy(period)
    has_prev = F.lag(F.lit(1), 1).over(w).isNotNull()
    prevs = {a: F.lag(F.col(a), 1).over(w) for a in attrs}
    staged = snap.select(key, period, *attrs, has_prev.alias("_has_prev"), *[v.alias(_previous(a)) for a, v in prevs.items()])
    changed = any_of([_changed(F.col(a), F.col(_previous(a)), F.col("_has_prev"), null_safe) for a in attrs])
    ind = staged.select(key, period, *attrs, F.when(changed, F.lit(1)).otherwise(F.lit(0)).alias("change_indicator"))
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ind.withColumn(streak_col, F.sum("change_indicator").over(running))


def streaks(
    snap: DataFrame,
    key: str,
    period: str,
    attrs: Sequence[str],
    start_col: str = "start_season",
    end_col: str = "end_season",
    null_safe: bool = True,
    streak_col: str = "streak_identifier",
) -> DataFrame:
    """One row per run of unchanged attributes with its first and last period.

    The final group-by keys start with the window's partition key, so it
    reuses the window's hash partitioning: no further exchange.
    """
    s = with_streaks(snap, key, period, attrs, null_safe, streak_col)
    return s.groupBy(key, streak_col, *attrs).agg(
        F.min(period).alias(start_col), F.max(period).alias(end_col)
    )


def scd2_full(
    snap: DataFrame,
    key: str,
    period: str,
    attrs: Sequence[str],
    as_of: int | Column,
    start_col: str = "start_season",
    end_col: str = "end_season",
    as_of_col: str = "current_season",
    null_safe: bool = True,
) -> DataFrame:
    """Full SCD2 rebuild from snapshots up to ``as_of``, stamped with the as-of."""
    s = streaks(snap.where(F.col(period) <= lit_of(as_of)), key, period, attrs, start_col, end_col, null_safe)
    return s.select(key, *attrs, start_col, end_col, lit_of(as_of).cast("int").alias(as_of_col))


def scd2_incremental(
    scd_prev: DataFrame,
    snap_cur: DataFrame,
    key: str,
    attrs: Sequence[str],
    period: int | Column,
    snap_period_col: str = "current_season",
    start_col: str = "start_season",
    end_col: str = "end_season",
    as_of_col: str = "current_season",
) -> DataFrame:
    """SCD2 as of ``period`` from the SCD2 as of ``period - 1`` and snapshot ``period``.

    Closed rows pass through. Open rows (end = P-1) meet this period's rows in
    ONE full outer join; each joined row emits 1 or 2 interval rows through
    ``inline(array(struct...))``:

    * no open row (new entity)         -> (attrs, P, P)
    * no row this period (carried)     -> open row unchanged (it closes)
    * attributes equal (``<=>``)       -> open row with end extended to P
    * attributes differ                -> open row as is + (attrs, P, P)

    Every entity lands in exactly one branch, so no NULL rows or duplicates.
    """
    prev = scd_prev.select(key, *attrs, start_col, end_col)
    p = lit_of(period).cast("int")
    closed = prev.where(F.col(end_col) < p - 1)
    open_rows = prev.where(F.col(end_col) == p - 1).withColumn("_in_o", F.lit(True)).alias("o")
    cur = (
        snap_cur.where(F.col(snap_period_col) == p)
        .select(key, *attrs)
        .withColumn("_in_t", F.lit(True))
        .alias("t")
    )
    j = open_rows.join(cur, F.col(f"o.{key}") == F.col(f"t.{key}"), "full_outer")

    def interval(side: str, start: Column, end: Column) -> Column:
        return F.struct(*[F.col(f"{side}.{a}").alias(a) for a in attrs], start.alias(start_col), end.alias(end_col))

    same = all_null_safe_equal([F.col(f"o.{a}") for a in attrs], [F.col(f"t.{a}") for a in attrs])
    rows = (
        F.when(F.col("o._in_o").isNull(), F.array(interval("t", p, p)))
        .when(F.col("t._in_t").isNull(), F.array(interval("o", F.col(f"o.{start_col}"), F.col(f"o.{end_col}"))))
        .when(same, F.array(interval("o", F.col(f"o.{start_col}"), p)))
        .otherwise(
            F.array(
                interval("o", F.col(f"o.{start_col}"), F.col(f"o.{end_col}")),
                interval("t", p, p),
            )
        )
    )
    changed = j.select(F.coalesce(F.col(f"o.{key}"), F.col(f"t.{key}")).alias(key), F.inline(rows))
    return changed.unionByName(closed).select(key, *attrs, start_col, end_col, p.alias(as_of_col))


# ---------------------------------------------------------------- from one snapshot's history arrays


def _segments(spec: CumulativeSpec, as_of: Column) -> Column:
    """Per history entry its own period and, if any, the idle periods behind it: structs (class, active, start)."""
    history = F.col(spec.history)

    def of(x: Column, i: Column) -> Column:
        cls = tier(x[spec.measure], spec.tiers, spec.default_tier).alias(spec.cls)
        played = F.struct(cls, F.lit(True).alias(spec.active), x[spec.period].cast("int").alias("start"))
        idle = F.struct(cls, F.lit(False).alias(spec.active), (x[spec.period] + 1).cast("int").alias("start"))
        following = F.coalesce(F.get(history, i + 1)[spec.period], as_of + 1)
        return F.when(following > x[spec.period] + 1, F.array(played, idle)).otherwise(F.array(played))

    return F.flatten(F.transform(history, of))


def _closed(starts: Column, as_of: Column) -> Column:
    """Structs with ``start`` get the ``end`` before the next one's start, the last one the as-of."""
    return F.transform(
        starts,
        lambda x, i: x.withField("end", F.coalesce(F.get(starts, i + 1)["start"] - 1, as_of).cast("int")),
    )


def _one_snapshot(snap: DataFrame, spec: CumulativeSpec, as_of: int | Column) -> tuple[DataFrame, Column]:
    p = lit_of(as_of).cast("int")
    rows = snap.where(F.col(spec.as_of) == lit_of(as_of))
    return rows.select(spec.key, _segments(spec, p).alias("_segments")), p


def changes_from_history(snap: DataFrame, spec: CumulativeSpec, as_of: int | Column) -> DataFrame:
    """O05 over all periods up to ``as_of`` from the snapshot ``as_of`` alone, for its class and active flag.

    The history array holds all that the earlier snapshots were made of, so no
    other partition is read and nothing is shuffled: each entity's array gives
    its row per period, with the previous values and change indicators.
    """
    rows, p = _one_snapshot(snap, spec, as_of)
    attrs = (spec.cls, spec.active)
    each = F.transform(
        _closed(F.col("_segments"), p),
        lambda s, i: F.transform(
            F.sequence(s["start"], s["end"]),
            lambda period: F.struct(
                period.alias(spec.as_of),
                *[s[a].alias(a) for a in attrs],
                *[
                    F.when(period > s["start"], s[a]).otherwise(F.get(F.col("_segments"), i - 1)[a]).alias(_previous(a))
                    for a in attrs
                ],
                ((period > s["start"]) | (i > 0)).alias("_has_prev"),
            ),
        ),
    )
    listed = rows.select(spec.key, F.inline(F.flatten(each)))
    return listed.select(
        spec.key,
        spec.as_of,
        *attrs,
        *[_previous(a) for a in attrs],
        *[
            F.when(_changed(F.col(a), F.col(_previous(a)), F.col("_has_prev"), True), F.lit(1)).otherwise(F.lit(0)).alias(_indicator(a))
            for a in attrs
        ],
    )


def streaks_from_history(
    snap: DataFrame,
    spec: CumulativeSpec,
    as_of: int | Column,
    start_col: str = "start_season",
    end_col: str = "end_season",
    streak_col: str = "streak_identifier",
) -> DataFrame:
    """O06 from the snapshot ``as_of`` alone: one row per run of unchanged class and active flag.

    Row by row over the history arrays: no window, sort or exchange, and one
    partition read, where the plain form scans and shuffles every snapshot.
    """
    rows, p = _one_snapshot(snap, spec, as_of)
    s = F.col("_segments")
    same = lambda x, y: x[spec.cls].eqNullSafe(y[spec.cls]) & x[spec.active].eqNullSafe(y[spec.active])
    first = F.filter(s, lambda x, i: (i == 0) | ~same(x, F.get(s, i - 1)))
    runs = rows.select(spec.key, first.alias("_starts")).select(
        spec.key, F.posexplode(_closed(F.col("_starts"), p)).alias(streak_col, "r")
    )
    return runs.select(
        spec.key,
        F.col(streak_col).cast("bigint").alias(streak_col),
        f"r.{spec.cls}",
        f"r.{spec.active}",
        F.col("r.start").alias(start_col),
        F.col("r.end").alias(end_col),
    )


def scd2_from_history(
    snap: DataFrame,
    spec: CumulativeSpec,
    as_of: int | Column,
    start_col: str = "start_season",
    end_col: str = "end_season",
) -> DataFrame:
    """O07 from the snapshot ``as_of`` alone, stamped with the as-of: equal to ``scd2_full``, map-only."""
    runs = streaks_from_history(snap, spec, as_of, start_col, end_col)
    return runs.select(
        spec.key, spec.cls, spec.active, start_col, end_col, lit_of(as_of).cast("int").alias(spec.as_of)
    )


# ---------------------------------------------------------------- several periods at once


def scd2_catch_up(
    scd_prev: DataFrame,
    snaps: DataFrame,
    key: str,
    attrs: Sequence[str],
    first: int,
    as_of: int,
    before: int | None = None,
    snap_period_col: str = "current_season",
    start_col: str = "start_season",
    end_col: str = "end_season",
    as_of_col: str = "current_season",
) -> DataFrame:
    """SCD2 as of ``as_of`` from an older SCD2 and the snapshots of the periods ``first`` .. ``as_of``.

    Takes in any number of periods at once, over gaps too, and corrections: what
    ``scd_prev`` says about ``first`` and later is dropped, intervals that reach
    into it are cut back to ``before``, the last stored period before ``first``
    (default ``first - 1``), and are open again. Old intervals and the new
    periods' rows, as intervals of one period, meet in one group-by on the key;
    each entity's sorted list (bounded by its periods) is merged in one pass:
    an interval with the attributes (``<=>``) of the one before it extends it.
    Equal to the full rebuild over the same snapshots, which it never reads.
    """
    last = first - 1 if before is None else before
    interval = [*attrs, start_col, end_col]
    old = scd_prev.where(F.col(start_col) < F.lit(first)).select(
        key, *attrs, start_col, F.least(F.col(end_col), F.lit(last)).cast("int").alias(end_col)
    )
    period = F.col(snap_period_col)
    new = snaps.where((period >= F.lit(first)) & (period <= F.lit(as_of))).select(
        key, *attrs, period.cast("int").alias(start_col), period.cast("int").alias(end_col)
    )
    listed = old.unionByName(new).groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(F.col(start_col).alias("_at"), F.struct(*interval).alias("x")))).alias("_all")
    )
    x = F.transform("_all", lambda e: e["x"])
    rows = listed.select(key, x.alias("_x"))
    starts = F.filter(
        F.transform("_x", lambda a, i: F.struct(a.alias("a"), i.alias("i"))),
        lambda e: (e["i"] == 0)
        | ~all_null_safe_equal([e["a"][c] for c in attrs], [F.get(F.col("_x"), e["i"] - 1)[c] for c in attrs]),
    )
    rows = rows.withColumn("_starts", starts)
    # a run ends where the interval before the next run's first one ends
    merged = F.transform(
        "_starts",
        lambda e, k: F.struct(
            *[e["a"][c].alias(c) for c in attrs],
            e["a"][start_col].alias(start_col),
            F.get(F.col("_x"), F.coalesce(F.get(F.col("_starts"), k + 1)["i"], F.size("_x")) - 1)[end_col].alias(end_col),
        ),
    )
    return rows.select(key, F.inline(merged)).select(
        key, *attrs, start_col, end_col, F.lit(as_of).cast("int").alias(as_of_col)
    )
