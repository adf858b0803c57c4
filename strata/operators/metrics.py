"""Month arrays of daily metrics per user, and their daily totals.

State: one row per (user, month_start, metric_name) whose array holds one
value per day of the month so far (position 0 = first day of the month).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import date_lit

def default_metrics() -> dict[str, Column]:
    """The reference's single metric: hits per user and day."""
    return {"site_hits": F.count(F.lit(1))}


def month_start(day: dt.date) -> dt.date:
    return day.replace(day=1)


def daily_metrics(
    events: DataFrame,
    day_lo: dt.date,
    day_hi: dt.date,
    metrics: dict[str, Column] | None = None,
    user_col: str = "user_id",
    ts_col: str = "event_time",
) -> DataFrame:
    """(user, day, metric_name, value) for days in [day_lo, day_hi], non-NULL users.

    All metrics come from one partial+final aggregate; the day filter is a
    timestamp range pushed into the scan.
    """
    metrics = metrics or default_metrics()
    d = F.to_date(F.col(ts_col))
    per_day = (
        events.where(F.col(user_col).isNotNull() & (d >= date_lit(day_lo)) & (d <= date_lit(day_hi)))
        .groupBy(user_col, d.alias("day"))
        .agg(*[expr.alias(f"_m_{i}") for i, expr in enumerate(metrics.values())])
    )
    stacked = F.array(
        *[
            F.struct(F.lit(name).alias("metric_name"), F.col(f"_m_{i}").cast("bigint").alias("value"))
            for i, name in enumerate(metrics)
        ]
    )
    return per_day.select(user_col, "day", F.inline(stacked))


def array_metric_step(
    prev: DataFrame | None,
    events: DataFrame,
    day: dt.date,
    metrics: dict[str, Column] | None = None,
    user_col: str = "user_id",
    ts_col: str = "event_time",
) -> DataFrame:
    """Month arrays as of ``day`` from the arrays as of ``day - 1`` and the day's events.

    Upsert as a full outer join on (user, metric) of the month's prior arrays
    with today's values. With k = day offset in the month, the prior array
    is padded with zeros / cut to length k and today's value (0 if absent)
    appended, so every array has length k + 1: a first appearance mid-month
    gets k leading zeros, a skipped day leaves a zero, a rerun replaces
    rather than appends. A new month starts new arrays.

    ``metrics`` (name -> aggregate) are all computed in one scan of the
    day's events; a state table holds the metrics of one such job (rows of
    other metrics in ``prev`` are ignored, and the written partition
    replaces the whole as-of day).
    """
    metrics = metrics or default_metrics()
    m0 = month_start(day)
    k = (day - m0).days
    today = daily_metrics(events, day, day, metrics, user_col, ts_col).drop("day").alias("t")
    if prev is None:
        prior = today.where(F.lit(False)).select(
            user_col,
            "metric_name",
            F.array(F.col("value")).alias("metric_array"),
        ).alias("y")
    else:
        prior = (
            prev.where(
                (F.col("as_of") == date_lit(day - dt.timedelta(days=1)))
                & (F.col("month_start") == date_lit(m0))
                # only this job's metrics: other metrics sharing the table are not touched
                & F.col("metric_name").isin(list(metrics))
            )
            .select(user_col, "metric_name", "metric_array")
            .alias("y")
        )
    cond = (F.col(f"y.{user_col}") == F.col(f"t.{user_col}")) & (F.col("y.metric_name") == F.col("t.metric_name"))
    j = prior.join(today, cond, "full_outer")
    padded = F.slice(
        F.concat(
            F.coalesce(F.col("y.metric_array"), F.array().cast("array<bigint>")),
            F.array_repeat(F.lit(0).cast("bigint"), k),
        ),
        1,
        k,
    )
    arr = F.concat(padded, F.array(F.coalesce(F.col("t.value"), F.lit(0).cast("bigint"))))
    return j.select(
        F.coalesce(F.col(f"t.{user_col}"), F.col(f"y.{user_col}")).alias(user_col),
        date_lit(m0).alias("month_start"),
        F.coalesce(F.col("t.metric_name"), F.col("y.metric_name")).alias("metric_name"),
        arr.alias("metric_array"),
        date_lit(day).alias("as_of"),
    )


def array_metric_backfill(
    events: DataFrame,
    day_lo: dt.date,
    day_hi: dt.date,
    metrics: dict[str, Column] | None = None,
    user_col: str = "user_id",
    ts_col: str = "event_time",
) -> DataFrame:
    """Month arrays as of each month's last day up to ``day_hi``, in one pass over all months.

    Same content as folding O19 from ``day_lo`` on and reading each month's last
    snapshot: users are those with an event in the month; an array has one
    entry per day of the month so far, 0 where the user had no event.
    ``day_lo`` is a month's first day, or the first day with any event.
    """
    daily = daily_metrics(events, day_lo, day_hi, metrics, user_col, ts_col)
    month = F.trunc("day", "month")
    per_user = daily.groupBy(user_col, month.alias("month_start"), "metric_name").agg(
        F.map_from_entries(
            F.collect_list(F.struct(F.datediff("day", F.trunc("day", "month")), F.col("value")))
        ).alias("_m")
    )
    as_of = F.least(F.last_day("month_start"), date_lit(day_hi))
    arr = F.transform(
        F.sequence(F.lit(0), F.datediff(as_of, F.col("month_start"))),
        lambda i: F.coalesce(F.try_element_at(F.col("_m"), i), F.lit(0).cast("bigint")),
    )
    return per_user.select(user_col, "month_start", "metric_name", arr.alias("metric_array"), as_of.alias("as_of"))


def day_values(
    events: DataFrame,
    first: dt.date,
    last: dt.date,
    metrics: dict[str, Column] | None = None,
    user_col: str = "user_id",
    ts_col: str = "event_time",
) -> DataFrame:
    """O19's change rows of the days ``first`` .. ``last``: (user, metric_name, value, as_of) of each day's users."""
    return daily_metrics(events, first, last, metrics, user_col, ts_col).withColumnRenamed("day", "as_of")


def merge_month_arrays(base: DataFrame | None, changes: DataFrame, as_of: dt.date, user_col: str = "user_id") -> DataFrame:
    """O19's state as of a day from a base of month arrays and the change rows after it.

    Only the as-of month counts: a base of an earlier month adds nothing, and
    of the changes only that month's partitions are read. A key's array is its
    base array, padded with zeros to the as-of day, with the changed days' values
    in their places: one group-by on (user, metric), no join.
    """
    m0 = month_start(as_of)
    day = F.col("as_of")
    rows = changes.where((day >= date_lit(m0)) & (day <= date_lit(as_of))).select(
        user_col,
        "metric_name",
        F.datediff(day, date_lit(m0)).alias("_at"),
        "value",
        F.lit(None).cast("array<bigint>").alias("_old"),
    )
    if base is not None:
        old = base.where(F.col("month_start") == date_lit(m0)).select(
            user_col,
            "metric_name",
            F.lit(None).cast("int").alias("_at"),
            F.lit(None).cast("bigint").alias("value"),
            F.col("metric_array").alias("_old"),
        )
        rows = rows.unionByName(old)
    per_key = rows.groupBy(user_col, "metric_name").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("_at").isNotNull(), F.struct("_at", "value")))).alias("_new"),
        F.max("_old").alias("_old"),
    )
    zero = F.lit(0).cast("bigint")
    values = F.transform(
        F.sequence(F.lit(0), F.lit((as_of - m0).days)),
        lambda i: F.coalesce(F.try_element_at(F.col("_new"), i), F.get("_old", i), zero),
    )
    return per_key.select(
        user_col,
        date_lit(m0).alias("month_start"),
        "metric_name",
        values.alias("metric_array"),
        date_lit(as_of).alias("as_of"),
    )


def array_metric_daily(metric_arrays: DataFrame) -> DataFrame:
    """Position-wise sum of the arrays over users, one row per (metric, date).

    Every array has at most 31 places, so a (metric, month) group's aggregate
    is 31 sums: one partial row per task and group, and no row is multiplied
    before it. Places that no array has are NULL and give no row.
    """
    places = range(31)
    sums = metric_arrays.groupBy("metric_name", "month_start").agg(
        *[F.sum(F.get("metric_array", F.lit(i))).cast("bigint").alias(f"_{i}") for i in places]
    )
    slots = sums.unpivot(["metric_name", "month_start"], [f"_{i}" for i in places], "slot", "value")
    place = F.expr("substring(slot, 2)").cast("int")
    return slots.where("value is not null").select(
        "metric_name", F.date_add("month_start", place).alias("metric_date"), "value"
    )
