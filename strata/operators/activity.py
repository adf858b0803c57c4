"""Cumulative activity date lists and 32-day activity bitmaps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dateset
from ..functions.bitmap import any_bits, bit_string, date_bitmap, low_mask, top_bits_mask
from ..functions.columns import date_lit


def day_of(ts_col: str):
    return F.to_date(F.col(ts_col))


def active_users(events: DataFrame, day: dt.date, user_col: str = "user_id", ts_col: str = "event_time") -> DataFrame:
    """Distinct non-NULL users with an event on ``day``.

    ``to_date(ts) = day`` is rewritten by the optimizer into a timestamp
    range that is pushed into the Parquet scan.
    """
    return (
        events.where(F.col(user_col).isNotNull() & (day_of(ts_col) == date_lit(day)))
        .select(user_col)
        .distinct()
        .withColumn("date_active", date_lit(day))
    )


def empty_datelist(events: DataFrame, user_col: str = "user_id") -> DataFrame:
    return events.where(F.lit(False)).select(
        user_col, F.array(F.lit(None).cast("date")).alias("dates_active"), F.lit(None).cast("date").alias("date")
    )


def activity_step(
    prev: DataFrame | None,
    events: DataFrame,
    day: dt.date,
    user_col: str = "user_id",
    ts_col: str = "event_time",
) -> DataFrame:
    """Date list as of ``day`` from the list as of ``day - 1`` and the day's events.

    Full outer join of yesterday's state with today's distinct users: today
    is prepended (newest first), absent users carry their list, new users
    start one. The as-of is the literal day; lists keep every active day.
    """
    if prev is None:
        prev = empty_datelist(events, user_col)
    y = prev.where(F.col("date") == date_lit(day - dt.timedelta(days=1))).alias("y")
    t = active_users(events, day, user_col, ts_col).alias("t")
    today = F.array(F.col("t.date_active"))
    dates = (
        F.when(F.col("y.dates_active").isNull(), today)
        .when(F.col("t.date_active").isNull(), F.col("y.dates_active"))
        .otherwise(F.concat(today, F.col("y.dates_active")))
    )
    j = y.join(t, F.col(f"y.{user_col}") == F.col(f"t.{user_col}"), "full_outer")
    return j.select(
        F.coalesce(F.col(f"t.{user_col}"), F.col(f"y.{user_col}")).alias(user_col),
        dates.alias("dates_active"),
        date_lit(day).alias("date"),
    )


def activity_backfill(
    events: DataFrame,
    last_day: dt.date,
    first_day: dt.date | None = None,
    snapshots_from: dt.date | None = None,
    user_col: str = "user_id",
    ts_col: str = "event_time",
) -> DataFrame:
    """Date-list snapshots up to ``last_day`` in one pass.

    Same content as folding O17 day by day from ``first_day`` (users appear
    from their first active day on): distinct (user, day) -> one group-by on
    the user with the (bounded, one per day) sorted day list ->
    ``explode(sequence)`` over the as-of days -> ``filter`` + ``reverse``.
    ``snapshots_from`` limits which as-of days are produced (e.g. only
    ``last_day``); the lists still hold every active day since ``first_day``.
    """
    d = day_of(ts_col)
    cond = F.col(user_col).isNotNull() & (d <= date_lit(last_day))
    if first_day is not None:
        cond = cond & (d >= date_lit(first_day))
    days = events.where(cond).select(user_col, d.alias("d")).distinct()
    per_user = days.groupBy(user_col).agg(F.min("d").alias("_first"), F.array_sort(F.collect_list("d")).alias("_all"))
    lo = F.col("_first") if snapshots_from is None else F.greatest(F.col("_first"), date_lit(snapshots_from))
    snaps = per_user.where(lo <= date_lit(last_day)).select(
        user_col,
        "_all",
        F.explode(F.sequence(lo, date_lit(last_day), F.expr("INTERVAL 1 DAY"))).alias("date"),
    )
    dates = F.reverse(F.filter(F.col("_all"), lambda x: x <= F.col("date")))
    return snaps.select(user_col, dates.alias("dates_active"), "date")


def activity_bitmap(
    snap: DataFrame,
    as_of: dt.date,
    user_col: str = "user_id",
    width: int = 32,
    anchor_bit: int = 31,
    week_days: int = 7,
    window_days: int | None = None,
) -> DataFrame:
    """Activity bitmap per user as of ``as_of`` and the flags derived from it.

    Bit ``anchor_bit`` is the as-of day, bit ``anchor_bit - n`` is n days
    earlier. Days active = bit count; monthly = any bit; weekly = any of the
    top ``week_days`` bits; daily = the top bit. Row-wise, no shuffle.
    ``anchor_bit=32, window_days=31`` reproduces the literal job (31-day
    series, off-by-one exponent: every flag is a day late).
    """
    s = snap.where(F.col("date") == date_lit(as_of))
    bits = date_bitmap(F.col("dates_active"), F.col("date"), width, anchor_bit, window_days)
    return bitmap_flags(s.select(user_col, "date", bits.alias("activity_bits")), "activity_bits", width, week_days)


def bitmap_flags(df: DataFrame, bits_col: str = "activity_bits", width: int = 32, week_days: int = 7) -> DataFrame:
    """Add the bit string, day count and monthly / weekly / daily flags of a bitmap column."""
    return df.select(
        "*",
        bit_string(bits_col, width).alias("activity_bit_string"),
        F.bit_count(bits_col).cast("int").alias("dim_monthly_active_for_n_days"),
        (F.col(bits_col) != 0).alias("dim_is_monthly_active"),
        any_bits(bits_col, top_bits_mask(week_days, width)).alias("dim_is_weekly_active"),
        any_bits(bits_col, top_bits_mask(1, width)).alias("dim_is_daily_active"),
    )


def activity_bitmap_from_events(
    events: DataFrame,
    as_of: dt.date,
    user_col: str = "user_id",
    ts_col: str = "event_time",
    width: int = 32,
    anchor_bit: int = 31,
    week_days: int = 7,
    window_days: int | None = None,
) -> DataFrame:
    """O18 straight from events, for when no date-list table is kept.

    Same output as ``activity_bitmap`` over the as-of snapshot from one scan
    and one hash aggregate: ``bit_or`` over the days in the window (fixed-width
    state, partial on the map side); users seen only before it get zero.
    """
    if window_days is None:
        window_days = anchor_bit + 1
    d = day_of(ts_col)
    back = F.datediff(date_lit(as_of), d)
    bit = F.when(
        back < window_days, F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(anchor_bit) - back)
    ).otherwise(F.lit(0).cast("bigint"))
    bits = (
        events.where(F.col(user_col).isNotNull() & (d <= date_lit(as_of)))
        .groupBy(user_col)
        .agg(F.bit_or(bit).alias("_bits"))
    )
    out = bits.select(
        user_col,
        date_lit(as_of).alias("date"),
        F.col("_bits").bitwiseAND(F.lit((1 << width) - 1)).alias("activity_bits"),
    )
    return bitmap_flags(out, "activity_bits", width, week_days)


def rolling_bitmap_step(
    prev: DataFrame | None,
    events: DataFrame,
    day: dt.date,
    user_col: str = "user_id",
    ts_col: str = "event_time",
    width: int = 32,
) -> DataFrame:
    """O18 kept as state: (user, activity_bits, date) as of ``day`` from an earlier day's and the events since.

    A user's bits move down by the days since ``prev``'s date, and each later
    day with events sets its bit: one LONG per user, whatever the length of the
    activity, and no list of dates is read or kept. A step may take in one day
    or several; days without events need none. Bits pushed out of the window
    are gone; such users stay, with 0.
    """
    if prev is None:
        prev = events.where(F.lit(False)).select(
            user_col, F.lit(0).cast("bigint").alias("activity_bits"), F.lit(None).cast("date").alias("date")
        )
    d, one = day_of(ts_col), F.lit(1).cast("bigint")
    since = prev.agg(F.max("date")).first()[0]  # one value: the date is the same in all rows
    back = F.datediff(date_lit(day), d)
    bit = F.when(back < width, F.call_function("shiftleft", one, F.lit(width - 1) - back)).otherwise(F.lit(0).cast("bigint"))
    fresh = F.col(user_col).isNotNull() & (d <= date_lit(day))
    if since is not None:
        fresh = fresh & (d > date_lit(since))
    t = events.where(fresh).groupBy(user_col).agg(F.bit_or(bit).alias("new_bits")).alias("t")
    y = prev.select(user_col, "activity_bits", "date").alias("y")
    passed = F.datediff(date_lit(day), F.col("y.date"))
    moved = F.when(passed < width, F.call_function("shiftright", F.col("y.activity_bits"), passed))
    zero = F.lit(0).cast("bigint")
    bits = F.coalesce(moved, zero).bitwiseOR(F.coalesce("t.new_bits", zero)).bitwiseAND(F.lit(low_mask(width)))
    j = y.join(t, F.col(f"y.{user_col}") == F.col(f"t.{user_col}"), "full_outer")
    return j.select(
        F.coalesce(F.col(f"t.{user_col}"), F.col(f"y.{user_col}")).alias(user_col),
        bits.alias("activity_bits"),
        date_lit(day).alias("date"),
    )


def day_users(
    events: DataFrame, first: dt.date, last: dt.date, user_col: str = "user_id", ts_col: str = "event_time"
) -> DataFrame:
    """O17's change rows of the days ``first`` .. ``last``: (user, date) of the users each day adds to."""
    d = day_of(ts_col)
    inside = F.col(user_col).isNotNull() & (d >= date_lit(first)) & (d <= date_lit(last))
    return events.where(inside).select(user_col, d.alias("date")).distinct()


def merge_day_sets(base: DataFrame | None, changes: DataFrame, as_of: dt.date, user_col: str = "user_id") -> DataFrame:
    """O17's state (user, days, date) from a base of packed day sets and the change rows after it.

    Base words and changed days become (user, word, bits) rows, folded by a
    ``bit_or`` hash aggregate with a partial step, then one row per user holds
    its words: 48 bytes per year of activity (see ``functions.dateset``).
    """
    rows = changes.select(user_col, dateset.word_of("date").alias("word"), dateset.bit_of("date").alias("bits"))
    if base is not None:
        rows = rows.unionByName(base.select(user_col, F.inline(dateset.entries_of("days"))))
    words = rows.groupBy(user_col, "word").agg(F.bit_or("bits").alias("bits"))
    sets = words.groupBy(user_col).agg(F.collect_list(F.struct("word", "bits")).alias("_e"))
    return sets.select(user_col, dateset.set_of_words("_e").alias("days"), date_lit(as_of).alias("date"))


def datelists(sets: DataFrame, as_of: dt.date, user_col: str = "user_id") -> DataFrame:
    """The date lists (newest first) as of each user's first day up to ``as_of`` from packed sets: row-wise."""
    first = F.array_min(dateset.unpack("days"))
    each = sets.select(
        user_col, "days", F.explode(F.sequence(first, date_lit(as_of), F.expr("INTERVAL 1 DAY"))).alias("date")
    )
    dates = F.reverse(dateset.unpack(dateset.upto("days", "date")))
    return each.select(user_col, dates.alias("dates_active"), "date")
