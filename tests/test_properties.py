"""Property-based checks on random small inputs (hypothesis), against brute force."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.columns import REFERENCE_TIERS
from strata.operators import activity, cumulative, metrics, scd
from strata.operators.cumulative import CumulativeSpec

from .conftest import same_rows

SPEC = CumulativeSpec(key="k", period="p", dims=("d",), stats=("v",), measure="v")
SCHEMA = "k string, p int, d string, v double"
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c"]),
        st.integers(1, 6),
        st.sampled_from(["x", "y", None]),
        st.one_of(st.none(), st.sampled_from([0.0, 5.0, 10.0, 12.5, 15.0, 20.0, 25.0])),
    ),
    min_size=1,
    max_size=14,
    unique_by=lambda r: (r[0], r[1]),
)


@SETTINGS
@given(rows_strategy)
def test_fold_equals_backfill(spark, rows):
    src = spark.createDataFrame(rows, SCHEMA)
    lo, hi = min(r[1] for r in rows), max(r[1] for r in rows)
    prev, parts = None, []
    for p in range(lo, hi + 1):
        prev = cumulative.cumulative_step(prev, src, SPEC, p)
        parts.append(prev)
    folded = parts[0]
    for x in parts[1:]:
        folded = folded.unionByName(x)
    back = cumulative.cumulative_backfill(src, SPEC, last=hi, dims_mode="latest")
    assert same_rows(folded, back)


def _classify(v):
    for label, t in REFERENCE_TIERS:
        if v is not None and v > t:
            return label
    return "bad"


@SETTINGS
@given(rows_strategy)
def test_scd_incremental_equals_full_and_brute_force(spark, rows):
    src = spark.createDataFrame(rows, SCHEMA)
    hi = max(r[1] for r in rows)
    snaps = cumulative.cumulative_backfill(src, SPEC, last=hi)
    attrs = ["scoring_class", "is_active"]
    full = scd.scd2_full(snaps, "k", "current_season", attrs, as_of=hi)
    if hi > min(r[1] for r in rows):
        prev = scd.scd2_full(snaps, "k", "current_season", attrs, as_of=hi - 1)
        assert same_rows(scd.scd2_incremental(prev, snaps, "k", attrs, period=hi), full)
    # brute force: per key, walk the periods and cut a new interval on any change
    expected = []
    for k in {r[0] for r in rows}:
        seen = {r[1]: r[3] for r in rows if r[0] == k}
        first, last_v, last_p, cur = min(seen), None, None, None
        for p in range(first, hi + 1):
            if p in seen:
                last_v, last_p = seen[p], p
            state = (_classify(last_v), last_p == p)
            if cur and cur[0] == state:
                cur[2] = p
            else:
                if cur:
                    expected.append((k, *cur[0], cur[1], cur[2]))
                cur = [state, p, p]
        expected.append((k, *cur[0], cur[1], cur[2]))
    got = sorted(tuple(r) for r in full.select("k", "scoring_class", "is_active", "start_season", "end_season").collect())
    assert got == sorted(expected)


ANCHOR = dt.date(2024, 3, 31)


@SETTINGS
@given(st.lists(st.integers(-3, 40), max_size=12), st.sampled_from([31, 32]))
def test_bitmap_matches_brute_force(spark, offsets, anchor_bit):
    dates = [ANCHOR - dt.timedelta(days=o) for o in offsets]
    snap = spark.createDataFrame([(1, dates, ANCHOR)], "user_id long, dates_active array<date>, date date")
    r = activity.activity_bitmap(snap, ANCHOR, anchor_bit=anchor_bit).collect()[0]
    bits = 0
    for o in set(offsets):
        if 0 <= o <= anchor_bit:
            bits |= 1 << (anchor_bit - o)
    bits &= (1 << 32) - 1
    assert r.activity_bits == bits
    assert r.dim_monthly_active_for_n_days == bin(bits).count("1")
    assert r.dim_is_weekly_active == bool(bits & (((1 << 7) - 1) << 25))
    assert r.dim_is_daily_active == bool(bits & (1 << 31))


@SETTINGS
@given(
    st.lists(st.tuples(st.sampled_from([1, 2, 3]), st.integers(1, 9)), max_size=25),
    st.lists(st.integers(1, 9), min_size=1, max_size=9),
)
def test_metric_steps_match_brute_force(spark, hits, run_days):
    """Any order of processed days (skips and reruns included) leaves arrays of
    length k + 1 holding each processed day's count (0 for skipped days)."""
    ev = spark.createDataFrame(
        [(u, dt.datetime(2024, 5, d, 12)) for u, d in hits], "user_id long, event_time timestamp_ntz"
    )
    run_days = sorted(set(run_days))  # a daily job runs forward; gaps are skipped days
    prev, processed = None, []
    for d in run_days:
        day = dt.date(2024, 5, d)
        if prev is not None:
            prev = prev.withColumn("as_of", F.lit(day - dt.timedelta(days=1)))  # prior = last written state
        prev = metrics.array_metric_step(prev, ev, day)
        processed.append(d)
    got = {r.user_id: r.metric_array for r in prev.collect()}
    last = run_days[-1]
    users = {u for u, d in hits if d in processed}
    expected = {}
    for u in users:
        arr = []
        for offset in range(last):
            d = offset + 1
            arr.append(sum(1 for uu, dd in hits if uu == u and dd == d) if d in processed else 0)
        expected[u] = arr
    assert got == expected


fact_rows = st.lists(
    st.tuples(
        st.integers(1, 6),  # member
        st.integers(1, 4),  # group
        st.sampled_from(["T1", "T2", None]),  # side
        st.integers(0, 9),  # measure
        st.integers(0, 3),  # order
    ),
    min_size=1,
    max_size=30,
    unique_by=lambda r: (r[0], r[1], r[4]),
)


@SETTINGS
@given(fact_rows, st.sampled_from([1, 2, 10**9]))
def test_pair_edges_match_brute_force(spark, rows, chunk):
    from strata.operators import graph

    df = spark.createDataFrame(rows, "m long, g long, side string, v int, o int")
    e = graph.cooccurrence_edges(df, "m", "g", "side", "v", order=["o"], chunk_rows=chunk)
    got = sorted(
        (int(r.subject_identifier), int(r.object_identifier), r.edge_type, *[int(x) for x in r.p])
        for r in e.select(
            "subject_identifier",
            "object_identifier",
            "edge_type",
            F.array(
                F.get_json_object("properties", "$.num_games"),
                F.get_json_object("properties", "$.subject_points"),
                F.get_json_object("properties", "$.object_points"),
            ).alias("p"),
        ).collect()
    )
    first = {}
    for m, g, side, v, o in sorted(rows, key=lambda r: r[4]):
        first.setdefault((m, g), (side, v))
    agg = {}
    for (ma, g), (sa, va) in first.items():
        for (mb, gb), (sb, vb) in first.items():
            if g == gb and ma > mb:
                t = "shares_team" if sa is not None and sa == sb else "plays_against"
                n, pa, pb = agg.get((ma, mb, t), (0, 0, 0))
                agg[(ma, mb, t)] = (n + 1, pa + va, pb + vb)
    assert got == sorted((a, b, t, *vals) for (a, b, t), vals in agg.items())


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 5), st.integers(0, 100)), min_size=1, max_size=25,
                unique_by=lambda r: (r[0], r[1])))
def test_dedup_first_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, o int, v int")
    from strata.operators import quality

    got = sorted(tuple(r) for r in quality.dedup_first(df, ["k"], ["o"]).collect())
    best = {}
    for k, o, v in rows:
        if k not in best or o < best[k][1]:
            best[k] = (k, o, v)
    assert got == sorted(best.values())
