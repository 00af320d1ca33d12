"""Blocked work on hot devices equals plain work; skew is really split."""

from datetime import datetime
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import layout
from millrace.operators import throttle as throttle_module
from millrace.operators.hampel import hampel
from millrace.operators.layout import BLOCK, POSITION, TOTAL, in_blocks, per_key_rows, with_position
from millrace.operators.lttb import _LOW, _choose, _whole, bucket_of, hull_rows, lttb
from millrace.operators.rolling import rolling_mean
from millrace.operators.series import insert_gap_markers, stride_sample
from millrace.operators.throttle import apply_steps, block_steps, compose, kept_mask, throttle
from millrace.schemas import DEVICE, TIME, VALUE
from millrace.session import bounded, stage
from workload.tables import events_clean

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows on one device."""
    rows = events_clean(spark, SF)
    return rows.withColumn(DEVICE, F.when(F.xxhash64(TIME) % 3 == 0, F.lit(-1)).otherwise(F.col(DEVICE))).cache()


def same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b.select(*a.columns)).isEmpty()


@pytest.mark.parametrize("hot_rows", [24, 700, 5000])
def test_hampel_blocked(skewed, hot_rows):
    same(hampel(skewed), hampel(skewed, hot_rows=hot_rows))


def test_markers_stride_and_rolling_mean_blocked(skewed):
    same(insert_gap_markers(skewed, "7d", False), insert_gap_markers(skewed, "7d", False, hot_rows=500))
    same(stride_sample(skewed, 100), stride_sample(skewed, 100, hot_rows=500))
    plain, blocked = (
        rolling_mean(skewed, hot_rows=n).select(DEVICE, TIME, F.round("rolling_mean", 6).alias("m")) for n in (9999, 500)
    )
    same(plain, blocked)


@pytest.mark.parametrize("seconds", [300, 3600, 86_400])
def test_throttle_blocked(skewed, seconds):
    same(throttle(skewed, min_seconds=seconds), throttle(skewed, min_seconds=seconds, hot_rows=400))


def test_throttle_tree(skewed, monkeypatch):
    monkeypatch.setattr(throttle_module, "_FAN", 3)
    same(throttle(skewed, min_seconds=7200), throttle(skewed, min_seconds=7200, hot_rows=150))


def test_lttb_blocked(skewed):
    same(lttb(skewed, samples=50, threshold=60), lttb(skewed, samples=50, threshold=60, hot_rows=500, chunk=200))


SHAPES = {
    "ramp of a tenth": "0.1 * n", "ramp with offset": "0.37 * n + 5", "constant": "0.1", "steps": "floor(n / 100)",
    "counter": "n", "few levels": "pmod(xxhash64(n), 3)", "noise": "rand(7)",
}


@pytest.mark.parametrize("shape", SHAPES)
def test_lttb_does_not_depend_on_how_a_series_is_cut(spark, shape):
    rows = spark.range(4000, numPartitions=4).selectExpr(
        "id as n", f"timestamp_seconds(1700000000 + id * 60) as {TIME}", f"'x' as {DEVICE}")
    rows = stage(rows.withColumn(VALUE, F.expr(SHAPES[shape]).cast("double")), "shape")
    cuts = [(2_000_000, 65_536), (500, 65_536), (500, 300), (500, 97)]
    found = [[tuple(r) for r in lttb(rows, samples=30, threshold=60, hot_rows=h, chunk=c).select(TIME, VALUE).orderBy(TIME)
              .collect()] for h, c in cuts]
    assert len(found[0]) == 30 and all(f == found[0] for f in found[1:])
    # The same by exact fractions.
    points = [(int(r[0].timestamp() * 10**6), Fraction(r[1])) for r in rows.select(TIME, VALUE).orderBy(TIME).collect()]
    buckets = [[] for _ in range(30)]
    for p, b in zip(points, bucket_of(np.arange(4000), 4000, 30)):
        buckets[b].append(p)
    chosen = [buckets[0][0]]
    for own, following in zip(buckets[1:-1], buckets[2:]):
        (ax, ay), size = chosen[-1], len(following)
        mx = Fraction(sum(x for x, _ in following) / size)
        my = Fraction(float(sum(y for _, y in following)) / size)
        chosen.append(max(own, key=lambda p: abs((ax - mx) * (p[1] - ay) - (ax - p[0]) * (my - ay))))
    chosen.append(buckets[-1][0])
    assert [(int(t.timestamp() * 10**6), Fraction(v)) for t, v in found[0]] == chosen


def test_whole_numbers_of_floats():
    values = np.array([0.1, -3.0, 0.0, 5e-324, 1e300, -0.0])
    numbers, low = _whole(values)
    assert [Fraction(int(n)) / 2**-low for n in numbers] == [Fraction(v) for v in values.tolist()]


def frame_form(rows, text):
    frame = f"PARTITION BY {DEVICE} ORDER BY {TIME} RANGE BETWEEN {text} PRECEDING AND CURRENT ROW"
    return rows.withColumn("rolling_mean", F.expr(f"avg({VALUE}) OVER ({frame})"))


def means(df):
    return sorted(((r[0], r[1], None if r[2] is None else round(r[2] + 3e-8, 6)) for r in
                   df.select(DEVICE, TIME, "rolling_mean").collect()), key=repr)


@pytest.mark.parametrize("text", ["INTERVAL 10 SECONDS", "INTERVAL 1 HOUR", "INTERVAL 400 DAYS"])
def test_rolling_mean_of_a_dense_series(spark, text):
    """One row a second, some times twice, readings missing; the hot device lies in many partitions."""
    rows = spark.range(6000, numPartitions=3).selectExpr(
        f"if(id % 3 = 0, 'cold', 'hot') as {DEVICE}", f"timestamp_seconds(1700000000 + id - id % 7 div 6) as {TIME}",
        f"if(id % 11 = 0, null, 1e6 + id * 0.37) as {VALUE}", "id as other")
    rows = stage(rows, "dense")
    expected = means(frame_form(rows, text))
    assert means(rolling_mean(rows, text)) == expected
    assert means(rolling_mean(rows, text, hot_rows=2500)) == expected
    assert rolling_mean(rows, text, hot_rows=2500).columns == [*rows.columns, "rolling_mean"]


@pytest.mark.parametrize("hot_rows", [10, 1000])
def test_rolling_mean_of_odd_readings(spark, hot_rows):
    values = [1.0, float("nan"), 2.0, None, float("inf"), 3.0, float("-inf"), 4.0, 5.0, None, None, None, 6.0]
    rows = [("a", datetime(2024, 1, 1, 0, i), v) for i, v in enumerate(values)] + [(None, datetime(2024, 1, 1), 1.0)] * 12
    df = spark.createDataFrame(rows, f"{DEVICE} string, {TIME} timestamp, {VALUE} double")
    assert repr(means(rolling_mean(df, "INTERVAL 2 MINUTES", hot_rows=hot_rows))) == repr(means(frame_form(df, "INTERVAL 2 MINUTES")))
    lone = spark.createDataFrame([("a", None, 1.0), ("a", datetime(2024, 1, 1), 3.0)], df.schema)
    assert sorted(r[2] or 0 for r in means(rolling_mean(lone))) == [0, 3.0]
    assert rolling_mean(df.limit(0)).count() == 0


def test_positions_and_blocks_of_identical_copies(spark):
    """Copies that cannot be told apart still spread over blocks of exactly the asked size."""
    df = spark.range(5000).select(F.lit("hot").alias("k"), F.lit(1).alias("t"))
    placed = with_position(df, "k", ["t"], hot_rows=100)
    out = placed.agg(F.countDistinct(POSITION), F.min(POSITION), F.max(POSITION), F.max(TOTAL)).head()
    assert tuple(out) == (5000, 0, 4999, 5000)
    sizes = [r["count"] for r in in_blocks(df, "k", ["t"], 1000).groupBy(BLOCK).count().collect()]
    assert sizes == [1000] * 5


def test_bounded_results(spark):
    df = spark.range(200).select((F.col("id") % 10).alias("k"))
    assert layout.hot_keys(df, "k", 20) is None
    assert layout.hot_keys(df, "k", 5).count() == 10
    assert bounded(df, "few", 199).count() == 200 and bounded(df, "few", 200).count() == 200


def test_series_stay_whole_after_a_join_that_becomes_a_broadcast(spark):
    """The planner drops a repartition above a join on the same key; a later broadcast would tear the series."""
    df = spark.range(40_000).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"))
    other = spark.sparkContext.parallelize([(100,)]).toDF("k bigint")
    out = per_key_rows(df.join(other, "k", "left_anti"), "k", ["t"], lambda table, a, b: np.arange(a, a + 1), ["k", "t"])
    assert sorted((r["k"], r["t"]) for r in out.collect()) == [(i, i) for i in range(7)]


def greedy(times, gap):
    kept, last = [], None
    for t in times:
        if last is None or t - last >= gap:
            kept.append(t)
            last = t
    return kept


times = st.lists(st.integers(0, 400), min_size=1, max_size=80).map(sorted)


@settings(max_examples=300, deadline=None)
@given(times, st.integers(1, 90), st.integers(1, 12))
def test_block_steps_compose_to_the_greedy_walk(values, gap, size):
    us = np.array(values, dtype=np.int64)
    assert us[kept_mask(us, gap)].tolist() == greedy(values, gap)
    blocks = [us[i:i + size] for i in range(0, len(us), size)]
    steps = [block_steps(b, gap) for b in blocks]
    last, kept = -(1 << 62), []
    for block, step in zip(blocks, steps):
        kept += block[kept_mask(block, gap, last)].tolist()
        last = int(apply_steps(np.array([last]), gap, *step[:2])[0])
    assert kept == greedy(values, gap) and last == kept[-1]
    whole = steps[0]
    for step in steps[1:]:
        whole = compose(whole, step, gap)
    assert int(apply_steps(np.array([-(1 << 62)]), gap, *whole[:2])[0]) == kept[-1]
    if len(steps) > 2:  # a later start, from any state before it
        tail = steps[1]
        for step in steps[2:]:
            tail = compose(tail, step, gap)
        for state in {int(blocks[0][0]), int(blocks[0][-1])}:
            expected = state
            for step in steps[1:]:
                expected = int(apply_steps(np.array([expected]), gap, *step[:2])[0])
            assert int(apply_steps(np.array([state]), gap, *tail[:2])[0]) == expected


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(-40, 40)), min_size=1, max_size=120))
def test_hull_keeps_every_linear_maximum(points):
    points.sort(key=lambda p: p[0])
    x, y = (np.array(c, dtype=float) for c in zip(*points))
    keep = hull_rows(x, y)
    for a, b in [(1, 0), (0, 1), (1, 1), (-1, 2), (3, -1), (-2, -5), (7, 3), (0.1, -4)]:
        area = a * x + b * y
        assert area[keep].max() == area.max() and area[keep].min() == area.min()


@pytest.mark.parametrize("n, samples", [(13, 12), (100, 12), (1251, 1000), (5000, 1000), (50, 3)])
def test_lttb_sample_shape(n, samples):
    rng = np.random.default_rng(n)
    x, y = np.cumsum(rng.integers(1, 1000, n)), rng.normal(size=n)
    bucket = bucket_of(np.arange(n), n, samples)
    assert len(np.unique(bucket)) == samples
    sums = [y[bucket == b].tolist() for b in range(samples)]
    chosen = _choose(x, y, bucket, x >> 20, x & _LOW, np.ones(n, np.int64), sums)
    assert len(chosen) == samples and chosen[0] == 0 and chosen[-1] == n - 1
    assert chosen == sorted(set(chosen))


def test_lttb_shares_calls_between_pieces(spark):
    """Many devices in many pieces: whole series and pieces give the same, and there is no call for each piece."""
    rows = spark.range(6000).select(
        (F.col("id") % 30).cast("string").alias(DEVICE),
        F.timestamp_seconds(F.col("id")).alias(TIME), F.sin(F.col("id") * 0.37).alias(VALUE))
    cut = lttb(rows, samples=12, threshold=20, hot_rows=50, chunk=24)
    whole = lttb(rows, samples=12, threshold=20)
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))
    assert cut.count() == 30 * 12
    assert "FlatMapGroupsInArrow" not in cut._jdf.queryExecution().toString()


def test_lttb_keeps_short_series_and_ends(spark):
    rows = events_clean(spark, SF)
    assert lttb(rows).count() == rows.count()
    out = lttb(rows, samples=5, threshold=6)
    ends = rows.groupBy(DEVICE).agg(F.min(TIME).alias("a"), F.max(TIME).alias("z"))
    kept = out.groupBy(DEVICE).agg(F.min(TIME).alias("a"), F.max(TIME).alias("z"))
    same(ends, kept)
    assert out.schema[VALUE].dataType.simpleString() == "double"
