"""Hand-made edge tables, one group per behaviour that is easy to get wrong."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import curve, filters, histogram, series, stats
from millrace.operators.dedupe import dedupe_first
from millrace.operators.hampel import hampel
from millrace.operators.quality import check_fk, check_not_null, check_unique
from millrace.operators.reshape import decode_events, explode_events, malformed_parts, pivot_measures, split_malformed
from millrace.operators.throttle import throttle
from millrace.plans import queries as Q
from millrace.schemas import DEVICE, MEASURE_COLUMNS, OUTLIER, RAW_VALUE, TIME, VALUE

T0 = datetime(2024, 3, 1)


def clean(spark, rows):
    """rows: (device, seconds after T0, value[, flag])."""
    full = [(r[0], T0 + timedelta(seconds=r[1]), r[2], r[2], r[3] if len(r) > 3 else False) for r in rows]
    return spark.createDataFrame(
        full, f"{DEVICE} string, {TIME} timestamp, {RAW_VALUE} double, {VALUE} double, {OUTLIER} boolean"
    )


def test_histogram_maximum_is_not_counted(spark):
    rows = [("a", i, float(i)) for i in range(11)] + [("flat", i, 5.0) for i in range(3)] + [("one", 0, 2.0)]
    rows += [("a", 99, None)]
    hist = histogram.flow_histogram(clean(spark, rows), bins=10)
    counts = {(r[DEVICE], r["bin_index"]): r["count"] for r in hist.collect()}
    assert [counts["a", i] for i in range(1, 11)] == [1] * 10
    assert [counts["flat", i] for i in range(1, 11)] == [3] + [0] * 9
    assert [counts["one", i] for i in range(1, 11)] == [1] + [0] * 9
    flat = hist.filter(F.col(DEVICE) == "flat").select("range_start", "range_end").distinct().collect()
    assert [tuple(r) for r in flat] == [(5.0, 5.0)]
    upper = histogram.flow_histogram(clean(spark, rows), bins=10, include_upper=True)
    assert upper.filter(f"{DEVICE} = 'a' and bin_index = 10").head()["count"] == 2


def test_histogram_window_is_half_open(spark):
    rows = [("a", 0, 1.0), ("a", 3600, 2.0), ("a", 7200, 3.0)]
    hist = histogram.flow_histogram(
        clean(spark, rows), bins=2, hours=2, as_of=F.lit(T0 + timedelta(hours=2, minutes=20)), include_upper=True
    )
    out = hist.orderBy("bin_index").collect()
    assert [r["count"] for r in out] == [1, 1]
    assert (out[0]["window_start"], out[0]["window_end"]) == (T0, T0 + timedelta(hours=2))


def test_percent_of_empty_histogram_is_zero(spark):
    hist = spark.createDataFrame([("a", 1, 0), ("a", 2, 0), ("b", 1, 1), ("b", 2, 3)],
                                 f"{DEVICE} string, bin_index int, count bigint")
    out = {(r[0], r[1]): r["percent"] for r in histogram.with_percent(hist).collect()}
    assert out == {("a", 1): 0.0, ("a", 2): 0.0, ("b", 1): 25.0, ("b", 2): 75.0}


def test_stats_bounds_flags_and_missing(spark):
    day = 86_400
    rows = [
        ("a", 0, 1.0), ("a", 9 * day, 3.0), ("a", 10 * day, 5.0),  # 9 d is exactly last - 24 h
        ("a", 11 * day, 100.0, True), ("a", 12 * day, None), ("b", 0, 7.0, None), ("gone", 0, 1.0, True),
    ]
    out = {r[DEVICE]: r for r in stats.device_stats(clean(spark, rows)).collect()}
    assert set(out) == {"a", "b"}
    assert out["a"]["total_measurements"] == 3
    assert out["a"]["last_measurement"] == T0 + timedelta(days=10)
    assert (out["a"]["avg_24h"], out["a"]["avg_7d"], out["a"]["avg_30d"]) == (4.0, 4.0, 3.0)
    assert out["b"]["avg_all_time"] == 7.0


def test_curve_ties_rank_by_day_and_flags_count(spark):
    day = 86_400
    rows = [("a", 0, 2.0), ("a", day, 2.0), ("a", 2 * day, 9.0, True), ("a", 3 * day, 1.0), ("x", 0, 1.0)]
    devices = spark.createDataFrame([("a",), ("idle",)], f"{DEVICE} string")
    out = curve.duration_curve(clean(spark, rows), devices)
    assert [(r["m"], r["giorno"], r["p_exceed"]) for r in out.orderBy("m").collect()] == [
        (1, date(2024, 3, 3), 20.0), (2, date(2024, 3, 1), 40.0), (3, date(2024, 3, 2), 60.0), (4, date(2024, 3, 4), 80.0)
    ]
    assert curve.interpolate_at(out).collect()[0]["y_at_x"] == 1.0  # exact hit
    assert curve.interpolate_at(out, 90).collect()[0]["y_at_x"] is None
    assert curve.interpolate_at(out, 70).collect()[0]["y_at_x"] == pytest.approx(1.5)
    everyone = Q.all_curves(devices, out).filter(F.col(DEVICE) == "idle").collect()
    assert [tuple(r) for r in everyone] == [("idle", None, None)]


def test_curve_floor(spark):
    df = spark.createDataFrame([(-51.0,), (-50.0,), (None,), (3.0,)], "flow_avg_day double")
    assert sorted(r[0] for r in filters.curve_floor(df).collect()) == [-50.0, 3.0]


def reference_hampel(values, window, n_sigma):
    import numpy as np

    radius, out = window // 2, []
    for i, v in enumerate(values):
        frame = [x for x in values[max(0, i - radius): i + radius + 1] if x is not None]
        if not frame:
            out.append((None, False))
            continue
        median = float(np.median(frame))
        mad = float(np.median(np.abs(np.array(frame) - median)))
        bad = v is not None and abs(v - median) > n_sigma * 1.4826 * mad
        out.append((median if bad else v, bad))
    return out


HAMPEL_SERIES = {
    "shorter than the window": [1.0, 50.0, 1.0],
    "MAD 0: any difference is an outlier": [5.0] * 9 + [6.0] + [5.0] * 9,
    "spikes at both ends": [90.0, 1.0, 2.0, 1.5, 1.2, 1.1, 80.0],
    "missing readings": [1.0, None, 2.0, 40.0, None, 2.5, 1.5],
    "nothing but missing": [None, None, None],
}


@pytest.mark.parametrize("window", [5, 6, 49])
def test_hampel_edges(spark, window):
    rows = clean(spark, [(name, i * 300, v) for name, values in HAMPEL_SERIES.items() for i, v in enumerate(values)])
    out = hampel(rows, window=window, n_sigma=3.0).orderBy(DEVICE, TIME).collect()
    for name, values in HAMPEL_SERIES.items():
        mine = [(r[VALUE], r[OUTLIER]) for r in out if r[DEVICE] == name]
        assert mine == reference_hampel(values, window, 3.0), name


def test_hampel_keep_edge_and_nan(spark):
    values = [90.0, 1.0, 2.0, float("nan"), 70.0, 1.1, 2.0, 80.0]
    out = hampel(clean(spark, [("a", i, v) for i, v in enumerate(values)]), window=5, n_sigma=1.0, edge="keep")
    out = out.orderBy(TIME).collect()
    assert [r[OUTLIER] for r in out] == [False, False, False, False, True, False, False, False]
    assert out[3][RAW_VALUE] is None and out[3][VALUE] is None
    with pytest.raises(ValueError):
        hampel(clean(spark, []), edge="mirror")


def test_throttle_edges(spark):
    cases = {
        "279": ([0, 279], [0]),
        "280": ([0, 280], [0, 280]),
        "281": ([0, 281], [0, 281]),
        "first and third": ([0, 200, 400], [0, 400]),
        "same instant": ([0, 0, 280], [0, 280]),
    }
    out = throttle(clean(spark, [(name, s, 1.0) for name, (seconds, _) in cases.items() for s in seconds])).collect()
    for name, (_, kept) in cases.items():
        assert sorted((r[TIME] - T0).total_seconds() for r in out if r[DEVICE] == name) == kept


def test_gaps_at_the_threshold(spark):
    hours = [0, 2, 4.001, 5]
    rows = clean(spark, [("a", int(h * 3600), 1.0) for h in hours])
    assert [(r["gap_start"], r["gap_end"]) for r in series.gap_ranges(rows).collect()] == [
        (T0 + timedelta(hours=2), T0 + timedelta(seconds=int(4.001 * 3600)))
    ]
    days = clean(spark, [("a", 0, 1.0), ("a", 86_400, 1.0), ("a", 5 * 86_400, 1.0)])
    assert series.gap_ranges(days, range_key="6m").count() == 1


def test_gap_markers_skip_missing_neighbours(spark):
    hour = 3600
    rows = clean(spark, [("a", 0, 1.0), ("a", 4 * hour, None), ("a", 8 * hour, 2.0), ("a", 12 * hour, 3.0)])
    out = series.insert_gap_markers(rows, "24h", decimated=False).orderBy(TIME).collect()
    assert [((r[TIME] - T0).total_seconds() / hour, r[VALUE], r["is_gap"]) for r in out] == [
        (0, 1.0, False), (8, 2.0, False), (10, None, True), (12, 3.0, False)
    ]
    assert series.insert_gap_markers(rows, "24h", decimated=True).filter("is_gap").count() == 0


def test_stride(spark):
    sizes = {10: 10, 11: 11, 19: 19, 20: 10, 21: 11, 35: 12}
    rows = clean(spark, [(str(n), i, 1.0) for n in sizes for i in range(n)])
    out = series.stride_sample(rows, 10).groupBy(DEVICE).agg(F.count("*").alias("size"), F.min(TIME).alias("first"))
    assert {int(r[DEVICE]): r["size"] for r in out.collect()} == sizes
    assert {r["first"] for r in out.collect()} == {T0}
    assert series.stride_sample(rows, None) is rows


def test_clamp_and_numbers(spark):
    limit = 9_999_999.999
    df = spark.createDataFrame([(limit,), (limit + 1,), (-limit - 1,), (float("nan"),), (None,), (1.5,)], "v double")
    assert [r[0] for r in df.select(S.clamp("v")).collect()] == [limit, limit, -limit, None, None, 1.5]
    text = spark.createDataFrame([(" 1,5 ",), ("2.5",), ("1,2,3",), ("x",), (None,), ("inf",)], "s string")
    assert [r[0] for r in text.select(S.parse_decimal("s")).collect()] == [1.5, 2.5, None, None, None, None]
    numbers = spark.createDataFrame([("7",), ("NaN",), ("Infinity",), ("-Infinity",), ("",)], "s string")
    assert [r[0] for r in numbers.select(S.finite("s")).collect()] == [7.0, None, None, None, None]


def test_time_formats(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 25, 7, 23, 30),), (datetime(2024, 1, 25, 7, 23, 30, 5000),)],
                               "t timestamp")
    out = df.select(S.fmt_iso("t"), S.fmt_short("t"), S.fmt_full("t")).collect()
    assert tuple(out[0]) == ("2024-01-25T07:23:30Z", "25-01-24 07:23:30", "25/01/2024 07:23:30")
    assert out[1][0] == "2024-01-25T07:23:30.005000Z"
    bad = spark.createDataFrame([("2024-02-30",), ("nonsense",), ("2024-02-28 10:00:00",)], "s string")
    assert filters.drop_unparsed(bad, "s", "t").count() == 1


def test_freshness_bounds(spark):
    as_of = F.lit(T0 + timedelta(hours=10))
    rows = clean(spark, [("two", 8 * 3600, 1.0), ("more", 8 * 3600 - 1, 1.0), ("six", 4 * 3600, 1.0),
                         ("old", 4 * 3600 - 1, 1.0)])
    devices = spark.createDataFrame([(d,) for d in ("two", "more", "six", "old", "none")], f"{DEVICE} string")
    out = {r[DEVICE]: r["status"] for r in Q.freshness_query(devices, rows, as_of).collect()}
    assert out == {"two": "status-green", "more": "status-orange", "six": "status-orange", "old": "status-red",
                   "none": "status-gray"}


EVENTS = [
    '{"timestamp": 1, "timestampMsec": 1000, "group_name": "g", "values": {"d1": {"Instant flow rate 2": '
    '{"raw_data": 4.5, "status": 1, "timestamp": 1, "timestampMsec": 999}, "Strange": {"raw_data": 1}}}}',
    "not json",
    '{"timestampMsec": 2000, "values": 5}',
    '{"timestampMsec": 3000, "values": {"d1": 7, "d2": {"Fluid velocity 1": 3, "Fluid velocity 2": {"raw_data": 2}}}}',
    '{"timestampMsec": 4000}',
    "[1, 2]",
]


def test_event_decoding(spark):
    df = spark.createDataFrame([(e,) for e in EVENTS], "body string")
    good, bad = split_malformed(df)
    assert (good.count(), bad.count()) == (3, 3)
    rows = {(r["device_id"], r["measure_name"]): r for r in explode_events(df).collect()}
    assert set(rows) == {("d1", "Instant flow rate 2"), ("d1", "Strange"), ("d2", "Fluid velocity 2")}
    first = rows["d1", "Instant flow rate 2"]
    assert (first["group_name"], first["raw_data"], first["measure_timestampMsec"]) == ("g", 4.5, 999)
    assert rows["d2", "Fluid velocity 2"]["group_name"] == ""
    parts = {(r["device_id"], r["measure_name"], r["text"]) for r in malformed_parts(good).collect()}
    assert parts == {("d1", None, "7"), ("d2", "Fluid velocity 1", "3")}
    events = sorted(r["text"] for r in malformed_parts(df).filter("part = 'event'").collect())
    assert events == sorted(r["body"] for r in bad.collect())


ODD_EVENTS = {
    '{"values": [{"d": {"m": {"raw_data": 1}}}, 2]}': [("event", None, None)],
    '[{"values": {}}]': [("event", None, None)],
    '{"values": null}': [],
    '{"values": {}}': [],
    '{"values": {"d": {}, "e": [], "f": [1, 2], "g": null, "h": "{}"}}': [
        ("device", x, None) for x in "efgh"],
    '{"values": {"d": {"m": [1], "n": null, "o": {"raw_data": "2.5", "status": "x"}, "p": {}}}}': [
        ("measure", "d", "m"), ("measure", "d", "n"), (None, "d", "o"), (None, "d", "p")],
    '{"values": {"d": {"m": {"raw_data": "NaN", "timestampMsec": 5}}, "d": {"m": {"raw_data": 3}}}}': [("event", None, None)],
    ' {"values": {"d": {"m": {"raw_data": 1e3}}}} ': [(None, "d", "m")],
    "": [("event", None, None)],
    "7": [("event", None, None)],
}


@pytest.mark.parametrize("event", [*ODD_EVENTS, None])
def test_parts_of_odd_events(spark, event):
    df = spark.createDataFrame([(event,)], "body string")
    found = decode_events(df).collect()
    assert sorted(((r["part"], r["device_id"], r["measure_name"]) for r in found), key=repr) == sorted(
        ODD_EVENTS.get(event, [("event", None, None)]), key=repr)
    assert explode_events(df).count() == sum(r["part"] is None for r in found)
    values = {r["measure_name"]: r["raw_data"] for r in found if r["part"] is None}
    assert values.get("o", 2.5) == 2.5 and values.get("p") is None and values.get("m") in (None, 3.0, 1000.0)


def test_events_are_parsed_once(spark):
    plan = decode_events(spark.createDataFrame([("{}",)], "body string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


def test_pivot_names(spark):
    rows = [("d", 1000, name, float(i)) for i, name in enumerate(MEASURE_COLUMNS)]
    rows += [("d", 1000, "Unknown", 99.0), ("d", 1000, "Instant flow rate 1", None)]
    raw = spark.createDataFrame(
        rows, "device_id string, parent_timestampMsec bigint, measure_name string, raw_data double")
    out = pivot_measures(raw).collect()
    assert len(out) == 1
    assert [out[0][c] for c in MEASURE_COLUMNS.values()] == [float(i) for i in range(10)]
    assert out[0]["instant_heat_flow_rate_2"] == 4.0 and out[0]["instant_heat_flow_rate_1"] == 5.0


def test_dedupe_first_takes_the_first_of_many_copies(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("key"),
                                    (F.lit(50_000) - F.col("id")).alias("at"), "id")
    out = dedupe_first(df, ["key"], ["at"])
    assert out.filter("key = 0").head()["id"] == 19_998
    assert out.count() == df.select("key").distinct().count()


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("c", 2)], "k string, x int")
    assert [tuple(r) for r in check_unique(df, ["k", "x"]).collect()] == [("a", 1, 2)]
    assert [(r["k"], r["null_columns"]) for r in check_not_null(df, ["k", "x"]).collect()] == [("b", ["x"])]
    dim = spark.createDataFrame([("a",), ("b",)], "k string")
    assert [tuple(r) for r in check_fk(df, dim, "k").collect()] == [("c", 1)]


def test_value_bounds(spark):
    rows = clean(spark, [("neg", 0, -3.0), ("neg", 1, 10.0), ("pos", 0, 2.0), ("pos", 1, 4.0)])
    mean = spark.createDataFrame([("pos", 8.0)], f"{DEVICE} string, mean double")
    out = {r[DEVICE]: (r["y_min"], r["y_max"]) for r in stats.value_bounds(rows, (RAW_VALUE, VALUE), mean).collect()}
    assert out["neg"] == (-50.0, pytest.approx(11.0)) and out["pos"] == (0.0, pytest.approx(8.8))
    curve_kind = {r[DEVICE]: r["y_min"] for r in stats.value_bounds(rows, kind="curve").collect()}
    assert curve_kind == {"neg": -3.0, "pos": 0.0}


def test_read_queries(spark):
    hour = 3600
    rows = clean(spark, [("a", i * hour, float(i)) for i in range(60)] + [("b", 0, 1.0)])
    day = Q.series_query(rows, "a")
    assert day.count() == 25 and day.columns == [TIME, RAW_VALUE, VALUE, OUTLIER]
    assert Q.series_query(rows, "a", "7d").count() == 60
    assert Q.series_query(rows, "a", "whatever").count() == 60
    assert Q.series_query(rows, "missing").count() == 0
    with pytest.raises(ValueError):
        Q.series_query(rows, "")
    devices = spark.createDataFrame([("a", "Alpha", "Roma", True), ("c", "Gamma", None, False)],
                                    f"{DEVICE} string, name string, location string, is_active boolean")
    table = stats.device_stats(rows)
    detail, last = Q.device_detail(devices, table, rows, "b")
    assert detail.head()["name"] == "Unknown Misuratore" and last.count() == 1
    detail, _ = Q.device_detail(devices, table, rows, "c")
    assert detail.head()["total_measurements"] is None
    curves = curve.duration_curve(rows, devices)
    assert Q.curve_query(curves, "a").count() == 3 and Q.curve_query(curves, "c").count() == 0
    hist = histogram.flow_histogram(rows, bins=4, as_of=F.lit(T0))
    both = hist.unionByName(histogram.flow_histogram(rows, bins=2, as_of=F.lit(T0 + timedelta(days=1))))
    newest = Q.histogram_query(both, "a").collect()
    assert len(newest) == 2 and sum(r["percent"] for r in newest) == pytest.approx(100)
    assert [r[DEVICE] for r in Q.device_catalogue(devices, "active").collect()] == ["a"]
    assert [r[DEVICE] for r in Q.device_catalogue(devices, text="ROM alp").collect()] == ["a"]
    assert filters.first_for(devices, "a").count() == 1
    assert stats.latest(rows, "a").head()[0] == T0 + timedelta(hours=59)
