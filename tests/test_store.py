"""Commits of several tables: what readers see at every step, merge on read, compaction, replay."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators.curve import duration_curve
from millrace.operators.daystates import day_states
from millrace.operators.hampel import hampel, needed_days
from millrace.operators.histogram import flow_histogram
from millrace.operators.stats import device_stats
from millrace.plans import pipeline
from millrace.plans.pipeline import Tables, ensure_tables, process_batch, refresh_derived, regenerate_clean, run_increment
from millrace.schemas import DEVICE, RAW, RAW_VALUE, STATS_WINDOWS, TABLES, TIME
from millrace.session import stage
from millrace.sinks.store import DATE, Change, Conflict, Files, Store
from millrace.sinks.tables import append_raw
from workload.tables import customer_devices
from tests.test_increment import COLUMNS, raw_rows, same

class Killed(Exception):
    pass


def dated(spark, rows):
    return spark.createDataFrame([(k, date(2024, 1, d), v) for k, d, v in rows], f"k string, {DATE} date, v int")


def content(snapshot, table):
    return sorted(tuple(r) for r in snapshot.read(table).select("k", DATE, "v").collect())


def test_latest_batch_wins_and_untouched_days_are_read_plainly(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    now = store.commit(store.snapshot(), [Change("t", dated(spark, [("a", 1, 1), ("a", 2, 1), ("b", 2, 1)]), ["k", DATE])])
    now = store.commit(now, [Change("t", dated(spark, [("a", 2, 2), ("c", 3, 2)]), ["k", DATE])], {"m": 7})
    now = store.commit(now, [Change("t", dated(spark, [("a", 2, 3), ("d", 2, 3)]), ["k", DATE])])
    day = lambda d: date(2024, 1, d)
    expected = [("a", day(1), 1), ("a", day(2), 3), ("b", day(2), 1), ("c", day(3), 2), ("d", day(2), 3)]
    assert content(now, "t") == content(store.snapshot(), "t") == expected
    assert store.snapshot().marks == {"m": 7}
    assert content(store.snapshot(1), "t") == [("a", day(1), 1), ("a", day(2), 1), ("b", day(2), 1)]
    assert now.tables["t"]["parts"] == {"2024-01-01": [1], "2024-01-02": [1, 2, 3], "2024-01-03": [2]}
    assert "Join" not in now.read("t", [day(1), day(3)])._jdf.queryExecution().toString()
    assert sorted(r["v"] for r in now.read("t", since=2).collect()) == [3, 3]
    done = store.compact(now, most=2)
    assert done.tables["t"]["parts"] == {"2024-01-01": [1], "2024-01-02": [4], "2024-01-03": [2]}
    assert content(done, "t") == expected and store.compact(done) is done
    store.vacuum(keep=1)
    assert content(store.snapshot(), "t") == expected
    left = {p.parent.relative_to(tmp_path / "t").as_posix() for p in (tmp_path / "t").rglob("*.parquet")}
    assert left == {"batch=1/event_date=2024-01-01", "batch=2/event_date=2024-01-03", "batch=4/event_date=2024-01-02"}


def test_columns_can_be_added_and_keys_may_be_null(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    now = store.commit(store.snapshot(), [Change("t", spark.createDataFrame([(None, 1), ("a", 1)], "k string, v int"), ["k"], False)])
    more = spark.createDataFrame([(None, 2, "x")], "k string, v int, w string")
    now = store.commit(now, [Change("t", more, ["k"], False)])
    assert sorted(map(tuple, now.read("t").collect()), key=repr) == [("a", 1, None), (None, 2, "x")]
    now = store.commit(now, [Change("t", more.limit(0), ["k"], False, replace=True)])
    assert now.read("t").count() == 0


def test_a_second_writer_is_refused(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    base = store.snapshot()
    store.commit(base, [Change("t", dated(spark, [("a", 1, 1)]))])
    with pytest.raises(Conflict):
        Store(spark, str(tmp_path)).commit(base, [Change("t", dated(spark, [("b", 1, 1)]))])
    assert content(store.snapshot(), "t") == [("a", date(2024, 1, 1), 1)]


class Steps(Files):
    """Stops the writer before its n-th changing file operation."""

    left = 0

    def _step(self):
        if Steps.left == 0:
            raise Killed
        Steps.left -= 1

    def write(self, path, text):
        self._step()
        super().write(path, text)
        self._step()

    def rename(self, old, new):
        self._step()
        done = super().rename(old, new)
        self._step()
        return done

    def delete(self, path):
        self._step()
        super().delete(path)


@pytest.mark.parametrize("replace", [False, True])
def test_a_writer_killed_between_any_two_steps_leaves_old_or_new(spark, tmp_path, replace):
    old, new = [("a", date(2024, 1, 1), 1), ("b", date(2024, 1, 2), 1)], dated(spark, [("a", 1, 2), ("c", 3, 2)])
    wanted = [("a", date(2024, 1, 1), 2), ("b", date(2024, 1, 2), 1), ("c", date(2024, 1, 3), 2)]
    wanted = [r for r in wanted if r[2] == 2 or not replace]
    seen = []
    for step in range(20):
        store = Store(spark, str(tmp_path / str(step)))
        base = store.commit(store.snapshot(), [Change("t", dated(spark, [("a", 1, 1), ("b", 2, 1)]), ["k", DATE])], {"m": 1})
        store.files, Steps.left = Steps(spark), step
        write = store._write
        # Also between the tables of one commit: the first one's files are there, the second one's not.
        store._write = lambda c, n: (store.files._step(), write(c, n), store.files._step())[1]
        changes = [Change("t", new, ["k", DATE], replace=replace), Change("u", new)]
        try:
            store.compact(store.commit(base, changes, {"m": 2}), 1)
            store.vacuum(1)
            finished = True
        except Killed:
            finished = False
        now = Store(spark, store.root).snapshot()
        state = content(now, "t")
        assert (state, now.marks["m"], now.has("u")) in [(old, 1, False), (wanted, 2, True)]
        if finished:
            break
        # The attempt after it makes good what was left half done.
        again = Store(spark, store.root)
        if now.marks["m"] == 1:
            now = again.commit(now, changes, {"m": 2})
        assert content(again.compact(now, 1), "t") == wanted
        again.vacuum(1)
        assert content(again.snapshot(), "t") == wanted
        seen.append(now.marks["m"])
    assert finished and step > 6


def raw_table(spark, tmp_path):
    raw = raw_rows(spark)
    lost = raw.limit(3).withColumn("parent_timestampMsec", F.lit(None).cast("long"))
    return raw.select(*RAW.names), lost.select(*RAW.names)


def test_marks_drive_increments_and_replays_change_nothing(spark, tmp_path):
    tables = Tables(str(tmp_path))
    assert run_increment(tables, spark) == 0
    raw, lost = raw_table(spark, tmp_path)
    at = F.timestamp_millis("parent_timestampMsec")
    late = raw.filter(at < "2024-01-18").limit(40).cache()
    append_raw(raw.filter(at < "2024-01-18").join(late, ["device_id", "parent_timestampMsec"], "left_anti").unionByName(lost),
               tables.path("raw"))
    first = run_increment(tables, spark)
    append_raw(raw.filter(at >= "2024-01-18").unionByName(late).unionByName(lost), tables.path("raw"))
    second = run_increment(tables, spark)
    assert 0 < first < second == raw.agg(F.max("parent_timestampMsec")).head()[0]
    # Rows behind the mark need the allowance.
    assert tables.read(spark, "measurements").count() == raw.count() - 40
    assert run_increment(tables, spark, timedelta(days=60)) == second
    series = raw.select(F.col("device_id").alias(DEVICE), at.alias(TIME), F.col("raw_data").alias(RAW_VALUE))
    same(tables.read(spark, "clean"), hampel(series))
    before = {t: tables.read(spark, t).drop("updated_at").collect() for t in ("measurements", "clean", "quarantine", "days")}
    assert len(before["quarantine"]) == lost.distinct().count()
    process_batch(tables, raw.unionByName(lost))
    for name, rows in before.items():
        assert sorted(rows, key=repr) == sorted(tables.read(spark, name).drop("updated_at").collect(), key=repr)


def test_a_repeated_stream_batch_is_skipped(spark, tmp_path):
    tables = Tables(str(tmp_path))
    raw, lost = raw_table(spark, tmp_path)
    process_batch(tables, raw.unionByName(lost), 3)
    number = tables.store(spark).snapshot().number
    process_batch(tables, raw.limit(1), 3)
    assert tables.store(spark).snapshot().number == number


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    """All rows in two increments with a refresh after each, and what the plans of the second refresh read."""
    tables = Tables(str(tmp_path_factory.mktemp("filled")))
    raw, _ = raw_table(spark, None)
    at = F.timestamp_millis("parent_timestampMsec")
    devices = customer_devices(spark, "/root/testdata/sf0.01").withColumn(DEVICE, F.col(DEVICE).cast("string"))
    process_batch(tables, raw.filter(at < "2024-01-28"))
    refresh_derived(tables, devices, as_of(), bins=10)
    opened = []
    process_batch(tables, raw.filter(at >= "2024-01-28"))
    read = pipeline.Snapshot.read

    def noted(self, table, days=None, since=0):
        opened.append((table, None if days is None else sorted(days)))
        return read(self, table, days, since)

    pipeline.Snapshot.read = noted
    refresh_derived(tables, devices, as_of(), bins=10)
    pipeline.Snapshot.read = read
    return tables, devices, opened


def as_of():
    return F.lit("2024-02-01").cast("timestamp")


def rounded(df, columns):
    return sorted((tuple(round(v + 3e-8, 6) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect()), key=repr)


def test_derived_tables_equal_the_recompute(spark, filled):
    tables, devices, _ = filled
    clean = tables.read(spark, "clean")
    means = [*STATS_WINDOWS, "avg_all_time"]
    columns = [DEVICE, "total_measurements", "first_measurement", "last_measurement", *means]
    assert rounded(tables.read(spark, "stats"), columns) == rounded(device_stats(clean, as_of()), columns)
    columns = [DEVICE, "giorno", "m", "n", "p_exceed"]
    assert rounded(tables.read(spark, "duration_curve"), columns) == rounded(duration_curve(clean, devices), columns)
    columns = [DEVICE, "window_start", "bin_index", "range_start", "range_end", "count"]
    assert rounded(tables.read(spark, "histogram"), columns) == rounded(flow_histogram(clean, 10, 0, as_of()), columns)
    states = day_states(clean.withColumn(DATE, F.to_date(TIME)))
    stored = tables.read(spark, "days").drop("changed_in")
    columns = [DEVICE, DATE, "n", "n_value", "n_good", "low", "high", "first_good", "last_good"]
    assert rounded(stored, columns) == rounded(states, columns)


def test_a_refresh_never_opens_the_whole_series(filled):
    assert all(days is not None for table, days in filled[2] if table == "clean")


def test_a_refresh_reads_border_days_and_changed_days(spark, tmp_path):
    tables = Tables(str(tmp_path))
    row = lambda d, day, v: (d, "", 0, day * 86_400_000 + 1000 * v, "Instant flow rate 2", float(v % 50), 1, 0, 0)
    first = [row("a", day, v) for day in range(1, 30) for v in (0, 10, 20, 49)]
    devices = spark.createDataFrame([("a",)], f"{DEVICE} string")
    process_batch(tables, spark.createDataFrame(first, RAW))
    refresh_derived(tables, devices, as_of(), bins=5)
    process_batch(tables, spark.createDataFrame([row("a", 30, 7), row("a", 30, 8)], RAW))
    opened, read = [], pipeline.Snapshot.read
    pipeline.Snapshot.read = lambda self, t, days=None, since=0: (opened.append((t, days)), read(self, t, days, since))[1]
    try:
        refresh_derived(tables, devices, as_of(), bins=5)
    finally:
        pipeline.Snapshot.read = read
    borders, bins = [d for t, d in opened if t == "clean"]
    # Trailing periods of the one device start a day, a week, 30 and 360 days before its last row.
    last = date(1970, 1, 31)
    assert sorted(borders) == sorted(last - timedelta(days=n) for n in (1, 7, 30, 360))
    # The new rows change the frames of the 24 rows before them, on six days, but not the range.
    assert min(bins) >= date(1970, 1, 24)
    clean = tables.read(spark, "clean")
    columns = [DEVICE, "bin_index", "range_start", "range_end", "count"]
    assert rounded(tables.read(spark, "histogram"), columns) == rounded(flow_histogram(clean, 5, 0, as_of()), columns)


def test_only_needed_days_are_opened(spark):
    """A dense device, a sparse one and a new one; a late row of one device opens no day of the others."""
    first = date(2023, 1, 1)
    day = lambda n: date.fromordinal(first.toordinal() + n)
    index = [("dense", day(n), 10) for n in range(400)] + [("sparse", day(n), 1) for n in (3, 200, 390)]
    index += [("late", day(n), 5) for n in range(0, 400, 2)]
    table = spark.createDataFrame(index, f"{DEVICE} string, {DATE} date, n long")
    extents = table.groupBy(DEVICE).agg(F.min(DATE).alias("first_day"), F.max(DATE).alias("last_day"))
    new = spark.createDataFrame([("dense", day(400)), ("sparse", day(400)), ("new", day(400)), ("late", day(100))],
                                f"{DEVICE} string, {DATE} date")
    asked = []

    def days_in(days):
        asked.append(set(days))
        return table.filter(F.col(DATE).isin(list(days)))

    found = needed_days(days_in, sorted({r[1] for r in index}), extents, new, 48)
    got = {}
    for k, d in found.collect():
        got.setdefault(k, []).append((d - first).days)
    assert sorted(got["dense"]) == [395, 396, 397, 398, 399, 400]
    assert sorted(got["sparse"]) == [3, 200, 390, 400]
    assert got["new"] == [400]
    assert sorted(got["late"]) == list(range(80, 121, 2))
    # The first round stays near the new days, the others read on for the sparse device alone.
    assert len(asked) == 3 and len(asked[0]) < 100


def test_jobs_on_nothing(spark, tmp_path):
    tables = Tables(str(tmp_path))
    devices = spark.createDataFrame([("a",)], f"{DEVICE} string")
    for _ in range(2):
        assert run_increment(tables, spark) == 0
        refresh_derived(tables, devices)
        regenerate_clean(tables, spark)
        process_batch(tables, spark.createDataFrame([], RAW))
        ensure_tables(tables, spark)
    assert tables.read(spark, "clean").count() == 0
    lost = spark.createDataFrame([("a", "", 0, None, "m", 1.5, 1, 0, 0)], RAW)
    append_raw(lost, tables.path("raw"))
    assert run_increment(tables, spark) == run_increment(tables, spark) == 0
    assert tables.read(spark, "quarantine").count() == 1


def test_ensured_tables_are_those_of_the_pipeline(spark, tmp_path):
    tables = Tables(str(tmp_path))
    ensure_tables(tables, spark)
    number = ensure_tables(tables, spark).number
    assert number == 1
    for name in ("measurements", "clean", "stats", "histogram", "duration_curve", "etl_state"):
        empty = tables.read(spark, name)
        assert empty.count() == 0 and set(TABLES[name].names) <= set(empty.columns)
    rows = [("a", "", 0, 86_400_000, "Instant flow rate 2", 1.5, 1, 0, 0)]
    process_batch(tables, spark.createDataFrame(rows, RAW))
    assert tables.read(spark, "clean").head()[TIME] == datetime(1970, 1, 2)
    assert tables.read(spark, "clean").columns[: len(TABLES["clean"].names)] == TABLES["clean"].names


def test_rows_looked_at_again_are_not_copied_or_pivoted_and_an_idle_refresh_writes_nothing(spark, tmp_path, monkeypatch):
    tables = Tables(str(tmp_path))
    raw = spark.createDataFrame(
        [(k, "", 0, 86_400_000 * d + 1000, m, float(d), 1, 0, 0) for k in ("a", "b") for d in range(1, 9)
         for m in ("other", "_stored", "Instant flow rate 2")], RAW)
    append_raw(raw, tables.path("raw"))
    run_increment(tables, spark)
    registry = spark.createDataFrame([("a",), ("a",)], f"{DEVICE} string")
    refresh_derived(tables, registry)
    before, staged = tables.store(spark).snapshot(), {}
    assert before.read("measurements").count() == 16

    def record(df, label, *folder):
        staged[label] = (out := stage(df, label, *folder)).count()
        return out

    monkeypatch.setattr(pipeline, "stage", record)
    run_increment(tables, spark, timedelta(days=60))
    assert not {"batch", "wide"} & set(staged) and staged["insert"] == 0
    refresh_derived(tables, registry)
    after = tables.store(spark).snapshot()
    for name in ("measurements", "clean", "stats", "duration_curve", "histogram"):
        assert after.tables[name] == before.tables[name]
    refresh_derived(tables, spark.createDataFrame([("b",)], f"{DEVICE} string"))
    assert {r[0] for r in tables.read(spark, "duration_curve").select(DEVICE).collect()} == {"b"}


def test_needed_days_equal_brute_force(spark):
    chosen, first, rows = random.Random(3), date(2024, 1, 1), 12
    day = lambda n: date.fromordinal(first.toordinal() + n)
    index = [(k, day(n), chosen.randint(0, 6)) for k in "abcdef" for n in range(150) if chosen.random() < 0.4]
    new = [(k, day(n)) for k in "abcdefg" for n in range(150) if chosen.random() < 0.03]
    table = spark.createDataFrame(index, f"{DEVICE} string, {DATE} date, n long")
    extents = table.groupBy(DEVICE).agg(F.min(DATE).alias("first_day"), F.max(DATE).alias("last_day"))
    pairs = spark.createDataFrame([*new, (None, day(5))], f"{DEVICE} string, {DATE} date")
    days = sorted({d for _, d, _ in index})
    found = needed_days(lambda some: table.filter(F.col(DATE).isin(list(some))), days, extents, pairs, rows, step=5)
    want = {*new, (None, day(5))}
    for k, d in new:
        for sign in (1, -1):
            seen = 0
            for at, n in sorted(((a, n) for x, a, n in index if x == k and (a > d if sign == 1 else a < d)), reverse=sign < 0):
                if seen < rows:
                    want.add((k, at))
                seen += n
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_one_later_batch_is_not_grouped_again(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    now = store.commit(store.snapshot(), [Change("t", dated(spark, [("a", 1, 1), (None, 2, 1)]), ["k", DATE])])
    now = store.commit(now, [Change("t", dated(spark, [("a", 1, 2), (None, 2, 2)]), ["k", DATE])])
    assert {r["v"] for r in now.read("t").collect()} == {2} and now.read("t").count() == 2
    assert "Aggregate" not in now.read("t")._jdf.queryExecution().toString()
