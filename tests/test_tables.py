"""CSV sources and table writers."""

import io
import pathlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators.dedupe import merge_series
from millrace.operators.filters import newer_than
from millrace.plans.queries import clean_files
from millrace.schemas import DEVICE, ETL_STATE, RAW_VALUE, TABLES, TIME, VALUE
from millrace.session import drop_staged, scratch_root, stage, staging_scope
from millrace.sinks.tables import (
    advance_mark,
    append_raw,
    ensure_table,
    insert_ignore_dated,
    open_table,
    read_mark,
    refresh_table,
    upsert_dated,
    upsert_snapshot,
    write_csv,
)
from millrace.sources import csvfiles
from millrace.sources.csvfiles import read_clean_csv, read_processed_csv
from millrace.sources.tables import read_table


def test_clean_files(spark, tmp_path):
    def file(name, text):
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    good = file("out_01. Some place+x.csv",
                "t,flow_ls\n2024-01-01 00:05:00,2.0\n2024-01-01 00:00:00,1.0\nbad,9\n2024-01-01 00:00:00,1.0\n"
                "2024-01-01 00:00:00,7.0\n2024-01-01 00:10:00,\n")
    other = file("b.csv", "flow_ls,note,t\n5.5,x,2024-01-02 00:00:00\n")
    wrong = file("c.csv", "time,value\n1,2\n")
    mapping = {"A": good, "B": other, "C": wrong, "D": "", "E": str(tmp_path / "none.csv")}
    out = clean_files(spark, mapping).orderBy(DEVICE, TIME)
    assert [(r[DEVICE], r[TIME], r[RAW_VALUE]) for r in out.collect()] == [
        ("A", datetime(2024, 1, 1, 0, 0), 1.0),
        ("A", datetime(2024, 1, 1, 0, 5), 2.0),
        ("A", datetime(2024, 1, 1, 0, 10), None),
        ("B", datetime(2024, 1, 2), 5.5),
    ]
    assert clean_files(spark, {"C": wrong, "D": ""}) is None
    write_csv(out, str(tmp_path / "out"))
    assert (tmp_path / "out" / f"{DEVICE}=A").is_dir()


def test_merge_of_csv_folder(spark, tmp_path):
    assert read_clean_csv(spark, str(tmp_path)) is None
    (tmp_path / "a.csv").write_text(f"{DEVICE},{TIME},{VALUE}\nx,2024-01-02 00:00:00,1\nx,oops,2\n")
    (tmp_path / "b.csv").write_text(f"{DEVICE},{TIME},{VALUE},extra\nx,2024-01-02 00:00:00,3,e\nx,2024-01-01 00:00:00,4,f\n")
    full, unique = merge_series(read_clean_csv(spark, str(tmp_path)), ["_line"])
    assert full.count() == 3
    assert [(r[VALUE], r["extra"]) for r in unique.orderBy(TIME).collect()] == [("4", "f"), ("1", None)]


def test_device_folders_and_headers(spark, tmp_path):
    rows = spark.createDataFrame([("SA:3", "2024-01-01", 1.5), ("x y+z", "2024-01-02", 2.5)], f"{DEVICE} string, t string, v double")
    write_csv(rows, str(tmp_path / "out"))
    (tmp_path / "out" / "more.csv").write_text('\ufeff"t","a, quoted",t\r\n2024-01-03,q,w\r\n')
    (tmp_path / "out" / "empty.csv").write_text("")
    back = read_clean_csv(spark, str(tmp_path / "out"))
    found = sorted((r[DEVICE] or "", r["t"], r["v"], r["a, quoted"], r["t_2"]) for r in back.collect() if r["t"])
    assert found == [("", "2024-01-03", None, "q", "w"), ("SA:3", "2024-01-01", "1.5", None, None),
                     ("x y+z", "2024-01-02", "2.5", None, None)]


def test_headers_come_from_the_first_bytes(spark, tmp_path, monkeypatch):
    for i in range(40):
        (tmp_path / f"{i}.csv").write_text(f"a,b{i % 2}\n" + "1,2\n" * 100_000 * (i == 0))
    paths = csvfiles.placed(spark, [f"{tmp_path}/*.csv", f"{tmp_path}/none.csv"])
    groups = csvfiles.headers(spark, paths)
    assert {k: len(v) for k, v in groups.items()} == {("a", "b0"): 20, ("a", "b1"): 20}
    asked = []

    class Counting(io.BytesIO):
        def read(self, size=-1):
            asked.append(size)
            return super().read(size)

    monkeypatch.setattr(csvfiles, "_opened", lambda path: Counting((tmp_path / "0.csv").read_bytes()))
    assert csvfiles._first_line("any") == "a,b0" and asked == [csvfiles._PEEK]
    by_text = csvfiles._by_text(spark, csvfiles.existing(spark, paths))
    assert {(r["path"], r["header"]) for r in by_text.collect()} == {(f, ",".join(k)) for k, v in groups.items() for f in v}


def test_device_files_are_found_in_tasks_and_opened_once(spark, tmp_path, monkeypatch):
    """A frame of patterns, most without a file; the driver expands none of the local ones."""
    for device in ("a", "b"):
        (tmp_path / device).mkdir()
        for part in "12":
            (tmp_path / device / f"{part}.csv").write_text(f"t,flow_ls\n2024-01-0{part} 00:00:00,{part}\n")
    (tmp_path / "a" / ".1.csv.crc").write_text("x")
    bracket = f"{tmp_path}/[b]/2.cs?"
    given = [("a", f"{tmp_path}/a/*.csv"), ("b", f"file:{tmp_path}//b/1.csv"), ("b", bracket), ("none", f"{tmp_path}/none.csv"),
             ("empty", ""), ("null", None), *((f"x{i}", f"{tmp_path}/x{i}/*.csv") for i in range(500))]
    asked, on_driver = [], csvfiles.placed
    monkeypatch.setattr(csvfiles, "placed", lambda s, paths: asked.extend(paths) or on_driver(s, paths))
    mapping = spark.createDataFrame(given, f"{DEVICE} string, path string")
    rows = csvfiles.read_device_csv(spark, mapping)
    assert asked == [bracket]
    assert sorted((r[DEVICE], r["flow_ls"]) for r in rows.collect()) == [("a", 1.0), ("a", 2.0), ("b", 1.0), ("b", 2.0)]
    assert not [f for f in rows.unionByName(rows).inputFiles() if f.endswith(".csv")]
    assert clean_files(spark, mapping).count() == 4


def test_the_driver_lists_few_files_at_a_time(spark, tmp_path, monkeypatch):
    """Many files of two headers, also below folders: no list of paths in one reader, and the same rows."""
    for i in range(60):
        folder = tmp_path / (f"{DEVICE}=d{i}" if i % 3 else ".")
        folder.mkdir(exist_ok=True)
        (folder / f"{i}.csv").write_text(f"t,{'vw'[i % 2]}\n{i},{10 * i}\n{i},{10 * i + 1}\n")
    listed, csv = [], type(spark.read).csv
    monkeypatch.setattr(type(spark.read), "csv", lambda reader, files: listed.append(files) or csv(reader, files))
    monkeypatch.setattr(csvfiles, "FILES", 6)
    rows = read_clean_csv(spark, str(tmp_path)).collect()
    want = [(f"d{i}" if i % 3 else None, str(i), *((x, None) if i % 2 == 0 else (None, x)))
            for i in range(60) for x in (str(10 * i), str(10 * i + 1))]
    assert sorted(((r[DEVICE], r.t, r.v, r.w) for r in rows), key=str) == sorted(want, key=str)
    assert sorted(f for files in listed for f in files) == sorted(f"file:{p}" for p in tmp_path.rglob("*.csv"))
    assert max(map(len, listed)) <= 20
    by_line = sorted((r for r in rows if r.t == "7"), key=lambda r: r["_line"])
    assert [r.w for r in by_line] == ["70", "71"]


def test_processed_csv(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text(f"timestamp,{RAW_VALUE},{VALUE},is_outlier,more\n2024-01-02,1.5,2,True,z\nx,1,1,False,z\n"
                    "2024-01-01,2.5,2.5,False,z\n")
    out = read_processed_csv(spark, str(path))
    assert [f.dataType.simpleString() for f in out.schema] == ["timestamp", "float", "float", "boolean"]
    assert [r[RAW_VALUE] for r in out.collect()] == [2.5, 1.5]


def frame(spark, rows):
    return spark.createDataFrame([(k, datetime(2024, 1, d), v) for k, d, v in rows], "k string, t timestamp, v int")


def test_dated_upsert_writes_only_the_increment(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert_dated(path, frame(spark, [("a", 1, 1), ("a", 2, 2), ("b", 2, 3)]), ["k", "t"], ["v"], "t")
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    upsert_dated(path, frame(spark, [("a", 2, 9), ("a", 2, 8), ("c", 3, 4)]), ["k", "t"], ["v"], "t")
    assert {p: p.stat().st_mtime_ns for p in before} == before
    added = [str(p) for p in tmp_path.rglob("*.parquet") if p not in before]
    assert spark.read.parquet(*added).count() == 2
    out = sorted((r["k"], r["t"].day, r["v"]) for r in open_table(spark, path).collect())
    assert out == [("a", 1, 1), ("a", 2, 9), ("b", 2, 3), ("c", 3, 4)]


def test_dated_insert_ignore(spark, tmp_path):
    path = str(tmp_path / "t")
    insert_ignore_dated(path, frame(spark, [("a", 1, 5), ("a", 1, 4)]), ["k", "t"], ["v"], "t")
    insert_ignore_dated(path, frame(spark, [("a", 1, 1), ("a", 2, 2)]), ["k", "t"], ["v"], "t")
    assert sorted((r["t"].day, r["v"]) for r in open_table(spark, path).collect()) == [(1, 4), (2, 2)]


def test_snapshot_append_refresh(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    upsert_snapshot(path, rows, ["k"], ["v"])
    upsert_snapshot(path, spark.createDataFrame([("b", 2), ("c", 3)], "k string, v int"), ["k"], ["v"])
    assert sorted(map(tuple, open_table(spark, path).collect())) == [("a", 1), ("b", 2), ("c", 3)]
    refresh_table(rows, path)
    assert read_table(spark, "s", str(tmp_path)).count() == 2
    raw = spark.createDataFrame([(86_400_000,), (1,)], "parent_timestampMsec bigint")
    append_raw(raw, str(tmp_path / "raw"))
    append_raw(raw, str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "raw")).groupBy("event_date").count().count() == 2


def test_marks(spark):
    state = spark.createDataFrame([], ETL_STATE)
    assert read_mark(state, "job") == 0
    for ms, expected in [(100, 100), (0, 100), (250, 250)]:  # an empty batch (0) never moves the mark back
        marks = spark.createDataFrame([(ms,)], "max_ts bigint")
        state = stage(advance_mark(state, "job", marks), "state")
        assert read_mark(state, "job") == expected
    rows = spark.createDataFrame([(250,), (251,)], "ms bigint")
    assert [r[0] for r in newer_than(rows, "ms", 250).collect()] == [251]
    times = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 1, 0, 0, 1),)], "t timestamp")
    assert newer_than(times, "t", 1_704_067_200_000).count() == 1
    assert newer_than(times, "t", None).count() == 2


@pytest.mark.parametrize("name", list(TABLES))
def test_ensure_table(spark, name):
    database = "checks"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    ensure_table(spark, name, database)
    created = ensure_table(spark, name, database)
    assert created.columns == TABLES[name].names and created.count() == 0
    spark.sql(f"DROP TABLE {database}.{name}")


def test_staged_tables_are_dropped(spark):
    stage(spark.range(3), "x")
    assert spark.conf.get("spark.checkpoint.dir") == scratch_root(spark)
    assert drop_staged(spark)
    assert stage(spark.range(3).withColumn("y", F.lit(1)), "x").count() == 3
    with staging_scope(spark):
        inner = stage(spark.range(3), "x")
        folder = inner.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert pathlib.Path(folder).is_dir()
    assert not pathlib.Path(folder).exists()
