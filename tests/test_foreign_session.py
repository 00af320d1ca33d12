"""Queries in a session and a folder of their own: nothing but Spark's settings, the package on the driver's path only."""

import os
import pathlib
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parent.parent

LATE = """
import datetime as dt, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
out = sys.argv[2]
spark = SparkSession.builder.master("local[2]").config(map={
    "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.sql.session.timeZone": "UTC",
    "spark.driver.host": "127.0.0.1", "spark.checkpoint.dir": out + "/kept"}).getOrCreate()
import __spark_entry__
first = dt.datetime(2024, 1, 1)
rows = [(i, first + dt.timedelta(hours=i * 7), i % 3, "view", float(i), "{}") for i in range(100)]
schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
spark.createDataFrame(rows, schema).write.parquet(out + "/events.parquet")
before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
found = {tuple(r) for r in __spark_entry__.queries()["stream_throttle_late"](spark, out).collect()}
assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
expected, last = set(), {}
for _, ts, device, _, value, _ in rows:
    if device not in last or ts - last[device] >= dt.timedelta(days=1):
        last[device] = ts
        if ts < rows[-1][1] - dt.timedelta(days=17):
            expected.add((device, ts, value))
assert expected and found == expected, (found, expected)
"""


def test_late_throttle_in_a_plain_session(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", LATE, str(ROOT), str(tmp_path)], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
