import os
import pathlib
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.sinks.tables import open_table, refresh_table

ROOT = pathlib.Path(__file__).resolve().parent.parent
CODE = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", entry.queries()["hampel"](spark, "/root/testdata/sf0.001").count())
"""


def test_python_operators_run_from_another_folder(tmp_path):
    """The working folder is not the repository, so the workers find the package only if it is shipped."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env |= {"PYSPARK_PYTHON": sys.executable, "PYSPARK_DRIVER_PYTHON": sys.executable}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "rows " in done.stdout, done.stderr[-2000:]


def test_a_cluster_needs_a_shared_folder():
    class Cluster:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

        class conf:  # noqa: N801
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError):
        session.scratch_root(Cluster())


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    refresh_table(spark.range(3), path)
    with pytest.raises(Exception):  # noqa: B017
        refresh_table(spark.range(5).withColumn("id", F.raise_error(F.lit("no"))), path)
    assert open_table(spark, path).count() == 3
    refresh_table(open_table(spark, path).filter("id > 0"), path)
    assert open_table(spark, path).count() == 2
