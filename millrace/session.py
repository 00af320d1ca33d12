"""Session settings and the shared scratch area for intermediate tables."""

import gc
import pathlib
import re
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keep small but computation-heavy stages spread over the cores.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def build_session(app: str = "millrace", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where it is unset, a temporary one in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


_scope = threading.local()


def _staging_folder(spark: SparkSession) -> str:
    own = f"{scratch_root(spark)}/staged/{spark.sparkContext.applicationId}"
    return getattr(_scope, "folder", None) or own


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[str]:
    """Delete what is staged inside the block when it ends well; for jobs that have written their result by then.

    The value is the folder around it: ``stage`` to that what shall stay. After an error the staged tables stay: one of them may hold the only copy of a result.
    """
    outer = getattr(_scope, "folder", None)
    around = _staging_folder(spark)
    folder = f"{around}/scope-{uuid.uuid4().hex}"
    _scope.folder = folder
    try:
        yield around
    finally:
        _scope.folder = outer
    _delete(spark, folder)


def _delete(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each query that runs in the block once it has ended; for queries whose result is
    written, so that nobody reads those files again."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streaming queries started in the block keep their state in RocksDB, also in a session that ``build_session`` did
    not make; a query takes its settings when it starts."""
    before = spark.conf.get(_STATE_STORE)
    spark.conf.set(_STATE_STORE, SETTINGS[_STATE_STORE])
    try:
        yield
    finally:
        spark.conf.set(_STATE_STORE, before)


def stage(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` to the scratch area (or a ``folder`` of it) and read it back.

    The lineage is cut in reliable storage, so a lost executor costs no recomputation, and the
    planner sees the true size of the result: it broadcasts a small one on its own and falls back
    to a (skew-split) sort-merge join for a large one. The shuffle files of the write go at its end.
    """
    spark = df.sparkSession
    path = f"{folder or _staging_folder(spark)}/{label}-{uuid.uuid4().hex}"
    with brief_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_parts(parts: Iterable[DataFrame], label: str) -> DataFrame:
    """As ``stage``, for rows that come as frames of the same columns, one at least: each is written before the next is
    made, so the driver plans and lists the files of one at a time."""
    path = None
    for df in parts:
        spark, schema = df.sparkSession, df.schema
        path = path or f"{_staging_folder(spark)}/{label}-{uuid.uuid4().hex}"
        with brief_shuffles(spark):
            df.write.mode("append").parquet(path)
        # Python's handles of Java objects lie in cycles; until they go, the driver keeps the plan and its list of files.
        del df
        gc.collect()
    return spark.read.schema(schema).parquet(path)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a ``folder`` that ``stage`` was given, once nothing reads what lies in it."""
    _delete(spark, folder)


class Buckets:
    """A table in buckets of ``key``, written part by part to a ``folder`` of the scratch area: joins by the key do not
    shuffle it again. There are as many buckets as shuffle partitions, or ``least`` if that is more."""

    def __init__(self, spark: SparkSession, folder: str, key: str, least: int = 0):
        self.spark, self.folder, self.key = spark, folder, key
        self.name = f"millrace_{uuid.uuid4().hex}"
        self.number = max(int(spark.conf.get("spark.sql.shuffle.partitions")), least)

    def add(self, df: DataFrame) -> None:
        with brief_shuffles(self.spark):
            rows = df.repartition(self.number, self.key).write.bucketBy(self.number, self.key)
            rows.mode("append").option("path", self.folder).saveAsTable(self.name, format="parquet")

    def read(self) -> DataFrame:
        """The table; its name goes from the catalog, its files stay with the folder."""
        found = self.spark.table(self.name)
        self.spark.sql(f"DROP TABLE {self.name}")
        return found


def bounded(df: DataFrame, label: str, few: int = 10_000) -> DataFrame | None:
    """``df`` for use as the small side of joins; None if it is empty.

    At most ``few`` rows come back as a local relation, which the planner broadcasts; a longer result
    is staged and joined as its size allows.
    """
    found = df.limit(few + 1).toArrow()
    if found.num_rows == 0:
        return None
    return stage(df, label) if found.num_rows > few else df.sparkSession.createDataFrame(found, df.schema)


def drop_staged(spark: SparkSession) -> bool:
    """Delete this application's intermediate tables, once no result that reads them is needed any more."""
    return _delete(spark, _staging_folder(spark))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application; for runs from a folder that they do not share."""
    context = spark.sparkContext
    if _shipped.get("application") == context.applicationId:
        return
    root = pathlib.Path(__file__).resolve().parent.parent
    target = pathlib.Path(tempfile.mkdtemp(prefix="millrace-ship-")) / "millrace.zip"
    with zipfile.ZipFile(target, "w") as bundle:
        for folder in ("millrace", "workload"):
            for file in sorted((root / folder).rglob("*.py")):
                bundle.write(file, file.relative_to(root))
    context.addPyFile(str(target))
    _shipped["application"] = context.applicationId


_shipped: dict[str, str] = {}
