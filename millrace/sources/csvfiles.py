"""Device CSV files."""

import csv
import glob
import re
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from itertools import islice

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scalars import parse_ts
from millrace.operators.dedupe import concat_series
from millrace.schemas import DEVICE, OUTLIER, RAW_VALUE, VALUE
from millrace.session import stage, stage_parts

FILE, LINE = "_file", "_line"


def _file_path() -> Column:
    """Path of the row's file; the metadata column holds it URL-encoded, with a plus sign as is."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(path, "^file:/+", "file:/")


_PEEK = 1 << 16
# Files that the driver lists at a time.
FILES = 1 << 13


def _opened(path: str):
    if path.startswith("file:") or "://" not in path:
        return open(re.sub("^file:/+", "/", path), "rb")
    system, place = pafs.FileSystem.from_uri(path)
    return system.open_input_stream(place)


def _first_line(path: str) -> str | None:
    """The first line of a file without reading on; None if there is no such file."""
    try:
        stream = _opened(path)
    except FileNotFoundError:
        return None
    with stream:
        head = b""
        while b"\n" not in head and (more := stream.read(_PEEK)):
            head += more
    return head.split(b"\n", 1)[0].rstrip(b"\r").decode("utf-8-sig", "replace")


def _peek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path in batch.column("path").to_pylist():
            try:
                line = _first_line(path)
                found.append((path, line, line is not None))
            except (OSError, pa.ArrowException):
                found.append((path, None, None))
        yield pa.RecordBatch.from_pylist([dict(zip(("path", "header", "there"), x)) for x in found], schema=_PEEKED)


_PEEKED = pa.schema([("path", pa.string()), ("header", pa.string()), ("there", pa.bool_())])


def _by_text(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, header) by a pass over the text, for stores that only Spark opens."""
    lines = spark.read.text(list(paths)).select(
        _file_path().alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"), "value",
    )
    return lines.filter("start = 0").groupBy("path").agg(F.min_by("value", "line").alias("header"))


def _names(header: str) -> list[str]:
    """Column names of a header line, which may be quoted; of equal names the later ones get their place as a suffix."""
    names = [n.strip() for n in next(csv.reader([header.lstrip("\ufeff")]), [])]
    return [n if n not in names[:i] else f"{n}_{i}" for i, n in enumerate(names)]


def _headers(spark: SparkSession, paths: Sequence[str] | DataFrame) -> DataFrame:
    """(path, header) of the files that are there, staged; the driver holds no list of them."""
    if not isinstance(paths, DataFrame):
        given = spark.createDataFrame([(p,) for p in paths], "path string")
        paths = given.repartition(max(1, min(len(paths) // 16, 512)))
    else:
        paths = paths.repartition(4 * spark.sparkContext.defaultParallelism)
    rows = paths.mapInArrow(_peek, "path string, header string, there boolean").filter("there IS NULL OR there")
    rows = stage(rows, "headers")
    read = [stage(_by_text(spark, files), "headers") for closed in _portions(rows.filter("there IS NULL"))
            if (files := existing(spark, closed))]
    return concat_series(rows.filter("there").drop("there"), *read)


def _portions(files: DataFrame) -> Iterator[list[str]]:
    """The column ``path`` in sorted lists of about ``FILES`` paths, so that the driver never holds all of them."""
    number = -(-files.count() // FILES)
    if number == 1:
        yield sorted(files.select("path").toArrow()["path"].to_pylist())
    if number < 2:
        return
    part = F.pmod(F.xxhash64("path"), F.lit(number)).alias("part")
    dealt = files.select("path", part).repartitionByRange(min(number, 200), "part").sortWithinPartitions("part")
    dealt = stage(dealt, "portions")
    for k in range(number):
        if found := sorted(dealt.filter(F.col("part") == k).toArrow()["path"].to_pylist()):
            yield found


def headers(spark: SparkSession, paths: Sequence[str] | DataFrame) -> dict[tuple[str, ...], list[str]]:
    """Column names -> the files with that header, by name; missing files are left out. ``paths``: a list, or a frame
    with the column ``path``. For a number of files that the driver can hold; ``read_by_header`` does not need that.

    Tasks read the first bytes of the files, so no content is scanned to learn the columns.
    """
    rows = _headers(spark, paths).toArrow()
    found = list(zip(rows["path"].to_pylist(), rows["header"].to_pylist(), strict=True))
    names = {header: tuple(_names(header)) for header in {header for _, header in found}}
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in sorted(found):
        groups.setdefault(names[header], []).append(path)
    return groups


def read_by_header(
    spark: SparkSession, paths: Sequence[str] | DataFrame, required: Sequence[str] = (), base: str | None = None
) -> DataFrame | None:
    """All columns as text, united by name, plus file and line order. Files without ``required`` are skipped.

    Every file is scanned once, together with others of its header, and its rows are staged: whoever reads the result
    several times does not open a great many small files again. The driver lists about ``FILES`` files at a time. With
    ``base``, folders ``name=value`` below it are columns too.
    """
    found = _headers(spark, paths).withColumn("folders", _folder_names(base) if base else F.lit(""))
    groups: dict[tuple[tuple[str, ...], tuple[str, ...]], list[tuple[str, str]]] = {}
    for header, folders in found.select("header", "folders").distinct().collect():
        groups.setdefault((tuple(_names(header)), tuple(folders.split("/")[:-1])), []).append((header, folders))
    frames = []
    for (names, inner), kinds in sorted(groups.items()):
        if not set(required) <= {*names, *inner}:
            continue
        outer = [n for n in inner if n not in names]
        schema = T.StructType([T.StructField(name, T.StringType()) for name in (*names, *outer)])
        reader = spark.read.schema(schema).option("header", True)
        if outer:
            reader = reader.option("basePath", base)
        files = found.filter(F.col("header").isin([header for header, _ in kinds]) & (F.col("folders") == kinds[0][1]))
        frames.append(stage_parts((_rows(spark, reader, portion) for portion in _portions(files)), "files"))
    return concat_series(*frames) if frames else None


def _rows(spark: SparkSession, reader: DataFrameReader, files: list[str]) -> DataFrame:
    """The rows of ``files`` with file and line order."""
    with _fewer_listings(spark):
        found = reader.csv(files)
    return found.select(
        "*",
        _file_path().alias(FILE),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("line"),
        ).alias(LINE),
    )


_LISTINGS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def _fewer_listings(spark: SparkSession) -> Iterator[None]:
    """Readers made in the block list their paths in a few tasks for each core; Spark's default is a task for each path,
    which takes longer to start than to run."""
    before = spark.conf.get(_LISTINGS)
    spark.conf.set(_LISTINGS, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(_LISTINGS, before)


def _folder_names(base: str) -> Column:
    """Names of the folders ``name=value`` between ``base`` and the file ``path``, each with a slash behind it."""
    depth, parts = len(base.rstrip("/").split("/")), F.split("path", "/")
    inner = F.slice(parts, depth + 1, F.greatest(F.size(parts) - F.lit(depth + 1), F.lit(0)))
    inner = F.filter(inner, lambda part: F.instr(part, "=") > 0)
    return F.array_join(F.transform(inner, lambda part: F.concat(F.substring_index(part, "=", 1), F.lit("/"))), "")


def placed(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The non-empty paths in full and in the given order, whether they exist or not; a pattern gives its matches."""
    jvm, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    found = []
    for path in filter(None, paths):
        p = jvm.Path(path)
        files = p.getFileSystem(conf)
        if any(c in path for c in "*?"):
            found += sorted(match.getPath().toString() for match in files.globStatus(p) or [])
        else:
            found.append(files.makeQualified(p).toString())
    return found


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of the full paths that exist."""
    jvm, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    return [p for p in paths if jvm.Path(p).getFileSystem(conf).exists(jvm.Path(p))]


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, path, found) of the files that a path or pattern names; ``found`` is false where it is left to Spark."""
    for batch in batches:
        found = _matches(zip(batch.column("name").to_pylist(), batch.column("path").to_pylist()))
        while some := list(islice(found, 10_000)):
            yield pa.RecordBatch.from_pylist([dict(zip(("name", "path", "found"), x)) for x in some], schema=_MATCHED)


def _matches(given: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str, bool]]:
    for name, path in given:
        local = path.startswith(("file:/", "/")) and not re.search(r"[\[\]{}\\]", path)
        place = re.sub("^file:", "", path)
        if not local or place.startswith("//") and not place.startswith("///"):
            yield name, path, False
            continue
        place = re.sub("/+", "/", place)
        place = place.rstrip("/") or "/"
        if "*" in path or "?" in path:
            for match in glob.iglob(place, include_hidden=True):
                if not re.search(r"(^|/)\.[^/]*\.crc$", match):
                    yield name, f"file:{match}", True
        else:
            yield name, f"file:{place}", True


_MATCHED = pa.schema([("name", pa.string()), ("path", pa.string()), ("found", pa.bool_())])


def _located(spark: SparkSession, given: DataFrame) -> DataFrame:
    """(name, path in full) of the files that the rows (name, path or pattern) name, found in tasks; only what a task
    cannot look up (other stores, relative paths, patterns with brackets) goes through the driver."""
    default = spark._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(spark._jsc.hadoopConfiguration()).getScheme()
    known = F.col("path").startswith("file:") | F.lit(default == "file")
    given = given.filter("path <> ''").select("name", "path")
    found = stage(given.filter(known).mapInArrow(_match, "name string, path string, found boolean"), "located")
    closed = found.filter("NOT found").drop("found").unionByName(given.filter(~known)).distinct().collect()
    rest = [(name, full) for name, path in closed for full in placed(spark, [path])]
    located = found.filter("found").drop("found")
    return (located.unionByName(spark.createDataFrame(rest, located.schema)) if rest else located).distinct()


def read_device_csv(
    spark: SparkSession, mapping: dict[str, str] | DataFrame, t: str = "t", v: str = "flow_ls", k: str = DEVICE
) -> DataFrame | None:
    """(device, t, flow_ls, line) of the mapped files; ``mapping`` is device -> path, or, for many devices, a frame of
    these two columns.

    Empty paths, missing files and files without both columns are skipped; None if none is left.
    """
    if not isinstance(mapping, DataFrame):
        mapping = spark.createDataFrame(list(mapping.items()), "name string, path string")
    names = stage(_located(spark, mapping.toDF("name", "path")), "names")
    rows = read_by_header(spark, names.select("path").distinct(), [t, v])
    if rows is None:
        return None
    devices = names.select(F.col("name").alias(k), F.col("path").alias(FILE))
    return rows.join(devices, FILE).select(k, t, F.col(v).try_cast("double").alias(v), LINE)


def read_clean_csv(spark: SparkSession, folder: str) -> DataFrame | None:
    """All CSV files of a folder, and of folders ``name=value`` in it, as one table in file-name order by ``_line``; None
    if there is none. It reads what ``write_csv`` has written, the device being a folder's name."""
    [base] = placed(spark, [folder])
    given = spark.createDataFrame([("", f"{base}/*.csv"), ("", f"{base}/*=*/*.csv")], "name string, path string")
    return read_by_header(spark, _located(spark, given).select("path").distinct(), base=base)


def read_processed_csv(spark: SparkSession, path: str, t: str = "timestamp") -> DataFrame:
    """Time, raw, smoothed (float) and flag (bool) of processed files; unreadable times dropped; sorted."""
    rows = spark.read.option("header", True).csv(path)
    return (
        rows.select(
            parse_ts(t).alias(t),
            F.col(RAW_VALUE).try_cast("float").alias(RAW_VALUE),
            F.col(VALUE).try_cast("float").alias(VALUE),
            F.col(OUTLIER).try_cast("boolean").alias(OUTLIER),
        )
        .filter(F.col(t).isNotNull())
        .orderBy(t)
    )
