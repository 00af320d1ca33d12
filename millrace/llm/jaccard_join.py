"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

Documents with equal shingle sets are one class first, with the smallest id as representative; everything below works on
representatives. Two sets can only reach the threshold if they share a shingle among the rarest few of each, so only
those are joined. The order of rarity comes from a table of ``CELLS`` counters: any order gives right results, and very
common shingles stand out in it at every size.

A shared prefix shingle is not expanded into all its pairs at once. The first round compares its documents with its most
central set only; the second compares all pairs across the components found so far. A large group of near copies is
therefore linked by a number of comparisons in proportion to its size, and no pair that could join two components is
left out. ``every_link=True`` compares all pairs instead.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import words as W
from millrace.llm.shared import bitmap, components, documents, in_bitmap, small_batches
from millrace.session import stage, staging_scope

N = 4
PERCENT = 85
CELLS = 1 << 19
PARTS = 256
_FULL = 255


def _need(percent: int, both):
    """The smallest intersection of two sets of ``both`` shingles in sum that reaches the threshold."""
    return (percent * both + 99 + percent) // (100 + percent)


def _pack(codes: np.ndarray) -> np.ndarray:
    """48-bit codes as 6 bytes each."""
    return np.ascontiguousarray(codes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).reshape(-1)


def _unpack(data) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :6] = raw
    return out.reshape(-1).view("<u8")


def _binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _sets(batches, n: int, key: str, text: str):
    for whole in batches:
        for batch in W.slices(whole, text):
            code, row = W.shingle_sets(W.find_words(batch.column(text), W.SPACED), n)
            yield batch.column(key), code, row, np.bincount(row, minlength=batch.num_rows)


def rarity(docs: DataFrame, n: int, key: str, text: str) -> np.ndarray:
    """How many (document, shingle) pairs fall into each of ``CELLS`` hash cells, counted over all documents."""

    def count(batches):
        total = np.zeros(CELLS, np.int64)
        for _, code, _, _ in _sets(batches, n, key, text):
            total += np.bincount((code & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
        cell = np.flatnonzero(total)
        for at in range(0, len(cell), 1 << 16):
            part = cell[at : at + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"cell": pa.array(part, pa.int32()), "n": pa.array(total[part])})

    found = docs.select(key, text).mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    rows = found.toArrow()
    out = np.zeros(CELLS, np.int64)
    out[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    return out


def signatures(docs: DataFrame, n: int, percent: int, key: str, text: str) -> DataFrame:
    """A row for each document: set size, 128-bit sum of the set, rarest shingles in order."""
    counts = docs.sparkSession.sparkContext.broadcast(rarity(docs, n, key, text))

    def sign(batches):
        for ids, code, row, size in _sets(batches, n, key, text):
            first = np.concatenate([[0], np.cumsum(size)])
            a, b = W.mix(code + np.uint64(1)), W.mix(code ^ np.uint64(0x5851F42D4C957F2D))
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)]) for x in (a, b)]
            s1, s2 = (x[first[1:]] - x[first[:-1]] for x in sums)
            common = counts.value[(code & np.uint64(CELLS - 1)).astype(np.int64)]
            order = np.argsort((row << 44) | np.minimum(common, (1 << 44) - 1), kind="stable")
            long = np.where(size > 0, size - (percent * size + 99) // 100 + 1, 0)
            head = np.arange(len(code)) - first[row] < long[row]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(size, pa.int32()), pa.array(W.signed(s1)), pa.array(W.signed(s2)),
                 _binaries(_pack(code[order][head]), np.cumsum(long) * 6)],
                names=["doc_id", "n", "s1", "s2", "prefix"],
            )

    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text))
    return rows.mapInArrow(sign, "doc_id long, n int, s1 long, s2 long, prefix binary")


def _entries(reps: DataFrame, only: np.ndarray | None = None) -> DataFrame:
    """(token, rep, n, pos) of the prefixes; ``only``: a bitmap of the tokens of interest."""
    wanted = None if only is None else reps.sparkSession.sparkContext.broadcast(only)

    def explode(batches):
        for batch in batches:
            data = batch.column("prefix").to_pylist()
            token = _unpack(b"".join(data))
            sizes = np.array([len(x) // 6 for x in data])
            row = np.repeat(np.arange(len(sizes)), sizes)
            pos = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            keep = slice(None) if wanted is None else in_bitmap(wanted.value, token)
            row = row[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(token[keep].astype(np.int64)), batch.column("rep").take(pa.array(row)),
                 batch.column("n").take(pa.array(row)), pa.array(pos[keep], pa.int32())],
                names=["token", "rep", "n", "pos"],
            )

    return reps.select("rep", "n", "prefix").mapInArrow(explode, "token long, rep long, n int, pos int")


def _near(percent: int, nx: Column, ny: Column) -> Column:
    """Length filter: sets that differ more in size cannot reach the threshold."""
    return F.lit(100) * F.least(nx, ny) >= F.lit(percent) * F.greatest(nx, ny)


def _hopeful(percent: int) -> Column:
    """Whether a pair can still suffice if all before and behind one shared shingle were shared."""
    need = F.floor((F.lit(percent) * (F.col("nx") + F.col("ny")) + 99 + percent) / F.lit(100 + percent))
    return F.least("px", "py") + F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py")) >= need


def _pairs(matches: DataFrame, percent: int) -> DataFrame:
    """(x, y) of the matches (a, b) on prefix shingles that the positional filter leaves.

    Behind the last shared shingle of the prefixes, a pair has at most what is left of either set; before it, no more
    than the matches that were found. The order of a and b is by representative.
    """
    turned = F.col("a.rep") > F.col("b.rep")
    x, y = F.when(turned, F.col("b")).otherwise(F.col("a")), F.when(turned, F.col("a")).otherwise(F.col("b"))
    found = (
        matches.select(x["rep"].alias("x"), y["rep"].alias("y"), x["n"].alias("nx"), y["n"].alias("ny"),
                       x["pos"].alias("px"), y["pos"].alias("py"))
        .filter(_hopeful(percent))
        .groupBy("x", "y", "nx", "ny").agg(F.count("*").alias("c"), F.max("px").alias("px"), F.max("py").alias("py"))
    )
    need = F.floor((F.lit(percent) * (F.col("nx") + F.col("ny")) + 99 + percent) / F.lit(100 + percent))
    left = F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py")) - 1
    return found.filter(F.col("c") + left >= need).select("x", "y")


def _verified(docs: DataFrame, reps: DataFrame, pairs: DataFrame, n: int, percent: int, key: str, text: str):
    """(x, y, linked) for candidate pairs of representatives, each compared once on its whole sets.

    The sets of the documents in question are made again from their texts, with counts by hash part. The suffix filter
    comes first: of each part, a pair shares at most the smaller count. Of what is staged only the result stays.
    """
    with staging_scope(docs.sparkSession) as around:
        return _compared(docs, reps, pairs, n, percent, key, text, around)


def _compared(
    docs: DataFrame, reps: DataFrame, pairs: DataFrame, n: int, percent: int, key: str, text: str, around: str
) -> DataFrame:
    spark = docs.sparkSession
    pairs = stage(pairs, "pairs")
    ids = pairs.select(F.col("x").alias("rep")).union(pairs.select(F.col("y").alias("rep"))).distinct()
    ids = stage(ids.join(reps.select("rep", "s1"), "rep"), "ids")
    wanted = spark.sparkContext.broadcast(bitmap(ids, "rep"))

    def fetch(batches):
        for batch in batches:
            at = batch.schema.names.index(key)
            batch = batch.filter(batch.column(at).is_valid())
            batch = batch.filter(pa.array(in_bitmap(wanted.value, batch.column(at).to_numpy())))
            for own, code, row, size in _sets([batch], n, key, text):
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(code + np.uint64(1)))])
                first = np.concatenate([[0], np.cumsum(size)])
                part = np.bincount(row * PARTS + (code >> np.uint64(W.CODE_BITS - 8)).astype(np.int64),
                                   minlength=len(own) * PARTS)
                part = np.minimum(part, _FULL).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array(W.signed(total[first[1:]] - total[first[:-1]])), pa.array(size, pa.int32()),
                     _binaries(part, np.arange(1, len(own) + 1) * PARTS), _binaries(_pack(code), np.cumsum(size) * 6)],
                    names=["rep", "s1", "n", "parts", "codes"],
                )

    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text))
    shape = "rep long, s1 long, n int, parts binary, codes binary"
    sets = stage(rows.mapInArrow(fetch, shape).join(ids, ["rep", "s1"]).drop("s1").dropDuplicates(["rep"]), "sets")

    def suffix(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, PARTS)
                        for c in ("parts_x", "parts_y"))
                both = batch.column("nx").to_numpy().astype(np.int64) + batch.column("ny").to_numpy()
                keep = np.minimum(x, y).sum(1, dtype=np.int64) >= _need(percent, both)
                keep |= ((x == _FULL) | (y == _FULL)).any(1)
                yield batch.select(["x", "y"]).filter(pa.array(keep))

    left = sets.select(F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("parts").alias("parts_x"))
    right = sets.select(F.col("rep").alias("y"), F.col("n").alias("ny"), F.col("parts").alias("parts_y"))
    pairs = pairs.join(left, "x").join(right, "y").mapInArrow(suffix, "x long, y long")

    def compare(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                keys, size = [], np.zeros(batch.num_rows, np.int64)
                for c in ("codes_x", "codes_y"):
                    data = batch.column(c).to_pylist()
                    lengths = np.array([len(v) // 6 for v in data])
                    size += lengths
                    pair = np.repeat(np.arange(len(data), dtype=np.uint64), lengths)
                    keys.append((pair << np.uint64(48)) | _unpack(b"".join(data)))
                key_ = np.sort(np.concatenate(keys))
                same = key_[1:][key_[1:] == key_[:-1]] >> np.uint64(48)
                shared = np.bincount(same.astype(np.int64), minlength=batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("x"), batch.column("y"), pa.array(shared >= _need(percent, size))],
                    names=["x", "y", "linked"],
                )

    both = (
        pairs.join(sets.select(F.col("rep").alias("x"), F.col("codes").alias("codes_x")), "x")
        .join(sets.select(F.col("rep").alias("y"), F.col("codes").alias("codes_y")), "y")
    )
    return stage(both.mapInArrow(compare, "x long, y long, linked boolean"), "verified", around)


def links(
    docs: DataFrame, n: int = N, percent: int = PERCENT, key: str = "doc_id", text: str = "text",
    every_link: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, representatives, links).

    members: doc_id, n, s1, s2 of every row (``n`` is the set size). representatives: rep, n, s1, s2 of every distinct
    non-empty set. links: (x, y) of representatives that reach the threshold: enough of them to connect all that is
    connected, or all of them with ``every_link``.

    Null and empty texts have empty sets and no representative. Rows without an id belong to the class of their set
    but never represent it. Repeated rows fall into one class.
    """
    spark = docs.sparkSession
    small_batches(spark)
    signed = stage(signatures(docs, n, percent, key, text), "signatures")
    members = signed.select("doc_id", "n", "s1", "s2")
    classes = (
        members.filter(F.col("n") > 0).groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"))
        .filter(F.col("rep").isNotNull())
    )
    chosen = signed.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "s1", "s2"])
    reps = stage(chosen.withColumnRenamed("doc_id", "rep").dropDuplicates(["rep"]), "reps")

    tokens = _entries(reps).groupBy("token").count().filter(F.col("count") > 1).select("token")
    tokens = stage(tokens, "tokens")
    shared = stage(_entries(reps, bitmap(tokens, "token", 1 << 26)).join(tokens, "token"), "shared")
    known = spark.createDataFrame([], "x long, y long, linked boolean")
    rest = shared.withColumn("component", F.col("rep"))
    if not every_link:
        # The entry with the fewest rarer shingles before it is the most central.
        hubs = rest.groupBy("token").agg(F.min(F.struct("pos", "n", "rep")).alias("hub"))
        star = rest.join(hubs, "token").filter(F.col("rep") != F.col("hub.rep"))
        star = star.filter(_near(percent, F.col("n"), F.col("hub.n")))
        star = star.select(F.struct("rep", "n", "pos").alias("a"), F.struct("hub.rep", "hub.n", "hub.pos").alias("b"))
        known = _verified(docs, reps, _pairs(star, percent), n, percent, key, text)
        found = stage(components(known.filter("linked"), "x", "y").withColumnRenamed("node", "rep"), "components")
        placed = rest.drop("component").join(found, "rep", "left")
        placed = placed.withColumn("component", F.coalesce("component", "rep"))
        mixed = placed.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b"))
        rest = stage(placed.join(mixed.filter("a != b").select("token"), "token"), "rest")
    group = rest.select("token", "component").distinct()
    across = group.join(group.select("token", F.col("component").alias("other")), "token")
    across = across.filter(F.col("component") < F.col("other"))
    first, second = (
        rest.select("token", F.col("component").alias(c), F.struct("rep", "n", "pos").alias(name))
        for c, name in (("component", "a"), ("other", "b"))
    )
    # The smaller set of a pair shares a shingle within its shorter index prefix.
    small = F.when(F.struct("a.n", "a.rep") < F.struct("b.n", "b.rep"), F.col("a")).otherwise(F.col("b"))
    index = small["n"] - F.ceil(F.lit(2 * percent) * small["n"] / F.lit(100 + percent)) + 1
    matches = across.join(first, ["token", "component"]).join(second, ["token", "other"])
    matches = matches.filter(_near(percent, F.col("a.n"), F.col("b.n")) & (small["pos"] < index)).select("a", "b")
    others = _pairs(matches, percent).join(known.select("x", "y"), ["x", "y"], "left_anti")
    others = _verified(docs, reps, others, n, percent, key, text)
    linked = known.filter("linked").select("x", "y").union(others.filter("linked").select("x", "y"))
    return members, reps.select("rep", "n", "s1", "s2"), linked


def cluster(docs: DataFrame, n: int = N, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``: the smallest id that links reach from it."""
    members, reps, linked = links(docs, n, percent, key, text)
    found = components(linked, "x", "y", "component_id").withColumnRenamed("node", "rep")
    named = reps.join(found, "rep", "left").select("s1", "s2", F.coalesce("component_id", "rep").alias("component_id"))
    full = members.filter("n > 0").join(named, ["s1", "s2"], "left")
    return full.select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                       F.coalesce("component_id", "doc_id").alias("component_id")).union(
        members.filter("n = 0").select("doc_id", F.lit(0).cast("long"), "doc_id"))


def keep_one(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id; of repeated rows of an id, one.

    Rows without an id stay: nothing can name them.
    """
    with staging_scope(docs.sparkSession) as around:
        kept = cluster(docs, n, percent).filter(F.col("doc_id") == F.col("component_id"))
        kept = stage(kept.groupBy("doc_id").agg(F.count("*").alias("copies")), "kept", around)
    single = docs.join(kept.filter("copies = 1").select("doc_id"), "doc_id", "left_semi")
    repeated = docs.join(kept.filter("copies > 1").select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return single.unionByName(repeated).unionByName(docs.filter(F.col("doc_id").isNull())).select(docs.columns)


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(documents(spark, sf_dir).select("doc_id", "text"))


OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(g) AS h, g FROM (
    SELECT doc_id, array_to_string(ws[i : i + 3], ' ') AS g
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 2)) AS i FROM d WHERE len(ws) >= 4)
    UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 3)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes AS a ON a.doc_id = x JOIN sizes AS b ON b.doc_id = y
  WHERE 100 * common.n >= 85 * (a.n + b.n - common.n)),
either AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM d
  UNION SELECT reach.x, either.y FROM reach JOIN either ON either.x = reach.y)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) AS c
USING (doc_id)
"""
