"""Exact top-k search by inner product over a paged metric tree.

A vector x becomes the point (x, sqrt(M - |x|^2)), M the largest squared length, and a query q the point (q, 0): the
nearer the point, the larger the inner product. Routing objects are vectors of the data, chosen from a bounded sample.
Each vector belongs to its nearest routing object; the members of one are dealt to pages of about ``PAGE`` rows, so
copies of one vector, however many, fill many small pages. A page has a centre, a covering radius, the distance of its
centre from its routing object, and the distance of each member from the centre. The tree is written as a table.

A search visits the pages of a task from the smallest lower bound on. The stored distances bound those of centres and
members by the triangle inequality, so most need not be computed. Pruning is by bounds that hold, with a margin for
rounding; scores are whole numbers, so results are exact.

The tree holds vectors whose squared length is below ``LONG``: their scores are exact in floating point. Longer ones, rows
or queries, would blur its distances; they are compared with all others in unlimited whole numbers, block by block. Scores
beyond 64 bits count as the nearest number of 64 bits.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.shared import table
from millrace.session import stage

SCALE = 1024
K = 10
ROUTES = 256
PAGE = 256
BLOCK = 4096
LONG = 2.0**50
_SLACK = 1e-6


def whole_vectors(rows: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(key, v: binary of little-endian doubles, size, length): floor(scale * x) of each vector that takes part, and its
    squared length.

    Left out: null keys, null or empty vectors, vectors with null, NaN or infinite components, or components that are
    infinite once scaled. Of repeated keys, the vector of the smallest bytes counts. Vectors of different sizes are
    compared as if the shorter had zeros at its end.
    """

    def convert(batches):
        for batch in batches:
            lists = batch.column("vector")
            use = pc.and_(lists.is_valid(), pc.greater(pc.fill_null(pc.list_value_length(lists), 0), 0))
            batch = batch.filter(use)
            lists = batch.column("vector")
            size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = pc.fill_null(lists.flatten(), float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
            first = np.concatenate([[0], np.cumsum(size)])
            with np.errstate(over="ignore", invalid="ignore"):
                scaled = np.floor(flat * scale) + 0.0  # no negative zeros
                length = np.bincount(np.repeat(np.arange(len(size)), size), scaled**2, minlength=len(size))
            good = np.diff(np.concatenate([[0], np.cumsum(~np.isfinite(scaled))])[first]) == 0
            data = [scaled[first[r] : first[r + 1]].astype("<f8").tobytes() for r in np.flatnonzero(good)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").filter(pa.array(good)), pa.array(data, pa.binary()), pa.array(size[good], pa.int32()),
                 pa.array(length[good])], names=["id", "v", "size", "length"])

    chosen = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    found = chosen.filter("id is not null").mapInArrow(convert, "id long, v binary, size int, length double")
    return found.groupBy("id").agg(F.min(F.struct("v", "size", "length")).alias("x")).select("id", "x.*")


def _matrix(data: list[bytes], width: int) -> np.ndarray:
    if all(len(v) == 8 * width for v in data):
        return np.frombuffer(b"".join(data), "<f8").reshape(len(data), width)
    out = np.zeros((len(data), width))
    for row, v in enumerate(data):
        x = np.frombuffer(v, "<f8")
        out[row, : len(x)] = x
    return out


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of vectors shorter than ``LONG``: no sum on the way needs more than 53 bits."""
    return (a @ b.T).astype(np.int64)


def _long_dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers of any size, those beyond 64 bits as the nearest number of 64 bits."""
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(a) @ whole(b).T, -(2**63), 2**63 - 1).astype(np.int64)


def _points(x: np.ndarray, most: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(0.0, most - (x**2).sum(1)))[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(0.0, d))


def build(vectors: DataFrame, routes: int = ROUTES, page: int = PAGE) -> tuple[DataFrame, dict, DataFrame]:
    """The tree over staged ``whole_vectors``: its pages as a table, its root (routing vectors and measures), and the
    vectors themselves, for those too long for it."""
    spark = vectors.sparkSession
    short = vectors.filter(F.col("length") < LONG)
    width = int(vectors.agg(F.max("size")).first()[0] or 1)
    top = short.agg(F.max("length"), F.count("*")).first()
    most, rows = float(top[0] or 0.0), int(top[1])
    sample = short.orderBy(F.xxhash64("id"), "id").limit(routes).select("id", "v").toArrow()
    root = {"width": width, "most": most, "rows": rows, "ids": sample["id"].to_numpy(),
            "routes": _matrix(sample["v"].to_pylist(), width)}
    known = spark.sparkContext.broadcast(root)

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                x = _points(_matrix(batch.column("v").to_pylist(), width), most)
                near = _distances(x, _points(known.value["routes"], most)).argmin(1)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(near, pa.int32())],
                                                 names=["id", "v", "route"])

    placed = stage(short.select("id", "v").mapInArrow(assign, "id long, v binary, route int"), "placed")
    pages = placed.groupBy("route").agg(F.ceil(F.count("*") / page).alias("pages"))
    dealt = placed.join(pages, "route").withColumn("number", F.pmod(F.xxhash64("id"), "pages").cast("int"))

    def make(table_):
        x = _matrix(table_["v"].to_pylist(), width)
        points = _points(x, most)
        centre = int(_distances(points, points.mean(0)[None, :])[:, 0].argmin())
        apart = _distances(points, points[centre : centre + 1])[:, 0]
        route = table_["route"][0].as_py()
        up = _distances(points[centre : centre + 1], _points(known.value["routes"][route : route + 1], most))[0, 0]
        return pa.table({
            "route": pa.array([route], pa.int32()), "centre": pa.array([x[centre].astype("<f8").tobytes()]),
            "radius": [float(apart.max())], "up": [float(up)],
            "ids": pa.array([table_["id"].to_numpy().astype("<i8").tobytes()]),
            "vectors": pa.array([x.astype("<f8").tobytes()]), "apart": pa.array([apart.astype("<f8").tobytes()])})

    shape = "route int, centre binary, radius double, up double, ids binary, vectors binary, apart binary"
    return stage(dealt.groupBy("route", "number").applyInArrow(make, shape), "tree"), root, vectors


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(score) > 4 * k:
        few = np.flatnonzero(score >= np.partition(score, -k)[-k])
        return few[np.lexsort((ids[few], -score[few]))[:k]]
    return np.lexsort((ids, -score))[:k]


def _searcher(known, k: int):
    def search(batches):
        state = known.value
        root, q, own, floor = state["root"], state["queries"], state["ids"], state["floor"].copy()
        most, width = root["most"], root["width"]
        points = np.hstack([q, np.zeros((len(q), 1))])
        squared = (points**2).sum(1)
        to_route = _distances(points, _points(root["routes"], most))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in own]
        for batch in batches:
            rows = batch.to_pylist()
            centres = _points(_matrix([r["centre"] for r in rows], width), most)
            radius, up, route = (np.array([r[c] for r in rows]) for c in ("radius", "up", "route"))
            # The distance of a query from a centre is at least this far from that to the routing object.
            bound = np.abs(to_route[:, route] - up[None, :]) - radius[None, :]
            for at in np.argsort(bound.min(0), kind="stable"):
                reach = np.sqrt(np.maximum(0.0, squared + most - 2.0 * floor)) * (1 + _SLACK) + _SLACK
                some = np.flatnonzero(bound[:, at] <= reach)
                if not len(some):
                    continue
                away = _distances(points[some], centres[at : at + 1])[:, 0]
                near = away - radius[at] <= reach[some]
                some, away = some[near], away[near]
                if not len(some):
                    continue
                apart = np.frombuffer(rows[at]["apart"], "<f8")
                member = (np.abs(away[:, None] - apart[None, :]) <= reach[some][:, None]).any(0)
                ids = np.frombuffer(rows[at]["ids"], "<i8")[member]
                x = np.frombuffer(rows[at]["vectors"], "<f8").reshape(-1, width)[member]
                scores = _dots(q[some], x)
                for row, said in zip(some, scores, strict=True):
                    good = (said >= floor[row]) & (ids != own[row])
                    if good.any():
                        s = np.concatenate([found[row][0], said[good]])
                        i = np.concatenate([found[row][1], ids[good]])
                        take = _best(s, i, k)
                        found[row] = (s[take], i[take])
                        if len(take) == k:
                            floor[row] = max(floor[row], s[take[-1]])
        size = np.array([len(s) for s, _ in found], np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(own, size)), pa.array(np.concatenate([i for _, i in found] or [[]]).astype(np.int64)),
             pa.array(np.concatenate([s for s, _ in found] or [[]]).astype(np.int64))],
            names=["query_id", "vec_id", "score"])

    return search


def _blocks(queries: DataFrame, block: int, width: int):
    """(ids, vectors) of the queries, about ``block`` at a time."""
    blocks = max(1, -(-queries.count() // block))
    for number in range(blocks):
        rows = queries.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).toArrow()
        yield rows["id"].to_numpy(), _matrix(rows["v"].to_pylist(), width)


def _compared(vectors: DataFrame, queries: DataFrame, k: int, block: int, width: int) -> list[DataFrame]:
    """The ``k`` best of each batch of vectors for every query, compared one by one."""
    results = []
    for ids, q in _blocks(queries, block, width):
        known = vectors.sparkSession.sparkContext.broadcast((ids, q))

        def run(batches, known=known):
            own, q = known.value
            for batch in batches:
                there = batch.column("id").to_numpy()
                for at, said in zip(own, _long_dots(q, _matrix(batch.column("v").to_pylist(), width)), strict=True):
                    other = np.flatnonzero(there != at)
                    best = other[_best(said[other], there[other], k)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(best), at)), pa.array(there[best]), pa.array(said[best])],
                        names=["query_id", "vec_id", "score"])

        found = vectors.select("id", "v").mapInArrow(run, "query_id long, vec_id long, score long")
        results.append(stage(found, "found"))
    return results


def top_k(tree: tuple[DataFrame, dict, DataFrame], queries: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of highest inner product with each query, but for its own id.

    Queries (id, v, length) are taken in blocks of about ``block``, each broadcast to the pages of the tree. Every block
    starts from the scores of the routing vectors, which are rows themselves. All scores of a tie at the end count by id.
    """
    pages, root, vectors = tree
    spark = queries.sparkSession
    queries = stage(queries.select("id", "v", "length"), "queries")
    short = queries.filter(F.col("length") < LONG)
    parts = pages.repartition(max(1, min(4096, -(-root["rows"] // (16 * PAGE)))))
    results = []
    for ids, q in _blocks(short, block, root["width"]):
        floor = np.full(len(ids), -(2**62), np.int64)
        if len(ids) and len(root["ids"]) > k:
            scores = _dots(q, root["routes"])
            scores[ids[:, None] == root["ids"][None, :]] = -(2**62)
            floor = np.sort(scores, axis=1)[:, -k]
        known = spark.sparkContext.broadcast({"root": root, "queries": q, "ids": ids, "floor": floor})
        results.append(stage(parts.mapInArrow(_searcher(known, k), "query_id long, vec_id long, score long"), "found"))
    far = vectors.filter(F.col("length") >= LONG)
    if not far.isEmpty():
        results += _compared(far, short, k, block, root["width"])
        results += _compared(vectors, queries.filter(F.col("length") >= LONG), k, block, root["width"])
    full = results[0]
    for more in results[1:]:
        full = full.union(more)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return full.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = stage(whole_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "vectors")
    return top_k(build(vectors), vectors.filter("id % 100 = 0"))


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
        FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0))
WHERE rank <= 10
"""
