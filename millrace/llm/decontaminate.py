"""Benchmark decontamination: hashed windows of normalised benchmark words, looked up in every document window.

The benchmark's windows are a hash set in shards of at most ``SHARD`` windows (a proven bound on what is broadcast);
each document passes the shards one after the other in the same task, so no text is shuffled. A hit counts only after
its words have been compared with the benchmark's words.
"""


import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from millrace.llm import words as W
from millrace.llm.shared import carried, documents, table
from millrace.session import stage

WINDOW = 10
SHARD = 1_000_000
DROP_SHARE = 0.5
OWN = ["n_words", "n_hit", "hit_items", "hit_mask"]


def windows(benchmark: DataFrame, n: int = WINDOW, key: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (code, size, phrase, item): the windows of ``n`` words of each item; a shorter item is one window.

    Items without words have none. ``phrase`` holds the normalised words, joined by a space.
    """

    def cut(batches):
        for whole in batches:
            for batch in W.slices(whole, text):
                found = W.find_words(batch.column(text), W.ALNUM)
                lower = W.LOWER[found.data].tobytes()
                out = ([], [], [], [])
                items = batch.column(key).to_pylist()
                for row in range(found.rows):
                    a, b = found.first[row], found.first[row + 1]
                    size = min(n, b - a)
                    for i in range(a, b - size + 1 if size else a):
                        phrase = b" ".join(lower[found.start[j] : found.end[j]] for j in range(i, i + size))
                        for column, value in zip(out, (size, phrase.decode(), items[row]), strict=False):
                            column.append(value)
                yield pa.RecordBatch.from_pydict({
                    "code": pa.array(W.signed(_codes(out[1])), pa.int64()), "size": pa.array(out[0], pa.int32()),
                    "phrase": pa.array(out[1], pa.string()), "item": pa.array(out[2], pa.string()),
                })

    items = benchmark.select(F.col(key).cast("string").alias(key), F.col(text).cast("string").alias(text))
    return items.mapInArrow(cut, "code long, size int, phrase string, item string").distinct()


def _codes(phrases: list[str]) -> np.ndarray:
    """The hash of each phrase, as ``grams`` has it for the same words in a document."""
    found = W.find_words(pa.array(phrases, pa.string()), W.ALNUM)
    sizes = np.diff(found.first)
    out = np.zeros(len(phrases), np.uint64)
    for size in np.unique(sizes):
        code, place = W.grams(found, int(size))
        at = np.searchsorted(place, found.first[:-1][sizes == size])
        out[sizes == size] = code[at]
    return out


def _shards(frame: DataFrame, most: int) -> list[DataFrame]:
    """The windows in hash shards of at most ``most`` rows; windows of one code stay together."""
    rows = frame.count()
    count = max(1, -(-2 * rows // most)) if rows > most else 1
    return [frame.filter(F.pmod("code", F.lit(count)) == k) for k in range(count)] if count > 1 else [frame]


def scan(
    docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, text: str = "text", item: str = "item_id",
    benchmark_text: str = "text", shard: int = SHARD,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside any occurring window), ``hit_items`` (item ids as sorted
    strings) and ``hit_mask`` (a bit for each word, packed; null without a hit).

    Every row is scanned by itself, so repeated rows give repeated results. Null and empty texts have no words; an
    empty benchmark hits nothing. A benchmark row without an id marks words but is not listed. Input columns named
    like the added ones are replaced.
    """
    spark = docs.sparkSession
    base = docs.drop(*OWN).withColumn(text, F.col(text).cast("string"))
    own = _parse_datatype_string("n_words long, n_hit long, hit_items array<string>, hit_mask binary")
    schema = StructType(base.schema.fields + own.fields)
    out = base
    found = stage(windows(benchmark, n, item, benchmark_text), "windows")
    for number, part in enumerate(_shards(found, shard)):
        known = spark.sparkContext.broadcast(_packed(part.toArrow()))
        out = out.mapInArrow(_marker(known, text, number > 0), schema)
    return out


def _packed(rows: pa.Table) -> tuple:
    """(sizes, {size: sorted codes}, {code: [(phrase, item ids)]})"""
    phrases: dict[int, dict[str, set]] = {}
    codes: dict[int, set] = {}
    for code, size, phrase, item in zip(*(rows.column(c).to_pylist() for c in ("code", "size", "phrase", "item")),
                                        strict=True):
        codes.setdefault(size, set()).add(code)
        phrases.setdefault(code, {}).setdefault(phrase, set()).add(item)
    return (
        {size: np.sort(np.array(sorted(c), np.int64).view(np.uint64)) for size, c in codes.items()},
        {code: [(p.encode(), sorted(i for i in items if i is not None)) for p, items in by.items()]
         for code, by in phrases.items()},
    )


def _marker(known, text: str, again: bool):
    """Marks hits of one shard; ``again``: the batch already has the marks of the shards before."""

    def mark(batches):
        codes, phrases = known.value
        for whole in batches:
            for batch in W.slices(whole, text):
                found = W.find_words(batch.column(text), W.ALNUM)
                hit = np.zeros(len(found.code), bool)
                items: dict[int, set] = {}
                if again:
                    for row, (mask, named) in enumerate(zip(batch.column("hit_mask").to_pylist(),
                                                            batch.column("hit_items").to_pylist(), strict=True)):
                        if mask is not None:
                            a, b = found.first[row], found.first[row + 1]
                            hit[a:b] = np.unpackbits(np.frombuffer(mask, np.uint8), count=b - a).astype(bool)
                            items[row] = set(named)
                lower = None
                for size, wanted in codes.items():
                    code, place = W.grams(found, size)
                    at = np.minimum(np.searchsorted(wanted, code), len(wanted) - 1)
                    for k in np.flatnonzero(wanted[at] == code) if len(wanted) else ():
                        i = place[k]
                        lower = W.LOWER[found.data].tobytes() if lower is None else lower
                        said = b" ".join(lower[found.start[j] : found.end[j]] for j in range(i, i + size))
                        for phrase, ids in phrases[int(code[k].view(np.int64))]:
                            if phrase == said:
                                hit[i : i + size] = True
                                items.setdefault(int(found.row[i]), set()).update(ids)
                total = np.concatenate([[0], np.cumsum(hit)])
                n_hit = total[found.first[1:]] - total[found.first[:-1]]
                masks = [
                    np.packbits(hit[found.first[r] : found.first[r + 1]]).tobytes() if n_hit[r] else None
                    for r in range(found.rows)
                ]
                own = [
                    pa.array(np.diff(found.first), pa.int64()), pa.array(n_hit, pa.int64()),
                    pa.array([sorted(items.get(r, ())) for r in range(found.rows)], pa.list_(pa.string())),
                    pa.array(masks, pa.binary()),
                ]
                names = batch.schema.names[: -len(OWN)] if again else batch.schema.names
                kept = [batch.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(kept + own, names=[*names, *OWN])

    return mark


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, drop_share: float = DROP_SHARE, text: str = "text",
) -> DataFrame:
    """``docs`` without benchmark passages: marked words go, with what stands between them; a document with at least
    ``drop_share`` of its words marked goes as a whole. Others stay as they are. ``n_chars``, if there, is counted
    again for texts that changed."""
    counted = "n_chars" in docs.columns
    rows, back = carried(docs, text, *(["n_chars"] if counted else []))
    found = scan(rows, benchmark, n, text)

    def cut(batches):
        for whole in batches:
            for batch in W.slices(whole, text):
                keep = pa.compute.or_(
                    pa.compute.equal(batch.column("n_hit"), 0),
                    pa.compute.less(pa.compute.cast(batch.column("n_hit"), pa.float64()),
                                    pa.compute.multiply(pa.compute.cast(batch.column("n_words"), pa.float64()),
                                                        drop_share)),
                )
                batch = batch.filter(keep)
                if batch.num_rows == 0:
                    continue
                masks = batch.column("hit_mask").to_pylist()
                at = batch.schema.names.index(text)
                columns = list(batch.columns)
                if any(m is not None for m in masks):
                    changed = batch.column(at).to_pylist()
                    for row, mask in enumerate(masks):
                        if mask is not None:
                            changed[row] = _without(changed[row], mask)
                    columns[at] = pa.array(changed, pa.string())
                    if counted:
                        chars = batch.schema.names.index("n_chars")
                        columns[chars] = pa.array(
                            [len(changed[r]) if m is not None else v
                             for r, (m, v) in enumerate(zip(masks, columns[chars].to_pylist(), strict=True))],
                            columns[chars].type,
                        )
                yield pa.RecordBatch.from_arrays(columns[: -len(OWN)], names=batch.schema.names[: -len(OWN)])

    return back(found.mapInArrow(cut, rows.withColumn(text, F.col(text).cast("string")).schema))


def _without(text: str, mask: bytes) -> str:
    found = W.find_words(pa.array([text]), W.ALNUM)
    hit = np.unpackbits(np.frombuffer(mask, np.uint8), count=len(found.code)).astype(np.int8)
    begin = np.flatnonzero(np.diff(hit, prepend=0) == 1)
    finish = np.flatnonzero(np.diff(hit, append=0) == -1)
    data, at, parts = found.data.tobytes(), 0, []
    for a, b in zip(begin, finish, strict=True):
        parts.append(data[at : found.start[a]])
        at = found.end[b]
    return b"".join([*parts, data[at:]]).decode()


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir).select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
items AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase
  FROM (SELECT item_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM (SELECT item_id, ws, least(10, len(ws)) AS k FROM b WHERE len(ws) > 0))),
hits AS (
  SELECT r, i, g.k, item_id
  FROM (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM items) AS sizes WHERE len(ws) >= k) AS g
  JOIN items ON items.k = g.k AND items.phrase = array_to_string(ws[i : i + g.k - 1], ' ')),
marked AS (
  SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(range(i, i + k)) AS at FROM hits) GROUP BY r),
named AS (
  SELECT r, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(marked.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(marked.n, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (r) LEFT JOIN named USING (r)
"""
