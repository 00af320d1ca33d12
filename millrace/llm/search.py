"""Ranked lexical search with the Best Position Algorithm.

Every shard of documents (the rows that one task has read) keeps an impact list for each term: its documents by falling
impact. For a query, the lists of its terms are read side by side from the top. A document met in one list is looked up
directly in all others, and every place seen that way is marked. The best position of a list is the last place before
the first one not seen; a document not met yet lies behind the best position of each list, so its score is at most the
sum of the impacts there. Direct accesses push best positions beyond the places read, which is why this bound falls
earlier than that of the last places read. A shard stops when the bound is strictly below its k-th score: a tie might
still be won by a smaller id. The results of all shards are merged.

Before that, a probe of the first ``PROBE`` places of all lists gives every query k real scores over all shards; their
k-th is a bound that no result can lie below, and shards stop at it as well.

Queries are worked on in blocks of a bounded number of terms, so that what a task keeps of them does not grow with
their number. Terms are compared as 64-bit hashes.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import words as W
from millrace.llm.shared import documents, small_batches, table
from millrace.session import stage

TOP = 20
BLOCK_TERMS = 1 << 18  # terms of the queries of a block, counted for each query, on average
SHARD_POSTINGS = 1 << 21
SHARD_DOCS = 1 << 18
PROBE = 16
PARTIAL = 256
# The weights of the score.
LENGTH_PERCENT = 25
SATURATION = 12
_DOC_BITS, _IMPACT_BITS = 18, 20
_NO_DOC = np.iinfo(np.int64).max


class Vocabulary:
    """Numbers of known 64-bit codes: a table of four places for each of them, probed in order."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.bits = max(4, int(4 * max(1, len(codes)) - 1).bit_length())
        self.table = np.full(1 << self.bits, -1, np.int32)
        left, step = np.arange(len(codes)), 0
        while len(left):
            place = self._place(codes[left], step)
            free = self.table[place] < 0
            self.table[place[free]] = left[free]
            left = left[self.table[place] != left]
            step += 1
        self.steps = step

    def _place(self, codes: np.ndarray, step: int) -> np.ndarray:
        return ((codes >> np.uint64(64 - self.bits)).astype(np.int64) + step) & ((1 << self.bits) - 1)

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        """The number of each code, -1 where it is not known."""
        out = np.full(len(codes), -1, np.int32)
        if len(self.codes) == 0:
            return out
        open_ = np.arange(len(codes))
        for step in range(self.steps):
            found = self.table[self._place(codes[open_], step)]
            same = (found >= 0) & (self.codes[found] == codes[open_])
            out[open_[same]] = found[same]
            open_ = open_[(found >= 0) & ~same]
            if not len(open_):
                break
        return out


def _counted(words: W.Words, number: np.ndarray):
    """(row, number, occurrences) of the known words, by row and number."""
    known = np.flatnonzero(number >= 0)
    keys = np.sort((words.row[known] << 32) | number[known])
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(keys)))
    return keys[first] >> 32, keys[first] & 0xFFFFFFFF, times


def query_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """(item, code, times): the distinct terms of every query; rows of one key are one query, without a key also."""

    def run(batches):
        for whole in batches:
            for batch in W.slices(whole, "text"):
                words = W.find_words(batch.column("text"), W.ALNUM)
                codes, number = np.unique(words.code, return_inverse=True)
                row, number, times = _counted(words, number)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item").take(pa.array(row)), pa.array(W.signed(codes[number])), pa.array(times)],
                    names=["item", "code", "times"],
                )

    rows = queries.select(F.col(key).alias("item"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["item"].dataType.simpleString()
    found = rows.mapInArrow(run, f"item {kind}, code long, times long")
    return found.groupBy("item", "code").agg(F.sum("times").alias("times"))


def _binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = (np.concatenate([[0], ends]) * 4).astype(np.int32)
    data = np.ascontiguousarray(values.astype("<u4"))
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def forward(docs: DataFrame, vocabulary: Vocabulary, key: str, text: str) -> DataFrame:
    """(doc_id, n, terms, times) of every document with at least one word: its length and the known terms in it."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        for whole in batches:
            for batch in W.slices(whole, "text"):
                words = W.find_words(batch.column("text"), W.ALNUM)
                row, number, times = _counted(words, known.value.numbers(words.code))
                ends = np.searchsorted(row, np.arange(batch.num_rows), side="right")
                size = np.diff(words.first)
                found = pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(size), _binaries(number, ends), _binaries(times, ends)],
                    names=["doc_id", "n", "terms", "times"],
                )
                yield found.filter(pa.array(size > 0))

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, terms binary, times binary")


def _unpacked(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(name).to_pylist()), "<u4").astype(np.int64)


def document_frequencies(index: DataFrame, terms: int) -> np.ndarray:
    """How many documents hold each of the ``terms`` known terms, counted before they are shuffled."""

    def run(batches):
        total = np.zeros(terms, np.int64)
        for batch in batches:
            total += np.bincount(_unpacked(batch, "terms"), minlength=terms)
        some = np.flatnonzero(total)
        for at in range(0, len(some), 1 << 16):
            part = some[at : at + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"term": pa.array(part), "df": pa.array(total[part])})

    found = index.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    rows = found.toArrow()
    out = np.zeros(terms, np.int64)
    out[rows["term"].to_numpy()] = rows["df"].to_numpy()
    return out


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


class Shard:
    """Impact lists of some documents; ``at[t] : at[t + 1]`` is the list of term t."""

    def __init__(self, doc_id: np.ndarray, norm: np.ndarray, doc: np.ndarray, term: np.ndarray, times: np.ndarray,
                 terms: int):
        self.doc_id = doc_id
        impact = (1_000_000_000 * times) // (1000 * times + SATURATION * norm[doc])
        low = _DOC_BITS + _IMPACT_BITS
        # A list is sorted by falling impact, equal impacts by document.
        key = (term << low) | (((1 << _IMPACT_BITS) - 1 - impact) << _DOC_BITS) | doc
        order = np.argsort(key)
        self.doc, self.impact = doc[order], impact[order]
        self.at = np.searchsorted(term[order], np.arange(terms + 1))
        by_document = np.argsort((term[order] << _DOC_BITS) | self.doc)
        self.direct = ((term[order] << _DOC_BITS) | self.doc)[by_document]
        self.place = by_document

    def lookup(self, terms: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Direct access: the place of every document in every list, and whether it is in it; one row for each list."""
        wanted = (terms[:, None] << _DOC_BITS) | docs
        found = np.minimum(np.searchsorted(self.direct, wanted), len(self.direct) - 1)
        return self.place[found], self.direct[found] == wanted

    def best(self, terms: np.ndarray, factor: np.ndarray, k: int, floor: int = 1, rounds: int | None = None):
        """(documents, scores) of the ``k`` highest scores of at least ``floor``, ties to smaller ids.

        Lists are read in rounds of growing depth; ``rounds`` ends the search early.
        """
        used = (self.at[terms + 1] > self.at[terms]) & (factor > 0)
        terms, factor = terms[used], factor[used]
        first, size = self.at[terms], self.at[terms + 1] - self.at[terms]
        offset = np.cumsum(size) - size
        marked = np.zeros(int(size.sum()), bool)
        met = np.zeros(len(self.doc_id), bool)
        position = np.zeros(len(terms), np.int64)
        docs, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        depth, step, done = 0, PROBE, 0
        while len(terms):
            heads = [self.doc[a + depth : a + min(depth + step, n)] for a, n in zip(first, size) if depth < n]
            fresh = np.unique(np.concatenate(heads)) if heads else np.zeros(0, np.int64)
            fresh = fresh[~met[fresh]]
            met[fresh] = True
            place, inside = self.lookup(terms, fresh)
            docs.append(fresh)
            scores.append((np.where(inside, self.impact[place], 0) * factor[:, None]).sum(0))
            marked[(place - first[:, None] + offset[:, None])[inside]] = True
            for t in np.flatnonzero(position < size):
                unseen = marked[offset[t] + position[t] : offset[t] + size[t]]
                gap = int(np.argmin(unseen))
                position[t] = size[t] if unseen[gap] else position[t] + gap
            # The place behind a whole list holds nothing; a list read in part has seen its first place.
            open_ = position < size
            bound = int((self.impact[first[open_] + position[open_] - 1] * factor[open_]).sum())
            depth, step, done = depth + step, step * 2, done + 1
            if not open_.any() or bound < floor or done == rounds:
                break
            every = np.concatenate(scores)
            if len(every) >= k and bound < np.partition(every, -k)[-k]:
                break
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        good = scores >= floor
        docs, scores = docs[good], scores[good]
        order = np.lexsort((self.doc_id[docs], -scores))[:k]
        return docs[order], scores[order]


@dataclass(frozen=True)
class Block:
    """Some queries: ``item[q]`` is the number of query q, ``at[q] : at[q + 1]`` its terms and their factors."""

    at: np.ndarray
    term: np.ndarray
    factor: np.ndarray
    floor: np.ndarray
    documents: int
    words: int
    terms: int


def _shards(batches: Iterator[pa.RecordBatch], block: Block) -> Iterator[tuple[Shard, pa.Array]]:
    def made():
        ids = pa.concat_arrays([b.column("doc_id") for b in kept])
        n = np.concatenate([b.column("n").to_numpy() for b in kept])
        norm = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * n * block.documents) // block.words
        sizes = np.concatenate([np.array([len(x) // 4 for x in b.column("terms").to_pylist()], np.int64) for b in kept])
        term, times = (np.concatenate([_unpacked(b, c) for b in kept]) for c in ("terms", "times"))
        order = ids.fill_null(_NO_DOC).to_numpy()
        return Shard(order, norm, np.repeat(np.arange(len(n)), sizes), term, times, block.terms), ids

    kept, postings, rows = [], 0, 0
    for whole in batches:
        for at in range(0, whole.num_rows, 4096):
            batch = whole.slice(at, 4096)
            size = batch.column("terms").nbytes // 4
            if kept and (postings + size > SHARD_POSTINGS or rows + batch.num_rows > SHARD_DOCS):
                yield made()
                kept, postings, rows = [], 0, 0
            kept.append(batch)
            postings, rows = postings + size, rows + batch.num_rows
    if kept:
        yield made()


def _searched(index: DataFrame, block: Block, k: int, rounds: int | None = None) -> DataFrame:
    """(query, doc_id, score): the best documents of every shard."""
    sent = index.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        own = sent.value
        for shard, ids in _shards(batches, own):
            if len(shard.doc) == 0:
                continue
            query, docs, scores = [], [], []
            for q in range(len(own.at) - 1):
                part = slice(own.at[q], own.at[q + 1])
                found, score = shard.best(own.term[part], own.factor[part], k, int(own.floor[q]), rounds)
                query.append(np.full(len(found), q))
                docs.append(found)
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(query)), ids.take(pa.array(np.concatenate(docs))),
                 pa.array(np.concatenate(scores))],
                names=["query", "doc_id", "score"],
            )

    return index.mapInArrow(run, "query long, doc_id long, score long")


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each query; shards are merged in groups first, so that no task gets all of a query."""
    order: list[Column] = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    grouped = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTIAL)))
    for keys in ([*by, "part"], by):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        grouped = grouped.withColumn("rank", place).filter(F.col("rank") <= k)
    return grouped.drop("part")


def _blocks(terms: DataFrame) -> Iterator[DataFrame]:
    count = terms.count()
    blocks = -(-count // BLOCK_TERMS)
    for b in range(blocks):
        yield terms if blocks == 1 else terms.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)


def search(
    docs: DataFrame, queries: DataFrame, k: int = TOP, key: str = "doc_id", text: str = "text",
    query_key: str = "item_id", query_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): for every query the ``k`` documents of the highest scores above 0, ties to the
    smaller id, fewer if there are no more.

    Null and empty texts have no terms: such documents are not counted and such queries have no results. Query rows of
    one key are one query, rows without a key too. Repeated document rows are documents of their own and come out each;
    those without an id come behind equal scores. Other columns are not read. A text is taken as a whole.
    """
    spark = docs.sparkSession
    small_batches(spark)
    terms = stage(query_terms(queries, query_key, query_text), "query-terms")
    out = None
    for part in _blocks(terms):
        rows = part.toArrow().sort_by([("item", "ascending"), ("code", "ascending")])
        items = rows["item"].combine_chunks().dictionary_encode(null_encoding="encode")
        number = items.indices.to_numpy().astype(np.int64)
        codes, term = np.unique(rows["code"].to_numpy().view(np.uint64), return_inverse=True)
        index = stage(forward(docs, Vocabulary(codes), key, text), "forward")
        size = index.agg(F.count("*"), F.sum("n")).first()
        if not size[0]:
            continue
        factor = weights(document_frequencies(index, len(codes)), size[0])[term] * rows["times"].to_numpy()
        order = np.argsort(number, kind="stable")
        at = np.searchsorted(number[order], np.arange(len(items.dictionary) + 1))
        block = Block(at, term[order].astype(np.int64), factor[order], np.ones(len(at) - 1, np.int64), size[0], size[1],
                      len(codes))
        probed = _ranked(_searched(index, block, k, rounds=1), ["query"], k).filter(F.col("rank") == k).toArrow()
        block.floor[probed["query"].to_numpy()] = np.maximum(probed["score"].to_numpy(), 1)
        found = stage(_ranked(_searched(index, block, k), ["query"], k), "found")
        names = pa.table({"query": pa.array(np.arange(len(items.dictionary))), query_key: items.dictionary})
        names = spark.createDataFrame(names)
        ranked = found.join(names, "query").select(query_key, "rank", "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        kind = queries.select(query_key).schema[0].dataType.simpleString()
        out = spark.createDataFrame([], f"`{query_key}` {kind}, rank int, doc_id long, score long")
    return out


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


_TERMS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
OP13_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS ws FROM documents),
size AS (SELECT count(*) FILTER (len(ws) > 0) AS docs, CAST(sum(len(ws)) AS BIGINT) AS words FROM d),
tf AS (
  SELECT r, doc_id, n, w, count(*) AS tf FROM (SELECT r, doc_id, len(ws) AS n, unnest(ws) AS w FROM d) GROUP BY ALL),
df AS (SELECT w, count(*) AS df FROM tf GROUP BY w),
q AS (SELECT item_id, w, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS w FROM benchmark) GROUP BY ALL),
scores AS (
  SELECT item_id, r, doc_id, CAST(sum(
    times * CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
    * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // words)))) AS BIGINT) AS score
  FROM q JOIN tf USING (w) JOIN df USING (w), size GROUP BY item_id, r, doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
    doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
