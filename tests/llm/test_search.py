import math
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import search as S
from tests.llm import cases

SF = "/root/testdata/sf0.001"


def brute(docs, items, k=20):
    bags = [(i, Counter(cases.alnum(t))) for i, t in docs]
    bags = [(i, b, b.total()) for i, b in bags if b]
    count, words = len(bags), sum(n for *_, n in bags)
    df = Counter(w for _, b, _ in bags for w in b)
    queries = {}
    for item, text in items:
        queries.setdefault(item, Counter()).update(cases.alnum(text))
    out = []
    for item, terms in queries.items():
        scored = []
        for i, b, n in bags:
            m = 75 + (25 * n * count) // words
            score = sum(
                times * math.floor(1000 * math.log((2 * count + 2) / (2 * df[w] + 1)))
                * ((1_000_000_000 * b[w]) // (1000 * b[w] + 12 * m)) for w, times in terms.items() if b[w])
            if score > 0:
                scored.append((-score, math.inf if i is None else i, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scored, key=lambda x: x[:2])[:k], 1)]
    return sorted(out, key=repr)


def collected(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def odd():
    docs = cases.texts() + [(30 + i, cases.sentence(i % 7, 30 + i % 5)) for i in range(60)]
    items = [("a", cases.sentence(1, 20)), ("b", "one ONE three"), ("c", None), ("d", ""), ("e", "nowhere"),
             ("f", "é alpha1 alpha1 beta2"), ("f", "gamma3"), (None, "one"), ("g", cases.sentence(2, 400))]
    return docs, items


def tables(spark):
    docs, items = odd()
    full = cases.documents(spark, docs).withColumnRenamed("code", "score").withColumn("rank", F.lit(1))
    return full, spark.createDataFrame(items, "item_id string, text string").withColumn("doc_id", F.lit(1))


def test_query_equals_brute_force_and_sql(spark):
    docs, items = (
        [tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(i, "text").collect()]
        for t, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    found = collected(S.op13_lexical_search(spark, SF))
    assert found == brute(docs, items)
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    assert found == sorted(db.execute(S.OP13_SQL).fetchall(), key=repr)


@pytest.mark.parametrize("k", [1, 3, 20, 1000])
def test_odd_rows(spark, k):
    assert collected(S.search(*tables(spark), k)) == brute(*odd(), k)


def test_many_small_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_TERMS", 60)
    monkeypatch.setattr(S, "SHARD_DOCS", 5)
    docs, items = tables(spark)
    assert collected(S.search(docs.repartition(3), items, 5)) == brute(*odd(), 5)


@pytest.mark.parametrize("empty", ["documents", "queries"])
def test_empty_tables(spark, empty):
    docs, items = tables(spark)
    docs, items = (docs.limit(0), items) if empty == "documents" else (docs, items.limit(0))
    found = S.search(docs, items)
    assert found.count() == 0 and found.columns == ["item_id", "rank", "doc_id", "score"]


def test_vocabulary():
    rng = np.random.default_rng(1)
    codes = np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64))
    codes[:200] = np.arange(200)  # one crowded place
    codes = np.unique(codes)
    known = S.Vocabulary(codes)
    assert (known.numbers(codes) == np.arange(len(codes))).all()
    assert (known.numbers(codes ^ np.uint64(1 << 63)) == -1).all()
    assert (S.Vocabulary(codes[:0]).numbers(codes) == -1).all()


def lists(seed, docs=3000, terms=6):
    rng = np.random.default_rng(seed)
    held = rng.random((docs, terms)) < rng.uniform(0.05, 0.9, terms)
    doc, term = np.nonzero(held)
    times = rng.integers(1, 4, len(doc))
    return S.Shard(np.arange(docs) * 3, np.full(docs, 100), doc, term, times, terms), doc, term, times


@pytest.mark.parametrize("seed", range(5))
def test_best_positions_give_exact_results(seed):
    shard, doc, term, times = lists(seed)
    factor = np.array([5, 1, 700, 30, 0, 12])
    score = np.zeros(3000, np.int64)
    np.add.at(score, doc, factor[term] * ((1_000_000_000 * times) // (1000 * times + 1200)))
    wanted = np.lexsort((np.arange(3000), -score))[:20]
    found, scores = shard.best(np.arange(6), factor, 20)
    assert found.tolist() == wanted.tolist() and scores.tolist() == score[wanted].tolist()
    found, scores = shard.best(np.arange(6), factor, 20, floor=int(score[wanted[4]]))
    kept = [d for d in wanted.tolist() if score[d] >= score[wanted[4]]]
    assert found.tolist() == kept


def test_search_stops_early(monkeypatch):
    rng = np.random.default_rng(0)
    docs = 20_000
    times = rng.integers(1, 1000, (docs, 3))
    doc, term = (x.ravel() for x in np.indices((docs, 3)))
    shard = S.Shard(np.arange(docs), np.full(docs, 4000), doc, term, times.ravel(), 3)
    looked = []
    lookup = shard.lookup
    monkeypatch.setattr(shard, "lookup", lambda t, d: looked.append(len(d)) or lookup(t, d))
    shard.best(np.arange(3), np.array([3, 2, 1]), 20)
    assert sum(looked) < docs / 2
