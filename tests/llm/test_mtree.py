import math

import numpy as np

from millrace.llm import mtree


def rows():
    rng = np.random.default_rng(3)
    out = [(k, rng.normal(size=8).astype(np.float32).tolist()) for k in range(600)]
    out += [(1000 + k, out[5][1]) for k in range(40)]  # copies: ties go to the smaller id
    return out + [(2000, None), (2001, []), (2002, [None] * 8), (2003, [math.nan] * 8), (2004, [math.inf] * 8),
                  (None, [1.0] * 8), (2100, [0.5, -0.25]), (7, out[7][1])]


def score(a, b):
    return max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b, strict=True))))


def plain(data, k=10):
    good = {}
    for i, v in data:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            good[i] = [math.floor(1024 * x) for x in v] + [0] * (8 - len(v))
    out = []
    for q in good:
        if q % 100 == 0:
            best = sorted((-score(good[q], v), i) for i, v in good.items() if i != q)[:k]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out)


def search(spark, data, **how):
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, score long")
    vectors = mtree.stage(mtree.whole_vectors(frame, "vec_id", "embedding"), "vectors")
    found = mtree.top_k(mtree.build(vectors, **how), vectors.filter("id % 100 = 0"), block=4)
    return sorted(tuple(r) for r in found.collect())


def test_equals_brute_force(spark):
    data = [(*r, 1) for r in rows()]
    assert search(spark, data, routes=16, page=20) == plain(rows())


def test_few_and_no_rows(spark):
    data = [(0, [1.0, 2.0], 0), (1, [0.0, 1.0], 0)]
    assert search(spark, data) == [(0, 1, 1, 2048 * 1024)]
    assert search(spark, []) == []


def test_long_vectors_are_rows_and_queries(spark):
    """Components of 2 ** 21 and more, scores that need more than 53 and more than 64 bits, and scores below those."""
    data = [(1, [3e6, 0.0]), (2, [1.0, 1.0]), (3, [0.5, 0.5]), (100, [1.0, 2.0]), (200, [2.0**21 - 0.5] * 4),
            (4, [2.0**21 - 0.25] * 4), (5, [-1e20, 1.0]), (300, [1e300, -1e300, 1.0]), (6, [1e300]), (7, [-1e300]),
            (8, [1e306]), (9, [2.0**40 + 0.5, 2.0**-10])]
    want = plain([r for r in data if r[0] != 8])
    assert search(spark, [(*r, 1) for r in data]) == want
    both = rows() + [(5000 + i, v) for i, v in data[:7]]
    assert search(spark, [(*r, 1) for r in both], routes=16, page=20) == plain(both)
