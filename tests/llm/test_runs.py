import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import runs as R
from tests.llm import cases

SF = "/root/testdata/sf0.001"


def brute(x):
    """(start, length, period) by comparing all words p apart, for all p."""
    x, found = np.asarray(x), {}
    for p in range(1, len(x) // 3 + 1):
        same = np.concatenate([[False], x[p:] == x[:-p], [False]]).astype(np.int8)
        change = np.flatnonzero(np.diff(same))
        for a, b in zip(change[::2].tolist(), change[1::2].tolist()):
            if b - a + p >= max(24, 3 * p):
                found.setdefault((a, b - a + p), p)
    return sorted(((a, n, p) for (a, n), p in found.items()), key=lambda r: (r[0], r[2]))


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def planted(doc_id, words):
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = planted(doc_id, words_of(text))
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    runs = brute([number[w] for w in words])
    dropped = {i for a, n, p in runs for i in range(a + p, a + n)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    lines = "".join(f"{a},{n},{p}\n" for a, n, p in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = [hashlib.sha256(s.encode()).hexdigest() for s in (lines, kept)]
    return (doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, *sha)


def order(rows):
    return sorted(rows, key=repr)


def test_cover_has_every_difference():
    assert {(a - b) % R.CYCLE for a in R.COVER for b in R.COVER} == set(range(R.CYCLE))
    assert len(R.COVER) * (len(R.COVER) - 1) + 1 == R.CYCLE


def text(rng):
    kinds, n = rng.choice([1, 2, 3, 60]), rng.choice([0, 1, 23, 24, 25, 71, 72, 73, 74, 300, 900])
    x = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        if n > 30:
            a, p, size = rng.randrange(n), rng.choice([1, 2, 5, 8, 9, 40, 73, 146, 200]), rng.randrange(n)
            for i in range(a + p, min(n, a + size)):
                x[i] = x[i - p]
    return x


@pytest.mark.parametrize("seed", range(20))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [text(rng) for _ in range(rng.randrange(1, 8))]
    x = np.array([w for t in texts for w in t], np.int32)
    found = R.find_runs(x, np.array([len(t) for t in texts]))
    for t, words in enumerate(texts):
        assert [tuple(r[1:]) for r in found.tolist() if r[0] == t] == brute(words)


def test_runs_in_pieces_of_any_size(monkeypatch):
    monkeypatch.setattr(R, "_PAIRS", 7)
    rng = random.Random(5)
    x = [rng.randrange(2) for _ in range(200)] + [0, 1, 2] * 30
    assert [tuple(r[1:]) for r in R.find_runs(np.array(x, np.int32), np.array([290])).tolist()] == brute(x)


@pytest.mark.parametrize("ends", [[400], [150, 400]])
def test_extensions(ends):
    rng = random.Random(3)
    x = np.array([rng.randrange(2) for _ in range(80)] * 5, np.int32)
    right = R.Extensions(x, np.array(ends))
    for _ in range(500):
        start, end = rng.choice(list(zip([0, *ends], ends)))
        i, j = sorted(rng.sample(range(start, end), 2))
        n = 0
        while j + n < end and x[i + n] == x[j + n]:
            n += 1
        assert right(np.array([i]), np.array([j]), np.array([end]))[0] == n


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = [tuple(r) for r in R.op11_periodic_runs(spark, SF).collect()]
    assert order(found) == order(expected(*d) for d in docs)
    assert any(r[1] for r in found)


def test_odd_rows(spark, tmp_path):
    rows = cases.texts() + [(50, "x " * 40), (51, "a\x0bb\x0cc " * 9), (52, "é è ß " * 30), (None, "u v " * 20)]
    rows += [(100 + i, cases.sentence(i, 60)) for i in range(40)]
    cases.documents(spark, rows).withColumnRenamed("code", "runs").withColumn("start", F.lit(1)).write.parquet(
        f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in R.op11_periodic_runs(spark, str(tmp_path)).collect()]
    assert order(found) == order(expected(*r) for r in rows)


def test_empty_table(spark):
    found = R.periodic_runs(cases.documents(spark, []))
    assert found.count() == 0 and found.columns[-1] == "collapsed"


def test_real_outputs(spark):
    line = " ".join(f"w{i % 10}" for i in range(45))
    row = R.periodic_runs(spark.createDataFrame([(1, f"before {line} after")], "doc_id long, text string")).first()
    assert [tuple(r) for r in row.runs] == [(1, 45, 10)] and tuple(row.strongest) == (1, 45, 10)
    assert row.collapsed == "before w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 after"
