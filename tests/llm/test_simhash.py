import random

import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import simhash as S
from tests.llm import cases

SF = "/root/testdata/sf0.001"


def print_of(text, n=3):
    words = cases.spaced(text)
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    codes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(c >> b & 1 for c in codes) > len(codes))


def classes(prints, radius=2):
    """Smallest id in each component of (id, fingerprint) rows, by comparing all pairs."""
    kinds = sorted({p for _, p in prints})
    root = {p: p for p in kinds}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    first = {}
    for i, p in prints:
        if i is not None:
            first[find(p)] = min(i, first.get(find(p), i))
    return [first.get(find(p)) for _, p in prints]


def expected(rows):
    prints = [(i, print_of(t)) for i, t in rows]
    return sorted(((i, f"{p:016x}", c) for (i, p), c in zip(prints, classes(prints))), key=repr)


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = S.op12_simhash(spark, SF)
    assert found.columns[:3] == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(docs)


def test_odd_rows(spark, tmp_path):
    rows = cases.texts()
    cases.documents(spark, rows).withColumnRenamed("code", "fp").withColumn("component", F.lit(1)).write.parquet(
        f"{tmp_path}/documents.parquet")
    found = [tuple(r) for r in S.op12_simhash(spark, str(tmp_path)).collect()]
    assert sorted(found, key=repr) == expected(rows)


def test_only_rows_without_id(spark):
    rows = S.cluster(cases.documents(spark, [(None, "a b c d"), (None, "a b c d")])).collect()
    assert [r.component_id for r in rows] == [None, None]


def test_empty_table(spark):
    assert S.cluster(cases.documents(spark, [])).count() == 0


def test_long_text_in_pieces(monkeypatch):
    text = cases.sentence(9, 500).encode()
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "_PIECE", 7)
    assert S.fingerprint(text) == whole == (lambda p: p - (1 << 64) if p >> 63 else p)(print_of(text.decode()))


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_connect_what_all_pairs_connect(spark, radius):
    rng = random.Random(radius)
    prints = {rng.getrandbits(64) for _ in range(30)}
    for p in list(prints):
        for _ in range(6):
            for _ in range(rng.randrange(1, 4)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    pairs = S.links(spark.createDataFrame(signed, "fp long"), radius).collect()
    assert len({tuple(r) for r in pairs}) == len(pairs)
    mask = (1 << 64) - 1
    assert all(((r.x ^ r.y) & mask).bit_count() <= radius for r in pairs)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for r in pairs:
        root[find(r.x & mask)] = find(r.y & mask)
    groups, wanted = {}, {}
    for number, p in enumerate(sorted(prints)):
        groups.setdefault(find(p), []).append(number)
    for number, name in enumerate(classes(list(enumerate(sorted(prints))), radius)):
        wanted.setdefault(name, []).append(number)
    assert sorted(groups.values()) == sorted(wanted.values())
    # A family of near copies costs links in proportion to its size.
    assert len(pairs) <= len(prints) * 65 * (33 if radius == 3 else 1)
