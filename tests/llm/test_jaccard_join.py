import itertools
import pathlib

import pytest
from cases import documents, sentence, shingles, texts

from millrace.llm import jaccard_join
from millrace.session import scratch_root


def plain(rows, n, percent):
    sets = [(i, shingles(t, n)) for i, t in rows]
    group = list(range(len(sets)))
    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if x and y and 100 * len(x & y) >= percent * len(x | y) and group[a] != group[b]:
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    out = []
    for k, (i, s) in enumerate(sets):
        ids = [j for m, (j, _) in enumerate(sets) if group[m] == group[k] and j is not None]
        out.append((i, len(s), min(ids) if s and ids else i))
    return sorted(out, key=str)


def family():
    """Near copies of one text: pairs with one change link, pairs with two mostly do not."""
    base = sentence(20, 150).split()
    rows = []
    for k in range(40):
        words = list(base)
        for at in ((k * 13) % 150, (k * 29 + 70) % 150)[: 1 + k % 2]:
            words[at] = f"new{k}"
        rows.append((100 + k, " ".join(words)))
    return rows


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (2, 60)])
def test_clusters_equal_brute_force(spark, n, percent):
    rows = texts() + family()
    got = jaccard_join.cluster(documents(spark, rows), n, percent).collect()
    assert sorted([tuple(r) for r in got], key=str) == plain(rows, n, percent)


def test_every_link(spark):
    rows = family()
    _, _, links = jaccard_join.links(documents(spark, rows), every_link=True)
    sets = {i: shingles(t, 4) for i, t in rows}
    want = {(a, b) for a, b in itertools.combinations(sorted(sets), 2)
            if sets[a] != sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert {(r.x, r.y) for r in links.collect()} == want


def test_empty_table(spark):
    assert jaccard_join.cluster(documents(spark, [])).count() == 0


def test_keep_one_keeps_columns_and_one_of_each_group(spark):
    docs = documents(spark)
    kept = jaccard_join.keep_one(docs.select("text", "doc_id", "rate"))
    assert kept.columns == ["text", "doc_id", "rate"]
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([None, 1, 4, 5, 6, 7, 8, 10, 11, 12, 14, 15, 16, 17], key=str)


def test_whole_sets_go_once_their_pairs_are_compared(spark):
    staged = pathlib.Path(scratch_root(spark).removeprefix("file:")) / "staged" / spark.sparkContext.applicationId
    before = set(staged.iterdir()) if staged.exists() else set()
    _, _, links = jaccard_join.links(documents(spark, family()))
    left = {p.name.split("-")[0] for p in set(staged.iterdir()) - before}
    assert "verified" in left and not left & {"pairs", "ids", "sets"} and links.count() > 0
