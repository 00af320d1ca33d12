import collections
import math
import re

import pytest
from cases import WORDS, documents, texts
from pyspark.sql import functions as F

from millrace.llm import quality

LABELS = "doc_id long, quality int, toxic int"


def prose(seed, n=80):
    """Words that follow each other as in a language: the next is one of two that depend on the last."""
    out, x, at = [], seed * 7919 + 1, seed % 24
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        at = (at * 5 + 1 + ((x >> 9) % 2) * 7) % 24
        out.append(WORDS[at])
    return " ".join(out)


def corpus():
    good = [(i, prose(i)) for i in range(300)]
    bad = [(1000 + i, " ".join(w.upper() + "!!" for w in prose(i).split())) for i in range(20)]
    runs = [(2000 + i, " ".join([WORDS[i]] * 80)) for i in range(10)]
    return good + bad + runs


def test_junk_goes_and_prose_stays(spark):
    docs = documents(spark, corpus())
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 300, 2)] + [(1000, 0, 0)], LABELS)
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    assert [i for i in range(300) if not got[i].keep] == []
    assert not any(got[i].keep for i in [*range(1000, 1020), *range(2000, 2010)])
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 300


def plain_model(texts, order):
    """A function from a text to its negative logarithm of probability, by the recursive definition."""
    marked = [plain_marks(t, order) for t in texts if spaced_cased(t)]
    counts = {order: collections.Counter(
        tuple(w[i : i + order]) for w in marked for i in range(len(w) - order + 1) if w[i + order - 1] != "<run>")}
    raw = counts[order]
    for m in range(order - 1, 0, -1):
        before, raw_m = collections.defaultdict(set), collections.Counter()
        for gram in counts[m + 1]:
            before[gram[1:]].add(gram[0])
        for gram, c in raw.items():
            raw_m[gram[1:]] += c
        counts[m] = {g: raw_m[g] if g[0] == "<s>" else len(v) for g, v in before.items()}
        raw = raw_m
    cuts = {}
    for m, found in counts.items():
        n1, n2, n3, n4 = (max(1, sum(c == k for c in found.values())) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        cuts[m] = [0] + [min(max(d, 0.05), k - 0.05) for k, d in (
            (1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3))]
    follow = {m: collections.defaultdict(list) for m in counts}
    for m, found in counts.items():
        for gram, c in found.items():
            follow[m][gram[:-1]].append(c)

    def p(gram):
        m = len(gram)
        if m == 0:
            return 1 / (len(counts[1]) + 1)
        after = follow[m].get(gram[:-1])
        if not after:
            return p(gram[1:])
        cut = cuts[m]
        c = counts[m].get(gram, 0)
        freed = sum(cut[min(k, 3)] for k in after)
        return (c - cut[min(c, 3)] + freed * p(gram[1:])) / sum(after)

    def surprise(text):
        w = plain_marks(text, order)
        return -sum(math.log(p(tuple(w[i - order + 1 : i + 1]))) for i in range(order - 1, len(w)))

    return surprise


def plain_marks(text, order):
    """Start marks, the words, of which a third one in a row is a mark, and an end mark."""
    w = spaced_cased(text)
    return ["<s>"] * (order - 1) + [
        "<run>" if i > 1 and w[i - 2] == w[i - 1] == x else x for i, x in enumerate(w)] + ["</s>"]


def spaced_cased(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


@pytest.mark.parametrize(("order", "hot"), [(1, 4), (2, 4), (2, 1 << 18), (3, 4), (4, 40)])
def test_surprise_equals_brute_force(spark, monkeypatch, order, hot):
    monkeypatch.setattr(quality, "HOT", hot)
    rows = corpus()[:40] + [(3000 + k, " ".join(WORDS[k : k + 3])) for k in range(20)] + texts()
    rows += [(3100 + k, " ".join([WORDS[k]] * 5 + [WORDS[k + 1]] * 2 + ["other"])) for k in range(6)]
    train = [t for i, t in rows if i is not None and i % 2 == 0]
    model = quality.train(spark.createDataFrame([(t,) for t in dict.fromkeys(train)], "text string"), order)
    docs = quality._identified(documents(spark, rows), "doc_id", "text")
    ids = docs.select("doc_id", "text", "_id", "_h").distinct()
    got = {(r.doc_id, r.text): r for r in ids.join(quality.score(docs, model, order), ["_id", "_h"]).collect()}
    want = plain_model(dict.fromkeys(t for t in train if t), order)
    for i, t in rows:
        assert got[i, t].n_words == len(spaced_cased(t))
        if got[i, t].n_words:
            assert math.isclose(got[i, t].surprise, want(t), rel_tol=1e-5), (i, t[:40])
        else:
            assert got[i, t].surprise == 0


def test_copies_teach_once_and_stay_on_one_side(spark):
    rows = corpus()[:50] + [(5000 + k, corpus()[3][1]) for k in range(200)]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in rows], LABELS)
    known = quality.trusted(labels)
    found = [r.text for r in quality._training(documents(spark, rows), known, "doc_id", "text").collect()]
    assert len(found) == len(set(found)) <= 50
    held = documents(spark, rows).select("text", quality._held(F.col("text")).alias("held")).distinct().collect()
    assert {r.text for r in held if not r.held} == set(found)


def test_columns_of_clashing_names_come_back(spark):
    docs = documents(spark, corpus()).withColumn("_id", F.lit("x")).withColumn("surprise", F.lit(1))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 300, 2)], LABELS)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.filter("_id = 'x' and surprise = 1").count() == 300


def test_awkward_rows_and_no_labels(spark):
    docs = documents(spark)
    got = quality.classify(docs, spark.createDataFrame([], LABELS)).collect()
    assert len(got) == len(texts())
    assert {r.doc_id for r in got if not r.keep} == {4, 5, 6, 17}
    assert all(r.perplexity is None for r in got if r.n_words == 0)
    assert quality.classify(documents(spark, []), spark.createDataFrame([], LABELS)).count() == 0


def test_contradicting_labels_are_not_trusted(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 0), (2, 1, 0), (3, 1, 1), (None, 1, 0), (4, None, 0)], LABELS)
    assert [r.doc_id for r in quality.trusted(labels).collect()] == [2]


def test_quartiles(spark):
    rows = [("en", 1, float(k)) for k in range(1, 41)]
    scored = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, language string, n_words long, surprise double").withColumn("held", F.lit(True))
    known = scored.select("doc_id")
    got = {r.language: r for r in quality.thresholds(scored, known).collect()}
    assert set(got) == {"en", "*"} and got["en"].mean == 20.5
    value = sorted((s + quality.PRIOR * 20.5) / (1 + quality.PRIOR) for _, _, s in rows)
    q1, q3 = value[9], value[29]
    assert abs(got["en"].most - (q3 + quality.FENCE * (q3 - q1))) < 0.01


def test_parts_hold_every_gram_once(spark):
    texts = spark.createDataFrame([(t,) for _, t in corpus()[:40]], "text string")
    whole = sorted(map(tuple, quality.count_grams(texts).collect()))
    parts = [list(map(tuple, quality.count_grams(texts, part=part, parts=3).collect())) for part in range(3)]
    assert sorted(sum(parts, [])) == whole and max(map(len, parts)) < len(whole) / 2


def test_the_model_is_not_shuffled_again(spark):
    texts = spark.createDataFrame([(t,) for _, t in corpus()[:40]], "text string")
    weights = quality.train(texts)[0]
    assert [r.name for r in spark.catalog.listTables() if r.name.startswith("millrace_")] == []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = spark.range(1000).select((F.col("id") * 7).alias("key"))
        plan = asked.join(weights.hint("shuffle_hash"), "key", "left")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan


def test_texts_that_stay_are_not_shuffled(spark):
    docs = documents(spark, corpus())
    kept = quality.keep_good(docs, spark.createDataFrame([(i, 1, 0) for i in range(0, 300, 2)], LABELS))
    plan = kept._jdf.queryExecution().optimizedPlan().toString().splitlines()
    union = next(k for k, line in enumerate(plan) if "Union" in line)
    sure = plan[union + 1 : next(k for k, line in enumerate(plan) if "Join LeftAnti" in line)]
    assert any("MapInArrow" in line for line in sure) and not any("Join" in line for line in sure)
    assert kept.count() == 300


def test_parts_give_the_same_model_and_scores(spark, monkeypatch):
    docs = quality._identified(documents(spark, corpus()[:40] + texts()), "doc_id", "text")
    train = spark.createDataFrame([(t,) for _, t in corpus()[:20]], "text string")

    def found():
        model = quality.train(train)
        return sorted(map(tuple, model[0].collect())), model[1:], sorted(map(tuple, quality.score(docs, model).collect()))

    whole = found()
    monkeypatch.setattr(quality, "SLICE", 1 << 10)
    monkeypatch.setattr(quality, "SLICES", 3)
    assert quality._slices(train, "text") == 3 and found() == whole
