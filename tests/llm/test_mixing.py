import numpy as np
import pyarrow as pa
import pytest
from cases import documents, sentence, texts

from millrace.llm import mixing

LABELLED = "doc_id long, domain string"


def corpus():
    a = [(k, " ".join(f"red{j % 9}" for j in range(k, k + 40))) for k in range(120)]
    b = [(500 + k, " ".join(f"blue{j % 9}" for j in range(k, k + 20))) for k in range(60)]
    return a + b + [(900, "red1 blue1 " * 10), (901, None), (902, ""), (902, ""), (None, "red1 red2")]


def model(spark):
    labelled = spark.createDataFrame([(k, "red") for k in range(0, 120, 2)] + [(500 + k, "blue") for k in range(0, 60, 2)], LABELLED)
    return mixing.classifier(documents(spark, corpus()), labelled, ["domain"])


def test_expected_tokens_meet_targets(spark):
    docs, found = documents(spark, corpus()), model(spark)
    assert found["domains"] == ["blue", "red"]
    mixture = mixing.solve(docs, found, {"blue": 0.5, "red": 0.5})
    for row in mixture.report:
        assert abs(row["expected"] - row["target"]) < 0.05 * row["target"]
    got = mixing.mix(docs, mixture)
    assert got.columns == ["doc_id", "text", "lang", "n_words", "code", "n_tokens", "domain", "rate", "copies"]
    rows = got.collect()
    assert len(rows) == len(corpus()) and all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in rows)
    assert {r.domain for r in rows if r.doc_id is not None and r.doc_id < 120} == {"red"}


def test_rates_are_the_least_squares_solution(spark):
    """Against plain projected gradient on all rates at once, run to its end."""
    docs, found = documents(spark, corpus()), model(spark)
    mixture = mixing.solve(docs, found, {"blue": 0.7, "red": 0.3}, budget=5000.0, rounds=60)
    said = pa.array([t for _, t in corpus()], pa.string())
    size, p = mixing.posteriors(found, said)
    total = size.sum()
    share = (size @ p) / total
    aim = np.array([0.7, 0.3]) * 5000 / total
    rate = np.ones(len(size))
    for _ in range(20_000):
        error = ((size * rate) @ p / total - aim) / share
        rate = np.maximum(0, rate - 0.2 * (p @ error + mixing.RIDGE * (rate - 1)))
    assert np.abs(mixture.rates(said)[1] - rate).max() < 1e-3


def test_unwanted_domain_is_thinned(spark):
    docs, found = documents(spark, corpus()), model(spark)
    mixture = mixing.solve(docs, found, {"red": 1.0}, rounds=20)
    rows = [r for r in mixing.mix(docs, mixture).collect() if r.doc_id is not None]
    assert min(r.rate for r in rows if r.doc_id < 120) > 0.9
    assert max(r.rate for r in rows if 500 <= r.doc_id < 560) < 0.5
    kept = mixing.apply_copies(docs, mixture)
    assert kept.columns == docs.columns and kept.count() == sum(r.copies for r in mixing.mix(docs, mixture).collect())


def test_unknown_targets_and_empty_tables(spark):
    docs, found = documents(spark, corpus()), model(spark)
    with pytest.raises(ValueError):
        mixing.solve(docs, found, {"green": 1.0})
    none = documents(spark, [])
    empty = mixing.classifier(none, spark.createDataFrame([], LABELLED), ["domain"])
    assert mixing.mix(none, mixing.solve(none, empty, {}, rounds=2)).count() == 0
    rows = mixing.mix(documents(spark), mixing.solve(documents(spark), empty, {}, rounds=2)).collect()
    assert len(rows) == len(texts())


def test_sample_bound(spark):
    labelled = spark.createDataFrame([(k, "red") for k in range(120)], LABELLED)
    assert mixing.sample(documents(spark, corpus()), labelled, "doc_id", "text", 10).count() == 10


def test_classifier_separates_held_out_rows():
    cells = np.concatenate([np.arange(k % 2 * 50, k % 2 * 50 + 20) for k in range(100)])
    first = np.arange(101) * 20
    weight = mixing._fit(cells, first, np.arange(100) % 2, 2)
    assert (mixing._logits(weight, cells, first).argmax(1) == np.arange(100) % 2).all()
    assert sentence(1, 3) != sentence(2, 3)
