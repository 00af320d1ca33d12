"""Mixing to target weights with soft membership.

A classifier fitted on labelled documents gives every document a probability for each domain. Projected gradient least
squares then finds nonnegative rates for the documents, so that the expected tokens of each domain (rate x tokens x
probability, summed) come to their share of the total.

The classifier is fitted on at most ``SAMPLE`` labelled rows, those of the lowest hash of their id. Everything else
covers all documents. A rate follows from a document's probabilities and the errors of the domains in each round, so
rounds keep no state but these few errors, and only sums by domain leave a task.
"""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from millrace.llm import words as W
from millrace.llm.shared import bitmap, carried, documents, in_bitmap, table
from millrace.session import stage, staging_scope

SAMPLE = 12_000
CELLS = 1 << 16
RARE = 10
DECAY = 1e-3
ROUNDS = 40
RIDGE = 0.05
MOST_DOMAINS = 256
_AT_ONCE = 1024  # documents or cells of the fit that are in work at a time

# The query's domains and targets: each language's share of good text, and none of the rest.
TARGETS = {"en/good": 0.55, "de/good": 0.15, "fr/good": 0.15, "es/good": 0.15}


def _cells(found: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """(cells, rows): the distinct hash cells of the words of each row."""
    key = np.unique((found.row * CELLS) + (found.code & np.uint64(CELLS - 1)).astype(np.int64))
    return key % CELLS, key // CELLS


def sample(docs: DataFrame, labelled: DataFrame, key: str, text: str, most: int) -> DataFrame:
    """(key, facet columns, cells) of at most ``most`` labelled documents."""
    rank = F.xxhash64(key)
    known = stage(labelled.filter(F.col(key).isNotNull()).dropDuplicates([key]).orderBy(rank, key).limit(most), "labelled")
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(known, key))

    def encode(batches):
        for batch in batches:
            batch = batch.filter(batch.column(key).is_valid())
            batch = batch.filter(pa.array(in_bitmap(wanted.value, batch.column(key).to_numpy())))
            for part in W.slices(batch, text):
                cell, row = _cells(W.find_words(part.column(text), W.SPACED))
                ends = np.cumsum(np.bincount(row, minlength=part.num_rows)) * 2
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), pa.Array.from_buffers(pa.binary(), part.num_rows, [
                        None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)),
                        pa.py_buffer(cell.astype("<u2"))])], names=[key, "cells"])

    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text))
    return rows.mapInArrow(encode, f"{key} long, cells binary").join(known, key)


def _fit(cells: np.ndarray, first: np.ndarray, label: np.ndarray, classes: int, rounds: int = 80) -> np.ndarray:
    """Weights (CELLS + 1, classes) of a multinomial logistic model on the presence of cells; the last row is the bias.

    Cells in fewer than ``RARE`` of the rows have no weight.
    """
    weight = np.zeros((CELLS + 1, classes), np.float32)
    rows = len(label)
    if not rows:
        return weight
    row = np.repeat(np.arange(rows, dtype=np.int32), np.diff(first))
    common = (np.bincount(cells, minlength=CELLS) >= RARE)[cells]
    cells, row = cells[common], row[common]
    first = np.searchsorted(row, np.arange(rows + 1))
    order = np.argsort(cells, kind="stable").astype(np.int32)
    row_by_cell = row[order]
    begin = np.flatnonzero(np.diff(cells[order], prepend=-1))
    used = cells[order[begin]]
    del order, row
    pieces = [slice(a, a + _AT_ONCE) for a in range(0, len(begin), _AT_ONCE)]
    limits = np.append(begin, len(row_by_cell))
    truth = np.eye(classes, dtype=np.float32)[label]
    moment, square = np.zeros_like(weight), np.zeros_like(weight)
    for k in range(1, rounds + 1):
        p = _softmax(_logits(weight, cells, first))
        wrong = (p - truth) / rows
        slope = DECAY * weight
        for piece in pieces:
            a, b = limits[piece.start], limits[min(piece.stop, len(begin))]
            slope[used[piece]] += np.add.reduceat(wrong[row_by_cell[a:b]], begin[piece] - a, axis=0)
        slope[CELLS] = wrong.sum(0)
        moment = 0.9 * moment + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        weight -= 0.1 * (moment / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-6)
    return weight


def _logits(weight: np.ndarray, cells: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.repeat(weight[CELLS:], len(first) - 1, axis=0)
    for at in range(0, len(first) - 1, _AT_ONCE):
        own = first[at : at + _AT_ONCE + 1]
        full = np.flatnonzero(np.diff(own))
        if len(full):
            out[at + full] += np.add.reduceat(weight[cells[own[0] : own[-1]]], own[full] - own[0], axis=0)
    return out


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def classifier(docs: DataFrame, labelled: DataFrame, facets: list[str], key: str = "doc_id", text: str = "text",
               most: int = SAMPLE) -> dict:
    """One logistic model for each facet (a label column of ``labelled``); domains are combinations of facet values."""
    rows = sample(docs, labelled, key, text, most).select(key, *facets, "cells").toArrow().sort_by(key)
    data = rows["cells"].to_pylist()
    first = np.concatenate([[0], np.cumsum([len(x) // 2 for x in data])]).astype(np.int64)
    cells = np.frombuffer(b"".join(data), "<u2").astype(np.int32)
    del data
    values, weights = [], []
    for facet in facets:
        said = ["" if v is None else v for v in rows[facet].to_pylist()]
        values.append(sorted(set(said)) or [""])
        weights.append(_fit(cells, first, np.array([values[-1].index(v) for v in said], np.int64), len(values[-1])))
    domains = ["/".join(v) for v in itertools.product(*values)]
    if len(domains) > MOST_DOMAINS:
        raise ValueError(f"{len(domains)} domains; at most {MOST_DOMAINS} are broadcast")
    return {"domains": domains, "weights": weights}


def posteriors(model: dict, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(words, probability of each domain) of each text."""
    found = W.find_words(texts, W.SPACED)
    cell, row = _cells(found)
    first = np.searchsorted(row, np.arange(found.rows + 1))
    out = np.ones((found.rows, 1))
    for weight in model["weights"]:
        p = _softmax(_logits(weight, cell, first).astype(np.float64))
        out = (out[:, :, None] * p[:, None, :]).reshape(found.rows, -1)
    return np.diff(found.first), out


def _rates(p: np.ndarray, errors: np.ndarray, step: float) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the rounds whose scaled errors are given, and where the next gradient is taken: accelerated projected
    gradient steps from 1."""
    pull = p @ errors.T
    rate = ahead = np.ones(len(p))
    t = 1.0
    for k in range(len(errors)):
        new = np.maximum(0.0, ahead - step * (pull[:, k] + RIDGE * (ahead - 1.0)))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - rate)
        rate, t = new, t_new
    return rate, ahead


class Mixture:
    """What the rounds found: the model, the scaled errors of each round and the step. ``rates(texts)`` applies it."""

    def __init__(self, model: dict, errors: np.ndarray, step: float, report: list[dict]):
        self.model, self.errors, self.step, self.report = model, errors, step, report

    def rates(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, rates, most probable domain) of each text."""
        size, p = posteriors(self.model, texts)
        return size, _rates(p, self.errors, self.step)[0], p.argmax(1)


def solve(docs: DataFrame, model: dict, targets: dict[str, float], text: str = "text", budget: float | None = None,
          rounds: int = ROUNDS) -> Mixture:
    """The rates at which the expected tokens of the domains are ``targets`` (normalised) of ``budget`` tokens.

    By default the budget is the smallest at which no wanted domain is thinned out: those in short supply are repeated.
    Errors count in proportion to a domain's tokens. Targets for domains that no label names are refused.
    """
    domains = model["domains"]
    unknown = set(targets) - set(domains)
    want = np.array([targets.get(d, 0.0) for d in domains])
    known = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for whole in batches:
            for batch in W.slices(whole, text):
                size, p = posteriors(known.value, batch.column(text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(size, pa.int64()), pa.array([x.tobytes() for x in p], pa.binary())], names=["n", "p"])

    rows = stage(docs.select(F.col(text).cast("string").alias(text)).mapInArrow(score, "n long, p binary"), "posteriors")

    def sums(function, size: int) -> np.ndarray:
        """The sum over all rows of what ``function`` (words, probabilities) gives for each batch."""

        def add(batches):
            total = np.zeros(size)
            for batch in batches:
                if batch.num_rows:
                    p = np.frombuffer(b"".join(batch.column("p").to_pylist())).reshape(batch.num_rows, -1)
                    total += function(batch.column("n").to_numpy().astype(np.float64), p)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["k", "x"])

        found = rows.mapInArrow(add, "k long, x double").groupBy("k").agg(F.sum("x").alias("x")).toArrow()
        out = np.zeros(size)
        out[found["k"].to_numpy()] = found["x"].to_numpy()
        return out

    n = len(domains)
    first = sums(lambda t, p: np.concatenate([t @ p, ((p * t[:, None]).T @ p).ravel()]), n + n * n)
    have, gram = first[:n], first[n:].reshape(n, n)
    total = max(have.sum(), 1.0)
    if unknown and have.sum():
        raise ValueError(f"no label names {sorted(unknown)}")
    share = np.maximum(have / total, 1e-4)
    if want.sum():
        want = want / want.sum()
    if budget is None:
        budget = max([total, *(have[want > 0] / want[want > 0])])
    aim = want * budget / total
    bend = gram / total / np.sqrt(np.outer(share, share))
    step = 1.0 / (np.linalg.eigvalsh(bend)[-1] + RIDGE)
    errors = np.zeros((0, n))
    for _ in range(rounds):
        now = sums(lambda t, p, e=errors: (t * _rates(p, e, step)[1]) @ p, n)
        errors = np.vstack([errors, (now / total - aim) / share])
    last = sums(lambda t, p: (t * _rates(p, errors, step)[0]) @ p, n)
    report = [{"domain": d, "before": float(b), "target": float(w * budget), "expected": float(x)}
              for d, b, w, x in zip(domains, have, want, last, strict=True)]
    return Mixture(model, errors, step, report)


def mix(docs: DataFrame, mixture: Mixture, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``domain``, ``rate`` and ``copies``: the rate, rounded up or down by the hash of the
    row's key, so that copies come to the rate on average and a run can be repeated.

    Null and empty texts have no words, so they weigh nothing; they get the rate of their posteriors like any other.
    Repeated rows have the same rate each. Input columns named like the added ones are replaced.
    """
    own = "n_tokens long, domain string, rate double"
    base = docs.drop("n_tokens", "domain", "rate", "copies").withColumn(text, F.col(text).cast("string"))
    known = docs.sparkSession.sparkContext.broadcast(mixture)

    def apply(batches):
        for whole in batches:
            for batch in W.slices(whole, text):
                size, rate, best = known.value.rates(batch.column(text))
                names = known.value.model["domains"]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(size, pa.int64()), pa.array([names[k] for k in best], pa.string()),
                     pa.array(rate)], names=[*batch.schema.names, "n_tokens", "domain", "rate"])

    rated = base.mapInArrow(apply, StructType(base.schema.fields + _parse_datatype_string(own).fields))
    chance = F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    return rated.withColumn("copies", F.floor(F.col("rate") + chance))


def label_facets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, language, label): labelled documents with label toxic, low or good."""
    label = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").otherwise("good")
    rows = labels.filter(F.col("quality").isNotNull()).select(F.col("doc_id").cast("long"), label.alias("label"))
    language = docs.select(F.col("doc_id").cast("long"), F.coalesce("lang", F.lit("")).alias("language"))
    return rows.join(language.dropDuplicates(["doc_id"]), "doc_id").select("doc_id", "language", "label")


def fitted(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> Mixture:
    """The mixture of ``docs`` by language and label; targets whose domain no label names are left out."""
    with staging_scope(docs.sparkSession):
        model = classifier(docs, label_facets(docs, labels), ["language", "label"])
        return solve(docs, model, {d: w for d, w in targets.items() if d in model["domains"]})


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    mixture = fitted(docs, table(spark, sf_dir, "labels"))
    return mix(docs.select("doc_id", "text"), mixture).select("doc_id", "n_tokens", "domain", "rate", "copies")


def apply_copies(docs: DataFrame, mixture: Mixture, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with each row as often as its copies say; rows without a copy go."""
    rows, back = carried(docs, key, text)
    full = mix(rows, mixture, key, text).filter("copies > 0")
    return back(full.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))))
