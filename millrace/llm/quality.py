"""Quality classifier: an interpolated modified Kneser-Ney word model of trusted text and perplexity thresholds by
language.

Words (case kept, as 64-bit hashes) of every distinct trusted text are counted as n-grams of ``ORDER`` words, with marks
for start and end. The highest order keeps raw counts; lower orders count different predecessors, but for those that begin
with a start mark, which have none. Each order has three discounts, from how many n-grams were counted once to four times.

The logarithm of an interpolated probability is a sum over n-grams: the word's own, and for each known longer n-gram the
amount by which it differs, plus the weight with which its context passes on mass to lower orders. So the model becomes
one table (key of an n-gram, weight) that grows with the trusted text, and a document's surprise is the sum of the weights
of all its n-grams: its pre-aggregated n-grams are joined with the table by key. N-grams that are
at least 1/``HOT`` of the training text, at most ``HOT`` of each order, are looked up before the shuffle instead, so no
frequent word becomes a hot key. A bitmap spares the shuffle of n-grams that the table surely lacks.

Both n-grams of the texts and of the documents are several times the text, so neither is on disk as a whole: n-grams are
counted and weighed in ``SLICES`` parts by key, documents are scored in ``SLICES`` parts by id; fewer, where texts have
less than ``SLICE`` bytes for each. The table is written in buckets of its key, so that its joins with the parts of the
documents shuffle these only.

A word that stands a third time in a row becomes a mark of its own that is never counted: such runs are always a surprise.

A fifth of the trusted texts, chosen by the text, stays out of training. Their surprise per word gives the quartiles of
each language; a document is rejected if it lies ``FENCE`` interquartile ranges above the third. Short documents are drawn
to the mean of their language by ``PRIOR`` words.
"""

import functools
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import words as W
from millrace.llm.shared import bitmap, carried, documents, in_bitmap, table
from millrace.session import Buckets, drop_folder, stage, staging_scope

ORDER = 2
HOT = 1 << 18
FENCE = 3.0
PRIOR = 10.0
FOLDS = 5
LEAST = 20
SLICES = 8
SLICE = 1 << 25
BUCKET = 1 << 20
START, END, RUN = 1, 2, 3
UNIT = 1 << 20
_BITS = 1 << 26
_ODD = W.mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def keys(*codes: np.ndarray) -> np.ndarray:
    """The key of the n-grams with the given words."""
    total = np.full(len(codes[0]), len(codes), np.uint64)
    for odd, code in zip(_ODD, codes, strict=False):
        total = W.mix(total + code.view(np.uint64)) * odd
    return W.signed(W.mix(total))


def _marked(found: W.Words, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, rows, place in the row) of the texts that have words: ``order - 1`` start marks, the words, an end mark."""
    size = np.diff(found.first)
    has = np.flatnonzero(size)
    full = size[has] + order
    first = np.cumsum(full) - full
    row = np.repeat(has, full)
    place = np.arange(len(row)) - np.repeat(first, full)
    code = np.full(len(row), START, np.uint64)
    code[first + full - 1] = END
    said = found.code.copy()
    same = (said[1:] == said[:-1]) & (found.row[1:] == found.row[:-1])
    said[2:][same[1:] & same[:-1]] = RUN
    code[(place >= order - 1) & (place < np.repeat(full - 1, full))] = said
    return W.signed(code), row, place


def _codes(m: int) -> list[str]:
    return [f"g{k}" for k in range(m)]


def trusted(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id): ids whose labels all say good and none toxic."""
    good = labels.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("x"))
    return good.filter("q = 1 and x = 0").select(F.col(key).cast("long").alias("doc_id"))


def _held(text):
    """Whether a trusted text stays out of training; copies are on one side."""
    return F.pmod(F.xxhash64(text), F.lit(FOLDS)) == 0


def count_grams(texts: DataFrame, order: int = ORDER, text: str = "text", part: int = 0, parts: int = 1) -> DataFrame:
    """(g0, g1, ..., c): how often each n-gram of ``order`` words and marks stands in the texts; those of one of
    ``parts`` parts by key."""
    names = _codes(order)

    def count(batches):
        for whole in batches:
            for batch in W.slices(whole, text):
                code, _, place = _marked(W.find_words(batch.column(text), W.SPACED, W.KEEP_CASE), order)
                at = np.flatnonzero((place >= order - 1) & (code != RUN))
                key = keys(*(code[at - back] for back in range(order - 1, -1, -1)))
                if parts > 1:
                    mine = np.flatnonzero((key.view(np.uint64) >> np.uint64(32)) % np.uint64(parts) == part)
                    key, at = key[mine], at[mine]
                _, some, n = np.unique(key, return_index=True, return_counts=True)
                words = [pa.array(code[at[some] - back]) for back in range(order - 1, -1, -1)]
                yield pa.RecordBatch.from_arrays([*words, pa.array(n.astype(np.int64))], names=[*names, "c"])

    found = texts.select(text).mapInArrow(count, "".join(f"{g} long, " for g in names) + "c long")
    return found.groupBy(*names).agg(F.sum("c").alias("c"))


def _cut(counts: DataFrame):
    """The discount of modified Kneser-Ney as a column, from how many n-grams were counted once to four times."""
    seen = {r["k"]: r["keys"] for r in counts.filter("k <= 4").groupBy("k").agg(F.count("*").alias("keys")).collect()}
    n1, n2, n3, n4 = (max(1, seen.get(k, 0)) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    one, two, more = (min(max(d, 0.05), k - 0.05) for k, d in (
        (1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3)))
    return F.when(F.col("k") == 1, one).when(F.col("k") == 2, two).otherwise(more)


def _fixed(value) -> F.Column:
    return F.round(value * UNIT).cast("int")


def train(texts: DataFrame, order: int = ORDER, text: str = "text") -> tuple[DataFrame, int, int]:
    """(key, weight, c) of all n-grams of the training texts, staged; their words and marks; the weight of an unknown word.

    Weights are logarithms in units of 1/``UNIT``, so that sums do not depend on their order. An n-gram's weight is its
    logarithm of interpolated probability, less what its ending and its context's mass already give, plus the mass it
    leaves as a context itself. Words are weighed against an unknown one.
    """
    with staging_scope(texts.sparkSession) as around:
        return _fitted(texts, order, text, around)


def _slices(texts: DataFrame, text: str) -> int:
    size = texts.agg(F.sum(F.octet_length(F.col(text).cast("string")).cast("long"))).first()[0] or 0
    return int(min(SLICES, 1 + size // SLICE))


def _counted(texts: DataFrame, order: int, text: str) -> dict[str, DataFrame]:
    """The parts of ``count_grams`` by the folder that each is staged in."""
    spark = texts.sparkSession
    with staging_scope(spark) as around:
        texts = stage(texts.select(text), "texts")
        parts = _slices(texts, text)
        found = {f"{around}/part-{part}": count_grams(texts, order, text, part, parts) for part in range(parts)}
        return {folder: stage(rows.withColumn("k", F.col("c")), "grams", folder) for folder, rows in found.items()}


def _fitted(texts: DataFrame, order: int, text: str, around: str) -> tuple[DataFrame, int, int]:
    parts = _counted(texts, order, text)
    counts = {order: functools.reduce(DataFrame.union, parts.values())}
    for m in range(order - 1, 0, -1):
        some = counts[m + 1].groupBy(*(F.col(f"g{k + 1}").alias(f"g{k}") for k in range(m)))
        some = some.agg(F.sum("c").alias("c"), F.count("*").alias("k"))
        counts[m] = stage(some.withColumn("k", F.when(F.col("g0") == START, F.col("c")).otherwise(F.col("k"))), "grams")
    one = counts[1]
    cut = _cut(one)
    total, freed, size, words = one.agg(F.sum("k"), F.sum(cut), F.count("*"), F.sum("c")).first()
    unknown = (freed / total if total else 1.0) / (size + 1)
    least = float(np.log(unknown))

    def first(rows: DataFrame) -> DataFrame:
        p = (F.col("k") - cut) / F.lit(float(total or 1)) + unknown
        gain = F.log(p) - F.when(F.col("g0") == END, 0.0).otherwise(least)
        return rows.select("g0", "c", p.alias("p"), gain.alias("gain"))

    def named(rows: DataFrame, m: int) -> DataFrame:
        def run(batches):
            for batch in batches:
                key = keys(*(batch.column(g).to_numpy() for g in _codes(m)))
                yield pa.RecordBatch.from_arrays([pa.array(key), batch.column("weight"), batch.column("c")],
                                                 names=["key", "weight", "c"])

        rows = rows.select(*_codes(m), _fixed(F.col("gain")).alias("weight"), "c")
        return rows.mapInArrow(run, "key long, weight int, c long")

    grams = sum(rows.count() for rows in counts.values())
    table = Buckets(texts.sparkSession, f"{around}/weights-{uuid.uuid4().hex}", "key", grams // BUCKET)
    grow = first
    for m in range(1, order):
        level = grow(counts[m])
        level = stage(level, "level") if m > 1 else level
        above = _cut(counts[m + 1])
        context = counts[m + 1].groupBy(*_codes(m)).agg(
            F.sum("k").alias("total"), F.sum(above).alias("freed"), F.sum("c").alias("seen"))
        context = stage(context, "contexts")
        both = level.join(context.withColumn("left", F.log(F.col("freed") / F.col("total"))), _codes(m), "full")
        table.add(named(both.select(*_codes(m), F.coalesce("c", "seen").alias("c"), (
            F.coalesce("gain", F.lit(0.0)) + F.coalesce("left", F.lit(0.0))).alias("gain")), m))
        grow = _longer(level, context, above, m)
    for folder, rows in parts.items():
        table.add(named(grow(rows), order))
        drop_folder(texts.sparkSession, folder)
    return table.read(), int(words or 0), round(least * UNIT)


def _longer(level: DataFrame, context: DataFrame, cut: F.Column, m: int) -> Callable[[DataFrame], DataFrame]:
    """From counted n-grams of ``m + 1`` words to (words, c, p, gain), by their contexts and the ``level`` below."""
    ending = level.select(*(F.col(f"g{k}").alias(f"g{k + 1}") for k in range(m)), F.col("p").alias("lower"))
    mass = F.col("freed") / F.col("total")
    p = (F.col("k") - cut) / F.col("total") + mass * F.col("lower")

    def grow(rows: DataFrame) -> DataFrame:
        both = rows.join(context.drop("seen"), _codes(m)).join(ending, _codes(m + 1)[1:])
        return both.select(*_codes(m + 1), "c", p.alias("p"), (F.log(p) - F.log(mass) - F.log("lower")).alias("gain"))

    return grow


def _identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Adds ``_id`` and ``_h``, which rows of one id and text share; the id of rows without one is made of the text."""
    said = F.col(text).cast("string")
    return docs.withColumn("_id", F.coalesce(F.col(key).cast("long"), F.xxhash64(said))).withColumn("_h", F.hash(said))


def score(docs: DataFrame, model: tuple, order: int = ORDER, text: str = "text") -> DataFrame:
    """(_id, _h, n_words, surprise) of the texts of ``docs`` (_id, _h, text): the negative logarithm of the probability of
    all words and the end of the text. Repeated rows have one result."""
    weights, total, unknown = model
    spark = docs.sparkSession
    often = weights.filter(F.col("c") * HOT >= total).select("key", "weight").toArrow().sort_by("key")
    rare = weights.filter(F.col("c") * HOT < total).select("key", "weight")
    known = spark.sparkContext.broadcast((often["key"].to_numpy(), often["weight"].to_numpy().astype(np.int64),
                                          bitmap(rare, "key", _BITS)))

    def run(batches):
        hot, value, there = known.value
        for whole in batches:
            for batch in W.slices(whole, text):
                found = W.find_words(batch.column(text), W.SPACED, W.KEEP_CASE)
                size = np.diff(found.first)
                code, row, place = _marked(found, order)
                sums = size * unknown
                some, rows = [], []
                for m in range(1, order + 1):
                    at = np.flatnonzero(place >= order - 1 - (m < order))
                    key = keys(*(code[at - back] for back in range(m - 1, -1, -1)))
                    if len(hot):
                        near = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
                        hit = hot[near] == key
                        sums = sums + np.bincount(row[at[hit]], value[near[hit]], minlength=len(size)).astype(np.int64)
                        key, at = key[~hit], at[~hit]
                    use = in_bitmap(there, key)
                    some.append(key[use])
                    rows.append(row[at[use]])
                key, at = np.concatenate(some), np.concatenate(rows)
                by = np.lexsort((key, at))
                key, at = key[by], at[by]
                new = np.ones(len(key) + 1, bool)
                new[1:-1] = (key[1:] != key[:-1]) | (at[1:] != at[:-1])
                edge = np.flatnonzero(new)
                key, at, n = key[edge[:-1]], at[edge[:-1]], np.diff(edge)
                ids, h = batch.column("_id").to_numpy(), batch.column("_h").to_numpy()
                whose = np.concatenate([at, np.arange(len(size))])
                spread = W.signed(W.mix(ids.astype(np.int64).view(np.uint64) + h.astype(np.int64).view(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([key, spread])), pa.array(ids[whose]), pa.array(h[whose]),
                     pa.array(np.concatenate([n, size]), pa.int32()),
                     pa.array(np.concatenate([np.zeros(len(key), np.int64), sums]),
                              mask=np.arange(len(whose)) < len(key))], names=["key", "_id", "_h", "n", "own"])

    rows = docs.select("_id", "_h", F.col(text).cast("string").alias(text))
    sure = F.col("d.own").isNull() & (F.col("d.key") == F.col("m.key"))

    parts = _slices(rows, text)

    def summed(part: int) -> DataFrame:
        some = rows.filter(F.pmod(F.xxhash64("_id"), F.lit(parts)) == part)
        found = some.mapInArrow(run, "key long, _id long, _h int, n int, own long").alias("d")
        return stage(_sums(found.join(rare.hint("shuffle_hash").alias("m"), sure, "left")), "sums")

    return functools.reduce(DataFrame.union, [summed(part) for part in range(parts)])


def _sums(joined: DataFrame) -> DataFrame:
    # Rows of the same id and text all add the same, so the sums are divided by their number.
    sums = joined.groupBy("_id", "_h").agg(
        F.sum(F.coalesce(F.col("own"), F.col("n") * F.coalesce(F.col("weight").cast("long"), F.lit(0)))).alias("sum"),
        F.sum(F.when(F.col("own").isNotNull(), F.col("n").cast("long"))).alias("words"), F.count("own").alias("copies"))
    return sums.select("_id", "_h", (F.col("words") / F.col("copies")).cast("long").alias("n_words"),
                       (-F.col("sum") / F.col("copies") / UNIT).alias("surprise"))


def thresholds(scored: DataFrame, known: DataFrame) -> DataFrame:
    """(language, mean, most): of the held-out trusted documents of each language, and of all as language ``*``.

    Quartiles are exact to a thousandth: they come from counts by thousandth, so no group of documents is gathered.
    """
    held = stage(scored.filter("held and n_words > 0").join(known.select("doc_id"), "doc_id")
                 .select("language", "n_words", "surprise"), "held")
    held = held.union(held.withColumn("language", F.lit("*")))
    mean = held.groupBy("language").agg((F.sum("surprise") / F.sum("n_words")).alias("mean"))
    value = (F.col("surprise") + PRIOR * F.col("mean")) / (F.col("n_words") + PRIOR)
    bins = (held.join(mean, "language").groupBy("language", F.floor(value * 1000).alias("bin"))
            .agg(F.count("*").alias("n"), F.first("mean").alias("mean")))
    below = F.sum("n").over(Window.partitionBy("language").orderBy("bin"))
    total = F.sum("n").over(Window.partitionBy("language"))
    bins = bins.select("language", "mean", "bin", below.alias("below"), total.alias("total"))
    first, third = (F.min(F.when(F.col("below") >= q * F.col("total"), F.col("bin"))) / 1000 for q in (0.25, 0.75))
    found = bins.groupBy("language").agg(F.first("mean").alias("mean"), first.alias("q1"), third.alias("q3"),
                                         F.max("total").alias("n"))
    return stage(found.filter((F.col("n") >= LEAST) | (F.col("language") == "*"))
                 .select("language", "mean", (F.col("q3") + FENCE * (F.col("q3") - F.col("q1"))).alias("most")),
                 "thresholds")


def _judged(scored: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds ``threshold`` and ``keep``; a language without its own limits has those of all."""
    row = limits.filter("language = '*'").first()
    mean, most = (row["mean"], row["most"]) if row else (0.0, float("inf"))
    own = scored.join(limits.filter("language <> '*'"), "language", "left")
    mean, most = F.coalesce("mean", F.lit(mean)), F.coalesce("most", F.lit(most))
    value = (F.col("surprise") + PRIOR * mean) / (F.col("n_words") + PRIOR)
    return own.withColumn("threshold", most).withColumn("keep", (F.col("n_words") > 0) & (value <= most)).drop(
        "mean", "most")


def _training(docs: DataFrame, known: DataFrame, key: str, text: str) -> DataFrame:
    """(text): the distinct trusted texts that are not held out."""
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(known, "doc_id"))

    def likely(batches):
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(wanted.value, batch.column("doc_id").to_numpy())))

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~_held("text"))
    found = rows.mapInArrow(likely, "doc_id long, text string").join(known, "doc_id", "left_semi")
    return found.withColumn("h", F.xxhash64("text")).dropDuplicates(["h"]).select("text")


def _scored(docs: DataFrame, labels: DataFrame, key: str, text: str, lang: str, order: int) -> DataFrame:
    """(_id, _h, doc_id, language, n_words, surprise, threshold, keep) of every row."""
    known = stage(trusted(labels, key), "trusted")
    model = train(_training(docs, known, key, text), order)
    rows = _identified(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")),
                       "doc_id", "text")
    found = score(rows, model, order)
    small = rows.select("_id", "_h", F.col("doc_id").cast("long").alias("doc_id"), _held(F.col("text").cast("string"))
                        .alias("held"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("language"))
    scored = stage(small.join(found, ["_id", "_h"]), "scored")
    return _judged(scored, thresholds(scored, known))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
             order: int = ORDER) -> DataFrame:
    """doc_id, language, n_words, perplexity, threshold (of the surprise per word) and keep, for every row of ``docs``.

    Null, empty and blank texts have no words, a null perplexity, and are rejected. A null language is a language of
    its own. Repeated rows are judged alike. Without trusted documents every document with words is kept. Very long texts
    are read whole. Other columns are not looked at.
    """
    ratio = F.when(F.col("n_words") > 0, F.exp(F.col("surprise") / (F.col("n_words") + 1)))
    return _scored(docs, labels, key, text, lang, order).select(
        "doc_id", "language", "n_words", ratio.alias("perplexity"), "threshold", "keep")


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
              order: int = ORDER) -> DataFrame:
    """``docs`` without the documents that ``classify`` rejects."""
    with staging_scope(docs.sparkSession) as around:
        poor = _scored(docs, labels, key, text, lang, order).filter(~F.col("keep")).select("_id", "_h").distinct()
        poor = stage(poor, "poor", around)
    packed, back = carried(docs, key, text)
    named = _identified(packed, key, text).withColumn("_at", F.xxhash64("_id", "_h"))
    rejected = docs.sparkSession.sparkContext.broadcast(bitmap(poor, F.xxhash64("_id", "_h")))

    def sifted(perhaps: bool):
        def run(batches):
            for batch in batches:
                yield batch.filter(pa.array(in_bitmap(rejected.value, batch.column("_at").to_numpy()) == perhaps))

        return named.mapInArrow(run, named.schema)

    # Most texts surely stay and need no shuffle.
    return back(sifted(False).unionByName(sifted(True).join(poor, ["_id", "_h"], "left_anti").select(named.columns)))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir).select("doc_id", "text", "lang"), table(spark, sf_dir, "labels"))
