"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius of it; two fingerprints within the radius share a
variant, so one shuffle on variants brings them together. For an odd radius the halves differ: one side of a pair is
within the smaller half of the shared variant, the other within the larger.

All fingerprints of a variant are within the radius of one that is within the smaller half of it (triangle inequality).
So a variant links its fingerprints to one hub instead of emitting all their pairs: what can be reached stays the same,
and the links are at most as many as the variants. A variant has at most as many fingerprints as a ball has points (65
for a radius of 2), whatever the data: copies have collapsed into one fingerprint before.
"""

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import words as W
from millrace.llm.shared import components, documents, small_batches
from millrace.session import stage

N = 3
SEED = 42
RADIUS = 2
BITS = 64
_PIECE = 1 << 15


def bit_counts(text: bytes, n: int, seed: int) -> tuple[np.ndarray, int]:
    """How many n-word shingles of ``text`` have each bit of their hash set, lowest bit first, and their number."""
    words = text.lower().split()
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]] if words else []
    # The hash takes the shingle without the space behind it.
    last = ends[n - 1 :] if len(words) >= n else ends[-1:]
    total, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(last), _PIECE):
        part = last[at : at + _PIECE]
        codes = np.array([digest(line[a : b - 1], seed) for a, b in zip(starts[at:], part)], "<u8")
        total += np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return total, len(last)


_PLACES = np.uint64(1) << np.arange(BITS, dtype=np.uint64)


def fingerprint(text: bytes, n: int = N, seed: int = SEED) -> int:
    """64 bits, each set if it is set in more than half the shingles' hashes; 0 without words. Signed."""
    counts, total = bit_counts(text, n, seed)
    return int(_PLACES[2 * counts > total].sum(dtype=np.uint64).astype(np.int64))


def fingerprints(docs: DataFrame, n: int = N, key: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """(doc_id, fp) for every row: only A-Z are lower-cased, words are cut at ASCII white space. Null counts as empty; a
    text of fewer than n words is one shingle. A text is hashed as a whole, in pieces of bounded memory."""

    def run(batches):
        for whole in batches:
            for batch in W.slices(whole, "text"):
                data, offsets = W.text_buffer(batch.column("text"))
                raw = data.tobytes()
                fp = [fingerprint(raw[a:b], n, seed) for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp, pa.int64())],
                                                 names=["doc_id", "fp"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def ball(radius: int) -> list[tuple[int, int]]:
    """(mask, number of its bits) of all changes of at most ``radius`` bits, masks signed."""
    masks = [(sum(1 << b for b in bits), k) for k in range(radius + 1) for bits in combinations(range(BITS), k)]
    return [(m - (1 << 64) if m >> 63 else m, k) for m, k in masks]


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(x, y), x < y, of distinct fingerprints at most ``radius`` bits apart: enough of these pairs to connect all that
    such pairs connect. ``prints`` has distinct fingerprints ``fp``. Each pair is verified once."""
    small = radius // 2
    masks = ball(radius - small)
    change = F.explode(F.array(*(F.struct(F.lit(m).alias("m"), F.lit(k).alias("k")) for m, k in masks)))
    sent = prints.select("fp", change.alias("c")).select(
        F.col("fp").bitwiseXOR(F.col("c.m")).alias("variant"), "fp", (F.col("c.k") <= small).alias("near"))
    hub = F.min(F.when(F.col("near"), F.col("fp"))).over(Window.partitionBy("variant"))
    met = sent.select("fp", hub.alias("hub")).filter(F.col("hub") != F.col("fp"))
    pairs = met.select(F.least("fp", "hub").alias("x"), F.greatest("fp", "hub").alias("y")).distinct()
    return pairs.filter(F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= radius)


def cluster(
    docs: DataFrame, n: int = N, radius: int = RADIUS, key: str = "doc_id", text: str = "text", seed: int = SEED
) -> DataFrame:
    """(doc_id, fp, component_id) for every row: the smallest id among all rows whose fingerprints links reach.

    Texts without words have the fingerprint 0 and are linked like any other. Rows without an id belong to the class of
    their fingerprint but never name it; a class without any id has a null. Repeated rows are rows like any other. Other
    columns of ``docs`` are not read.
    """
    small_batches(docs.sparkSession)
    rows = stage(fingerprints(docs, n, key, text, seed), "fingerprints")
    prints = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    found = components(links(prints, radius), "x", "y").withColumnRenamed("node", "fp")
    placed = stage(prints.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "placed")
    named = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = stage(placed.join(named, "component").select("fp", "component_id"), "classes")
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
