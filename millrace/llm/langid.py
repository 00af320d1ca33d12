"""Language of web pages by Bayesian evidence fusion.

The text's likelihood comes from byte trigrams counted over labelled documents. It is combined with the language that
the markup declares, the suffix of the host's name, and a prior of the host that is smoothed towards its domain's, which
is smoothed towards that of all pages. How reliable a declaration or a suffix is, and what a host writes in, comes from
sums over all pages of the probabilities that the text alone gives; a page's own share is taken out for itself.
"""

import html as _html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import words as W
from millrace.llm.shared import documents, table
from millrace.session import stage

CELLS = 1 << 15
EVIDENCE = 60
HOST_WEIGHT = 10.0
DOMAIN_WEIGHT = 20.0
SOURCE_WEIGHT = 5.0
MOST_LANGUAGES = 256
_BLOCKS = re.compile(r"(?is)<(script|style|nav|footer|header|aside|noscript|template)\b.*?</\1\s*>|<!--.*?-->")
_TAG = re.compile(r"(?s)<[^>]*>")
_DECLARED = re.compile(r"""(?i)<html\b[^>]*?\slang\s*=\s*["']?([a-z]{2,3})\b""")
_HOST = re.compile(r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)")


def plain_text(page: str | None) -> str:
    return _html.unescape(_TAG.sub(" ", _BLOCKS.sub(" ", page or "")))


def address(url: str | None) -> tuple[str | None, str | None, str | None]:
    """(host, domain: its last two labels, suffix: its last label), lower case; nulls without a host."""
    found = _HOST.match(url or "")
    host = found.group(1).lower().strip(".") if found else ""
    if not host:
        return None, None, None
    labels = host.split(".")
    return host, ".".join(labels[-2:]), labels[-1]


def _trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(cells, rows) of the byte trigrams of each text, case of A-Z folded."""
    data, offsets = W.text_buffer(texts)
    low = W.LOWER[data].astype(np.uint32)
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    code = low[:-2] << np.uint32(16) | low[1:-1] << np.uint32(8) | low[2:]
    same = row[:-2] == row[2:]
    return ((code[same] * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64), row[:-2][same]


def train(docs: DataFrame, lang: str = "lang", text: str = "text") -> tuple[list[str], np.ndarray]:
    """(languages, log probability of each trigram cell in each), counted over all labelled documents."""

    def count(batches):
        seen: dict[str, np.ndarray] = {}
        for whole in batches:
            for batch in W.slices(whole, text):
                cell, row = _trigrams(batch.column(text))
                said = np.array(batch.column(lang).to_pylist(), object)
                for name in set(said.tolist()):
                    own = np.bincount(cell[(said == name)[row]], minlength=CELLS)
                    seen[name] = seen.get(name, 0) + own
        for name, total in seen.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()),
                                              pa.array(total[at])], names=["lang", "cell", "n"])

    rows = docs.select(F.col(lang).cast("string").alias(lang), F.col(text).cast("string").alias(text))
    rows = rows.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sums = stage(rows.mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell")
                 .agg(F.sum("n").alias("n")), "trigrams")
    names = [r[0] for r in sums.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()]
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    names = sorted(names) or ["und"]
    counts = np.full((len(names), CELLS), 0.1)
    for r in sums.toArrow().to_batches():
        at = np.array([names.index(x) for x in r.column("lang").to_pylist()], np.int64)
        counts[at, r.column("cell").to_numpy()] += r.column("n").to_numpy()
    return names, np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def _lists(x: np.ndarray) -> pa.Array:
    offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.reshape(-1)))


def identify(pages: DataFrame, docs: DataFrame, key: str = "page_id", url: str = "url", page: str = "html",
             lang: str = "lang", text: str = "text") -> DataFrame:
    """(key, language, probability, text_language, declared, host) of every page.

    Without text, declaration or host the other evidence decides; with none of them the language is the commonest one.
    Repeated rows are judged alike, each is counted. Without labelled documents every language is ``und``.
    """
    model = train(docs, lang, text)
    names = model[0]
    known = pages.sparkSession.sparkContext.broadcast(model)

    def read(batches):
        for whole in batches:
            for batch in W.slices(whole, "page"):
                raw = batch.column("page").to_pylist()
                cell, row = _trigrams(pa.array([plain_text(x) for x in raw], pa.string()))
                count = np.bincount(row, minlength=len(raw))
                first = np.searchsorted(row, np.arange(len(raw)))
                score = np.zeros((len(raw), len(names)))
                full = np.flatnonzero(count)
                if len(full):
                    score[full] = np.add.reduceat(known.value[1].T[cell], first[full], axis=0, dtype=np.float64)
                # Trigrams overlap and repeat: more than EVIDENCE of them say no more than so many.
                score *= (np.minimum(count, EVIDENCE) / np.maximum(count, 1))[:, None]
                said = [_DECLARED.search(x or "") for x in raw]
                where = [address(x) for x in batch.column("url").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key), pa.array([m.group(1).lower() if m else None for m in said], pa.string()),
                     *(pa.array([w[k] for w in where], pa.string()) for k in range(3)), _lists(score),
                     _lists(_softmax(score))],
                    names=[key, "declared", "host", "domain", "suffix", "score", "q"])

    rows = pages.select(key, F.col(url).cast("string").alias("url"), F.col(page).cast("string").alias("page"))
    kind = dict(rows.dtypes)[key]
    read_ = stage(rows.mapInArrow(
        read, f"{key} {kind}, declared string, host string, domain string, suffix string, score array<double>, "
        "q array<double>"), "evidence")
    total = F.array(*(F.sum(F.col("q")[k]) for k in range(len(names))))
    full = read_
    for source in ("declared", "suffix", "domain", "host"):
        sums = stage(read_.filter(F.col(source).isNotNull()).groupBy(source).agg(total.alias(f"{source}_n")), source)
        full = full.join(sums, source, "left")
    everything = read_.agg(total.alias("n")).first()["n"]
    everything = np.array([x or 0.0 for x in everything])

    def judge(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n = len(names)

            def matrix(name, batch=batch, n=n):
                column = batch.column(name)
                there = column.is_valid().to_numpy(zero_copy_only=False)
                out = np.zeros((batch.num_rows, n))
                out[there] = column.drop_null().flatten().to_numpy().reshape(-1, n)
                return out, there

            score, q = matrix("score")[0], matrix("q")[0]
            others = np.maximum(everything - q, 0.0)
            share = (others + 1.0) / (others + 1.0).sum(1, keepdims=True)
            prior = share
            for source, weight in (("domain", DOMAIN_WEIGHT), ("host", HOST_WEIGHT)):
                seen, there = matrix(f"{source}_n")
                seen = np.maximum(seen - q, 0.0)
                new = (seen + weight * prior) / (seen.sum(1, keepdims=True) + weight)
                prior = np.where(there[:, None], new, prior)
            fused = score + np.log(prior)
            for source in ("declared", "suffix"):
                seen, there = matrix(f"{source}_n")
                seen = np.maximum(seen - q, 0.0)
                rate = (seen.sum(1, keepdims=True) + 1.0) / (others.sum(1, keepdims=True) + 2.0)
                likely = (seen + SOURCE_WEIGHT * rate) / (others + SOURCE_WEIGHT)
                fused += np.where(there[:, None], np.log(likely), 0.0)
            p = _softmax(fused)
            best = p.argmax(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array([names[k] for k in best]), pa.array(p[np.arange(len(p)), best]),
                 pa.array([names[k] for k in q.argmax(1)]), batch.column("declared"), batch.column("host")],
                names=[key, "language", "probability", "text_language", "declared", "host"])

    return full.mapInArrow(judge, f"{key} {kind}, language string, probability double, text_language string, "
                                  "declared string, host string")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "pages"), documents(spark, sf_dir).select("lang", "text"))
