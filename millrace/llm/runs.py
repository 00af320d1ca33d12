"""Periodic run detection: maximal stretches of repeated word groups in every document, and the texts without the repeats.

A run of period p has words p apart that are identical. Where it is long enough, the places i with word i equal to word
i + p form a stretch of at least ``max(24 - p, 2 * p)`` places, so testing the multiples of that number for every p (a
harmonic grid: about n log n / 2 tests) meets every run. Each hit is extended to both sides by longest common extensions.

An extension compares a few words until both places are in a difference cover (all residues modulo ``CYCLE`` are
differences of two of its members), which happens within ``CYCLE`` words. Only cover-sampled suffixes are sorted, as
strings of whole blocks of ``CYCLE`` words, by prefix doubling; the minimum of their common prefixes between two places
of that order, from a sparse table, is the number of equal blocks; the words of the first unequal block are compared
again. Documents in which no comparison gets as far as a sample need no order and build none.

Words are compared as whole words (numbers given out by a dictionary), never as hashes. A document is worked on in one
task, with about 200 bytes of memory for each of its words; nothing is shuffled, so no key can be hot.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import words as W
from millrace.llm.shared import documents

LEAST = 24
TIMES = 3
CYCLE = 73
_PAIRS = 1 << 19


def _cover() -> np.ndarray:
    """The powers of two modulo 73: every residue is the difference of exactly one pair of them."""
    out = [1]
    while out[-1] * 2 % CYCLE != 1:
        out.append(out[-1] * 2 % CYCLE)
    return np.sort(np.array(out))


COVER = _cover()
_PLACE = np.full(CYCLE, -1)
_PLACE[COVER] = np.arange(len(COVER))
_FIRST = np.zeros(CYCLE, np.int64)  # for each difference, a member whose sum with it is a member
for _member in COVER:
    _FIRST[(COVER - _member) % CYCLE] = _member


def _agree(x: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many words from i and j on are equal, at most ``most``."""
    out = np.zeros(len(i), np.int64)
    live = np.flatnonzero(most > 0)
    a, b, end = i[live], j[live], most[live]
    k = 0
    while len(live):
        same = x[a + k] == x[b + k]
        live, a, b, end = live[same], a[same], b[same], end[same]
        k += 1
        out[live] = k
        go = end > k
        live, a, b, end = live[go], a[go], b[go], end[go]
    return out


def _shift(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Words to go until both places are in the cover."""
    return (_FIRST[(j - i) % CYCLE] - i) % CYCLE


class Extensions:
    """Longest common extensions to the right in several texts, one after another in ``x``; ``ends`` are their ends."""

    def __init__(self, x: np.ndarray, ends: np.ndarray):
        self.x = x
        at = np.arange(0, len(x) + CYCLE, CYCLE)[:, None] + COVER
        at = at.reshape(-1)[at.reshape(-1) < len(x)]
        text = np.searchsorted(ends, at, side="right")
        self._sort(at, text, ends)

    def _sort(self, at: np.ndarray, text: np.ndarray, ends: np.ndarray) -> None:
        count, step = len(at), len(COVER)
        if count == 0:
            self.rank, self.table = np.zeros(0, np.int64), [np.zeros(0, np.int64)]
            return
        left = ends[text] - at
        padded = np.concatenate([self.x, np.full(CYCLE, -1, self.x.dtype)])
        block = np.empty((count, CYCLE + 1), np.int32)
        block[:, 0] = text
        block[:, 1:] = np.lib.stride_tricks.sliding_window_view(padded, CYCLE)[at]
        block[:, 1:][np.arange(CYCLE) >= left[:, None]] = -1
        rank = np.unique(block.view(np.dtype((np.void, block.shape[1] * 4))).reshape(-1), return_inverse=True)[1]
        del block
        # A block that goes beyond its text equals no other of it, so in the end all ranks of a text differ.
        levels, jump = [rank], 1
        while rank.max() + 1 < count:
            behind = np.zeros(count, np.int64)
            inside = np.flatnonzero(left > jump * CYCLE)
            behind[inside] = rank[inside + jump * step] + 1
            rank = np.unique(rank * (count + 1) + behind, return_inverse=True)[1]
            levels.append(rank)
            jump *= 2
        order = np.argsort(rank)
        a, b = order[:-1].copy(), order[1:].copy()
        shared = np.zeros(count - 1, np.int64)
        for depth in range(len(levels) - 1, -1, -1):
            same = (a < count) & (b < count)
            same[same] = levels[depth][a[same]] == levels[depth][b[same]]
            shared[same] += 1 << depth
            a[same] += step << depth
            b[same] += step << depth
        self.rank, self.table = rank, [shared]
        while 1 << len(self.table) < count:
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]) if len(last) > half else last)

    def _blocks(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal whole blocks behind two different sampled places: the least common prefix between them in the order."""
        a, b = (self.rank[(v // CYCLE) * len(COVER) + _PLACE[v % CYCLE]] for v in (i, j))
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(i), np.int64)
        for depth in np.unique(level):
            at = np.flatnonzero(level == depth)
            row = self.table[depth]
            out[at] = np.minimum(row[lo[at]], row[hi[at] - (1 << int(depth))])
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray, end: np.ndarray) -> np.ndarray:
        """For i < j in one text that ends at ``end``."""
        most = end - j
        near = np.minimum(_shift(i, j), most)
        out = _agree(self.x, i, j, near)
        far = np.flatnonzero((out == near) & (near < most))
        if len(far):
            a, b = i[far] + out[far], j[far] + out[far]
            equal = self._blocks(a, b) * CYCLE
            rest = _agree(self.x, a + equal, b + equal, np.minimum(CYCLE, end[far] - b - equal))
            out[far] += equal + rest
        return out


def _grid(sizes: np.ndarray, starts: np.ndarray):
    """(text, place, period) of the tests of all texts, in pieces of about ``_PAIRS``."""
    tops = np.where(sizes >= LEAST, sizes // TIMES, 0)
    text = np.repeat(np.arange(len(sizes)), tops)
    period = np.arange(len(text)) - np.repeat(np.cumsum(tops) - tops, tops) + 1
    step = np.maximum(LEAST - period, (TIMES - 1) * period)
    count = (sizes[text] - period - 1) // step + 1
    total = np.concatenate([[0], np.cumsum(count)])
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(total, total[at] + _PAIRS, side="right")) - 1)
        n = count[at:to]
        which = np.repeat(np.arange(at, to), n)
        place = (np.arange(len(which)) - np.repeat(total[at:to] - total[at], n)) * step[which]
        yield text[which], place + starts[text[which]], period[which]
        at = to


def _distinct(found: list[np.ndarray]) -> np.ndarray:
    """Rows (text, start, end, period); of equal stretches, the one of the smallest period."""
    rows = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)
    return rows[new]


def _stretches(text, i, p, ahead, back) -> np.ndarray:
    long = ahead + back >= np.maximum(LEAST - p, (TIMES - 1) * p)
    text, i, p, ahead, back = (v[long] for v in (text, i, p, ahead, back))
    return _distinct([np.stack([text, i - back, i + p + ahead, p], 1)])


def find_runs(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period) of all runs in texts of ``sizes`` words that follow one another in ``x``,
    by text, start and period. ``start`` counts from the start of the text."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    mirrored = np.ascontiguousarray(x[::-1])
    found, deep = [], np.zeros(len(sizes), bool)

    def hits(sizes, starts, x):
        for text, i, p in _grid(sizes, starts):
            same = x[i] == x[i + p]
            if same.any():
                yield text[same], i[same], p[same]

    for text, i, p in hits(sizes, starts, x):
        ahead_most = ends[text] - i - p
        back_most = i - starts[text]
        near = np.minimum(_shift(i, i + p), ahead_most)
        ahead = _agree(x, i, i + p, near)
        a, b = len(x) - i - p, len(x) - i
        near_back = np.minimum(_shift(a, b), back_most)
        back = _agree(mirrored, a, b, near_back)
        open_ = ((ahead == near) & (near < ahead_most)) | ((back == near_back) & (near_back < back_most))
        # An end that is open can go on for long; a text with such a hit gets the whole treatment below.
        deep[text[open_]] = True
        found.append(_stretches(text, i, p, ahead, back))
    found = [rows[~deep[rows[:, 0]]] for rows in found]
    chosen = np.flatnonzero(deep)
    if len(chosen):
        y = np.concatenate([x[starts[t] : ends[t]] for t in chosen])
        own_ends = np.cumsum(sizes[chosen])
        own_starts = own_ends - sizes[chosen]
        right, left = Extensions(y, own_ends), Extensions(np.ascontiguousarray(y[::-1]), np.cumsum(sizes[chosen][::-1]))
        for text, i, p in hits(sizes[chosen], own_starts, y):
            ahead = right(i, i + p, own_ends[text])
            back = np.zeros(len(i), np.int64)
            inner = np.flatnonzero(i > own_starts[text])
            back[inner] = left(len(y) - i[inner] - p[inner], len(y) - i[inner], len(y) - own_starts[text[inner]])
            rows = _stretches(text, i, p, ahead, back)
            rows[:, 1:3] += (starts[chosen] - own_starts)[rows[:, :1]]
            rows[:, 0] = chosen[rows[:, 0]]
            found.append(rows)
    rows = _distinct(found)
    rows[:, 2] -= rows[:, 1]
    rows[:, 1] -= starts[rows[:, 0]]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


@dataclass
class _Batch:
    words: list[list[bytes]]
    sizes: np.ndarray
    x: np.ndarray


def _numbered(texts: pa.Array) -> _Batch:
    """The words of some texts (split at space, tab, line feed, vertical tab, form feed and carriage return) with equal
    numbers for equal words."""
    data, offsets = W.text_buffer(texts)
    raw = data.tobytes()
    words = [raw[a:b].split() for a, b in zip(offsets[:-1], offsets[1:])]
    sizes = np.array([len(w) for w in words], np.int64)
    numbers: dict[bytes, int] = {}
    for w in words:
        numbers.update(dict.fromkeys(w))
    for at, word in enumerate(numbers):
        numbers[word] = at
    x = np.concatenate([np.fromiter(map(numbers.__getitem__, w), np.int32, len(w)) for w in words])
    return _Batch(words, sizes, x)


def _strongest(runs: np.ndarray):
    """The run of the greatest length / period, compared as fractions; the first of equals."""
    best = None
    for start, length, period in runs.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = start, length, period
    return best


_SHAPE = ("doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
          "strongest struct<start:long,length:long,period:long>, collapsed string")
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, strongest, collapsed) for every row of ``docs``.

    runs: all runs by start and period, their smallest. strongest: the one of the greatest length / period, null without
    runs. collapsed: the words joined by one space, of each run only the first period. Null and empty texts have no
    words, no runs and an empty ``collapsed``. Rows without an id and repeated rows are rows like any other; other
    columns of ``docs`` are not read. A very long text is worked on as a whole.
    """

    def run(batches):
        for whole in batches:
            for batch in W.slices(whole, "text"):
                own = _numbered(batch.column("text"))
                rows = find_runs(own.x, own.sizes)
                first = np.searchsorted(rows[:, 0], np.arange(batch.num_rows + 1))
                runs, strongest, collapsed = [], [], []
                for r, words in enumerate(own.words):
                    part = rows[first[r] : first[r + 1], 1:]
                    best = None
                    if len(part):
                        change = np.zeros(len(words) + 1, np.int64)
                        np.add.at(change, part[:, 0] + part[:, 2], 1)
                        np.add.at(change, part[:, 0] + part[:, 1], -1)
                        words = [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
                        best = dict(zip(("start", "length", "period"), _strongest(part)))
                    runs.append([dict(zip(("start", "length", "period"), x)) for x in part.tolist()])
                    strongest.append(best)
                    collapsed.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(own.sizes), pa.array(runs, pa.list_(_RUN)),
                     pa.array(strongest, _RUN), pa.array(collapsed, pa.string())],
                    names=["doc_id", "n_words", "runs", "strongest", "collapsed"],
                )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, _SHAPE)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the tail of every tenth document, chosen by the checksum of its id, made periodic;
    rows without an id stay as they are."""
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n = F.floor(h / 10), F.size("words")
    start = F.col("g") % n
    period = 1 + F.floor((n - F.col("start")) / (3 + F.col("g") % 8))
    at = lambda i: F.when(i < F.col("start"), i).otherwise(
        F.col("start") + (i - F.col("start")) % F.col("period"))
    changed = F.array_join(
        F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", at(i).cast("int"))), " ")
    chosen = (h % 10 == 0) & F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    return (
        docs.select("doc_id", "text").withColumn("words", F.when(chosen, words)).withColumn("g", g)
        .withColumn("start", start).withColumn("period", period)
        .select("doc_id", F.when(F.col("words").isNotNull(), changed).otherwise(F.col("text")).alias("text"))
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_periodic_tails(documents(spark, sf_dir)))
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
        F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
