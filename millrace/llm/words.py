"""Words and word n-grams of a whole column of texts as numpy arrays, hashed to 64 bits without a Python loop per row.

The helpers work on the UTF-8 buffer of an Arrow string column. A word alphabet is a set of bytes; every byte of a
character beyond ASCII is above 0x7F, so the alphabets used here mean the same on bytes and on characters.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_CHUNK = 1 << 19
CODE_BITS = 48
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_rng = np.random.default_rng(20240501)
_BYTE_CODES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GRAM_CODES = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base & _MASK)
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(_CHUNK * 2, 1 << int(n).bit_length())
    if size not in _tables:
        _tables.clear()
        _tables[size] = (_powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size))
    return _tables[size]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_bytes(separators: bytes | None = None, words: bytes | None = None) -> np.ndarray:
    """Which bytes belong to words: all but ``separators``, or those in ``words`` and all beyond ASCII."""
    if separators is not None:
        table = np.ones(256, bool)
        table[list(separators)] = False
    else:
        table = np.zeros(256, bool)
        table[list(words or b"")] = True
        table[128:] = True
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KEEP_CASE = np.arange(256, dtype=np.uint8)

# The word alphabets of the query contracts.
SPACED = word_bytes(separators=b"\x20\x09\x0a\x0b\x0c\x0d")
ALNUM = word_bytes(words=b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


@dataclass
class Words:
    """The words of some rows: byte positions in ``data``, the row of each word, its hash; ``first[r] : first[r + 1]``
    are the words of row r."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    code: np.ndarray
    first: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    marks = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    marks = marks.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[marks[0] : marks[-1]], marks - marks[0]


def _cut(inside: np.ndarray, data: np.ndarray, at: int) -> int:
    """The first place from ``at`` on where no word goes on."""
    n = len(data)
    while at < n:
        step = data[at : at + 4096]
        out = np.flatnonzero(~inside[step])
        if len(out):
            return at + int(out[0])
        at += len(step)
    return n


def find_words(texts: pa.Array, inside: np.ndarray, fold: np.ndarray = LOWER) -> Words:
    """The words of ``texts``, in order; temporary memory does not depend on the length of a text."""
    data, offsets = text_buffer(texts)
    n = len(data)
    starts, ends, codes = [], [], []
    a = 0
    while a < n:
        b = _cut(inside, data, min(n, a + _CHUNK))
        piece = data[a:b]
        word = inside[piece]
        edge = np.zeros(b - a + 1, bool)
        lo, hi = np.searchsorted(offsets, [a, b + 1])
        edge[offsets[lo:hi] - a] = True
        edge[0] = edge[-1] = True
        begin = word.copy()
        begin[1:] &= ~word[:-1] | edge[1:-1]
        finish = word
        finish[:-1] &= ~word[1:] | edge[1:-1]
        s = np.flatnonzero(begin)
        e = np.flatnonzero(finish) + 1
        power, inverse = _power_tables(b - a)
        total = np.empty(b - a + 1, np.uint64)
        total[0] = 0
        np.cumsum(_BYTE_CODES[fold[piece]] * power[: b - a], out=total[1:])
        h = (total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64) * np.uint64(_BASE)
        codes.append(mix(h))
        starts.append(s + a)
        ends.append(e + a)
        a = b
    none = np.zeros(0, np.int64)
    start = np.concatenate(starts) if starts else none
    first = np.searchsorted(start, offsets)
    return Words(
        data, offsets, start, np.concatenate(ends) if ends else none,
        np.repeat(np.arange(len(offsets) - 1), np.diff(first)),
        np.concatenate(codes) if codes else np.zeros(0, np.uint64), first,
    )


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words of one row, and the place of their first words in ``words``."""
    count = len(words.code) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    place = np.flatnonzero(words.row[:count] == words.row[n - 1 :])
    total = words.code[place] * _GRAM_CODES[0]
    for k in range(1, n):
        total += words.code[place + k] * _GRAM_CODES[k % 64] + np.uint64(k // 64)
    return mix(total + np.uint64(n)), place


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each row as (hashes of ``CODE_BITS`` bits, rows), by row and hash; a row of fewer
    words, but not none, has its whole sequence as one shingle. ``words`` has at most 65,536 rows."""
    code, place = grams(words, n)
    row = words.row[place]
    sizes = np.diff(words.first)
    for k in range(1, n):
        short = np.flatnonzero(sizes == k)
        if len(short):
            at = words.first[short]
            total = words.code[at] * _GRAM_CODES[0]
            for j in range(1, k):
                total += words.code[at + j] * _GRAM_CODES[j]
            code = np.concatenate([code, mix(total + np.uint64(k))])
            row = np.concatenate([row, short])
    key = np.sort((row.astype(np.uint64) << np.uint64(CODE_BITS)) | (code >> np.uint64(64 - CODE_BITS)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    key = key[new]
    return key & np.uint64((1 << CODE_BITS) - 1), (key >> np.uint64(CODE_BITS)).astype(np.int64)


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``most`` bytes of text and at most 65,536 rows, one row at least."""
    if batch.num_rows == 0:
        return
    _, offsets = text_buffer(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        to = min(to, at + (1 << 64 - CODE_BITS))
        yield batch.slice(at, to - at)
        at = to


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
