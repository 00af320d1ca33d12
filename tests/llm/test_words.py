import pyarrow as pa
import pytest
from cases import alnum, shingles, spaced, texts

from millrace.llm import words as W


@pytest.mark.parametrize(("table", "plain"), [(W.SPACED, spaced), (W.ALNUM, alnum)])
def test_words_are_those_of_the_pattern(table, plain):
    said = [t for _, t in texts()]
    found = W.find_words(pa.array(said), table)
    lower = W.LOWER[found.data].tobytes()
    got = [[lower[found.start[k] : found.end[k]].decode() for k in range(a, b)]
           for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
    assert got == [plain(t) for t in said]
    assert len(set(found.code.tolist())) == len({w for ws in got for w in ws})


def test_chunks_do_not_cut_words(monkeypatch):
    said = pa.array([t for _, t in texts()])
    whole = W.find_words(said, W.SPACED)
    monkeypatch.setattr(W, "_CHUNK", 64)
    cut = W.find_words(said, W.SPACED)
    assert (whole.code == cut.code).all() and (whole.start == cut.start).all() and (whole.first == cut.first).all()


def test_shingle_sets():
    said = [t for _, t in texts()]
    code, row = W.shingle_sets(W.find_words(pa.array(said), W.SPACED), 4)
    assert [int((row == k).sum()) for k in range(len(said))] == [len(shingles(t, 4)) for t in said]


def test_sliced_arrays_and_no_rows():
    said = pa.array(["drop", "a b", None, "c"])
    assert W.find_words(said[1:], W.SPACED).first.tolist() == [0, 2, 2, 3]
    assert W.find_words(pa.array([], pa.string()), W.SPACED).rows == 0
