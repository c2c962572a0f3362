"""Words of Arrow columns against regular expressions."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tableferry.llm import words as W

from .plain import LOWER, alphanumeric, spaced

texts = st.lists(st.one_of(st.none(), st.text("aB zé\t\n\x0b.9-日\x1c\xa0")), max_size=6)


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
@given(rows=texts)
def test_words_of_each_text(rows, kind):
    for word_bytes, plain in ((W.ALPHANUMERIC, alphanumeric), (W.SPACED, spaced)):
        found = []
        for _, words in W.pieces(pa.array(rows, kind), word_bytes):
            for first, n in zip(words.first, words.counts):
                found.append([words.text(first + i, 1).decode() for i in range(n)])
        assert found == [[w.translate(LOWER) for w in plain(t)] for t in rows]


@given(rows=texts)
def test_a_slice_of_a_column_has_its_own_words(rows):
    column = pa.array([*rows, "one two", None, "three"])[len(rows) :]
    (_, words), = W.pieces(column, W.SPACED)
    assert words.counts.tolist() == [2, 0, 1]


def test_equal_words_have_equal_hashes_and_others_differ():
    rows = ["ab a b ba aab b", "a ab", "x" * 9000 + " " + "x" * 9001 + " " + "x" * 9000]
    hashes, plain = [], []
    for at, words in W.pieces(pa.array(rows), W.SPACED):
        hashes += words.hashes().tolist()
        plain += [w for t in rows[at : at + words.texts] for w in t.split()]
    assert len(set(hashes)) == len(set(plain)) == len(set(zip(hashes, plain)))


def test_windows_tell_order_and_length_apart():
    h = W.mix(np.arange(1, 9, dtype=np.uint64))
    seen = [int(x) for k in range(1, 6) for x in W.window_hashes(h, k)]
    seen += [int(x) for k in range(2, 6) for x in W.window_hashes(h[::-1].copy(), k)]
    assert len(set(seen)) == len(seen)
    assert len(W.window_hashes(h, 9)) == 0


def test_pieces_are_cut_between_texts(monkeypatch):
    monkeypatch.setattr(W, "PIECE_BYTES", 10)
    rows = ["aaaa", "bb cc", "", "long text over a piece", None, "d"]
    found = [(at, words.counts.tolist()) for at, words in W.pieces(pa.array(rows), W.SPACED)]
    assert [n for _, counts in found for n in counts] == [1, 2, 0, 5, 0, 1]
    assert [at for at, _ in found] == [0, 3, 4]
