import random
import re

import numpy as np
import pyarrow as pa
import pytest

from parcelion.llm import words as W

PATTERNS = [(W.NOT_SPACE, r"[^\x20\x09-\x0D]+"), (W.ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")]


@pytest.mark.parametrize("table, pattern", PATTERNS)
@pytest.mark.parametrize("piece", [7, 64, 1 << 20])
def test_words_are_those_of_the_pattern(monkeypatch, table, pattern, piece):
    monkeypatch.setattr(W, "_PIECE", piece)
    monkeypatch.setattr(W, "_powers", {})
    rng = random.Random(piece)
    texts = [None, "", " ", "x" * 300, *("".join(rng.choice("aBZz é日\n\t.0-") for _ in range(rng.randrange(80))) for _ in range(60))]
    found = W.Words(pa.array(texts), table)
    lowered = [(t or "").translate({c: c + 32 for c in range(65, 91)}) for t in texts]
    expected = [re.findall(pattern, t) for t in lowered]
    hashes = {}
    for row, own in enumerate(expected):
        a, b = found.bounds[row], found.bounds[row + 1]
        assert [W.LOWER[found.data[s:e]].tobytes().decode() for s, e in zip(found.starts[a:b], found.ends[a:b])] == own
        for word, value in zip(own, found.hashes[a:b]):
            assert hashes.setdefault(word, value) == value
    assert len(set(hashes.values())) == len(hashes)


def test_slices_and_binary_columns():
    column = pa.array(["one two", "three", None, "four five"])
    assert list(W.Words(column.slice(1), W.NOT_SPACE).bounds) == [0, 1, 1, 3]
    assert (W.Words(column.cast(pa.binary()), W.NOT_SPACE).hashes == W.Words(column, W.NOT_SPACE).hashes).all()


def test_ngrams_depend_on_order_and_length():
    h = W.Words(pa.array(["a b a b a"]), W.NOT_SPACE).hashes
    two = W.ngram_hashes(h, 2)
    assert two[0] == two[2] != two[1] and len(W.ngram_hashes(h, 6)) == 0
    assert W.ngram_hashes(h[:1], 1)[0] != h[0]


def test_batches_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array(["x" * 50, None, "y" * 500, "z"])], names=["id", "text"])
    parts = list(W.batches([batch, batch.slice(0, 0)], 60))
    assert [p.column(0).to_pylist() for p in parts] == [[1, 2], [3], [4]]
    assert np.diff(W.Words(parts[1].column(1), W.NOT_SPACE).bounds).tolist() == [1]
