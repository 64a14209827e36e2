"""Words of Arrow string columns as 64-bit hashes, without a Python object per word.

A column's UTF-8 bytes are classified through a 256-entry table. Hashes are polynomial
prefix sums modulo 2**64, finished by a mixer; they are the same in every task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_PIECE = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _table(separators) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


SPACES = [0x20, *range(0x09, 0x0E)]
# Words between white space.
NOT_SPACE = _table(SPACES)
# Words of digits, lower-case letters and all characters beyond ASCII.
ALPHANUMERIC = _table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
# Words between white space and common punctuation.
NOT_PUNCTUATION = _table([*SPACES, *b".,;:!?\"'()"])

_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, size: int) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < size:
        known = np.full(max(size, _PIECE), base, dtype=_U)
        known[0] = 1
        known = _powers[name] = np.cumprod(known, dtype=_U)
    return known[:size]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    values = (values ^ (values >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> _U(27))) * _U(0x94D049BB133111EB)
    return values ^ (values >> _U(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (strings or binary) and the offset of each; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        column = pc.fill_null(column.cast(pa.large_binary()), b"")
    else:
        column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def _cut(data: np.ndarray, begin: int, is_word: np.ndarray) -> int:
    """End of the piece that begins at ``begin``: near _PIECE bytes on, at a separator."""
    end = begin + _PIECE
    if end >= len(data):
        return len(data)
    back = np.flatnonzero(~is_word[LOWER[data[begin:end]]])
    if len(back):
        return begin + int(back[-1]) + 1
    while end < len(data):
        ahead = np.flatnonzero(~is_word[LOWER[data[end : end + _PIECE]]])
        if len(ahead):
            return end + int(ahead[0]) + 1
        end += _PIECE
    return len(data)


class Words:
    """All words of a column, in order.

    ``hashes``, ``starts`` and ``ends`` (byte offsets into ``data``) have an entry per word;
    the words of row i are ``bounds[i]`` to ``bounds[i + 1]``. A-Z count as a-z unless ``fold`` is off.
    """

    def __init__(self, column: pa.Array, is_word: np.ndarray, fold: bool = True):
        self.data, self.offsets = utf8(column)
        hashes, starts, ends = [], [], []
        begin = 0
        while begin < len(self.data):
            end = _cut(self.data, begin, is_word)
            piece = LOWER[self.data[begin:end]] if fold else self.data[begin:end]
            inside = is_word[LOWER[piece]]
            first = inside.copy()
            first[1:] &= ~inside[:-1]
            last = inside.copy()
            last[:-1] &= ~inside[1:]
            rows = self.offsets[np.searchsorted(self.offsets, begin) : np.searchsorted(self.offsets, end, "right")] - begin
            at = rows[rows < len(piece)]
            first[at] = inside[at]
            at = rows[rows > 0] - 1
            last[at] = inside[at]
            s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
            if len(s):
                sums = np.cumsum((piece.astype(_U) + _U(1)) * _power("up", _BASE, len(piece)), dtype=_U)
                before = np.where(s > 0, sums[s - 1], _U(0))
                h = (sums[e - 1] - before) * _power("down", _INVERSE, len(piece))[s]
                hashes.append(mix(h + (e - s).astype(_U) * _U(0xD6E8FEB86659FD93)))
                starts.append(s + begin)
                ends.append(e + begin)
            begin = end
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, _U)
        self.starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.ends = np.concatenate(ends) if ends else np.zeros(0, np.int64)
        self.bounds = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.bounds) - 1


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words; one shorter than the input by n - 1."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, _U)
    total = np.zeros(size, _U)
    for i in range(n):
        total = total * _U(0x9FB21C651E98DF25) + hashes[i : i + size]
    return mix(total + _U(n))


def batches(stream, byte_limit: int = 8 << 20, column: str = "text"):
    """Cut Arrow batches so that each holds about ``byte_limit`` bytes of ``column``.
    A row is never cut: one long text makes a batch of its own."""
    for batch in stream:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        total = np.cumsum(np.asarray(sizes, dtype=np.int64))
        begin = 0
        while begin < batch.num_rows:
            used = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, used + byte_limit, "right")))
            yield batch.slice(begin, end - begin)
            begin = end
