"""Benchmark decontamination with suffix arrays over the training text.

Every batch of training documents is a shard. The words of a shard that can take part in a
match (runs of benchmark words as long as the shortest window) get a suffix array, sorted by
prefix doubling to the depth of the longest benchmark item. Each benchmark window is looked up by
binary search; its range in the array gives all locations of the window. The longest match at a location is that with
a neighbour of its text among the benchmark's places of the same window, which are kept in the order of their suffixes.

The benchmark is the stated query set: it is sent to the tasks in blocks of at most
``block_bytes`` of text (measured first), and a larger benchmark makes further passes over the documents.

Defined results: null or empty texts have no words and no items; repeated document rows are
reported each; benchmark rows with one item id are one item; a null item id reads as "null"; an
empty benchmark leaves all documents clean; an empty table gives an empty result. Words never span
two documents. Documents' further columns pass through; where one is named like the report, that gets
underscores before its name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelion.session import stage_table

from .columns import free_name
from .words import ALPHANUMERIC, LOWER, Words, batches

WINDOW = 10
BLOCK_BYTES = 16 << 20

REPORT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest", T.LongType()),
    T.StructField("longest_start", T.LongType()),
])


class Benchmark:
    """The benchmark side: word numbers, windows without repetition, and items by window."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        words = Words(pa.array([text for _, text in items], pa.large_string()), ALPHANUMERIC)
        self.vocabulary, first, numbers = np.unique(words.hashes, return_index=True, return_inverse=True)
        # Word numbers, with a -2 after each item.
        ends_at = np.asarray(words.bounds[1:], dtype=np.int64)
        self.text = np.insert(numbers.reshape(-1).astype(np.int32), ends_at, np.int32(-2))
        self.word_at, self.word_size = words.starts[first], (words.ends - words.starts)[first]
        self.bytes = words.data
        starts, lengths, rows, ends = [], [], [], []
        for row in range(len(items)):
            begin, end = int(words.bounds[row]) + row, int(words.bounds[row + 1]) + row
            if begin == end:
                continue
            size = min(window, end - begin)
            at = np.arange(begin, end - size + 1)
            starts.append(at)
            lengths.append(np.full(len(at), size))
            rows.append(np.full(len(at), row))
            ends.append(np.full(len(at), end))
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        starts, lengths, rows, ends = join(starts), join(lengths), join(rows), join(ends)
        self.shortest = int(lengths.min()) if len(lengths) else 0
        self.deepest = int((ends - starts).max()) if len(starts) else 0
        # Windows as rows of word numbers, padded with -3; the places of each different one by their suffixes.
        table = np.full((len(starts), window), -3, np.int32)
        for column in range(window):
            some = lengths > column
            table[some, column] = self.text[starts[some] + column]
        self.windows, first, of = np.unique(table, axis=0, return_index=True, return_inverse=True)
        self.lengths, of = lengths[first], of.reshape(-1)
        rank = np.zeros(len(self.text), np.int64)
        if len(starts) > len(first):
            rank[suffix_array(self.text, self.deepest + 1)] = np.arange(len(self.text))
        order = np.lexsort((rank[starts], of))
        self.places, self.place_bounds = starts[order], np.searchsorted(of[order], np.arange(len(first) + 1))
        pairs = np.unique(np.stack([of, rows], axis=1), axis=0) if len(rows) else np.zeros((0, 2), np.int64)
        self.window_rows = pairs[:, 1]
        self.window_bounds = np.searchsorted(pairs[:, 0], np.arange(len(self.windows) + 1))
        self.names = [name for name, _ in items]


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes of ``text`` in the order of their first ``depth`` words at least."""
    order = np.argsort(text, kind="stable")
    rank = np.empty(len(text), np.int64)
    rank[order] = np.cumsum(np.concatenate([[0], text[order][1:] != text[order][:-1]]))
    known = 1
    while known < depth and rank[order[-1]] < len(text) - 1:
        behind = np.zeros(len(text), np.int64)
        behind[:-known] = rank[known:] + 1
        key = rank * (len(text) + 1) + behind
        order = np.argsort(key, kind="stable")
        rank[order] = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
        known *= 2
    return order


def search(text: np.ndarray, array: np.ndarray, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Range of each window in the suffix array, by binary search for all windows at a time."""
    width = windows.shape[1]
    padded = np.concatenate([text, np.full(width, -3, text.dtype)])
    inside = np.arange(width)[None, :] < lengths[:, None]

    def bound(upper: bool) -> np.ndarray:
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), len(array), np.int64)
        while (some := np.flatnonzero(low < high)).size:
            middle = (low[some] + high[some]) // 2
            found = padded[array[middle][:, None] + np.arange(width)]
            differ = (found != windows[some]) & inside[some]
            at = differ.argmax(axis=1)
            line = np.arange(len(some))
            equal = ~differ[line, at]
            less = found[line, at] < windows[some][line, at]
            right = np.where(equal, upper, less)
            low[some] = np.where(right, middle + 1, low[some])
            high[some] = np.where(right, high[some], middle)
        return low

    return bound(False), bound(True)


def _runs(numbers: np.ndarray, bounds: np.ndarray, shortest: int) -> np.ndarray:
    """Mask of the words in runs of benchmark words of ``shortest`` or more within a document."""
    known = numbers >= 0
    if not known.any():
        return known
    begins = known.copy()
    begins[1:] &= ~known[:-1]
    at = bounds[:-1][bounds[:-1] < len(known)]
    begins[at] = known[at]
    run = np.cumsum(begins)
    sizes = np.bincount(run[known], minlength=run[-1] + 1)
    return known & (sizes[run] >= shortest)


def _verified(words: Words, numbers: np.ndarray, some: np.ndarray, bench: Benchmark) -> None:
    """Give up words whose hash is that of a benchmark word but whose bytes are not."""
    at = np.flatnonzero(some)
    target = numbers[at]
    sizes = words.ends[at] - words.starts[at]
    wrong = sizes != bench.word_size[target]
    numbers[at[wrong]] = -1
    at, target, sizes = at[~wrong], target[~wrong], sizes[~wrong]
    if not len(at):
        return
    first = np.cumsum(sizes) - sizes
    step = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    ours = words.data[np.repeat(words.starts[at], sizes) + step]
    theirs = bench.bytes[np.repeat(bench.word_at[target], sizes) + step]
    unlike = np.add.reduceat(LOWER[ours] != LOWER[theirs], first)
    numbers[at[unlike > 0]] = -1


def _longest(text: np.ndarray, place: np.ndarray, length: np.ndarray, bench: Benchmark, window: np.ndarray) -> np.ndarray:
    """The most words that agree from each place of a window on, with any place of that window in the benchmark.

    A binary search among the places meets both neighbours of the text, one of which agrees longest."""
    padded, full = np.append(text, np.int32(-1)), length.copy()
    low, high = bench.place_bounds[window], bench.place_bounds[window + 1]
    while (some := np.flatnonzero(low < high)).size:
        middle = (low[some] + high[some]) // 2
        ours, theirs, same = place[some], bench.places[middle], length[some]
        alive = np.arange(len(some))
        while alive.size:
            ahead = np.minimum(ours[alive] + same[alive], len(text))
            alive = alive[padded[ahead] == bench.text[theirs[alive] + same[alive]]]
            same[alive] += 1
        full[some] = np.maximum(full[some], same)
        right = bench.text[theirs + same] < padded[np.minimum(ours + same, len(text))]
        low[some] = np.where(right, middle + 1, low[some])
        high[some] = np.where(right, high[some], middle)
    return full


def match(words: Words, bench: Benchmark) -> list[dict]:
    """The report of each row of a batch."""
    reports = [{"n_words": int(n), "spans": [], "items": [], "longest": 0, "longest_start": None} for n in np.diff(words.bounds)]
    if not len(bench.windows) or not len(words.hashes):
        return reports
    place = np.minimum(np.searchsorted(bench.vocabulary, words.hashes), len(bench.vocabulary) - 1)
    numbers = np.where(bench.vocabulary[place] == words.hashes, place, -1).astype(np.int32)
    _verified(words, numbers, _runs(numbers, words.bounds, bench.shortest), bench)
    inside = _runs(numbers, words.bounds, bench.shortest)
    at = np.flatnonzero(inside)
    if not len(at):
        return reports
    # Runs side by side, with a -1 between two of them and between documents.
    row = np.searchsorted(words.bounds, at, "right") - 1
    gap = np.concatenate([[0], ((np.diff(at) > 1) | (np.diff(row) > 0)).astype(np.int64)])
    position = np.arange(len(at)) + np.cumsum(gap)
    text = np.full(position[-1] + 1, -1, np.int32)
    text[position] = numbers[at]
    origin = np.full(len(text), -1, np.int64)
    origin[position] = at
    array = suffix_array(text, bench.deepest)
    low, high = search(text, array, bench.windows, bench.lengths)
    counts = high - low
    if not counts.sum():
        return reports
    window = np.repeat(np.arange(len(low)), counts)
    place = array[np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)]
    begin = origin[place]
    length = bench.lengths[window]
    # Coverage of the documents' words.
    steps = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(steps, begin, 1)
    np.add.at(steps, begin + length, -1)
    covered = np.concatenate([[False], np.cumsum(steps[:-1]) > 0, [False]])
    full = _longest(text, place, length, bench, window)
    hit_row = np.searchsorted(words.bounds, begin, "right") - 1
    order = np.lexsort((begin, -full, hit_row))
    best = order[np.concatenate([[True], np.diff(hit_row[order]) > 0])]
    for row_window in np.unique(np.stack([hit_row, window], axis=1), axis=0):
        rows = bench.window_rows[bench.window_bounds[row_window[1]] : bench.window_bounds[row_window[1] + 1]]
        reports[row_window[0]]["items"].extend(rows.tolist())
    for index, top in zip(hit_row[best], best):
        a, b = words.bounds[index], words.bounds[index + 1]
        edge = np.diff(np.concatenate([[0], covered[a + 1 : b + 1].astype(np.int8), [0]]))
        report = reports[index]
        report["spans"] = [{"start": int(s), "end": int(e)} for s, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
        report["items"] = sorted({bench.names[i] for i in report["items"]})
        report["longest"], report["longest_start"] = int(full[top]), int(begin[top] - a)
    return reports


def _merged(old: dict | None, new: dict) -> dict:
    """Reports of one document from two blocks of the benchmark."""
    if not old:
        return new
    spans: list[dict] = []
    for span in sorted([*old["spans"], *new["spans"]], key=lambda s: (s["start"], s["end"])):
        if spans and span["start"] <= spans[-1]["end"]:
            spans[-1] = {"start": spans[-1]["start"], "end": max(spans[-1]["end"], span["end"])}
        else:
            spans.append(span)
    best = max(old, new, key=lambda r: (r["longest"], -(r["longest_start"] or 0)))
    return {
        "n_words": new["n_words"], "spans": spans, "items": sorted({*old["items"], *new["items"]}),
        "longest": best["longest"], "longest_start": best["longest_start"],
    }


def _pass(docs: DataFrame, items: list[tuple[str, str | None]], text_col: str, report: str, window: int) -> DataFrame:
    """Search one block of the benchmark in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(items)
    carried = [c for c in docs.columns if c != report]
    at, old_at = docs.columns.index(text_col), docs.columns.index(report) if report in docs.columns else None
    places = [docs.columns.index(c) for c in carried]
    schema = T.StructType([docs.schema[c] for c in carried] + [T.StructField(report, REPORT)])

    def run(stream):
        bench = None
        for batch in batches(stream, column=text_col):
            bench = bench or Benchmark(shared.value, window)
            found = match(Words(batch.column(at), ALPHANUMERIC), bench)
            if old_at is not None:
                found = [_merged(a, b) for a, b in zip(batch.column(old_at).to_pylist(), found)]
            columns = [batch.column(i) for i in places]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, _ARROW)], names=[*carried, report])

    return docs.mapInArrow(run, schema)


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_ARROW = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string())), ("longest", pa.int64()), ("longest_start", pa.int64())])


def find_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    report: str = "contamination",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a struct column ``report`` as its last: n_words, spans of hit words, ids of the items with
    occurring windows, and length and first word of the longest verbatim match of a window or more (the first of several)."""
    report = free_name(docs.columns, report)
    docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), F.col(item_text_col).cast("string").alias("text")
    )
    size = items.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    blocks = -(-size // block_bytes) or 1
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    for number in range(blocks):
        rows = [(row["item"], row["text"]) for row in items.filter(block == number).collect()]
        docs = _pass(docs, rows, text_col, report, window)
        if number < blocks - 1:
            docs = stage_table(docs, "decontaminate")
    return docs


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents in which no benchmark window occurs, with their columns unchanged."""
    found = find_matches(docs, benchmark, text_col)
    report = found.columns[-1]
    return found.filter(F.size(f"{report}.items") == 0).drop(report)
