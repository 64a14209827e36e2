import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelion.llm import decontaminate as D
from parcelion.llm.words import ALPHANUMERIC, Words

from .plain import hits

TEXTS = st.lists(st.text(alphabet="aab c.é", max_size=60), min_size=1, max_size=8)


@given(st.lists(st.integers(0, 3), min_size=1, max_size=40))
@settings(deadline=None, max_examples=60)
def test_suffix_array_sorts_suffixes(values):
    text = np.array(values, np.int32)
    array = D.suffix_array(text, len(text))
    assert array.tolist() == sorted(range(len(values)), key=lambda i: values[i:])


@given(TEXTS, TEXTS, st.integers(2, 4))
@settings(deadline=None, max_examples=150)
def test_reports_equal_a_plain_scan(docs, items, window):
    bench = D.Benchmark([(str(i), t) for i, t in enumerate(items)], window)
    for text, report in zip(docs, D.match(Words(pa.array(docs), ALPHANUMERIC), bench)):
        words, hit, found = hits(text, dict(enumerate(items)), window)
        assert report["n_words"] == len(words)
        assert {i for s in report["spans"] for i in range(s["start"], s["end"])} == hit
        assert report["items"] == sorted(found)


def test_longest_match_and_places():
    item = " ".join(f"w{i}" for i in range(30))
    text = "before " + " ".join(f"W{i}" for i in range(4, 25)) + " after"
    bench = D.Benchmark([("7", item)], 10)
    report = D.match(Words(pa.array(["", text]), ALPHANUMERIC), bench)[1]
    assert report == {"n_words": 23, "spans": [{"start": 1, "end": 22}], "items": ["7"], "longest": 21, "longest_start": 1}


def test_longest_match_of_a_window_with_several_places():
    shared, ours = " ".join(f"w{i}" for i in range(12)), " ".join(f"y{i}" for i in range(30))
    bench = D.Benchmark([("1", f"{shared} x0 x1 x2"), ("2", f"{shared} {ours}"), ("3", shared)], 10)
    report = D.match(Words(pa.array([f"a b {shared} {ours} c"]), ALPHANUMERIC), bench)[0]
    assert (report["longest"], report["longest_start"], report["items"]) == (42, 2, ["1", "2", "3"])


@given(TEXTS, TEXTS, st.integers(1, 4))
@settings(deadline=None, max_examples=150)
def test_longest_matches_equal_a_plain_search(docs, items, window):
    bench = D.Benchmark([(str(i), t) for i, t in enumerate(items)], window)
    split = lambda text: hits(text, {}, window)[0]
    for text, report in zip(docs, D.match(Words(pa.array(docs), ALPHANUMERIC), bench)):
        words, best = split(text), (0, None)
        for item in map(split, items):
            for i in range(len(words)):
                for j in range(len(item)):
                    size = 0
                    while i + size < len(words) and j + size < len(item) and words[i + size] == item[j + size]:
                        size += 1
                    if (size >= window or size == len(item) > 0) and (size > best[0] or (size == best[0] and i < best[1])):
                        best = size, i
        assert (report["longest"], report["longest_start"]) == best


def test_hash_twins_are_told_apart(monkeypatch):
    bench = D.Benchmark([("1", "aa bb")], 2)
    words = Words(pa.array(["aa cc"]), ALPHANUMERIC)
    words.hashes[1] = bench.vocabulary[bench.text[1]]
    assert D.match(words, bench)[0]["items"] == []


def test_blocks_of_the_benchmark_give_the_same_report(spark):
    rng = random.Random(3)
    words = [f"v{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(words, k=14))) for i in range(25)]
    docs = [(i, " ".join(rng.choices(words, k=50)) + " " + rng.choice(items)[1][3:], i) for i in range(40)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, other int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(str, D.find_matches(docs, bench).collect()))
    assert one == sorted(map(str, D.find_matches(docs, bench, block_bytes=300).collect()))
    assert D.remove_contaminated(docs, bench).columns == docs.columns


def test_no_benchmark(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert D.remove_contaminated(docs, bench).count() == 1
