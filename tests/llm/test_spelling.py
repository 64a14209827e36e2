import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from parcelion.llm import spelling as S

from .plain import spelling


def _found(spark, counts, partitions):
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(partitions)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in S.variants(words).collect()}


@given(st.dictionaries(st.text("abé", min_size=1, max_size=6), st.integers(3, 60), min_size=1, max_size=60), st.integers(1, 6))
@settings(deadline=None, max_examples=8)
def test_variants_equal_brute_force(spark, counts, partitions):
    assert _found(spark, counts, partitions) == spelling(counts)


def test_long_words_and_chains(spark):
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh") for _ in range(3000))
    counts = {long: 9, long[:700] + long[701:]: 4, long[:-1] + "z": 3, "chain": 1000, "chaim": 400, "chaimm": 100, "hcaimm": 7, "ccaimm": 20, "aaaaaa": 5, "aaaaa": 12}
    assert _found(spark, counts, 4) == spelling(counts)


def test_trie_nodes_are_numbered_once(spark):
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 9))) for _ in range(120)})
    rows = S.numbered_trie(spark.createDataFrame([(w, 1) for w in words], "word string, n long").repartition(5)).collect()
    nodes, numbers = {}, {}
    for row in rows:
        assert words[row.rank] == row.word and len(row.nodes) == len(row.word) + 1
        for depth, number in enumerate(row.nodes):
            prefix = row.word[:depth]
            assert nodes.setdefault(prefix, number) == number and numbers.setdefault(number, prefix) == prefix
    assert sorted(numbers) == list(range(len(nodes)))


def test_query_of_odd_rows(query, tables):
    texts = {None: "étrange Étrange éTRANGE", 1: "Étrange ÉTRANGE é" * 3, 2: None, 3: "", 4: "short a-b-c wordy wordy wordx wordx", 5: "wordy" + "q" * 5000}
    rows = [(i, t) for i, t in texts.items()] * 2
    counts = {}
    for key, text in rows:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
                word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run
                counts[word] = counts.get(word, 0) + 1
                run = ""
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    found = query("op13_spelling", tables(documents=rows))
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found} == spelling(counts)
