import random

import regex

from parcelion.llm import token_counts as K

from .plain import best_cut, prose


def test_counts_are_those_of_the_best_cut_and_prefixes_are_scored_once():
    rng = random.Random(9)
    scores = {bytes(rng.choices(b"abc", k=rng.randrange(1, 5))): -rng.random() * 5 for _ in range(40)}
    pieces = K.PieceScores(scores)
    words = [bytes(rng.choices(b"abcd", k=rng.randrange(0, 9))) for _ in range(300)]
    terminal, nodes = K.trie_counts(words, pieces)
    assert terminal == {w: best_cut(w, scores, pieces.missing) for w in words}
    assert nodes == len({w[:i] for w in words for i in range(1, len(w) + 1)})


def test_documents_equal_plain_counts(spark):
    scores = K.read_vocabulary()
    texts = [(i, prose(i, 30) + " naïve 日本 \U0001f600 don't\n\n 42") for i in range(6)] + [(6, None), (7, "x" * 3000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    missing = K.PieceScores(scores).missing
    for remembered in (0, 300_000):
        rows = {r.doc_id: r for r in K.count_tokens(docs, scores, remembered=remembered).collect()}
        for key, text in texts[:7]:
            cut = regex.findall(K.PRE_TOKENS, text or "")
            assert "".join(cut) == (text or "") and rows[key].n_pretokens == len(cut)
            assert rows[key].n_tokens == sum(best_cut(w.encode(), scores, missing) for w in cut)
        assert rows[7].n_pretokens == 1


def test_scores_are_probabilities():
    import math

    assert abs(sum(map(math.exp, K.read_vocabulary().values())) - 1) < 1e-9
