"""Cross-entropy scores and the quality classifier against plain counts, and on held-out labels."""

import math
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelion.llm import cross_entropy as C
from parcelion.llm import quality as Q
from parcelion.llm.words import NOT_PUNCTUATION, NOT_SPACE, Words

from .plain import lower, prose


def _hashes(words, table, fold):
    import pyarrow as pa

    return {w: int(Words(pa.array([w]), table, fold).hashes.view(np.int64)[0]) for w in words}


def _vocabulary(sentences, size, table, fold):
    counts = Counter(w for s in sentences for w in s)
    order = _hashes(counts, table, fold)
    return set(sorted((w for w, n in counts.items() if n > 1), key=lambda w: (-counts[w], order[w]))[:size])


def test_scores_equal_plain_counts(spark):
    texts = {i: prose(i % 9, 40 + i, vocabulary=30) for i in range(40)} | {40: "", 41: "Odd. Words, only!"}
    target = set(range(0, 40, 3))
    size = 25
    split = {i: re.findall(r"[^\x20\x09-\x0D.,;:!?\"'()]+", lower(t)) for i, t in texts.items()}
    known = _vocabulary(split.values(), size, NOT_PUNCTUATION, True)
    words = {i: [w if w in known else None for w in own] for i, own in split.items()}
    alone, pairs, before = ([Counter(), Counter()] for _ in range(3))
    for i, own in words.items():
        for side in {0, 1} if i in target else {1}:
            for h, w in zip([None, *own], own):
                alone[side][w] += 1
                if h is not None and w is not None:
                    pairs[side][h, w] += 1
                    before[side][h] += 1
    total = [sum(a.values()) for a in alone]
    scale = [1.0, total[0] / total[1]]

    def p(side, h, w):
        one = (alone[side][w] * scale[side] + 0.5) / (total[0] + 0.5 * (len(known) + 1))
        if h is None or w is None:
            return one
        return (pairs[side][h, w] * scale[side] + C.PRIOR * one) / (before[side][h] * scale[side] + C.PRIOR)

    expected = {
        i: sum(math.log(p(1, h, w)) - math.log(p(0, h, w)) for h, w in zip([None, *own], own)) / max(len(own), 1) for i, own in words.items()
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    ids = spark.createDataFrame([(i,) for i in target], "doc_id long")
    rows = C.score_documents(docs, ids, vocabulary=size).collect()
    assert {r.doc_id: r.n_words for r in rows} == {i: len(own) for i, own in split.items()}
    for r in rows:
        assert r.score == pytest.approx(1e6 * expected[r.doc_id], abs=2)


def test_perplexity_equals_plain_kneser_ney(spark):
    texts = {i: prose(i % 7, 60, vocabulary=40) for i in range(30)}
    size = 60
    split = {i: t.split() for i, t in texts.items()}
    known = _vocabulary(split.values(), size, NOT_SPACE, False)
    pairs = Counter((h, w) for own in split.values() for h, w in zip(own, own[1:]) if h in known and w in known)
    tokens = sum(map(len, split.values()))
    unknown = sum(w not in known for own in split.values() for w in own)
    discount = [0, *Q.discounts(Counter(pairs.values()))]
    p_unknown = (unknown + 1) / (tokens + 2)
    follows = Counter(w for _, w in pairs)
    low = {w: (1 - p_unknown) * (follows[w] + 0.5) / (len(pairs) + 0.5 * len(known)) for w in known}
    total = Counter()
    for (h, _), n in pairs.items():
        total[h] += n
    gamma = {h: sum(discount[min(n, 3)] for (x, _), n in pairs.items() if x == h) / total[h] for h in total}

    def p(h, w):
        if w not in known:
            return p_unknown / Q.UNKNOWN
        if h not in known or not total[h]:
            return low[w]
        n = pairs[h, w]
        return (1 - p_unknown) * (n - discount[min(n, 3)]) / total[h] * (n > 0) + gamma[h] * low[w]

    for h in list(known)[:5]:
        assert sum(p(h, w) for w in known) + p_unknown == pytest.approx(1)
    docs = spark.createDataFrame([(i, i, t) for i, t in texts.items()], "id long, h long, text string")
    model, gains = Q.train(docs, size)
    new = spark.createDataFrame([(99, 0, prose(3, 50, vocabulary=44)), (98, 0, "")], "id long, h long, text string")
    rows = {r.id: r for r in Q.losses(docs.union(new), model, gains).collect()}
    split |= {99: prose(3, 50, vocabulary=44).split(), 98: []}
    for i, own in split.items():
        assert rows[i].n == len(own)
        assert rows[i].loss == pytest.approx(1e6 * sum(-math.log(p(h, w)) for h, w in zip([None, *own], own)), abs=2 * len(own) + 1)


def test_discounts_stay_in_range():
    assert Q.discounts({}) == [0.5, 1.0, 1.5]
    for counts in ({1: 5}, {1: 1, 2: 9, 3: 1, 4: 50}, {1: 100, 2: 40, 3: 20, 4: 9}):
        assert all(0 < d < i for i, d in enumerate(Q.discounts(counts), 1))


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    judged = Q.classify(docs, labels).join(labels, "doc_id").join(Q.trusted_sample(labels), "doc_id", "left").filter("coalesce(train, false) = false")
    share = {r.quality: r.kept for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("kept")).collect()}
    assert share[1] > 0.98 and share[0] < 0.4
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns and 0.75 * docs.count() < kept.count() < docs.count()


def test_thresholds_see_every_trusted_document_not_trained_on(spark):
    # One document in ten is of the rare language: more labels must not cost it its own threshold, nor its places in the model.
    texts = [(i, prose(i, 30), "rare" if i % 10 == 0 else "hot") for i in range(3000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(4)
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    sample = Q.trusted_sample(labels, 200, docs.select("doc_id", "lang")).join(docs, "doc_id").groupBy("lang", "train").count().collect()
    found = {(r.lang, r.train): r["count"] for r in sample}
    assert sum(found.values()) == 3000 and found["rare", True] == found["hot", True] == 50
    judged = Q.classify(docs, labels, quantile=0.9, max_trusted=200)
    chosen = {r.doc_id for r in Q.trusted_sample(labels, 200, docs.select("doc_id", "lang")).filter("train").collect()}
    rows = [r for r in judged.collect() if r.doc_id not in chosen]
    for lang in ("rare", "hot"):
        own = [r for r in rows if r.lang == lang]
        limit = float(np.quantile([r.loss for r in own], 0.9))
        assert {r.threshold for r in own} == {math.ceil(limit)}


def test_equal_share():
    assert Q._equal_share({}, 10) == 1 and Q._equal_share({3: 2}, 10) == 3 and Q._equal_share({2: 1, 50: 2}, 12) == 5
    assert Q._equal_share({1: 100}, 10) == 1 and Q._equal_share({1: 1, 4: 1, 1000: 1}, 20) == 15


def test_scores_tell_rare_words_apart(spark):
    # The frequent words belong to a hot language; those of another one occur three times each.
    hot = [(i, " ".join(f"hot{(i * 83 + j) % 5000}" for j in range(400))) for i in range(60)]
    rare = [(100 + i, " ".join(f"{'like' if i < 6 else 'unlike'}{j % 300}" for j in range(i % 6, 300, 2))) for i in range(12)]
    docs = spark.createDataFrame(hot + rare, "doc_id long, text string").repartition(3)
    target = spark.createDataFrame([(i,) for i in [*range(60), *range(100, 105)]], "doc_id long")
    score = {r.doc_id: r.score for r in C.score_documents(docs, target).collect()}
    assert max(score[i] for i in range(100, 106)) + 100_000 < min(score[i] for i in range(106, 112))


def test_scores_without_a_vocabulary_equal_those_with_all_words(spark):
    # Every word occurs twice, so a large vocabulary holds them all.
    texts = [(i, prose(i % 9, 30, vocabulary=50)) for i in range(36)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    target = docs.filter("doc_id % 3 = 0").select("doc_id")
    everything, cut = (sorted(map(tuple, C.score_documents(docs, target, vocabulary=v).collect())) for v in (None, 10_000))
    assert everything == cut


def test_quality_holds_the_words_of_a_bounded_part_of_a_batch():
    """Rows go out for every 2 MB of text, and are the rows of each text alone."""
    taken = {}
    fields = {name: T.StructField(name, T.LongType()) for name in ("id", "h")}

    class Docs:
        sparkSession = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda value: SimpleNamespace(value=value)))

        schema = fields

        def mapInArrow(self, run, schema):
            taken["run"] = run

    none = np.zeros(0)
    Q._shard_rows(Docs(), Q.Model([], 0, 0, [0.5, 0.5, 0.5], none, np.zeros((0, 3)), none))
    texts = ["word " * 10_000] * 120
    batch = pa.RecordBatch.from_arrays([pa.array(range(120)), pa.array([0] * 120), pa.array(texts)], names=["id", "h", "text"])
    out = list(taken["run"](iter([batch])))
    assert max(part.num_rows for part in out) * 50_000 <= 2 << 20
    assert [n for part in out for n in part.column(5).to_pylist()] == [10_000] * 120


def test_all_trusted_documents_of_the_half_train_the_model(spark):
    labels = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    found = {r.train: r["count"] for r in Q.trusted_sample(labels).groupBy("train").count().collect()}
    assert sum(found.values()) == 60_000 and found[True] > 29_000


def test_all_repeated_words_are_known(spark):
    # 12,000 words, each twice and after one word only: a bigram of every one is known.
    text = " ".join(f"word{i}" for i in range(12_000))
    docs = spark.createDataFrame([(i, i, text) for i in range(2)] + [(9, 9, "single again")], "id long, h long, text string")
    model, gains = Q.train(docs)
    assert len(model.words) == 12_000 and model.pairs == gains.count() == 11_999
    # The two words that came once are unknown, and cost alike.
    new = spark.createDataFrame([(1, 1, "word7 word8"), (2, 2, "word8 word7"), (3, 3, "single"), (4, 4, "other")], "id long, h long, text string")
    loss = {r.id: r.loss for r in Q.losses(new, model, gains).collect()}
    assert loss[1] < loss[2] - 1_000_000 and loss[3] == loss[4] == model.unknown


@pytest.mark.parametrize("pairs", [20, 1 << 20])
def test_shards_give_what_the_sent_table_gives(spark, monkeypatch, pairs):
    """Also of rows that come twice, and with more shards than the least number."""
    texts = [(i, 7, prose(i % 11, 80, vocabulary=60)) for i in range(30)] + [(40, 7, ""), (41, 7, "New words"), (3, 7, prose(3, 80, vocabulary=60))]
    docs = spark.createDataFrame(texts, "id long, h long, text string").repartition(3)
    monkeypatch.setattr(Q, "SHARD_PAIRS", pairs)
    model, gains = Q.train(docs)
    assert (model.shards > Q.SHARDS) == (pairs == 20)
    sent = sorted(map(tuple, Q.losses(docs, model, gains).collect()))
    monkeypatch.setattr(Q, "PART_PAIRS", pairs)
    assert sorted(map(tuple, Q.losses(docs, model, gains).collect())) == sent
    monkeypatch.setattr(Q, "SENT_PAIRS", 0)
    assert sorted(map(tuple, Q.losses(docs, model, gains).collect())) == sent and len(sent) == 32
