import random

import numpy as np
import pytest

from parcelion.llm import minhash as M
from parcelion.llm.shingles import counted_keys, pivot_differences, pivot_keys, rare_keys
from parcelion.llm.words import mix

from .plain import prose, tokens


def _sets(text):
    words = tokens(text)
    return {tuple(words[i : i + 2]) for i in range(len(words) - 1)} if len(words) >= 2 else ({tuple(words)} if words else set())


def _components(texts):
    sets, parent = {k: _sets(t) for k, t in texts.items()}, {k: k for k in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names = sorted(texts)
    for i, x in enumerate(names):
        for y in names[:i]:
            if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                p, q = root(x), root(y)
                parent[max(p, q)] = min(p, q)
    return {k: root(k) for k in texts}


def _edited(rng, text, share):
    return " ".join(f"n{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


def test_estimates_follow_the_similarity():
    rng = np.random.default_rng(3)
    for common, only in [(0, 400), (300, 100), (800, 100), (900, 20), (500, 0)]:
        found = []
        for _ in range(20):
            values = mix(rng.integers(0, 2**63, common + 2 * only).astype(np.uint64))
            a, b = values[: common + only], np.concatenate([values[:common], values[common + only :]])
            rows = [np.frombuffer(M.signature(M.minima(x)), np.uint8)[None, :] for x in (a, b)]
            found.append(M.estimates(*rows)[0])
        assert abs(np.mean(found) - common / (common + 2 * only)) < 0.03
    assert 0.55 < M.least_estimate(80) < 0.65


def test_minima_do_not_depend_on_the_cut():
    values = mix(np.arange(2000, dtype=np.uint64))
    assert (M.minima(values) == np.minimum(M.minima(values[:700]), M.minima(values[700:]))).all()
    assert len(M.band_keys(M.minima(values))) == M.MINIMA // M.ROWS


def test_groups_equal_brute_force(spark):
    rng, texts = random.Random(5), {}
    for base in range(12):
        text = prose(base, rng.choice([1, 2, 3, 6, 40, 150, 400]))
        texts[len(texts)] = text
        for _ in range(rng.randrange(6)):
            texts[len(texts)] = _edited(rng, text, rng.choice([0, 0.02, 0.04, 0.06]))
    star = prose("star", 300)
    for _ in range(60):
        texts[len(texts)] = _edited(rng, star, rng.choice([0.03, 0.06, 0.12, 0.2]))
    texts |= {len(texts): star, len(texts) + 1: None, len(texts) + 2: "", len(texts) + 3: texts[0].upper()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    rows = {r.doc_id: r for r in M.near_duplicates(docs).collect()}
    assert {k: r.component_id for k, r in rows.items()} == _components(texts)
    assert {k: r.n_shingles for k, r in rows.items()} == {k: len(_sets(t)) for k, t in texts.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows.values())


def test_many_rows_of_two_texts_are_one_pair(spark, monkeypatch):
    asked = []
    confirmed = M._confirmed
    monkeypatch.setattr(M, "_confirmed", lambda pairs, texts, *rest: asked.append((pairs.count(), texts.count())) or confirmed(pairs, texts, *rest))
    one = prose("one", 100)
    rows = [(3, one)] * 300 + [(4, one + " end")] * 300 + [(None, one)] * 5
    found = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == 605 and {r.component_id for r in found} == {3}
    assert asked == [(1, 2)]


@pytest.mark.parametrize("cells", [None, 4, 1 << 20])
def test_keys_meet_in_every_alike_pair(spark, cells):
    rng = random.Random(11)
    base = prose("base", 60)
    texts = {i: _edited(rng, base, rng.choice([0, 0.02, 0.05, 0.1, 0.3])) for i in range(40)} | {99: "k l m n o p q r s t u"}
    sets = {i: _sets(t) for i, t in texts.items()}
    members = spark.createDataFrame([(i, i, len(s)) for i, s in sets.items()], "node long, label long, n long")
    frame = spark.createDataFrame(list(texts.items()), "node long, text string")
    rows = (rare_keys(members, frame, 2, 80) if cells is None else counted_keys(frame, 2, 80, cells)).collect()
    keys = {i: {(r.key, r.short) for r in rows if r.node == i} for i in texts}
    assert not keys[99]
    for x in texts:
        for y in texts:
            if (len(sets[x]), x) < (len(sets[y]), y) and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                assert {k for k, short in keys[x] if short} & {k for k, _ in keys[y]}


@pytest.mark.parametrize("percent", [75, 80])
def test_pivot_keys_meet_in_every_alike_pair(spark, percent):
    rng, base = random.Random(percent), prose("base", 60)
    texts = {0: _edited(rng, base, 0.02)}
    for i in range(1, 50):
        text = texts[rng.randrange(i)] if rng.random() < 0.4 else base
        text = _edited(rng, text, rng.choice([0.02, 0.04, 0.08, 0.12])).split()
        cut = rng.choice([0, 0, 3, 6])
        texts[i] = " ".join(w for w in text[cut:] if rng.random() > 0.02)
    sets = {i: _sets(t) for i, t in texts.items()}

    def alike(x, y):
        return 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y])

    label = {i: 0 if alike(0, i) else i for i in texts}
    members = spark.createDataFrame([(7, i, len(s), label[i], i) for i, s in sets.items()], "key long, node long, n int, label long, rank int")
    frame = spark.createDataFrame(list(texts.items()), "node long, text string")
    differences = pivot_differences(members, frame, 2, percent).cache()
    assert {r.node: (r.pivot, r.cost <= r.free, len(r.apart)) for r in differences.collect()} == {
        i: (0, label[i] == 0, len(sets[i] ^ sets[0])) for i in texts if i
    }
    keys = {i: [] for i in texts}
    for r in pivot_keys(differences, percent).collect():
        keys[r.node].append(r)

    def meet(a, b):
        return a.key == b.key and (a.side is None or a.side != b.side) and 2 * (100 + percent) * (1 + min(a.rest, b.rest)) >= a.need + b.need

    pairs = [(x, y) for x in texts for y in texts if 0 < x < y and label[x] != label[y] and alike(x, y)]
    assert len(pairs) > 5
    assert all(any(meet(a, b) for a in keys[x] for b in keys[y]) for x, y in pairs)


def test_unlinked_copies_of_a_text_are_not_all_compared(spark, monkeypatch):
    asked = []
    estimated = M._estimated
    monkeypatch.setattr(M, "_estimated", lambda pairs, *rest: asked.append(pairs.count()) or estimated(pairs, *rest))
    rng, base = random.Random(3), prose("base", 150)
    texts = {i: _edited(rng, base, rng.choice([0.065, 0.07, 0.08])) for i in range(240)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    assert {r.doc_id: r.component_id for r in M.near_duplicates(docs).collect()} == _components(texts)
    # After the rounds on bands and on exact keys.
    assert sum(asked[2:]) < 4 * len(texts), asked
