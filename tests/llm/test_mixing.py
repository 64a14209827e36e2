import random

import pytest

from parcelion.llm.mixing import mix_sources, period, phases, whole_weights

from .plain import earliest_deadline


@pytest.mark.parametrize("weights", [[1], [3, 1], [6, 4, 4, 3, 3, 2, 2, 1, 1, 10], [1] * 7, [97, 2, 1], [50, *[1] * 50]])
def test_every_prefix_is_less_than_a_block_off(weights):
    total = sum(weights)
    slots = period(dict(enumerate(weights)))
    assert sorted(slot for own in slots.values() for slot in own) == list(range(total))
    for g, p in enumerate(weights):
        for k, slot in enumerate(slots[g]):
            assert k * total // p <= slot < -(-(k + 1) * total // p)
        for t in range(total + 1):
            assert abs(sum(slot < t for slot in slots[g]) * total - p * t) < total


def test_phases_give_the_slots_of_a_step_by_step_schedule():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randrange(1, 7)
        blocks, weights = [rng.randrange(0, 30) for _ in range(n)], [rng.randrange(1, 9) for _ in range(n)]
        expected = {pick: slot for slot, pick in enumerate(earliest_deadline(blocks, weights))}
        plan = phases(dict(enumerate(blocks)), dict(enumerate(weights)))
        for (g, block), slot in expected.items():
            own = [p for p in plan if p["g"] == g and p["first_block"] <= block][-1]
            k = block - own["first_block"]
            assert own["first_slot"] + k // own["weight"] * own["total"] + own["slots"][k % own["weight"]] == slot


def test_weights_as_whole_numbers():
    assert whole_weights([2, 3]) == [2, 3] and whole_weights([0.25, 0.75]) == [250, 750]
    with pytest.raises(ValueError):
        whole_weights([1, 0])


def test_a_source_with_a_third_of_all_rows(spark):
    sources = [("big" if i % 3 == 0 else f"s{i % 7}") for i in range(2000)]
    docs = spark.createDataFrame(list(enumerate(sources)), "doc_id long, source string")
    rows = mix_sources(docs, {"big": 2, "s1": 1}, 1, block_rows=8).collect()
    assert sorted(r.position for r in rows) == list(range(2000))
    assert all(r.release <= r.slot < r.deadline for r in rows)
    groups = {"big": [], "s1": [], "rest": []}
    for r in rows:
        groups[r.source if r.source in groups else "rest"].append(r)
    blocks = [-(-len(groups[g]) // 8) for g in ("big", "s1", "rest")]
    slots = earliest_deadline(blocks, [2, 1, 1])
    for number, g in enumerate(("big", "s1", "rest")):
        assert {(number, r.block): r.slot for r in groups[g]} == {pick: s for s, pick in enumerate(slots) if pick[0] == number}
    order = [r.doc_id for r in sorted(groups["big"], key=lambda r: r.position)]
    assert order != sorted(order)


def test_main_path_is_native(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, source string")
    plan = mix_sources(docs, {"a": 1})._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
