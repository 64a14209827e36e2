import random
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelion.llm import conversations as C

from .plain import conversation_report, repaired

ROLES = {0: "tool", 1: "system", 2: "user", 3: "assistant"}


@given(st.lists(st.integers(0, 8), max_size=7), st.integers(0, 7))
@settings(deadline=None, max_examples=500)
def test_trace_is_the_least_of_the_cheapest(codes, cut):
    """Backward costs and forward trace of one or two chunks against all edits."""
    rows = [(ROLES[c % 4], "t", "blank" if c == 8 else "truncated" if c >= 4 else "") for c in codes]
    cost, audit, _ = repaired(rows)
    letters, paid, _ = C.trace(bytes(codes), 0, C.END, True)
    assert (paid, "".join(letters)) == (cost, audit)
    cut = min(cut, len(codes))
    right = C.backwards(bytes(codes[cut:]), C.END)[-1]
    first, part, state = C.trace(bytes(codes[:cut]), 0, right, False)
    second, rest, _ = C.trace(bytes(codes[cut:]), state, C.END, True)
    assert (part + rest, "".join(first + second)) == (cost, audit)


@given(st.binary(max_size=30).map(lambda b: bytes(x % 9 for x in b)), st.integers(0, 10**6))
@settings(deadline=None, max_examples=300)
def test_fix_up_stops_only_where_vectors_are_parallel(codes, seed):
    vectors = [C.backwards(bytes([c, d]), C.END)[-1] for c, d in product(range(9), repeat=2)]
    rng = random.Random(seed)
    old, new = rng.choice(vectors), rng.choice(vectors)
    start = C.backwards(codes, old)[-1]
    assert C.fixed_up(codes, old, new, start) == C.backwards(codes, new)[-1]


def _talk(rng, size, conv):
    rows, turn = [], rng.randrange(5)
    for _ in range(size):
        turn += rng.choice([0, 1, 1, 1, 1, 2])
        role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "a", ""])
        text = rng.choice(["Yes.", "No!", "Why", " \t", "", f"{turn} more?", f"cut {turn}", "é\n.\x0b"])
        rows.append((conv, None if rng.random() < 0.03 else turn, role, text))
    return rows


@pytest.mark.parametrize("chunk", [1, 3, 2048])
def test_report_equals_plain_edits(spark, monkeypatch, chunk):
    """Small chunks send long conversations through fix-up passes, entry maps and the joint digest."""
    monkeypatch.setattr(C, "CHUNK_ROWS", chunk)
    rng = random.Random(chunk)
    rows = [row for conv in range(60) for row in _talk(rng, rng.choice([1, 2, 3, 5, 8, 13]), conv)]
    rows += _talk(rng, 150, 99) + _talk(rng, 40, None) + [(77, 5, "tool", f"the same role {i}") for i in range(25)]
    rows += [(78, 1, "user", "again.")] * 30 + [(79, i, "user", "again.") for i in range(30)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    pieces = C.repaired_pieces(frame)
    found = {r.conv_id: r.asDict() for r in C.report(pieces).collect()}
    digest = frame.select("*", F.md5("text").alias("digest")).collect()
    by_conv = {}
    for row in digest:
        by_conv.setdefault(row.conv_id, []).append(row)
    assert set(found) == set(by_conv)
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r.turn is not None, r.turn or 0, r.role, r.digest))
        assert found[conv] == {"conv_id": conv} | conversation_report([(r.turn, r.role, r.text) for r in own]), conv
    turns = {}
    for row in sorted(C.repaired_turns(pieces).collect(), key=lambda r: (r.place, r.number)):
        turns.setdefault(row.conv_id, []).append(row.role[0])
    for initials in turns.values():
        kept = initials[1:] if initials[0] == "s" else initials
        assert kept == ["u", "a"] * (len(kept) // 2)


def test_chunks_bound_text(spark, monkeypatch):
    monkeypatch.setattr(C, "CHUNK_BYTES", 1000)
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"{i}" + "x" * 400 + ".") for i in range(40)]
    pieces = C.repaired_pieces(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert max(r.n for r in pieces.select(F.size("turns").alias("n")).collect()) <= 4
    assert C.report(pieces).first().audit == "K" * 40
