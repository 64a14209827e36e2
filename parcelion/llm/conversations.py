"""Conversation structure repair by rank-convergence parallel Viterbi.

The rows of a conversation, by turn, are a path through four states: begin, after a system row, after a user row, after an
assistant row. Edits cost: Keep 0, Rerole (to user or assistant) 2, Delete 3, Insert an empty user or assistant row 2; a truncated row that
stays adds 1; blank and duplicate rows must go. The cheapest path ends at the begin or after an assistant row.

Rows are range partitioned by conversation and place and cut into chunks of at most ``CHUNK_ROWS`` rows and about
``CHUNK_BYTES`` of text, so a conversation of any length is spread over tasks. Each chunk computes its backward costs (the cheapest
way to the end, by state) from a speculative vector, that of a conversation's end. Fix-up passes hand every chunk the
vector that the next one found for its first row; a chunk runs again, until its new vector differs from the old one only by a constant: all rows
before that are right up to a constant. Passes end when no vector is wrong. Vectors are kept less their minimum, so
"differs by a constant" is equality, and there are so few of them that the step of a row is a table of its own making.

Tracing goes forwards, taking at each state the least edit in ASCII order that the stitched backward costs allow. A chunk is
traced from each state it may be entered in; the maps from entry to exit are composed by doubling. Chunks of one conversation
meet in one task only at the end, one after another, for the digest.

Defined results: null roles and texts are one space; rows of a turn are ordered by role and MD5 of the text, null turns come first; rows equal in
all are one after another and all but the first are duplicates; a null conversation is a conversation of its own; roles that begin with none
of s, u, a cannot be kept; gaps count no null turn and are 0 when all are null; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelion.session import stage_table

CHUNK_ROWS, CHUNK_BYTES = 2048, 1 << 20
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
BLANKS = " \t\n\x0b\x0c\r"
# States 0 to 3: begin, system, user, assistant. An inserted or reroled row leads on to the state NEXT names.
NEXT = (2, 2, 3, 2)
# What is left to pay at the end of a conversation.
END = (0, 4, 2, 0)
# Row codes: the initial's kind (0 other, 1 s, 2 u, 3 a), four more if truncated; 8 must go.
GONE = 8
_INITIAL = {2: "user", 3: "assistant"}


def _edits(code: int, state: int):
    """(letter, cost, next state) of the edits of a row, in ASCII order without Insert."""
    yield "D", DELETE, state
    if code != GONE:
        more, kind = (TRUNCATED if code >= 4 else 0), code % 4
        if (kind == 1 and state == 0) or (kind in (2, 3) and NEXT[state] == kind):
            yield "K", more, kind
        yield "R", REROLE + more, NEXT[state]


@lru_cache(maxsize=None)
def back(code: int, after: tuple) -> tuple:
    """Costs before a row from those after it, less their minimum, and that minimum."""
    own = [min(cost + after[to] for _, cost, to in _edits(code, state)) for state in range(4)]
    # Two inserts in a row lead from any state to any that an insert can reach.
    for _ in range(2):
        own = [min(cost, INSERT + own[NEXT[state]]) for state, cost in enumerate(own)]
    least = min(own)
    return tuple(cost - least for cost in own), least


@lru_cache(maxsize=None)
def forward(code: int, state: int, after: tuple) -> tuple[str, int, int]:
    """Edits before and of a row (least letters first), their cost and the state after it."""
    before, least = back(code, after)
    letters, paid = "", 0
    while True:
        left = before[state] + least
        moves = {letter: (cost, to) for letter, cost, to in _edits(code, state) if cost + after[to] == left}
        insert = INSERT + before[NEXT[state]] + least == left
        letter = min([*moves, *("I" if insert else "")])
        letters += letter
        if letter != "I":
            return letters, paid + moves[letter][0], moves[letter][1]
        paid, state = paid + INSERT, NEXT[state]


def backwards(codes: bytes, end: tuple) -> list[tuple]:
    """The vector after each row, and at last the one before the first: from the last row to the first."""
    found = [end]
    for code in reversed(codes):
        found.append(back(code, found[-1])[0])
    return found


def fixed_up(codes: bytes, old_end: tuple, new_end: tuple, start: tuple) -> tuple:
    """The vector before the first row when ``new_end`` stands for ``old_end``; stops where the two runs meet."""
    for code in reversed(codes):
        if old_end == new_end:
            return start
        old_end, new_end = back(code, old_end)[0], back(code, new_end)[0]
    return new_end


def trace(codes: bytes, state: int, end: tuple, closes: bool) -> tuple[list[str], int, int]:
    """Letters of each row, with those after the last row at the end; cost; last state."""
    after, letters, paid = backwards(codes, end)[:-1][::-1], [], 0
    for code, vector in zip(codes, after):
        found, cost, state = forward(code, state, vector)
        letters.append(found)
        paid += cost
    tail = ""
    while closes and END[state]:
        tail, paid, state = tail + "I", paid + INSERT, NEXT[state]
    return [*letters, tail], paid, state


def _faults(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, digest, kind, fault, copies): equal rows once; fault 1 blank, 2 duplicate, 3 truncated, of the first copy."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit(" ")), F.coalesce(F.col("role").cast("string"), F.lit(" "))
    rows = rows.select("conv", "turn", role.alias("role"), text.alias("text"))
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies")).withColumn("digest", F.md5("text"))
    rows = stage_table(rows, "turns")
    place = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    seen = rows.groupBy("conv", "role", "digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("often")).filter("often > 1")
    seen = stage_table(seen.select(F.col("conv").alias("s_conv"), F.col("role").alias("s_role"), F.col("digest").alias("s_digest"), "first"), "seen")
    match = rows["conv"].eqNullSafe(seen["s_conv"]) & (rows["role"] == seen["s_role"]) & (rows["digest"] == seen["s_digest"])
    rows = rows.join(seen, match, "left")
    said, initial = F.rtrim("text", F.lit(BLANKS)), F.substring("role", 1, 1)
    fault = (
        F.when(said == "", 1).when(place != F.col("first"), 2)
        .when(~F.substring(said, -1, 1).isin(".", "!", "?"), 3).otherwise(0)
    )
    kind = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    rows = rows.select("conv", "turn", "role", "text", "digest", "copies", kind.alias("kind"), fault.alias("fault"))
    kept = F.col("fault").isin(0, 3)
    return rows.withColumns({"text": F.when(kept, F.col("text")), "shown": F.when(kept, F.col("role"))})


_CHUNK = [
    ("part", "int"), ("number", "long"), ("opens", "boolean"), ("closes", "boolean"), ("codes", "binary"), ("copies", "array<long>"),
    ("roles", "array<string>"), ("texts", "array<string>"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"), ("illegal", "long"),
    ("first_kind", "int"), ("last_kind", "int"), ("first_turn", "long"), ("last_turn", "long"), ("low_turn", "long"), ("turns", "long"),
]


def _chunked(rows: DataFrame) -> DataFrame:
    """Rows (conv and _CHUNK) of at most CHUNK_ROWS rows of one conversation. ``opens`` and ``closes`` tell whether the chunk is its conversation's
    first and last one; null at the edges of a partition, where the neighbour is elsewhere."""
    schema = T.StructType([rows.schema["conv"], *(T.StructField(n, T._parse_datatype_string(t)) for n, t in _CHUNK)])
    names = schema.fieldNames()

    def emit(table: pa.Table, begins: np.ndarray, ends: np.ndarray, fresh: np.ndarray, part: int, number: int, last: bool):
        # ``fresh``: rows at which a conversation begins; the first row of the partition is counted as one.
        col = {n: table.column(n).combine_chunks() for n in table.column_names}
        fault, kind, copies = (col[n].to_numpy().astype(np.int64) for n in ("fault", "kind", "copies"))
        null = np.asarray(col["turn"].is_null())
        turn = pc.fill_null(col["turn"], 0).to_numpy()
        top = int(ends[-1])
        offsets = np.append(begins, top).astype(np.int32)
        code = np.where((fault == 1) | (fault == 2), GONE, kind + 4 * (fault == 3)).astype(np.uint8)
        total = lambda values: pa.array(np.add.reduceat(values[:top], begins).astype(np.int64))
        inner = np.ones(len(turn), bool)
        inner[begins] = False
        before = np.concatenate([[0], kind[:-1]])
        legal = ((before == 1) & (kind == 2)) | ((before == 2) & (kind == 3)) | ((before == 3) & (kind == 2))
        new_turn = ~null & ~(inner & np.concatenate([[False], (turn[1:] == turn[:-1]) & ~null[:-1]]))
        low = np.minimum.reduceat(np.where(null, np.iinfo(np.int64).max, turn)[:top], begins)
        opens = fresh[begins]
        closes = np.append(fresh, True)[ends]
        unknown_open = np.zeros(len(begins), bool)
        unknown_open[0] = number == 0
        unknown_close = np.zeros(len(begins), bool)
        unknown_close[-1] = last
        lists = lambda values: pa.ListArray.from_arrays(pa.array(offsets), values.slice(0, top))
        at = lambda values, where: pa.array(values[where], mask=null[where]) if values is turn else pa.array(values[where].astype(np.int32))
        return pa.RecordBatch.from_arrays([
            col["conv"].take(pa.array(begins)), pa.array(np.full(len(begins), part, np.int32)), pa.array(number + np.arange(len(begins))),
            pa.array(opens, mask=unknown_open), pa.array(closes, mask=unknown_close),
            pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(code[:top].tobytes())]),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(copies[:top])), lists(col["shown"]), lists(col["text"]),
            total(np.where(fault == 1, copies, 0)),
            # All copies of a row but the first are duplicates, unless blank.
            total(np.where(fault == 2, copies, np.where(fault == 1, 0, copies - 1))), total((fault == 3).astype(np.int64)),
            total((inner & ~legal) + copies - 1), at(kind, begins), at(kind, ends - 1), at(turn, begins), at(turn, ends - 1),
            pa.array(low, mask=low == np.iinfo(np.int64).max), total(new_turn.astype(np.int64)),
        ], names=names)

    def run(stream):
        part, number, held, running = TaskContext.get().partitionId(), 0, None, False
        for batch in stream:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            conv, size = table.column("conv").combine_chunks(), table.num_rows
            null = np.asarray(conv.is_null())
            differs = np.asarray(pc.fill_null(pc.not_equal(conv.slice(1), conv.slice(0, size - 1)), False)) | (null[1:] != null[:-1])
            fresh = np.concatenate([[not running], differs])
            starts = np.flatnonzero(np.concatenate([[True], differs]))
            run_of = np.repeat(starts, np.diff(np.append(starts, size)))
            weight = np.asarray(pc.fill_null(pc.binary_length(table.column("text").combine_chunks()), 0), dtype=np.int64)
            used = np.cumsum(weight) - weight
            cut = np.stack([(np.arange(size) - run_of) // CHUNK_ROWS, (used - used[run_of]) // CHUNK_BYTES])
            begins = np.flatnonzero(np.concatenate([[True], differs | (cut[:, 1:] != cut[:, :-1]).any(axis=0)]))
            if len(begins) > 1:
                yield emit(table, begins[:-1], begins[1:], fresh, part, number, False)
                number += len(begins) - 1
                running = not fresh[begins[-1]]
            held = table.slice(begins[-1])
        if held is not None:
            fresh = np.zeros(held.num_rows, bool)
            fresh[0] = not running
            yield emit(held, np.array([0]), np.array([held.num_rows]), fresh, part, number, True)

    keys = ["conv", "turn", "role", "digest"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return rows.select("conv", "turn", "kind", "fault", "copies", "shown", "text").mapInArrow(run, schema)


def _vectors(chunks: DataFrame, wanted: bool) -> DataFrame:
    """(place, conv, codes, closes, end, start): backward costs of chunks from their end, or, if ``wanted``, those of chunks whose end was wrong."""
    schema = T.StructType([
        T.StructField("place", T.LongType()), chunks.schema["conv"], T.StructField("codes", T.BinaryType()), T.StructField("closes", T.BooleanType()),
        T.StructField("end", T.ArrayType(T.IntegerType())), T.StructField("start", T.ArrayType(T.IntegerType())),
    ])

    def run(stream):
        for batch in stream:
            codes = [c.as_py() for c in batch.column(2)]
            ends = [tuple(e) for e in batch.column(4).to_pylist()]
            if wanted:
                new = [e if w is None else tuple(w) for e, w in zip(ends, batch.column(6).to_pylist())]
                starts = [fixed_up(c, e, w, tuple(s)) for c, e, w, s in zip(codes, ends, new, batch.column(5).to_pylist())]
            else:
                new, starts = ends, [backwards(c, e)[-1] for c, e in zip(codes, ends)]
            vector = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), pa.array(new, vector), pa.array(starts, vector)], names=schema.fieldNames()
            )

    return chunks.mapInArrow(run, schema)


def _converged(edges: DataFrame) -> DataFrame:
    """Chunks (place, conv, codes, closes) with the vector ``end`` after their last row."""
    end = F.array(*[F.lit(c) for c in END])
    state = stage_table(_vectors(edges.select("place", "conv", "codes", "closes", end.alias("end")), False), "vectors")
    while True:
        after = state.select((F.col("place") - 1).alias("place"), F.col("conv").alias("n_conv"), F.col("start").alias("wanted"))
        after = after.join(state.select("place", "conv", "closes"), "place").filter(F.col("conv").eqNullSafe(F.col("n_conv"))).select("place", "wanted")
        asked = stage_table(state.join(after, "place", "left"), "asked")
        if asked.filter("wanted <> end").isEmpty():
            return asked.select("place", "conv", "codes", F.col("wanted").isNull().alias("closes"), "end")
        asked = asked.select("place", "conv", "codes", "closes", "end", "start", F.when(F.col("wanted") != F.col("end"), F.col("wanted")).alias("wanted"))
        state = stage_table(_vectors(asked, True), "vectors")


def _entries(chunks: DataFrame) -> DataFrame:
    """(place, entry): the state in which each chunk (place, conv, codes, closes, end) is entered."""

    def run(stream):
        for batch in stream:
            maps = [
                [trace(c, s, tuple(e), False)[2] for s in range(4)]
                for c, e in zip((c.as_py() for c in batch.column(2)), batch.column(4).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(2)), pa.array(maps, pa.list_(pa.int32()))], names=["place", "conv", "map"])

    schema = T.StructType([T.StructField("place", T.LongType()), chunks.schema["conv"], T.StructField("map", T.ArrayType(T.IntegerType()))])
    maps, reach = stage_table(chunks.select("place", "conv", "codes", "closes", "end").mapInArrow(run, schema), "maps"), 1
    while True:
        before = maps.select((F.col("place") + reach).alias("place"), F.col("conv").alias("b_conv"), F.col("map").alias("first"))
        joined = maps.join(before, "place", "left").withColumn("first", F.when(F.col("conv").eqNullSafe(F.col("b_conv")), F.col("first")))
        whole = F.when(F.col("first").isNull(), F.col("map")).otherwise(F.transform("first", lambda s: F.element_at("map", s + 1)))
        joined = stage_table(joined.select("place", "conv", whole.alias("map"), F.col("first").isNotNull().alias("more")), "maps")
        if joined.filter("more").isEmpty():
            break
        maps, reach = joined.drop("more"), 2 * reach
    before = maps.select((F.col("place") + 1).alias("place"), F.col("conv").alias("b_conv"), F.element_at("map", 1).alias("exit"))
    entry = F.when(F.col("conv").eqNullSafe(F.col("b_conv")), F.col("exit")).otherwise(0)
    return maps.join(before, "place", "left").select("place", F.coalesce(entry, F.lit(0)).alias("entry"))


_PIECE = [
    ("place", "long"), ("audit", "string"), ("cost", "long"), ("turns", "array<struct<role:string,text:string>>"),
]


def _traced(chunks: DataFrame, more: list[str]) -> DataFrame:
    """Chunks (place, codes, copies, roles, texts, entry, end, closes, then ``more``) as pieces: audit, cost, repaired turns, ``more``."""
    schema = T.StructType([*(T.StructField(n, T._parse_datatype_string(t)) for n, t in _PIECE), *(chunks.schema[c] for c in more)])
    turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(stream):
        for batch in stream:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            audits, costs, turns = [], [], []
            for row in range(batch.num_rows):
                codes, copies = col["codes"][row].as_py(), col["copies"][row].as_py()
                roles, texts, state = col["roles"][row].as_py(), col["texts"][row].as_py(), col["entry"][row].as_py()
                letters, paid, _ = trace(codes, state, tuple(col["end"][row].as_py()), col["closes"][row].as_py())
                told, out = [], []
                for i, found in enumerate(letters):
                    for letter in found:
                        if letter == "I":
                            state = NEXT[state]
                            out.append((_INITIAL[state], ""))
                        elif letter != "D":
                            state = NEXT[state] if letter == "R" else codes[i] % 4
                            out.append((_INITIAL[state] if letter == "R" else roles[i], texts[i]))
                    told.append(found)
                    if i < len(codes) and copies[i] > 1:
                        told.append("D" * (copies[i] - 1))
                        paid += DELETE * (copies[i] - 1)
                audits.append("".join(told))
                costs.append(paid)
                turns.append([{"role": r, "text": t} for r, t in out])
            yield pa.RecordBatch.from_arrays(
                [col["place"], pa.array(audits, pa.string()), pa.array(costs, pa.int64()), pa.array(turns, turn), *(col[c] for c in more)],
                names=schema.fieldNames(),
            )

    return chunks.mapInArrow(run, schema)


_FIGURES = ["blank", "duplicate", "truncated", "illegal"]
_SPAN = ["first_kind", "last_kind", "first_turn", "last_turn", "low_turn", "n_turns"]


def repaired_pieces(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Chunks of repaired conversations: ``conv``, ``place`` (ascending within a conversation), ``whole`` (the conversation's only one), ``audit``, ``cost``,
    ``turns`` (role, text), and the chunk's figures. ``rows`` has ``id_col``, turn, role and text."""
    rows = rows.select(F.col(id_col).alias("conv"), F.col("turn").cast("long").alias("turn"), "role", "text")
    chunks = stage_table(_chunked(_faults(rows)).withColumnRenamed("turns", "n_turns"), "chunks")
    # One row per partition: the number of its first chunk among all.
    counts = chunks.groupBy("part").agg(F.count(F.lit(1)).alias("chunks"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("chunks").over(order), F.lit(0)).alias("offset"))
    chunks = chunks.join(stage_table(offsets, "offsets"), "part").withColumn("place", F.col("offset") + F.col("number")).drop("part", "number", "offset")
    whole = F.coalesce(F.col("opens") & F.col("closes"), F.lit(False))
    more = ["conv", "whole", *_FIGURES, *_SPAN]
    columns = ["place", "codes", "copies", "roles", "texts", "entry", "end", "closes", *more]
    alone = chunks.filter(whole).withColumns({
        "entry": F.lit(0), "end": F.array(*[F.lit(c) for c in END]), "closes": F.lit(True), "whole": F.lit(True),
    })
    edges = chunks.filter(~whole).drop("closes").withColumn("whole", F.lit(False))
    narrow = stage_table(chunks.filter(~whole).select("place", "conv", "codes", "closes"), "edges")
    solved = stage_table(_converged(narrow), "solved")
    solved = solved.join(_entries(solved), "place").select("place", "end", "entry", "closes")
    return _traced(alone.select(*columns).unionByName(edges.join(stage_table(solved, "entered"), "place").select(*columns)), more)


def repaired_turns(pieces: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Rows (``id_col``, place, number, role, text) of the repaired conversations; ordered by place and number."""
    rows = pieces.select(F.col("conv").alias(id_col), "place", F.posexplode("turns").alias("number", "turn"))
    return rows.select(id_col, "place", "number", "turn.role", "turn.text")


def report(pieces: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. Conversations of several
    chunks are digested chunk by chunk, by a task that holds one chunk and the audit."""
    gap = F.coalesce(F.col("high_turn") - F.col("low_turn") + 1 - F.col("n_turns"), F.lit(0)).cast("long").alias("gaps")
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    figures = [*_FIGURES, "cost", "audit"]
    alone = pieces.filter("whole").withColumn("high_turn", F.col("last_turn"))
    alone = alone.select(F.col("conv").alias(id_col), gap, *figures, F.sha2(lines, 256).alias("repaired_sha256"))
    schema = T.StructType([
        T.StructField(id_col, pieces.schema["conv"].dataType),
        *(T.StructField(n, T.LongType()) for n in ("gaps", *_FIGURES, "cost")), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
    ])

    def run(stream):
        def closed():
            spread = known["high"] - known["low"] + 1 - known["turns"] if known["low"] is not None else 0
            values = [key, spread, *(known[n] for n in _FIGURES), known["cost"], "".join(known["audit"]), known["digest"].hexdigest()]
            return pa.RecordBatch.from_arrays([pa.array([v], f) for v, f in zip(values, types)], names=schema.fieldNames())

        known, key, types = None, None, None
        for batch in stream:
            types = types or [batch.schema.field(0).type, *[pa.int64()] * 6, pa.string(), pa.string()]
            for i in range(batch.num_rows):
                row = {n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}
                if known is None or row["conv"] != key:
                    if known is not None:
                        yield closed()
                    key = row["conv"]
                    known = dict.fromkeys([*_FIGURES, "cost", "turns"], 0) | {"low": None, "high": None, "audit": [], "digest": hashlib.sha256(), "some": False, "kind": None}
                for name in (*_FIGURES, "cost"):
                    known[name] += row[name]
                known["turns"] += row["n_turns"]
                if known["kind"] is not None:
                    known["illegal"] += (known["kind"], row["first_kind"]) not in ((1, 2), (2, 3), (3, 2))
                    known["turns"] -= row["first_turn"] is not None and row["first_turn"] == known["high"]
                known["kind"] = row["last_kind"]
                known["low"] = row["low_turn"] if known["low"] is None else known["low"]
                known["high"] = known["high"] if row["last_turn"] is None else row["last_turn"]
                known["audit"].append(row["audit"])
                if row["lines"]:
                    known["digest"].update((b"\n" if known["some"] else b"") + row["lines"].encode())
                    known["some"] = True
        if known is not None:
            yield closed()

    rest = pieces.filter("NOT whole").select("conv", "place", lines.alias("lines"), *figures, "first_kind", "last_kind", "first_turn", "last_turn", "low_turn", "n_turns")
    rest = rest.repartition("conv").sortWithinPartitions("conv", "place").mapInArrow(run, schema)
    return alone.unionByName(rest)


def repair(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """The report of all conversations in ``rows`` (``id_col``, turn, role, text)."""
    return report(repaired_pieces(rows, id_col), id_col)
