"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of ``block_rows`` documents in pseudo-random order. With weight p of a
total P, the k-th block of a source is released at slot floor(k P / p) and due by slot
ceil((k + 1) P / p). Earliest deadline first fills every slot in time, so that after any number of
slots each source is less than one block away from its share.

The schedule repeats after P slots, so one period is laid out (P steps, however many documents there
are) and a block's slot is computed from it. When a source is used up, the remaining ones go on with their
weights among themselves, in a new phase. Every document is placed exactly once.

Sources without a weight of their own, null among them, are one group with ``default_weight``. So the
period, the phases and what is broadcast are bounded by the given weights alone.

Defined results: documents with null id come first in their block order; repeated rows take
places of their own; an empty table gives an empty result; other columns pass through, and where one is
named like one of ``PLACES``, the added column gets underscores before its name. Only DataFrame functions handle rows.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columns import free_name

BLOCK_ROWS = 16
RESOLUTION = 1000
_BUCKET_ROWS = 1 << 16

PLACES = ["block", "slot", "release", "deadline", "position"]


def whole_weights(weights: list[float]) -> list[int]:
    """Weights as whole numbers: as they are, or in parts of RESOLUTION."""
    if any(w <= 0 for w in weights):
        raise ValueError("weights must be positive")
    if all(float(w).is_integer() and w <= RESOLUTION for w in weights):
        return [int(w) for w in weights]
    return [max(1, round(w * RESOLUTION / sum(weights))) for w in weights]


def period(weights: dict[int, int]) -> dict[int, list[int]]:
    """Slots of each group's blocks in one period: earliest deadline first among the released."""
    total = sum(weights.values())
    slots: dict[int, list[int]] = {g: [] for g in weights}
    for slot in range(total):
        ready = [
            (-(-(len(slots[g]) + 1) * total // p), g)
            for g, p in weights.items()
            if len(slots[g]) < p and len(slots[g]) * total // p <= slot
        ]
        slots[min(ready)[1]].append(slot)
    return slots


def phases(blocks: dict[int, int], weights: dict[int, int]) -> list[dict]:
    """One entry per phase and active group: its first block and slot in the phase and the period."""
    used, start, plan = {g: 0 for g in blocks if blocks[g]}, 0, []
    while used:
        active = {g: weights[g] for g in used}
        total, slots = sum(active.values()), period(active)

        def place(group: int, k: int) -> int:
            return k // active[group] * total + slots[group][k % active[group]]  # noqa: B023

        length = min(place(g, blocks[g] - used[g] - 1) for g in used) + 1
        plan += [
            {"g": g, "first_block": used[g], "first_slot": start, "total": total, "weight": active[g], "slots": slots[g]}
            for g in used
        ]
        for g in used:
            used[g] += length // total * active[g] + sum(slot < length % total for slot in slots[g])
        start += length
        used = {g: n for g, n in used.items() if n < blocks[g]}
    return plan


def _literal(rows: list[dict], schema: str) -> Column:
    return F.from_json(F.lit(json.dumps(rows)), schema)


def mix_sources(
    docs: DataFrame,
    weights: dict[str, float],
    default_weight: float = 1,
    id_col: str = "doc_id",
    source_col: str = "source",
    block_rows: int = BLOCK_ROWS,
    seed: str = "mix",
) -> DataFrame:
    """``docs`` and, as the last columns, ``block`` (number within the source), ``slot``, ``release``, ``deadline`` and ``position`` (0, 1, ...)."""
    spark = docs.sparkSession
    names = sorted(weights)
    numbers = whole_weights([*(weights[name] for name in names), default_weight])
    group = F.lit(len(names))
    for number, name in enumerate(names):
        group = F.when(F.col(source_col) == name, number).otherwise(group)

    counts = {row["g"]: row["n"] for row in docs.groupBy(group.alias("g")).agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = {g: -(-n // block_rows) for g, n in counts.items()}
    plan = phases(blocks, dict(enumerate(numbers)))

    # Number the documents of each group without bringing a group together: buckets of the order,
    # counted first, give each bucket its offset.
    digits = max(2, math.ceil(math.log(max([1, *counts.values()]) / _BUCKET_ROWS, 16)))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    tie = F.xxhash64(*[c for c, f in zip(docs.columns, docs.schema) if not isinstance(f.dataType, (T.MapType, T.VariantType))])
    keyed = docs.withColumns({"__g": group, "__h": order, "__tie": tie})
    keyed = keyed.withColumn("__bucket", F.substring("__h", 1, digits))
    sizes = (
        docs.select(group.alias("__g"), F.substring(order, 1, digits).alias("__bucket"))
        .groupBy("__g", "__bucket").agg(F.count(F.lit(1)).alias("n"))
    )
    before = Window.partitionBy("__g").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__g", "__bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("__g", "__bucket").orderBy("__h", id_col, "__tie")
    numbered = keyed.withColumn("__row", F.row_number().over(within) - 1).join(offsets, ["__g", "__bucket"])
    numbered = numbered.withColumn("__row", F.col("__row") + F.col("__before"))

    # The plan: a row per group, its size bounded by the weights.
    shape = "g INT, first_block BIGINT, first_slot BIGINT, total BIGINT, weight BIGINT, slots ARRAY<BIGINT>"
    table = (
        spark.range(1).select(F.inline(_literal(plan, f"ARRAY<STRUCT<{shape}>>")))
        .groupBy(F.col("g").alias("__g"))
        .agg(F.sort_array(F.collect_list(F.struct("first_block", "first_slot", "total", "weight", "slots"))).alias("__phases"))
    )
    lasts = []
    for g in blocks:
        entry = [p for p in plan if p["g"] == g][-1]
        k = blocks[g] - 1 - entry["first_block"]
        slot = entry["first_slot"] + k // entry["weight"] * entry["total"] + entry["slots"][k % entry["weight"]]
        lasts.append({"slot": slot, "missing": blocks[g] * block_rows - counts[g]})

    placed = numbered.join(F.broadcast(table), "__g")
    placed = placed.withColumn("__block", F.floor(F.col("__row") / block_rows).cast("long"))
    placed = placed.withColumn(
        "__phase", F.element_at(F.filter("__phases", lambda p: p["first_block"] <= F.col("__block")), -1)
    )
    k, phase = F.col("__block") - F.col("__phase.first_block"), F.col("__phase")
    # Whole-number division: the quotient is exact below 2**53.
    div = lambda a, b: (a - F.pmod(a, b)) / b
    placed = placed.withColumns({
        "__slot": (phase["first_slot"] + div(k, phase["weight"]) * phase["total"]
                 + F.get(phase["slots"], F.pmod(k, phase["weight"]).cast("int"))).cast("long"),
        "__release": (phase["first_slot"] + div(k * phase["total"], phase["weight"])).cast("long"),
        "__deadline": (phase["first_slot"] + div((k + 1) * phase["total"] + phase["weight"] - 1, phase["weight"])).cast("long"),
    })
    missing = F.aggregate(
        F.filter(_literal(lasts, "ARRAY<STRUCT<slot BIGINT, missing BIGINT>>"), lambda x: x["slot"] < F.col("__slot")),
        F.lit(0).cast("long"), lambda total, x: total + x["missing"],
    )
    placed = placed.withColumn(
        "__position", (F.col("__slot") * block_rows - missing + F.col("__row") - F.col("__block") * block_rows).cast("long")
    )
    return placed.select(*docs.columns, *[F.col(f"__{name}").alias(free_name(docs.columns, name)) for name in PLACES])
