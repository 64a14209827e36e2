"""MinHash near-duplicates with b-bit signatures.

A document's distinct shingles of ``SHINGLE`` words are hashed, and ``MINIMA`` multipliers give as many minima. ``ROWS``
successive minima make the key of a band; documents that share a key are candidates. Of every minimum only ``BITS`` low
bits are kept, packed into a signature. Two signatures agree in a share E of their slots, of which C = 2^-BITS agree by
chance, so that the similarity is estimated as (E - C) / (1 - C), by counting bits. Candidates whose estimate lies
more than six deviations below the threshold go; the others are confirmed on their whole shingle sets. At the threshold
of 80 % a linked pair shares no key with a chance of (1 - 0.8^4)^40 = 7e-10 and is refuted by its estimate with one of about 1e-9.

Copies of one set are one node from the start, combined before the shuffle. No key's members are paired with each other: in the
first round the member with the most company in its keys is a key's hub, and the others are compared with it. A key is done when what is
left of it is one component. Members of keys that are not done are mostly copies edited too much to be linked with anyone. They go
on with exact keys: two sets that are alike share one of their rarest shingles, as many of these as their sizes let them
differ in. Rarity is counted among the members left, and shingles under one component only come first and make no key, so a copy with
enough edits of its own has no key at all. In groups that are still large after four hubs, every member is held against one, and two of them
meet only at the rarest of the shingles in which both differ from that one. Further rounds take four times as many hubs each. No link is lost.

Defined results: null, empty and blank texts have no shingles and are linked with nothing (their component is their own id);
a text of one word is one shingle; rows repeating an id each get a row; a null id is never the smallest unless alone, and
``kept`` of a row with a null id says whether its component is null; an empty table gives an empty result; other columns are ignored.
Shingles, keys and nodes are 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelion.session import kept_table, released_after, stage_table

from .components import connected_components
from .shingles import by_size, node_of, one_per_node, pivot_differences, pivot_keys, rare_keys, reachable, shingle_sets, without_pivot
from .words import NOT_SPACE, Words, batches, mix

SHINGLE, PERCENT = 2, 80
MINIMA, ROWS, BITS = 160, 4, 4
# Up to here the ids of wanted texts go to the documents, and not all texts through a shuffle to the ids.
BROADCAST_ROWS = 1_000_000
_U = np.uint64
_FACTORS = mix(np.arange(1, MINIMA + 1, dtype=_U)) | _U(1)
_PLACES = mix(np.arange(1, ROWS + 1, dtype=_U))
_BANDS = mix(np.arange(1, MINIMA // ROWS + 1, dtype=_U) << _U(32))
CHANCE = 2.0**-BITS


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest product of any shingle with each factor."""
    best = np.full(MINIMA, np.iinfo(_U).max, _U)
    for begin in range(0, len(shingles), 512):
        best = np.minimum(best, (shingles[begin : begin + 512, None] * _FACTORS).min(axis=0))
    return best


def band_keys(best: np.ndarray) -> np.ndarray:
    return mix((mix(best.reshape(-1, ROWS) ^ _PLACES)).sum(axis=1, dtype=_U) ^ _BANDS)


def signature(best: np.ndarray) -> bytes:
    """``BITS`` (four) bits of each minimum, two minima a byte."""
    low = ((best >> _U(32)) & _U(2**BITS - 1)).astype(np.uint8)
    return (low[0::2] << 4 | low[1::2]).tobytes()


def estimates(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Similarity of signatures (rows of bytes), corrected for slots that agree by chance."""
    differ = left ^ right
    differ |= differ >> 2
    differ |= differ >> 1
    share = 1 - np.bitwise_count(differ & 0x11).sum(axis=1) / MINIMA
    return (share - CHANCE) / (1 - CHANCE)


def least_estimate(percent: int) -> float:
    """The threshold less six deviations of the estimate there."""
    share = CHANCE + (1 - CHANCE) * percent / 100
    return percent / 100 - 6 * (share * (1 - share) / MINIMA) ** 0.5 / (1 - CHANCE)


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """(id, n, node, signature, keys) of the documents (id, text)."""
    schema = T.StructType([
        docs.schema["id"], T.StructField("n", T.LongType()), T.StructField("node", T.LongType()),
        T.StructField("signature", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType())),
    ])
    names = schema.fieldNames()

    def run(stream):
        for batch in batches(stream):
            sets = shingle_sets(Words(batch.column(1), NOT_SPACE), size)
            best = [minima(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) for s in sets], pa.int64()),
                pa.array([None if b is None else signature(b) for b in best], pa.binary()),
                pa.array([None if b is None else band_keys(b).view(np.int64) for b in best], pa.list_(pa.int64())),
            ], names=names)

    return docs.mapInArrow(run, schema)


def _estimated(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures do not refute a link."""
    least = least_estimate(percent)
    for side in ("a", "b"):
        pairs = pairs.join(signatures.select(F.col("node").alias(side), F.col("signature").alias(f"s_{side}")), side)

    def run(stream):
        for batch in stream:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
                yield batch.select([0, 1]).filter(pa.array(estimates(left, right) >= least))

    return pairs.select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _texts(docs: DataFrame, reps: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(node, text), one row for each of the ``wanted`` nodes, from a document of the smallest id that has it."""
    wanted = stage_table(wanted.join(reps, "node"), "wanted")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    rows = docs.join(wanted, docs["id"].eqNullSafe(wanted["rep"])).select("node", "text")

    def run(stream):
        for batch in batches(stream):
            # Another document may have the same id.
            own = np.array([node_of(s) for s in shingle_sets(Words(batch.column(1), NOT_SPACE), size)], np.int64)
            yield batch.filter(pa.array(own == np.asarray(batch.column(0))))

    return one_per_node(rows.mapInArrow(run, "node long, text string"))


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are alike, on their whole shingle sets."""
    for side in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("node").alias(side), F.col("text").alias("text" if side == "b" else "text_a")), side)

    def run(stream):
        for batch in batches(stream, 2 << 20):
            keep = []
            left, right = (shingle_sets(Words(batch.column(i), NOT_SPACE), size) for i in (2, 3))
            for x, y in zip(left, right):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "text_a", "text").mapInArrow(run, "a long, b long")


def _labels(docs: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """The component (node, label) of every node that has a link."""
    with released_after(docs.sparkSession):
        keys = sets.select(F.explode("keys").alias("key"), "node", "n").groupBy("key", "node").agg(F.min("n").alias("n"))
        company = keys.groupBy("key").agg(F.count(F.lit(1)).alias("company")).filter("company > 1")
        shared = stage_table(keys.join(company, "key"), "shared")
        central = shared.groupBy("node").agg(F.sum("company").alias("central"))
        left = shared.drop("company").join(central, "node").withColumns({"label": F.col("node"), "short": F.lit(True)})
        left = stage_table(without_pivot(left), "open")
        signatures = sets.select("node", "signature").join(central.select("node"), "node", "left_semi").dropDuplicates(["node"])
        signatures = stage_table(signatures, "signatures")
        reps = stage_table(sets.groupBy("node").agg(F.min("id").alias("rep")), "reps")
        labels, edges, hubs_taken, step = None, None, 1, 0
        while True:
            order = Window.partitionBy("key").orderBy(F.desc("central"), "node")
            hubs = stage_table(left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= hubs_taken), "hubs")
            hub = hubs.select("key", *[F.col(c).alias(f"hub_{c}") for c in ("node", "n", "label", "short", "side", "need", "rest")])
            sizes = 100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")
            short = F.when(F.struct("n", "node") < F.struct("hub_n", "hub_node"), F.col("short")).otherwise(F.col("hub_short"))
            pairs = left.join(hub, "key").filter((F.col("label") != F.col("hub_label")) & sizes & short & reachable(percent))
            pairs = pairs.select(F.least("node", "hub_node").alias("a"), F.greatest("node", "hub_node").alias("b")).distinct()
            pairs = stage_table(_estimated(pairs, signatures, percent), "pairs")
            if edges is None or not pairs.isEmpty():
                wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
                more = stage_table(_confirmed(pairs, _texts(docs, reps, wanted, size), size, percent), "edges")
                if edges is None or not more.isEmpty():
                    edges = more if edges is None else edges.union(more)
                    labels = connected_components(edges)
            # Hubs have met all members of their key. Keys whose other members are in several components go on.
            left = left.join(hubs.select("key", "node"), ["key", "node"], "left_anti").drop("label")
            left = left.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
            left = _mixed_keys(stage_table(left, "left"))
            if step == 0 and not left.isEmpty():
                nodes = stage_table(left.select("node", "label", "n").distinct(), "nodes")
                rare = rare_keys(nodes, _texts(docs, reps, nodes.select("node"), size), size, percent)
                # Those with the fewest shingles of their own are most like the others.
                like = F.count(F.lit(1)).over(Window.partitionBy("node")) / F.col("n")
                left = _mixed_keys(stage_table(without_pivot(rare.withColumn("central", like)), "rare"))
            elif step == 1 and not left.isEmpty():
                # Large groups of edited copies have most shingles in common: what each has otherwise than one of them tells whom it may be linked with.
                few, many = by_size(left)
                texts = _texts(docs, reps, many.select("node").distinct(), size)
                differences = stage_table(pivot_differences(many.withColumn("rank", -F.col("central")), texts, size, percent), "differences")
                more = differences.filter("cost <= free AND label <> pivot_label").select(F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b"))
                more = stage_table(more, "edges")
                if not more.isEmpty():
                    edges = edges.union(more)
                    labels = connected_components(edges)
                    differences = differences.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
                keys = pivot_keys(differences, percent).withColumns({"central": -F.col("cost").cast("double"), "short": F.lit(True)}).drop("cost")
                left = stage_table(few.unionByName(keys), "open")
            if left.isEmpty():
                return kept_table(labels, "labels")
            # The last keys are taken with 4 hubs first, as those before them.
            hubs_taken, step = 4 if step < 2 else 4 * hubs_taken, step + 1


def _mixed_keys(members: DataFrame) -> DataFrame:
    """The members whose key has members of several labels."""
    several = members.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    return stage_table(members.join(several.select("key"), "key", "left_semi"), "open")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_shingles``, ``component_id`` (smallest id reachable by links of ``percent``
    similarity or more), ``kept`` (whether the row's id is that)."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sets = stage_table(_sets(docs, size), "sets")
    labels = _labels(docs, sets, size, percent)
    labelled = sets.select("id", "n", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = stage_table(labelled.groupBy("label").agg(F.min("id").alias("smallest")), "smallest")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("smallest"))
    return labelled.join(smallest, "label").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
    )
