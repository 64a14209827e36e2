"""Property graph as node and edge tables; path questions as joins.

Nature -> type -> commune edges are distinct pairs, and sales hang from the commune
only. A path through a type therefore reaches every sale of each linked commune, not
just those of that type.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelion import schemas
from parcelion.functions.text import blank_to
from parcelion.session import path_exists, stage_table

UNKNOWN_NATURE = "Inconnue"
UNKNOWN_TYPE = "Inconnu"


@dataclass(frozen=True)
class Graph:
    nodes_nature: DataFrame
    nodes_type: DataFrame
    nodes_commune: DataFrame
    nodes_mutation: DataFrame
    a_pour_type: DataFrame
    a_pour_lieu: DataFrame
    a_enregistre: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return dict(vars(self))


def graph_rows(silver: DataFrame) -> DataFrame:
    """Rows that enter the graph: commune, date and a price other than 0 are required;
    a missing nature or type gets its default."""
    return silver.where(
        (F.col("commune") != "") & F.col("date_mutation").isNotNull() & (F.col("valeur_fonciere") != 0)
    ).select(
        "commune",
        blank_to(F.col("nature_mutation"), UNKNOWN_NATURE).alias("nature"),
        blank_to(F.col("type_local"), UNKNOWN_TYPE).alias("type"),
        F.col("date_mutation").cast("string").alias("date"),
        F.col("valeur_fonciere").alias("valeur"),
        F.col("id_unique").alias("mutation_id"),
    )


def build_graph(silver: DataFrame) -> Graph:
    """Merged nodes and edges, and one sale node with its edge per row. The content key
    of a row is its node id, so a rerun builds the same graph. The edge carries date and
    price of its sale: paths read one table, and rows that share a key stay single.

    Natures, types and communes come out of the two edge tables, which are distinct
    already: one pass over silver for all five small tables.
    """
    rows = graph_rows(silver)
    triples = stage_table(rows.select("nature", "type", "commune").distinct(), "triples")
    return Graph(
        nodes_nature=triples.select(F.col("nature").alias("nom")).distinct(),
        nodes_type=triples.select(F.col("type").alias("nom")).distinct(),
        nodes_commune=triples.select(F.col("commune").alias("nom")).distinct(),
        nodes_mutation=rows.select(F.col("mutation_id").alias("id"), "date", "valeur"),
        a_pour_type=triples.select("nature", "type").distinct(),
        a_pour_lieu=triples.select("type", "commune").distinct(),
        a_enregistre=rows.select("commune", "mutation_id", "date", "valeur"),
    )


def save_graph(graph: Graph, path: str) -> None:
    """Store every node and edge table, replacing what was there."""
    for name, table in graph.tables().items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")


# What identifies a node or an edge: the rest of a row follows from it.
KEYS = {
    "nodes_nature": ["nom"], "nodes_type": ["nom"], "nodes_commune": ["nom"], "nodes_mutation": ["id"],
    "a_pour_type": ["nature", "type"], "a_pour_lieu": ["type", "commune"], "a_enregistre": ["commune", "mutation_id"],
}
BUCKETS = 64
# Keys that are digests as a rule.
_DIGESTS = ("id", "mutation_id")


def _packed(rows: DataFrame) -> DataFrame:
    """Digests as bytes, half as long in a shuffle: lower-case hex text after a 1, any other text after a 0. NULL stays NULL."""
    def pack(c: str) -> Column:
        raw = F.unhex(c)
        return F.when(F.lower(F.hex(raw)) == F.col(c), F.concat(F.unhex(F.lit("01")), raw)).otherwise(F.concat(F.unhex(F.lit("00")), F.encode(c, "UTF-8")))

    return rows.withColumns({c: pack(c) for c in _DIGESTS if c in rows.columns})


def _unpacked(rows: DataFrame) -> DataFrame:
    """What :func:`_packed` packed."""
    def unpack(c: str) -> Column:
        rest = F.substring(F.col(c), F.lit(2), F.length(c))
        return F.when(F.substring(F.col(c), 1, 1) == F.unhex(F.lit("01")), F.lower(F.hex(rest))).otherwise(F.decode(rest, "UTF-8"))

    return rows.withColumns({c: unpack(c) for c in _DIGESTS if c in rows.columns})


def merge_graph(spark: SparkSession, graph: Graph, path: str) -> DataFrame:
    """Add to a stored graph the nodes and edges that it does not have, and tell what came: (table, total, charges, ignores).

    Tables are stored by hash bucket of their key. Only the buckets that the load touches are read, and only by their keys; new rows are
    appended to them, nothing is rewritten. A load that is repeated, or breaks off and comes again, adds what is missing. Rows are
    shuffled once, by bucket and key, to be made distinct and to meet the stored keys, and written once.
    """
    counts = []
    for name, table in graph.tables().items():
        key, target = KEYS[name], f"{path}/{name}"
        bucket = F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")
        rows = table.withColumn("seau", bucket)
        total, stored = table.count(), path_exists(spark, target)
        new, before = _packed(rows).dropDuplicates(["seau", *key]), 0
        if stored:
            before = spark.read.schema(rows.schema).parquet(target).count()
            touched = [r.seau for r in rows.select("seau").distinct().collect()]
            known = spark.read.schema(rows.schema).parquet(target).where(F.col("seau").isin(touched)).select("seau", *key)
            new = new.join(_packed(known), ["seau", *key], "left_anti")
        # Digests do not repeat, but their hex digits take half a byte each.
        _unpacked(new).write.mode("append").option("compression", "zstd").partitionBy("seau").parquet(target)
        added = spark.read.schema(rows.schema).parquet(target).count() - before
        counts.append((name, total, added, total - added))
    return spark.createDataFrame(counts, "table string, total long, charges long, ignores long")


def merged_graph(spark: SparkSession, path: str) -> Graph:
    """The graph stored by :func:`merge_graph`."""
    return Graph(**{name: spark.read.parquet(f"{path}/{name}").drop("seau") for name in Graph.__dataclass_fields__})


def load_graph(spark: SparkSession, path: str) -> Graph:
    return Graph(**{name: spark.read.parquet(f"{path}/{name}") for name in Graph.__dataclass_fields__})


def wipe_graph(spark: SparkSession, path: str) -> None:
    """Delete all nodes and edges: every table is overwritten by an empty one."""
    kinds = {
        "nodes_nature": schemas.NODE, "nodes_type": schemas.NODE, "nodes_commune": schemas.NODE,
        "nodes_mutation": schemas.MUTATION_NODE, **schemas.EDGES,
    }
    for name, schema in kinds.items():
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/{name}")


def sales(graph: Graph) -> DataFrame:
    """Every sale with its commune: (commune, id, date, valeur). A filter on the commune
    reaches the scan."""
    return graph.a_enregistre.select("commune", F.col("mutation_id").alias("id"), "date", "valeur")


def _routes(graph: Graph, nature: str | None, type_name: str | None, commune: str | None) -> DataFrame:
    """Distinct (nature, type, commune) hops, filtered before they are joined."""
    first, second = graph.a_pour_type, graph.a_pour_lieu
    if nature is not None:
        first = first.where(F.col("nature") == nature)
    if type_name is not None:
        first = first.where(F.col("type") == type_name)
        second = second.where(F.col("type") == type_name)
    if commune is not None:
        second = second.where(F.col("commune") == commune)
    return first.join(second, "type").select("nature", "type", "commune")


def paths(
    graph: Graph,
    nature: str | None = None,
    type_name: str | None = None,
    commune: str | None = None,
    known_types_only: bool = False,
) -> DataFrame:
    """All nature -> type -> commune -> sale paths that pass the filters."""
    routes = _routes(graph, nature, type_name, commune)
    if known_types_only:
        routes = routes.where(F.col("type") != UNKNOWN_TYPE)
    reached = sales(graph)
    if commune is not None:
        reached = reached.where(F.col("commune") == commune)
    return routes.join(reached, "commune").select("nature", "type", "commune", "id", "date", "valeur")


def first_paths(found: DataFrame, rows: int = 100) -> DataFrame:
    """The first paths in a total order."""
    return found.orderBy("nature", "type", "commune", "date", "id").limit(rows)


def ranked_paths(
    graph: Graph, nature: str | None = None, type_name: str | None = None, commune: str | None = None,
    known_types_only: bool = False, rows: int = 100,
) -> DataFrame:
    """What :func:`first_paths` gives of :func:`paths`, without building the paths. Every route to a commune with sales holds a path, so the first
    ``rows`` paths lie on the first ``rows`` routes, and on each of these among the first ``rows`` sales of its commune: that many sales of that many communes
    are the most that meet."""
    routes = _routes(graph, nature, type_name, commune)
    if known_types_only:
        routes = routes.where(F.col("type") != UNKNOWN_TYPE)
    with_sales = graph.a_enregistre.select("commune").distinct()
    # At most ``rows`` routes, whatever the data.
    first = routes.join(with_sales, "commune", "left_semi").orderBy("nature", "type", "commune").limit(rows)
    first = stage_table(first.select("nature", "type", "commune"), "routes")
    reached = sales(graph).join(F.broadcast(first.select("commune").distinct()), "commune", "left_semi")
    place = F.row_number().over(Window.partitionBy("commune").orderBy("date", "id"))
    reached = reached.withColumn("_place", place).where(F.col("_place") <= rows).drop("_place")
    return first_paths(reached.join(F.broadcast(first), "commune").select("nature", "type", "commune", "id", "date", "valeur"), rows)


def path_counts(graph: Graph) -> DataFrame:
    """Number of paths per (nature, type): sales are counted per commune before the
    hops multiply them, so the paths themselves are never built."""
    per_commune = graph.a_enregistre.groupBy("commune").agg(F.count(F.lit(1)).alias("_sales"))
    return (
        _routes(graph, None, None, None)
        .join(per_commune, "commune")
        .groupBy("nature", "type")
        .agg(F.sum("_sales").alias("chemins"), F.count(F.lit(1)).alias("communes"))
    )


def communes_by_sales(graph: Graph, rows: int = 100) -> DataFrame:
    """Communes with the most sales."""
    return (
        graph.a_enregistre.groupBy(F.col("commune").alias("Commune"))
        .agg(F.count(F.lit(1)).alias("NombreMutations"))
        .orderBy(F.desc("NombreMutations"), "Commune")
        .limit(rows)
    )


def commune_history(graph: Graph, commune: str, rows: int = 100) -> DataFrame:
    """Sales of one commune by date."""
    return (
        sales(graph)
        .where(F.col("commune") == commune)
        .orderBy("date", "valeur", "id")
        .limit(rows)
        .select(F.col("date").alias("Date"), F.col("valeur").alias("Valeur"))
    )


def list_nodes(graph: Graph, rows: int = 100) -> DataFrame:
    """The first nodes of all kinds, in a total order."""
    kinds = {
        "NatureMutation": graph.nodes_nature.select("nom"),
        "TypeLocal": graph.nodes_type.select("nom"),
        "Commune": graph.nodes_commune.select("nom"),
        "Mutation": graph.nodes_mutation.select(F.col("id").alias("nom")),
    }
    listed = None
    for label, nodes in kinds.items():
        part = nodes.select(F.lit(label).alias("genre"), "nom")
        listed = part if listed is None else listed.unionByName(part)
    return listed.orderBy("genre", "nom").limit(rows)


def node_counts(graph: Graph) -> DataFrame:
    """Number of rows of every node and edge table."""
    counted = None
    for name, table in graph.tables().items():
        part = table.agg(F.count(F.lit(1)).alias("nombre")).select(F.lit(name).alias("table"), "nombre")
        counted = part if counted is None else counted.unionByName(part)
    return counted
