"""Property-sale rows derived from the star-schema tables of a test-data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelion.sources.raw import message_fields


# Schemas seen so far by path: file footers are looked at once, not once per query.
_SEEN: dict[str, T.StructType] = {}


def table_schema(spark: SparkSession, sf_dir: str, name: str) -> T.StructType:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SEEN:
        _SEEN[path] = spark.read.parquet(path).schema
    return _SEEN[path]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(table_schema(spark, sf_dir, name)).parquet(f"{sf_dir}/{name}.parquet")


def _spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows over all cores when their files have fewer splits than the session has slots.

    A small file is one row group, which one task would carry through all joins. Large
    inputs have more splits than slots and stay as they are.
    """
    slots = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= slots else rows.repartition(slots, *keys)


def _comma_text(amount: Column) -> Column:
    return F.replace(amount.cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(","))


def raw_mutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw text row per order line, under the raw header names.

    No join side is hinted: Catalyst broadcasts by file size, and adaptive execution
    splits a hot order, part or customer where it has to shuffle. Orders meet their customers
    before the lines come, so lines are not shuffled by customer as well.
    """
    customers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    orders = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    sales = (
        _spread(lines, "l_orderkey", "l_partkey", "l_linenumber")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    no_building = F.col("p_size") < 10
    # A few dates that cannot be read, prices on the bounds of segments, and outliers.
    fifth, part = F.col("l_linenumber") == 5, F.col("l_partkey") % 20
    return sales.select(
        F.when((F.col("l_linenumber") == 6) & (F.col("l_partkey") % 40 == 0), "inconnue")
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("Date mutation"),
        F.col("o_orderpriority").alias("Nature mutation"),
        F.when(F.col("l_linenumber") == 7, "")
        .when(fifth & (part == 0), "470000,00").when(fifth & (part == 5), "1300000,00")
        .when(fifth & (part == 10), "600000000,00")
        .otherwise(_comma_text(F.col("l_extendedprice") * 20))
        .alias("Valeur fonciere"),
        (1000 + F.col("c_nationkey") * 1000 + F.col("c_custkey") % 90)
        .cast("string")
        .alias("Code postal"),
        F.concat("n_name", F.lit("-"), (F.col("c_custkey") % 10).cast("string")).alias("Commune"),
        F.when(F.col("p_size") % 7 == 0, "").otherwise(F.col("p_type")).alias("Type local"),
        F.when(no_building, "").otherwise(_comma_text(F.col("l_quantity") * 5))
        .alias("Surface reelle bati"),
        F.when(no_building, "").otherwise((F.col("p_size") % 8).cast("string"))
        .alias("Nombre pieces principales"),
        F.concat(F.lit("mutations-"), F.year("o_orderdate").cast("string")).alias("fichier_source"),
    )


def mutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as message fields."""
    return message_fields(raw_mutations(spark, sf_dir))
