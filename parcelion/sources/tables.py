"""Stored tables: columnar, CSV, relational and document stores behind one pair of calls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Formats addressed by connector options instead of a path.
_CONNECTORS = {"jdbc", "mongodb"}


def read_table(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """Scan of a stored table. Filters and columns chosen later reach the source."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load() if fmt in _CONNECTORS else reader.load(path)


def write_table(
    df: DataFrame,
    path: str | None = None,
    fmt: str = "parquet",
    mode: str = "append",
    partition_by: Sequence[str] = (),
    **options: str,
) -> None:
    """Append or overwrite a stored table; ``fmt="jdbc"`` and the document store take
    their address from the options."""
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt in _CONNECTORS:
        writer.save()
    else:
        writer.save(path)


def write_jdbc(df: DataFrame, connections: int = 5, batch_size: int = 10_000, **options: str) -> None:
    """Relational append over a fixed number of connections."""
    write_table(
        df.repartition(connections), fmt="jdbc", mode="append", batchsize=str(batch_size), **options
    )


def replace_months(silver: DataFrame, path: str, derived: dict[str, Column] | None = None) -> None:
    """Write silver by year and month, replacing only the months that occur in it, so
    that a rerun leaves the same table.

    The rebalance hint lets adaptive execution cut a hot month into several files and
    merge small ones. ``derived`` columns follow from the others: they are computed where
    they are written, not shuffled.
    """
    dealt = (
        silver.drop(*(derived or {}))
        .withColumn("annee", F.year("date_mutation"))
        .withColumn("mois", F.month("date_mutation"))
        .hint("rebalance", "annee", "mois")
    )
    (
        dealt.withColumns(derived or {}).select(*silver.columns, "annee", "mois")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("annee", "mois")
        .parquet(path)
    )


def read_months(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """Rows dated in [start, end). Months outside the range are never read, and the
    date bounds themselves are pushed into the Parquet scan."""
    day, month = F.col("date_mutation"), F.col("annee") * 12 + F.col("mois")
    first, last = (int(d[:4]) * 12 + int(d[5:7]) for d in (start, end))
    return (
        spark.read.parquet(path)
        .where(month.between(first, last))
        .where((day >= F.to_date(F.lit(start))) & (day < F.to_date(F.lit(end))))
        .drop("annee", "mois")
    )


def overview(df: DataFrame, rows: int = 20) -> tuple[int, T.StructType, DataFrame]:
    """Row count, schema and first rows of a table."""
    return df.count(), df.schema, df.limit(rows)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and no index; dates and numbers in their usual text form."""
    df.write.mode("overwrite").option("header", True).csv(path)


def import_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, read with a given schema and not with a scan to infer one."""
    return spark.read.schema(schema).option("header", True).csv(path)


def export_sample(
    df: DataFrame, path: str, fraction: float = 0.1, rows: int = 20_000, seed: int = 42, identity: str | None = None
) -> None:
    """Sample without replacement, cut at ``rows``, as snappy Parquet: Bernoulli, or by a
    salted digest of ``identity``, which gives the same rows on every run and partitioning."""
    if identity is None:
        sample = df.sample(withReplacement=False, fraction=fraction, seed=seed).limit(rows)
    else:
        digest = F.sha2(F.concat(F.col(identity), F.lit(f":{seed}")), 256)
        chosen = F.conv(F.substring(digest, 1, 4), 16, 10).cast("int") < F.lit(fraction) * 65536
        sample = df.where(chosen).orderBy(digest, identity).limit(rows)
    sample.write.mode("overwrite").option("compression", "snappy").parquet(path)
