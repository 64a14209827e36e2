"""Key figures, reports, profiles and lookups over stored rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelion.functions.dates import local_clock
from parcelion.functions.numeric import half_even
from parcelion.functions.text import ranked_label, split_label
from parcelion.session import stage_table


def headline(df: DataFrame) -> DataFrame:
    """Row count and mean price rounded to cents; 0 for an empty table."""
    return df.agg(
        F.count(F.lit(1)).alias("total_documents"),
        half_even(F.coalesce(F.avg("valeur_fonciere"), F.lit(0.0)), 2).alias("moyenne_valeur_fonciere"),
    )


def top_communes(df: DataFrame, rows: int = 5) -> DataFrame:
    """Communes with the most rows; the name settles ties."""
    return (
        df.groupBy("commune")
        .agg(F.count(F.lit(1)).alias("nb"))
        .orderBy(F.desc("nb"), "commune")
        .limit(rows)
    )


def key_values(df: DataFrame, now: datetime | None = None, rows: int = 5) -> DataFrame:
    """Key figures as (key, pos, value) text, the shape of the key-value store.

    Rows are read once, into a stored table of one row per commune; the figures and the
    list both come from that.
    """
    communes = stage_table(
        df.groupBy("commune").agg(
            F.count(F.lit(1)).alias("nb"),
            F.count("valeur_fonciere").alias("prix"),
            F.sum("valeur_fonciere").alias("somme"),
        ),
        "communes",
    )
    mean = F.coalesce(F.try_divide(F.sum("somme"), F.sum("prix")), F.lit(0.0))
    clock = local_clock(F.lit(now) if now is not None else F.current_timestamp())
    figures = communes.agg(
        F.coalesce(F.sum("nb"), F.lit(0)).cast("string").alias("total"),
        half_even(mean, 2).cast("string").alias("moyenne"),
    ).select(
        F.inline(
            F.array(
                _entry("stat_total_documents", F.col("total")),
                _entry("stat_moyenne_valeur_fonciere", F.col("moyenne")),
                _entry("last_update_stats", clock),
            )
        )
    )
    best = communes.orderBy(F.desc("nb"), "commune").limit(rows)
    # ``best`` has ``rows`` rows: one array holds them.
    ranked = best.agg(
        F.array_sort(F.collect_list(F.struct((-F.col("nb")).alias("down"), "commune", "nb"))).alias("top")
    ).select(F.posexplode("top").alias("pos", "c"))
    return figures.unionByName(
        ranked.select(
            F.lit("top_communes").alias("key"), "pos",
            ranked_label(F.col("c.commune"), F.col("c.nb")).alias("value"),
        )
    )


def _entry(key: str, value):
    return F.struct(F.lit(key).alias("key"), F.lit(0).alias("pos"), value.alias("value"))


def save_key_values(kpis: DataFrame, path: str) -> None:
    """Replace the stored key figures; scalars and the ordered list alike."""
    kpis.coalesce(1).write.mode("overwrite").parquet(path)


def read_list(kpis: DataFrame, key: str) -> DataFrame:
    """Entries of one stored list in order, split back into name and count."""
    name, count = split_label(F.col("value"))
    return (
        kpis.where(F.col("key") == key)
        .orderBy("pos")
        .select("pos", name.alias("commune"), count.alias("nb"))
    )


def parquet_report(df: DataFrame) -> DataFrame:
    """Rows, distinct communes and mean price of a stored sample."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct("commune").alias("communes_uniques"),
        F.avg("valeur_fonciere").alias("valeur_moyenne"),
    )


def profile(df: DataFrame) -> DataFrame:
    """Type and percentage of missing values per column, from one pass."""
    shares = df.agg(*[(F.avg(F.col(c).isNull().cast("int")) * 100).alias(c) for c in df.columns])
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("colonne"), F.lit(kinds[c]).alias("type"), F.col(c).alias("pct_nul"))
            for c in df.columns
        ]
    )
    return shares.select(F.inline(rows))


def frequencies(df: DataFrame, column: str, rows: int | None = None) -> DataFrame:
    """Non-NULL values by falling frequency, all or the first ``rows``."""
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("valeur"))
        .agg(F.count(F.lit(1)).alias("effectif"))
        .orderBy(F.desc("effectif"), "valeur")
    )
    return counted if rows is None else counted.limit(rows)


def lookup(
    silver: DataFrame, postal_code: str | None = None, commune: str | None = None, rows: int = 100
) -> DataFrame:
    """Rows of one postal code and / or of communes that contain a text in any case.

    NULL and empty arguments do not filter; ``%`` and ``_`` in the text are wildcards.
    The first rows by content key are returned, so the answer is stable.
    """
    found = silver
    if postal_code:
        found = found.where(F.col("code_postal") == postal_code)
    if commune:
        found = found.where(F.col("commune").ilike(f"%{commune}%"))
    return found.orderBy("id_unique").limit(rows)
