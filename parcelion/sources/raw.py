"""Raw pipe-separated files: scan, choice of files, projection to message fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelion import schemas
from parcelion.functions.numeric import decimal_comma
from parcelion.functions.text import source_tag


def scan_raw(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All 43 text columns of one file, a folder, a glob or a chosen list of files,
    with ``fichier_source`` taken from the file name.

    A list of paths is one scan, so several files need no union.
    """
    chosen = [paths] if isinstance(paths, str) else list(paths)
    return (
        spark.read.schema(schemas.RAW)
        .option("sep", "|")
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", "")
        .csv(chosen)
        .select("*", source_tag(F.col("_metadata.file_name")).alias("fichier_source"))
    )


def write_raw(raw: DataFrame, path: str, folder_by: str | None = None) -> None:
    """Write raw columns as pipe-separated text; columns not present are empty. With
    ``folder_by`` there is one folder per value of that column."""
    columns = [
        F.col(f"`{name}`") if name in raw.columns else F.lit("").alias(name)
        for name in schemas.RAW_COLUMNS
    ]
    folders = [folder_by] if folder_by else []
    (
        raw.select(*columns, *folders).write.partitionBy(*folders)
        .option("sep", "|").option("header", True).option("encoding", "UTF-8")
        .option("quote", "").option("emptyValue", "").option("nullValue", "").csv(path)
    )


def message_fields(raw: DataFrame) -> DataFrame:
    """The nine message fields out of the raw columns.

    Empty text stays empty text; an empty price, surface or room count is NULL.
    """
    texts = {
        field: F.coalesce(F.col(f"`{schemas.MESSAGE_FIELDS[field]}`"), F.lit(""))
        for field in ("date_mutation", "nature_mutation", "code_postal", "commune", "type_local")
    }
    price = decimal_comma(F.col(f"`{schemas.MESSAGE_FIELDS['valeur_fonciere']}`"))
    surface = decimal_comma(F.col(f"`{schemas.MESSAGE_FIELDS['surface_reelle_bati']}`"))
    rooms_text = F.col(f"`{schemas.MESSAGE_FIELDS['nombre_pieces_principales']}`")
    rooms = F.nullif(F.trim(rooms_text), F.lit("")).try_cast("int")
    return raw.select(
        texts["date_mutation"].alias("date_mutation"),
        texts["nature_mutation"].alias("nature_mutation"),
        price.alias("valeur_fonciere"),
        texts["code_postal"].alias("code_postal"),
        texts["commune"].alias("commune"),
        texts["type_local"].alias("type_local"),
        surface.alias("surface_reelle_bati"),
        rooms.alias("nombre_pieces_principales"),
        "fichier_source",
    )


def source_counts(messages: DataFrame) -> DataFrame:
    """Rows sent per source, with prices, surfaces and room counts that were missing."""
    return messages.groupBy("fichier_source").agg(
        F.count(F.lit(1)).alias("lignes"),
        F.count_if(F.col("valeur_fonciere").isNull()).alias("sans_valeur"),
        F.count_if(F.col("surface_reelle_bati").isNull()).alias("sans_surface"),
        F.count_if(F.col("nombre_pieces_principales").isNull()).alias("sans_pieces"),
    )
