"""Registered queries of the training-data operators and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, conversations, cross_entropy, decontaminate, jaccard, lines, minhash, mixing, passages, quality, search, spelling, token_counts,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Target weights: parts of the mix by source; all other sources together have OTHER_WEIGHT.
SOURCE_WEIGHTS = {"src0": 6, "src1": 4, "src2": 4, "src3": 3, "src4": 3, "src5": 2, "src6": 2, "src7": 1, "src8": 1}
OTHER_WEIGHT = 10


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix_sources(docs, SOURCE_WEIGHTS, OTHER_WEIGHT)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_matches(docs, _table(spark, sf_dir, "benchmark"))
    report = F.col("contamination")
    n_hit = F.aggregate(report["spans"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        report["n_words"].alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(report["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(report["items"], ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.shared_passages(_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.clean_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(_table(spark, sf_dir, "documents"))


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    target = labels.filter("quality = 1 AND coalesce(toxic, 0) = 0")
    return cross_entropy.score_documents(_table(spark, sf_dir, "documents"), target).drop("text_hash")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), token_counts.read_vocabulary())


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("text_hash")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"),
    )
    out = chat.format_chat(rows.unionByName(more))
    text = chat.formatted(F.col("pieces"))
    turns = chat.parse(text)
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.under_loss(F.col("pieces"))
    return out.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length(text).cast("long").alias("formatted_chars"),
        "round_trip",
    )


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with faults by a checksum of conversation and turn; nulls read as one space."""
    told = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    pick = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn"))) % 20
    role, text = told("role"), told("text")
    rows = rows.select(
        "conv_id", "turn", pick.alias("pick"), F.when(pick == 4, "user").otherwise(role).alias("role"),
        F.when(pick == 1, "").when(pick == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
    )
    copies = F.when(F.col("pick") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter("pick <> 0").select("conv_id", "turn", "role", "text", F.explode(copies).alias("copy")).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = conversations.repair(damaged(rows)).withColumnRenamed("conv_id", "found")
    ids = rows.select("conv_id").distinct()
    joined = ids.join(found, ids["conv_id"].eqNullSafe(found["found"]), "left").drop("found")
    none = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")} | {"audit": ""}
    return joined.fillna(none, subset=list(none)).withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 97th run of letters, by checksum, loses a code point; a null id is empty there."""
    docs = _table(spark, sf_dir, "documents")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(lower, F.lit(spelling.LETTERS), F.lit(0))).alias("run"))
    runs = runs.select("run", F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return spelling.variants(spelling.count_words(runs.select(F.when(F.col("h") % 97 == 0, cut).otherwise(F.col("run")).alias("word"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_decontamination": op2_decontamination,
    "op3_passages": op3_passages,
    "op4_line_dedup": op4_line_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_topk_search": op6_topk_search,
    "op7_cross_entropy": op7_cross_entropy,
    "op8_token_counts": op8_token_counts,
    "op10_quality": op10_quality,
    "op9_chat_format": op9_chat_format,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_minhash": op12_minhash,
    "op13_spelling": op13_spelling,
}
