"""Line dedup: lines that many documents share stay in one of them.

Every line becomes the 128-bit hash of its normalised form. The documents that hold a hash
are counted, hashes found in ``min_docs`` documents or more are marked together with the
largest document id that holds them, and each document drops the marked lines it does not own.

Defined results: null or empty text is one empty line; a null id is a document of its own
and the smallest id; rows that repeat an id are one document for counting, and each row is cleaned;
an empty table gives an empty result. Columns besides id and text pass through ``clean_lines``; where
one is named like an added column, that one gets underscores before its name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelion.session import stage_table

from .columns import free_name

MIN_CHARS = 20
MIN_DOCS = 3
_SPACES = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    """The line without white space at both ends, A-Z as a-z."""
    return line.strip(_SPACES).lower()


def _hash(line: bytes, min_chars: int) -> bytes | None:
    key = line_key(line)
    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _lines(text: str | None) -> list[bytes]:
    return (text or "").encode().split(b"\n")


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row (id, hash) per different long line of a row."""

    def explode(stream):
        for batch in stream:
            rows, hashes = [], []
            for row, text in enumerate(batch.column(1)):
                found = {_hash(line, min_chars) for line in _lines(text.as_py())} - {None}
                rows += [row] * len(found)
                hashes += found
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(hashes, pa.binary())], names=["id", "hash"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([slim.schema["id"], T.StructField("hash", T.BinaryType())])
    return slim.mapInArrow(explode, schema)


def shared_lines(hashes: DataFrame, min_docs: int) -> DataFrame:
    """Hashes found in ``min_docs`` documents or more, and the largest id holding each.

    Both figures are partial aggregates over distinct (hash, id) rows, so that a line found
    in a third of all documents is counted by every task and not by one.
    """
    distinct = hashes.distinct()
    return (
        distinct.groupBy("hash")
        .agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("keeper"))
        .filter(F.col("docs") >= min_docs)
        .select("hash", "keeper")
    )


def clean_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """All columns of ``docs`` with ``text_col`` cleaned, and ``n_lines`` (before), ``n_dropped``
    and ``kept_sha256`` (of the cleaned text) as its last three. A row that loses no line keeps its text as it is,
    null included."""
    hashes = line_hashes(docs, id_col, text_col, min_chars)
    drop = (
        hashes.join(stage_table(shared_lines(hashes, min_docs), "lines"), "hash")
        .filter(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy("id")
        .agg(F.collect_set("hash").alias("hashes"))
    )
    key, marks = free_name(docs.columns, "line_doc"), free_name(docs.columns, "line_marks")
    drop = drop.select(F.col("id").alias(key), F.col("hashes").alias(marks))
    marked = docs.join(drop, F.col(id_col).eqNullSafe(F.col(key)), "left").drop(key)
    marked = marked.withColumn(text_col, F.col(text_col).cast("string"))
    at = marked.columns.index(text_col)
    added = [("n_lines", T.LongType()), ("n_dropped", T.LongType()), ("kept_sha256", T.StringType())]
    schema = T.StructType([
        *(f for f in marked.schema.fields if f.name != marks), *(T.StructField(free_name(docs.columns, n), kind) for n, kind in added),
    ])
    names = schema.fieldNames()
    drop_at = marked.columns.index(marks)

    def reassemble(stream):
        for batch in stream:
            texts, total, dropped, digests = [], [], [], []
            for text, marks in zip(batch.column(at), batch.column(drop_at)):
                text, marks = text.as_py(), marks.as_py()
                lines = _lines(text)
                kept = lines
                if marks:
                    marks = set(marks)
                    kept = [line for line in lines if _hash(line, min_chars) not in marks]
                    text = b"\n".join(kept).decode() if len(kept) < len(lines) else text
                texts.append(text)
                total.append(len(lines))
                dropped.append(len(lines) - len(kept))
                digests.append(hashlib.sha256(b"\n".join(kept)).hexdigest())
            columns = [c for i, c in enumerate(batch.columns) if i != drop_at]
            columns[at - (at > drop_at)] = pa.array(texts, batch.schema.field(at).type)
            columns += [
                pa.array(np.array(total, np.int64)), pa.array(np.array(dropped, np.int64)), pa.array(digests, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return marked.mapInArrow(reassemble, schema)
