"""Token counts of a unigram tokenizer, by dynamic programming over a trie of pre-tokens.

The distinct pre-tokens of a batch of documents are put in a trie by walking them in sorted order. A node's
forward score is the best sum of piece scores over all ways to cut the bytes from the root to the node
into pieces. It is computed once per node, however many pre-tokens share the prefix, and a node that
ends a pre-token stores the number of pieces of its best cut. A document's count is the sum over its
pre-tokens.

The pieces come from a vocabulary file in rank order (base64 piece and rank per line). The file has
no probabilities; by Zipf's law the piece of rank r gets the score -ln(r + 1) - ln(H), where H makes the
probabilities sum to 1. Equal scores prefer fewer pieces. Bytes missing from a vocabulary count
as a piece of the lowest score less 10.

Defined results: null or empty text has no tokens; repeated rows are counted each; an empty table gives an
empty result; other columns are ignored. The vocabulary is sent to the tasks; its size is that of the file.
"""

from __future__ import annotations

import base64
import math

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Letters, digits or marks with a blank before them, and white space.
PRE_TOKENS = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_vocabulary(path: str = VOCABULARY) -> dict[bytes, float]:
    """Piece scores from a file of base64 pieces and ranks, read on the driver."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                piece, rank = line.split()
                ranks[base64.b64decode(piece)] = int(rank)
    total = math.log(sum(1 / (rank + 1) for rank in ranks.values()))
    return {piece: -math.log(rank + 1) - total for piece, rank in ranks.items()}


class PieceScores:
    """Scores by piece, and for each pair of last bytes the lengths that pieces ending in it have."""

    def __init__(self, scores: dict[bytes, float]):
        self.scores = scores
        self.missing = min(scores.values(), default=0.0) - 10
        lengths: dict[bytes, set[int]] = {}
        for piece in scores:
            if len(piece) > 1:
                lengths.setdefault(piece[-2:], set()).add(len(piece))
        self.lengths = {pair: sorted(found) for pair, found in lengths.items()}


def trie_counts(words: list[bytes], pieces: PieceScores) -> tuple[dict[bytes, int], int]:
    """Pieces of the best cut of each word, and the number of trie nodes scored.

    ``words`` are walked in sorted order; ``best[d]`` and ``count[d]`` belong to the node of depth d on the
    path of the current word, so a prefix shared with the word before is not scored again.
    """
    get, lengths, missing = pieces.scores.get, pieces.lengths, pieces.missing
    best, count = [0.0], [0]
    terminal, before, nodes = {}, b"", 0
    for word in sorted(set(words)):
        shared = 0
        for a, b in zip(word, before):
            if a != b:
                break
            shared += 1
        del best[shared + 1 :], count[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            score, used = best[end - 1] + get(word[end - 1 : end], missing), count[end - 1] + 1
            for size in lengths.get(word[max(end - 2, 0) : end], ()):
                if size > end:
                    break
                own = get(word[end - size : end])
                if own is not None:
                    own += best[end - size]
                    if own > score or (own == score and count[end - size] + 1 < used):
                        score, used = own, count[end - size] + 1
            best.append(score)
            count.append(used)
            nodes += 1
        terminal[word] = count[-1]
        before = word
    return terminal, nodes


def count_tokens(
    docs: DataFrame,
    scores: dict[bytes, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    pattern: str = PRE_TOKENS,
    remembered: int = 300_000,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_pretokens``, ``n_tokens``. A task forgets the terminal counts of
    earlier batches when it has more than ``remembered`` of them; that bounds its memory and changes no count."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(scores)
    schema = T.StructType([
        T.StructField(id_col, slim.schema["id"].dataType), T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType()),
    ])

    def run(stream):
        pieces, split = PieceScores(shared.value), regex.compile(pattern).findall
        counts: dict[str, int] = {}
        for batch in batches(stream, 8 << 20):
            cut = [split(text.as_py() or "") for text in batch.column(1)]
            if len(counts) > remembered:
                counts = {}
            distinct = set().union(*cut).difference(counts)
            terminal, _ = trie_counts([word.encode() for word in distinct], pieces)
            counts.update((word, terminal[word.encode()]) for word in distinct)
            totals = [sum(map(counts.__getitem__, words)) for words in cut]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(np.array([len(words) for words in cut], np.int64)), pa.array(np.array(totals, np.int64)),
            ], names=[id_col, "n_pretokens", "n_tokens"])

    return slim.mapInArrow(run, schema)
