"""Document vectors: the mean of the word vectors of a token list."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termspace.operators.skew import hot_keys, lookup_join
from termspace.operators.vocabulary import word_rows
from termspace.session import settle

# Vectors of the most frequent words are sent to every task, up to this size.
SENT_BYTES = 128 * 2**20
# Word vectors gathered at a time inside a task.
_GATHER_BYTES = 32 * 2**20


def embed_documents(
    df: DataFrame,
    vectors: DataFrame,
    key: str,
    words: str = "words",
    sent_bytes: int = SENT_BYTES,
    work: str | None = None,
    **balance,
) -> DataFrame:
    """(key, vector): mean of the word vectors of each row's token list.

    Tokens without a vector count in the divisor; a row without any known token
    gets zeros. ``key`` tells the rows apart; ``vectors`` has (word, vector) and
    may have ``idx``, the position by frequency, and ``count``.

    Vectors go to every task as far as ``sent_bytes`` allows: all of them, or
    else those of the most frequent words (by ``idx``), so that most tokens are
    summed where they are read. Only if words remain beyond that are the other
    tokens shuffled to their vectors, and the two sums added.
    """
    first = vectors.select(F.size("vector")).first()
    dimensions = first[0] if first else 0
    limit = sent_bytes // max(1, 4 * dimensions)
    whole = vectors.count() <= limit
    frequent = vectors if whole else vectors.filter(F.col("idx") < limit if "idx" in vectors.columns else F.lit(False))
    # Bounded fetch: at most ``limit`` rows of so many floats.
    sent = frequent.select("word", F.col("vector").cast("array<float>").alias("vector")).limit(limit).toArrow()
    sums = _sum_sent(df, sent, key, words, dimensions, with_rest=not whole)
    if not whole:
        sums = settle(sums, "sums", work)
        unsent = vectors.join(F.broadcast(df.sparkSession.createDataFrame(sent.select(["word"]))), "word", "left_anti")
        rest = _sum_joined(sums, unsent, key, **balance)
        both = F.zip_with("total", "more", lambda a, b: a + b)
        sums = sums.join(rest, key, "left").withColumn("total", F.coalesce(both, "total"))
    length = F.greatest(F.col("n_tokens"), F.lit(1))
    return sums.select(key, F.transform("total", lambda x: x / length).alias("vector"))


def _sum_sent(df: DataFrame, sent: pa.Table, key: str, words: str, dimensions: int, with_rest: bool) -> DataFrame:
    """(key, n_tokens, total, rest): sum over the tokens with a sent vector, and the other tokens."""
    known = df.sparkSession.sparkContext.broadcast(sent)
    schema = f"{key} {df.schema[key].dataType.simpleString()}, n_tokens int, total array<double>, rest array<string>"

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = known.value["word"].combine_chunks()
        matrix = known.value["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        matrix = matrix.reshape(len(vocabulary), dimensions)
        for batch in batches:
            lists = pc.fill_null(batch.column(1), [])
            tokens, row = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
            place = pc.index_in(tokens, vocabulary)
            hit = place.is_valid().to_numpy(zero_copy_only=False)
            totals = _row_sums(matrix, place.drop_null().to_numpy(), row[hit], len(batch), dimensions)
            yield pa.record_batch(
                [
                    batch.column(0),
                    pc.list_value_length(lists).cast(pa.int32()),
                    _lists(totals.ravel(), np.full(len(batch), dimensions)),
                    _lists(tokens.filter(pa.array(~hit)), np.bincount(row[~hit], minlength=len(batch)))
                    if with_rest
                    else pa.nulls(len(batch), pa.list_(pa.string())),
                ],
                names=[key, "n_tokens", "total", "rest"],
            )

    return df.select(key, words).mapInArrow(add_up, schema)


def _lists(values, lengths: np.ndarray) -> pa.ListArray:
    offsets = np.r_[0, np.cumsum(lengths)].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _row_sums(matrix: np.ndarray, place: np.ndarray, row: np.ndarray, n_rows: int, dimensions: int) -> np.ndarray:
    """Sum the matrix rows ``place`` per ``row`` (ascending), a bounded number at a time."""
    totals = np.zeros((n_rows, dimensions))
    step = max(1, _GATHER_BYTES // max(1, 8 * dimensions))
    for start in range(0, len(place), step):
        part = row[start : start + step]
        firsts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        gathered = matrix[place[start : start + step]].astype(np.float64)
        totals[part[firsts]] += np.add.reduceat(gathered, firsts, axis=0)
    return totals


def _sum_joined(sums: DataFrame, vectors: DataFrame, key: str, **balance) -> DataFrame:
    """(key, more): sum over the tokens in ``rest``, shuffled to their vectors.

    Repeats within a row are counted before the join, by word and row, so
    neither a long row nor a frequent word fills one task.
    """
    counted = word_rows(sums, "rest", key).groupBy(key, "word").agg(F.count("*").cast("double").alias("n"))
    if "count" in vectors.columns:
        balance.setdefault("hot", hot_keys(vectors.select("word", "count"), "word"))
    found = lookup_join(counted, vectors.select("word", "vector"), "word", spread=[key], **balance)
    total = Summarizer.sum(array_to_vector(F.col("vector").cast("array<double>")), F.col("n"))
    return found.groupBy(key).agg(vector_to_array(total).alias("more"))
