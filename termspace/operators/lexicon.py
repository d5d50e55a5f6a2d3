"""Nouns of a text by a lexicon table (word, tag)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termspace.operators.skew import fits, lookup_join
from termspace.session import settle

NOUN_TAGS = ("NN",)


def wanted_words(lexicon: DataFrame, tags: tuple[str, ...]) -> DataFrame:
    """(word): the distinct words with one of the tags, settled."""
    return settle(lexicon.filter(F.col("tag").isin(*tags)).select("word").dropna().distinct(), "lexicon")


def noun_list(words: str, wanted: DataFrame) -> Column:
    """The words of a list column that are in ``wanted``, a table that fits."""
    sent = wanted.sparkSession.sparkContext.broadcast(wanted.toArrow()["word"].combine_chunks())

    @F.arrow_udf("array<string>")
    def keep(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = sent.value
        for lists in batches:
            filled = pc.fill_null(lists, [])
            tokens, row = pc.list_flatten(filled), pc.list_parent_indices(filled).to_numpy()
            hit = pc.is_in(tokens, known).to_numpy(zero_copy_only=False)
            sizes = np.bincount(row[hit], minlength=len(lists))
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32), mask=np.r_[lists.is_null().to_numpy(False), False])
            yield pa.ListArray.from_arrays(offsets, tokens.filter(pa.array(hit)))

    return keep(F.col(words))


def lexicon_nouns(
    df: DataFrame,
    key: str,
    words: str,
    lexicon: DataFrame,
    output: str = "nouns",
    tags: tuple[str, ...] = NOUN_TAGS,
    **balance,
) -> DataFrame:
    """(key, output): the words that the lexicon tags as wanted, order and repeats kept.

    ``key`` names a column that tells the rows apart. Rows without such words
    get an empty list, rows without words null. ``balance`` goes to lookup_join.

    A lexicon that fits is sent to every task and the lists are filtered where
    they stand; otherwise the tokens are shuffled to their entries.
    """
    wanted = wanted_words(lexicon, tags)
    if balance.get("broadcast_small", True) and fits(wanted):
        return df.select(key, noun_list(words, wanted).alias(output))
    wanted = wanted.withColumn("_noun", F.lit(True))
    given = F.col(words).isNotNull().alias("_given")
    tokens = df.select(key, given, F.posexplode_outer(words).alias("pos", "word"))
    tagged = lookup_join(tokens, wanted, "word", spread=[key, "pos"], how="left", **balance)
    # Only the nouns enter the partial lists, so a row per key and task is shuffled.
    nouns = F.sort_array(F.collect_list(F.when(F.col("_noun"), F.struct("pos", "word"))))
    listed = tagged.groupBy(key).agg(nouns.alias("_nouns"), F.first("_given").alias("_given"))
    return listed.select(key, F.when(F.col("_given"), F.transform("_nouns", lambda s: s["word"])).alias(output))
