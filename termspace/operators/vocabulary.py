"""Word counts and dense positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termspace.operators.skew import fits
from termspace.session import settle


def word_rows(df: DataFrame, words: str, *keep: str) -> DataFrame:
    """(keep..., word): one row per element of a token list.

    The outer form keeps the planner from testing the list for elements first,
    which would compute the tokens of every row a second time.
    """
    rows = df.select(*keep, F.explode_outer(words).alias("word"))
    return rows.filter(F.col("word").isNotNull())


def vocabulary(df: DataFrame, words: str = "words", min_count: int = 20, times: str | None = None) -> DataFrame:
    """(word, count) of the words seen at least ``min_count`` times.

    ``times`` names a list beside the words that says how often each was seen; without it, once.
    """
    if times is None:
        seen = word_rows(df, words).groupBy("word").agg(F.count("*").alias("count"))
    else:
        rows = df.select(F.explode(F.arrays_zip(F.col(words).alias("word"), F.col(times).alias("times"))).alias("seen"))
        seen = rows.groupBy("seen.word").agg(F.sum("seen.times").alias("count")).filter(F.col("word").isNotNull())
    return seen.filter(F.col("count") >= min_count)


def lists_and_distinct(df: DataFrame, key: str, words: str) -> DataFrame:
    """(distinct, again, words): each token list as it stands and, if its row has a key, once more with each word once.

    ``again`` is the key of such a list of distinct words where other rows may have it too. All others
    count as one row of their own each, so that nothing need remember which words a key has come with.
    Keys of several rows are found in the key column alone; if there are too many to broadcast, every key counts as one.
    """
    shared = settle(df.groupBy(key).count().filter(F.col("count") > 1).select(key).dropna(), "shared")
    if fits(shared):
        df = df.join(F.broadcast(shared.withColumn("_again", F.col(key))), key, "left")
    else:
        df = df.withColumn("_again", F.col(key))
    every = F.struct(F.lit(False).alias("distinct"), F.lit(None).cast(df.schema[key].dataType).alias("again"), F.col(words).alias(words))
    once = F.when(F.col(key).isNotNull(), F.array_distinct(words))
    each = F.struct(F.lit(True).alias("distinct"), F.col("_again").alias("again"), once.alias(words))
    return df.select(F.inline_outer(F.array(every, each)))


def indexed_vocabulary(counts: DataFrame, work: str | None = None) -> DataFrame:
    """(word, count, idx): most frequent word first, words of one count by the alphabet."""
    return dense_index(counts.select("word", "count"), by_frequency(), work=work)


def by_frequency() -> list[Column]:
    """Order of the vocabulary: most frequent word first, then by the word."""
    return [F.col("count").desc(), F.col("word").asc()]


def dense_index(df: DataFrame, order: list[Column], name: str = "idx", work: str | None = None) -> DataFrame:
    """Add the 0-based position of each row in ``order``, without a one-task sort.

    Rows are range-partitioned and sorted inside the partitions; a row's position
    is the number of rows in the partitions before plus its place in its own.
    Both must come from one run of the sort, so its result is written down first.
    """
    # monotonically_increasing_id: partition number in the upper bits, place in the lower 33.
    placed = settle(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", 33))
        .withColumn("_place", F.col("_place").bitwiseAND(F.lit(2**33 - 1))),
        "places",
        work,
    )
    # One row per partition of the sort.
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_part", "_place", "_start")
    )
