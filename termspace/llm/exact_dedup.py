"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Only rows that share their length and the hash of their first bytes with
another row have their whole text hashed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termspace.llm.common import Bitmap, columns_as, lowered
from termspace.session import scratch_path, settle

PREFIX_CHARS = 128


def exact_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    carry: dict[str, Column] | None = None,
    work: str | None = None,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept): one row per row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    Of equal texts the row with the largest doc_id is kept; a null doc_id is
    below all others. Rows that repeat text and doc_id are one group, of which
    each row that carries the largest doc_id is marked as kept. ``carry`` adds
    columns computed from ``_id`` and ``_text``. Other columns are not read.
    An empty table gives an empty result.

    Each level counts its keys (one row per key and task is shuffled) and hands
    the keys of two or more rows to the next as a bitmap of bounded size; what
    passes it by chance is told apart by the next level. No text is shuffled.
    A group of copies, however large, meets others only as counts, and in the
    last join as the large side, whose partitions Spark may split.
    """
    work = work or scratch_path(docs.sparkSession, "exact")
    carry = carry or {}
    docs = columns_as(docs, _id=doc_id, _text=text).withColumn("_norm", lowered("_text"))
    shape = {
        "_length": F.octet_length("_norm"),
        "_prefix": F.xxhash64(F.substring("_norm", 1, prefix_chars)),
    }
    narrow = settle(docs.select(*[c.alias(n) for n, c in shape.items()]), "shapes", work)
    by_length = Bitmap(_repeated(narrow, ["_length"]), ["_length"])
    shapes = settle(_repeated(by_length.keep(narrow, ["_length"]), ["_length", "_prefix"]), "prefixes", work)
    by_prefix = Bitmap(shapes, ["_length", "_prefix"])

    # The second reading: only survivors of both levels have their text hashed.
    rows = docs.select("_id", "_norm", *[c.alias(n) for n, c in shape.items()], *[c.alias(n) for n, c in carry.items()])
    survivor = by_prefix.keep_flag(["_length", "_prefix"])
    rows = by_prefix.probe(rows, ["_length", "_prefix"]).select(
        "_id", F.when(survivor, F.sha2("_norm", 256)).alias("_full"), *carry
    )
    rows = settle(rows, "rows", work)
    groups = (
        rows.filter("_full IS NOT NULL")
        .groupBy("_full")
        .agg(F.max("_id").alias("_keep"), F.count("*").alias("_size"))
        .filter("_size > 1")
    )
    groups = settle(groups, "groups", work)
    alone = rows.filter("_full IS NULL").withColumns({"_keep": F.col("_id"), "_size": F.lit(1).cast("long")})
    found = rows.filter("_full IS NOT NULL").join(groups, "_full", "left").unionByName(alone)
    keep = F.when(F.col("_size") > 1, F.col("_keep")).otherwise(F.col("_id"))
    return found.select(
        F.col("_id").alias(doc_id),
        keep.alias("keep_id"),
        F.coalesce("_size", F.lit(1)).alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
        *carry,
    )


def _repeated(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).count().filter("count > 1").drop("count")
