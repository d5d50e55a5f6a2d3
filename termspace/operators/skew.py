"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termspace.session import settle

# One task should meet about this many rows of one key.
ROWS_PER_COPY = 200_000
# Slots that rows without a key are spread over.
NULL_SLOTS = 4_096

# A table within both bounds is broadcast.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 * 2**20


def fits(table: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a table is small enough to broadcast, by its row count and then its measured size."""

    def width(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(column), F.lit(0))
        if isinstance(field.dataType, (T.NumericType, T.BooleanType)):
            return F.lit(8)
        if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.NumericType):
            return 8 * F.greatest(F.size(column), F.lit(1))
        # Nested values: at least as long as text as they are in memory.
        return F.coalesce(F.octet_length(F.to_json(F.array(column))), F.lit(0))

    total = F.lit(0).cast("long")
    for field in table.schema.fields:
        total = total + width(field)
    n, held = table.agg(F.count("*"), F.sum(total)).first()
    return n <= rows and (held or 0) <= size


def hot_keys(counts: DataFrame, key: str, rows_per_copy: int = ROWS_PER_COPY) -> DataFrame:
    """(key, copies) of every key worth splitting, from a table (key, count)."""
    hot = counts.filter(F.col("count") > rows_per_copy)
    return hot.select(key, F.ceil(F.col("count") / rows_per_copy).cast("long").alias("_copies"))


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    spread: list[str],
    how: str = "inner",
    hot: DataFrame | None = None,
    rows_per_copy: int = ROWS_PER_COPY,
    broadcast_small: bool = True,
) -> DataFrame:
    """Join ``facts`` to ``table`` (one row per key) without piling up hot keys.

    A table that ``fits`` is broadcast and the facts stay where they are.
    Otherwise the hot keys are split up: the rows of a hot key are spread over
    several copies of its table row, by a hash of the ``spread`` columns, which
    should tell the rows of a key apart. ``hot`` takes a known list from
    ``hot_keys``; without it the keys of ``facts`` are counted (partial sums
    before the shuffle).
    """
    if broadcast_small and fits(table):
        return facts.join(F.broadcast(table), key, how)
    if hot is None:
        hot = hot_keys(facts.groupBy(key).count(), key, rows_per_copy)
    # The list is settled before it is measured; beyond the bound it is joined like any table.
    hot = settle(hot, "hot")
    hot = F.broadcast(hot) if fits(hot) else hot
    copies = F.coalesce(F.col("_copies"), F.lit(1))
    # A null key matches nothing, so its rows may go anywhere.
    slots = F.when(F.col(key).isNull(), NULL_SLOTS).otherwise(copies)
    left = (
        facts.join(hot, key, "left")
        .withColumn("_copy", F.pmod(F.xxhash64(*spread), slots))
        .drop("_copies")
    )
    right = (
        table.join(hot, key, "left")
        .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
        .drop("_copies")
    )
    return left.join(right, [key, "_copy"], how).drop("_copy")
