"""What several operators share: normalised text, row keys, splits, bounded bitmaps."""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words end at space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lowered(text: Column | str) -> Column:
    """A-Z to a-z, nothing else; null counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def columns_as(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under the operator's own names; others cannot clash."""
    return df.select(*[df[column].alias(name) for name, column in names.items()])


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(key: Column | str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; null for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string")) % parts


def row_key(*columns: str) -> Column:
    """64-bit key of a row's content; repeated rows share it."""
    return F.xxhash64(*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])


class Sent:
    """An object of bounded size that every task gets; its code travels along."""

    def __init__(self, spark: SparkSession, value):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def __getstate__(self):
        return {"_sent": self._sent}

    def get(self):
        if "_value" not in self.__dict__:
            self._value = cloudpickle.loads(self._sent.value)
        return self._value


def texts_of(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Texts as one array with 64-bit offsets, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an array of ``texts_of``, without copying."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def bounded_slices(offsets: np.ndarray, size: int):
    """(first, last) rows of consecutive slices of about ``size`` bytes; a longer text is a slice of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(rows, max(first + 1, last))
        yield first, last
        first = last


def sums_of(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive ``offsets``; empty stretches give 0."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


class Bitmap:
    """A set of hashed keys as a bitmap of bounded size, for pre-filters that may pass too much, never too little.

    ``bits`` grows with the number of keys up to ``MAX_BITS``; beyond that more
    keys pass by chance, which costs work and changes no result.
    """

    MIN_BITS, MAX_BITS = 2**16, 2**29

    def __init__(self, keys: DataFrame, columns: list[str]):
        n = keys.count()
        bits = self.MIN_BITS
        while bits < min(16 * n, self.MAX_BITS):
            bits *= 2
        self.bits = bits
        place = self._place(columns)
        pages = keys.select(place.alias("place")).select(
            F.bitmap_bucket_number("place").alias("_page"), F.bitmap_bit_position("place").alias("bit")
        )
        self.pages = pages.groupBy("_page").agg(F.bitmap_construct_agg("bit").alias("_bits"))

    def _place(self, columns: list[str]) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(self.bits)) + 1

    def probe(self, df: DataFrame, columns: list[str]) -> DataFrame:
        """Every row, with the page its key falls in. At most MAX_BITS / 8 bytes are broadcast."""
        asked = df.withColumn("_page", F.bitmap_bucket_number(self._place(columns)))
        return asked.join(F.broadcast(self.pages), "_page", "left")

    def keep_flag(self, columns: list[str]) -> Column:
        """Whether the key of a probed row may be in the set."""
        bit = F.bitmap_bit_position(self._place(columns)).cast("int")
        byte = F.substring(F.col("_bits"), F.floor(bit / 8).cast("int") + 1, F.lit(1))
        value = F.conv(F.hex(byte), 16, 10).cast("int")
        return F.coalesce(F.getbit(value, bit % 8) == 1, F.lit(False))

    def keep(self, df: DataFrame, columns: list[str]) -> DataFrame:
        """The rows whose key may be in the set."""
        return self.probe(df, columns).filter(self.keep_flag(columns)).drop("_page", "_bits")
