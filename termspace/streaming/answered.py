"""Which mentions have been answered: a reply table in lots, and an index of the ids of finished lots.

Replies are appended to the lot that is open. A lot that has grown to
``LOT_FILES`` files is closed: its ids go to the index, which is parted by a hash
of the id, and a mark says that the lot is in it. So an id is known from the
index or from the open lot, whatever the time it came with. Each step may be
repeated: ids that stand in the index twice do no harm, and a lot without its
mark is read as open.

Beside the index stand the answers to expressions, for as long as the vector table
is the same one: an expression that comes again in a later batch is not scored
against all vectors again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termspace.schemas import REPLIES
from termspace.session import remove, settle

BUCKETS = 256
# Files of a lot before it is closed, and of a bucket before its files are merged.
LOT_FILES, BUCKET_FILES = 64, 32
INDEX = "id long, bucket int"
EXPRESSIONS = "key string, oov array<string>, words array<string>, bucket int"


def read_replies(spark: SparkSession, path: str) -> DataFrame | None:
    """The reply table, or None before the first batch."""
    return spark.read.schema(REPLIES).parquet(path) if _Folder(spark, path).exists() else None


def bucket_of(id_column: str):
    return F.pmod(F.xxhash64(F.col(id_column).cast("long")), F.lit(BUCKETS)).cast("int")


class _Buckets:
    """A table parted by ``bucket``, to which rows are added, by one writer at a time; some rows may stand in it twice."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, bucket_files: int):
        self.spark, self.index, self.schema, self.key, self.bucket_files = spark, path, schema, key, bucket_files

    def merge(self) -> None:
        """One file per bucket again. Old files go when their rows are in new ones."""
        old = [file for files in self._bucket_files().values() for file in files]
        self._add(self._index().dropDuplicates([self.key]))
        for file in old:
            _Folder(self.spark, file).delete()

    def _merge_if_many(self) -> None:
        if any(len(files) > self.bucket_files for files in self._bucket_files().values()):
            self.merge()

    def _add(self, rows: DataFrame) -> None:
        dealt = rows.repartition("bucket").sortWithinPartitions("bucket", self.key)
        dealt.write.mode("append").partitionBy("bucket").parquet(self.index)

    def _index(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.index)

    def _bucket_files(self) -> dict[str, list[str]]:
        parts = [n for n in _Folder(self.spark, self.index).names() if n.startswith("bucket=")]
        return {p: [f"{self.index}/{p}/{f}" for f in _Folder(self.spark, f"{self.index}/{p}").names()] for p in parts}


class AnsweredIds(_Buckets):
    """The ids of a reply table. One writer at a time, as a stream's batches are."""

    def __init__(self, spark: SparkSession, replies: str, lot_files: int = LOT_FILES, bucket_files: int = BUCKET_FILES):
        self.replies, self.lot_files = replies.rstrip("/"), lot_files
        # Names that begin with "_" are no part of the reply table.
        super().__init__(spark, f"{self.replies}/_answered", INDEX, "id", bucket_files)

    def open_lot(self) -> int:
        closed = [int(name) for name in _Folder(self.spark, f"{self.index}/_lots").names()]
        return max(closed, default=-1) + 1

    def unanswered(self, batch: DataFrame, buckets: list[int], first: int, last: int) -> DataFrame:
        """The rows of ``batch`` (id, ...) whose id has no reply; ids lie between ``first`` and ``last``, in ``buckets``.

        Only these buckets are read, and of their files only what may hold such
        ids, by the statistics of the files.
        """
        near = F.col("id").between(first, last)
        known = self._lot_ids(self.open_lot()).filter(near)
        if _Folder(self.spark, self.index).exists():
            known = known.unionByName(self._index().filter(F.col("bucket").isin(buckets) & near).select("id"))
        return batch.join(known, "id", "left_anti")

    def append(self, replies: DataFrame) -> None:
        """Add replies to the open lot, and close it when it has many files."""
        lot = self.open_lot()
        # Few files, whatever the partitions before.
        rows = replies.withColumn("lot", F.lit(lot)).hint("rebalance")
        rows.write.mode("append").partitionBy("lot").parquet(self.replies)
        if len(self._lot_files(lot)) >= self.lot_files:
            self.close(lot)

    def close(self, lot: int) -> None:
        ids = self._lot_ids(lot).withColumn("bucket", bucket_of("id"))
        self._add(ids)
        _Folder(self.spark, f"{self.index}/_lots").touch(str(lot))
        self._merge_if_many()

    def _lot_ids(self, lot: int) -> DataFrame:
        replies = read_replies(self.spark, self.replies)
        if replies is None:
            return self.spark.createDataFrame([], "id long")
        return replies.filter(F.col("lot") == lot).select(F.col("in_reply_to").alias("id"))

    def _lot_files(self, lot: int) -> list[str]:
        return _Folder(self.spark, f"{self.replies}/lot={lot}").names()


class AnsweredExpressions(_Buckets):
    """Answers to expressions by one vector table, beside the reply table; those by another table are dropped."""

    def __init__(self, spark: SparkSession, replies: str, vectors: DataFrame, bucket_files: int = BUCKET_FILES):
        folder, name = f"{replies.rstrip('/')}/_expressions", _digest(vectors)
        super().__init__(spark, f"{folder}/{name}", EXPRESSIONS, "key", bucket_files)
        for other in _Folder(spark, folder).names():
            if other != name:
                remove(spark, f"{folder}/{other}")

    def answer(self, queries: DataFrame, by: Callable[[DataFrame], DataFrame], work: str | None = None) -> DataFrame:
        """(key, terms, oov, words) of distinct expressions (key, terms); ``by`` answers those that have no answer here."""
        bucket = F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int")
        queries, known = queries.select("key", "terms"), None
        if _Folder(self.spark, self.index).exists():
            asked = [row[0] for row in queries.select(bucket).distinct().collect()]
            held = self._index().filter(F.col("bucket").isin(asked)).select("key", "oov", "words").dropDuplicates(["key"])
            known = settle(queries.join(held, "key"), "known", work)
            queries = settle(queries.join(known.select("key"), "key", "left_anti"), "unknown", work)
            if queries.isEmpty():
                return known
        fresh = settle(by(queries), "answers", work)
        self._add(fresh.select("key", "oov", "words", bucket.alias("bucket")))
        self._merge_if_many()
        return fresh if known is None else fresh.unionByName(known)


def _digest(vectors: DataFrame) -> str:
    """Tells vector tables apart by their rows, in whatever order: their count and two sums of 64-bit hashes."""
    sums = [F.sum(F.xxhash64(*columns).cast("decimal(38,0)")) for columns in (("word", "vector"), ("vector", "word"))]
    return "by" + "_".join(str(x) for x in vectors.agg(F.count("*"), *sums).first())


class _Folder:
    """A path of the cluster's file system."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        self._files = self._path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._child = lambda name: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._path, name)

    def exists(self) -> bool:
        return self._files.exists(self._path)

    def names(self) -> list[str]:
        """Names in the folder, but for hidden ones; none if there is no such folder."""
        if not self.exists():
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(self._path)]
        return [name for name in names if name[0] not in "_."]

    def touch(self, name: str) -> None:
        self._files.create(self._child(name), True).close()

    def delete(self) -> None:
        self._files.delete(self._path, False)
