"""The mention stream: every direct mention gets one reply."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from termspace.operators.answers import LINK_BASE, direct_mentions, reply_to
from termspace.schemas import MENTIONS
from termspace.session import remove, scratch_path, settle
from termspace.streaming.answered import AnsweredExpressions, AnsweredIds, bucket_of, read_replies

__all__ = ["MentionMetrics", "answer_stream", "append_replies", "fresh_mentions", "read_mentions", "read_replies"]

POLL = "60 seconds"


def read_mentions(spark: SparkSession, path: str) -> DataFrame:
    """Stream of newline-JSON mention files, by a fixed schema."""
    return spark.readStream.schema(MENTIONS).json(path)


def fresh_mentions(mentions: DataFrame, name: str) -> DataFrame:
    """Direct mentions, however late or without time; repeated ids are told apart when they are answered."""
    return direct_mentions(mentions, name).observe(
        "mentions", F.count("*").alias("retrieved"), F.max("id").alias("last_mention_id")
    )


def answer_stream(
    mentions: DataFrame,
    vectors: DataFrame,
    name: str,
    replies: str,
    checkpoint: str,
    trigger: dict | None = None,
    link_base: str = LINK_BASE,
) -> StreamingQuery:
    """Answer the mentions of a stream and append the replies to a parquet table.

    Offsets live in the checkpoint, and the reply table tells which ids have been
    answered: should a mention come again, a batch run again, or the checkpoint
    be lost, mentions that already have a reply are left out.
    """

    def answer(batch: DataFrame, batch_id: int) -> None:
        append_replies(batch, vectors, name, replies, link_base)

    return (
        fresh_mentions(mentions, name)
        .writeStream.foreachBatch(answer)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": POLL}))
        .start()
    )


def append_replies(batch: DataFrame, vectors: DataFrame, name: str, replies: str, link_base: str = LINK_BASE, **lots) -> None:
    """Reply to the mentions of a batch that have no reply yet: one reply per id, for good.

    An id counts as answered whatever time it came with before, see
    ``AnsweredIds``. Of rows of a batch that share an id the earliest is answered,
    one without time only if there is none with; of equal times the first text,
    then the first author. A mention without id cannot be replied to and is left
    out.
    """
    spark = batch.sparkSession
    work = scratch_path(spark, "mentions")
    # The batch is read several times below; its state store must be read once.
    try:
        first = F.min(F.struct(F.col("ts").isNull().alias("late"), "ts", "text", "author")).alias("m")
        one = batch.filter(F.col("id").isNotNull()).groupBy("id").agg(first).select("id", "m.ts", "m.author", "m.text")
        batch = settle(one.withColumn("bucket", bucket_of("id")), "batch", work)
        low, high, buckets = batch.agg(F.min("id"), F.max("id"), F.collect_set("bucket")).first()
        if low is None:
            return
        answered = AnsweredIds(spark, replies, **lots)
        batch = answered.unanswered(batch.drop("bucket"), buckets, low, high)
        known = AnsweredExpressions(spark, replies, vectors)
        answered.append(reply_to(batch, vectors, name, link_base, work, known).withColumn("reply_date", F.to_date("ts")))
    finally:
        remove(spark, work)


class MentionMetrics(StreamingQueryListener):
    """How many mentions were retrieved and the newest id: of the latest batches, and in all."""

    def __init__(self, keep: int = 100):
        self.batches: deque[dict] = deque(maxlen=keep)
        self.retrieved = 0
        self.last_mention_id: int | None = None

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        seen = event.progress.observedMetrics.get("mentions")
        if seen is not None:
            seen = seen.asDict()
            self.batches.append({"batch": event.progress.batchId, **seen})
            self.retrieved += seen["retrieved"]
            ids = [i for i in (self.last_mention_id, seen["last_mention_id"]) if i is not None]
            self.last_mention_id = max(ids, default=None)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
