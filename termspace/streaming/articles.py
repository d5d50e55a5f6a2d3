"""Incremental conversion: new files are converted once, exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from termspace.schemas import FILES, JATS_STYLE
from termspace.sources.articles import collection_articles, extract_articles, file_articles
from termspace.sources.streams import tasks_can_open


def convert_new_files(
    spark: SparkSession,
    source: str,
    output: str,
    checkpoint: str,
    kind: str = "collection",
    style: dict[str, str] = JATS_STYLE,
    trigger: dict | None = None,
    compressed: str | None = None,
    spread: int | None = None,
) -> StreamingQuery:
    """Convert the files that are new since the last run and append them to ``output``.

    The checkpoint remembers the files, and the parquet sink commits a batch as
    a whole, so a failed run leaves neither gaps nor halves. Bad articles go to
    the partition ``status=quarantine`` of the same table. ``compressed="gz"``:
    the files are tar.gz archives. Of a cut or damaged archive or gzip
    collection what comes before the break is converted, and the break becomes a
    quarantine row; a read that fails fails the run, and the next one takes the
    file again.
    """
    if kind == "collection":
        raw = collection_articles(spark, spark.readStream, source, tasks_can_open(spark, source), spread)
    elif kind == "files":
        files = spark.readStream.format("binaryFile").schema(FILES).load(source)
        raw = file_articles(files, compressed, tasks_can_open(spark, source), spread)
    else:
        raise ValueError(f"kind: collection or files, not {kind!r}")
    status = F.when(F.col("error").isNull(), "article").otherwise("quarantine")
    return (
        extract_articles(raw, style)
        .withColumn("status", status)
        .writeStream.format("parquet")
        .partitionBy("status")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_converted(spark: SparkSession, output: str) -> tuple[DataFrame, DataFrame]:
    """(articles, quarantine) of a converted table, each by partition pruning."""
    table = spark.read.parquet(output)
    articles = table.filter("status = 'article'").drop("status", "error", "xml")
    return articles, table.filter("status = 'quarantine'").select("source_file", "error", "xml")
