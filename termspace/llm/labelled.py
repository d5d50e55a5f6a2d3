"""Bounded samples of labelled texts to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termspace.session import remove, settle


def labelled_sample(
    texts: DataFrame, labels: DataFrame | None, per_label: int, label_bytes: int, work: str
) -> list[tuple[object, int, str]]:
    """(label, place, text) of at most ``per_label`` whole texts and ``label_bytes`` bytes per label.

    ``texts``: (_id, _text), and _label unless ``labels`` (_id, _label) are
    given. Rows are taken in order of a hash of their id and text, so the same
    ones whatever the partitions; one whose text would pass the bound of bytes
    is passed over. Null and empty texts, null labels and null ids are left out.
    """
    spark = texts.sparkSession
    by_id = F.xxhash64("_id", F.lit("sample"))
    if labels is not None:
        marks = labels.dropna().withColumn("_order", by_id)
        # Bounded by the number of labels times per_label.
        marks = _first_of_each(marks, ["_id"], per_label, f"{work}/labels").select("_id", "_label")
        texts = texts.join(F.broadcast(marks), "_id")
    texts = texts.filter(F.col("_id").isNotNull() & F.col("_label").isNotNull() & (F.length("_text") > 0))
    # The keys alone are ranked; texts are read for the ranked ones only.
    keys = texts.select("_id", "_label", F.xxhash64("_text").alias("_hash"), F.octet_length("_text").alias("_bytes"))
    keys = _first_of_each(keys.withColumn("_order", by_id), ["_id", "_hash"], per_label, f"{work}/keys")
    used: dict[object, int] = {}
    chosen = []
    for row in keys.orderBy("_label", "_place").collect():
        size = used.get(row["_label"], 0) + row["_bytes"]
        if size <= label_bytes:
            used[row["_label"]] = size
            chosen.append((row["_id"], row["_label"], row["_hash"], row["_place"]))
    wanted = keys.select("_id", "_label", "_hash", "_place")
    wanted = spark.createDataFrame(chosen, wanted.schema) if chosen else wanted.limit(0)
    found = texts.withColumn("_hash", F.xxhash64("_text")).join(F.broadcast(wanted), ["_id", "_label", "_hash"])
    rows = found.groupBy("_label", "_place").agg(F.first("_text").alias("_text")).collect()
    remove(spark, work)
    return sorted(((r["_label"], r["_place"], r["_text"]) for r in rows), key=lambda r: (str(r[0]), r[1]))


def _first_of_each(rows: DataFrame, ties: list[str], most: int, work: str) -> DataFrame:
    """The first ``most`` distinct rows of every ``_label`` by ``_order``, a hash, and ``ties``; with their ``_place``.

    Of a label with n rows only hashes in the lowest 4 * most / n of their range
    are ranked, so a label with most rows brings no more to its task than
    another. Where repeated rows leave too few of them, the range is widened.
    """
    counts = settle(rows.groupBy("_label").agg(F.count("*").alias("_n")), "counts", work)
    best = Window.partitionBy("_label").orderBy("_order", *ties)
    height = F.col("_order") / F.lit(2.0**64) + 0.5
    wide, turn = 4.0 * most, 0
    while True:
        low = rows.join(F.broadcast(counts), "_label").filter(height <= F.lit(wide) / F.col("_n")).drop("_n")
        ranked = low.distinct().withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= most)
        found = settle(ranked, f"first{turn}", work)
        enough = found.groupBy("_label").agg(F.count("*").alias("_found"))
        lacking = counts.filter(F.col("_n") > wide).join(enough, "_label", "left")
        if lacking.filter(F.coalesce("_found", F.lit(0)) < most).isEmpty():
            return found
        wide, turn = wide * 8, turn + 1
