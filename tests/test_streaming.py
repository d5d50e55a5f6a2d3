import pytest
from pyspark.sql import functions as F

from termspace.operators import answers
from termspace.plans import catalog
from termspace.streaming import articles as article_stream
from termspace.streaming import mentions as stream

SF = "/root/testdata/sf0.001"
NOW = {"availableNow": True}
COLUMNS = ["in_reply_to", "author", "kind", "reply", "url"]


@pytest.fixture()
def inputs(spark, tmp_path):
    """Mentions in three files, 30 of them twice."""
    mentions = catalog.event_mentions(spark, SF).coalesce(1).orderBy("id")
    source = tmp_path / "mentions"
    lots = ("id < 400", "id >= 370 and id < 700", "id >= 700")
    for i, lot in enumerate(lots):
        mentions.filter(lot).write.json(str(tmp_path / f"lot{i}"))

    def arrive(i):
        source.mkdir(exist_ok=True)
        for file in (tmp_path / f"lot{i}").glob("part-*.json"):
            (source / f"{i}-{file.name}").write_bytes(file.read_bytes())

    return mentions, str(source), arrive


def run(spark, source, tmp_path, checkpoint="progress"):
    query = stream.answer_stream(
        stream.read_mentions(spark, source),
        catalog.id_vectors(spark, SF),
        "bot",
        str(tmp_path / "replies"),
        str(tmp_path / checkpoint),
        trigger=NOW,
    )
    query.awaitTermination()
    return sorted(map(tuple, stream.read_replies(spark, str(tmp_path / "replies")).select(COLUMNS).collect()))


def test_stream_equals_batch_and_restarts_add_nothing(spark, inputs, tmp_path):
    mentions, source, arrive = inputs
    metrics = stream.MentionMetrics()
    spark.streams.addListener(metrics)
    batch = answers.reply_to(mentions, catalog.id_vectors(spark, SF), "bot").select(COLUMNS)
    want = sorted(map(tuple, batch.collect()))
    arrive(0)
    first = run(spark, source, tmp_path)
    assert first == [r for r in want if r[0] < 400]
    arrive(1)
    arrive(2)
    assert run(spark, source, tmp_path) == want
    # Nothing new; then a lost checkpoint and everything read again.
    assert run(spark, source, tmp_path) == want
    assert run(spark, source, tmp_path, "other-progress") == want
    spark.streams.removeListener(metrics)
    assert sum(b["retrieved"] for b in metrics.batches) >= len(want)
    assert max(b["last_mention_id"] or 0 for b in metrics.batches) == want[-1][0]


def test_a_batch_that_was_half_written_is_completed(spark, inputs, tmp_path):
    mentions, _, _ = inputs
    vectors, replies = catalog.id_vectors(spark, SF), str(tmp_path / "replies")
    stream.append_replies(mentions.filter("id < 100"), vectors, "bot", replies)
    stream.append_replies(mentions.filter("id < 200"), vectors, "bot", replies)
    ids = [r[0] for r in stream.read_replies(spark, replies).select("in_reply_to").collect()]
    direct = answers.direct_mentions(mentions.filter("id < 200"), "bot")
    assert sorted(ids) == sorted(r["id"] for r in direct.collect())


def test_an_empty_batch_writes_nothing(spark, inputs, tmp_path):
    mentions, _, _ = inputs
    stream.append_replies(mentions.filter("id < 0"), catalog.id_vectors(spark, SF), "bot", str(tmp_path / "replies"))
    assert stream.read_replies(spark, str(tmp_path / "replies")) is None


def test_conversion_takes_each_file_once(spark, tmp_path):
    article = '<article><front><article-meta><article-id pub-id-type="doi">{}</article-id></article-meta></front></article>'
    source, output, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    (tmp_path / "in").mkdir()

    def convert():
        article_stream.convert_new_files(spark, source, output, progress).awaitTermination()
        good, bad = article_stream.read_converted(spark, output)
        return sorted(r["doi"] for r in good.collect()), bad.count()

    (tmp_path / "in" / "a.xml").write_text("<all>" + article.format("a1") + article.format("a2") + "</all>")
    assert convert() == (["a1", "a2"], 0)
    (tmp_path / "in" / "b.xml").write_text("<all>" + article.format("b1") + "<article><x></article>" + "</all>")
    assert convert() == (["a1", "a2", "b1"], 1)
    assert convert() == (["a1", "a2", "b1"], 1)


def test_conversion_of_single_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    article = '<article><front><article-meta><article-id pub-id-type="doi">x</article-id></article-meta></front></article>'
    (tmp_path / "in" / "a.xml").write_text("junk\n" + article)
    (tmp_path / "in" / "b.xml").write_text("nothing")
    output = str(tmp_path / "out")
    article_stream.convert_new_files(
        spark, str(tmp_path / "in"), output, str(tmp_path / "progress"), kind="files"
    ).awaitTermination()
    good, bad = article_stream.read_converted(spark, output)
    assert [r["doi"] for r in good.collect()] == ["x"] and [r["error"] for r in bad.collect()] == ["no article"]


def test_late_and_timeless_mentions_are_passed_on(spark, tmp_path):
    from termspace.schemas import MENTIONS

    schema = MENTIONS.simpleString()
    rows = [(1, "2024-01-09 00:00:00", "a", "@bot x"), (2, "2024-01-01 00:10:00", "a", "@bot x"), (3, None, "a", "@bot x")]
    df = spark.createDataFrame(rows, "id long, ts string, author string, text string")
    df.withColumn("ts", F.col("ts").cast("timestamp")).write.json(str(tmp_path / "in"))
    fresh = stream.fresh_mentions(stream.read_mentions(spark, str(tmp_path / "in")), "bot")
    assert fresh.schema.simpleString() == schema
    query = fresh.writeStream.format("memory").queryName("fresh_mentions").trigger(**NOW).start()
    query.awaitTermination()
    assert spark.table("fresh_mentions").count() == 3


def test_metrics_keep_a_bounded_summary():
    from types import SimpleNamespace

    from pyspark.sql import Row

    metrics = stream.MentionMetrics(keep=2)
    for i in range(5):
        seen = Row(retrieved=3, last_mention_id=10 - i)
        metrics.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(batchId=i, observedMetrics={"mentions": seen})))
    assert len(metrics.batches) == 2 and metrics.retrieved == 15 and metrics.last_mention_id == 10
