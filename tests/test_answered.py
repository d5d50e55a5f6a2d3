"""One reply per id, whatever its time and however often it comes."""

import os

import pytest
from pyspark.sql import functions as F

from termspace.plans import catalog
from termspace.streaming import mentions as stream
from termspace.streaming.answered import AnsweredIds, bucket_of

SF = "/root/testdata/sf0.001"
SCHEMA = "id long, ts timestamp, author string, text string"


def lot(spark, *rows):
    given = spark.createDataFrame([(i, ts, a, t) for i, ts, a, t in rows], "id long, ts string, author string, text string")
    return given.withColumn("ts", F.col("ts").cast("timestamp"))


@pytest.fixture()
def answer(spark, tmp_path):
    vectors = catalog.id_vectors(spark, SF).cache()
    replies = str(tmp_path / "replies")

    def run(*rows, **lots):
        stream.append_replies(lot(spark, *rows), vectors, "bot", replies, **lots)
        table = stream.read_replies(spark, replies)
        return [] if table is None else sorted((r["in_reply_to"], r["author"]) for r in table.collect())

    run.path = replies
    return run


@pytest.mark.parametrize("lots", [{}, {"lot_files": 1, "bucket_files": 1}])
def test_an_id_with_three_times_gets_one_reply(answer, lots):
    times = ["2024-01-01 23:59:00", "2024-01-02 00:01:00", None]
    for ts in times:
        assert answer((7, ts, "a", "@bot 1"), **lots) == [(7, "a")]
    assert answer(*[(8, ts, f"b{i}", "@bot 1") for i, ts in enumerate(reversed(times))], **lots) == [(7, "a"), (8, "b2")]
    # Nothing to answer: no id, no row.
    assert answer((None, times[0], "c", "@bot 1"), **lots) == [(7, "a"), (8, "b2")]


def test_equal_times_go_by_text_then_author(answer):
    ts = "2024-01-01 00:00:00"
    assert answer((1, ts, "z", "@bot 2"), (1, ts, "y", "@bot 1"), (1, ts, "x", "@bot 1")) == [(1, "x")]


def test_only_the_buckets_of_a_batch_are_read(spark, answer):
    answer(*[(i, None, "a", "@bot 1") for i in range(40)], lot_files=1)
    answered = AnsweredIds(spark, answer.path)
    ids = lot(spark, (3, None, "a", "@bot 1"), (99, None, "a", "@bot 1"))
    buckets = [r[0] for r in ids.select(bucket_of("id")).collect()]
    left = answered.unanswered(ids, buckets, 3, 99)
    assert [r["id"] for r in left.collect()] == [99]
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("PartitionFilters: [isnotnull(bucket", "PartitionFilters: [bucket")
    assert "GreaterThanOrEqual(id,3)" in plan and "LessThanOrEqual(id,99)" in plan


def test_ids_stay_known_through_closing_merging_and_broken_steps(spark, answer):
    for start in range(0, 50, 10):
        answer(*[(i, None, "a", "@bot 1") for i in range(start, start + 10)], lot_files=2, bucket_files=1)
    answered = AnsweredIds(spark, answer.path, 2, 1)
    assert answered.open_lot() == 2
    # A lot whose ids were written but not marked is read as open, and closed again.
    answered._add(answered._lot_ids(2).withColumn("bucket", bucket_of("id")))
    everything = [(i, "2030-01-01 00:00:00", "b", "@bot 1") for i in range(50)]
    assert answer(*everything, lot_files=2) == [(i, "a") for i in range(50)]
    answered.close(2)
    answered.merge()
    assert answer(*everything, lot_files=2) == [(i, "a") for i in range(50)]
    files = [f for _, _, names in os.walk(answered.index) for f in names if f.endswith(".parquet")]
    ids = spark.read.parquet(answered.index).select("id")
    assert ids.count() == ids.distinct().count() == 50 and len(files) <= 50


def test_an_expression_is_scored_once_for_a_vector_table(spark, answer, tmp_path, monkeypatch):
    # Finding 2 of round 4: each batch scored the expressions of all batches before again.
    from termspace.operators import answers

    scored, score = [], answers.answer_expressions
    monkeypatch.setattr(
        answers, "answer_expressions", lambda q, *a, **b: scored.append(sorted(r["key"] for r in q.collect())) or score(q, *a, **b)
    )
    texts = ["@bot 1", "@bot 1 - 2 + 3", "@bot 1 + zz", "@bot 4"]
    rows = [(i, None, "a", t) for i, t in enumerate(texts)]
    answer(*rows[:2])
    # One new expression in a batch, then no new one, then files that are merged.
    answer(*rows[1:3], (10, None, "b", texts[0]))
    answer((11, None, "b", texts[1]), (12, None, "b", texts[2]))
    answer((13, None, "b", texts[0]), (3, None, "a", texts[3]))
    assert [len(keys) for keys in scored] == [2, 1, 1]
    table = {r["in_reply_to"]: (r["kind"], r["reply"].split(" ", 1)[1]) for r in stream.read_replies(spark, answer.path).collect()}
    assert sorted(table) == [0, 1, 2, 3, 10, 11, 12, 13]
    assert table[10] == table[13] == table[0] and table[11] == table[1] and table[12] == table[2]
    assert [table[i][0] for i in range(4)] == ["related", "equation", "unknown", "related"]

    # The same replies as by a batch of its own; other vectors have answers of their own.
    other = catalog.id_vectors(spark, SF).filter("word != '1'")
    again = str(tmp_path / "again")
    stream.append_replies(lot(spark, *rows), catalog.id_vectors(spark, SF), "bot", again)
    assert {r["in_reply_to"]: (r["kind"], r["reply"].split(" ", 1)[1]) for r in stream.read_replies(spark, again).collect()} == {
        i: table[i] for i in range(4)
    }
    stream.append_replies(lot(spark, (20, None, "a", texts[0])), other, "bot", again)
    assert stream.read_replies(spark, again).filter("in_reply_to = 20").first()["kind"] == "unknown"
    assert [len(keys) for keys in scored] == [2, 1, 1, 4, 1]
    assert len([x for x in os.listdir(f"{again}/_expressions") if x[0] not in "._"]) == 1


def test_known_expressions_are_merged_and_read_once(spark, tmp_path):
    from termspace.streaming.answered import AnsweredExpressions

    vectors = catalog.id_vectors(spark, SF)
    known = AnsweredExpressions(spark, str(tmp_path), vectors, bucket_files=1)
    asked = lambda *keys: spark.createDataFrame([(k, [k]) for k in keys], "key string, terms array<string>")
    by = lambda q: q.withColumns({"oov": F.array("key"), "words": F.lit(None).cast("array<string>")})
    for keys in (["a", "b"], ["a", "c"], ["b", "c", "d"]):
        got = sorted((r["key"], r["terms"], r["oov"], r["words"]) for r in known.answer(asked(*keys), by).collect())
        assert got == [(k, [k], [k], None) for k in keys]
    # A row that stands in the table twice, as after a repeated step, is read once.
    known._add(known._index())
    known.merge()
    assert all(len(files) == 1 for files in known._bucket_files().values())
    assert known._index().count() == 4
    assert AnsweredExpressions(spark, str(tmp_path), vectors.repartition(3)).index == known.index
