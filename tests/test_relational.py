import pytest
from pyspark.sql import functions as F

from termspace.operators import relational
from termspace.operators import vocabulary as vocabulary_module
from termspace.operators.skew import fits, hot_keys, lookup_join
from termspace.operators.vocabulary import by_frequency, dense_index, vocabulary
from termspace.plans import catalog


def test_dedup_takes_the_first_and_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 3), (None, 4)], "k string, n int")
    assert sorted(r["n"] for r in relational.dedup(df, ["k"], ["n"]).collect()) == [1, 3, 4]
    assert sorted(r["n"] for r in relational.dedup(df, ["k"], ["n"], "collapse").collect()) == [1, 3]
    with pytest.raises(ValueError):
        relational.dedup(df, ["k"], ["n"], "other")


def test_dedup_cuts_copies_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), "id")
    plan = relational.dedup(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    a = {r["k"] for r in relational.sample(df.repartition(3), 0.2, "k").collect()}
    b = {r["k"] for r in relational.sample(df.repartition(7), 0.2, "k").collect()}
    assert a == b and 300 < len(a) < 500
    assert a != {r["k"] for r in relational.sample(df, 0.2, "k", seed=1).collect()}
    assert relational.sample(df, None, "k").count() == 2000
    with pytest.raises(ValueError):
        relational.sample(df, 1.5, "k")


def test_explode(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "n int, l array<string>")
    assert [tuple(r)[2] for r in relational.explode_column(df, "l", "x").collect()] == ["a", "b"]
    assert relational.explode_column(df, "l", "x", outer=True).count() == 4


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("options", [{}, {"broadcast_small": False}, {"broadcast_small": False, "rows_per_copy": 10}])
def test_lookup_join_equals_a_plain_join(spark, how, options):
    # One key holds a third of the rows.
    facts = spark.range(900).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k")
    )
    table = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(40)], "k string, v int")
    found = lookup_join(facts, table, "k", spread=["id"], how=how, **options).select("id", "k", "v")
    plain = facts.join(table, "k", how).select("id", "k", "v")
    assert found.exceptAll(plain).count() == 0 and plain.exceptAll(found).count() == 0


def test_hot_keys_are_split_evenly(spark):
    counts = spark.createDataFrame([("a", 95), ("b", 10), ("c", 11)], "k string, count long")
    assert {r["k"]: r["_copies"] for r in hot_keys(counts, "k", 10).collect()} == {"a": 10, "c": 2}


def test_fits(spark):
    df = spark.range(100).select("id", F.lit("x" * 50).alias("s"), F.array(F.lit(1.0), F.lit(2.0)).alias("v"))
    assert fits(df)
    assert not fits(df, rows=99)
    assert not fits(df, size=5000)


def test_vocabulary_and_index(spark):
    words = ["b"] * 3 + ["a"] * 3 + ["c"] * 5 + ["d"]
    df = spark.createDataFrame([(words,), ([],), (None,)], "words array<string>")
    counted = vocabulary(df, min_count=2)
    rows = dense_index(counted, by_frequency()).collect()
    assert sorted((r["idx"], r["word"], r["count"]) for r in rows) == [(0, "c", 5), (1, "a", 3), (2, "b", 3)]


def test_index_over_many_partitions(spark):
    df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("word"), (F.col("id") % 7).alias("count"))
    rows = dense_index(df.repartition(6), by_frequency()).orderBy("idx").collect()
    assert [r["idx"] for r in rows] == list(range(5000))
    order = [(-r["count"], r["word"]) for r in rows]
    assert order == sorted(order)


def documents_at(spark, path, rows):
    """A table of documents as the queries read it, in two files."""
    made = spark.createDataFrame(rows, "doc_id long, text string").repartition(2, "doc_id")
    made.write.parquet(f"{path}/documents.parquet")
    return str(path)


def shuffled_rows(node):
    """Rows that the shuffles of a plan that has run wrote, the last shuffle first."""
    name, found = node.getClass().getSimpleName(), []
    if name == "AdaptiveSparkPlanExec":
        return shuffled_rows(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return shuffled_rows(node.plan())
    if name == "ShuffleExchangeExec":
        found.append(node.metrics().apply("shuffleRecordsWritten").value())
    for i in range(node.children().size()):
        found += shuffled_rows(node.children().apply(i))
    return found


@pytest.mark.parametrize("small", [True, False])
def test_documents_of_a_word_are_counted_whatever_their_ids(spark, monkeypatch, tmp_path, small):
    """Ids in several rows, of one text or more, rows that come twice, no id, no text, no words."""
    rows = [(1, "a b a"), (2, "A c"), (2, "a d"), (3, "b b"), (3, "b b"), (None, "a e"), (None, "a"), (4, None), (5, ""), (6, "-")]
    rows += [(7, "f"), (7, None), (8, "a g"), (8, None), (None, None)]
    seen = [(word.lower(), doc) for doc, text in rows for word in (text or "").split() if word != "-"]
    want = {w: (sum(w == x for x, _ in seen), len({d for x, d in seen if x == w and d is not None})) for w, _ in seen}
    monkeypatch.setattr(vocabulary_module, "fits", lambda table: small)
    found = catalog.explode_tokens(spark, documents_at(spark, tmp_path, rows)).collect()
    assert {r["word"]: (r["n"], r["n_docs"]) for r in found} == want and len(found) == len(want)
    assert want["a"] == (7, 3) and want["e"] == (1, 0) and want["b"] == (5, 2)


def test_words_are_not_kept_for_each_document_of_one_row(spark, tmp_path):
    """A task sends a row for each of its words, and one more for each word of a document whose id comes again."""
    rows = [(i, " ".join(f"w{j}" for j in range(50))) for i in range(200)]
    for name, more in (("alone", []), ("again", [(0, "w0 x")])):
        counted = catalog.explode_tokens(spark, documents_at(spark, tmp_path / name, rows + more))
        assert {(r["n"], r["n_docs"]) for r in counted.collect()} == ({(200, 200)} if not more else {(200, 200), (201, 200), (1, 1)})
        tasks = spark.sparkContext.defaultParallelism
        first = shuffled_rows(counted._jdf.queryExecution().executedPlan())[1]
        assert 50 <= first <= tasks * 51 + 51 * len(more)
