import random
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from termspace.operators import skipgram
from termspace.operators.similarity import nearest_terms
from termspace.operators.vocabulary import vocabulary

SMALL = skipgram.SkipGram(vector_size=16, min_count=5, window=2, epochs=4, passes=20, batch=64)


@pytest.fixture(scope="module")
def planted(spark):
    """Sentences over topics; the words even3 and odd3 stand in the same places of topic 3."""
    rng = random.Random(7)
    rows = []
    for i in range(3_000):
        topic = rng.randrange(8)
        about = [f"t{topic}w{rng.randrange(6)}" for _ in range(6)]
        about[rng.randrange(6)] = f"{rng.choice(['even', 'odd'])}{topic}"
        rows.append((i, about))
    return spark.createDataFrame(rows, "id long, words array<string>")


def vectors_of(found):
    return {r["word"]: np.array(r["vector"]) for r in found.collect()}


def test_pairs_are_those_of_the_window(spark):
    rows = [["a", "b", "a", "c"], ["c"], [], None, ["b", "a"]]
    df = spark.createDataFrame([(w,) for w in rows], "words array<string>")
    want = {}
    for words in rows:
        for i, first in enumerate(words or []):
            for second in words[i + 1 : i + 3]:
                want[first, second] = want.get((first, second), 0) + 1
    assert {(r["first"], r["second"]): r["n"] for r in skipgram.window_pairs(df, "words", 2).collect()} == want


def test_pairs_are_the_same_with_and_without_a_small_vocabulary(planted, monkeypatch, tmp_path):
    vocab = planted.select(F.explode("words").alias("word")).distinct().filter("word NOT LIKE '%w5'")
    vocab = vocab.withColumn("idx", F.row_number().over(Window.orderBy("word")).cast("long") - 1)
    found = []
    for small in (True, False):
        monkeypatch.setattr(skipgram, "fits", lambda table: small)
        rows = skipgram._indexed_pairs(planted, "words", vocab, 3, f"{tmp_path}/{small}").collect()
        found.append(sorted(map(tuple, rows)))
    assert found[0] == found[1] and len(found[0]) > 100


@pytest.mark.parametrize("small", [True, False])
def test_packed_pairs_of_chunks_are_those_of_the_window(spark, monkeypatch, tmp_path, small):
    """Without pairs of texts, whatever the size of the vocabulary, in chunks and buckets of a few tokens."""
    rng = random.Random(3)
    rows = [[rng.choice("abcdefg") for _ in range(rng.randrange(12))] for _ in range(200)] + [None, [], ["a", None, "a", "b"]]
    df = spark.createDataFrame([(w,) for w in rows], "words array<string>")
    vocab = spark.createDataFrame([(w, i) for i, w in enumerate("gbadf")], "word string, idx long")
    at, want = {w: i for i, w in enumerate("gbadf")}, {}
    for words in rows:
        for i, first in enumerate(words or []):
            for second in words[i + 1 : i + 3]:
                if first in at and second in at:
                    pair = tuple(sorted((at[first], at[second])))
                    want[pair] = want.get(pair, 0) + 1
    monkeypatch.setattr(skipgram, "window_pairs", None)
    monkeypatch.setattr(skipgram, "fits", lambda table: small)
    monkeypatch.setattr(skipgram, "TOKENS_AT_ONCE", 50)
    monkeypatch.setattr(skipgram, "PAIRS_AT_ONCE", 300)
    found = skipgram._indexed_pairs(df, "words", vocab, 2, f"{tmp_path}/work").collect()
    assert {(r["low"], r["high"]): r["n"] for r in found} == want and len(found) == len(want)


def test_words_of_chunks_are_counted_as_those_of_lists(spark):
    rows = [["a", "b", "a"], None, [], ["b", None, "c"], ["a"]]
    df = spark.createDataFrame([(w,) for w in rows], "words array<string>")
    found = [
        sorted(map(tuple, counts.collect()))
        for counts in (vocabulary(df, "words", 2), vocabulary(skipgram._texts(df, "words"), "words", 2, times="times"))
    ]
    assert found[0] == found[1] == [("a", 3), ("b", 2)]


@pytest.mark.parametrize("blocks", [1, 2, 3, 4, 5])
def test_every_pair_is_trained_once_each_way(spark, blocks):
    """A cell is kept once, and serves the turns of both its blocks."""
    rng = np.random.default_rng(blocks)
    words = 23
    codes = np.unique([min(a, b) << 32 | max(a, b) for a, b in rng.integers(0, words, (150, 2)).tolist()])
    n = rng.integers(1, 9, len(codes))
    want, met = {}, np.zeros(words)
    for one, two, times in zip(codes >> 32, codes & skipgram.LOW_BITS, n):
        for a, b in ((one, two), (two, one)):
            want[int(a), int(b)] = want.get((int(a), int(b)), 0) + times
            met[a] += times
    low, high = skipgram._split(codes).values()
    rows = [tuple(x.tobytes() for x in part) for part in zip(*(np.array_split(x, 3) for x in (low, high, n)))]
    packed = spark.createDataFrame(rows, "low binary, high binary, n binary")
    dealt = packed.mapInArrow(skipgram._to_cells(blocks), skipgram._CELLS)
    cells = dealt.groupBy("gap", "x").applyInArrow(skipgram._one_cell(blocks, words), f"{skipgram._CELLS}, first_met binary, second_met binary").cache()
    found, sums = {}, np.zeros(words)
    for turn in range(blocks):
        rows = skipgram._asked_cells(cells, turn, blocks).collect()
        assert len({r["task"] for r in rows}) == len(rows)
        for r in rows:
            cell = pa.table({c: [r[c]] for c in ("x", "first", "second", "n")})
            for a, b, times in zip(*skipgram._examples(cell, r["task"], turn)):
                pair = int(a) * blocks + r["task"], int(b) * blocks + (r["task"] + turn) % blocks
                assert pair not in found
                found[pair] = times
    assert found == want
    for r in cells.collect():
        for block, part in ((r["x"], r["first_met"]), ((r["x"] + r["gap"]) % blocks, r["second_met"]))[: 1 + (r["gap"] > 0)]:
            sums[block::blocks] += np.frombuffer(part, "<f8")
    assert (sums == met).all()


def test_gradients_of_a_word_are_added_up():
    rng = np.random.default_rng(5)
    rows, gradient = np.r_[np.full(400, 7), rng.integers(0, 300, 600), np.arange(5)], rng.normal(size=(1005, 6)).astype(np.float32)
    want = np.zeros((300, 6))
    np.add.at(want, rows, gradient)
    for words in (300, 2**17):
        distinct, total = skipgram._sums(rows, words, gradient)
        assert sorted(distinct) == sorted(set(rows.tolist()))
        assert np.allclose(total, want[distinct], atol=1e-4)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(2, 5, 4))
    label, weight = np.array([1, 0, 1, 0, 0.0]), rng.random(5) + 0.5

    def loss(x, y):
        score = 1 / (1 + np.exp(-(x * y).sum(axis=1)))
        return -(weight * (label * np.log(score) + (1 - label) * np.log(1 - score))).sum()

    by_x, by_y = skipgram.gradients(x, y, label, weight)
    for i in range(5):
        for j in range(4):
            step = np.zeros((5, 4))
            step[i, j] = 1e-6
            assert by_x[i, j] == pytest.approx((loss(x + step, y) - loss(x - step, y)) / 2e-6, abs=1e-4)
            assert by_y[i, j] == pytest.approx((loss(x, y + step) - loss(x, y - step)) / 2e-6, abs=1e-4)


@pytest.mark.parametrize("bounds", [{}, {"words_per_block": 20}, {"pairs_per_task": 200}])
def test_planted_synonyms_are_found(spark, planted, bounds):
    settings = skipgram.SkipGram(**{**SMALL.__dict__, **bounds})
    found = skipgram.train_skipgram(planted, settings=settings)
    vectors = vectors_of(found)
    assert len(vectors) == 8 * 8 and all(v.shape == (16,) and np.isfinite(v).all() for v in vectors.values())
    unit = {w: v / np.linalg.norm(v) for w, v in vectors.items()}
    topic = {w: w[1] if w[0] == "t" else w[-1] for w in unit}
    for word in (f"even{t}" for t in range(8)):
        nearest = sorted((w for w in unit if w != word), key=lambda w: -unit[word] @ unit[w])[:7]
        assert sum(topic[w] == topic[word] for w in nearest) >= 6


def test_the_seed_fixes_the_vectors_whatever_the_partitions(planted):
    settings = skipgram.SkipGram(**{**SMALL.__dict__, "epochs": 2, "words_per_block": 25})
    first, again = (vectors_of(skipgram.train_skipgram(planted.repartition(n, "id"), settings=settings)) for n in (2, 7))
    assert first.keys() == again.keys() and all((first[w] == again[w]).all() for w in first)
    other = vectors_of(skipgram.train_skipgram(planted, settings=skipgram.SkipGram(**{**settings.__dict__, "seed": 2})))
    assert any((first[w] != other[w]).any() for w in first)


def test_tables_are_computed_once_and_read_as_often_as_they_are_needed(planted, monkeypatch, tmp_path):
    """Sizes of texts and positions of words take no runs of their own."""

    def tallied(df, label):
        def tally(batches):
            rows = 0
            for batch in batches:
                rows += len(batch)
                yield batch
            (tmp_path / uuid.uuid4().hex).write_text(f"{label} {rows}")

        return df.mapInArrow(tally, df.schema)

    settle = skipgram.settle
    monkeypatch.setattr(skipgram, "settle", lambda df, label, work: tallied(settle(df, label, work), label))
    monkeypatch.setattr(skipgram, "vocabulary", lambda *args, **named: tallied(vocabulary(*args, **named), "counted"))
    monkeypatch.setattr(skipgram, "_texts", lambda *args, texts=skipgram._texts: tallied(texts(*args), "encoded"))
    found = skipgram.train_skipgram(planted.repartition(3), settings=skipgram.SkipGram(**{**SMALL.__dict__, "epochs": 1}))
    rows, words = Counter(), found.count()
    for file in tmp_path.iterdir():
        label, n = file.read_text().split()
        rows[label] += int(n)
    # Words and places of the texts; sums of the vocabulary, whether it fits, to broadcast it, for the first vectors, with the last ones.
    assert rows["encoded"] > 0 and rows["texts"] == 2 * rows["encoded"]
    assert rows["counted"] == words and rows["vocabulary"] == 5 * words


def test_cells_are_read_once_for_how_often_words_meet(spark, tmp_path):
    cells = [(0, 0, 1, 1), (0, 1, 2, 2), (1, 0, 3, 4), (1, 2, 5, 6), (2, 3, None, None)]
    spark.createDataFrame(cells, "gap long, x long, first_met long, second_met long").write.parquet(f"{tmp_path}/cells")
    met = skipgram._met(spark.read.parquet(f"{tmp_path}/cells"), 4)
    want = [(0, 1), (1, 2), (0, 3), (1, 4), (2, 5), (3, 6), (3, None), (1, None)]
    assert Counter(map(tuple, met.collect())) == Counter(want)
    assert met._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_nothing_to_train_on(spark, planted):
    assert skipgram.train_skipgram(planted.limit(0), settings=SMALL).count() == 0
    lonely = spark.createDataFrame([(["only"],)] * 6, "words array<string>")
    row = skipgram.train_skipgram(lonely, settings=SMALL).first()
    assert (row["word"], row["count"], len(row["vector"])) == ("only", 6, 16)


def test_vectors_serve_as_a_vector_table(spark, planted):
    found = skipgram.train_skipgram(planted, settings=skipgram.SkipGram(**{**SMALL.__dict__, "epochs": 1}))
    asked = spark.createDataFrame([("q", "even1")], "key string, term string")
    assert nearest_terms(asked, found).count() > 0
    assert found.filter(F.abs("norm") == 0).count() == 0
