"""Word vectors by skip-gram with negative sampling, for vocabularies of any size.

Spark ML's Word2Vec holds all vectors on the driver. Here both vector tables
stand on shared storage, cut into blocks of words, and so are the pairs of words
that meet in a window, packed, by the blocks of their two words. An epoch has as many
turns as there are blocks: in a turn, task i trains its own block of centres
against one block of neighbours, the next one in every turn, so that no two
tasks hold the same block. Nothing but sums reaches the driver.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from termspace.operators.skew import fits, lookup_join
from termspace.operators.vocabulary import indexed_vocabulary, vocabulary
from termspace.session import remove, scratch_path, settle


# Tokens whose pairs are counted in one piece.
TOKENS_AT_ONCE = 2**20
# Pairs that are added up or dealt out in one piece, at most.
PAIRS_AT_ONCE = 2**22
# A pair of positions is one number, the lower position above the higher one's 32 bits.
LOW_BITS = 2**32 - 1
# Words that occur more often in a batch have the rest of their gradients added up by themselves.
FEW = 16


@dataclass(frozen=True)
class SkipGram:
    """``words_per_block`` bounds the vectors that a task holds (twice as many), ``pairs_per_task`` sets their pairs on average.

    In a turn a task goes ``passes`` times through its examples, with new noise words each time.
    """

    vector_size: int = 100
    min_count: int = 20
    window: int = 5
    epochs: int = 3
    passes: int = 4
    negatives: int = 5
    step_size: float = 0.1
    seed: int = 1
    words_per_block: int = 50_000
    pairs_per_task: int = 250_000
    batch: int = 4_096


_STATE = "side string, block long, mass binary, vectors binary, squares binary"


def window_pairs(df: DataFrame, words: str, window: int) -> DataFrame:
    """(first, second, n): how often the second word follows the first within ``window`` places."""
    size = F.size(words)
    at = [
        F.arrays_zip(
            F.slice(words, F.lit(1), F.greatest(size - gap, F.lit(0))).alias("first"),
            F.slice(words, F.lit(1 + gap), F.greatest(size - gap, F.lit(0))).alias("second"),
        )
        for gap in range(1, window + 1)
    ]
    rows = df.filter(size > 1).select(F.explode(F.concat(*at)).alias("pair"))
    pairs = rows.select(F.col("pair.first").alias("first"), F.col("pair.second").alias("second"))
    return pairs.groupBy("first", "second").agg(F.count("*").alias("n"))


_TEXTS = "chunk string, words array<string>, times array<long>, tokens long, places binary, sizes binary"
_PAIRS = "bucket long, low binary, high binary, n binary"
_CELLS = "gap long, x long, first binary, second binary, n binary"


def _settled_texts(df: DataFrame, words: str, work: str) -> tuple[DataFrame, int]:
    """``_texts``, written down, and their tokens, which are counted while they are written."""
    seen = Observation()
    texts = settle(_texts(df, words).observe(seen, F.sum("tokens").alias("tokens")), "texts", work)
    return texts, seen.get["tokens"] or 0


def _texts(df: DataFrame, words: str) -> DataFrame:
    """Token lists in chunks: each distinct word of a chunk once, with its count, and the tokens as places in them."""
    listed = df.select(F.coalesce(F.col(words), F.array().cast("array<string>")).alias("words"))
    return listed.mapInArrow(_encoded, _TEXTS)


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(0)
        offsets = np.asarray(lists.offsets, dtype=np.int64)
        first = 0
        while first < len(lists):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + TOKENS_AT_ONCE, side="right")) - 1)
            coded = lists[first:last].flatten().dictionary_encode()
            places = coded.indices.fill_null(-1).to_numpy().astype("<i4")
            times = np.bincount(places[places >= 0], minlength=len(coded.dictionary))
            whole = pa.array([0, len(times)], pa.int32())
            columns = {
                "chunk": [uuid.uuid4().hex],
                "words": pa.ListArray.from_arrays(whole, coded.dictionary),
                "times": pa.ListArray.from_arrays(whole, pa.array(times, pa.int64())),
                "tokens": pa.array([len(places)], pa.int64()),
                "places": [places.tobytes()],
                "sizes": [np.diff(offsets[first : last + 1]).astype("<i4").tobytes()],
            }
            yield pa.RecordBatch.from_pydict(columns)
            first = last


def _indexed_pairs(df: DataFrame, words: str, vocab: DataFrame, window: int, work: str) -> DataFrame:
    """(low, high, n): how often two words of the vocabulary, by position, meet in a window."""

    def listed(batches):
        for batch in batches:
            low, high, n = (_joined(batch.column(c), t).astype(np.int64) for c, t in (("low", "<u4"), ("high", "<u4"), ("n", "<i8")))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (low, high, n)], names=["low", "high", "n"])

    texts, tokens = _settled_texts(df, words, work)
    return _packed_pairs(texts, tokens, vocab, window).mapInArrow(listed, "low long, high long, n long")


def _packed_pairs(texts: DataFrame, tokens: int, vocab: DataFrame, window: int) -> DataFrame:
    """The distinct pairs of ``_texts`` and their counts, packed: many to a row, dealt to buckets by hash.

    The words of a chunk are looked up, not its tokens or pairs: beside them in
    the task if the vocabulary ``fits``, else by a join on the distinct words.
    """
    index = vocab.select("word", "idx")
    buckets = max(1, math.ceil(tokens * window / PAIRS_AT_ONCE))
    if fits(index):
        found = texts.select("words", "places", "sizes").mapInArrow(_pair_counter(index, window, buckets), _PAIRS)
    else:
        asked = texts.select(F.col("chunk").alias("of"), F.posexplode("words").alias("local", "word"))
        known = lookup_join(asked, index, "word", ["of"]).select("of", "local", "idx")
        chunks = texts.select("chunk", "places", "sizes").groupBy("chunk")
        found = chunks.cogroup(known.groupBy("of")).applyInArrow(_joined_pair_counter(window, buckets), _PAIRS)
    return found.groupBy("bucket").applyInArrow(_added_up, _PAIRS)


def _pair_counter(index: DataFrame, window: int, buckets: int):
    """Pairs counted by a vocabulary that ``fits``."""
    # Sorted on the driver, which holds it anyway: Spark would read the table twice to sort it.
    known = index.toArrow().sort_by("idx")["word"].combine_chunks()
    sent = index.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                words, places, sizes = (batch.column(i)[row] for i in range(3))
                of_word = pc.index_in(words.values, value_set=sent.value).fill_null(-1).to_numpy().astype(np.int64)
                yield _dealt_pairs(of_word, places.as_py(), sizes.as_py(), window, buckets)

    return count


def _joined_pair_counter(window: int, buckets: int):
    """Pairs of a chunk whose words were looked up by a join."""

    def count(chunk: pa.Table, known: pa.Table) -> pa.Table:
        row, local = chunk.to_pylist()[0], known["local"].to_numpy()
        of_word = np.full(np.frombuffer(row["places"], "<i4").max(initial=0) + 1, -1, np.int64)
        of_word[local] = known["idx"].to_numpy()
        return pa.Table.from_batches([_dealt_pairs(of_word, row["places"], row["sizes"], window, buckets)])

    return count


def _dealt_pairs(of_word: np.ndarray, places: bytes, sizes: bytes, window: int, buckets: int) -> pa.RecordBatch:
    """A row of packed pairs, with counts, for each bucket; ``of_word``: positions in the vocabulary, or -1."""
    sizes = np.frombuffer(sizes, "<i4")
    of_list = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    # Place -1, a null token, takes the last entry.
    place = np.r_[of_word, -1].astype(np.int32)[np.frombuffer(places, "<i4")]
    codes = [np.zeros(0, np.int64)]
    for gap in range(1, window + 1):
        a, b = place[:-gap], place[gap:]
        real = (a >= 0) & (b >= 0) & (of_list[:-gap] == of_list[gap:])
        a, b = a[real], b[real]
        codes.append(np.minimum(a, b).astype(np.int64) << 32)
        codes[-1] |= np.maximum(a, b)
    codes = np.concatenate(codes)
    codes.sort()
    starts = _starts(codes)
    pairs, n = codes[starts], np.diff(np.r_[starts, len(codes)])
    del codes, starts
    bucket = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bucket >>= np.uint64(33)
    bucket %= np.uint64(buckets)
    return _rows_of(bucket.astype(np.int64), ["bucket"], lambda key: [key], **_split(pairs), n=n.astype("<i8"))


def _added_up(rows: pa.Table) -> pa.Table:
    """Packed pairs of a bucket, each once, some 100,000s to a row."""
    codes = _joined(rows["low"], "<u4").astype(np.int64)
    codes <<= 32
    codes |= _joined(rows["high"], "<u4")
    # The parts are in order each, so a merge sort has little to do.
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    n = _joined(rows["n"], "<i8")[order]
    del order
    starts = _starts(codes)
    codes, n = codes[starts], np.add.reduceat(n, starts) if len(starts) else n
    return pa.Table.from_batches([_rows_of(np.arange(len(codes)) >> 18, ["bucket"], lambda key: [key], **_split(codes), n=n)])


def _split(codes: np.ndarray) -> dict[str, np.ndarray]:
    """Pairs in order as two columns: the lower positions are long runs of one value, which compress to little."""
    return {"low": (codes >> 32).astype("<u4"), "high": (codes & LOW_BITS).astype("<u4")}


def _starts(ranked: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.r_[np.ones(min(1, len(ranked)), bool), ranked[1:] != ranked[:-1]])


def _joined(packed: pa.Array | pa.ChunkedArray, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(packed.to_pylist()), dtype)


def _rows_of(key: np.ndarray, names: list[str], columns_of, **values: np.ndarray) -> pa.RecordBatch:
    """A row for each key, its columns by ``columns_of`` and then the values of the key, packed in their order."""
    narrow = key.astype(np.uint16) if key.max(initial=0) < 2**16 else key
    order = np.argsort(narrow, kind="stable")
    key = key[order]
    starts = _starts(key)
    ends = np.r_[starts, len(key)]
    columns = [pa.array(x, pa.int64()) for x in columns_of(key[starts])]
    for value in values.values():
        buffers = [None, pa.py_buffer((ends * value.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(value[order]))]
        columns.append(pa.Array.from_buffers(pa.binary(), len(starts), buffers))
    return pa.RecordBatch.from_arrays(columns, names=[*names, *values])


def _to_cells(blocks: int):
    """Pairs dealt to cells of two blocks, x and the one ``gap`` further on (half way round at most), places within them."""

    def cells(low: np.ndarray, high: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        ahead = (high - low) % blocks
        # Half way round a cell could begin at either block: it does at the lesser one.
        turned = (2 * ahead > blocks) | ((2 * ahead == blocks) & (low % blocks > high % blocks))
        first, second = np.where(turned, high, low), np.where(turned, low, high)
        key = np.where(turned, blocks - ahead, ahead) * blocks + first % blocks
        places = {"first": (first // blocks).astype("<u4"), "second": (second // blocks).astype("<u4")}
        return _rows_of(key, ["gap", "x"], lambda key: [key // blocks, key % blocks], **places, n=n)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for low, high, n in zip(*(batch.column(c).to_pylist() for c in ("low", "high", "n"))):
                held.append((np.frombuffer(low, "<u4"), np.frombuffer(high, "<u4"), np.frombuffer(n, "<i8")))
                size += len(held[-1][0])
                if size >= PAIRS_AT_ONCE // 4:
                    yield cells(*(np.concatenate(x).astype(np.int64) for x in zip(*held)))
                    held, size = [], 0
        if size:
            yield cells(*(np.concatenate(x).astype(np.int64) for x in zip(*held)))

    return deal


def _met(cells: DataFrame, blocks: int) -> DataFrame:
    """(block, met): how often its words meet others, of both blocks of each cell, which are one if there is no gap."""
    first = F.struct(F.col("x").alias("block"), F.col("first_met").alias("met"))
    second = F.struct(F.pmod(F.col("x") + F.col("gap"), F.lit(blocks)).alias("block"), F.col("second_met").alias("met"))
    return cells.select(F.inline(F.when(F.col("gap") > 0, F.array(first, second)).otherwise(F.array(first))))


def _one_cell(blocks: int, words: int):
    """The parts of a cell as one row, and how often each word of its two blocks meets one of the other."""

    def join(rows: pa.Table) -> pa.Table:
        gap, x = rows["gap"][0].as_py(), rows["x"][0].as_py()
        first, second, n = (_joined(rows[c], t) for c, t in (("first", "<u4"), ("second", "<u4"), ("n", "<i8")))
        sizes = [len(range(block, words, blocks)) for block in (x, (x + gap) % blocks)]
        met = [np.bincount(place, n, size).astype("<f8") for place, size in zip((first, second), sizes)]
        if gap == 0:
            met = [met[0] + met[1]] * 2
        packed = {"first": first, "second": second, "n": n, "first_met": met[0], "second_met": met[1]}
        keys = {"gap": pa.array([gap], pa.int64()), "x": pa.array([x], pa.int64())}
        return pa.table(keys | {c: [v.tobytes()] for c, v in packed.items()})

    return join


def gradients(x: np.ndarray, y: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the weighted logistic loss of x.y against the label, by x and by y."""
    score = 1 / (1 + np.exp(-np.clip(np.einsum("ij,ij->i", x, y), -30, 30)))
    pull = (weight * (score - label)).astype(np.float32)[:, None]
    return pull * y, pull * x


def _sums(rows: np.ndarray, words: int, gradient: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``rows`` and the sums of their gradients: most words occur a few times in a batch, a few very often."""
    order = np.argsort(rows.astype(np.uint16) if words <= 2**16 else rows, kind="stable")
    ranked = rows[order]
    starts = _starts(ranked)
    length = np.diff(np.r_[starts, len(rows)])
    by_length = np.argsort(-length, kind="stable")
    starts, length = starts[by_length], length[by_length]
    total = gradient[order[starts]]
    for k, longer in enumerate(np.searchsorted(-length, -np.arange(1, FEW), side="left"), 1):
        total[:longer] += gradient[order[starts[:longer] + k]]
    for i in range(np.searchsorted(-length, -FEW, side="left")):
        total[i] += gradient[order[starts[i] + FEW : starts[i] + length[i]]].sum(axis=0)
    return ranked[starts], total


def _step(vectors: np.ndarray, squares: np.ndarray, rows: np.ndarray, gradient: np.ndarray, size: float) -> None:
    """One step with a rate per word (AdaGrad): gradients of a batch are added up by word first."""
    rows, total = _sums(rows, len(vectors), gradient)
    squares[rows] += np.einsum("ij,ij->i", total, total) / total.shape[1]
    vectors[rows] -= (size / np.sqrt(squares[rows] + 1e-12)).astype(np.float32)[:, None] * total


def _asked_cells(cells: DataFrame, turn: int, blocks: int) -> DataFrame:
    """The cells of a turn, each by the block whose words are its centres, ``task``."""
    x, apart = F.col("x"), min(turn, blocks - turn)
    beyond = F.pmod(x + apart, F.lit(blocks))
    # Half way round, a cell serves both of its blocks in one turn.
    centres = [x] if 2 * turn < blocks else [beyond] if 2 * turn > blocks else [x, beyond]
    return cells.filter(F.col("gap") == apart).select(F.explode(F.array(*centres)).alias("task"), "x", "first", "second", "n")


def _examples(cell: pa.Table, block: int, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centre, other, n) in order, of the cell in which a block of centres meets its neighbours in a turn, or of none."""
    # Word i stands at place i // blocks of block i % blocks.
    centre, other = (_joined(cell[c], "<u4").astype(np.int64) for c in ("first", "second"))
    n = _joined(cell["n"], "<i8").astype(float)
    if turn == 0:
        # Each word is the centre of a pair once, so twice of a pair with itself.
        two = centre != other
        centre, other, n = np.r_[centre, other[two]], np.r_[other, centre[two]], np.r_[np.where(two, n, 2 * n), n[two]]
    elif cell["x"].to_pylist() not in ([], [block]):
        centre, other = other, centre
    order = np.argsort(centre << 32 | other)
    return centre[order], other[order], n[order]


def _trainer(settings: SkipGram, blocks: int, turn: int, epoch: int, noise: float):
    def train(state: pa.Table, pairs: pa.Table) -> pa.Table:
        dims, rows = settings.vector_size, {r["side"]: r for r in state.to_pylist()}
        block = rows["centre"]["block"]
        mass, vectors, squares = {}, {}, {}
        for side, row in rows.items():
            mass[side] = np.frombuffer(row["mass"], "<f8")
            vectors[side] = np.frombuffer(row["vectors"], "<f4").reshape(-1, dims).copy()
            squares[side] = np.frombuffer(row["squares"], "<f4").copy()
        centre, other, n = _examples(pairs, block, turn)
        rng = np.random.default_rng([settings.seed, epoch, turn, block])
        # Noise words stand for all that a centre would draw from this block, as often as it occurs.
        share = mass["other"].sum() / noise
        upto = np.cumsum(mass["other"]) / mass["other"].sum()
        met = np.flatnonzero(mass["centre"])
        draws = np.maximum(np.bincount(centre, minlength=len(mass["centre"])), settings.negatives)[met]
        drawn_for = np.repeat(met, draws)
        c_all = np.r_[centre, drawn_for]
        label = np.r_[np.ones(len(n)), np.zeros(len(drawn_for))]
        weight = np.r_[n, np.repeat(mass["centre"][met] * share * settings.negatives / draws, draws)]
        for _ in range(settings.passes):
            drawn = np.minimum(np.searchsorted(upto, rng.random(len(drawn_for)), side="right"), len(upto) - 1)
            o_all = np.r_[other, drawn]
            order = rng.permutation(len(c_all))
            mixed = [x[order] for x in (c_all, o_all, label, weight)]
            for first in range(0, len(order), settings.batch):
                c, o, *rest = (x[first : first + settings.batch] for x in mixed)
                by_centre, by_other = gradients(vectors["centre"][c], vectors["other"][o], *rest)
                _step(vectors["centre"], squares["centre"], c, by_centre, settings.step_size)
                _step(vectors["other"], squares["other"], o, by_other, settings.step_size)
        sides = list(rows)
        return pa.table(
            {
                "side": sides,
                "block": pa.array([rows[s]["block"] for s in sides], pa.int64()),
                "mass": [rows[s]["mass"] for s in sides],
                "vectors": [vectors[s].tobytes() for s in sides],
                "squares": [squares[s].tobytes() for s in sides],
            }
        )

    return train


def _first_state(settings: SkipGram, blocks: int):
    def start(key: tuple, words: pa.Table, parts: pa.Table) -> pa.Table:
        block, dims = key[0].as_py(), settings.vector_size
        words = words.sort_by("idx")
        rng = np.random.default_rng([settings.seed, block])
        random = ((rng.random((len(words), dims), np.float32) - 0.5) / dims).astype("<f4")
        zeros, squares = np.zeros((len(words), dims), "<f4"), np.zeros(len(words), "<f4")
        noise = words["count"].to_numpy().astype(float) ** 0.75
        met = _joined(parts["met"], "<f8").reshape(-1, len(words)).sum(axis=0)
        return pa.table(
            {
                "side": ["centre", "other"],
                "block": pa.array([block] * 2, pa.int64()),
                "mass": [met.astype("<f8").tobytes(), noise.astype("<f8").tobytes()],
                "vectors": [random.tobytes(), zeros.tobytes()],
                "squares": [squares.tobytes()] * 2,
            }
        )

    return start


def train_skipgram(df: DataFrame, words: str = "words", settings: SkipGram = SkipGram(), work: str | None = None) -> DataFrame:
    """(word, idx, count, vector, norm) of every word seen ``min_count`` times in the token lists of ``df``.

    The pairs are those of the lists as they stand: a rare word between two
    others counts as a place of the window. A pair that occurs n times is one
    example of weight n, and noise words are weighted likewise, so the work
    follows the distinct pairs. The seed fixes the vectors, whatever the
    partitions of ``df``; the number of blocks, which follows from the
    vocabulary, takes part in it. Null and empty lists have no pairs; words that
    meet no other keep their first, random vector. No word often enough: no rows.
    """
    spark = df.sparkSession
    work = work or scratch_path(spark, "skip-gram")
    texts, tokens = _settled_texts(df, words, work)
    # Kept until they have positions: the sort by range samples its rows first, and would add the counts up a second time.
    counted = vocabulary(texts, "words", settings.min_count, times="times").persist(StorageLevel.DISK_ONLY)
    vocab = settle(indexed_vocabulary(counted, work), "vocabulary", work)
    counted.unpersist()
    row = vocab.agg(F.count("*").alias("n"), F.sum(F.pow("count", F.lit(0.75))).alias("noise")).first()
    met = settle(_packed_pairs(texts, tokens, vocab, settings.window), "indexed", work)
    remove(spark, f"{work}/texts")
    distinct = met.agg(F.sum(F.octet_length("n") / 8).cast("long")).first()[0] or 0
    # As many tasks train at a time as there are blocks, and meet as many blocks of neighbours.
    blocks = max(1, math.ceil(row["n"] / settings.words_per_block), math.ceil(math.sqrt(2 * distinct / settings.pairs_per_task)))
    # A cell of two blocks serves two turns: the one's words are centres in the first, the other's in the second.
    dealt = met.select("low", "high", "n").mapInArrow(_to_cells(blocks), _CELLS).groupBy("gap", "x")
    schema = f"{_CELLS}, first_met binary, second_met binary"
    path = f"{work}/cells"
    dealt.applyInArrow(_one_cell(blocks, row["n"]), schema).write.partitionBy("gap").parquet(path)
    remove(spark, f"{work}/indexed")
    cells = spark.read.schema(schema).parquet(path)

    placed = vocab.select(F.pmod("idx", F.lit(blocks)).alias("block"), "idx", "count").groupBy("block")
    state = settle(placed.cogroup(_met(cells, blocks).groupBy("block")).applyInArrow(_first_state(settings, blocks), _STATE), "state", work)
    before = f"{work}/state"
    for epoch in range(settings.epochs):
        for turn in range(blocks):
            own = F.when(F.col("side") == "centre", F.col("block")).otherwise(F.pmod(F.col("block") - turn, F.lit(blocks)))
            tasks = state.withColumn("task", own).groupBy("task")
            examples = _asked_cells(cells, turn, blocks).groupBy("task")
            train = _trainer(settings, blocks, turn, epoch, row["noise"] or 1.0)
            state = settle(tasks.cogroup(examples).applyInArrow(train, _STATE), f"state-{epoch}-{turn}", work)
            remove(spark, before)
            before = f"{work}/state-{epoch}-{turn}"

    def listed(batches):
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = np.frombuffer(packed, "<f4")
                size = settings.vector_size
                n = len(values) // size
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * size, pa.int32()), pa.array(values))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(n) * blocks + block), vectors], names=["idx", "vector"])

    vectors = state.filter("side = 'centre'").select("block", "vectors").mapInArrow(listed, "idx long, vector array<float>")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x))
    return vocab.join(vectors, "idx").select("word", "idx", "count", "vector", norm.alias("norm"))
