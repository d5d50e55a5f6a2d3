"""Scores of texts by a deleted-interpolation language model.

The chance of a token mixes the shares that it has among the tokens after the
same two words, after the same word, and anywhere, and equal chances. The
mixture weights depend on how often the longest known context occurs; they are
learned by expectation maximisation on counts that were kept back, and then
serve with the counts of all training texts.

Every word, pair and triple of the training texts is counted, however rare.
Texts are cut into slices of a few MiB. A slice asks for the counts of its
distinct n-grams, packed by groups of hashed n-grams; the askers are the
training texts themselves, so a group adds up what it is asked and answers. The
answers meet the slice again, where its texts are scored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termspace.llm.common import bounded_slices, text_bytes, texts_of
from termspace.session import scratch_path, settle

# The longest n-grams.
ORDER = 3
SLICE_BYTES = 4 * 2**20
# Tokens whose n-grams of one length meet in one group, on average.
GROUP_TOKENS = 1_000_000
# Slices that a group hears at once; beyond that their sums are added up in a second step.
BLOCK_SLICES = 8_192
ROUNDS = 200
# Keys of the end of a text and of what stands before it, which are no words.
END, START = 0, 1
_UNTAUGHT, _KEPT, _HELD = range(3)
_WORD_BITS = 63
_SPAN = 64
_STEPS = 1


# Tokens and n-grams.


def word_keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, place of each token among them, bounds of the texts): words and ends in order."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    bounds = np.asarray(words.offsets, dtype=np.int64)
    words = words.flatten()
    real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    # Words before each text, without the empty pieces at its ends.
    before = np.r_[0, np.cumsum(real)][bounds - bounds[0]]
    coded = words.filter(pa.array(real)).dictionary_encode()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    keys = np.r_[np.uint64(END), np.maximum(hashes >> np.uint64(1), np.uint64(START + 1))]
    place = np.insert(coded.indices.to_numpy().astype(np.int64) + 1, before[1:], 0)
    return keys, place, before + np.arange(len(before))


def _mixed(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """One 64-bit hash of a context's hash and a token's."""
    mixed = context * np.uint64(0x9E3779B97F4A7C15) + token
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def _before(values: np.ndarray, bounds: np.ndarray, first) -> np.ndarray:
    """The value of the token before; ``first`` at the beginning of a text (every text has an end)."""
    shifted = np.empty_like(values)
    shifted[1:] = values[:-1]
    shifted[bounds[:-1]] = first
    return shifted


@dataclass
class Layout:
    """How n-grams are told apart and grouped."""

    order: int
    groups: int  # of n-grams of each length
    bits: int  # of a pair's or triple's key: 18 more than count them, so one in some 2^18 or fewer shares its key

    def width(self, length: int) -> int:
        return _WORD_BITS if length == 1 else self.bits

    def group(self, keys: np.ndarray, length: int) -> np.ndarray:
        """Ascending with the key."""
        width = self.width(length)
        top = min(31, width)
        return ((keys >> (width - top)) * self.groups) >> top

    def grams(self, texts: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """(bounds of the texts, per length: distinct keys in order, place of each token's, how often each occurs)."""
        words, place, bounds = word_keys(texts)
        distinct, back = np.unique(words.astype(np.int64), return_inverse=True)
        place = back.ravel()[place]
        found = [(distinct, place, np.bincount(place, minlength=len(distinct)))]
        hashes, outside = distinct.astype(np.uint64)[place], np.full(1, START, np.uint64)
        context = hashes
        for length in range(2, self.order + 1):
            context = _mixed(_before(context, bounds, outside[0]), hashes)
            outside = _mixed(outside, np.full(1, START, np.uint64))
            keys = (context >> np.uint64(64 - self.width(length))).astype(np.int64)
            distinct, back, n = np.unique(keys, return_inverse=True, return_counts=True)
            found.append((distinct, back.ravel(), n))
        return bounds, found


def _pack(values: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes as the largest needs, all first bytes first, so that they compress."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = np.ascontiguousarray(values, dtype="<i8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + planes.T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    values = np.zeros((planes.shape[1], 8), np.uint8)
    values[:, : data[0]] = planes.T
    return values.view("<i8").ravel()


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=0))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data))


def _pack_texts(texts: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.record_batch([texts], names=["text"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack_texts(data: bytes) -> pa.Array:
    return pa.ipc.open_stream(data).read_all()["text"].combine_chunks()


# Counts.


def _cut(slice_bytes: int):
    """Slices of texts of one kind: not learned from, learned from, kept back."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_ = TaskContext.get().partitionId() << 32
        for batch in batches:
            train, held = (batch.column(i).to_numpy(zero_copy_only=False).astype(bool) for i in (2, 3))
            kinds = np.where(train, np.where(held, _HELD, _KEPT), _UNTAUGHT)
            for kind in np.unique(kinds).tolist():
                rows = pa.array(np.flatnonzero(kinds == kind))
                ids, texts = batch.column(0).take(rows), texts_of(batch.column(1).take(rows))
                for first, last in bounded_slices(text_bytes(texts)[1], slice_bytes):
                    listed = pa.ListArray.from_arrays(pa.array([0, last - first], pa.int32()), ids[first:last])
                    part = texts[first:last]
                    size = len(text_bytes(part)[0]) + len(part)
                    columns = [pa.array([slice_]), pa.array([kind], pa.int32()), pa.array([size]), listed, pa.array([_pack_texts(part)])]
                    yield pa.RecordBatch.from_arrays(columns, names=["slice", "kind", "size", "ids", "texts"])
                    slice_ += 1

    return cut


_ASKED = "part long, block int, slice long, kind int, keys binary, n binary"
_ANSWERED = "slice long, kind int, part long, n binary, kept binary, types long, tokens long, kept_tokens long, texts long, kept_texts long"
_STATS = ("types", "tokens", "kept_tokens", "texts", "kept_texts")


def _ask(layout: Layout, blocks: int):
    """One packed row per slice and group: distinct n-grams, and how often the slice has them."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slice_, kind, texts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                _, grams = layout.grams(_unpack_texts(texts))
                rows = []
                for length, (keys, _, n) in enumerate(grams, 1):
                    group = layout.group(keys, length)
                    cuts = np.r_[0, np.flatnonzero(np.diff(group)) + 1, len(group)]
                    for first, last in zip(cuts.tolist(), cuts[1:].tolist()):
                        part = int(group[first]) * layout.order + length - 1
                        data = _pack_sorted(keys[first:last]), _pack(n[first:last])
                        rows.append((part, xxhash.xxh32_intdigest(str(slice_)) % blocks, slice_, kind, *data))
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "slice", "kind", "keys", "n"])

    return ask


def _added(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """(distinct keys, training counts, those not kept back, places of each row's keys among them)."""
    lists = [_unpack_sorted(x) for x in table["keys"].to_pylist()]
    keys = np.concatenate(lists)
    order = np.argsort(keys, kind="stable")
    new = np.r_[True, np.diff(keys[order]) > 0]
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    keys = keys[order][new]
    del order, new
    places = np.split(place, np.cumsum([len(x) for x in lists])[:-1])
    counts, kept = np.zeros((2, len(keys)), np.int64)
    # A row's keys are distinct.
    for at, kind, n in zip(places, table["kind"].to_pylist(), table["n"].to_pylist()):
        if kind != _UNTAUGHT:
            n = _unpack(n)
            counts[at] += n
            if kind == _KEPT:
                kept[at] += n
    return keys, counts, kept, places


def _answers(table: pa.Table, counts: np.ndarray, kept: np.ndarray, places: list[np.ndarray]) -> list[tuple]:
    part = table["part"][0].as_py()
    rows = zip(table["slice"].to_pylist(), table["kind"].to_pylist(), places)
    # What is left without the texts kept back is asked for by those alone.
    return [
        (slice_, kind, part, _pack(counts[at]), _pack(kept[at]) if kind == _HELD else b"", *[0] * 5) for slice_, kind, at in rows
    ]


def _totals(layout: Layout, part: int, keys: np.ndarray, counts: np.ndarray, kept: np.ndarray) -> tuple:
    """A row without a slice: what the words of a group add to the corpus's totals."""
    of_words = part % layout.order == 0
    ends = keys == END
    sums = [(counts > 0).sum(), counts.sum(), kept.sum(), counts[ends].sum(), kept[ends].sum()]
    return (-1, -1, part, b"", b"", *[int(x) if of_words else 0 for x in sums])


def _answered(rows: list[tuple]) -> pa.Table:
    types = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 5)
    names = ("slice", "kind", "part", "n", "kept", *_STATS)
    return pa.table([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(types), types)], names=list(names))


def _count(asked: DataFrame, layout: Layout, blocks: int) -> DataFrame:
    """The answers to all slices, and the totals of each group of words."""

    def at_once(table: pa.Table) -> pa.Table:
        keys, counts, kept, places = _added(table)
        return _answered([*_answers(table, counts, kept, places), _totals(layout, table["part"][0].as_py(), keys, counts, kept)])

    if blocks == 1:
        return asked.groupBy("part").applyInArrow(at_once, _ANSWERED)

    # A word that every slice has would bring as many entries to its group as there are slices. So blocks
    # of slices are added up first, then the sums of the blocks, and each block answers its slices.
    def of_block(table: pa.Table) -> pa.Table:
        keys, counts, kept, _ = _added(table)
        packed = {"keys": [_pack_sorted(keys)], "counts": [_pack(counts)], "kept": [_pack(kept)]}
        return pa.table({"part": table["part"][:1], "block": table["block"][:1], **packed})

    def of_all(table: pa.Table) -> pa.Table:
        lists = [_unpack_sorted(x) for x in table["keys"].to_pylist()]
        keys, place = np.unique(np.concatenate(lists), return_inverse=True)
        sums = [
            np.bincount(place, weights=np.concatenate([_unpack(x) for x in table[c].to_pylist()])).astype(np.int64)
            for c in ("counts", "kept")
        ]
        part = table["part"][0].as_py()
        totals = _totals(layout, part, keys, *sums)
        rows = [(b, *(_pack(s[at]) for s in sums)) for b, at in zip(table["block"].to_pylist(), np.split(place, np.cumsum([len(x) for x in lists])[:-1]))]
        block, counts, kept = zip(*rows)
        stats = {c: pa.array([x] + [0] * (len(rows) - 1), pa.int64()) for c, x in zip(_STATS, totals[5:])}
        named = {"part": pa.array([part] * len(rows), pa.int64()), "block": pa.array(block, pa.int32()), "counts": counts, "kept": kept}
        return pa.table({**named, **stats})

    def to_slices(table: pa.Table, sums: pa.Table) -> pa.Table:
        places = _added(table)[3]
        counts, kept = (_unpack(sums[c][0].as_py()) for c in ("counts", "kept"))
        totals = (-1, -1, table["part"][0].as_py(), b"", b"", *(sums[c][0].as_py() for c in _STATS))
        return _answered([*_answers(table, counts, kept, places), totals])

    partial = asked.groupBy("part", "block").applyInArrow(of_block, "part long, block int, keys binary, counts binary, kept binary")
    stats = ", ".join(f"{c} long" for c in _STATS)
    sums = partial.groupBy("part").applyInArrow(of_all, f"part long, block int, counts binary, kept binary, {stats}")
    return asked.groupBy("part", "block").cogroup(sums.groupBy("part", "block")).applyInArrow(to_slices, _ANSWERED)


# The model.


@dataclass
class Model:
    """What every task needs: totals and weights. All counts stay in Spark."""

    layout: Layout
    tokens: int
    kept_tokens: int
    types: int
    texts: int
    kept_texts: int
    weights: np.ndarray | None = None  # per bucket: longest n-gram, ..., token, equal

    def estimates(self, counts: list[np.ndarray], bounds: np.ndarray, kept: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(bucket of each token, its shares: after the longest context first, then any token's, then equal)."""
        tokens, texts = (self.kept_tokens, self.kept_texts) if kept else (self.tokens, self.texts)
        equal = np.full(len(counts[0]), 1 / (self.types + 1))
        shares = [equal, counts[0] / max(1, tokens)]
        bucket = np.zeros(len(counts[0]), np.int64)
        for longer in range(1, len(counts)):
            followed = _before(counts[longer - 1], bounds, texts)
            shares.append(counts[longer] / np.maximum(followed, 1))
            bucket = np.where(followed > 0, _SPAN * (longer - 1) + frequency(followed), bucket)
        return bucket, np.stack(shares[::-1], axis=1)

    def chances(self, counts: list[np.ndarray], bounds: np.ndarray) -> np.ndarray:
        bucket, shares = self.estimates(counts, bounds)
        return (self.weights[bucket] * shares).sum(axis=1)

    def base_chances(self, n: np.ndarray) -> np.ndarray:
        return (n + 0.5) / (self.tokens + 0.5 * (self.types + 1))


def frequency(followed: np.ndarray) -> np.ndarray:
    """Bucket of a context's count: 0, then one per doubling."""
    return np.where(followed >= 1, np.floor(np.log2(np.maximum(followed, 1))) + 1, 0).astype(np.int64)


def learn_weights(bucket: np.ndarray, n: np.ndarray, parts: np.ndarray, order: int) -> np.ndarray:
    """Mixture weights by expectation maximisation.

    Per cell: its bucket, number of kept-back tokens, and their shares relative
    to that of the token alone. Buckets with few kept back lean on the weights
    of all.
    """
    everywhere = _maximise(n, parts, np.full(order + 1, 1 / (order + 1)), 0.0)
    weights = np.tile(everywhere, (_SPAN * max(1, order - 1), 1))
    for found in np.unique(bucket):
        of_bucket = bucket == found
        weights[found] = _maximise(n[of_bucket], parts[of_bucket], everywhere, 20.0)
    # A context never seen tells nothing.
    for longer in range(1, order):
        weights[: _SPAN * (longer - 1) + 1, order - 1 - longer] = 0.0
    weights[:, -2:] = np.maximum(weights[:, -2:], 1e-6)
    return weights / weights.sum(axis=1, keepdims=True)


def _maximise(n: np.ndarray, parts: np.ndarray, prior: np.ndarray, strength: float) -> np.ndarray:
    if not len(n):
        return prior
    weights = np.full(len(prior), 1 / len(prior))
    for _ in range(ROUNDS):
        mixed = parts * weights
        following = n / np.maximum(mixed.sum(axis=1), 1e-300) @ mixed + strength * prior
        following /= max(following.sum(), 1e-300)
        if np.abs(following - weights).max() < 1e-6:
            return following
        weights = following
    return weights


def _counts_of(grams: list[tuple], answers: pa.Table, column: str) -> list[np.ndarray]:
    """Counts of every token's n-grams, by length, from the answers to their slice."""
    answers = answers.sort_by("part")
    part, packed = answers["part"].to_numpy(), answers[column].to_pylist()
    order = len(grams)
    found = []
    for length, (_, place, _) in enumerate(grams):
        each = [_unpack(packed[i]) for i in np.flatnonzero(part % order == length)]
        found.append(np.concatenate(each)[place])
    return found


def _cells(model: Model):
    """Kept-back tokens of a slice, added up where bucket and shares are alike; each cell keeps its mean shares."""

    def cells(texts: pa.Table, answers: pa.Table) -> pa.Table:
        bounds, grams = model.layout.grams(_unpack_texts(texts["texts"][0].as_py()))
        bucket, shares = model.estimates(_counts_of(grams, answers, "kept"), bounds, kept=True)
        # A token that only the kept-back texts have gets the smallest share there is.
        shares[:, -2] = np.maximum(shares[:, -2], 0.5 / max(1, model.kept_tokens))
        shares /= shares[:, -2:-1]
        with np.errstate(divide="ignore"):
            steps = np.where(shares > 0, np.round(np.log2(shares) * _STEPS), -999).astype(np.int64)
        code = bucket
        for column in range(shares.shape[1]):
            code = code * 2_048 + steps[:, column] + 1_000 if column != shares.shape[1] - 2 else code
        distinct, back = np.unique(code, return_inverse=True)
        sums = [np.bincount(back, weights=shares[:, i]) for i in range(shares.shape[1])]
        of_cell = np.zeros(len(distinct), np.int64)
        of_cell[back] = bucket
        return pa.table({"cell": distinct, "bucket": of_cell, "n": np.bincount(back).astype(float), **{f"s{i}": s for i, s in enumerate(sums)}})

    return cells


def _learn(slices: DataFrame, answers: DataFrame, model: Model) -> np.ndarray:
    columns = [f"s{i}" for i in range(model.layout.order + 1)]
    schema = "cell long, bucket long, n double, " + ", ".join(f"{c} double" for c in columns)
    held = slices.filter(F.col("kind") == _HELD).select("slice", "texts")
    told = answers.filter(F.col("kind") == _HELD).select("slice", "part", "kept")
    found = held.groupBy("slice").cogroup(told.groupBy("slice")).applyInArrow(_cells(model), schema)
    sums = found.groupBy("cell", "bucket").agg(*[F.sum(c).alias(c) for c in ("n", *columns)]).orderBy("cell", "bucket")
    # As many cells as kinds of shares in doublings: their number grows with the logarithm of the counts.
    cells = sums.toArrow()
    n = cells["n"].to_numpy()
    parts = np.stack([cells[c].to_numpy() for c in columns], axis=1) / np.maximum(n, 1)[:, None]
    return learn_weights(cells["bucket"].to_numpy(), n, parts, model.layout.order)


# Scores.


def _score(model: Model):
    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        ids = texts["ids"].combine_chunks().flatten()
        bounds, grams = model.layout.grams(_unpack_texts(texts["texts"][0].as_py()))
        counts = _counts_of(grams, answers, "n")
        columns = [
            ids,
            np.diff(bounds),
            # Added up text by text, so that equal texts get equal sums.
            np.add.reduceat((counts[0] > 0).astype(np.int64), bounds[:-1]),
            np.add.reduceat(np.log10(model.base_chances(counts[0])), bounds[:-1]),
            np.add.reduceat(np.log10(model.chances(counts, bounds)), bounds[:-1]),
        ]
        return pa.Table.from_arrays([pa.array(c) for c in columns], names=["_id", "n_tokens", "n_known", "base", "score"])

    return score


def score(
    docs: DataFrame,
    train: Column,
    held: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    work: str | None = None,
    slice_bytes: int = SLICE_BYTES,
    group_tokens: int = GROUP_TOKENS,
    block_slices: int = BLOCK_SLICES,
) -> tuple[DataFrame, Model]:
    """((doc_id, n_tokens, n_known, base_score, score) of every row of ``docs``, the model).

    ``train`` tells the rows to learn from, ``held`` those of them that are kept
    back while the mixture weights are learned; ``order`` is the length of the
    longest n-grams. Whole texts are lower-cased (A-Z) and cut into words, and an
    end, which is a token too; a null or empty text is an end alone. ``n_known``
    counts tokens that occur in training texts, ``base_score`` adds
    log10((c + 0.5) / (N + 0.5 * (V + 1))) over the tokens, and ``score`` is the
    model's log10 chance of the text, in which a word never seen has the chance
    of all such words. Repeated rows get equal scores each; null ids are kept;
    where ``train`` is null a row is not learned from. With nothing to learn from
    all words have equal chances. An empty table gives an empty result. A text
    longer than a slice is a slice of its own.

    The sizes of slices, groups and blocks change no count: a group's task holds
    some ``group_tokens`` n-grams, and hears of at most ``block_slices`` slices.
    """
    work = work or scratch_path(docs.sparkSession, "language-model")
    never = F.lit(False)
    rows = docs.select(
        F.col(doc_id).alias("_id"),
        F.col(text).alias("_text"),
        F.coalesce(train, never).alias("_train"),
        F.coalesce(held, never).alias("_held"),
    )
    id_type = rows.schema["_id"].dataType.simpleString()
    cut = rows.mapInArrow(_cut(slice_bytes), f"slice long, kind int, size long, ids array<{id_type}>, texts binary")
    # Written, as a slice must stay the same until its answers come.
    slices = settle(cut, "slices", work)
    row = slices.agg(F.count("*").alias("slices"), F.sum("size").alias("size")).first()
    size = row["size"] or 0
    # Some six bytes a token.
    layout = Layout(order, max(1, math.ceil(size / 6 / group_tokens)), min(62, 18 + (size + 2).bit_length()))
    blocks = max(1, math.ceil(row["slices"] / block_slices))
    asked = slices.select("slice", "kind", "texts").mapInArrow(_ask(layout, blocks), _ASKED)
    answers = settle(_count(asked, layout, blocks), "answers", work)
    stats = answers.filter("slice < 0").agg(*[F.sum(c).alias(c) for c in _STATS]).first()
    model = Model(layout, **{c: stats[c] or 0 for c in _STATS})
    model.weights = _learn(slices, answers, model)
    told = answers.filter("slice >= 0").select("slice", "part", "n")
    parts = slices.select("slice", "ids", "texts").groupBy("slice").cogroup(told.groupBy("slice"))
    scored = parts.applyInArrow(_score(model), f"_id {id_type}, n_tokens long, n_known long, base double, score double")
    found = scored.select(F.col("_id").alias(doc_id), "n_tokens", "n_known", F.col("base").alias("base_score"), "score")
    return found, model
