"""Benchmark passages in documents, found by Wu-Manber multi-pattern search.

A benchmark item is cut into windows of ten words; each is a search string.
Strings of similar length share a block shift table, indexed by the last bytes
of the current alignment: it tells how far the alignment can move on without
passing an occurrence. Where it cannot move, the strings whose first bytes end
with that block are looked up and compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termspace.llm.common import Sent, bounded_slices, columns_as, row_key, text_bytes, texts_of

WINDOW = 10
# Benchmark text sent to every task at a time; a larger benchmark is searched for in several passes.
SHARD_BYTES = 8 * 2**20
# Strings shorter than each bound share a table: the shortest one limits the shifts.
_LENGTHS = (4, 8, 16, 32, 2**62)
_SEARCH_BYTES = 2 * 2**20
_LANE_BYTES = 2_048
_PAD = 8

_SPACE, _END = 0x20, 0x00


def _byte_table() -> np.ndarray:
    """Word bytes (0-9, a-z, all above 0x7F) as they are, A-Z lower-cased, the others a space."""
    table = np.full(256, _SPACE, dtype=np.uint8)
    for first, last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[first : last + 1] = np.arange(first, last + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buffer, ends): each text as its words, every word followed by one space, then a zero byte.

    ``ends`` are the positions of the zero bytes, a leading one included.
    """
    mapped = _byte_table()[data].tobytes()
    pieces = [b"\0" * _PAD]
    for first, last in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        pieces += (mapped[first:last], b" \0")
    buffer = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    word = (buffer != _SPACE) & (buffer != _END)
    keep = word | (buffer == _END)
    keep[1:] |= word[:-1]
    buffer = buffer[keep]
    return buffer, np.flatnonzero(buffer == _END)[_PAD - 1 :]


def _blocks(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one number."""
    return np.ndarray((max(0, len(buffer) - 7),), dtype="<u8", buffer=np.ascontiguousarray(buffer), strides=(1,))


@dataclass
class _Table:
    """Search strings of similar length: places in the pattern buffer, shift table, suffix buckets."""

    shortest: int
    block: int
    bits: int
    shift: np.ndarray
    suffix: np.ndarray  # last block of the first ``shortest`` bytes, sorted
    pattern: np.ndarray  # its string

    def slots(self, values: np.ndarray) -> np.ndarray:
        return (values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def tails(self, blocks: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The last ``block`` bytes before each position."""
        return blocks[end - 8] >> np.uint64(8 * (8 - self.block))


class Windows:
    """All windows of a set of items, ready to be searched for."""

    def __init__(self, texts: pa.Array, window: int = WINDOW):
        buffer, ends = normalised(*text_bytes(texts))
        self.buffer = buffer.tobytes()
        spaces = np.flatnonzero(buffer == _SPACE)
        bounds = np.searchsorted(spaces, ends)
        first, words, item = [], [], []
        for i in range(len(texts)):
            n = bounds[i + 1] - bounds[i]
            if n:
                begins = np.arange(bounds[i], bounds[i + 1] - min(n, window) + 1)
                first.append(begins)
                words.append(np.full(len(begins), min(n, window)))
                item.append(np.full(len(begins), i))
        none = [np.zeros(0, np.int64)]
        first, self.words, self.item = (np.concatenate(none + x) for x in (first, words, item))
        # A word begins after the end mark of the text before, or after the space of the word before.
        start_of = np.maximum(ends[np.searchsorted(ends, spaces) - 1] + 1, np.r_[0, spaces[:-1] + 1]) if len(spaces) else spaces
        self.start = start_of[first]
        self.length = spaces[first + self.words - 1] + 1 - self.start
        self.tables = []
        blocks, low = _blocks(buffer), 0
        for high in _LENGTHS:
            chosen = np.flatnonzero((self.length >= low) & (self.length < high))
            low = high
            if len(chosen):
                self.tables.append(self._table(blocks, chosen))

    def _table(self, blocks: np.ndarray, chosen: np.ndarray) -> _Table:
        shortest = int(self.length[chosen].min())
        # The longer the block, the rarer a chance match; the shorter, the longer the shifts.
        wanted = int(np.ceil(np.log2(2.0 * shortest * len(chosen)) / 3))
        block = max(1, min(8, wanted, shortest))
        bits = int(min(22, max(12, np.ceil(np.log2(8.0 * shortest * len(chosen))))))
        table = _Table(shortest, block, bits, np.full(1 << bits, shortest - block + 1, np.int64), *[np.zeros(0)] * 2)
        for end in range(block, shortest + 1):
            slot = table.slots(table.tails(blocks, self.start[chosen] + end))
            np.minimum.at(table.shift, slot, shortest - end)
        suffix = table.tails(blocks, self.start[chosen] + shortest)
        order = np.argsort(suffix, kind="stable")
        table.suffix, table.pattern = suffix[order], chosen[order]
        return table

    def find(self, buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, string) of every occurrence that begins where a word begins."""
        found = [self._search(buffer, table) for table in self.tables]
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate([none, *(f[i] for f in found)]) for i in (0, 1))

    def _search(self, buffer: np.ndarray, table: _Table) -> tuple[np.ndarray, np.ndarray]:
        blocks, data = _blocks(buffer), buffer.tobytes()
        # The buffer is cut into lanes that move on at the same time.
        end = np.arange(_PAD + table.shortest, len(buffer) + 1, _LANE_BYTES)
        stop = np.minimum(end + _LANE_BYTES, len(buffer) + 1)
        starts, strings = [], []
        while len(end):
            tails = table.tails(blocks, end)
            move = table.shift[table.slots(tails)]
            still = np.flatnonzero(move == 0)
            if len(still):
                low = np.searchsorted(table.suffix, tails[still], side="left")
                n = np.searchsorted(table.suffix, tails[still], side="right") - low
                which = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start, string = np.repeat(end[still] - table.shortest, n), table.pattern[which]
                starts.append(start)
                strings.append(string)
            end = end + np.maximum(move, 1)
            going = end < stop
            end, stop = end[going], stop[going]
        none = np.zeros(0, np.int64)
        start, string = np.concatenate([none, *starts]), np.concatenate([none, *strings])
        # At the beginning of a word only; then the whole string is compared.
        begins = (buffer[start - 1] == _SPACE) | (buffer[start - 1] == _END)
        start, string = start[begins], string[begins]
        length, place, ours = self.length[string].tolist(), self.start[string].tolist(), self.buffer
        same = [data[s : s + n] == ours[p : p + n] for s, n, p in zip(start.tolist(), length, place)]
        same = np.array(same, dtype=bool)
        return start[same], string[same]

    def search(self, texts: pa.Array) -> tuple[np.ndarray, list[list[int]], list[set[int]]]:
        """Per text: number of words, runs of hit words (first, end, first, end ...), items found."""
        data, offsets = text_bytes(texts)
        n_words, runs, items = [], [], []
        for first, last in bounded_slices(offsets, _SEARCH_BYTES):
            part = offsets[first : last + 1]
            buffer, ends = normalised(data[part[0] : part[-1]], part - part[0])
            space = buffer == _SPACE
            before = np.cumsum(space)  # words that end at or before a position
            base = before[ends]
            n_words.append(np.diff(base))
            found: list[list[int]] = [[] for _ in range(last - first)]
            seen: list[set[int]] = [set() for _ in range(last - first)]
            position, string = self.find(buffer)
            order = np.argsort(position, kind="stable")
            position, string = position[order], string[order]
            text = np.searchsorted(ends, position) - 1
            begin = before[position - 1] - base[text]
            for t, b, n, i in zip(text.tolist(), begin.tolist(), self.words[string].tolist(), self.item[string].tolist()):
                seen[t].add(i)
                run = found[t]
                if run and b <= run[-1]:
                    run[-1] = max(run[-1], b + n)
                else:
                    run += (b, b + n)
            runs += found
            items += seen
        return np.concatenate([np.zeros(0, np.int64), *n_words]), runs, items


def _shards(benchmark: DataFrame, item_id: str, text: str, shard_bytes: int) -> Iterator[tuple[pa.Array, Windows]]:
    """(item ids as text, windows) of one bounded part of the benchmark after the other."""
    items = columns_as(benchmark, _item=item_id, _text=text).filter(F.length("_text") > 0)
    size = items.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    place = F.pmod(row_key("_item", "_text"), F.lit(shards))
    for shard in range(shards):
        part = items.filter(place == shard).select(F.coalesce(F.col("_item").cast("string"), F.lit("")), "_text").toArrow()
        yield part.column(0).combine_chunks(), Windows(texts_of(part.column(1)))


_RUNS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
_FOUND = "_id {id}, _key long, n_words long, runs array<struct<a: long, b: long>>, items array<string>"


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """(doc_id, n_words, n_hit, items, contaminated): one row per row of ``docs``.

    Words are runs of 0-9, a-z (after lower-casing A-Z) and characters above
    0x7F. A window is ten consecutive words of an item; an item of fewer words,
    but not none, is one window. A word inside any occurrence of a window is
    hit. ``items`` lists the ids of items with an occurring window as sorted
    text; a null id is listed as empty text. Null and empty texts have no words
    and hit nothing; repeated rows are judged alike; an empty benchmark hits
    nothing. Whole texts are searched, in slices of bounded size cut between
    texts.

    Benchmark text of at most ``shard_bytes`` is sent to the tasks at a time, and
    the documents are searched where they are read. A larger benchmark takes a
    pass per part, and what the passes found for a row is put together.
    """
    given = columns_as(docs, _id=doc_id, _text=text)
    schema = _FOUND.format(id=given.schema["_id"].dataType.simpleString())
    rows = given.select("_id", "_text", row_key("_id", "_text").alias("_key"))
    parts = []
    for shard in _shards(benchmark, item_id, item_text, shard_bytes):
        parts.append(rows.mapInArrow(_searcher(Sent(docs.sparkSession, shard)), schema))
    found = parts[0]
    if len(parts) > 1:
        for part in parts[1:]:
            found = found.unionByName(part)
        together = found.groupBy("_key").agg(
            F.first("_id").alias("_id"),
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("runs")).alias("runs"),
            F.flatten(F.collect_list("items")).alias("items"),
            (F.count("*") / len(parts)).cast("int").alias("_copies"),
        )
        found = together.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies")))
    spans = F.array_sort("runs")
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        spans,
        start,
        lambda a, s: F.struct(
            F.greatest(a["end"], s["b"]).alias("end"),
            (a["n"] + F.greatest(s["b"] - F.greatest(s["a"], a["end"]), F.lit(0).cast("long"))).alias("n"),
        ),
        lambda a: a["n"],
    )
    return found.select(
        F.col("_id").alias(doc_id),
        "n_words",
        covered.alias("n_hit"),
        F.array_sort(F.array_distinct("items")).alias("items"),
        (F.size("items") > 0).alias("contaminated"),
    )


def _searcher(sent):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, windows = sent.get()
        names = names.to_pylist()
        for batch in batches:
            n_words, runs, items = windows.search(texts_of(batch.column(1)))
            listed = [[names[i] for i in sorted(found)] for found in items]
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(n_words, pa.int64()),
                    pa.array([[(r[i], r[i + 1]) for i in range(0, len(r), 2)] for r in runs], _RUNS),
                    pa.array(listed, pa.list_(pa.string())),
                ],
                names=["_id", "_key", "n_words", "runs", "items"],
            )

    return search


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, in whose text no window of the benchmark occurs.

    Cases are judged as in ``contamination``; a null or empty text stays.
    """
    place = docs.columns.index(text)
    for shard in _shards(benchmark, item_id, item_text, shard_bytes):
        sent = Sent(docs.sparkSession, shard)

        def clean(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            windows = sent.get()[1]
            for batch in batches:
                _, _, items = windows.search(texts_of(batch.column(place)))
                yield batch.filter(pa.array([not found for found in items], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
