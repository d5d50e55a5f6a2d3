"""Near duplicates by 64-bit fingerprints and the generalised pigeonhole principle.

Bits that go together are put into one partition. If two fingerprints differ in
at most r bits, then for any thresholds t of the partitions whose t + 1 add up to
r + 1 there is a partition in which they differ in at most its threshold (a
threshold of -1 leaves a partition out). The thresholds, unequal where it pays,
come from a dynamic programme over estimated numbers of candidates. Fingerprints
meet where they agree on a partition but for as many bits as its threshold, and
are compared there in full.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termspace.llm.common import columns_as, fresh_name, row_key, texts_of
from termspace.llm.components import connected_components
from termspace.session import scratch_path, settle

BITS = 64
RADIUS = 3
SHINGLE = 3
SEED = 42
# Larger groups of candidates are told apart further before they are compared.
GROUP = 1_024
# Making and moving a row costs about as much as comparing so many pairs.
_ROW_COST = 64.0
_SHINGLE_SLICE = 2**16
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is set if it is set in over half of the hashes of the word shingles, repeats included."""
    words = _WORD.findall(text.translate(_LOWER))
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(BITS, dtype=np.int64)
    for first in range(0, n, _SHINGLE_SLICE):
        part = words[first : min(n, first + _SHINGLE_SLICE) + shingle - 1]
        joined = map(b" ".join, zip(*(part[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in joined], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(_id, _key, _print): the fingerprint of every row as a signed number, and a key of the row's content."""
    rows = columns_as(docs, _id=doc_id, _text=text)
    schema = f"_id {rows.schema['_id'].dataType.simpleString()}, _key long, _print long"

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(2))
            found = np.array([fingerprint(t.as_buffer().to_pybytes()) for t in texts], dtype=np.uint64)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], names=["_id", "_key", "_print"])

    return rows.select("_id", row_key("_id", "_text").alias("_key"), "_text").mapInArrow(compute, schema)


def hex_print(column: str = "_print") -> Column:
    return F.lpad(F.lower(F.hex(column)), 16, "0")


@dataclass
class Partitions:
    """Bit masks of the partitions and their thresholds."""

    masks: list[int]
    thresholds: list[int]

    def probes(self) -> list[int]:
        """Masks on which two near fingerprints agree at least once: of each partition all but ``threshold`` bits."""
        found = []
        for mask, threshold in zip(self.masks, self.thresholds):
            places = [1 << b for b in range(BITS) if mask >> b & 1]
            if threshold >= 0:
                found += [mask - sum(left_out) for left_out in combinations(places, threshold)]
        return found


def plan_partitions(prints: DataFrame, radius: int = RADIUS) -> Partitions:
    """Partitions and thresholds for a table of distinct fingerprints, from statistics of all of them."""
    n, together = _bit_statistics(prints)
    if n < 2:
        return Partitions([2**BITS - 1], [radius])
    share = np.diag(together) / n
    covariance = together / n - np.outer(share, share)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    correlation = np.abs(covariance / np.outer(spread, spread))
    options = [_group_bits(correlation, m) for m in range(2, radius + 2)]
    masks = sorted({mask for option in options for mask in option})
    equal = _equal_pairs(prints, masks)
    # Chance that two fingerprints differ in a bit.
    differ = 2 * share * (1 - share)
    best, best_cost = None, math.inf
    for option in options:
        costs = []
        for mask in option:
            places = [b for b in range(BITS) if mask >> b & 1]
            chance = _distance_chances(differ[places], radius)
            pairs = [equal[mask] * chance[: t + 1].sum() / max(chance[0], 1e-300) for t in range(radius + 1)]
            pairs = [min(p, n * (n - 1) / 2) for p in pairs]
            costs.append([0.0] + [p + _ROW_COST * n * math.comb(len(places), t) for t, p in enumerate(pairs)])
        thresholds, cost = _allocate(costs, radius)
        if cost < best_cost:
            best, best_cost = Partitions(option, thresholds), cost
    return best


def _bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """(number of fingerprints, 64 x 64 counts of bits set together), summed per task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            values = np.ascontiguousarray(batch.column(0).to_numpy().astype("<i8"))
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
        yield pa.record_batch([pa.array(range(BITS), pa.int32()), pa.array(total.tolist())], names=["bit", "n"])

    rows = prints.select("_print").mapInArrow(count, "bit int, n array<double>")
    rows = rows.select("bit", F.posexplode("n").alias("other", "n")).groupBy("bit", "other").agg(F.sum("n").alias("n"))
    together = np.zeros((BITS, BITS))
    for row in rows.collect():
        together[row["bit"], row["other"]] = row["n"]
    return prints.count(), together


def _group_bits(correlation: np.ndarray, parts: int) -> list[int]:
    """Masks of ``parts`` partitions of even width; each takes the bits that go with it most."""
    left = list(range(BITS))
    masks = []
    for part in range(parts):
        width = (BITS - sum(m.bit_count() for m in masks)) // (parts - part)
        # Begin with the bit that goes with the others most.
        chosen = [max(left, key=lambda b: (correlation[b, left].sum(), -b))]
        left.remove(chosen[0])
        while len(chosen) < width:
            following = max(left, key=lambda b: (correlation[b, chosen].sum(), -b))
            chosen.append(following)
            left.remove(following)
        masks.append(sum(1 << b for b in chosen))
    return masks


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


def _equal_pairs(prints: DataFrame, masks: list[int]) -> dict[int, float]:
    """Number of pairs that agree on a mask, counted over all fingerprints."""
    asked = F.array(*[F.lit(_signed(m)).cast("long") for m in masks])
    rows = prints.select("_print", F.posexplode(asked).alias("i", "mask"))
    sizes = rows.groupBy("i", F.col("_print").bitwiseAND(F.col("mask")).alias("value")).count()
    pairs = sizes.groupBy("i").agg(F.sum(F.col("count") * (F.col("count") - 1) / 2).alias("pairs"))
    found = {row["i"]: float(row["pairs"]) for row in pairs.collect()}
    return {mask: max(1.0, found.get(i, 0.0)) for i, mask in enumerate(masks)}


def _distance_chances(differ: np.ndarray, most: int) -> np.ndarray:
    """Chance of each distance up to ``most`` over bits that differ with the given chances."""
    chances = np.zeros(most + 1)
    chances[0] = 1.0
    for p in differ:
        moved = np.r_[0.0, chances[:-1]] * p
        chances = chances * (1 - p) + moved
    return chances


def _allocate(costs: list[list[float]], radius: int) -> tuple[list[int], float]:
    """Thresholds of least cost whose t + 1 add up to radius + 1; ``costs[i][t + 1]`` is that of t in partition i."""
    best = {0: (0.0, [])}
    for cost in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for used, (total, chosen) in best.items():
            for step in range(radius + 2 - used):
                tried = (total + cost[step], [*chosen, step - 1])
                if used + step not in following or tried < following[used + step]:
                    following[used + step] = tried
        best = following
    total, thresholds = best[radius + 1]
    return thresholds, total


def near_edges(prints: DataFrame, radius: int = RADIUS, group: int = GROUP, work: str | None = None) -> DataFrame:
    """(a, b): edges that connect all fingerprints (_print, distinct) within ``radius`` bits of each other.

    A pair that differs in at most ``radius`` bits is connected, if need be by
    way of others: a dense group gives a star rather than all of its pairs.

    Groups of candidates above ``group`` are taken apart by cutting the bits that
    they need not agree on into radius + 1 pieces, of which near ones must agree
    on one; what cannot be taken apart further is compared block by block.
    """
    work = work or scratch_path(prints.sparkSession, "near")
    spark = prints.sparkSession
    masks = plan_partitions(prints, radius).probes()
    asked = F.explode(F.array(*[F.lit(_signed(m)).cast("long") for m in masks]))
    rows = prints.select("_print", asked.alias("_mask"))
    level, parts = 0, []
    while True:
        key = F.xxhash64("_mask", F.col("_print").bitwiseAND(F.col("_mask")))
        keyed = settle(rows.withColumn("_group", key), f"level{level}", work)
        large = keyed.groupBy("_group").count().filter(F.col("count") > group)
        large = settle(large, f"large{level}", work)
        if large.isEmpty():
            parts.append(keyed.select("_print", "_group"))
            break
        parts.append(keyed.join(large, "_group", "left_anti").select("_print", "_group"))
        hot = keyed.join(large.select("_group"), "_group", "left_semi")
        finer = _finer(sorted({r["_mask"] for r in hot.select("_mask").distinct().collect()}), radius)
        if not finer:
            parts.append(_in_blocks(hot.join(large, "_group"), group))
            break
        cut = spark.createDataFrame(finer, "_mask long, _finer long")
        rows = hot.join(F.broadcast(cut), "_mask").select("_print", F.col("_finer").alias("_mask")).distinct()
        level += 1
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    grouped = together.repartition("_group").sortWithinPartitions("_group", "_print")
    return grouped.mapInArrow(_compare(radius), "a long, b long").distinct()


def _finer(masks: list[int], radius: int) -> list[tuple[int, int]]:
    """(mask, finer mask): each mask with one of radius + 1 pieces of its other bits; none if few bits are left."""
    found = []
    for mask in masks:
        free = [b for b in range(BITS) if not mask >> b & 1]
        if len(free) < 3 * (radius + 1):
            return []
        for piece in range(radius + 1):
            bits = sum(1 << b for b in free[piece :: radius + 1])
            found.append((mask, _signed(mask % 2**64 | bits)))
    return found


def _in_blocks(rows: DataFrame, group: int) -> DataFrame:
    """Groups cut into blocks; a row goes to every pair of blocks that its own is part of."""
    half = max(1, group // 2)
    blocks = F.ceil(F.col("count") / half).cast("long")
    own = F.pmod(F.xxhash64("_print"), blocks)
    paired = rows.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    pair = [F.least("_own", "_other"), F.greatest("_own", "_other")]
    return paired.select("_print", F.xxhash64("_group", *pair).alias("_group"))


def _compare(radius: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, groups = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            values = np.r_[values, batch.column(0).to_numpy()]
            groups = np.r_[groups, batch.column(1).to_numpy()]
            if not len(groups):
                continue
            # The last group may go on in the next batch.
            cut = int(np.searchsorted(groups, groups[-1]))
            yield from _edges(values[:cut], groups[:cut], radius)
            values, groups = values[cut:], groups[cut:]
        yield from _edges(values, groups, radius)

    return compare


def _edges(values: np.ndarray, groups: np.ndarray, radius: int, small: int = 8) -> Iterator[pa.RecordBatch]:
    if len(values) < 2:
        return
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    sizes = np.diff(np.r_[starts, len(groups)])
    a, b = [], []
    # Small groups all at once, each row with the row ``step`` further on.
    size = np.repeat(sizes, sizes)
    few, few_groups = values[size <= small], groups[size <= small]
    for step in range(1, small):
        same = few_groups[step:] == few_groups[:-step]
        left, right = few[:-step][same], few[step:][same]
        near = np.bitwise_count((left ^ right).view(np.uint64)) <= radius
        a.append(left[near])
        b.append(right[near])
    for start, n in zip(starts[sizes > small].tolist(), sizes[sizes > small].tolist()):
        own, root = _stars(values[start : start + n], radius)
        a.append(own)
        b.append(root)
    a, b = np.concatenate(a), np.concatenate(b)
    if len(a):
        yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])


def _stars(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Each value with the first one of its component within the group."""
    root = np.full(len(values), -1)
    for first in range(len(values)):
        if root[first] >= 0:
            continue
        root[first] = first
        front = np.array([first])
        while len(front):
            open_ = np.flatnonzero(root < 0)
            far = np.ones(len(open_), dtype=bool)
            for one in front:
                still = np.flatnonzero(far)
                far[still] = np.bitwise_count((values[open_[still]] ^ values[one]).view(np.uint64)) > radius
            front = open_[~far]
            root[front] = first
    other = root != np.arange(len(values))
    return values[other], values[root[other]]


def near_groups(rows: DataFrame, radius: int = RADIUS, group: int = GROUP, work: str | None = None) -> DataFrame:
    """(_print, _component, _first): per distinct fingerprint of ``rows`` (_id, _print) its component.

    ``_component`` is the smallest fingerprint of the component, ``_first`` the
    smallest _id in it.
    """
    work = work or scratch_path(rows.sparkSession, "simhash")
    prints = settle(rows.groupBy("_print").agg(F.min("_id").alias("_least")), "prints", work)
    edges = near_edges(prints.select("_print"), radius, group, f"{work}/near")
    roots = connected_components(edges, f"{work}/components")
    rooted = prints.join(roots.withColumnRenamed("node", "_print"), "_print", "left")
    rooted = settle(rooted.select("_print", "_least", F.coalesce("root", "_print").alias("_component")), "rooted", work)
    first = rooted.groupBy("_component").agg(F.min("_least").alias("_first"))
    return settle(rooted.join(first, "_component").select("_print", "_component", "_first"), "groups", work)


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    group: int = GROUP,
    work: str | None = None,
) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of ``docs``.

    Whole texts are lower-cased (A-Z) and cut into words and shingles of three
    words, or of all words if there are fewer. A text without words, null or
    empty, has the fingerprint zero and is linked like any other. Fingerprints
    link at ``radius`` or fewer differing bits; ``component_id`` is the smallest
    doc_id that can be reached, the row's own included; null ids are left out of
    that, and it is null where there are no others. Repeated rows share their
    component. An empty table gives an empty result. Other columns are not read.

    Equal fingerprints, however many, meet as counts and minima only; the last
    join has one row per distinct fingerprint on its small side, and copies are
    on the large side, whose partitions Spark may split.
    """
    work = work or scratch_path(docs.sparkSession, "simhash")
    rows = settle(fingerprints(docs, doc_id, text), "rows", work)
    groups = near_groups(rows, radius, group, work)
    found = rows.join(groups, "_print")
    return found.select(F.col("_id").alias(doc_id), hex_print().alias("fingerprint"), F.col("_first").alias("component_id"))


def keep_one_each(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    group: int = GROUP,
    work: str | None = None,
) -> DataFrame:
    """One row of each component of ``near_duplicates``, all columns of ``docs``.

    The row with the smallest doc_id stays, one without id only if there is none
    with; of rows that share their id the one with the smallest digest of its
    text, and of rows equal in both any one. Texts without words, null or empty,
    are near each other. An empty table stays empty; other columns are carried
    along and may have any name.
    """
    work = work or scratch_path(docs.sparkSession, "simhash")
    digest, row = fresh_name(docs, "_digest"), fresh_name(docs, "_row")
    keyed = docs.withColumn(digest, F.coalesce(F.md5(text), F.lit("")))
    keyed = keyed.withColumn(row, F.struct(F.col(doc_id).isNull().alias("n"), F.col(doc_id).alias("id"), F.col(digest).alias("key")))
    rows = settle(fingerprints(keyed, row, text).select("_id", "_print"), "rows", work)
    kept = near_groups(rows, radius, group, work).select(F.col("_first").alias("_best")).distinct()
    repeated = rows.groupBy("_id").count().filter("count > 1").select(F.col("_id").alias("_best"), F.lit(True).alias("_again"))
    kept = settle(kept.join(repeated, "_best", "left"), "kept", work)

    def chosen(which: Column) -> DataFrame:
        # Digest and id are compared apart, so that the join has a key without nulls.
        best = kept.filter(which).select(F.col("_best.id").alias("_best_id"), F.col("_best.key").alias("_best_key"))
        same = (keyed[digest] == best["_best_key"]) & keyed[doc_id].eqNullSafe(best["_best_id"])
        return keyed.join(best, same, "left_semi").drop(row)

    again = F.col("_again").isNotNull()
    found = chosen(~again).drop(digest)
    if kept.filter(again).isEmpty():
        return found
    # Of equal rows one stays; only these are gathered by their content.
    return found.unionByName(chosen(again).dropDuplicates([doc_id, digest]).drop(digest))
