"""Allow and block lists for URLs, held as cascades of Bloom filters.

A cascade is exact over the keys it was built for: level 1 encodes the listed
keys, level 2 the corpus keys that level 1 lets through wrongly, level 3 the
listed keys that level 2 lets through, and so on until a level errs nowhere.
A key is listed if the first level that does not contain it is an even one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termspace.llm.common import Sent, columns_as
from termspace.session import scratch_path, settle

BITS_PER_KEY = 10
PROBES = 5
# One level never takes more; with fewer bits a key it errs more often, and the next level mends that.
MAX_BITS = 2**31
DEFAULT = "allow"

RULES = T.StructType().add("host", "string").add("path", "string").add("verdict", "string")


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def candidate_keys(host: Column, path: Column, path_lengths: list[int], most_labels: int) -> Column:
    """Keys of all rules that could fit: host and parent domains, each with path beginnings of the listed lengths.

    Of a host only domains of up to ``most_labels`` labels are asked for, as the longest listed host has no more.
    """
    labels = F.split(host, r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.greatest(F.lit(1), n - (most_labels - 1)), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    lengths = F.filter(F.array(*[F.lit(x) for x in path_lengths]), lambda x: x <= F.length(path))
    keys = F.flatten(F.transform(domains, lambda d: F.transform(lengths, lambda x: F.concat(d, F.substring(path, 1, x)))))
    # Longest first; equally long ones by code point.
    return F.transform(F.sort_array(F.transform(keys, lambda k: F.struct(-F.length(k), k.alias("key")))), lambda s: s["key"])


@dataclass
class Cascade:
    """Bit arrays of the levels, first level first."""

    levels: list[np.ndarray]

    def contains(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether keys, given by two hashes each, are listed."""
        listed = np.full(len(first), len(self.levels) % 2 == 1)
        open_ = np.arange(len(first))
        for depth, bits in enumerate(self.levels):
            hit = np.ones(len(open_), dtype=bool)
            for place in places(first[open_], second[open_], depth, len(bits) * 8):
                hit &= (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            listed[open_[~hit]] = depth % 2 == 1
            open_ = open_[hit]
        return listed


def places(first: np.ndarray, second: np.ndarray, depth: int, bits: int) -> Iterator[np.ndarray]:
    """Bit positions of keys in a level; each level draws its own."""
    step = second | np.uint64(1)
    start = first ^ (second * np.uint64(2 * depth + 1) >> np.uint64(7))
    for i in range(PROBES):
        yield (start + np.uint64(i) * step) % np.uint64(bits)


def key_hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("first"), F.xxhash64(key, F.lit(1)).alias("second")]


def build_cascade(listed: DataFrame, universe: DataFrame, work: str) -> Cascade:
    """The cascade for ``listed`` (key), exact for every key of ``universe`` (key).

    What a level must encode is settled as a table of keys; the bits themselves
    are gathered page by page, at most MAX_BITS of them.
    """
    spark = listed.sparkSession
    listed = settle(listed.select("key").distinct(), "listed", work)
    strangers = universe.select("key").distinct().join(listed, "key", "left_anti")
    held, others, levels = listed, strangers, []
    while True:
        n = held.count()
        if n == 0:
            return Cascade(levels)
        bits = min(MAX_BITS, max(1024, -(-n * BITS_PER_KEY // 8) * 8))
        levels.append(_level(held, len(levels), bits))
        sent = Sent(spark, levels[-1])
        wrong = others.filter(_passes(sent, len(levels) - 1)(*key_hashes(F.col("key"))))
        held, others = settle(wrong, f"level{len(levels)}", work), held


def _level(keys: DataFrame, depth: int, bits: int) -> np.ndarray:
    """Bits set for the keys; gathered as pages of 64 Ki bits, one row per page and task before the shuffle."""

    @F.pandas_udf("array<long>")
    def bit_places(first: pd.Series, second: pd.Series) -> pd.Series:
        a, b = first.to_numpy().view(np.uint64), second.to_numpy().view(np.uint64)
        return pd.Series(list(np.stack(list(places(a, b, depth, bits)), axis=1).astype(np.int64)))

    hashes = keys.select(*key_hashes(F.col("key")))
    place = hashes.select(F.explode(bit_places("first", "second")).alias("bit"))
    pages = (
        place.select((F.col("bit") + 1).alias("place"))
        .select(F.bitmap_bucket_number("place").alias("page"), F.bitmap_bit_position("place").alias("bit"))
        .groupBy("page")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    found = np.zeros(-(-bits // 32_768) * 4_096, dtype=np.uint8)
    for row in pages.toLocalIterator():
        start = (row["page"] - 1) * 4_096
        found[start : start + 4_096] = np.frombuffer(row["bits"], dtype=np.uint8)
    return found[: bits // 8]


def _passes(sent, depth: int):
    @F.pandas_udf("boolean")
    def passes(first: pd.Series, second: pd.Series) -> pd.Series:
        bits = sent.get()
        a, b = first.to_numpy().view(np.uint64), second.to_numpy().view(np.uint64)
        hit = np.ones(len(a), dtype=bool)
        for place in places(a, b, depth, len(bits) * 8):
            hit &= (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return pd.Series(hit)

    return passes


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    default: str = DEFAULT,
    work: str | None = None,
) -> DataFrame:
    """(page_id, host, path, rule, verdict): one row per row of ``pages``.

    ``rules``: (host, path, verdict) with verdict allow or block. A rule fits its
    host and all subdomains if the path of the url starts with its path; the
    longest host and path wins, and ``block`` where both lists hold the same
    rule. Without a fitting rule ``rule`` is null and the verdict ``default``:
    a url in neither list. A null url, or one without ``://``, has an empty host
    and path. Rules with a null host, path or verdict fit nothing. Repeated rows
    are judged alike; an empty page or rule table is fine. Urls of any length are
    judged whole; a host costs no more than the labels of the longest listed one.

    The lists become two Bloom cascades, exact over every key that any url of
    the table can ask for; the urls are then judged where they are read, with
    no join and no shuffle. Each level is at most MAX_BITS / 8 bytes.
    """
    spark = pages.sparkSession
    work = work or scratch_path(spark, "urls")
    pages = columns_as(pages, _id=page_id, _url=url)
    rules = rules.select("host", "path", "verdict").dropna()
    rules = rules.select(F.concat(F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), "path").alias("key"), F.length("path").alias("n"), (F.length("host") - F.length(F.replace("host", F.lit("."))) + 1).alias("labels"), "verdict")
    # As many rows as there are path lengths, however many rules.
    lengths = sorted(r["n"] for r in rules.select("n").distinct().toLocalIterator()) or [0]
    most = rules.agg(F.max("labels")).first()[0] or 1
    host, path = host_of(F.col("_url")), path_of(F.col("_url"))
    asked = pages.select("_id", host.alias("host"), path.alias("path"))
    asked = asked.withColumn("_keys", candidate_keys(F.col("host"), F.col("path"), lengths, most))
    universe = settle(asked.select(F.explode("_keys").alias("key")).distinct(), "universe", work)
    # Lists keep apart what both hold: block wins.
    sent = {}
    for verdict in ("block", "allow"):
        listed = rules.filter(F.col("verdict") == verdict).select("key")
        sent[verdict] = Sent(spark, build_cascade(listed, universe, f"{work}/{verdict}"))

    @F.pandas_udf("place int, verdict string")
    def decide(first: pd.Series, second: pd.Series) -> pd.DataFrame:
        sizes = first.str.len().to_numpy()
        a, b = (np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64).view(np.uint64) for x in (first, second))
        blocked, allowed = sent["block"].get().contains(a, b), sent["allow"].get().contains(a, b)
        starts = np.r_[0, np.cumsum(sizes)]
        places_, verdicts = [], []
        hits = np.flatnonzero(blocked | allowed)
        at = np.searchsorted(hits, starts)
        for row in range(len(sizes)):
            found = hits[at[row]] if at[row] < at[row + 1] else -1
            places_.append(None if found < 0 else int(found - starts[row]))
            verdicts.append(default if found < 0 else "block" if blocked[found] else "allow")
        return pd.DataFrame({"place": pd.array(places_, dtype="Int32"), "verdict": verdicts})

    def hashed(salt: int | None) -> Column:
        return F.transform("_keys", lambda k: F.xxhash64(k) if salt is None else F.xxhash64(k, F.lit(salt)))

    judged = asked.withColumn("_found", decide(hashed(None), hashed(1)))
    rule = F.get("_keys", F.col("_found.place"))
    return judged.select(F.col("_id").alias(page_id), "host", "path", rule.alias("rule"), F.col("_found.verdict").alias("verdict"))
