"""Exact vector queries: lookup, signed sums, cosine top-k, nearest terms, arithmetic.

A vector table has one row per word: ``word string, vector array<float>``, and
may carry ``norm``. Many queries are answered in one pass over it.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termspace.functions.vector_math import scale
from termspace.operators.skew import hot_keys, lookup_join
from termspace.session import settle

POOL = 10  # ranks that are looked at
SKIP = 1  # leading ranks that are dropped, whatever word they hold
ANSWERS = 5

# Query vectors are sent to every task up to this size (16,777 queries at 500
# dimensions); beyond it both sides are cut into cells and shuffled.
SENT_BYTES = 64 * 2**20
CELL_QUERIES = 16_384
CELL_VECTORS = 131_072
# Cells are not made narrower than this just to use more cores.
MIN_CELL_VECTORS = 2_048

# Working set inside a task: queries ranked together, queries and words scored at a time, pairs rescored at a
# time, pairs held before they are ranked.
_QUERIES_RANKED = 8_192
_QUERY_SLICE = 256
_WORD_SLICE = 2_048
_PAIR_SLICE = 16_384
_PAIRS_HELD = 2**20
# Words of the first block of a task; each block is as large as all before it.
_FIRST_BLOCK = 1_024

# A hit of one block; ``other`` is false for the term the query stands for.
_HITS = "key string, word string, sim double, other boolean"


def term_rows(queries: DataFrame) -> DataFrame:
    """(key, n_terms, pos, term, sign) of queries (key, terms array<struct<pos, term, sign>>)."""
    terms = queries.select("key", F.size("terms").alias("n_terms"), F.explode("terms").alias("t"))
    return terms.select("key", "n_terms", "t.pos", "t.term", "t.sign")


def asked_terms(terms: DataFrame, vectors: DataFrame, work: str | None = None) -> DataFrame:
    """(term, count, vector) of each distinct term asked for; vector is null for unknown terms.

    The vector table is reduced to the words asked for before it is joined. The
    result is written down (below ``work``): it is small beside the vector
    table, and every further step reads it instead.
    """
    counts = terms.groupBy("term").count()
    asked = counts.select(F.col("term").alias("word"))
    known = vectors.join(asked, "word", "left_semi").select(F.col("word").alias("term"), "vector")
    return settle(counts.join(known, "term", "left"), "asked", work)


def lookup_terms(terms: DataFrame, asked: DataFrame, **balance) -> DataFrame:
    """Add its vector to each row (key, pos, term, ...) whose term has one."""
    known = asked.filter(F.col("vector").isNotNull())
    balance.setdefault("hot", hot_keys(known, "term"))
    return lookup_join(terms, known.select("term", "vector"), "term", spread=["key", "pos"], **balance)


def signed_sum(queries: DataFrame, vectors: DataFrame, asked: DataFrame | None = None, **balance) -> DataFrame:
    """(key, vector): sum of sign * vector over the terms of a query.

    ``queries``: (key, terms array<struct<pos, term, sign>>). A query with a term
    that has no vector gives no row (see ``oov_terms``). The few terms of a query
    are gathered in one row and added in their order, in double precision: what
    cancels out leaves nothing behind, and the result does not depend on the
    partitions. Hot terms are split by the lookup before.
    """
    terms = term_rows(queries)
    found = lookup_terms(terms, asked_terms(terms, vectors) if asked is None else asked, **balance)
    signed = scale(F.col("vector").cast("array<double>"), F.col("sign"))
    gathered = (
        found.groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("pos", signed.alias("part")))).alias("parts"), F.first("n_terms").alias("n_terms"))
        .filter(F.size("parts") == F.col("n_terms"))
    )
    rest = F.slice("parts", F.lit(2), F.size("parts"))
    add = lambda total, s: F.zip_with(total, s["part"], lambda a, b: a + b)
    # Adding zero turns the negative zeros that are left over into zeros.
    total = F.transform(F.aggregate(rest, F.col("parts")[0]["part"], add), lambda x: x + F.lit(0.0))
    return gathered.select("key", total.alias("vector"))


def top_k(
    queries: DataFrame,
    vectors: DataFrame,
    pool: int = POOL,
    skip: int = SKIP,
    sent_queries: int | None = None,
    cell_queries: int = CELL_QUERIES,
    cell_vectors: int = CELL_VECTORS,
    work: str | None = None,
) -> DataFrame:
    """(key, rank, word, sim): ranks skip+1 .. pool of all words by cosine.

    ``queries``: (key string, term string, vector); ``term`` is the word the
    query stands for, or null. Equal cosines are ordered by the term itself
    first, then by word. Exact: every query is scored against every word, block
    by block as matrix products, and only ``pool`` rows per query leave a block.
    ``sent_queries`` overrides the number of queries that ``SENT_BYTES`` allows;
    ``work`` is the place for intermediate tables.
    """
    hits = _ranked_hits(queries, vectors, pool, sent_queries, cell_queries, cell_vectors, work)
    return hits.filter(F.col("rank") > skip)


def _ranked_hits(queries, vectors, pool, sent_queries, cell_queries, cell_vectors, work) -> DataFrame:
    queries = queries.select("key", "term", F.col("vector").cast("array<double>").alias("vector"))
    vectors = vectors.select("word", F.col("vector").cast("array<float>").alias("vector"))
    if sent_queries is None:
        first = vectors.select(F.size("vector")).first()
        sent_queries = SENT_BYTES // (8 * max(1, first[0] if first else 1))
    # Written once, then counted: what came before the queries is not run again for either way.
    queries = settle(queries.withColumn("zero", _without_length("vector")), "queries", work)
    n, n_zero = queries.agg(F.count("*"), F.count_if("zero")).first()
    zero, queries, n = queries.filter("zero"), queries.filter("NOT zero").drop("zero"), n - n_zero
    if n <= sent_queries:
        # A table without queries of length is not looked at.
        hits = _score_sent(queries.toArrow(), vectors if n else vectors.limit(0), pool)
    else:
        hits = _score_cells(queries, n, vectors, pool, cell_queries, cell_vectors)
    if n_zero:
        hits = hits.unionByName(_zero_hits(zero, vectors, pool))
    best_first = Window.partitionBy("key").orderBy(F.col("sim").desc(), "other", "word")
    return (
        hits.withColumn("rank", F.row_number().over(best_first))
        .filter(F.col("rank") <= pool)
        .select("key", F.col("rank").cast("long").alias("rank"), "word", "sim")
    )


def _without_length(vector: str):
    """Whether a vector has length zero; a null one is not told."""
    return F.coalesce(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x) == 0, F.lit(False))


def _zero_hits(queries: DataFrame, vectors: DataFrame, pool: int) -> DataFrame:
    """Hits of queries without length: they tie with every word, so their own term and the order of the words decide.

    No more than ``pool`` words can come first, the same ones for all queries.
    """
    words = vectors.select("word")
    first = [r["word"] for r in words.orderBy(F.col("word").asc_nulls_last()).limit(pool).collect()]
    listed = F.array(*map(F.lit, first)).cast("array<string>")
    other = F.coalesce(F.col("word") != F.col("term"), F.lit(True))
    tied = queries.select("key", "term", F.explode(listed).alias("word")).select("key", "word", other.alias("other")).filter("other")
    own = queries.join(words, F.col("term") == F.col("word")).select("key", "word", F.lit(False).alias("other"))
    return tied.unionByName(own).select("key", "word", F.lit(0.0).alias("sim"), "other")


def _score_sent(fetched: pa.Table, vectors: DataFrame, pool: int) -> DataFrame:
    """Every task gets the (few) queries; the vector table is not moved."""
    sent = vectors.sparkSession.sparkContext.broadcast(fetched)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _best_hits(sent.value, batches, pool)

    return vectors.mapInArrow(score, _HITS)


def _score_cells(queries, n_queries, vectors, pool, cell_queries, cell_vectors) -> DataFrame:
    """Both sides cut into blocks of bounded size; one task per pair of blocks."""
    n_vectors = vectors.count()
    q_blocks = math.ceil(n_queries / cell_queries)
    # As many blocks of vectors as memory asks for, or more where cores would be idle.
    idle = math.ceil(queries.sparkSession.sparkContext.defaultParallelism / q_blocks)
    useful = math.ceil(n_vectors / MIN_CELL_VECTORS)
    v_blocks = max(1, math.ceil(n_vectors / cell_vectors), min(idle, useful))

    def blocks(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # Keys and words are unique, so their hashes fill the blocks evenly.
    asked = queries.withColumn("q_block", F.pmod(F.xxhash64("key"), F.lit(q_blocks)).cast("int")).withColumn(
        "v_block", blocks(v_blocks)
    )
    words = vectors.withColumn("v_block", F.pmod(F.xxhash64("word"), F.lit(v_blocks)).cast("int")).withColumn(
        "q_block", blocks(q_blocks)
    )

    def score(asked: pa.Table, words: pa.Table) -> pa.Table:
        return pa.Table.from_batches(_best_hits(asked, words.to_batches(max_chunksize=8_192), pool), schema=BestHits.SCHEMA)

    return (
        asked.groupBy("q_block", "v_block").cogroup(words.groupBy("q_block", "v_block")).applyInArrow(score, _HITS)
    )


def _matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1).astype(np.float64, copy=False)


def _row_cosines(a: np.ndarray, b: np.ndarray, a_norms: np.ndarray, b_norms: np.ndarray) -> np.ndarray:
    """Cosine row by row; the same two vectors give the same value wherever they stand."""
    lengths = a_norms * b_norms
    products = (a * b).sum(axis=1)
    return np.divide(products, lengths, out=np.zeros_like(products), where=lengths > 0)


def _unit(vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Vectors of length one in single precision; those without length stay zero."""
    return np.divide(vectors, norms[:, None], out=np.zeros_like(vectors), where=norms[:, None] > 0).astype(np.float32)


def _true_places(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the few true flags, looked for eight at a time."""
    flat = flags.ravel()
    whole = len(flat) // 8 * 8
    eights = np.flatnonzero(flat[:whole].view(np.uint64))
    at = (eights[:, None] * 8 + np.arange(8)).ravel()
    at = np.r_[at[flat[at]], whole + np.flatnonzero(flat[whole:])]
    return np.divmod(at, max(1, flags.shape[1]))


def _places(query: np.ndarray) -> np.ndarray:
    """Place within the query: position minus the position of the query's first hit."""
    firsts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
    return np.arange(len(query)) - np.repeat(firsts, np.diff(np.r_[firsts, len(query)]))


class BestHits:
    """The best ``pool`` words per query over the batches of one task.

    Products in single precision find the pairs that may be among the best:
    whatever comes near enough to the last place kept so far. Only these are
    scored in double precision, and ranked. Queries have a length.
    """

    SCHEMA = pa.schema([("key", pa.string()), ("word", pa.string()), ("sim", pa.float64()), ("other", pa.bool_())])
    _RANKING = [("query", "ascending"), ("sim", "descending"), ("other", "ascending"), ("word", "ascending")]

    def __init__(self, queries: pa.Table, pool: int):
        self.pool = pool
        self.keys = queries["key"].combine_chunks()
        self.terms = queries["term"].combine_chunks()
        self.queries = _matrix(queries["vector"]) if len(self.keys) else np.zeros((0, 0))
        self.norms = np.sqrt((self.queries**2).sum(axis=1))
        self.units = _unit(self.queries, self.norms)
        # Rounding of a product of two units of so many entries, twice the bound.
        self.margin = (self.queries.shape[1] + 8) * 2.0**-22
        # Kept hits, and the value a new hit must reach.
        self.query, self.sim, self.word = np.zeros(0, np.int64), np.zeros(0), pa.array([], pa.string())
        self.floor = np.where(self.norms == 0, np.inf, -np.inf)
        self.seen = 0

    def add(self, words: pa.Array, vectors: pa.Array) -> None:
        if not len(words) or not len(self.keys):
            return
        words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
        block = _matrix(vectors)
        norms = np.sqrt((block**2).sum(axis=1))
        unit = _unit(block, norms)
        first = 0
        while first < len(words):
            rows = slice(first, first + max(_FIRST_BLOCK, self.seen))
            self._add(words[rows], block[rows], norms[rows], unit[rows])
            self.seen += len(words[rows])
            first = rows.stop

    def _add(self, words: pa.Array, block: np.ndarray, norms: np.ndarray, unit: np.ndarray) -> None:
        found, held = [], 0
        for start in range(0, len(self.keys), _QUERY_SLICE):
            for begin in range(0, len(unit), _WORD_SLICE):
                queries, rows = self._near(unit[begin : begin + _WORD_SLICE], slice(start, start + _QUERY_SLICE))
                queries, rows = queries + start, rows + begin
                for first in range(0, len(rows), _PAIR_SLICE):
                    r, q = rows[first : first + _PAIR_SLICE], queries[first : first + _PAIR_SLICE]
                    found.append((q, r, _row_cosines(block[r], self.queries[q], norms[r], self.norms[q])))
                    held += len(r)
                    # However many rows tie, no more than the pool of each query is held.
                    if held > _PAIRS_HELD:
                        self._merge(found, words)
                        found, held = [], 0
        if found:
            self._merge(found, words)

    def _near(self, unit: np.ndarray, part: slice) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) pairs that may be among the best."""
        sims = self.units[part] @ unit.T
        floor = self.floor[part] - self.margin
        fresh = np.flatnonzero(np.isneginf(floor))
        if len(fresh) and len(unit) > self.pool:
            # Nothing is kept of these queries yet: the block's own pool sets the value.
            last = len(unit) - self.pool
            floor[fresh] = np.partition(sims[fresh], last, axis=1)[:, last] - 2 * self.margin
        # Rounded down to single precision, as the products are.
        floor = np.nextafter(floor.astype(np.float32), np.float32(-np.inf))
        return _true_places(sims >= floor[:, None])

    def _merge(self, found: list[tuple], words: pa.Array) -> None:
        """Rank new hits (query, row, sim) with the kept ones of their queries; the others stay as they are."""
        query, row, sim = (np.concatenate(c) for c in zip(*found))
        touched = np.zeros(len(self.keys), bool)
        touched[query] = True
        mine = touched[self.query]
        own, rest = pa.array(mine), pa.array(~mine)
        # Places in the kept words of these queries, then in the new ones.
        place = np.r_[np.arange(mine.sum()), mine.sum() + row]
        query, sim = np.r_[self.query[mine], query], np.r_[self.sim[mine], sim]
        order = np.lexsort((-sim, query))
        query, sim, place = query[order], sim[order], place[order]
        # The pool of each query, and what ties with its last hit.
        rank = _places(query)
        last = rank == self.pool - 1
        least = np.full(len(self.keys), -np.inf)
        least[query[last]] = sim[last]
        best = (rank < self.pool) | (sim == least[query])
        query, sim, place = query[best], sim[best], place[best]
        word = pa.concat_arrays([self.word.filter(own), words]).take(pa.array(place))
        if len(query) > 1 and ((query[1:] == query[:-1]) & (sim[1:] == sim[:-1])).any():
            hits = pa.table({"query": query, "sim": sim, "other": self._other(query, word), "word": word})
            order = pc.sort_indices(hits, sort_keys=self._RANKING)
            word = word.take(order)
            query, sim = query[order.to_numpy()], sim[order.to_numpy()]
        rank = _places(query)
        kept, last = rank < self.pool, rank == self.pool - 1
        self.floor[query[last]] = sim[last]
        self.query, self.sim = np.r_[self.query[~mine], query[kept]], np.r_[self.sim[~mine], sim[kept]]
        self.word = pa.concat_arrays([self.word.filter(rest), word.filter(pa.array(kept))])

    def _other(self, query: np.ndarray, word: pa.Array) -> pa.Array:
        """False for the term that the query stands for; it goes before its equals."""
        return pc.fill_null(pc.not_equal(word, self.terms.take(pa.array(query))), True)

    def batches(self) -> list[pa.RecordBatch]:
        keys = self.keys.take(pa.array(self.query))
        table = pa.table([keys, self.word, pa.array(self.sim), self._other(self.query, self.word)], schema=self.SCHEMA)
        return table.to_batches(max_chunksize=65_536)


def _best_hits(queries: pa.Table, words: Iterable[pa.RecordBatch], pool: int) -> Iterator[pa.RecordBatch]:
    """Hits of the queries among batches of (word, vector); queries are ranked a bounded number at a time."""
    parts = [BestHits(queries.slice(first, _QUERIES_RANKED), pool) for first in range(0, len(queries), _QUERIES_RANKED)]
    for batch in words:
        for part in parts:
            part.add(batch["word"], batch["vector"])
    for part in parts:
        yield from part.batches()


def _first(hits: DataFrame, n: int) -> DataFrame:
    """The first n of the remaining ranks, renumbered."""
    place = F.row_number().over(Window.partitionBy("key").orderBy("rank"))
    return hits.withColumn("rank", place.cast("long")).filter(F.col("rank") <= n)


def _unlike_term(word, term):
    """Neither is the beginning of the other."""
    return ~F.startswith(word, term) & ~F.startswith(term, word)


def _unlike_terms(word, terms):
    """The word begins with none of the terms."""
    return ~F.exists(terms, lambda t: F.startswith(word, t["term"]))


def nearest_terms(
    queries: DataFrame, vectors: DataFrame, n: int = ANSWERS, pool: int = POOL, skip: int = SKIP, **sizes
) -> DataFrame:
    """(key, rank, word, sim): up to n words nearest to ``term``.

    ``queries``: (key, term). Words that begin with the term, or that the term
    begins with, are dropped after the pool is cut, so fewer than n may remain.
    """
    terms = queries.select("key", F.lit(0).alias("pos"), "term")
    found = lookup_terms(terms, asked_terms(terms, vectors))
    hits = top_k(found.select("key", "term", "vector"), vectors, pool, skip, **sizes)
    kept = hits.join(queries.select("key", "term"), "key").filter(_unlike_term(F.col("word"), F.col("term")))
    return _first(kept.drop("term"), n)


def term_arithmetic(
    queries: DataFrame, vectors: DataFrame, n: int = ANSWERS, pool: int = POOL, skip: int = SKIP, **sizes
) -> DataFrame:
    """(key, rank, word, sim): up to n words nearest to a signed sum of terms.

    ``queries``: (key, terms). Words that begin with any of the terms are
    dropped after the pool is cut.
    """
    summed = signed_sum(queries, vectors).withColumn("term", F.lit(None).cast("string"))
    hits = top_k(summed, vectors, pool, skip, **sizes)
    kept = hits.join(queries.select("key", "terms"), "key").filter(_unlike_terms(F.col("word"), F.col("terms")))
    return _first(kept.drop("terms"), n)


def answer_queries(
    queries: DataFrame,
    vectors: DataFrame,
    n: int = ANSWERS,
    pool: int = POOL,
    skip: int = SKIP,
    asked: DataFrame | None = None,
    **sizes,
) -> DataFrame:
    """(key, words): answers to expressions of known terms, in one pass over the vectors.

    One term: as ``nearest_terms``; several: as ``term_arithmetic``. A query
    without any remaining word gives no row.
    """
    single = F.when(F.size("terms") == 1, F.col("terms")[0]["term"])
    summed = signed_sum(queries, vectors, asked).join(queries.select("key", single.alias("term")), "key")
    hits = top_k(summed, vectors, pool, skip, **sizes)
    word, terms = F.col("word"), F.col("terms")
    unlike = F.when(F.size(terms) == 1, _unlike_term(word, terms[0]["term"])).otherwise(_unlike_terms(word, terms))
    kept = _first(hits.join(queries.select("key", "terms"), "key").filter(unlike), n)
    ranked = F.sort_array(F.collect_list(F.struct("rank", "word")))
    return kept.groupBy("key").agg(F.transform(ranked, lambda s: s["word"]).alias("words"))
