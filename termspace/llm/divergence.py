"""How far the sources of a language stand apart in their words.

A CountVectorizer turns every document into an exact sparse vector; the vectors
of a (lang, source) group are summed, index by index, and groups are compared by
smoothed shares in whole billionths. Terms that a group lacks all have the same
share, so a pair needs only the terms that one of the two has.

A token is a term together with its language. So one fit gives every language
its own vocabulary and its own document frequencies, in one pass, however many
languages there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termspace.llm.common import bounded_slices, columns_as, text_bytes, texts_of
from termspace.session import scratch_path, settle

# The unit of a share and the count added to every term.
UNIT = 1_000_000_000
SMOOTH = 5
MIN_DOCUMENTS = 30
TOP_TERMS = 50
# Largest integer: no term is left out for being rare among the kept ones.
VOCABULARY = 2**31 - 1
# Bound of the terms that one fit brings to the driver and to every task; more terms are fitted in parts.
FIT_TERMS = 2**21
# Sources and terms that a task compares at once.
SOURCE_BLOCK, TERM_BLOCK = 64, 4_096

_END = "\x00"
SLICE = 2 * 2**20
# Entries of sparse vectors that are added up at once; a longer vector is added by itself.
ENTRIES = 2**20

# Bytes of terms: ASCII letters, and all bytes of other characters. A-Z become a-z.
_BYTES = np.arange(256)
_CAPITAL = (_BYTES >= 65) & (_BYTES <= 90)
_TERM_BYTE = _CAPITAL | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_LOWER = (_BYTES + 32 * _CAPITAL).astype(np.uint8)


def term_tokens(docs: DataFrame) -> DataFrame:
    """(_lang, _source, _tokens): every term of a text with its language after a mark that no term holds."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = texts_of(batch["_text"]), batch["_lang"]
            data, offsets = text_bytes(texts)
            for first, last in bounded_slices(offsets, SLICE):
                tokens = _tokens(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], langs[first:last])
                yield pa.RecordBatch.from_arrays([langs[first:last], batch["_source"][first:last], tokens], ["_lang", "_source", "_tokens"])

    return docs.select("_text", "_lang", "_source").mapInArrow(cut, "_lang string, _source string, _tokens array<string>")


def _tokens(data: np.ndarray, offsets: np.ndarray, langs: pa.Array) -> pa.ListArray:
    inside = _TERM_BYTE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    # Places of the terms when all else is left out.
    place = np.append(np.cumsum(inside)[starts] - 1, inside.sum()).astype(np.int32)
    terms = pa.StringArray.from_buffers(len(starts), pa.py_buffer(place), pa.py_buffer(_LOWER[data[inside]]))
    each = np.searchsorted(starts, offsets)
    marks = pc.binary_join_element_wise(pa.scalar(_END), langs, "")
    marked = pc.binary_join_element_wise(terms, marks.take(pa.array(np.repeat(np.arange(len(langs)), np.diff(each)))), "")
    return pa.ListArray.from_arrays(pa.array(each, pa.int32()), marked)


def group_counts(
    docs: DataFrame,
    work: str,
    min_documents: int = MIN_DOCUMENTS,
    fit_terms: int = FIT_TERMS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(vocabulary, groups, counts) of (_text, _lang, _source) rows without nulls.

    vocabulary: (_lang, _term, _index), the terms of at least ``min_documents``
    rows of the language. groups: (_lang, _source), all that occur. counts:
    (_lang, _source, _index, _count), only those above zero.
    """
    spark = docs.sparkSession
    # Texts are cut once; counting and turning into vectors read the terms.
    tokens = settle(term_tokens(docs), "tokens", work)
    groups = settle(tokens.select("_lang", "_source").distinct(), "groups", work)
    # Rows that have a term, counted once; how many terms are kept decides in how many parts they are fitted.
    each = tokens.select(F.explode(F.array_distinct("_tokens")).alias("_token")).groupBy("_token").count()
    kept = settle(each.filter(F.col("count") >= min_documents).select("_token"), "kept", work)
    parts = -(-kept.count() // fit_terms)
    vocabularies, counts = [], []
    for part in range(parts):
        chosen = kept.filter(F.pmod(F.xxhash64("_token"), F.lit(parts)) == part) if parts > 1 else kept
        # Fitted on the kept terms, not on the texts: each of them has its place.
        counter = CountVectorizer(inputCol="_tokens", outputCol="_vector", vocabSize=VOCABULARY)
        model = counter.fit(chosen.select(F.array("_token").alias("_tokens")))
        path = f"{work}/model{part}"
        model.write().save(path)
        words = spark.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("_pos", "_token"))
        end = F.instr("_token", _END)
        vocabularies.append(
            words.select(
                F.substr(F.col("_token"), end + 1).alias("_lang"),
                F.substr(F.col("_token"), F.lit(1), end - 1).alias("_term"),
                (F.col("_pos").cast("long") * parts + part).alias("_index"),
            )
        )
        counts.append(group_sums(model.transform(tokens), F.col("_pos").cast("long") * parts + part))
    if not parts:
        empty = groups.limit(0)
        vocabularies.append(empty.select("_lang", F.col("_source").alias("_term"), F.lit(0).cast("long").alias("_index")))
        counts.append(empty.select("*", F.lit(0).cast("long").alias("_index"), F.lit(0).cast("long").alias("_count")))
    return settle(_union(vocabularies), "vocabulary", work), groups, settle(_union(counts), "counts", work)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def group_sums(vectors: DataFrame, index: Column) -> DataFrame:
    """(_lang, _source, _index, _count): the sparse vectors of each group summed, as whole numbers.

    A task adds up the vectors of a stretch of rows, in all groups at once,
    before anything is shuffled.
    """
    vector = F.unwrap_udt("_vector")
    entries = vectors.select("_lang", "_source", vector["indices"].alias("_at"), vector["values"].alias("_n"))
    partial = entries.mapInArrow(_stretch_sums, "_lang string, _source string, _pos int, _n long")
    sums = partial.groupBy("_lang", "_source", "_pos").agg(F.sum("_n").alias("_count"))
    return sums.select("_lang", "_source", index.alias("_index"), "_count")


def _stretch_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang, source = (batch[c].dictionary_encode() for c in ("_lang", "_source"))
        wide = max(1, len(source.dictionary))
        group = lang.indices.to_numpy().astype(np.int64) * wide + source.indices.to_numpy()
        sizes = np.append(0, np.cumsum(pc.list_value_length(batch["_at"]).to_numpy()))
        for first, last in bounded_slices(sizes, ENTRIES):
            at, n = (batch[c][first:last].flatten().to_numpy() for c in ("_at", "_n"))
            key = np.repeat(group[first:last], np.diff(sizes[first : last + 1])) << 32 | at
            different, place = np.unique(key, return_inverse=True)
            total, of = np.bincount(place, n, len(different)).astype(np.int64), different >> 32
            columns = [
                lang.dictionary.take(pa.array(of // wide)),
                source.dictionary.take(pa.array(of % wide)),
                pa.array((different & 0xFFFFFFFF).astype(np.int32)),
                pa.array(total),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["_lang", "_source", "_pos", "_n"])


def _share(count: Column, total: Column, terms: Column, smooth: int) -> Column:
    """1 + floor(UNIT * (count + smooth) / (total + smooth * terms)), by whole numbers that cannot overflow."""
    above = (count + smooth).cast("decimal(19,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = (total + smooth * terms).cast("decimal(19,0)")
    return F.call_function("div", above, below) + 1


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    smooth: int = SMOOTH,
    top_terms: int = TOP_TERMS,
    fit_terms: int = FIT_TERMS,
    source_block: int = SOURCE_BLOCK,
    term_block: int = TERM_BLOCK,
) -> DataFrame:
    """(lang, source, part, item, value, rank): every group against the other sources and against its language.

    Null text, lang and source are ''. A repeated row is a document of its own.
    Part ``pair``: the distance to each other source of the language, the sum of
    the differences of shares over the language's kept terms, 0 if it keeps
    none. Part ``term``: by how much the group's share of a term exceeds the
    language's, the ``top_terms`` highest. Ranks go by value, falling, then by
    item in the order of its bytes. A group of empty texts has pairs and no
    terms; a language of one source has no pairs; an empty table gives no rows.
    Texts of any length are read whole. Columns that are not named do not matter.
    """
    spark = docs.sparkSession
    work = scratch_path(spark, "divergence")
    rows = columns_as(docs, _text=text, _lang=lang, _source=source).na.fill("")
    vocabulary, groups, counts = group_counts(rows, work, min_documents, fit_terms)
    sizes = vocabulary.groupBy("_lang").agg(F.count("*").alias("_terms"))
    totals = counts.groupBy("_lang", "_source").agg(F.sum("_count").alias("_total"))
    zero = F.lit(0).cast("long")
    groups = groups.join(totals, ["_lang", "_source"], "left").join(sizes, "_lang", "left")
    groups = groups.fillna(0, ["_total", "_terms"]).withColumn("_base", F.when(F.col("_terms") > 0, _share(zero, F.col("_total"), F.col("_terms"), smooth)))
    # Sources are numbered within their language, to be dealt out to blocks.
    numbered = Window.partitionBy("_lang").orderBy("_source")
    groups = settle(groups.withColumn("_number", F.row_number().over(numbered) - 1), "sized", work)
    shares = counts.join(groups, ["_lang", "_source"]).withColumn("_p", _share(F.col("_count"), F.col("_total"), F.col("_terms"), smooth))
    shares = settle(shares.select("_lang", "_source", "_number", "_index", "_count", "_p"), "shares", work)
    found = pair_rows(groups, shares, source_block, term_block).unionByName(term_rows(groups, shares, vocabulary, smooth, top_terms))
    return found.select("lang", "source", "part", "item", "value", "rank")


def _ranked(rows: DataFrame, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= most) if most else ranked


def term_rows(groups: DataFrame, shares: DataFrame, vocabulary: DataFrame, smooth: int, most: int) -> DataFrame:
    """The terms whose share in a group most exceeds that in its language."""
    whole = groups.groupBy("_lang").agg(F.sum("_total").alias("_all"), F.max("_terms").alias("_terms"))
    q = shares.groupBy("_lang", "_index").agg(F.sum("_count").alias("_n")).join(whole, "_lang")
    q = q.select("_index", _share(F.col("_n"), F.col("_all"), F.col("_terms"), smooth).alias("_q"))
    above = shares.join(q, "_index").filter(F.col("_p") > F.col("_q"))
    named = above.join(vocabulary.select("_index", "_term"), "_index").select(
        F.col("_lang").alias("lang"),
        F.col("_source").alias("source"),
        F.lit("term").alias("part"),
        F.col("_term").alias("item"),
        (F.col("_p") - F.col("_q")).alias("value"),
    )
    return _ranked(named, most)


def pair_rows(groups: DataFrame, shares: DataFrame, source_block: int, term_block: int) -> DataFrame:
    """The distance of every two sources of a language.

    Sources are cut into blocks and terms into stretches; a task has the shares
    of two blocks over one stretch and gives one partial sum per pair. What it
    holds is bounded by block and stretch, whatever the sources and terms.
    """
    block = (F.col("_number") / source_block).cast("long")
    stretch = (F.col("_index") / term_block).cast("long").alias("_stretch")
    blocks = groups.groupBy("_lang").agg((F.max(block) + 1).alias("_blocks"))
    given = shares.select("_lang", "_number", stretch, "_index", "_p")
    # A source without a term of a stretch takes part in it with its base.
    bases = groups.select("_lang", "_number", F.col("_base").alias("_p")).join(given.select("_lang", "_stretch").distinct(), "_lang")
    given = given.unionByName(bases.withColumn("_index", F.lit(-1).cast("long")))
    dealt = given.join(blocks, "_lang")
    # Every block meets each block, itself included, once.
    partner = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))
    dealt = dealt.select("*", block.alias("_mine"), partner.alias("_other")).select(
        "_lang",
        F.least("_mine", "_other").alias("_low"),
        F.greatest("_mine", "_other").alias("_high"),
        "_stretch",
        "_mine",
        "_number",
        "_index",
        "_p",
    )
    partial = dealt.groupBy("_lang", "_low", "_high", "_stretch").applyInArrow(_partial_sums, "_lang string, _a int, _b int, _part long")
    partial = partial.groupBy("_lang", "_a", "_b").agg(F.sum("_part").alias("_part"))
    # The pairs themselves are the rows of the result.
    one = groups.select("_lang", F.col("_source").alias("source"), F.col("_number").alias("_m"), F.col("_base").alias("_base_a"), "_terms")
    two = groups.select("_lang", F.col("_source").alias("item"), F.col("_number").alias("_n"), F.col("_base").alias("_base_b"))
    pairs = one.join(two, "_lang").filter(F.col("_m") != F.col("_n"))
    pairs = pairs.withColumns({"_a": F.least("_m", "_n"), "_b": F.greatest("_m", "_n")}).join(partial, ["_lang", "_a", "_b"], "left")
    far = F.col("_terms") * F.abs(F.col("_base_a") - F.col("_base_b"))
    pairs = pairs.select(
        F.col("_lang").alias("lang"),
        "source",
        F.lit("pair").alias("part"),
        "item",
        F.coalesce(far + F.coalesce("_part", F.lit(0)), F.lit(0)).cast("long").alias("value"),
    )
    return _ranked(pairs)


def _partial_sums(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum over the stretch's terms of |p - q| - |base p - base q|, for every pair of a low and a high source."""
    rows = pa.Table.from_batches(list(batches))
    mine, number, index, p = (rows[c].to_numpy() for c in ("_mine", "_number", "_index", "_p"))
    terms = np.unique(index[index >= 0])

    def block(which: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        base, term = (mine == which) & (index < 0), (mine == which) & (index >= 0)
        order = np.argsort(number[base])
        sources, bases = number[base][order], p[base][order]
        matrix = np.repeat(bases[:, None], len(terms), axis=1)
        matrix[np.searchsorted(sources, number[term]), np.searchsorted(terms, index[term])] = p[term]
        return sources, bases, matrix

    a, base_a, p_a = block(key[1].as_py())
    b, base_b, p_b = block(key[2].as_py())
    found: list[list[np.ndarray]] = [[], [], []]
    for i in range(len(a)):
        sums = np.abs(p_b - p_a[i]).sum(axis=1) - len(terms) * np.abs(base_b - base_a[i])
        after = b > a[i]
        for column, values in zip(found, (np.full(after.sum(), a[i]), b[after], sums[after])):
            column.append(values)
    one, two, part = (np.concatenate(c) for c in found)
    lang = pa.array([key[0].as_py()] * len(one), pa.string())
    yield pa.RecordBatch.from_arrays(
        [lang, pa.array(one, pa.int32()), pa.array(two, pa.int32()), pa.array(part, pa.int64())], ["_lang", "_a", "_b", "_part"]
    )
