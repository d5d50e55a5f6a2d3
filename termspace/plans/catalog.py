"""Queries over the sample tables, one or more per operator.

The tables hold neither articles nor mentions nor word vectors as such; these
are derived from them, whole, as follows:

* articles: one per document, abstract = first line, body = the other lines;
* word vectors: ``embeddings`` with the id as word, or the vocabulary of the
  documents with the embeddings dealt out in order of frequency;
* mentions: one per event, the expression made of the user id.
"""

from __future__ import annotations

import gzip
import tarfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termspace.functions import expressions as X
from termspace.functions import text
from termspace.functions.vector_math import cosine
from termspace.operators import answers, embedding, lexicon, relational, similarity, skipgram
from termspace.operators.vocabulary import indexed_vocabulary, lists_and_distinct, vocabulary
from termspace.plans import stages, training
from termspace.schemas import ARTICLE
from termspace.session import fill_cores, scratch_path, settle
from termspace.sources import articles, pages, records, vectors
from termspace.sources.streams import filesystem_of
from termspace.streaming import articles as article_stream
from termspace.streaming import mentions as mention_stream_job

BOT = "bot"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir) -> DataFrame:
    return fill_cores(table(spark, sf_dir, "documents"))


def tokens(spark, sf_dir) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", text.regex_tokens("text").alias("words"))


def id_vectors(spark, sf_dir) -> DataFrame:
    """Embeddings as a vector table, the id as word."""
    return fill_cores(table(spark, sf_dir, "embeddings")).select(
        F.col("vec_id").cast("string").alias("word"), F.col("embedding").alias("vector")
    )


def word_vectors(spark, sf_dir) -> DataFrame:
    """Vocabulary of the documents; word number i has embedding number i modulo their count."""
    embeddings = table(spark, sf_dir, "embeddings")
    indexed = indexed_vocabulary(vocabulary(tokens(spark, sf_dir)))
    dealt = indexed.withColumn("vec_id", F.col("idx") % F.lit(embeddings.count()))
    return dealt.join(embeddings, "vec_id").select("word", "idx", "count", F.col("embedding").alias("vector"))


def three_term_queries(spark, sf_dir) -> DataFrame:
    """One query per embedding: its id - the next id + the one after."""
    vec = F.col("vec_id")
    expression = F.concat_ws(
        "", vec.cast("string"), F.lit(" - "), (vec + 1).cast("string"), F.lit(" + "), (vec + 2).cast("string")
    )
    return table(spark, sf_dir, "embeddings").select(
        vec.cast("string").alias("key"), X.parse_expression(expression).alias("terms")
    )


def mentions(events: DataFrame) -> DataFrame:
    """One mention per event; what it says depends on the event type."""
    user = F.col("user_id").cast("string")
    after = lambda n: (F.col("user_id") + n).cast("string")
    kind = F.col("event_type")
    message = (
        F.when(kind == "view", F.concat(F.lit("@bot "), user))
        .when(kind == "click", F.concat(F.lit("@bot "), user, F.lit(" - "), after(1), F.lit(" + "), after(2)))
        .when(kind == "purchase", F.concat(F.lit("@bot "), user, F.lit(" + ZZ"), user))
        .when(kind == "signup", F.concat(F.lit("hi @bot "), user))
        .otherwise(F.concat(F.lit("@bot "), user, F.lit(" + "), after(3), F.lit(" @u"), after(1)))
    )
    return events.select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("u"), user).alias("author"),
        message.alias("text"),
    )


def event_mentions(spark, sf_dir) -> DataFrame:
    return mentions(fill_cores(table(spark, sf_dir, "events")))


def lines_of(column: str) -> Column:
    return F.split(column, "\n")


def after_first(values: Column) -> Column:
    return F.slice(values, F.lit(2), F.size(values))


def article_rows(spark, sf_dir) -> DataFrame:
    """Documents as article records."""
    lines = lines_of("text")
    empty = F.array().cast("array<string>")
    given = {
        "doi": F.concat(F.lit("10.1/"), F.col("doc_id").cast("string")),
        "coll_date": F.array(F.col("n_chars").cast("string")),
        "meta_journal": F.array("source"),
        "keywordList": F.array("lang", "source"),
        "abstract": lines[0],
        "fulltext": F.array_join(after_first(lines), " "),
        "source_file": F.col("source"),
    }
    return documents(spark, sf_dir).select(*[given.get(n, empty).alias(n) for n in ARTICLE.fieldNames()])


def article_xml(spark, sf_dir, broken: Column | None = None) -> DataFrame:
    """(doc_id, lang, xml): documents as article XML; ``broken`` ones miss a closing tag."""

    def escaped(value: Column) -> Column:
        value = F.replace(value, F.lit("&"), F.lit("&amp;"))
        return F.replace(F.replace(value, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    lines = F.transform(lines_of("text"), escaped)
    # A <b> mark in every paragraph: inner marks must not lose text.
    paragraph = lambda line: F.concat(F.lit("<p><b>"), line, F.lit("</b></p>"))
    body_end = F.lit("</body>")
    if broken is not None:
        body_end = F.when(broken, "").otherwise(body_end)
    xml = F.concat(
        F.lit('<article>\n<front><journal-meta><journal-title>'),
        F.col("source"),
        F.lit('</journal-title></journal-meta><article-meta><article-id pub-id-type="doi">10.1/'),
        F.col("doc_id").cast("string"),
        F.lit('</article-id><pub-date pub-type="collection">'),
        F.col("n_chars").cast("string"),
        F.lit("</pub-date><kwd-group><kwd>"),
        F.col("lang"),
        F.lit("</kwd><kwd>"),
        F.col("source"),
        F.lit("</kwd></kwd-group></article-meta><abstract>"),
        paragraph(lines[0]),
        F.lit("</abstract></front>\n<body>"),
        F.array_join(F.transform(after_first(lines), paragraph), "\n"),
        body_end,
        F.lit("\n</article>"),
    )
    return documents(spark, sf_dir).select("doc_id", "lang", xml.alias("xml"))


def written_collection(xml: DataFrame, folder: str) -> str:
    xml.select("xml").write.mode("append").option("compression", "gzip").text(folder)
    return folder


def text_list(column: str) -> Column:
    return F.array_join(column, " | ", "<null>").alias(column)


# Sources and sinks.


def xml_collection(spark, sf_dir) -> DataFrame:
    folder = written_collection(article_xml(spark, sf_dir), scratch_path(spark, "collection"))
    rows = articles.extract_articles(articles.read_article_collection(spark, folder))
    good, _ = articles.split_quarantine(rows)
    return good.select(
        "doi",
        *map(text_list, ["coll_date", "disciplines", "meta_journal", "references", "keywordList"]),
        "abstract",
        "fulltext",
    )


def parsed_once(rows: DataFrame) -> DataFrame:
    """What tells articles and quarantine apart, written down: each of the two would read and parse all files."""
    return settle(rows.select("source_file", "doi", "error", "xml"), "parsed")


def quarantine(spark, sf_dir) -> DataFrame:
    xml = article_xml(spark, sf_dir, broken=F.col("lang") == "de")
    folder = written_collection(xml, scratch_path(spark, "collection"))
    rows = articles.extract_articles(articles.read_article_collection(spark, folder))
    good, bad = articles.split_quarantine(parsed_once(rows))
    found = r'pub-id-type="doi">10\.1/([0-9]+)<'
    bad_ids = bad.select(F.regexp_extract("xml", found, 1).alias("doc_id"), F.lit("quarantine").alias("status"))
    good_ids = good.select(F.substr(F.col("doi"), F.lit(6)).alias("doc_id"), F.lit("article").alias("status"))
    return good_ids.unionByName(bad_ids).select(F.col("doc_id").cast("long").alias("doc_id"), "status")


def incremental_conversion(spark, sf_dir) -> DataFrame:
    """Files arrive in two lots, and the job runs after each and once more."""
    folder, output, checkpoint = (scratch_path(spark, x) for x in ("collection", "converted", "progress"))
    xml = article_xml(spark, sf_dir, broken=F.col("lang") == "es")
    for lot in (F.col("lang") == "en", F.col("lang") != "en", F.lit(False)):
        written_collection(xml.filter(lot), folder)
        article_stream.convert_new_files(spark, folder, output, checkpoint).awaitTermination()
    good, bad = article_stream.read_converted(spark, output)
    bad_ids = F.regexp_extract("xml", r'pub-id-type="doi">([^<]*)<', 1).alias("doi")
    return good.select("doi", "fulltext").unionByName(bad.select(bad_ids, F.lit("").alias("fulltext")))


# Articles per damaged file, and the place of the one that is hit.
FILE_ARTICLES, HIT = 64, 40


def damaged_files(xml: DataFrame, folder: str, packed: bool = False) -> None:
    """Gzip collections of consecutive documents, a gzip member each, below ``folder``; ``packed``: tar archives.

    Of every four files one is whole, one ends in the middle of a member, one
    has a member whose data do not fit their checksum, one has bytes that begin
    no member. A file without the member that would be hit is whole.
    """

    def write(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((i, x) for b in batches for i, x in zip(b["doc_id"].to_pylist(), b["xml"].to_pylist()))
        texts = [packed_member(f"{i // 10}/{i}.xml", x.encode()) if packed else x.encode() for i, x in rows]
        members = [gzip.compress(x, mtime=0) for x in texts]
        harm = key[0].as_py() % 4
        if harm and len(members) > HIT:
            member = members[HIT]
            if harm == 1:
                members[HIT:] = [member[: len(member) // 2]]
            elif harm == 2:
                members[HIT] = member[:-8] + bytes(b ^ 255 for b in member[-8:-4]) + member[-4:]
            else:
                members[HIT] = b"no gzip" + member
        if packed and not (harm == 1 and len(rows) > HIT):
            members.append(gzip.compress(bytes(2 * tarfile.BLOCKSIZE), mtime=0))
        files, inner = filesystem_of(folder)
        files.create_dir(inner)
        # Written under another name first: a task that is repeated leaves no half file.
        name = f"{inner}/{key[0].as_py():09d}.{'tar' if packed else 'xml'}.gz"
        draft = f"{name}.{uuid.uuid4().hex}.tmp"
        with files.open_output_stream(draft, compression=None) as out:
            out.write(b"".join(members))
        files.move(draft, name)
        yield pa.RecordBatch.from_pydict({"file": [name]})

    filed = xml.withColumn("file", F.floor(F.col("doc_id") / FILE_ARTICLES).cast("long"))
    filed.select("file", "doc_id", "xml").groupBy("file").applyInArrow(write, "file string").count()


def packed_member(name: str, data: bytes) -> bytes:
    """A file as it stands in a tar archive."""
    info = tarfile.TarInfo(name)
    info.size = len(data)
    return info.tobuf() + data + bytes(-len(data) % tarfile.BLOCKSIZE)


def archive_members(spark, sf_dir) -> DataFrame:
    """Articles packed in tar.gz archives, some cut or damaged: every member before a break, and one row for each break."""
    folder = scratch_path(spark, "archives")
    damaged_files(article_xml(spark, sf_dir), folder, packed=True)
    rows = articles.extract_articles(articles.read_article_files(spark, folder, "gz"))
    file = F.regexp_extract("source_file", r"([0-9]+)\.tar\.gz(!|$)", 1).cast("long").alias("file")
    member = F.regexp_extract("source_file", r"!(.*)$", 1).alias("member")
    why = F.when(F.startswith("error", F.lit("broken at byte ")), "broken").otherwise(F.coalesce("error", F.lit("article")))
    return rows.select(file, member, "doi", "fulltext", why.alias("status"))


def damaged_collection(spark, sf_dir) -> DataFrame:
    """Gzip collections, some cut or damaged, read by the batch job and by the incremental one.

    Every article before a break, and one row for each break.
    """
    folder, output, checkpoint = (scratch_path(spark, x) for x in ("collection", "converted", "progress"))
    damaged_files(article_xml(spark, sf_dir), folder)
    batch = articles.split_quarantine(parsed_once(articles.extract_articles(articles.read_article_collection(spark, folder))))
    article_stream.convert_new_files(spark, folder, output, checkpoint).awaitTermination()
    found = []
    for job, (good, bad) in (("batch", batch), ("stream", article_stream.read_converted(spark, output))):
        file = F.regexp_extract("source_file", r"([0-9]+)\.xml\.gz$", 1).cast("long")
        found.append(good.select(F.lit(job).alias("job"), file.alias("file"), "doi", F.lit("article").alias("status")))
        why = F.when(F.startswith("error", F.lit("broken at byte ")), "broken").otherwise(F.col("error")).alias("status")
        found.append(bad.select(F.lit(job).alias("job"), file.alias("file"), F.lit(None).cast("string").alias("doi"), why))
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


def page_article_block(spark, sf_dir) -> DataFrame:
    """The page with a line break before its article, cut there."""
    start = F.instr("html", "<article")
    html = F.col("html")
    value = F.concat(F.substr(html, F.lit(1), start - 1), F.lit("\n"), F.substr(html, start))
    cut = table(spark, sf_dir, "pages").select("page_id", value.alias("value"))
    return cut.select("page_id", articles.article_block("value").alias("block"))


def page_metadata(spark, sf_dir) -> DataFrame:
    found = pages.page_metadata(table(spark, sf_dir, "pages"))
    return found.select("page_id", *map(text_list, ["lang", "title", "h1", "links"]))


def page_paragraphs(spark, sf_dir) -> DataFrame:
    return pages.page_paragraphs(table(spark, sf_dir, "pages")).select("page_id", "fulltext")


def pending_items(spark, sf_dir) -> DataFrame:
    return records.pending(documents(spark, sf_dir), table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "source")


def _record_view(df: DataFrame) -> DataFrame:
    lists = ["coll_date", "disciplines", "meta_journal", "keywordList"]
    return df.select("doi", *map(text_list, lists), "abstract", "fulltext", "source_file")


def json_roundtrip(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "json")
    records.write_articles(article_rows(spark, sf_dir), path)
    return _record_view(records.read_articles(spark, path))


def scalar_json_roundtrip(spark, sf_dir) -> DataFrame:
    """Single values as JSON scalars, whole numbers as numbers."""
    path = scratch_path(spark, "json")
    records.write_scalar_articles(article_rows(spark, sf_dir), path)
    return _record_view(records.read_articles(spark, path))


def scalar_json(spark, sf_dir) -> DataFrame:
    rows = documents(spark, sf_dir).select(
        "doc_id",
        F.array("source").alias("disciplines"),
        F.array(F.col("n_chars").cast("string")).alias("coll_date"),
        F.array("lang", "source").alias("keywordList"),
        F.array().cast("array<string>").alias("references"),
    )
    lists = rows.drop("doc_id")
    return rows.select("doc_id", records.article_json(lists).alias("record"))


# Relational.


def dedup_by_key(spark, sf_dir) -> DataFrame:
    keyed = documents(spark, sf_dir).select(F.md5("text").alias("doi"), "doc_id", "lang", "source")
    return relational.dedup(keyed, ["doi"], ["doc_id"])


def hash_sample(spark, sf_dir) -> DataFrame:
    keyed = documents(spark, sf_dir).select(F.md5("text").alias("doi"), "doc_id")
    return relational.sample(keyed, 0.1, "doi").select("doc_id")


def project_text(spark, sf_dir) -> DataFrame:
    selector = stages.ColumnSelector(outputCols=["doi", "abstract", "fulltext"])
    return selector.transform(article_rows(spark, sf_dir))


def explode_tokens(spark, sf_dir) -> DataFrame:
    exploder = stages.ColumnExploder(inputCol="words", outputCol="word")
    exploded = exploder.transform(lists_and_distinct(tokens(spark, sf_dir), "doc_id", "words"))
    # Only documents of several rows are told apart by word.
    alone = F.count_if(F.col("distinct") & F.col("again").isNull())
    return exploded.groupBy("word").agg(
        F.count_if(~F.col("distinct")).alias("n"), (alone + F.countDistinct("again")).alias("n_docs")
    )


# Text.


def concat_columns(spark, sf_dir) -> DataFrame:
    concat = stages.StringConcatenator(inputCols=["abstract", "fulltext"], outputCol="texts")
    return concat.transform(article_rows(spark, sf_dir)).select("doi", "texts")


def list_concat(spark, sf_dir) -> DataFrame:
    lists = documents(spark, sf_dir).select(
        "doc_id", text.sentences("text").alias("a"), text.regex_tokens("source").alias("b"), F.array("lang").alias("c")
    )
    both = stages.StringListAssembler(inputCols=["a", "b", "c"], outputCol="all").transform(lists)
    return both.select("doc_id", F.size("all").cast("long").alias("n"), text_list("all"))


def regex_tokens(spark, sf_dir) -> DataFrame:
    return tokens(spark, sf_dir).select("doc_id", F.size("words").cast("long").alias("n"), text_list("words"))


def sentence_split(spark, sf_dir) -> DataFrame:
    split = stages.SentTokenizer(inputCol="text", outputCol="sentences").transform(documents(spark, sf_dir))
    return split.select("doc_id", F.size("sentences").cast("long").alias("n"), text_list("sentences"))


def lexicon_nouns(spark, sf_dir) -> DataFrame:
    words = table(spark, sf_dir, "benchmark").select(F.explode(text.regex_tokens("text")).alias("word")).distinct()
    tag = F.when(F.length("word") % 2 == 0, "NN").otherwise("VB")
    nouns = lexicon.lexicon_nouns(tokens(spark, sf_dir), "doc_id", "words", words.withColumn("tag", tag))
    return nouns.select("doc_id", F.size("nouns").cast("long").alias("n"), text_list("nouns"))


# Training.


def vocabulary_min_count(spark, sf_dir) -> DataFrame:
    return vocabulary(tokens(spark, sf_dir))


def word2vec_train(spark, sf_dir) -> DataFrame:
    """Train on the deduplicated articles; which words have a vector of which make."""
    texts = training.corpus(article_rows(spark, sf_dir))
    _, trained = training.train_word2vec(texts)
    finite = F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    return trained.select(
        "word", "idx", "count", F.size("vector").cast("long").alias("dims"), (finite & (F.col("norm") > 0)).alias("ok")
    )


def sharded_vectors(spark, sf_dir) -> DataFrame:
    """Train on all documents, in blocks of words; which words have a vector of which make."""
    settings = skipgram.SkipGram(vector_size=50, window=3, epochs=1, passes=1)
    trained = skipgram.train_skipgram(tokens(spark, sf_dir), settings=settings)
    finite = F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    return trained.select(
        "word", "idx", "count", F.size("vector").cast("long").alias("dims"), (finite & (F.col("norm") > 0)).alias("ok")
    )


def vector_export(spark, sf_dir) -> DataFrame:
    """Written as a training job does, read back, with position and length."""
    source = word_vectors(spark, sf_dir)
    exported = vectors.export_vectors(source, source.select("word", "count"))
    path = vectors.write_vectors(exported, scratch_path(spark, "vectors"))
    return vectors.read_vectors(spark, path).select(
        "word", "idx", "count", (F.round("norm", 6) + F.lit(0.0)).alias("norm")
    )


def document_vectors(spark, sf_dir) -> DataFrame:
    known = settle(word_vectors(spark, sf_dir), "vectors")
    embedded = embedding.embed_documents(tokens(spark, sf_dir), known, "doc_id")
    value = F.col("value")
    return embedded.select("doc_id", F.posexplode("vector").alias("dim", "value")).select(
        "doc_id", F.col("dim").cast("long").alias("dim"), (F.round(value, 6) + F.lit(0.0)).alias("value")
    )


# Vector queries.


def rounded(column: str) -> Column:
    return (F.round(column, 6) + F.lit(0.0)).alias(column)


def cosine_pairs(spark, sf_dir) -> DataFrame:
    """Each vector with the next."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    following = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("following"))
    both = rows.join(following, "vec_id").withColumn("sim", cosine(F.col("embedding"), F.col("following")))
    return both.select("vec_id", rounded("sim"))


def cosine_topk(spark, sf_dir) -> DataFrame:
    rows = id_vectors(spark, sf_dir)
    queries = rows.select(F.col("word").alias("key"), F.col("word").alias("term"), "vector")
    return similarity.top_k(queries, rows).select("key", "rank", "word", rounded("sim"))


def nearest_terms(spark, sf_dir) -> DataFrame:
    rows = id_vectors(spark, sf_dir)
    queries = rows.select(F.col("word").alias("key"), F.col("word").alias("term"))
    return similarity.nearest_terms(queries, rows).select("key", "rank", "word", rounded("sim"))


def nearest_words(spark, sf_dir) -> DataFrame:
    """Every word of the documents; many words share a vector, so ties are common."""
    rows = fill_cores(settle(word_vectors(spark, sf_dir), "vectors"))
    queries = rows.select(F.col("word").alias("key"), F.col("word").alias("term"))
    return similarity.nearest_terms(queries, rows).select("key", "rank", "word", rounded("sim"))


def signed_sum(spark, sf_dir) -> DataFrame:
    summed = similarity.signed_sum(three_term_queries(spark, sf_dir), id_vectors(spark, sf_dir))
    return summed.select("key", F.posexplode("vector").alias("dim", "value")).select(
        "key", F.col("dim").cast("long").alias("dim"), rounded("value")
    )


def term_arithmetic(spark, sf_dir) -> DataFrame:
    found = similarity.term_arithmetic(three_term_queries(spark, sf_dir), id_vectors(spark, sf_dir))
    return found.select("key", "rank", "word", rounded("sim"))


# Messages.


def parse_expression(spark, sf_dir) -> DataFrame:
    parsed = event_mentions(spark, sf_dir).select("id", F.explode(X.parse_expression(F.col("text"))).alias("t"))
    return parsed.select(
        "id", F.col("t.pos").cast("long").alias("pos"), "t.term", F.col("t.sign").cast("long").alias("sign")
    )


def oov_terms(spark, sf_dir) -> DataFrame:
    queries = event_mentions(spark, sf_dir).select(
        F.col("id").cast("string").alias("key"), X.parse_expression(F.col("text")).alias("terms")
    )
    return answers.oov_terms(queries, id_vectors(spark, sf_dir)).select("key", text_list("oov"))


def direct_mentions(spark, sf_dir) -> DataFrame:
    return answers.direct_mentions(event_mentions(spark, sf_dir), BOT).select("id", "author", "text")


def mention_prefix(spark, sf_dir) -> DataFrame:
    prefix = X.mention_prefix(F.col("author"), F.col("text"), BOT)
    return event_mentions(spark, sf_dir).select("id", prefix.alias("prefix"))


def permalink(spark, sf_dir) -> DataFrame:
    url = X.permalink(F.col("author"), F.col("id"), answers.LINK_BASE)
    return event_mentions(spark, sf_dir).select("id", url.alias("url"))


def route_replies(spark, sf_dir) -> DataFrame:
    replies = answers.reply_to(event_mentions(spark, sf_dir), id_vectors(spark, sf_dir), BOT)
    return replies.select("in_reply_to", "author", "kind", "reply", "url")


def mention_stream(spark, sf_dir) -> DataFrame:
    """The events as a stream; its replies, as the table stands at the end."""
    events = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events*.parquet")
    replies, checkpoint = scratch_path(spark, "replies"), scratch_path(spark, "progress")
    mention_stream_job.answer_stream(
        mentions(stream), id_vectors(spark, sf_dir), BOT, replies, checkpoint, trigger={"availableNow": True}
    ).awaitTermination()
    table_now = mention_stream_job.read_replies(spark, replies)
    return table_now.select("in_reply_to", "author", "kind", "reply", "url")


# Inputs that go wrong easily.


def dedup_null_keys(spark, sf_dir) -> DataFrame:
    """As dedup_by_key, but documents in French have no key, and all of them stay."""
    doi = F.when(F.col("lang") != "fr", F.md5("text"))
    keyed = documents(spark, sf_dir).select(doi.alias("doi"), "doc_id", "source")
    return relational.dedup(keyed, ["doi"], ["source", "doc_id"])


def corpus_rows(spark, sf_dir) -> DataFrame:
    """The training corpus of articles of one file, some without doi, some without one of their texts."""
    lines, kind = lines_of("text"), F.substring(F.md5("text"), 1, 1)
    rows = documents(spark, sf_dir).select(
        F.when(~kind.isin("0", "1", "2", "3"), F.md5("text")).alias("doi"),
        F.when(~kind.isin("2", "4"), lines[0]).alias("abstract"),
        F.when(~kind.isin("3", "5"), F.array_join(after_first(lines), " ")).alias("fulltext"),
        F.lit("one file").alias("source_file"),
    )
    return training.corpus(rows)


def scalar_json_marks(spark, sf_dir) -> DataFrame:
    """Single values that begin like JSON, written as scalars and read back."""
    mark = F.get(F.array(*map(F.lit, ["[", "{", '"', "[1] "])), (F.col("doc_id") % 4).cast("int"))
    value = F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.concat(mark, "source"))
    rows = article_rows(spark, sf_dir).withColumn("doc_id", F.substr("doi", F.lit(6)).cast("long"))
    path = scratch_path(spark, "json")
    marked = rows.join(documents(spark, sf_dir).select("doc_id", "source"), "doc_id")
    records.write_scalar_articles(marked.select("doi", F.array(value).alias("disciplines"), value.alias("abstract")), path)
    return records.read_articles(spark, path).select("doi", text_list("disciplines"), "abstract")


def cancelled_sums(spark, sf_dir) -> DataFrame:
    """Sums of terms that cancel out, wholly or but for one."""
    vec = F.col("vec_id")
    a, b, c = (F.concat(F.lit(" "), (vec + i).cast("string"), F.lit(" ")) for i in range(3))
    plus, minus = F.lit("+"), F.lit("-")
    expression = (
        F.when(vec % 3 == 0, F.concat(a, plus, b, plus, c, minus, a, minus, b, minus, c))
        .when(vec % 3 == 1, F.concat(a, plus, b, minus, b))
        .otherwise(F.concat(a, minus, a))
    )
    queries = table(spark, sf_dir, "embeddings").select(
        vec.cast("string").alias("key"), X.parse_expression(F.trim(expression)).alias("terms")
    )
    summed = similarity.signed_sum(queries, id_vectors(spark, sf_dir))
    return summed.select("key", F.posexplode("vector").alias("dim", "value")).select(
        "key", F.col("dim").cast("long").alias("dim"), "value"
    )


def zero_queries(spark, sf_dir) -> DataFrame:
    """Nearest words of a - a: every word ties, so the order of the words decides."""
    vec = F.col("vec_id").cast("string")
    queries = table(spark, sf_dir, "embeddings").select(
        vec.alias("key"), X.parse_expression(F.concat(vec, F.lit(" - "), vec)).alias("terms")
    )
    return similarity.term_arithmetic(queries, id_vectors(spark, sf_dir)).select("key", "rank", "word", rounded("sim"))


def mention_lots(spark, sf_dir) -> DataFrame:
    """The events in three lots: repeated ids, a lot of days before, a lot without times; then once more."""
    given = mentions(table(spark, sf_dir, "events")).withColumn("lot", F.col("id") % 3)
    ts = F.when(F.col("lot") == 1, F.col("ts") - F.expr("INTERVAL 3 DAYS")).when(F.col("lot") == 0, F.col("ts"))
    given = given.withColumn("ts", ts)
    folder, replies, checkpoint = (scratch_path(spark, x) for x in ("lots", "replies", "progress"))
    for lots in ([0], [0, 1], [1, 2]):
        given.filter(F.col("lot").isin(lots)).drop("lot").write.mode("append").parquet(folder)
        # The second run finds nothing new.
        for _ in range(2):
            stream = spark.readStream.schema(given.drop("lot").schema).parquet(folder)
            mention_stream_job.answer_stream(
                stream, id_vectors(spark, sf_dir), BOT, replies, checkpoint, trigger={"availableNow": True}
            ).awaitTermination()
    found = mention_stream_job.read_replies(spark, replies)
    return found.select("in_reply_to", "author", "kind", "reply", "url")


def mention_replay(spark, sf_dir) -> DataFrame:
    """Every event as a mention five times: in one lot with two times and without one, then another day, then again without.

    The earliest of the first lot is answered, and the others never.
    """
    given = mentions(table(spark, sf_dir, "events"))
    later, none = F.col("ts") + F.expr("INTERVAL 2 MINUTES"), F.lit(None).cast("timestamp")
    elsewhere = F.concat(F.col("text"), F.lit(" + 1"))
    first = [given, given.withColumns({"ts": later, "text": elsewhere}), given.withColumns({"ts": none, "text": elsewhere})]
    lots = [
        first[1].unionByName(first[2]).unionByName(first[0]),
        given.withColumns({"ts": F.col("ts") + F.expr("INTERVAL 40 DAYS"), "text": elsewhere}),
        given.withColumns({"ts": none, "text": elsewhere}),
    ]
    vectors, replies = id_vectors(spark, sf_dir), scratch_path(spark, "replies")
    for lot in lots:
        # Small lots of files, so that ids move to the index between the lots.
        mention_stream_job.append_replies(lot, vectors, BOT, replies, lot_files=1)
    found = mention_stream_job.read_replies(spark, replies)
    return found.select("in_reply_to", "author", "kind", "reply", "url")


QUERIES = {
    query.__name__: query
    for query in (
        xml_collection,
        quarantine,
        incremental_conversion,
        damaged_collection,
        archive_members,
        page_article_block,
        page_metadata,
        page_paragraphs,
        pending_items,
        json_roundtrip,
        scalar_json_roundtrip,
        scalar_json,
        dedup_by_key,
        hash_sample,
        project_text,
        explode_tokens,
        concat_columns,
        list_concat,
        regex_tokens,
        sentence_split,
        lexicon_nouns,
        vocabulary_min_count,
        word2vec_train,
        sharded_vectors,
        vector_export,
        document_vectors,
        cosine_pairs,
        cosine_topk,
        nearest_terms,
        nearest_words,
        signed_sum,
        term_arithmetic,
        parse_expression,
        oov_terms,
        direct_mentions,
        mention_prefix,
        permalink,
        route_replies,
        mention_stream,
        dedup_null_keys,
        corpus_rows,
        scalar_json_marks,
        cancelled_sums,
        zero_queries,
        mention_lots,
        mention_replay,
    )
}
