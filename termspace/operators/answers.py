"""From messages to replies: vocabulary check, routing, reply text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termspace.functions import expressions as X
from termspace.operators.similarity import answer_queries, asked_terms, term_rows
from termspace.operators.skew import hot_keys, lookup_join
from termspace.session import settle

LINK_BASE = "http://twitter.com/"


def direct_mentions(mentions: DataFrame, name: str) -> DataFrame:
    """Messages that begin with the handle."""
    return mentions.filter(X.is_direct(F.col("text"), name))


def oov_terms(queries: DataFrame, vocabulary: DataFrame, asked: DataFrame | None = None, **balance) -> DataFrame:
    """(key, oov): sorted distinct terms without a vocabulary entry; only queries that have some.

    ``queries``: (key, terms). Each distinct term is looked up once; ``asked`` is
    the table of such a lookup, if there is one already (see ``asked_terms``).
    """
    terms = queries.select("key", F.explode(F.array_distinct(F.transform("terms", lambda t: t["term"]))).alias("term"))
    if asked is None:
        words = vocabulary.select(F.col("word").alias("term"))
        unknown = terms.groupBy("term").count().join(words, "term", "left_anti")
    else:
        unknown = asked.filter(F.col("vector").isNull())
    balance.setdefault("hot", hot_keys(unknown, "term"))
    return (
        lookup_join(terms, unknown.select("term"), "term", spread=["key"], **balance)
        .groupBy("key")
        .agg(F.sort_array(F.collect_set("term")).alias("oov"))
    )


def reply_to(
    mentions: DataFrame,
    vectors: DataFrame,
    name: str,
    link_base: str = LINK_BASE,
    work: str | None = None,
    known=None,
    **sizes,
) -> DataFrame:
    """(in_reply_to, ts, author, kind, reply, url): one reply per direct message.

    Each distinct expression is answered once, however many messages carry it:
    expressions are counted and written down first (below ``work``), and the
    messages are joined to the answers with hot expressions split up. ``known``
    (see ``streaming.answered.AnsweredExpressions``) holds answers by the same
    vectors for all batches of a stream.
    """
    text = F.col("text")
    parsed = direct_mentions(mentions, name).select(
        "id",
        "ts",
        "author",
        X.mention_prefix(F.col("author"), text, name).alias("prefix"),
        X.expression_text(text).alias("asked"),
        X.expression_key(text).alias("key"),
    )
    terms = X.terms_of_key(F.col("key")).alias("terms")
    queries = settle(parsed.groupBy("key").count().select("*", terms), "expressions", work)
    answered = lambda asked: answer_expressions(asked, vectors, work, **sizes)
    answers = settle(answered(queries), "answers", work) if known is None else known.answer(queries, answered, work)
    # Every key has an answer; a left join spares a test for null keys before it.
    replies = lookup_join(parsed, answers, "key", spread=["id"], how="left", hot=hot_keys(queries, "key"))
    return route(replies).select(
        F.col("id").alias("in_reply_to"),
        "ts",
        "author",
        "kind",
        "reply",
        X.permalink(F.col("author"), F.col("id"), link_base).alias("url"),
    )


def answer_expressions(queries: DataFrame, vectors: DataFrame, work: str | None = None, **sizes) -> DataFrame:
    """(key, terms, oov, words) of distinct expressions (key, terms)."""
    queries = queries.select("key", "terms")
    asked = asked_terms(term_rows(queries), vectors, work)
    oov = oov_terms(queries, vectors, asked)
    answers = answer_queries(queries, vectors, asked=asked, work=work, **sizes)
    return queries.join(oov, "key", "left").join(answers, "key", "left")


def route(df: DataFrame) -> DataFrame:
    """Add kind and reply, from prefix, asked, terms, oov and words."""
    prefix, words = F.col("prefix"), F.coalesce("words", F.array().cast("array<string>"))
    unknown, single = F.size("oov") > 0, F.size("terms") == 1
    kind = F.when(unknown, "unknown").when(single, "related").otherwise("equation")
    reply = (
        F.when(unknown, X.apology(prefix, F.col("oov")))
        .when(single, X.related_reply(prefix, F.col("terms")[0]["term"], words))
        .otherwise(X.equation_reply(prefix, F.col("asked"), words))
    )
    return df.withColumn("kind", kind).withColumn("reply", reply)
