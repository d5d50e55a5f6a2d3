"""One query per operator, and its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termspace.llm import decontaminate, divergence, exact_dedup, html_extract, interpolation_lm, language, mixing, quality, simhash, token_output, toxicity, url_filter, whitening
from termspace.llm.common import lowered, remainder, table
from termspace.session import scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2

# Fixed by the query: (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays for it; the digest is of the normalised text."""
    digest = {"text_sha256": F.sha2(lowered("_text"), 256)}
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), carry=digest)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url by the lists that the query fixes."""
    rules = spark.createDataFrame(URL_RULES, url_filter.RULES)
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's chance under the language model; a fifth of the documents is not learned from."""
    part = remainder("doc_id", 5)
    documents = table(spark, sf_dir, "documents")
    scored, model = interpolation_lm.score(documents, train=part != 1, held=part == 0)
    return scored.select(
        "doc_id",
        (part == 1).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page; weights from the pages that mark theirs."""
    pages = table(spark, sf_dir, "pages")
    found = html_extract.extract(pages, html_extract.fit_weights(pages), ["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    counts = mixing.mix_counts(table(spark, sf_dir, "documents"))
    each = counts.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), "_rows")))
    return each.select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
    )


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum in the token files, read back from them."""
    folder = scratch_path(spark, "tokens")
    token_output.write_tokens(table(spark, sf_dir, "documents"), folder, TOKENIZER, END_ID)
    return token_output.read_documents(spark, folder)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the component of near duplicates it is in."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality; labels of a fifth of the documents are kept back."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit_quality(documents, labels.filter(remainder("doc_id", 5) != 0))
    scored = documents.select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        quality.quality_score(model, documents, "text").alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; a quarter of the documents is kept back from learning."""
    documents = table(spark, sf_dir, "documents")
    model = language.fit_languages(documents.filter(remainder("doc_id", 4) != 2))
    found = language.language_of(model, documents)
    return documents.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), found.alias("found")).select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words that lie in a benchmark passage."""
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(documents, benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity; labels of a fifth of the documents are kept back."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(documents, labels.filter(remainder("doc_id", 5) != 0))
    scored = documents.select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        toxicity.toxicity_score(model, documents, "text").alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source of every language against the others and against the language."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the leading components of the covariance, scaled to unit variance."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {query.__name__: query for query in (op1_exact_dedup, op2_url_filter, op3_lm_score, op4_html_extract, op5_mixing, op6_token_output, op7_simhash, op8_quality, op9_language, op10_decontaminate, op11_toxicity, op12_source_divergence, op13_whitening)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NO_TERM = r"'[\x00-\x40\x5B-\x60\x7B-\x7F]+'"
_NO_WORD = r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

SQL = {
    "op1_exact_dedup": f"""
      SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
             doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
      FROM (SELECT doc_id, {_LOWER} AS norm FROM documents)
      WINDOW same AS (PARTITION BY norm)
    """,
    "op2_url_filter": r"""
      WITH parts AS (
        SELECT page_id,
               translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
        FROM pages
      ), rules(h, p, v) AS (
        VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
               ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
      ), judged AS (
        SELECT page_id, host, path, h || p AS rule, v,
               row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST) AS place
        FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
      )
      SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM judged WHERE place = 1
    """,
    "op10_decontaminate": rf"""
      WITH doc_words AS (
        SELECT doc_id, list_filter(string_split_regex({_LOWER}, {_NO_WORD}), lambda x: length(x) > 0) AS w FROM documents
      ), item_words AS (
        SELECT item_id, list_filter(string_split_regex({_LOWER}, {_NO_WORD}), lambda x: length(x) > 0) AS w
        FROM benchmark
      ), windows AS (
        SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS passage
        FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
              FROM (SELECT *, least(10, len(w)) AS k FROM item_words WHERE len(w) > 0))
      ), places AS (
        SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS passage
        FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
              FROM doc_words, (SELECT DISTINCT k FROM windows))
      ), found AS (
        SELECT doc_id, item_id, k, i FROM places JOIN windows USING (k, passage)
      ), hits AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found)
        GROUP BY doc_id
      ), items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
      )
      SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
             sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
      FROM doc_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op12_source_divergence": rf"""
      WITH d AS (
        SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
               list_filter(string_split_regex({_LOWER}, {_NO_TERM}), lambda x: length(x) > 0) AS w
        FROM documents
      ), t AS (
        SELECT lang, source, r, unnest(w) AS term FROM d
      ), kept AS (
        SELECT lang, term FROM (SELECT DISTINCT lang, r, term FROM t) GROUP BY lang, term HAVING count(*) >= 30
      ), sizes AS (
        SELECT lang, count(*) AS v FROM kept GROUP BY lang
      ), groups AS (
        SELECT DISTINCT lang, source FROM d
      ), counts AS (
        SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term
      ), totals AS (
        SELECT lang, source, coalesce(sum(n), 0) AS total
        FROM groups LEFT JOIN counts USING (lang, source) GROUP BY lang, source
      ), p AS (
        SELECT lang, source, term, coalesce(n, 0) AS n,
               1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v)::HUGEINT AS p
        FROM totals JOIN kept USING (lang) JOIN sizes USING (lang) LEFT JOIN counts USING (lang, source, term)
      ), q AS (
        SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)) // (any_value(whole) + 5 * any_value(v))::HUGEINT AS q
        FROM counts JOIN (SELECT lang, sum(total) AS whole FROM totals GROUP BY lang) USING (lang)
        JOIN sizes USING (lang) GROUP BY lang, term
      ), apart AS (
        SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY a.lang, a.source, b.source
      ), found AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
      ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM found
      )
      SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
      FROM ranked WHERE part = 'pair' OR place <= 50
    """,
}
