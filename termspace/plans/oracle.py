"""The catalog's queries as SQL over the same tables, for checking results.

Written on its own: nothing here is shared with the Spark side but the facts.
"""

ARTICLES = """
  SELECT doc_id, '10.1/' || doc_id AS doi, CAST(n_chars AS VARCHAR) AS coll_date, source, lang,
         string_split(text, chr(10))[1] AS abstract,
         coalesce(array_to_string(string_split(text, chr(10))[2:], ' '), '') AS fulltext
  FROM documents
"""

TOKENS = r"""
  SELECT doc_id, list_filter(string_split_regex(lower(text), '\W'), lambda x: length(x) > 0) AS words
  FROM documents
"""

VOCABULARY = """
  SELECT word, count(*) AS count FROM (SELECT unnest(words) AS word FROM tokens) GROUP BY word HAVING count(*) >= 20
"""

WORD_VECTORS = """
  SELECT word, idx, count, CAST(embedding AS DOUBLE[]) AS v
  FROM (SELECT word, count, row_number() OVER (ORDER BY count DESC, word) - 1 AS idx FROM vocabulary)
  JOIN embeddings ON vec_id = idx % (SELECT count(*) FROM embeddings)
"""

ID_VECTORS = """
  SELECT CAST(vec_id AS VARCHAR) AS word, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
"""

# Queries made of three ids, where all three exist.
SUMS = """
  SELECT a.word AS key, [a.word, b.word, c.word] AS terms,
         list_transform(list_zip(a.v, b.v, c.v), lambda z: z[1] - z[2] + z[3]) AS v
  FROM ids a
  JOIN ids b ON CAST(b.word AS BIGINT) = CAST(a.word AS BIGINT) + 1
  JOIN ids c ON CAST(c.word AS BIGINT) = CAST(a.word AS BIGINT) + 2
"""

# Ranks 2 to 10 by cosine of queries q (key, term, v) over words w (word, v).
RANKED = """
  SELECT key, word, sim, rank FROM (
    SELECT key, word, sim,
           row_number() OVER (PARTITION BY key ORDER BY sim DESC, coalesce(word <> term, true), word) AS rank
    FROM (
      SELECT q.key, q.term, w.word,
             coalesce(list_dot_product(q.v, w.v) / nullif(q.norm * w.norm, 0), 0) AS sim
      FROM (SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM q) q,
           (SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM w) w
    )
  ) WHERE rank BETWEEN 2 AND 10
"""

MENTIONS = """
  SELECT event_id AS id, 'u' || user_id AS author,
         CASE event_type
           WHEN 'view' THEN '@bot ' || user_id
           WHEN 'click' THEN '@bot ' || user_id || ' - ' || (user_id + 1) || ' + ' || (user_id + 2)
           WHEN 'purchase' THEN '@bot ' || user_id || ' + ZZ' || user_id
           WHEN 'signup' THEN 'hi @bot ' || user_id
           ELSE '@bot ' || user_id || ' + ' || (user_id + 3) || ' @u' || (user_id + 1)
         END AS text
  FROM events
"""

PARSED = r"""
  SELECT id, author, text, asked, replace(replace(lower(asked), '-', '+-'), ' ', '') AS key,
         array_to_string(list_concat(['@' || author], list_filter(string_split_regex(text, '[^@\p{L}\p{N}_]'),
           lambda h: length(h) > 2 AND h[1] = '@' AND h[2:] <> 'bot')), ' ') AS prefix,
         string_split_regex(text, '[^@\p{L}\p{N}_]')[1] = '@bot' AS direct
  FROM (SELECT *, array_to_string(list_filter(string_split_regex(text, '\s+'),
                    lambda x: x <> '' AND NOT contains(x, '@')), ' ') AS asked
        FROM mentions)
"""

TERMS = """
  SELECT id, pos - 1 AS pos, replace(pieces[pos], '-', '') AS term,
         CASE WHEN contains(pieces[pos], '-') THEN -1 ELSE 1 END AS sign
  FROM (SELECT id, pieces, unnest(range(1, len(pieces) + 1)) AS pos
        FROM (SELECT id, string_split(key, '+') AS pieces FROM parsed))
"""


def _with(final: str, **parts: str) -> str:
    steps = ",\n".join(f"{name} AS ({body})" for name, body in parts.items())
    return f"WITH {steps}\n{final}"


_JOINED = """
  SELECT doi, coll_date, '' AS disciplines, source AS meta_journal, lang || ' | ' || source AS "keywordList",
         abstract, fulltext, source AS source_file
  FROM articles
"""

_NEAREST = """
  SELECT key, row_number() OVER (PARTITION BY key ORDER BY rank) AS rank, word, round(sim, 6) + 0.0 AS sim
  FROM ranked WHERE NOT starts_with(word, key) AND NOT starts_with(key, word)
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY rank) <= 5
"""

# Expressions of the messages with their terms, unknown terms, and vector sums.
_REPLY_PARTS = {
    "mentions": MENTIONS,
    "ids": ID_VECTORS,
    "parsed": PARSED,
    "expressions": """
      SELECT key, pos, replace(piece, '-', '') AS term, CASE WHEN contains(piece, '-') THEN -1 ELSE 1 END AS sign
      FROM (SELECT key, unnest(string_split(key, '+')) AS piece,
                   unnest(range(len(string_split(key, '+')))) AS pos
            FROM (SELECT DISTINCT key FROM parsed WHERE direct))
    """,
    "looked_up": "SELECT e.*, ids.v FROM expressions e LEFT JOIN ids ON ids.word = e.term",
    "oov": """
      SELECT key, list_sort(list(DISTINCT term) FILTER (v IS NULL)) AS oov,
             list(term ORDER BY pos) AS terms
      FROM looked_up GROUP BY key
    """,
    "dims": """
      SELECT key, dim, sum(sign * x) AS x
      FROM (SELECT key, sign, unnest(v) AS x, unnest(range(len(v))) AS dim FROM looked_up)
      GROUP BY key, dim
    """,
    "q": """
      SELECT oov.key, CASE WHEN len(terms) = 1 THEN terms[1] END AS term, s.v
      FROM oov JOIN (SELECT key, list(x ORDER BY dim) AS v FROM dims GROUP BY key) s USING (key)
      WHERE oov.oov IS NULL
    """,
    "w": "SELECT * FROM ids",
    "ranked": RANKED,
    "answers": """
      SELECT key, list(word ORDER BY rank) AS words FROM (
        SELECT r.key, r.word, r.rank FROM ranked r JOIN oov USING (key)
        WHERE CASE WHEN len(terms) = 1
                THEN NOT starts_with(word, terms[1]) AND NOT starts_with(terms[1], word)
                ELSE len(list_filter(terms, lambda t: starts_with(word, t))) = 0 END
        QUALIFY row_number() OVER (PARTITION BY r.key ORDER BY r.rank) <= 5
      ) GROUP BY key
    """,
}

_REPLIES = _with(
    """
    SELECT id AS in_reply_to, author,
           CASE WHEN oov IS NOT NULL THEN 'unknown' WHEN len(terms) = 1 THEN 'related' ELSE 'equation' END AS kind,
           CASE WHEN oov IS NOT NULL
                  THEN prefix || ' Sorry, ' || array_to_string(oov, ', ') || ' not in my vocabulary.'
                WHEN len(terms) = 1
                  THEN prefix || ' Related terms to ' || terms[1] || ': ' || coalesce(array_to_string(words, ', '), '')
                ELSE prefix || ' ' || asked || ' = ' || coalesce(array_to_string(words, ', '), '') END AS reply,
           'http://twitter.com/' || author || '/status/' || id AS url
    FROM parsed JOIN oov USING (key) LEFT JOIN answers USING (key)
    WHERE direct
    """,
    **_REPLY_PARTS,
)

SQL = {
    "xml_collection": _with(
        """
        SELECT doi, coll_date, '' AS disciplines, source AS meta_journal, '' AS "references",
               lang || ' | ' || source AS "keywordList", abstract, fulltext
        FROM articles
        """,
        articles=ARTICLES,
    ),
    "quarantine": """
        SELECT doc_id, CASE WHEN lang = 'de' THEN 'quarantine' ELSE 'article' END AS status FROM documents
    """,
    "damaged_collection": """
        WITH d AS (
          SELECT doc_id, doc_id // 64 AS file, row_number() OVER (PARTITION BY doc_id // 64 ORDER BY doc_id) - 1 AS place,
                 count(*) OVER (PARTITION BY doc_id // 64) AS n
          FROM documents
        ), f AS (
          SELECT *, CASE WHEN n <= 40 OR file % 4 = 0 THEN n WHEN file % 4 = 2 THEN 41 ELSE 40 END AS whole FROM d
        ), found AS (
          SELECT file, '10.1/' || doc_id AS doi, 'article' AS status FROM f WHERE place < whole
          UNION ALL
          SELECT DISTINCT file, NULL, 'broken' FROM f WHERE n > 40 AND file % 4 <> 0
        )
        SELECT job, found.* FROM found, (VALUES ('batch'), ('stream')) jobs(job)
    """,
    "archive_members": _with(
        """
        SELECT file, doc_id // 10 || '/' || doc_id || '.xml' AS member, doi, fulltext, 'article' AS status
        FROM f WHERE place < whole
        UNION ALL
        SELECT DISTINCT file, '', NULL, NULL, 'broken' FROM f WHERE n > 40 AND file % 4 <> 0
        """,
        articles=ARTICLES,
        d="""
          SELECT *, doc_id // 64 AS file, row_number() OVER (PARTITION BY doc_id // 64 ORDER BY doc_id) - 1 AS place,
                 count(*) OVER (PARTITION BY doc_id // 64) AS n
          FROM articles
        """,
        f="SELECT *, CASE WHEN n <= 40 OR file % 4 = 0 THEN n WHEN file % 4 = 2 THEN 41 ELSE 40 END AS whole FROM d",
    ),
    "incremental_conversion": _with(
        "SELECT doi, CASE WHEN lang = 'es' THEN '' ELSE fulltext END AS fulltext FROM articles", articles=ARTICLES
    ),
    "page_article_block": "SELECT page_id, substr(html, strpos(html, '<article')) AS block FROM pages",
    "page_metadata": r"""
        SELECT page_id,
               array_to_string(regexp_extract_all(html, '<html[^>]*\slang="([^"]*)"', 1), ' | ') AS lang,
               array_to_string(regexp_extract_all(html, '<title>([^<]*)</title>', 1), ' | ') AS title,
               array_to_string(regexp_extract_all(html, '<h1>([^<]*)</h1>', 1), ' | ') AS h1,
               array_to_string(regexp_extract_all(html, '<a[^>]*\shref="([^"]*)"', 1), ' | ') AS links
        FROM pages
    """,
    "page_paragraphs": r"""
        SELECT page_id, coalesce(array_to_string(list_transform(
                 string_split(regexp_extract(html, '(?s)<article[\s>].*?</article>'), '<p>')[2:],
                 lambda p: regexp_replace(p, '<[^>]*>', '', 'g')), ' '), '') AS fulltext
        FROM pages
    """,
    "pending_items": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "json_roundtrip": _with(_JOINED, articles=ARTICLES),
    "scalar_json_roundtrip": _with(_JOINED, articles=ARTICLES),
    "scalar_json": """
        SELECT doc_id, '{"disciplines":"' || source || '","coll_date":' || n_chars || ',"keywordList":["' || lang
                       || '","' || source || '"],"references":[]}' AS record
        FROM documents
    """,
    "dedup_by_key": """
        SELECT md5(text) AS doi, doc_id, lang, source FROM documents
        QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1
    """,
    "hash_sample": """
        SELECT doc_id FROM documents
        WHERE CAST('0x' || substr(md5('42:' || md5(text)), 1, 8) AS BIGINT) < floor(0.1 * 4294967296)
    """,
    "project_text": _with("SELECT doi, abstract, fulltext FROM articles", articles=ARTICLES),
    "explode_tokens": _with(
        """
        SELECT word, count(*) AS n, count(DISTINCT doc_id) AS n_docs
        FROM (SELECT doc_id, unnest(words) AS word FROM tokens) GROUP BY word
        """,
        tokens=TOKENS,
    ),
    "concat_columns": _with("SELECT doi, abstract || fulltext AS texts FROM articles", articles=ARTICLES),
    "list_concat": r"""
        SELECT doc_id, len(al) AS n, array_to_string(al, ' | ') AS "all"
        FROM (SELECT doc_id, list_concat(list_concat(
                list_filter(string_split(regexp_replace(trim(text), '([.!?])[ \t\r\n\f]+', '\1' || chr(1), 'g'), chr(1)),
                            lambda s: length(s) > 0),
                list_filter(string_split_regex(lower(source), '\W'), lambda x: length(x) > 0)), [lang]) AS al
              FROM documents)
    """,
    "regex_tokens": _with(
        "SELECT doc_id, len(words) AS n, array_to_string(words, ' | ') AS words FROM tokens", tokens=TOKENS
    ),
    "sentence_split": r"""
        SELECT doc_id, len(s) AS n, array_to_string(s, ' | ') AS sentences
        FROM (SELECT doc_id, list_filter(string_split(
                regexp_replace(trim(text), '([.!?])[ \t\r\n\f]+', '\1' || chr(1), 'g'), chr(1)),
                lambda s: length(s) > 0) AS s
              FROM documents)
    """,
    "lexicon_nouns": _with(
        """
        SELECT doc_id, count(lexicon.word) AS n,
               coalesce(string_agg(lexicon.word, ' | ' ORDER BY pos), '') AS nouns
        FROM positions LEFT JOIN lexicon USING (word)
        GROUP BY doc_id
        """,
        tokens=TOKENS,
        lexicon=r"""
          SELECT DISTINCT word FROM (SELECT unnest(string_split_regex(lower(text), '\W')) AS word FROM benchmark)
          WHERE length(word) > 0 AND length(word) % 2 = 0
        """,
        positions="""
          SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM tokens WHERE len(words) > 0
          UNION ALL SELECT doc_id, NULL, 0 FROM tokens WHERE len(words) = 0
        """,
    ),
    "vocabulary_min_count": _with("SELECT word, count FROM vocabulary", tokens=TOKENS, vocabulary=VOCABULARY),
    "word2vec_train": _with(
        """
        SELECT word, row_number() OVER (ORDER BY count DESC, word) - 1 AS idx, count,
               CAST(500 AS BIGINT) AS dims, true AS ok
        FROM vocabulary
        """,
        articles=ARTICLES,
        tokens=r"""
          SELECT list_filter(string_split_regex(lower(abstract || fulltext), '\W'), lambda x: length(x) > 0) AS words
          FROM articles
        """,
        vocabulary=VOCABULARY,
    ),
    "sharded_vectors": _with(
        """
        SELECT word, row_number() OVER (ORDER BY count DESC, word) - 1 AS idx, count,
               CAST(50 AS BIGINT) AS dims, true AS ok
        FROM vocabulary
        """,
        tokens=TOKENS,
        vocabulary=VOCABULARY,
    ),
    "vector_export": _with(
        "SELECT word, idx, count, round(sqrt(list_dot_product(v, v)), 6) + 0.0 AS norm FROM word_vectors",
        tokens=TOKENS,
        vocabulary=VOCABULARY,
        word_vectors=WORD_VECTORS,
    ),
    "document_vectors": _with(
        """
        SELECT t.doc_id, d.dim, round(coalesce(s.x, 0) / greatest(len(t.words), 1), 6) + 0.0 AS value
        FROM tokens t CROSS JOIN (SELECT unnest(range(64)) AS dim) d
        LEFT JOIN sums s ON s.doc_id = t.doc_id AND s.dim = d.dim
        """,
        tokens=TOKENS,
        vocabulary=VOCABULARY,
        word_vectors=WORD_VECTORS,
        counted="""
          SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(words) AS word FROM tokens)
          GROUP BY doc_id, word
        """,
        sums="""
          SELECT doc_id, dim, sum(n * x) AS x
          FROM (SELECT doc_id, n, unnest(v) AS x, unnest(range(64)) AS dim
                FROM counted JOIN word_vectors USING (word))
          GROUP BY doc_id, dim
        """,
    ),
    "cosine_pairs": """
        SELECT a.vec_id, round(list_dot_product(a.v, b.v)
                 / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))), 6) + 0.0 AS sim
        FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) a
        JOIN (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) b ON b.vec_id = a.vec_id + 1
    """,
    "cosine_topk": _with(
        "SELECT key, rank, word, round(sim, 6) + 0.0 AS sim FROM ranked",
        w=ID_VECTORS,
        q="SELECT word AS key, word AS term, v FROM w",
        ranked=RANKED,
    ),
    "nearest_terms": _with(
        _NEAREST, w=ID_VECTORS, q="SELECT word AS key, word AS term, v FROM w", ranked=RANKED
    ),
    "nearest_words": _with(
        _NEAREST,
        tokens=TOKENS,
        vocabulary=VOCABULARY,
        w=WORD_VECTORS,
        q="SELECT word AS key, word AS term, v FROM w",
        ranked=RANKED,
    ),
    "signed_sum": _with(
        """
        SELECT key, dim, round(x, 6) + 0.0 AS value
        FROM (SELECT key, unnest(v) AS x, unnest(range(len(v))) AS dim FROM sums)
        """,
        ids=ID_VECTORS,
        sums=SUMS,
    ),
    "term_arithmetic": _with(
        """
        SELECT key, row_number() OVER (PARTITION BY key ORDER BY ranked.rank) AS rank, word,
               round(sim, 6) + 0.0 AS sim
        FROM ranked JOIN sums USING (key)
        WHERE len(list_filter(terms, lambda t: starts_with(word, t))) = 0
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY ranked.rank) <= 5
        """,
        ids=ID_VECTORS,
        sums=SUMS,
        q="SELECT key, CAST(NULL AS VARCHAR) AS term, v FROM sums",
        w="SELECT * FROM ids",
        ranked=RANKED,
    ),
    "parse_expression": _with(
        "SELECT id, pos, term, CAST(sign AS BIGINT) AS sign FROM terms", mentions=MENTIONS, parsed=PARSED, terms=TERMS
    ),
    "oov_terms": _with(
        """
        SELECT CAST(id AS VARCHAR) AS key, string_agg(DISTINCT term, ' | ' ORDER BY term) AS oov
        FROM terms WHERE term NOT IN (SELECT CAST(vec_id AS VARCHAR) FROM embeddings)
        GROUP BY id
        """,
        mentions=MENTIONS,
        parsed=PARSED,
        terms=TERMS,
    ),
    "direct_mentions": _with(
        "SELECT id, author, text FROM parsed WHERE direct", mentions=MENTIONS, parsed=PARSED
    ),
    "mention_prefix": _with("SELECT id, prefix FROM parsed", mentions=MENTIONS, parsed=PARSED),
    "permalink": "SELECT event_id AS id, 'http://twitter.com/u' || user_id || '/status/' || event_id AS url FROM events",
    "route_replies": _REPLIES,
    "mention_stream": _REPLIES,
}

SQL |= {
    "dedup_null_keys": """
      SELECT CASE WHEN lang <> 'fr' THEN md5(text) END AS doi, doc_id, source FROM documents
      QUALIFY lang = 'fr'
           OR row_number() OVER (PARTITION BY lang <> 'fr', md5(text) ORDER BY source, doc_id) = 1
    """,
    "corpus_rows": """
      WITH marked AS (
        SELECT md5(text) AS m, md5(text)[1] AS kind, string_split(text, chr(10)) AS lines FROM documents
      ), texts AS (
        SELECT CASE WHEN kind NOT IN ('0', '1', '2', '3') THEN m END AS doi,
               CASE WHEN kind NOT IN ('2', '4') THEN lines[1] ELSE '' END AS abstract,
               CASE WHEN kind NOT IN ('3', '5') THEN coalesce(array_to_string(lines[2:], ' '), '') ELSE '' END AS fulltext
        FROM marked
      )
      SELECT DISTINCT * FROM texts WHERE doi IS NOT NULL
      UNION ALL SELECT * FROM texts WHERE doi IS NULL
    """,
    "scalar_json_marks": """
      SELECT '10.1/' || doc_id AS doi, v AS disciplines, v AS abstract FROM (
        SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '' ELSE ['[', '{', '"', '[1] '][doc_id % 4 + 1] || source END AS v
        FROM documents
      )
    """,
    "cancelled_sums": """
      SELECT CAST(a.vec_id AS VARCHAR) AS key, dim - 1 AS dim,
             CASE WHEN a.vec_id % 3 = 1 THEN CAST(a.embedding[dim] AS DOUBLE) ELSE 0.0 END AS value
      FROM embeddings a, (SELECT unnest(range(1, 65)) AS dim)
      WHERE a.vec_id + (CASE a.vec_id % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END) IN (SELECT vec_id FROM embeddings)
        AND a.vec_id + (CASE a.vec_id % 3 WHEN 2 THEN 0 ELSE 1 END) IN (SELECT vec_id FROM embeddings)
    """,
    "zero_queries": """
      WITH words AS (
        SELECT CAST(vec_id AS VARCHAR) AS word, row_number() OVER (ORDER BY CAST(vec_id AS VARCHAR)) AS place
        FROM embeddings
      )
      SELECT CAST(vec_id AS VARCHAR) AS key, row_number() OVER (PARTITION BY vec_id ORDER BY place) AS rank, word,
             CAST(0.0 AS DOUBLE) AS sim
      FROM embeddings JOIN words ON place BETWEEN 2 AND 10 AND NOT starts_with(word, CAST(vec_id AS VARCHAR))
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY place) <= 5
    """,
    "mention_lots": SQL["mention_stream"],
    "mention_replay": SQL["mention_stream"],
}
