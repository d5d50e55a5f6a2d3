"""The operators for training text against SQL, brute force, and odd input."""

import collections
import html
import math
import os
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, differences, duck_rows, spark_rows
from pyspark.sql import functions as F

from termspace.llm import (
    components,
    decontaminate,
    exact_dedup,
    html_extract,
    interpolation_lm,
    language,
    mixing,
    quality,
    queries,
    simhash,
    token_output,
    url_filter,
)
from termspace.llm.common import Bitmap
from termspace.llm.labelled import labelled_sample
from termspace.session import scratch_path

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
LONG = "lorem ipsum dolor " * 20_000
ODD = [
    (1, "Same text here", "en", "a"),
    (2, "same TEXT here", "en", "a"),
    (2, "same TEXT here", "en", "a"),
    (None, "same text here", None, None),
    (3, None, "en", "a"),
    (4, "", None, "b"),
    (5, " \t\n", "de", None),
    (6, LONG, "en", "a"),
    (7, LONG + "x", "en", "a"),
    (8, "Ünïcode – ÄÖÜ 東京 <|endoftext|> it's***", "de", "b"),
    (9, "one", "fr", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties and repeated rows, and columns named like the operators' own."""
    rows = spark.createDataFrame(ODD, SCHEMA)
    names = ["_id", "_text", "_key", "score", "kept", "_print", "group", "_size", "_row_key", "_mix_key", "n_words"]
    return rows.withColumns({name: F.lit("clash") for name in names})


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


@pytest.mark.parametrize("name", queries.SQL)
def test_query_agrees_with_sql(spark, name):
    ours = spark_rows(queries.QUERIES[name](spark, SF))
    assert ours[1] and differences(ours, duck_rows(connect(SF), queries.SQL[name])) == []


# Exact dedup.


def test_exact_groups_of_odd_rows(odd, none):
    rows = exact_dedup.exact_groups(odd).collect()
    assert len(rows) == len(ODD)
    found = collections.Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in rows)
    assert found[1, 2, 4, False] == 1 and found[2, 2, 4, True] == 2 and found[None, 2, 4, False] == 1
    assert found[3, 4, 2, False] == 1 and found[4, 4, 2, True] == 1 and found[5, 5, 1, True] == 1
    assert exact_dedup.exact_groups(none).count() == 0


def test_bitmap_never_loses_a_key(spark):
    rows = spark.range(2_000)
    kept = Bitmap(rows.filter("id % 7 = 0"), ["id"]).keep(rows, ["id"])
    found = {r["id"] for r in kept.collect()}
    assert {i for i in range(2_000) if i % 7 == 0} <= found and len(found) < 600


def test_exact_dedup_stays_out_of_python(spark):
    plan = queries.op1_exact_dedup(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# URL lists.


def test_urls_of_odd_rows(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://EN.Example.ORG/en/1?x", "ftp://a.com/de/x", "http://notorg/", "x://org"]
    urls += ["http://a.org/x#/es/", "http://example.org/es/", "y://z.example.org/es/q", "http://a.com/fr"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("verdict", F.lit("clash"))
    rules = spark.createDataFrame(queries.URL_RULES, url_filter.RULES)
    found = {r["page_id"]: r for r in url_filter.judge_urls(pages, rules).collect()}
    got = [(r["host"], r["rule"], r["verdict"]) for _, r in sorted(found.items())]
    assert got[:4] == [("", None, "allow")] * 4
    assert got[4:8] == [
        ("en.example.org", "example.org/en/1", "block"),
        ("a.com", "com/de/", "block"),
        ("notorg", None, "allow"),
        ("org", None, "allow"),
    ]
    assert got[8:] == [
        ("a.org", "org/", "allow"),
        ("example.org", "example.org/es/", "block"),
        ("z.example.org", "example.org/es/", "block"),
        ("a.com", None, "allow"),
    ]
    assert {r["verdict"] for r in url_filter.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


def test_urls_with_very_many_labels(spark):
    host = "a." * 8_000
    urls = [f"http://{host}example.org/es/{'x/' * 8_000}", f"http://{host}net/", f"http://{host}com/de/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = spark.createDataFrame([*queries.URL_RULES, ("b.c.d.net", "/", "block")], url_filter.RULES)
    found = sorted((r["page_id"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(pages, rules).collect())
    assert found == [(0, "example.org/es/", "block"), (1, None, "allow"), (2, "com/de/", "block")]


def test_cascade_is_exact_with_far_too_few_bits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_BITS", 1_024)
    universe = spark.range(3_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.filter(F.crc32("key") % 10 == 0)
    cascade = url_filter.build_cascade(listed, universe, str(tmp_path))
    rows = universe.select("key", *url_filter.key_hashes(F.col("key")), (F.crc32("key") % 10 == 0).alias("want")).collect()
    first, second = (np.array([r[c] for r in rows], dtype=np.int64).view(np.uint64) for c in ("first", "second"))
    assert len(cascade.levels) > 2
    assert cascade.contains(first, second).tolist() == [r["want"] for r in rows]


# Language model.


def test_lm_base_score_agrees_with_brute_force(spark, texts):
    found = {r["doc_id"]: r for r in queries.op3_lm_score(spark, SF).collect()}
    tokens = {d: words(t) + [None] for d, t in texts.items()}
    part = {d: zlib.crc32(str(d).encode()) % 5 for d in texts}
    counts = collections.Counter(w for d, ws in tokens.items() if part[d] != 1 for w in ws)
    total, types = sum(counts.values()), len(counts)
    assert set(found) == set(texts)
    for d, row in found.items():
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (types + 1))) for w in tokens[d])
        assert (row["n_tokens"], row["train_tokens"], row["held_out"]) == (len(tokens[d]), total, part[d] == 1)
        assert row["n_known"] == sum(w in counts for w in tokens[d])
        assert row["base_score"] == pytest.approx(base, rel=1e-9) and row["score"] < 0
    held = [r for r in found.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


@pytest.mark.parametrize("sizes", [{}, {"slice_bytes": 20_000, "group_tokens": 3_000, "block_slices": 4}, {"order": 2}])
def test_lm_score_agrees_with_brute_force_model(documents, texts, sizes):
    """The mixture worked out token by token, with the weights that were learned; sizes of slices and groups change nothing."""
    order = sizes.get("order", interpolation_lm.ORDER)
    train = F.col("doc_id") % 3 != 0
    scored, model = interpolation_lm.score(documents, train, F.col("doc_id") % 3 == 1, **sizes)
    # "" stands before a text, None ends it.
    chains = {d: [""] * (order - 1) + words(t) + [None] for d, t in texts.items()}
    grams = lambda chain, n: [tuple(chain[i - n + 1 : i + 1]) for i in range(order - 1, len(chain))]
    counts = [collections.Counter(g for d, c in chains.items() if d % 3 for g in grams(c, n)) for n in range(1, order + 1)]
    followed = [collections.Counter() for _ in range(order)]
    for longer in range(1, order):
        for gram, n in counts[longer].items():
            followed[longer][gram[:-1]] += n
    total, types = sum(counts[0].values()), len(counts[0])
    assert (model.tokens, model.types, model.texts) == (total, types, sum(d % 3 > 0 for d in texts))
    for row in scored.collect():
        chain, want = chains[row["doc_id"]], 0.0
        for each in zip(*(grams(chain, n) for n in range(1, order + 1))):
            bucket, shares = 0, [1 / (types + 1), counts[0][each[0]] / total]
            for longer in range(1, order):
                n = followed[longer][each[longer][:-1]]
                bucket = 64 * (longer - 1) + int(math.log2(n)) + 1 if n else bucket
                shares.append(counts[longer][each[longer]] / max(n, 1))
            want += math.log10(sum(w * s for w, s in zip(model.weights[bucket], reversed(shares))))
        assert row["score"] == pytest.approx(want, rel=1e-9)


def test_lm_weights_are_those_of_plain_expectation_maximisation(documents, texts):
    """Two shares that EM over every kept-back pair would learn, without cells."""
    _, model = interpolation_lm.score(documents, F.lit(True), F.col("doc_id") % 5 == 0, order=2)
    chains = {d: ["", *words(t), None] for d, t in texts.items()}
    kept = [p for d, c in chains.items() if d % 5 for p in zip(c, c[1:])]
    pairs, tokens, before = collections.Counter(kept), collections.Counter(p[1] for p in kept), collections.Counter(p[0] for p in kept)
    types = len({w for c in chains.values() for w in c[1:]})
    parts, bucket = [], []
    for context, word in (p for d, c in chains.items() if not d % 5 for p in zip(c, c[1:])):
        n = before[context]
        bucket.append(int(math.log2(n)) + 1 if n else 0)
        parts.append([pairs[context, word] / max(n, 1), max(tokens[word], 0.5) / len(kept), 1 / (types + 1)])
    want = interpolation_lm.learn_weights(np.array(bucket), np.ones(len(bucket)), np.array(parts), 2)
    found = np.unique(bucket)
    assert np.abs(model.weights[found] - want[found]).max() < 0.02


def test_lm_chances_add_up_to_one(documents):
    """Over all words and the class of words never seen, after contexts of every kind."""
    _, model = interpolation_lm.score(documents, F.lit(True), F.col("doc_id") % 5 == 0)
    assert model.weights.sum(axis=1) == pytest.approx(1) and (model.weights >= 0).all()
    # Where a context was never seen, the estimate that needs it has no weight.
    assert (model.weights[0, :2] == 0).all() and (model.weights[:65, 0] == 0).all()


def test_lm_of_odd_rows(odd, none):
    scored, _ = interpolation_lm.score(odd, F.col("doc_id") < 7, F.col("doc_id") == 2)
    rows = scored.collect()
    assert len(rows) == len(ODD) and all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert collections.Counter(r["n_tokens"] for r in rows if r["doc_id"] in (3, 4, 5)) == {1: 3}
    twice = [r for r in rows if r["doc_id"] == 2]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert interpolation_lm.score(none, F.lit(True), F.lit(False))[0].count() == 0
    untaught = interpolation_lm.score(odd, F.lit(False), F.lit(False))[0].collect()
    assert len(untaught) == len(ODD) and all(r["n_known"] == 0 and math.isfinite(r["score"]) for r in untaught)


# Main text.


def test_main_text_is_the_article(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    found = {r["page_id"]: r for r in queries.op4_html_extract(spark, SF).collect()}
    for row in rows:
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", row["html"], re.DOTALL)[1]
        inner = re.sub(r"<(/?)(\w+)[^>]*(?:>|\Z)", lambda m: "" if m[2] == "b" else " ", inner)
        want = " ".join(html.unescape(inner).split())
        assert found[row["page_id"]]["text"] == want and found[row["page_id"]]["n_chars"] == len(want)


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("only words", "only words"),
        ("<nav>Home News</nav><p>Some <i>good</i>text &amp; more<p>Second<br>line</p><footer>foot</footer>", "Some goodtext & more Second line"),
        ("<article><h1>T</h1><p>a</p><div class='ad'>buy</div><p>b</p><section id=comments><p>me too</p></section></article>", "T a b"),
        ("<article><p>a</p><aside>side</aside><form>f</form></article><p>after</p>", "a"),
        ("<p title='a>b'>quoted</p><script>var a = '<p>no</p>'</script><p>end", "quoted end"),
        ("<div class=cookie-notice>We use cookies</div><main><p>1 &lt; 2 &eacute;</p></main>", "1 < 2 é"),
        ("<p>cut <a href=\"x", "cut"),
        ("<!-- all <p>hidden</p> --><p>shown</p><!-- never closed <p>x", "shown"),
        ("<p>" + LONG + "</p>", LONG.strip()),
    ],
)
def test_main_text(page, text):
    assert html_extract.main_text(page, dict(html_extract._DEFAULT)) == text


BODY = " ".join(f"word{i}" for i in range(60))


@pytest.mark.parametrize("page", ["<main><p>{}</p><article>A teaser</article></main>", "<div><p>{}</p></div><article>A teaser</article>"])
def test_a_teaser_article_does_not_take_the_place_of_the_body(page):
    assert html_extract.main_text(page.format(BODY), dict(html_extract._DEFAULT)) == BODY


@pytest.mark.parametrize(
    "wrapper",
    [
        "<div class='content has-sidebar'>{}</div>",
        "<div id=content class=right-sidebar>{}</div>",
        "<div class=page-with-nav>{}</div>",
        "<div class='post comments-open'><article>{}</article></div>",
        "<form id=aspnet action='/'><div>{}</div></form>",
        "<form><main>{}</main>",
    ],
)
def test_wrappers_of_the_page_are_no_furniture(wrapper):
    page = wrapper.format(f"<div class=sidebar>links</div><p>{BODY}</p><form class=x>mail</form>")
    assert html_extract.main_text(page, dict(html_extract._DEFAULT)) == BODY


def test_unmarked_pages_keep_their_body(spark):
    """The given pages without their marks, by the weights learned with them."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    weights = html_extract.fit_weights(pages)
    for row in pages.collect():
        bare = re.sub("</?article>", "", row["html"])
        marked = html_extract.main_text(row["html"], weights)
        assert marked and marked in html_extract.main_text(bare, weights)


@pytest.fixture(scope="module")
def learned(spark):
    return html_extract.fit_weights(spark.read.parquet(f"{SF}/pages.parquet"))


@pytest.mark.parametrize(
    "given",
    [
        "class='post category-advertising tag-social'",
        "class='social-sciences'",
        "class='search-result-page'",
        "class='widget-area-wrapper'",
        "class='notice-of-decision'",
        "class='promo-free'",
        "class='menu-recipes post'",
        "class='post reply-123'",
        "class='header-image-post'",
        "class='signup-guide'",
        "class='elementor-widget-container'",
        "class='wp-block-group elementor-widget x'",
        "class='modal-logic-article'",
        "class='comments-open'",
        "style='display:none-ish'",
    ],
)
@pytest.mark.parametrize("each", [False, True])
def test_names_of_wrappers_do_not_hide_the_body(learned, given, each):
    """One wrapper of the body, or one of every paragraph."""
    paragraphs = [f"<p>{BODY}</p>"] * 4
    body = "".join(f"<div {given}>{p}</div>" for p in paragraphs) if each else f"<div {given}>{''.join(paragraphs)}</div>"
    page = f"<body><nav>Home</nav><div class=ad>Buy more</div>{body}<div class=sidebar>Read this too</div><footer>f</footer></body>"
    assert html_extract.main_text(page, learned) == " ".join([BODY] * 4)


@pytest.mark.parametrize("name", ["ad", "sidebar", "menu", "comments", "cookie-notice", "newsletter signup", "related"])
@pytest.mark.parametrize("frame", ["<article>{}</article>", "<main>{}</main>", "<div>{}</div>"])
def test_named_furniture_stays_out(learned, name, frame):
    other = " ".join(f"other{i}" for i in range(200))
    page = frame.format(f"<p>{BODY}</p><div class='{name}'><p>{other}</p></div><p>{BODY}</p>")
    assert html_extract.main_text(page, learned) == f"{BODY} {BODY}"


def test_weights_of_names_are_learned(spark):
    """A name around main texts, one of furniture that no list has, and a listed one that the pages clear."""
    page = "<div class='frame widget'><div class=zzq>{0}</div><article><p>{0}</p><div class=ad>{0}</div></article></div>".format(BODY)
    weights = html_extract.fit_weights(spark.createDataFrame([(page,)] * 30, "html string"))
    assert weights["#name zzq"] < -1 and "#name frame" not in weights and "#name ad" not in weights
    assert weights["#name widget"] > -1 > html_extract._prior("widget")
    words = 30 * 60
    assert weights["#name zzq"] == pytest.approx(math.log(200 / (words + 200)))
    assert html_extract.main_text(f"<div><p>{BODY}</p><div class=zzq>x y z</div></div>", weights) == BODY
    assert html_extract.main_text(f"<div><p>{BODY}</p><div class=zzq>x y z</div></div>", dict(html_extract._DEFAULT)) == BODY + " x y z"


def test_best_run_is_the_best_of_all():
    rng = np.random.default_rng(4)
    weights = dict(html_extract._DEFAULT) | {"p": -0.3, "div": -0.9}
    for _ in range(200):
        pieces = []
        for _ in range(rng.integers(0, 30)):
            kind = str(rng.choice(["p", "div", "other", html_extract.WORD, html_extract.LINK_WORD, html_extract.FURNITURE]))
            text = kind.startswith("#")
            piece = html_extract._Piece(kind, "x" if text else "", int(rng.integers(0, 4)))
            piece.main = bool(rng.random() < 0.3)
            pieces.append(piece)

        def value(piece):
            if piece.kind == html_extract.FURNITURE:
                return 0.0
            if piece.text:
                return weights[html_extract.WORD if piece.main else piece.kind] * piece.n
            return (-html_extract._LEAST if piece.main else weights.get(piece.kind, weights[html_extract._UNSEEN_TAG])) * piece.n

        scores = [value(p) for p in pieces]
        sums = [sum(scores[i:j]) for i in range(len(pieces)) for j in range(i + 1, len(pieces) + 1)]
        score, begin, end = html_extract.best_run(pieces, weights)
        assert score == pytest.approx(max([0.0, *sums])) and score == pytest.approx(sum(scores[begin:end]))


def test_extract_of_odd_rows(spark):
    rows = [(1, None), (1, None), (2, ""), (None, "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("clash"))
    weights = html_extract.fit_weights(pages)
    found = html_extract.extract(pages, weights, ["page_id"]).collect()
    assert sorted((r["page_id"] or 0, r["text"]) for r in found) == [(0, "x"), (1, ""), (1, ""), (2, "")]
    assert html_extract.extract(pages.limit(0), html_extract.fit_weights(pages.limit(0)), ["page_id"]).count() == 0


def test_deep_pages_take_time_in_proportion():
    hostile = [
        "<div>" * 60_000 + "word " * 9 + "</b>" * 60_000,
        "<ul><li>" + "<span>" * 60_000 + "<li>x</li>" * 60_000,
        "<p>" * 60_000 + "<table>" * 60_000 + "</p>" * 60_000 + "</td>" * 60_000,
    ]
    for page in hostile:
        began = time.process_time()
        html_extract.main_text(page, html_extract._DEFAULT)
        assert time.process_time() - began < 20 * len(page) / 1_000_000, page[:40]


def test_end_tags_close_what_is_open():
    rng = np.random.default_rng(11)
    names = ["p", "li", "ul", "td", "table", "span", "div", "b", "option"]

    def close_within(open_, name):
        for depth in range(len(open_) - 1, -1, -1):
            if open_[depth] == name:
                del open_[depth:]
                return
            if open_[depth] in html_extract._SCOPE:
                return

    for _ in range(300):
        tags = [(bool(rng.random() < 0.4), names[rng.integers(len(names))]) for _ in range(40)]
        page = html_extract._Page("".join(f"</{n}>" if end else f"<{n}>" for end, n in tags))
        open_ = []
        for end, name in tags:
            if end and name in open_:
                while open_.pop() != name:
                    pass
            elif not end:
                if name in html_extract._CLOSES_P:
                    close_within(open_, "p")
                if name in html_extract._SAME_CLOSES:
                    close_within(open_, name)
                open_.append(name)
        assert [name for name, _, _ in page.open if name not in html_extract._FURNITURE] == [n for n in open_ if n not in html_extract._FURNITURE]


# Mixing.


def targets_by_hand(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = set()
    while True:
        rest = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        target = {s: most * sizes[s] if s in capped else rest * weight[s] / free for s in names}
        above = {s for s in names if s not in capped and target[s] > most * sizes[s]}
        if not above:
            return target
        capped |= above


def test_mixing_meets_its_targets(spark, documents, texts):
    rows = queries.op5_mixing(spark, SF).collect()
    source = {r["doc_id"]: r["source"] for r in documents.collect()}
    size = {d: len(words(t)) for d, t in texts.items()}
    per_source, taken = collections.Counter(), collections.Counter()
    for d, n in size.items():
        per_source[source[d]] += n
    target = targets_by_hand(per_source)
    for r in rows:
        d = r["doc_id"]
        assert r["size"] == size[d] and r["source_size"] == per_source[source[d]]
        assert r["target"] == pytest.approx(target[source[d]])
        share = r["target"] / r["source_size"]
        assert r["taken"] in (math.floor(share + 1e-9) * size[d], math.ceil(share - 1e-9) * size[d])
        taken[source[d]] += r["taken"]
    largest = max(size.values())
    assert len(rows) == len(size) and all(abs(taken[s] - t) <= largest / 2 + 1 for s, t in target.items())
    again = {r["doc_id"]: r["taken"] for r in mixing.mix_counts(documents.repartition(7)).selectExpr("_id AS doc_id", "_size * _copies AS taken").collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_mixing_is_fair(spark):
    rows = spark.range(300).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 5 + 1).cast("int")).alias("text"), F.lit("s").alias("source")
    )
    rows = rows.unionByName(rows.filter("doc_id < 100").withColumn("source", F.lit("t")))
    means = collections.Counter()
    for seed in range(6):
        for r in mixing.mix_counts(rows, seed=seed).filter("_source = 's'").collect():
            means[r["_size"]] += r["_copies"] / 6 / 60
    share = targets_by_hand({"s": 900, "t": 300})["s"] / 900
    assert all(abs(mean - share) < 0.12 for mean in means.values()), (means, share)


def mixed_by_hand(docs, share, chance):
    """Bits of (id, size) documents of one group: each in turn meets all documents after it."""
    bits, rest = {}, sum(size for _, size in docs)
    for key, size in docs:
        rest -= size
        fair = rest * share >= size * (1 - share) * (1 - 1e-9) and rest * (1 - share) >= size * share * (1 - 1e-9)
        bits[key] = int(chance[key] < share) if fair else int(share >= 0.5)
        share = min(1.0, max(0.0, share - (bits[key] - share) * size / rest)) if rest else 0.0
    return bits


def sized(spark, rows):
    """Documents of (doc_id, words, source)."""
    given = spark.createDataFrame(rows, "doc_id long, n int, source string")
    return given.select("doc_id", F.repeat(F.lit("w "), F.col("n")).alias("text"), "source")


def test_mixing_is_the_plain_one_by_one(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(n), "st"[i % 2]) for i, n in enumerate(rng.integers(1, 400, 80))]
    counts = mixing.mix_counts(sized(spark, rows), weights=(2, 3)).select(
        "*", mixing._uniform(F.xxhash64("_id", "_size", F.lit(mixing.SEED)), F.lit(mixing.SEED)).alias("chance"),
        F.xxhash64("_id", "_size", F.lit(mixing.SEED)).alias("hash"),
    ).collect()
    for source in "st":
        own = sorted((r for r in counts if r["_source"] == source), key=lambda r: (-r["_size"], r["hash"]))
        share = own[0]["_target"] / own[0]["_source_size"]
        by_hand = mixed_by_hand([(r["_id"], r["_size"]) for r in own], share % 1, {r["_id"]: r["chance"] for r in own})
        assert {r["_id"]: r["_copies"] - int(share) for r in own} == by_hand
        taken = sum(r["_copies"] * r["_size"] for r in own)
        assert abs(taken / own[0]["_target"] - 1) < 0.01


def test_mixing_ends_near_its_targets(spark):
    # One document larger than most others together; and a source of several rounds of meetings in a band.
    rows = [(0, 20_000, "big")] + [(i, 50, "big") for i in range(1, 801)] + [(1_000 + i, 50, "other") for i in range(1_600)]
    rows += [(10_000 + i, 40 + i % 60, "many") for i in range(6_000)]
    for seed in (1, 2):
        counts = mixing.mix_counts(sized(spark, rows), seed=seed)
        found = counts.groupBy("_source").agg(F.sum(F.col("_copies") * F.col("_size")).alias("taken"), F.max("_target").alias("target"))
        off = {r["_source"]: abs(r["taken"] - r["target"]) for r in found.collect()}
        assert off["big"] <= 25 and off["other"] <= 25 and off["many"] <= 50, off


def test_mixing_takes_every_document_as_often_as_it_should(spark):
    # Many sources alike stand for many seeds. Smaller documents can always take up what a larger one gains or owes.
    sizes, sources = [90, 80, 70, 60] + [30] * 10 + [5] * 60 + [1] * 100, 400
    rows = [(s * 1_000 + i, n, f"s{s:04}") for s in range(sources) for i, n in enumerate(sizes)]
    counts = mixing.mix_counts(sized(spark, rows), weights=(1, 2)).withColumn("share", F.col("_target") / F.col("_source_size"))
    means = counts.groupBy((F.col("_id") % 1_000).alias("place"), F.round("share", 6).alias("share")).agg(F.avg("_copies").alias("mean")).collect()
    for r in means:
        part = r["share"] % 1
        error = math.sqrt(part * (1 - part) / (sources / 2))
        # 348 means are looked at, so some lie beyond three standard errors by chance.
        assert abs(r["mean"] - r["share"]) <= 4 * error, (sizes[r["place"]], r)


def test_mixing_of_odd_rows(odd, none):
    counts = mixing.mix_counts(odd).collect()
    assert sum(r["_rows"] for r in counts) == len(ODD) and all(0 <= r["_copies"] <= 3 for r in counts)
    assert [r["_source"] for r in counts if r["_id"] is None] == [None]
    rows = mixing.mixed_rows(odd)
    assert rows.columns == odd.columns
    assert rows.count() == sum(r["_rows"] * r["_copies"] for r in counts if r["_size"])
    assert mixing.mix_counts(none).count() == 0 and mixing.mixed_rows(none).count() == 0


def test_mixing_stays_out_of_python(spark):
    plan = queries.op5_mixing(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# Token files.


def plain_ids(text):
    from tokenizers import Tokenizer

    if not hasattr(plain_ids, "tokenizer"):
        plain_ids.tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    return plain_ids.tokenizer.encode(text or "", add_special_tokens=False).ids + [queries.END_ID]


def test_token_files_hold_the_plain_encoding(spark, texts):
    start = 0
    found = sorted(queries.op6_token_output(spark, SF).collect(), key=lambda r: r["doc_id"])
    for row in found:
        ids = plain_ids(texts[row["doc_id"]])
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)


def test_words_encoded_apart_are_the_plain_encoding():
    rng = np.random.default_rng(7)
    letters = list("abzAZ09.,;:!?*&'\"-_<>|=/\\()é É ß 東 ́ ️ \t\n") + ["<|endoftext|>", "'s", "it's", "word", "WORD", "***", "e\u0301", "İ", "ﬁ", "\u00a0"]
    texts = ["".join(rng.choice(letters, rng.integers(0, 30))) for _ in range(3_000)]
    encoder = token_output.Encoder(queries.TOKENIZER, queries.END_ID)
    parts = list(encoder.encode(pa.array(texts, pa.large_string())))
    ids, sizes = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    for text, got in zip(texts, np.split(ids, np.cumsum(sizes)[:-1])):
        assert got.tolist() == plain_ids(text), repr(text)


def test_token_files_of_odd_rows(spark, odd, none, tmp_path):
    folder = str(tmp_path / "odd")
    manifest = token_output.write_tokens(odd, folder, queries.TOKENIZER, queries.END_ID)
    rows = token_output.read_documents(spark, folder).orderBy("start").collect()
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [r["doc_id"] for r in rows] == [r[0] for r in order]
    assert [r["n_tokens"] for r in rows] == [len(plain_ids(r[1])) for r in order]
    assert manifest.agg(F.sum("docs")).first()[0] == len(ODD)
    folder = str(tmp_path / "none")
    token_output.write_tokens(none, folder, queries.TOKENIZER, queries.END_ID)
    assert token_output.read_documents(spark, folder).count() == 0


# Near duplicates.


def components_by_hand(prints, radius=3):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= radius):
            a, b = sorted((find(i), find(i + 1 + int(j))))
            parent[b] = a
    return [find(i) for i in range(len(prints))]


def test_simhash_agrees_with_brute_force(spark, texts):
    import xxhash

    rows = sorted(queries.op7_simhash(spark, SF).collect(), key=lambda r: r["doc_id"])
    for row in rows:
        w = words(texts[row["doc_id"]])
        shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert row["fingerprint"] == f"{bits:016x}"
    prints = np.array([int(r["fingerprint"], 16) for r in rows], dtype=np.uint64)
    assert [r["component_id"] for r in rows] == [rows[i]["doc_id"] for i in components_by_hand(prints)]


@pytest.mark.parametrize("group", [1_024, 16, 4])
def test_near_groups_find_every_link(spark, group):
    """Clusters of near fingerprints, one of them large, whatever the size from which groups are taken apart."""
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**64, 60, dtype=np.uint64)
    centres[1:4] = centres[0] ^ np.uint64(0b111)
    prints = set(centres.tolist())
    for i, centre in enumerate(centres.tolist()):
        for _ in range(200 if i == 0 else 4):
            flips = rng.choice(64, rng.integers(1, 5), replace=False)
            prints.add(int(centre) ^ sum(1 << int(b) for b in flips))
    prints = np.array(sorted(prints), dtype=np.uint64)
    rows = spark.createDataFrame([(i, int(p)) for i, p in enumerate(prints.view(np.int64))], "_id long, _print long")
    found = {r["_print"]: r["_first"] for r in simhash.near_groups(rows, group=group).collect()}
    assert [found[int(p)] for p in prints.view(np.int64)] == components_by_hand(prints)


def test_thresholds_cover_the_radius():
    for costs in ([[0, 1, 5, 9, 9]] * 4, [[0, 50, 60, 70, 80], [0, 1, 2, 3, 4]]):
        thresholds, _ = simhash._allocate(costs, 3)
        assert sum(t + 1 for t in thresholds) == 4
    assert simhash._allocate([[0, 50, 60, 70, 80], [0, 1, 2, 3, 4]], 3)[0] == [-1, 3]


def test_components_of_chains_stars_and_loops(spark, tmp_path):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (7, 6), (7, 6), (300, 299)]
    found = components.connected_components(spark.createDataFrame(edges, "a long, b long"), str(tmp_path / "a"))
    want = {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 160)} | {300: 299, 299: 299}
    assert {r["node"]: r["root"] for r in found.collect()} == want and found.count() == len(want)
    empty = spark.createDataFrame([], "a long, b long")
    assert components.connected_components(empty, str(tmp_path / "b")).count() == 0


def test_simhash_of_odd_rows(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    found = collections.defaultdict(set)
    for r in rows:
        found[r["component_id"]].add(r["doc_id"])
    assert found[1] == {1, 2, None} and found[3] == {3, 4, 5} and found[6] == {6, 7}
    assert {r["fingerprint"] for r in rows if r["doc_id"] in (3, 4, 5)} == {"0" * 16}
    kept = simhash.keep_one_each(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 6, 8, 9]
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one_each(none).count() == 0


def test_one_of_each_component_stays(spark, documents, texts):
    ids = sorted(texts)
    parts = components_by_hand(np.array([simhash.fingerprint(texts[i].encode()) for i in ids], dtype=np.uint64))
    want = sorted({part: i for i, part in reversed(list(zip(ids, parts)))}.values())
    assert sorted(r["doc_id"] for r in simhash.keep_one_each(documents).collect()) == want
    twice = documents.unionByName(documents.filter("doc_id % 3 = 0"))
    kept = simhash.keep_one_each(twice)
    assert kept.columns == documents.columns and sorted(r["doc_id"] for r in kept.collect()) == want


# Quality and language.


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op8_quality(spark, sf).collect()]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows) and len(rows) == 1_000
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(a == b for a, b in held) / len(held) > 0.9


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (6, 0), (7, 0), (9, 1), (9, None), (None, 1), (9, 5)], "doc_id long, quality int")
    for marks in (labels, labels.limit(0), labels.filter("quality = 1")):
        model = quality.fit_quality(odd, marks)
        scores = [r[0] for r in odd.select(quality.quality_score(model, odd, "text")).collect()]
        assert len(scores) == len(ODD) and all(0 <= s <= 1 for s in scores)
    assert quality.drop_low_quality(odd, model).columns == odd.columns
    assert quality.drop_low_quality(none, quality.fit_quality(none, labels)).count() == 0


def test_language_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op9_language(spark, sf).collect()
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert len(rows) == 1_000 and sum(held) / len(held) > 0.97


def test_language_code_lengths_agree_with_a_plain_walk():

    tree = language.ContextTree.learn(pa.array(["abracadabra", "Abba"], pa.large_string()))
    counts = [collections.defaultdict(collections.Counter) for _ in range(4)]
    for text in ("abracadabra", "abba"):
        data = b"\0\0\0" + text.encode()
        for i in range(3, len(data)):
            for order in range(4):
                counts[order][data[i - order : i]][data[i]] += 1
    model = language.LanguageModel(["x"], [tree])
    asked = ["abrac", "zebra", "", "ABBA é"]
    for text, bits in zip(asked, model.code_lengths(pa.array(asked, pa.large_string()))[:, 0]):
        data, want = b"\0\0\0" + lower(text).encode(), 0.0
        for i in range(3, len(data)):
            for order in (3, 2, 1, 0):
                seen = counts[order].get(data[i - order : i])
                if seen is None:
                    continue
                room = sum(seen.values()) + len(seen)
                if data[i] in seen:
                    want -= math.log2(seen[data[i]] / room)
                    break
                want -= math.log2(len(seen) / room)
            else:
                want += 8
        assert bits == pytest.approx(want)


def test_language_slices_of_any_size_give_the_same_code_lengths(monkeypatch):
    texts = pa.array(["", "abracadabra", "Ab", "ñandú é", "", "x" * 90, "ba" * 40], pa.large_string())
    model = language.LanguageModel(["a", "b"], [language.ContextTree.learn(texts[:4]), language.ContextTree.learn(texts[4:])])
    whole = model.code_lengths(texts)
    for size in (1, 2, 3, 5, 50):
        monkeypatch.setattr(language, "_SLICE_BYTES", size)
        assert np.allclose(model.code_lengths(texts), whole)
        assert np.allclose(model.code_lengths(texts.slice(2, 4)), whole[2:6])


def test_labelled_sample_takes_the_lowest_hashes(spark):
    label = F.when(F.col("id") % 10 == 0, "few").otherwise("most")
    rows = spark.range(400).select((F.col("id") % 150).alias("_id"), F.concat(F.lit("t"), F.col("id") % 300).alias("_text"), label.alias("_label"))
    by_hash = rows.distinct().select("*", F.xxhash64("_id", F.lit("sample")).alias("h"), F.xxhash64("_text").alias("t")).collect()
    for most in (1, 7, 1_000):
        expected = []
        for name in ("few", "most"):
            ordered = sorted((r for r in by_hash if r["_label"] == name), key=lambda r: (r["h"], r["_id"], r["t"]))
            expected += [(name, i + 1, r["_text"]) for i, r in enumerate(ordered[:most])]
        assert labelled_sample(rows, None, most, 10**6, scratch_path(spark, "sample")) == expected
    # Repeated rows leave fewer than their number promises; null ids are left out.
    same = spark.range(3_000).select((F.col("id") % 3).alias("_id"), F.lit("t").alias("_text"), F.lit("a").alias("_label"))
    same = same.unionByName(same.withColumn("_id", F.lit(None).cast("long")))
    assert len(labelled_sample(same, None, 50, 10**6, scratch_path(spark, "sample"))) == 3


def test_language_of_odd_rows(odd, none):
    model = language.fit_languages(odd)
    rows = odd.select("doc_id", language.language_of(model, odd).alias("f")).select("doc_id", "f.*").collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert all((r["lang"] == "und") == (r["doc_id"] in (3, 4, 5)) for r in rows)
    untaught = language.fit_languages(none)
    assert {r[0]["lang"] for r in odd.select(language.language_of(untaught, odd)).collect()} == {"und"}


# Benchmark passages.


def test_contamination_agrees_with_brute_force(spark, odd, none):
    rng = np.random.default_rng(5)
    vocabulary = ["a", "b", "ab", "é", "x1", "the", "quick", "brown"]
    say = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(i, say(n)) for i, n in enumerate([1, 2, 3, 9, 10, 11, 14, 30])] + [(8, None), (8, ""), (9, "..!"), (0, "the THE the the")]
    texts = [say(int(n)) for n in rng.integers(0, 40, 60)] + [items[6][1].upper().replace(" ", "--"), items[7][1] + "x", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("items", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = [(i, w[k : k + 10]) for i, t in items for w in [cut(t)] for k in range(max(0, len(w) - 10) + 1) if w]
    for shard_bytes in (2**20, 60):
        rows = decontaminate.contamination(docs, bench, shard_bytes=shard_bytes).collect()
        assert len(rows) == len(texts)
        for row in rows:
            w = cut(texts[row["doc_id"]])
            hit, found = set(), set()
            for i, window in windows:
                for at in range(len(w) - len(window) + 1):
                    if w[at : at + len(window)] == window:
                        hit |= set(range(at, at + len(window)))
                        found.add(str(i))
            assert (row["n_words"], row["n_hit"], row["items"]) == (len(w), len(hit), sorted(found))
        clean = decontaminate.drop_contaminated(docs, bench, shard_bytes=shard_bytes)
        assert clean.columns == docs.columns
        assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in rows if not r["contaminated"]}
    assert len(decontaminate.contamination(odd, bench).collect()) == len(ODD)
    assert decontaminate.contamination(none, bench).count() == 0
    assert {r["n_hit"] for r in decontaminate.contamination(odd, bench.limit(0)).collect()} == {0}


# Pipeline.


def test_pipeline_stages_take_effect(spark, texts, documents):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "tokens"]
    docs, stages = documents, dict(corpus_pipeline.STAGES)
    kept = {}
    for name in ("quality", "near_dedup", "decontaminate", "mix"):
        docs = stages[name](spark, docs, SF)
        assert docs.columns == documents.columns
        docs = spark.createDataFrame(docs.collect(), documents.schema)
        kept[name] = [r["doc_id"] for r in docs.collect()]
    prints = [simhash.fingerprint((texts[d]).encode()) for d in kept["near_dedup"]]
    assert len(set(components_by_hand(np.array(prints, dtype=np.uint64)))) == len(prints)
    hits = {r["doc_id"] for r in decontaminate.contamination(documents, spark.read.parquet(f"{SF}/benchmark.parquet")).filter("contaminated").collect()}
    assert set(kept["near_dedup"]) - set(kept["decontaminate"]) == hits & set(kept["near_dedup"])
    assert max(collections.Counter(kept["mix"]).values()) <= 3
    rows = sorted(stages["tokens"](spark, docs, SF).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted(kept["mix"])


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_stages_of_odd_rows(spark, odd, empty):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES:
        docs = odd.limit(0) if empty else odd
        found = stage(spark, docs, SF)
        assert name == "tokens" or found.columns == docs.columns
        assert found.count() == 0 if empty else found.count() > 0
