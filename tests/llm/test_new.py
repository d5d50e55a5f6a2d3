"""Toxicity, divergence of sources and whitening: brute force, held-out labels, odd input."""

import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm import LONG, ODD, SCHEMA, SF, documents, none, odd, texts  # noqa: F401

from termspace.llm import divergence, queries, toxicity, whitening


# Toxicity.


def test_toxicity_on_held_out_labels(spark):
    found = queries.op11_toxicity(spark, "/root/testdata/sf0.01")
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    assert found.filter("score < 0 or score > 1 or score is null").count() == 0
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) >= 0.95


def planted(spark, n=400):
    """Texts of two languages; toxic ones of the second have words of an odd beginning."""
    rng = np.random.default_rng(3)
    words = {x: [f"{x}{rng.integers(10**6)}".translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(300)] for x in "op"}
    rows = []
    for i in range(n):
        lang, toxic = "op"[i % 3 == 0], i % 5 == 0
        text = list(rng.choice(words[lang], 40))
        if toxic:
            for place in rng.integers(0, 40, 4):
                text[place] = rng.choice(["idiot", "moron"]) if lang == "o" else "grumpf" + rng.choice(words["o"])[:3]
        rows.append((i, " ".join(text), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int"), rows


def test_toxic_words_of_a_small_language_are_learned_as_beginnings(spark):
    docs, rows = planted(spark)
    model = toxicity.fit_toxicity(docs, docs.filter("doc_id < 300"))
    scored = docs.select("doc_id", toxicity.toxicity_score(model, docs, "text").alias("score")).collect()
    wrong = [r for r in scored if r["doc_id"] >= 300 and (r["score"] >= 0.5) != (rows[r["doc_id"]][2] == 1)]
    assert not wrong
    assert any("grumpf".startswith(p.strip()) for p in model.patterns)


def test_label_model_agrees_with_brute_force_posterior(spark):
    """The posterior of every set of votes, from the joint distribution written out."""
    model = toxicity.LabelModel(0.3, [-1, 0, 0], np.array([[[0.2, 0.2], [0.7, 0.7]], [[0.1, 0.5], [0.4, 0.9]], [[0.3, 0.2], [0.6, 0.8]]]))
    votes = toxicity.unpacked(np.arange(8), 3)
    for row, got in zip(votes, model.posterior(votes)):
        joint = []
        for label, share in ((0, 0.7), (1, 0.3)):
            for j, up in enumerate(model.parent):
                one = model.chance[j, label, int(row[up]) if up >= 0 else 0]
                share *= one if row[j] else 1 - one
            joint.append(share)
        assert abs(got - joint[1] / sum(joint)) < 1e-12
    assert np.allclose(model.accuracies()[0], [0.2, 0.7])
    assert np.allclose(model.accuracies()[1], [0.8 * 0.1 + 0.2 * 0.5, 0.3 * 0.4 + 0.7 * 0.9])


def test_label_model_finds_accuracies_and_the_pair_that_repeats_itself(spark):
    rng = np.random.default_rng(5)
    n, true = 20_000, rng.random(20_000) < 0.2
    rates = [(0.05, 0.7), (0.1, 0.6), (0.02, 0.5), (0.2, 0.8)]
    votes = np.stack([np.where(true, rng.random(n) < hit, rng.random(n) < miss) for miss, hit in rates], 1)
    copied = np.where(rng.random(n) < 0.95, votes[:, 2], rng.random(n) < 0.5)
    votes = np.concatenate([votes, copied[:, None]], 1)
    sets = collections.Counter((votes @ (1 << np.arange(5))).tolist())
    table = spark.createDataFrame(list(sets.items()), "votes long, n long")
    model = toxicity.fit_label_model(table, votes[:400], true[:400].astype(float), np.ones(400))
    assert model.parent[4] == 2 or model.parent[2] == 4
    assert np.abs(model.accuracies()[:4] - np.array(rates)).max() < 0.1


def test_pattern_counts_agree_with_a_plain_search():
    patterns = [" idiot ", " idi", " \xc3\xa9t"]
    text = "Idiot, IDIOTIC idiot! été aidiot \nidi"
    folded = toxicity.folded(text.encode())
    words = re.findall(r"[a-z\x80-\xff]+", text.encode().decode("latin-1").lower().replace("\xe3", "\xc3"))
    plain = {0: words.count("idiot"), 1: sum(w.startswith("idi") for w in words), 2: 1}
    assert toxicity.Matcher(patterns).counts(folded) == plain
    assert toxicity.word_count(folded) == len(words)


def test_toxicity_of_odd_rows(spark, odd, none):  # noqa: F811
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (None, 1), (6, 0), (6, None), (6, 7), (9, 1), (7, 0)], "doc_id long, toxic int")
    for marks in (labels, labels.limit(0), labels.filter("toxic = 1")):
        model = toxicity.fit_toxicity(odd, marks)
        found = odd.select("doc_id", "text", toxicity.toxicity_score(model, odd, "text").alias("_found")).collect()
        assert len(found) == len(ODD) and all(0 <= r["_found"] <= 1 for r in found)
        assert len({r["_found"] for r in found if not (r["text"] or "").strip()}) == 1
        assert none.select(toxicity.toxicity_score(model, none, "text")).count() == 0
    toxicity.fit_toxicity(none, labels)


# Divergence of sources.


def audit_by_hand(rows, least, smooth=5, most=50):
    docs = [((lang or ""), (source or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", divergence_lower(text))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        frequency = collections.Counter(t for d in mine for t in set(d[2]))
        kept = [t for t, n in frequency.items() if n >= least]
        counts = {s: collections.Counter(t for d in mine if d[1] == s for t in d[2] if frequency[t] >= least) for s in {d[1] for d in mine}}
        whole = sum(counts.values(), collections.Counter())

        def share(c):
            below = sum(c.values()) + smooth * len(kept)
            return {t: 1 + 10**9 * (c[t] + smooth) // below for t in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s in counts:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in counts if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(sorted(terms)[:most])]
    return sorted(out)


def test_divergence_counts_terms_of_the_texts_once(spark, monkeypatch):
    # Finding on op12: the texts were counted to choose the terms, and again to fit them.
    fitted, fit = [], divergence.CountVectorizer.fit
    monkeypatch.setattr(divergence.CountVectorizer, "fit", lambda self, df: fitted.append(df.collect()) or fit(self, df))
    docs = spark.createDataFrame([("a b b rare", "x", "s")] * 5 + [("b c", "x", "t")] * 5 + [("rare", "y", "s")], "text string, lang string, source string")
    found = divergence.audit(docs, min_documents=5)
    assert sorted(r["_tokens"] for rows in fitted for r in rows) == [[f"{t}\0x"] for t in ("a", "b", "c", "rare")]
    # Shares of 1 + floor(1e9 * (count + 5) / (sum + 20)): a 5, b 10 and rare 5 of 20 in s, b 5 and c 5 of 10 in t.
    s, t = ([1 + 10**9 * (n + 5) // (sum(c) + 20) for n in c] for c in ([5, 10, 0, 5], [0, 5, 5, 0]))
    assert {r["value"] for r in found.filter("part = 'pair'").collect()} == {sum(abs(p - q) for p, q in zip(s, t))}


def divergence_lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


@pytest.mark.parametrize("limits", [{}, {"fit_terms": 7}, {"source_block": 2, "term_block": 3}])
def test_audit_agrees_with_brute_force(spark, limits):
    rng = np.random.default_rng(1)
    pool = ["the", "The", "a", "été", "東京", "x-y", "z\U0001f600z", "", "q1", *(f"w{'abcdefghij'[i]}" for i in range(10))]
    rows = [
        (" ".join(rng.choice(pool, rng.integers(0, 12))), ["en", "de", None][i % 3], ["s", "t", "u", None, "", "\U00010000"][i % 6 if i % 4 else 0])
        for i in range(90)
    ]
    rows += [(None, "fr", "s"), ("", "fr", "t"), ("once", "it", "s")] + rows[:5]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumns({"_lang": F.lit(1), "item": F.lit(2)})
    found = sorted(map(tuple, divergence.audit(docs, min_documents=4, **limits).collect()))
    assert found == audit_by_hand(rows, 4)


def test_audit_of_odd_rows(odd, none):  # noqa: F811
    found = sorted(map(tuple, divergence.audit(odd, min_documents=2).collect()))
    assert found == audit_by_hand([(t, lang, s) for _, t, lang, s in ODD], 2)
    assert divergence.audit(none).count() == 0


def test_shares_do_not_overflow(spark):
    big = spark.createDataFrame([(10**15, 10**15, 7)], "c long, n long, v long")
    got = big.select(divergence._share(F.col("c"), F.col("n"), F.col("v"), 5)).first()[0]
    assert got == 1 + 10**9 * (10**15 + 5) // (10**15 + 35)


# Whitening.


def whitened_by_hand(vectors, k):
    x = np.array([np.floor(256 * np.array(v, float)) for v in vectors]).astype(np.int64)
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = distinct - sums / n
    values, q = np.linalg.eigh(centred.T @ centred / n)
    values, q = values[::-1][:k], q[:, ::-1][:, :k]
    far = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, sums)) for row in x]
    return n, far, (x - sums / n) @ q / np.sqrt(values), values / (np.square(centred).sum() / n)


def agrees(found, vectors, ids, k):
    n, far, w, explained = whitened_by_hand(vectors, k)
    assert len(found) == len(ids) * k
    for c in range(k):
        rows = {r["vec_id"]: r for r in found if r["component"] == c + 1}
        got = np.array([rows[i]["whitened"] for i in ids])
        assert np.abs(got * np.sign(got @ w[:, c]) - w[:, c]).max() < 1e-9
        assert [rows[i]["deviation"] for i in ids] == far and {rows[i]["n"] for i in ids} == {n}
        assert all(abs(rows[i]["explained"] / explained[c] - 1) < 1e-10 for i in ids)
        assert max(rows[i]["identity_error"] for i in ids) < 1e-9


def test_whitening_agrees_with_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    found = queries.op13_whitening(spark, SF).collect()
    agrees(found, [r["embedding"] for r in rows], [r["vec_id"] for r in rows], 4)


@pytest.mark.parametrize("sizes", [{"block_bytes": 64}, {"fan_in": 2}])
def test_whitening_in_small_blocks_and_many_partial_sums(spark, sizes):
    rng = np.random.default_rng(0)
    rows = [(int(i), [int(v) for v in rng.integers(-300, 300, 5)]) for i in range(80)]
    vectors = spark.createDataFrame(rows, "key long, x array<long>").repartition(7)
    model = whitening.fit_whitening(vectors, 3, **sizes)
    x = np.array([r[1] for r in rows])
    centred = x - x.mean(axis=0)
    assert np.allclose(model.values, np.linalg.eigvalsh(centred.T @ centred / len(x))[::-1][:3], rtol=1e-13)
    assert model.sums.tolist() == x.sum(axis=0).tolist()


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i), -0.001, float(i * i % 7)]) for i in range(12)] + [(3, [3.0, -0.001, 2.0]), (3, [3.0, -0.001, 2.0])]
    bad = [(50, None), (51, [1.0, None, 2.0]), (52, [nan, 1.0, 1.0]), (53, [inf, 1.0, 1.0]), (54, [1.0]), (55, [])]
    schema = "vec_id long, embedding array<double>"
    rows = spark.createDataFrame(good + bad + [(None, [2.0, -0.001, 4.0])], schema).withColumns({"x": F.lit(1), "n": F.lit(2), "key": F.lit(3)})
    found = whitening.whiten(rows).collect()
    # The second entry never varies, so two components remain; repeated rows and a null key have results too.
    assert len(found) == (len(good) + 1) * 2 and {r["component"] for r in found} == {1, 2}
    assert {r["vec_id"] for r in found} == {None, *range(12)}
    unique = {i: v for i, v in good}
    agrees([r for r in found if r["vec_id"] not in (None, 3)] + list({(r["vec_id"], r["component"]): r for r in found if r["vec_id"] == 3}.values()), list(unique.values()), list(unique), 2)
    for few in (rows.filter("vec_id = 3"), rows.limit(0), rows.filter("vec_id >= 50")):
        assert whitening.whiten(few).collect() == []
    assert whitening.whiten(rows).schema == whitening.whiten(rows.limit(0)).schema


@pytest.mark.parametrize("values", [[5, 5, 5, 5, 5, 1, 1, 1], [9, 0, 0, 0, 0, 0], [1] * 7, [10.0**-i for i in range(30)], [5, 5 - 1e-9, 5 - 2e-9, 3, 1, 1], [2], [3, 1]])
def test_jacobi_davidson_of_hard_spectra(values):
    d, k = len(values), min(4, len(values))
    q, _ = np.linalg.qr(np.random.default_rng(2).standard_normal((d, d)))
    a = (q * np.array(values, float)) @ q.T
    got, u = whitening.jacobi_davidson(lambda b: a @ b, d, k)
    assert np.allclose(got, sorted(values, reverse=True)[:k], rtol=0, atol=1e-14 * max(values))
    assert np.linalg.norm(a @ u.T - u.T * got, axis=0).max() < 1e-14 * d * max(values)
    assert np.allclose(u @ u.T, np.eye(k), atol=1e-13)
