"""Gzip collections read piece by piece: whole, cut, damaged, in several members."""

import gzip
import os
import random
import re

import pytest

from termspace.sources import articles, streams
from termspace.streaming import articles as article_stream

ARTICLE = '<article id="{}"><front><article-meta><article-id pub-id-type="doi">{}</article-id></article-meta></front><body><p>{}</p></body></article>'


def texts(n, seed=0):
    rng = random.Random(seed)
    return [ARTICLE.format(i, f"d{i}", rng.randbytes(rng.randint(0, 900)).hex()) for i in range(n)]


def read(data, step):
    found, broken = [], None
    pieces = (data[i : i + step] for i in range(0, len(data), step))
    try:
        for text, closed in streams.parted(streams.gunzipped(pieces), rb"<article[\s>]", b"</article>"):
            found.append((text.decode("utf-8", "replace"), closed))
    except streams.Broken as problem:
        broken = problem
    return found, broken


@pytest.mark.parametrize("step", [2**20, 1000, 7])
def test_articles_of_a_gzip_stream(step):
    given = texts(60)
    body = "<all>junk <articles> " + "\n".join(given) + "</all>"
    whole = [(t, True) for t in given]
    one = gzip.compress(body.encode())
    many = b"".join(gzip.compress(t.encode()) for t in given) + b"\0" * 600
    assert read(one, step) == (whole, None) and read(many, step) == (whole, None)
    assert read(b"", step) == ([], None)
    found, broken = read(one[: len(one) // 2], step)
    closed = [f for f in found if f[1]]
    assert closed == whole[: len(closed)] and 20 < len(closed) < 40 and broken.offset == len(one) // 2
    assert not found[-1][1] and given[len(closed)].startswith(found[-1][0])
    # Everything decompressed before a bad checksum is given out.
    found, broken = read(one[:-8] + bytes(b ^ 1 for b in one[-8:-4]) + one[-4:], step)
    assert found == whole and "incorrect data check" in str(broken)
    found, broken = read(many[:-600] + b"trailing junk", step)
    assert found == whole and "incorrect header check" in str(broken)


def collections(folder):
    """Files of 40 articles: whole and plain, whole and gzip, cut, damaged, empty, unclosed."""
    given = texts(40, 3)
    body = ("<all>" + "\n".join(given) + "</all>").encode()
    packed = gzip.compress(body)
    folder.mkdir()
    (folder / "plain.xml").write_bytes(body)
    (folder / "whole one.xml.gz").write_bytes(packed)
    (folder / "cut.xml.gz").write_bytes(packed[: len(packed) // 2])
    (folder / "bad.xml.gz").write_bytes(packed[:-6] + b"abcdef")
    (folder / "empty.xml.gz").write_bytes(b"")
    (folder / "open.xml.gz").write_bytes(gzip.compress(body[: body.rindex(b"</body>")]))
    return given


def summary(good, bad):
    name = lambda r: os.path.basename(r["source_file"]).replace("%20", " ")
    counts = {}
    for r in good.collect():
        counts[name(r)] = counts.get(name(r), 0) + 1
    return counts, sorted((name(r), re.sub("[0-9]+", "N", r["error"])[:16], bool(r["xml"])) for r in bad.collect())


def test_damaged_collections_in_both_jobs(spark, tmp_path):
    collections(tmp_path / "in")
    source, output = str(tmp_path / "in"), str(tmp_path / "out")
    rows = articles.extract_articles(articles.read_article_collection(spark, source))
    batch = summary(*articles.split_quarantine(rows))
    article_stream.convert_new_files(spark, source, output, str(tmp_path / "progress")).awaitTermination()
    assert summary(*article_stream.read_converted(spark, output)) == batch
    counts, broken = batch
    assert counts["plain.xml"] == counts["whole one.xml.gz"] == counts["bad.xml.gz"] == 40
    assert 10 < counts["cut.xml.gz"] < 30 and counts["open.xml.gz"] == 39
    assert [b[0] for b in broken] == ["bad.xml.gz", "cut.xml.gz", "open.xml.gz"]
    assert [b[1] for b in broken[:2]] == ["broken at byte N"] * 2 and broken[1][2] and not broken[0][2]


@pytest.mark.parametrize("by_path", [True, False])
def test_files_that_spark_hands_over_read_alike(spark, tmp_path, by_path):
    collections(tmp_path / "in")
    found = articles.collection_articles(spark, spark.read, str(tmp_path / "in"), by_path, spread=3)
    assert found.filter("broken is null").count() > 150 and found.filter("broken is not null").count() == 2


def test_a_read_that_fails_fails_the_job(spark, tmp_path):
    collections(tmp_path / "in")
    rows = articles.read_article_collection(spark, str(tmp_path / "in"))
    (tmp_path / "in" / "cut.xml.gz").unlink()
    with pytest.raises(Exception, match="cut.xml.gz"):
        rows.count()


def test_file_names_as_spark_gives_them():
    for name in ("/a/b c", "file:/a/b c", "file:///a/b c"):
        assert streams.filesystem_of(name)[1] == "/a/b c"
