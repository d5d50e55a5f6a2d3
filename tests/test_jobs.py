"""The jobs as a user submits them, one after the other."""

import importlib.util
import os
from argparse import Namespace

from test_articles import FRONT, collection

JOBS = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "jobs")


def job(name):
    spec = importlib.util.spec_from_file_location(f"job_{name}", os.path.join(JOBS, f"{name}.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_from_xml_to_replies(spark, tmp_path):
    path = {n: str(tmp_path / n) for n in ("xml", "articles", "json", "model", "again", "mentions", "replies", "seen")}
    os.mkdir(path["xml"])
    words = "king queen man woman child crown castle knight horse sword"
    made = [
        f"<article>{FRONT.format(doi=f'10.1/{i}', kwds='')}<body><p>{words}</p></body></article>" for i in range(30)
    ]
    (tmp_path / "xml" / "a.xml").write_text(collection(*made, "<article><broken></article>"))

    extract = {"source": "CORE", "input": path["xml"], "style": None, "compressed": False, "spread": None}
    job("extract").main(Namespace(**extract, output=path["articles"], checkpoint=None, json=False))
    job("extract").main(Namespace(**extract, output=path["json"], checkpoint=None, json=True))
    assert spark.read.parquet(path["articles"]).groupBy("status").count().collect()
    assert spark.read.parquet(path["json"] + "-quarantine").count() == 1

    settings = {"sample": None, "vectorSize": 8, "minCount": 20, "maxIter": 1, "numPartitions": 1}
    settings |= {"windowSize": 5, "stepSize": 0.025, "seed": 42}
    job("train").main(Namespace(input=path["articles"], output=path["model"], json=False, **settings))
    model = path["model"] + "/df.parquet"
    trained = spark.read.parquet(model)
    assert {"king", "queen", "first"} <= {r["word"] for r in trained.collect()}
    job("train").main(Namespace(input=path["json"], output=path["json"] + "-model", json=True, **settings))
    assert spark.read.parquet(path["json"] + "-model/df.parquet").count() == trained.count()

    job("export").main(Namespace(input=model, output=path["again"], articles=path["articles"]))
    exported = spark.read.parquet(path["again"] + "/df.parquet")
    assert exported.select("word", "idx", "count").exceptAll(trained.select("word", "idx", "count")).count() == 0

    rows = [(1, "2024-01-01 00:00:00", "ann", "@bot king"), (2, "2024-01-01 00:00:00", "bob", "@bot king - man + zz")]
    df = spark.createDataFrame(rows, "id long, ts string, author string, text string")
    df.write.json(path["mentions"])
    answer = {"vectors": model, "name": "bot", "input": path["mentions"], "replies": path["replies"], "link": "l/"}
    for _ in range(2):
        job("answer").main(Namespace(**answer, stream=False))
    replies = {r["in_reply_to"]: r["reply"] for r in spark.read.parquet(path["replies"]).collect()}
    assert len(replies) == 2 and replies[1].startswith("@ann Related terms to king: ")
    assert replies[2] == "@bob Sorry, zz not in my vocabulary."
