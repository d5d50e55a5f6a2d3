"""Convert article XML to the article table.

spark-submit jobs/extract.py --source CORE --input xml/ --output articles/

CORE and EUPMC deliver collections, PLOS one article per file (--compressed:
one article per member of tar.gz archives). With --checkpoint only files that
are new since the last run are converted. Articles go to OUTPUT (or its
partition status=article), malformed input to a quarantine table.
"""

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from termspace.schemas import JATS_STYLE  # noqa: E402
from termspace.session import remove, scratch_path, session, settle  # noqa: E402
from termspace.sources import articles, records  # noqa: E402
from termspace.streaming.articles import convert_new_files  # noqa: E402

COLLECTIONS = ("CORE", "EUPMC")


def main(args: argparse.Namespace) -> None:
    spark = session("termspace-extract")
    style = JATS_STYLE
    if args.style:
        style = json.loads("\n".join(r["value"] for r in spark.read.text(args.style).collect()))
    kind = "collection" if args.source in COLLECTIONS else "files"
    if args.compressed and kind == "collection":
        raise SystemExit("--compressed is for single articles")
    packed = "gz" if args.compressed else None
    if args.checkpoint:
        if args.json:
            raise SystemExit("--checkpoint writes parquet; leave out --json")
        convert_new_files(
            spark, args.input, args.output, args.checkpoint, kind, style, compressed=packed, spread=args.spread
        ).awaitTermination()
        return
    if kind == "collection":
        raw = articles.read_article_collection(spark, args.input, args.spread)
    else:
        raw = articles.read_article_files(spark, args.input, packed, args.spread)
    rows = articles.extract_articles(raw, style)
    if args.json:
        work = scratch_path(spark, "extract")
        good, bad = articles.split_quarantine(settle(rows, "rows", work))
        records.write_scalar_articles(good, args.output)
        bad.write.mode("append").parquet(args.output.rstrip("/") + "-quarantine")
        remove(spark, work)
        return
    status = F.when(F.col("error").isNull(), "article").otherwise("quarantine")
    rows.withColumn("status", status).write.mode("append").partitionBy("status").parquet(args.output)


if __name__ == "__main__":
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--source", choices=[*COLLECTIONS, "PLOS"], required=True)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--style", help="JSON file, column -> path; JATS if not given")
    parser.add_argument("--compressed", action="store_true", help="PLOS: the input files are tar.gz archives")
    parser.add_argument("--checkpoint", help="folder that remembers the files converted so far")
    parser.add_argument("--json", action="store_true", help="write newline JSON instead of parquet")
    parser.add_argument("--spread", type=int, help="shuffle the articles of compressed collections and archives to so many tasks")
    main(parser.parse_args())
