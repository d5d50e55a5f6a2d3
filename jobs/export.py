"""Give a plain (word, vector) table positions and lengths.

spark-submit jobs/export.py --input vectors/ --articles articles/ --output model/

Counts for the order of positions come from the articles the vectors were
trained on; without them words are ordered alphabetically.
"""

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from termspace.operators.vocabulary import vocabulary  # noqa: E402
from termspace.plans.training import corpus, tokenized  # noqa: E402
from termspace.session import session  # noqa: E402
from termspace.sources import vectors  # noqa: E402


def main(args: argparse.Namespace) -> None:
    spark = session("termspace-export")
    plain = vectors.read_vectors(spark, args.input)
    if args.articles:
        words = tokenized(corpus(spark.read.parquet(args.articles)))
        counts = vocabulary(words, min_count=1).join(plain.select("word"), "word", "left_semi")
    else:
        counts = plain.select("word", F.lit(0).cast("long").alias("count"))
    vectors.write_vectors(vectors.export_vectors(plain, counts), args.output)


if __name__ == "__main__":
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--articles")
    main(parser.parse_args())
