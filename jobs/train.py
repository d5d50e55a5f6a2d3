"""Train word vectors on an article table and export them.

spark-submit jobs/train.py --input articles/ --output model/

The vector table, with positions and lengths, is OUTPUT/df.parquet.
"""

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from termspace.plans import training  # noqa: E402
from termspace.session import remove, scratch_path, session  # noqa: E402
from termspace.sources import records, vectors  # noqa: E402


def main(args: argparse.Namespace) -> None:
    spark = session("termspace-train")
    if args.json:
        articles = records.read_articles(spark, args.input)
    else:
        articles = spark.read.parquet(args.input)
        if "status" in articles.columns:
            articles = articles.filter("status = 'article'")
    settings = training.Training(
        vector_size=args.vectorSize,
        min_count=args.minCount,
        max_iter=args.maxIter,
        num_partitions=args.numPartitions,
        window_size=args.windowSize,
        step_size=args.stepSize,
        seed=args.seed,
    )
    work = scratch_path(spark, "training")
    _, trained = training.train_word2vec(training.corpus(articles, args.sample), settings, work)
    vectors.write_vectors(trained, args.output)
    remove(spark, work)


if __name__ == "__main__":
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--json", action="store_true", help="the input is newline JSON")
    parser.add_argument("--sample", type=float, help="share of the articles to train on, e.g. 0.01")
    parser.add_argument("--vectorSize", type=int, default=500)
    parser.add_argument("--minCount", type=int, default=20)
    parser.add_argument("--maxIter", type=int, default=1)
    parser.add_argument("--numPartitions", type=int, help="tasks that train at the same time; derived from tokens and vocabulary if not given")
    parser.add_argument("--windowSize", type=int, default=5)
    parser.add_argument("--stepSize", type=float, default=0.025)
    parser.add_argument("--seed", type=int, default=42)
    main(parser.parse_args())
