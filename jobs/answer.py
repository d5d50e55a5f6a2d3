"""Answer messages: once for a table of them, or as they arrive.

spark-submit jobs/answer.py --vectors model/df.parquet --name bot --input mentions/ --replies replies/
    [--stream --checkpoint progress/ --every "60 seconds"]

Messages are newline JSON: id, ts, author, text. Those that begin with @NAME
get one reply each; a message that has a reply already is left out.
"""

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from termspace.schemas import MENTIONS  # noqa: E402
from termspace.session import session  # noqa: E402
from termspace.sources.vectors import read_vectors  # noqa: E402
from termspace.streaming import mentions  # noqa: E402


def main(args: argparse.Namespace) -> None:
    spark = session("termspace-answer")
    vectors = read_vectors(spark, args.vectors)
    if not args.stream:
        batch = spark.read.schema(MENTIONS).json(args.input).dropDuplicates(["id"])
        mentions.append_replies(batch, vectors, args.name, args.replies, args.link)
        return
    if not args.checkpoint:
        raise SystemExit("--stream needs --checkpoint")
    query = mentions.answer_stream(
        mentions.read_mentions(spark, args.input),
        vectors,
        args.name,
        args.replies,
        args.checkpoint,
        {"processingTime": args.every},
        args.link,
    )
    query.awaitTermination()


if __name__ == "__main__":
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--vectors", required=True)
    parser.add_argument("--name", required=True, help="handle without @")
    parser.add_argument("--input", required=True)
    parser.add_argument("--replies", required=True)
    parser.add_argument("--link", default=mentions.LINK_BASE, help="begin of message addresses")
    parser.add_argument("--stream", action="store_true")
    parser.add_argument("--checkpoint")
    parser.add_argument("--every", default=mentions.POLL)
    main(parser.parse_args())
