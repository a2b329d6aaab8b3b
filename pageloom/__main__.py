"""Command line for the jobs: ``python -m pageloom <job> ...`` or ``spark-submit``.

Without a master from ``spark-submit`` a local session is used.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from pageloom.plans import jobs
from pageloom.plans.session import local_session
from pageloom.plans.staging import drop_staged


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="pageloom")
    sub = parser.add_subparsers(dest="job", required=True)


    def job(name: str, *paths: str, **options) -> None:
        command = sub.add_parser(name)
        for path in paths:
            command.add_argument(path)
        for option, (kind, default) in options.items():
            name = "--" + option.replace("_", "-")
            command.add_argument(name, type=kind, default=default)

    job("ngrams", "input", "output", n=(int, 5), k=(int, 5))
    job("tfidf", "input", "output")
    job("components", "input", "output", threshold=(float, 0.3), metric=(str, "euclid"))
    job("pagerank", "input", "links", "output", rounds=(int, 10), threshold=(float, 0.3))
    job("weights", "input", "output")
    job("topics", "input", "catalog", "pairs", min_overlap=(int, 30), k=(int, 50))
    job(
        "topic-stream", "input", "output", "checkpoint",
        min_overlap=(int, 30), k=(int, 50), interval=(str, "15 seconds"),
    )
    job("search", "table", "output", topic=(str, None))
    job("lookup-stream", "table", "input", "output", "checkpoint", interval=(str, "3 seconds"))
    job("matrix", "input", "output", k=(int, 50))
    return parser


def main() -> None:
    args = _parser().parse_args()
    submitted = "SPARK_ENV_LOADED" in os.environ
    spark = SparkSession.builder.getOrCreate() if submitted else local_session(args.job)
    try:
        if args.job == "ngrams":
            jobs.gram_job(spark, args.input, args.output, args.n, args.k)
        elif args.job == "tfidf":
            jobs.tfidf_job(spark, args.input, args.output)
        elif args.job == "components":
            jobs.component_job(spark, args.input, args.threshold, args.output, args.metric)
        elif args.job == "pagerank":
            jobs.pagerank_job(
                spark, args.input, args.links, args.rounds, args.output, args.threshold
            )
        elif args.job == "weights":
            jobs.weights_job(spark, args.input, args.output)
        elif args.job == "topics":
            jobs.topic_job(
                spark, args.input, args.catalog, args.pairs, args.min_overlap, args.k
            )
        elif args.job == "topic-stream":
            jobs.topic_stream_job(
                spark, args.input, args.output, args.min_overlap, args.checkpoint,
                args.k, args.interval,
            ).awaitTermination()
        elif args.job == "search":
            jobs.search_job(spark, args.table, args.output, args.topic)
        elif args.job == "lookup-stream":
            jobs.lookup_stream_job(
                spark, args.table, args.input, args.output, args.checkpoint, args.interval
            ).awaitTermination()
        else:
            jobs.matrix_job(spark, args.input, args.output, args.k)
    finally:
        drop_staged(spark)
        spark.stop()


if __name__ == "__main__":
    main()
