"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores of the
local session (default 8), ``BENCH_QUERIES`` an optional comma-separated choice.
Every query is run to its last row.  The session is warmed up with one query
that is not timed.  Before that, also untimed, the tables are written once as
several files each, as the given ones have a single row group, which one task reads
alone; ``BENCH_FILES=0`` leaves them as they are.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

from pyspark.sql import Observation
from pyspark.sql import functions as F

from pageloom.catalog.queries import all_queries
from pageloom.plans.session import local_session
from pageloom.plans.staging import drop_staged, shared_folder

HEADLINES = [
    "tokens_ascii",
    "term_freq",
    "doc_freq",
    "corpus_stats",
    "ngram5_top",
    "ngram3_top",
    "kv_reduce",
    "xml_pages",
    "tfidf_ratio",
    "tfidf_smoothed",
    "tfidf_hashed",
    "tfidf_top",
    "term_weights",
    "doc_top_terms",
    "doc_weight_list",
    "pair_euclid",
    "pair_symdiff",
    "cc_labels",
    "cc_shortest",
    "pagerank_ranks",
    "pagerank_top5",
    "kmeans_lloyd",
    "kmeans_ml",
    "cluster_top_terms",
    "doc_topic_overlap",
    "topic_catalog",
    "topic_title_pairs",
    "topic_search_sql",
    "topic_any_catalog",
    "topic_any_pairs",
    "topic_any_search",
    "stream_tfidf",
    "stream_topics",
    "stream_any_topics",
]


def in_files(spark, sf_dir: str, files: int) -> str:
    """The tables with as many files each as given; rows keep to ranges of their first column."""
    folder = f"{shared_folder(spark)}/bench-tables-{uuid.uuid4().hex[:12]}"
    for name in sorted(os.listdir(sf_dir)):
        table = spark.read.parquet(f"{sf_dir}/{name}")
        table.repartitionByRange(files, table.columns[0]).write.parquet(f"{folder}/{name}")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINES
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    files = int(os.environ.get("BENCH_FILES", str(2 * cpus)))
    tables = in_files(spark, sf_dir, files) if files else sf_dir
    registered["doc_len"](spark, tables).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in chosen:
        start, seen = time.perf_counter(), Observation()
        result = registered[name](spark, tables).observe(seen, F.count(F.lit(1)).alias("n"))
        result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        rows[name] = seen.get["n"]
        print(f"{name}: {seconds[name]} ({rows[name]} rows)", file=sys.stderr, flush=True)
        drop_staged(spark)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows": rows,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
