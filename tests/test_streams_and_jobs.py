from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pageloom.functions.text import ws_words
from pageloom.operators import search, tfidf, vocabulary
from pageloom.plans import jobs
from pageloom.plans.staging import scratch_path, stage
from pageloom.streaming import jobs as stream
from pageloom.streaming.batches import BatchLog

SCHEMA = "page_id long, title string, text string"
BATCHES = [
    [(1, "A", "sun sun sea"), (2, "B", "sun sea sky")],
    [(3, "C", "fog fog"), (4, "D", "fog sun")],
]


def add_file(spark, folder, batch):
    spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def exact(spark, batch):
    counts = tfidf.count_corpus(spark.createDataFrame(batch, SCHEMA), ws_words)
    return {
        (r["page_id"], r["word"], round(r["weight"], 9)) for r in tfidf.smoothed(counts).collect()
    }


def test_batches_are_independent_and_restarts_add_nothing(spark):
    folder, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    checkpoint = scratch_path(spark, "checkpoint")
    for batch in BATCHES:
        add_file(spark, folder, batch)

    def run():
        arriving = stream.parquet_stream(
            spark, spark.read.parquet(folder).schema, folder, files_per_batch=1
        )
        stream.start(arriving, stream.tfidf_batches(out), checkpoint).awaitTermination()
        return stream.read_batches(spark, out, "weights")

    got = run()
    found = {(r["page_id"], r["word"], round(r["weight"], 9)) for r in got.collect()}
    assert found == exact(spark, BATCHES[0]) | exact(spark, BATCHES[1])
    assert got.select("batch_id").distinct().count() == 2
    assert run().count() == len(found)


def test_a_batch_by_interval(spark):
    folder, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    add_file(spark, folder, BATCHES[0])
    arriving = stream.parquet_stream(spark, spark.read.parquet(folder).schema, folder, None)
    work = stream.topic_batches(
        out, lambda b: b.select("page_id", F.lit(0).alias("cluster")), 1, show=True
    )
    query = stream.start(arriving, work, scratch_path(spark, "checkpoint"), "1 second")
    query.processAllAvailable()
    query.stop()
    assert stream.read_batches(spark, out, "catalog").select("batch_id", "words").collect() == [(0, "sky,sea,sun")]


def test_lookup_joins_arriving_topics(spark, rows):
    pairs = spark.createDataFrame([("sun", "A"), ("sun", "B"), ("sea", "A")], "topic string, title string")
    path = scratch_path(spark, "table")
    search.store(pairs, path)
    table = search.stored(spark, path)
    asked, out = scratch_path(spark, "asked"), scratch_path(spark, "found")
    spark.createDataFrame([("sun",), ("none",)], "value string").write.text(asked)
    stream.lookup(
        stream.line_stream(spark, asked), table, out, scratch_path(spark, "c")
    ).awaitTermination()
    assert rows(stream.read_batches(spark, out, "found"), "topic", "title") == {("sun", "A"), ("sun", "B")}


def big_table(spark, buckets=16):
    pairs = spark.range(40_000).select(
        F.concat(F.lit("w"), F.col("id") % 400).alias("topic"), F.concat(F.lit("T"), "id").alias("title")
    )
    hot = spark.range(20_000).select(F.lit("hot").alias("topic"), F.concat(F.lit("H"), "id").alias("title"))
    path = scratch_path(spark, "table")
    search.store(pairs.unionByName(hot), path, buckets, files=8)
    return search.stored(spark, path)


def scanned(df):
    """Rows and files that the scans of a plan that was run have read."""
    todo, rows, files = [df._jdf.queryExecution().executedPlan()], 0, 0
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.getClass().getSimpleName():
            node = node.executedPlan()
        if "QueryStage" in node.getClass().getSimpleName():
            node = node.plan()
        if "FileSourceScan" in node.getClass().getSimpleName():
            rows += node.metrics().apply("numOutputRows").value()
            files += node.metrics().apply("numFiles").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return rows, files


def test_a_search_reads_little(spark):
    table = big_table(spark)
    all_files = len(table.inputFiles())
    for topic, n in (("w7", 100), ("hot", 20_000), ("none", 0)):
        found = search.stored_titles(table, topic, 16)
        assert len(found.collect()) == n
        read, files = scanned(found)
        assert n <= read <= n + 20_000 and files < all_files / 2
    found = search.stored_titles(table, "w7", 16)
    found.collect()
    assert scanned(found)[0] < 6_000  # of 60,000


def test_a_lookup_reads_the_asked_buckets(spark, rows):
    table = big_table(spark)
    asked = stage(spark.createDataFrame([("w7",), ("w7",), ("none",), (None,)], "topic string"), "asked")
    found = search.stored_matches(asked, table, 16)
    assert len(found.collect()) == 200
    plan = found._jdf.queryExecution().executedPlan().toString()
    numbers = asked.select(search.bucket_of(F.col("topic"), 16).alias("b")).where("topic IS NOT NULL").distinct()
    assert "PartitionFilters" in plan and numbers.count() <= 2
    read = table.where(F.col("bucket").isin([r["b"] for r in numbers.collect()]))
    assert scanned(found)[0] <= read.count() + 8
    none = search.stored_matches(asked.limit(0), table, 16)
    assert none.collect() == []


def test_a_failed_batch_shows_nothing(spark, rows):
    out = scratch_path(spark, "out")
    log = BatchLog(spark, out)
    good = spark.createDataFrame([(1,)], "x int")
    bad = good.select(F.raise_error(F.lit("half way")).cast("int").alias("x"))
    assert log.read("a", good.schema).collect() == []
    with pytest.raises(Exception, match="half way"):
        log.commit(0, a=good, b=bad)
    assert log.folders("a") == [] and not log.committed(0)
    assert log.commit(0, a=good, b=good) and not log.commit(0, a=good, b=good)
    assert log.commit(10, a=good.union(good))
    assert rows(log.read("a")) == {(1, 0), (1, 10)} and log.read("a").count() == 3
    assert log.read("b", good.schema).collect() == [(1, 0)]


def test_sketches_of_parts_add_up(spark):
    texts = [("a", " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(k, k + 4000)))
             for k in range(0, 16_000, 2000)] + [("b", "one two"), ("b", None), ("c", "")]
    pages = spark.createDataFrame(texts, "part string, text string")
    found = vocabulary.compared(vocabulary.sketches(pages, "part"), vocabulary.exact(pages, "part"), "part")
    got = {r["part"]: (r["n_words"], r["within"]) for r in found.collect()}
    assert got == {"a": (18_000, True), "b": (2, True), "all": (18_000, True)}


def wiki_lines(spark):
    page = "<page><title>T{i}</title><ns>{ns}</ns><id>{i}</id><revision><id>9</id><text>{x}</text></revision></page>"
    texts = {1: "red red green", 2: "red red green", 3: "blue", 4: "red red green teal", 5: "amber gold"}
    path = scratch_path(spark, "wiki")
    lines = [(page.format(i=i, ns=0 if i < 5 else 4, x=x),) for i, x in texts.items()]
    spark.createDataFrame(lines, "value string").write.text(path)
    return path


def test_page_jobs(spark, rows):
    path = wiki_lines(spark)
    best = jobs.tfidf_job(spark, path, scratch_path(spark, "o")).first()
    assert (best["title"], best["word"]) == ("T3", "blue")
    report = jobs.component_job(spark, path, 0.05, scratch_path(spark, "o"))
    assert rows(report, "component", "n_pages", "title") == {(1, 2, "T1"), (1, 2, "T2")}
    links = scratch_path(spark, "links")
    spark.createDataFrame([("1 2",), ("2 1",), ("2 3",)], "value string").write.text(links)
    ranked = jobs.pagerank_job(spark, path, links, 3, scratch_path(spark, "o"), threshold=0.05)
    assert rows(ranked, "page", "title") == {("1", "T1"), ("2", "T2")}
    grams = jobs.gram_job(spark, path, scratch_path(spark, "o"), n=3, k=1)
    assert rows(grams) == {("red,red,green", 3)}


def test_topic_jobs(spark):
    folder = scratch_path(spark, "tab")
    lines = [f"{i} T{i}\t" + " ".join(["sun", "sea"] * 3 if i % 2 else ["fog", "ice"] * 3) for i in range(8)]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(folder)
    pairs = scratch_path(spark, "pairs")
    jobs.topic_job(spark, folder, scratch_path(spark, "cat"), pairs, 2, k=2)
    titles = {r["title"] for r in jobs.search_job(spark, pairs, scratch_path(spark, "s"), "sun").collect()}
    assert titles == {"T1", "T3", "T5", "T7"}
    every = jobs.search_job(spark, pairs, scratch_path(spark, "s"))
    assert every.where(F.col("label") == "Topic: fog").count() == 4
    out = scratch_path(spark, "stream")
    query = jobs.topic_stream_job(
        spark, folder, out, 2, scratch_path(spark, "ck"), k=2, interval=None
    )
    query.awaitTermination()
    assert stream.read_batches(spark, out, "catalog").count() == 2
    weights = jobs.weights_job(spark, folder, scratch_path(spark, "w"))
    assert weights.count() == 16
    top = jobs.matrix_job(spark, folder, scratch_path(spark, "m"), k=2)
    assert {"page_id", "word", "weight", "rank", "cluster"} == set(top.columns)


def test_a_stored_table_is_cut_by_its_rows(spark, monkeypatch):
    pairs = spark.range(1000).selectExpr("concat('t', id % 3) topic", "cast(id as string) title")
    monkeypatch.setattr(search, "ROWS_PER_RANGE", 50)
    path = scratch_path(spark, "cut")
    search.store(pairs, path)
    table = search.stored(spark, path)
    assert len(table.inputFiles()) >= 15
    assert sorted(map(tuple, table.select("topic", "title").collect())) == sorted(map(tuple, pairs.collect()))
    asked = spark.createDataFrame([("t1",), ("none",)], "topic string")
    assert search.stored_matches(asked, table).count() == 333
