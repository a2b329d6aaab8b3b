from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.functions import text as tx
from pageloom.operators import clustering, pagerank, search, tfidf, topics
from pageloom.plans.staging import scratch_path
from pageloom.sources import lines as ln
from pageloom.sources import wiki_xml as wx


def links(spark, *pairs):
    return spark.createDataFrame(list(pairs), "src string, dst string")


def test_one_round_of_ranks(spark):
    got = pagerank.ranks(links(spark, ("a", "b"), ("a", "c"), ("b", "c"), ("a", "b")), 1)
    assert {r["page"]: round(r["rank"], 9) for r in got.collect()} == {"b": 0.6, "c": 1.4}


def plain_ranks(edges, rounds):
    out = {}
    for a, b in set(edges):
        out.setdefault(a, set()).add(b)
    ranks = {a: 1.0 for a in out}
    for _ in range(rounds):
        sums = {}
        for a, targets in out.items():
            for b in targets if a in ranks else ():
                sums[b] = sums.get(b, 0.0) + ranks[a] / len(targets)
        ranks = {b: 0.2 + 0.8 * s for b, s in sums.items()}
    return ranks


@pytest.mark.parametrize("per_split,per_bucket", [(2, 3), (2, 1_000_000), (100_000, 2)])
def test_a_split_hub_or_many_buckets_change_nothing(spark, per_split, per_bucket):
    edges = [("h", f"p{i}") for i in range(9)] + [(f"p{i}", "h") for i in range(4)] + [("p1", "p2")]
    got = pagerank.ranks(links(spark, *edges), 7, links_per_split=per_split, cut_every=3, links_per_bucket=per_bucket)
    expected = plain_ranks(edges, 7)
    assert {r["page"]: pytest.approx(r["rank"]) for r in got.collect()} == expected


def test_links_between(spark, rows):
    table = links(spark, ("a", "b"), ("a", "x"), ("x", "y"))
    chosen = spark.createDataFrame([("a",), ("b",)], "page string")
    assert rows(pagerank.links_between(table, chosen)) == {("a", "b")}
    assert rows(pagerank.links_between(table, chosen, either=True), "src", "dst") == {
        ("a", "b"),
        ("a", "x"),
    }


def test_size_band_is_strict(spark, rows):
    sizes = {"one": 1, "two": 2, "most": 49, "many": 50}
    member = spark.createDataFrame(
        [(i, c) for c, n in sizes.items() for i in range(n)], "page_id long, cluster string"
    )
    assert rows(topics.size_band(member)) == {("two", 2), ("most", 49)}


def test_top_terms_cut_ties_by_word(spark):
    centres = spark.createDataFrame(
        [("c", f"w{i:03d}", 1.0) for i in range(101)], "cluster string, word string, weight double"
    )
    got = topics.top_terms(centres).collect()
    assert len(got) == 100 and "w100" not in {r["word"] for r in got}


def test_topics_to_search(spark, rows):
    tf = spark.createDataFrame(
        [(1, "sun", 3), (2, "sun", 2), (2, "sea", 1), (3, "fog", 4)],
        "page_id long, word string, n long",
    )
    weights = tf.select("page_id", "word", F.col("n").cast("double").alias("weight"))
    assignment = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "page_id long, cluster int")
    titles = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], "page_id long, title string")
    model = topics.build_topics(tf, weights, assignment, titles, min_overlap=2)
    assert rows(model.kept) == {(0, 2)}  # a single page is no topic
    assert rows(model.catalog()) == {(0, "sun,sea", 2, "A | B")}
    search.register(model.pairs())
    assert rows(search.titles_for(spark, "sea"), "title") == {("A",), ("B",)}
    assert rows(search.titles_for(spark, "x' OR '1'='1"), "title") == set()
    assert ("Topic: sun", "A") in rows(search.labelled(spark))
    with pytest.raises(ValueError):
        topics.page_topics(model.overlaps, 0)


def test_smoothed_centroids_shuffle_no_row_per_page_and_word(spark):
    texts = [(1, "a b b"), (2, "a c"), (2, "a"), (3, "d"), (4, None), (None, "a")]
    pages = spark.createDataFrame(texts, "page_id long, text string")
    placed = [(1, "x"), (1, "y"), (2, "x"), (2, "x"), (4, "y"), (None, "x"), (3, None)]
    assignment = spark.createDataFrame(placed, "page_id long, cluster string")
    counts = tfidf.count_corpus(pages, tx.ws_words)
    beside = tfidf.count_corpus(pages, tx.ws_words, beside=topics.clusters_of(assignment))
    plain = topics.centroids(tfidf.smoothed(counts), assignment).collect()
    plain = {(r["cluster"], r["word"]): pytest.approx(r["weight"]) for r in plain}
    assert len(plain) == 5
    for c in (counts, beside):
        got = topics.smoothed_centroids(c, assignment).collect()
        assert {(r["cluster"], r["word"]): r["weight"] for r in got} == plain
    many = spark.range(400).selectExpr("id page_id", "repeat('a b c d e ', 5) text")
    assigned = many.selectExpr("page_id", "page_id % 2 cluster")
    staged = tfidf.count_corpus(many, tx.ws_words, beside=topics.clusters_of(assigned))
    plan = topics.smoothed_centroids(staged, assigned)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(page_id" not in plan


def test_lloyd_keeps_an_empty_cluster(spark):
    rng = np.random.default_rng(0)
    data = np.concatenate([rng.normal(0, 0.1, (20, 3)), rng.normal(5, 0.1, (20, 3))])
    df = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(data)], "id long, features array<float>"
    )
    got = clustering.lloyd(df, [data[0], data[20], [99.0, 99.0, 99.0]], 4)
    assert {r["id"]: r["cluster"] for r in got.collect()} == {
        i: int(i >= 20) for i in range(40)
    }


def test_kmeans_copes_with_copies_among_the_centres(spark):
    df = spark.createDataFrame(
        [(i, [float(i % 2), 1.0]) for i in range(12)], "page_id long, features array<double>"
    )
    assigned, centres = clustering.kmeans(clustering.to_vectors(df, "features"), k=6, seeds=(1, 2, 3))
    assert assigned.count() == 12 and 1 <= len(centres) <= 6


def write_lines(spark, *lines):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_tab_corpus(spark, rows):
    path = write_lines(spark, "7 A title\ttext\tmore", "8 No text", "9\tx")
    assert rows(ln.parse_tab_corpus(ln.read_lines(spark, path))) == {
        (7, "A title", "text"),
        (8, "No text", None),
        (9, None, "x"),
    }


def test_count_lines(spark, rows):
    path = write_lines(
        spark, "id 12", "title T", "idea,of,a,b,c\t1", "a,b\tx", "no tab", " a,b\t2 ", "id 5\t3"
    )
    assert rows(ln.parse_count_lines(ln.read_lines(spark, path))) == {
        ("idea,of,a,b,c", 1),
        ("a,b", 2),
        ("id 5", 3),
    }


def test_edge_lines(spark, rows):
    path = write_lines(spark, "a b", "a\tb extra", "lonely", "b  a")
    assert rows(ln.parse_edge_lines(ln.read_lines(spark, path))) == {("a", "b"), ("b", "a")}


def test_topic_table(spark, rows):
    path = write_lines(spark, "sun,A", "sea,")
    assert rows(ln.read_topic_table(spark, path)) == {("sun", "A"), ("sea", None)}


PAGE = (
    "<page><title>{t}</title><ns>0</ns><id>{i}</id><revision><id>90{i}</id>"
    "<contributor><username>u</username><id>80{i}</id></contributor>"
    "<text xml:space='preserve'>{x}</text></revision></page>"
)


def test_page_chunks_span_lines(spark, rows):
    first = PAGE.format(t="Café", i=1, x="a &lt;b&gt;\n second line")
    path = write_lines(spark, first + PAGE.format(t="Two", i=2, x=""), "junk", PAGE.format(t="Three", i=3, x="c"))
    pages = wx.read_page_chunks(spark, path)
    assert rows(pages, "page_id", "title", "revision_id", "contributor_id") == {
        (1, "Café", 901, 801),
        (2, "Two", 902, 802),
        (3, "Three", 903, 803),
    }
    assert "second line" in pages.where("page_id = 1").first()["text"]
    heads = rows(wx.header_rows(pages), "kind", "value")
    assert ("title", "Caf") in heads and ("id", "801") in heads


def test_a_page_with_several_revisions(spark, rows):
    two = PAGE.format(t="T", i=1, x="new words").replace(
        "<revision>", "<revision><id>701</id><text>old ones</text></revision><revision>"
    )
    pages = wx.parse_page_lines(spark.createDataFrame([(two,)], "value string"))
    assert rows(pages, "text", "revision_id") == {("new words", 901)}
    assert rows(wx.revision_texts(pages), "text") == {("old ones",), ("new words",)}
    assert {v for k, v in rows(wx.header_rows(pages), "kind", "value") if k == "id"} == {
        "1", "701", "901", "801",
    }


def test_malformed_page_line_gives_nulls(spark):
    lines = spark.createDataFrame([("<page><id>1</id>",), (PAGE.format(t="T", i=4, x="x"),)], "value string")
    got = wx.parse_page_lines(lines).collect()
    assert [r["page_id"] for r in got][1] == 4 and got[0]["title"] is None


def test_clusters_on_the_row_are_those_of_the_assignment(spark, monkeypatch):
    monkeypatch.setattr(topics, "HELD_ROWS", 3)
    texts = [(1, "a b b", "x"), (2, "a c", "y"), (2, "a", "x"), (3, "d", None), (4, None, "y"), (None, "a", "x"), (5, "", "x")]
    pages = spark.createDataFrame(texts, "page_id long, text string, section string")
    assignment = pages.selectExpr("page_id", "section cluster")
    named = topics.with_clusters(pages, F.col("section"))
    want = {r["page_id"]: r["clusters"] for r in topics.clusters_of(assignment).collect() if r["page_id"]}
    assert all(r["clusters"] == want.get(r["page_id"]) for r in named.collect()) and named.count() == 7
    old = tfidf.count_corpus(pages, tx.ws_words, beside=topics.clusters_of(assignment))
    new = tfidf.count_corpus(named, tx.ws_words, also=("clusters",))
    plain = {tuple(r) for r in topics.smoothed_centroids(old, assignment).collect()}
    assert {tuple(r) for r in topics.smoothed_centroids(new, assignment).collect()} == plain and len(plain) == 5


def test_centroids_shuffle_no_text_and_their_sums_once(spark):
    pages = spark.range(400).selectExpr("id page_id", "repeat('a b c d e ', 5) text", "'s' || id % 3 section")
    named = topics.with_clusters(pages, F.col("section"))
    counts = tfidf.count_corpus(named, tx.ws_words, also=("clusters",))
    assert "Exchange" not in named._jdf.queryExecution().executedPlan().toString()
    centres = topics.smoothed_centroids(counts, pages.selectExpr("page_id", "section cluster"))
    plan = centres._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "MapInArrow" in plan
    got = {(r["cluster"], r["word"]): r["weight"] for r in centres.collect()}
    assert len(got) == 15 and got["s0", "a"] == pytest.approx(0.0)
