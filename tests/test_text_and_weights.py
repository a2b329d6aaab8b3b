from __future__ import annotations

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pageloom.functions import text as tx
from pageloom.operators import ngrams, terms, tfidf


def pages(spark, *texts):
    return spark.createDataFrame(
        [(i, t) for i, t in enumerate(texts)], "page_id long, text string"
    )


def test_ascii_words_lower_after_the_expression(spark):
    df = pages(spark, "It's Kelvin, ÀB c1d", "", None, "...")
    got = df.select("page_id", tx.ascii_words(F.col("text")).alias("w")).collect()
    assert got[0]["w"] == ["it", "s", "elvin", "b", "c", "d"]
    assert got[1]["w"] == [] and got[2]["w"] is None and got[3]["w"] == []


def test_other_tokenizers(spark):
    row = pages(spark, " a  B,\tc ").select(
        tx.ws_words(F.col("text")).alias("ws"), tx.space_words(F.col("text")).alias("sp")
    ).first()
    assert row["ws"] == ["a", "B,", "c"]
    assert row["sp"] == ["", "a", "", "B,\tc", ""]


def test_short_documents_have_no_ngram(spark):
    assert ngrams.gram_counts(pages(spark, "a b c d", "", None), 5).count() == 0


def test_compat_windows(spark, rows):
    got = rows(ngrams.gram_counts_compat(pages(spark, "a b c d e f g h", "a b c d e f")))
    assert got == {("b,c,d,ef", 8), ("c,d,e,fg", 8)}


def test_top_grams_order(spark):
    counted = spark.createDataFrame(
        [("b", 2), ("a", 2), ("c", 3), ("d", 1), ("e", 1), ("f", 1)], "gram string, n long"
    )
    got = [(r["gram"], r["n"]) for r in ngrams.top_grams(counted).collect()]
    assert got == [("e", 1), ("d", 1), ("b", 2), ("a", 2), ("c", 3)]


def test_n_counts_pages_that_are_filtered_out(spark):
    df = spark.createDataFrame(
        [(1, "0", "x"), (2, "4", "x y")], "page_id long, ns string, text string"
    )
    got = tfidf.ratio(tfidf.count_corpus(df, keep=F.col("ns") == "0")).collect()
    assert [(r["word"], round(r["weight"], 9)) for r in got] == [("x", round(math.log(2), 9))]


def test_empty_page_counts_in_n_only(spark, rows):
    counts = tfidf.count_corpus(pages(spark, "x x y", "", None))
    assert rows(counts.tf) == {(0, 3, "x", 2), (0, 3, "y", 1)}
    weights = {r["word"]: r["weight"] for r in tfidf.ratio(counts).collect()}
    assert weights["x"] == pytest.approx(2 / 3 * math.log(3))


def test_ml_vectors_equal_the_exact_weights(spark):
    df = pages(spark, "one two two three", "two four", "five one one", "")
    exact = tfidf.smoothed(tfidf.count_corpus(df, tx.ws_words)).collect()
    vectors = tfidf.hashed_vectors(df, num_features=1 << 18).collect()
    for page in range(4):
        mine = sorted(round(r["weight"], 9) for r in exact if r["page_id"] == page)
        theirs = sorted(round(float(v), 9) for v in next(
            r["features"].values for r in vectors if r["page_id"] == page))
        assert mine == theirs


def test_hashed_equals_exact_without_collisions(spark):
    counts = tfidf.count_corpus(pages(spark, "one two two", "two four"), tx.ws_words)
    exact = sorted(round(r["weight"], 9) for r in tfidf.smoothed(counts).collect())
    hashed = tfidf.hashed(counts, F.lit(1 << 30)).collect()
    assert sorted(round(r["weight"], 9) for r in hashed) == exact


def test_hashed_adds_up_colliding_words(spark):
    counts = tfidf.count_corpus(pages(spark, "a b c", "d"), tx.ws_words)
    got = tfidf.hashed(counts, F.lit(1)).collect()
    assert {(r["page_id"], r["bucket"]) for r in got} == {(0, 0), (1, 0)}


def test_words_of_the_matrix(spark, rows):
    df = pages(spark, "Don't  stop été an", "don't a\tb").withColumn("section", F.lit("s"))
    weights = tfidf.log2_ratio(tfidf.count_corpus(df, tfidf.log2_words))
    got = {(r["page_id"], r["word"]): r["weight"] for r in tfidf.term_rows(df, weights).collect()}
    assert got == {
        (0, "don't"): 0.0,
        (0, "stop"): pytest.approx(1 / 3),
        (0, "été"): pytest.approx(1 / 3),
        (1, "don't"): 0.0,
        (1, "a\tb"): pytest.approx(1 / 2),
    }
    wide = tfidf.term_matrix(df, weights, ["stop", "none"])
    assert {(r["page_id"], r["w_none"]) for r in wide.collect()} == {(0, 0.0), (1, 0.0)}


def test_token_weights_have_every_place(spark):
    df = pages(spark, "a b a", "b", "")
    got = tfidf.token_weights(df, F.lit(1 << 20)).collect()
    assert sorted((r["page_id"], r["pos"], r["word"]) for r in got) == [
        (0, 0, "a"), (0, 1, "b"), (0, 2, "a"), (1, 0, "b"),
    ]
    assert [r["weight"] for r in got if r["word"] == "a"] == pytest.approx([2 * math.log(2)] * 2)


def test_token_weights_of_a_repeated_page_and_no_token_shuffle(spark):
    rows = [(1, "a b a"), (1, "a"), (2, "b\tc"), (3, None), (None, "a")]
    df = spark.createDataFrame(rows, "page_id long, text string")
    got = tfidf.token_weights(df, F.lit(1 << 20))
    ln2, ln3 = math.log(6 / 3), math.log(6 / 2)
    want = [(1, 0, "a", 3 * ln3), (1, 0, "a", 3 * ln3), (1, 1, "b", ln2), (1, 2, "a", 3 * ln3)]
    want += [(2, 0, "b", ln2), (2, 1, "c", ln3)]
    found = sorted((r["page_id"], r["pos"], r["word"], round(r["weight"], 9)) for r in got.collect())
    assert found == [(*r[:3], round(r[3], 9)) for r in want]
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()


def test_compat_grams_without_counting_all(spark):
    texts = ["a b c d e f g h", "x b c d e f g", "x b c d ef g h", "a", None, "b c d e f g b c d e f g h"]
    df = pages(spark, *texts)
    counts = ngrams.gram_counts_compat(df)
    for k, width in ((1, 2), (3, 4), (50, 1 << 16)):
        want = [tuple(r) for r in ngrams.top_grams(counts, k).collect()]
        assert [tuple(r) for r in ngrams.most_frequent_compat(df, k, width).collect()] == want


def test_tied_weights_stay_in_the_page_top(spark):
    weights = spark.createDataFrame(
        [(1, f"w{i}", 1.0) for i in range(101)] + [(1, "low", 0.5)],
        "page_id long, word string, weight double",
    )
    assert tfidf.top_terms_per_page(weights).count() == 101


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab c,É\n", max_size=30), min_size=1, max_size=5))
def test_counts_add_up(spark, texts):
    df = pages(spark, *texts)
    tf = terms.term_freq(df).agg(F.sum("n")).first()[0] or 0
    lengths = terms.doc_len(df).agg(F.sum("n_words")).first()[0] or 0
    stats = terms.corpus_stats(df).first()
    assert tf == lengths == stats["n_tokens"]
    assert stats["n_pages"] == len(texts)


@pytest.mark.parametrize("width,fullest", [(1 << 16, 64), (64, 4), (8, 1)])
def test_most_frequent_grams_equal_those_of_all_counts(spark, monkeypatch, width, fullest):
    monkeypatch.setattr(ngrams, "FULLEST", fullest)
    rnd = random.Random(width)
    texts = [" ".join(rnd.choices("abcdefgh", k=rnd.choice([0, 2, 5, 60]))) for _ in range(40)]
    texts += [None, "", "a b c a b c", "x y z"]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id long, text string")
    for n, k in ((1, 3), (3, 5), (5, 40), (3, 10_000)):
        expected = ngrams.top_grams(ngrams.gram_counts(pages, n), k).collect()
        assert ngrams.most_frequent(pages, n, k, width).collect() == expected


def test_most_frequent_grams_of_nothing(spark):
    assert ngrams.most_frequent(spark.createDataFrame([], "page_id long, text string"), 5).count() == 0
