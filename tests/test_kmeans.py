from __future__ import annotations

import hashlib
import random

import pytest

from pageloom.functions.text import ws_words
from pageloom.operators import sparse_kmeans as sk
from pageloom.operators import terms, tfidf
from pageloom.operators.dictionary import word_numbers
from pageloom.plans.numbering import numbered


def plain(pages, k, rounds, seeds, unit):
    """Clusters and centroids of the best run, with dicts."""
    if unit:
        norms = {p: sum(w * w for w in v.values()) ** 0.5 for p, v in pages.items()}
        pages = {p: {w: x / norms[p] for w, x in v.items()} if norms[p] else {} for p, v in pages.items()}

    def far(a, b):
        keys = a.keys() | b.keys()
        return round(sum((a.get(w, 0.0) - b.get(w, 0.0)) ** 2 for w in keys), 6)

    best = None
    for seed in seeds:
        order = sorted(pages, key=lambda p: (hashlib.md5(f"{seed}:{p}".encode()).hexdigest(), p))
        centres = [dict(pages[p]) for p in order[:k]]
        for step in range(rounds + 1):
            own = {p: min((far(v, c), i) for i, c in enumerate(centres)) for p, v in pages.items()}
            if step == rounds:
                break
            for i in range(len(centres)):
                mine = [pages[p] for p in pages if own[p][1] == i]
                if mine:
                    words = {w for v in mine for w in v}
                    centres[i] = {w: sum(v.get(w, 0.0) for v in mine) / len(mine) for w in words}
        cost = round(sum(d for d, _ in own.values()), 3)
        if best is None or cost < best[0]:
            best = cost, {p: c for p, (_, c) in own.items()}, centres
    return best[1:]


def random_pages(n, seed):
    rnd = random.Random(seed)
    out = {}
    for p in range(n):
        size = rnd.choice([0, 1, 2, 10, 40])
        out[p] = {rnd.choice([rnd.randrange(8), rnd.randrange(300)]): rnd.uniform(0.1, 3) for _ in range(size)}
    out[n] = dict(out[3])  # a copy
    return out


@pytest.mark.parametrize("unit, k, common", [(False, 5, 32), (True, 4, 3), (False, 90, 1)])
def test_sparse_kmeans(spark, monkeypatch, unit, k, common):
    monkeypatch.setattr(sk, "COMMON", common)
    monkeypatch.setattr(sk, "BLOCK", 7)
    monkeypatch.setattr(sk, "ENTRIES", 13)
    pages = random_pages(60, 2)
    rows = [(p, w, x) for p, v in pages.items() for w, x in v.items()]
    weights = spark.createDataFrame(rows, "page_id long, word int, weight double")
    ids = spark.createDataFrame([(p,) for p in pages], "page_id long")
    clusters, centres = plain(pages, k, 4, (1, 2, 3), unit)
    got, found = sk.sparse_kmeans(weights, k, 4, (1, 2, 3), unit, ids, pages_per_part=9)
    assert {r["page_id"]: r["cluster"] for r in got.collect()} == clusters
    mine = {(r["cluster"], r["word"]): r["weight"] for r in found.collect()}
    theirs = {(i, w): x for i, c in enumerate(centres) for w, x in c.items()}
    assert mine.keys() == theirs.keys()
    assert all(mine[key] == pytest.approx(theirs[key]) for key in mine)


def test_a_round_moves_packets_and_no_pages(spark, monkeypatch):
    staged, plans, k, seeds = {}, [], 6, (1, 2)
    plain_stage = sk.stage

    def counted(df, name):
        if name == "kmeans-round":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        out = plain_stage(df, name)
        staged.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(sk, "stage", counted)
    rnd = random.Random(3)
    rows = [(p, rnd.randrange(5000), rnd.uniform(0.1, 3)) for p in range(80) for _ in range(100)]
    weights = spark.createDataFrame(rows, "page_id long, word int, weight double")
    sk.sparse_kmeans(weights, k, 2, seeds, pages_per_part=20)
    parts = 4
    # a packet for each part and block, and the size of each slot, not a row per slot and word
    assert max(staged["kmeans-round"][:-1]) <= parts * (parts + k * len(seeds))
    # neither the pages nor the words that a part wants are shuffled
    exchanges = plans[-1].count("Exchange hashpartitioning")
    assert exchanges == 2, plans[-1]


def test_parts_grow_before_there_are_more(spark, monkeypatch):
    monkeypatch.setattr(sk, "LEAST_PARTS", 3)
    monkeypatch.setattr(sk, "ENTRIES_PER_PART", 25)
    buckets = []
    plain_stage = sk.stage_bucketed

    def noted(df, name, n, key):
        buckets.append(n)
        return plain_stage(df, name, n, key)

    monkeypatch.setattr(sk, "stage_bucketed", noted)
    rows = [(p, w, 1.0 + p) for p in range(20) for w in range(p, p + 5)]
    weights = spark.createDataFrame(rows, "page_id long, word int, weight double")
    few = sk.sparse_kmeans(weights, 3, 2, pages_per_part=100)[0].collect()
    many = sk.sparse_kmeans(weights, 3, 2, pages_per_part=1)[0].collect()
    assert buckets[::2] == [4, 4] and sorted(few) == sorted(many)
    monkeypatch.setattr(sk, "ENTRIES_PER_PART", 1 << 21)
    assert sorted(sk.sparse_kmeans(weights, 3, 2, pages_per_part=1)[0].collect()) == sorted(few)
    assert buckets[-2] == 3
    ids = spark.createDataFrame([(p,) for p in range(20)] * 2, "page_id long")
    assert sk.sparse_kmeans(weights, 3, 1, pages=ids, pages_per_part=20)[0].count() == 40
    assert buckets[-2] == 1  # a page that comes twice is one


def test_kmeans_of_nothing(spark):
    weights = spark.createDataFrame([], "page_id long, word int, weight double")
    got, centres = sk.sparse_kmeans(weights, 3, 2)
    assert got.count() == 0 and centres.count() == 0


def test_numbers_follow_the_order(spark):
    values = random.Random(1).choices(range(40), k=500)
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v long, i long")
    got = sorted((r["number"], r["v"], r["i"]) for r in numbered(rows.repartition(7), "v", "i").collect())
    assert got == [(n, v, i) for n, (v, i) in enumerate(sorted((v, i) for i, v in enumerate(values)))]
    words = spark.createDataFrame([("b", 2), ("a", 2), ("z", 1)], "word string, df long")
    assert sorted(tuple(r) for r in word_numbers(words).collect()) == [("a", 2, 1), ("b", 2, 2), ("z", 1, 0)]


def test_words_are_counted_without_a_shuffle(spark, rows):
    texts = [(1, "b a  b c b"), (2, ""), (3, None), (4, "x"), (5, " \n")]
    pages = spark.createDataFrame(texts, "page_id long, text string")
    tf = terms.sized_term_freq(pages, ws_words)
    assert rows(tf) == {(1, 5, "a", 1), (1, 5, "b", 3), (1, 5, "c", 1), (4, 1, "x", 1)}
    assert "Exchange" not in tf._jdf.queryExecution().executedPlan().toString()
    counts = tfidf.count_corpus(pages, ws_words)
    named = tfidf.smoothed_by_number(counts).withColumnRenamed("word", "word_id").join(counts.dictionary, "word_id")
    assert rows(named, "page_id", "word", "weight") == rows(tfidf.smoothed(counts))
