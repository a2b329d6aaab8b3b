from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from pageloom.operators import cover, page_graph, similarity
from pageloom.operators.components import components

WORDS = [f"{a}{b}" for a in "bcdfgh" for b in "aeiou"]


def corpus(seed: int, n: int = 40) -> list[str]:
    rnd = random.Random(seed)
    texts = []
    for _ in range(n):
        size = rnd.choice([1, 2, 3, 8, 20, 60, 300])
        texts.append(" ".join(rnd.choice(WORDS[: rnd.choice([3, 10, 30])]) for _ in range(size)))
    texts += [texts[0], texts[1], texts[1], texts[5] + " extra", ""]
    return texts


def brute(texts, threshold, metric):
    words = {i: re.findall("[a-zA-Z]+", t.lower()) for i, t in enumerate(texts)}
    counts = {i: Counter(w) for i, w in words.items() if w}
    df = Counter(w for c in counts.values() for w in c)
    vec = {
        i: {w: n / len(words[i]) * math.log(len(texts) / df[w]) for w, n in c.items()}
        for i, c in counts.items()
    }
    found = {}
    for a, b in itertools.combinations(sorted(vec), 2):
        x, y = vec[a], vec[b]
        if metric == "euclid":
            sq = sum((x.get(w, 0) - y.get(w, 0)) ** 2 for w in x.keys() | y.keys())
        else:
            sq = sum((x.get(w) or y.get(w)) ** 2 for w in x.keys() ^ y.keys())
        if round(math.sqrt(sq), 6) <= threshold:
            found[a, b] = round(math.sqrt(sq), 6)
    return found


def unfold(vectors, pairs, threshold):
    """All pairs from the three kinds: copies, light pairs, found pairs."""
    group = {}
    for r in vectors.copies.collect():
        group.setdefault(r["rep"], []).append(r["page_id"])
    norms = {r["rep"]: r["norm_sq"] for r in vectors.norms.collect()}
    got = {tuple(sorted(p)) for g in group.values() for p in itertools.combinations(g, 2)}
    limit = (threshold + similarity.HALF_UNIT) ** 2
    close = [(r["page_a"], r["page_b"]) for r in pairs.collect()]
    assert all(norms[a] + norms[b] > limit for a, b in close)
    close += [p for p in itertools.combinations(sorted(norms), 2) if norms[p[0]] + norms[p[1]] <= limit]
    for a, b in close:
        got |= {tuple(sorted(p)) for p in itertools.product(group[a], group[b])}
    return got


def as_pages(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "page_id long, text string")


@pytest.mark.parametrize("metric", similarity.METRICS)
@pytest.mark.parametrize("seed,threshold", [(1, 0.1), (2, 0.3), (3, 0.9)])
def test_three_kinds_of_pairs_are_all_pairs(spark, metric, seed, threshold):
    texts = corpus(seed)
    vectors = similarity.build_vectors(as_pages(spark, texts))
    pairs = similarity.found_pairs(vectors, threshold, metric, pages_per_split=3)
    expected = brute(texts, threshold, metric)
    assert unfold(vectors, pairs, threshold) == set(expected)
    for r in pairs.collect():
        assert r["dist"] == pytest.approx(expected[r["page_a"], r["page_b"]], abs=2e-6)


def test_neighbours_of_copies(spark):
    texts = corpus(3)
    vectors = similarity.build_vectors(as_pages(spark, texts))
    pairs = similarity.found_pairs(vectors, 0.9)
    rep = {r["page_id"]: r["rep"] for r in vectors.copies.collect()}
    found = {(r["page_a"], r["page_b"]) for r in pairs.collect()}
    got = sorted((r["page_id"], r["similar_id"]) for r in similarity.neighbours(pairs, vectors.copies).collect())
    expected = [(p, s) for p, r in rep.items() for s in set(rep.values()) if tuple(sorted((r, s))) in found]
    assert got == sorted(expected)
    lengths = {r["page_id"]: r["n_words"] for r in vectors.lengths.collect()}
    assert lengths == {i: len(t.split()) for i, t in enumerate(texts) if t}


def test_a_lone_light_page_is_not_listed(spark, rows):
    apart = vectors_of(spark, {"x": 0.1}, {"y": 5.0})
    assert rows(similarity.light_pages(apart, 0.2), "rep") == set()


def test_symdiff_is_never_longer_than_euclid(spark):
    texts = corpus(4)
    euclid, symdiff = brute(texts, 9, "euclid"), brute(texts, 9, "symdiff")
    vectors = similarity.build_vectors(as_pages(spark, texts))
    assert all(symdiff[p] <= d + 1e-6 for p, d in euclid.items())
    wide = {
        (r["page_a"], r["page_b"]): r["dist"]
        for r in similarity.found_pairs(vectors, 9, "symdiff").collect()
    }
    for pair, dist in wide.items():
        assert dist == pytest.approx(symdiff[pair], abs=2e-6)


def vectors_of(spark, *pages):
    """Vectors given by hand: dicts of word -> weight."""
    rows = [(i, w, x) for i, page in enumerate(pages) for w, x in page.items()]
    df = Counter(w for _, w, _ in rows)
    number = {w: i for i, w in enumerate(sorted(df, key=lambda w: (df[w], w)))}
    terms, norms = [], []
    for i, page in enumerate(pages):
        norm, before = sum(x * x for x in page.values()), 0.0
        for w, x in sorted(page.items(), key=lambda p: (df[p[0]], p[0])):
            terms.append((i, number[w], df[w], x, norm, before))
            before += x * x
        norms.append((i, 1, norm))
    return similarity.Vectors(
        spark.createDataFrame([(i, i) for i in range(len(pages))], "page_id long, rep long"),
        spark.createDataFrame(norms, "rep long, n_pages long, norm_sq double"),
        spark.createDataFrame(
            terms, "rep long, word long, df long, weight double, norm_sq double, before double"
        ),
    )


def test_distances_by_hand(spark, rows):
    shared = vectors_of(spark, {"x": 1.0, "y": 2.0}, {"x": 3.0})
    assert rows(similarity.found_pairs(shared, 3.0)) == {(0, 1, round(math.sqrt(8), 6))}
    assert rows(similarity.found_pairs(shared, 2.0, "symdiff")) == {(0, 1, 2.0)}  # exactly t
    assert rows(similarity.found_pairs(shared, 1.999, "symdiff")) == set()
    apart = vectors_of(spark, {"x": 0.1}, {"y": 0.1})
    assert rows(similarity.found_pairs(apart, 0.1)) == set()
    assert rows(similarity.light_pages(apart, 0.2), "rep") == {(0,), (1,)}


def closure(edges):
    parent = {v: v for e in edges for v in e}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        ra, rb = sorted((root(a), root(b)))
        parent[rb] = ra
    return {(v, root(v)) for v in parent}


@pytest.mark.parametrize("metric,threshold", [("euclid", 0.3), ("symdiff", 0.1), ("euclid", 0.9)])
def test_page_components_equal_those_of_all_pairs(spark, rows, metric, threshold):
    texts = corpus(7)
    vectors = similarity.build_vectors(as_pages(spark, texts))
    labels = page_graph.page_components(vectors, threshold, metric)
    assert rows(labels, "page_id", "component") == closure(brute(texts, threshold, metric))


def test_components(spark, rows):
    rnd = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 130)]
    loose = [(1, 2), (3, 2), (5, 6), (6, 5), (7, 7)]
    edges = chain + loose
    rnd.shuffle(edges)
    df = spark.createDataFrame([(b, a) for a, b in edges], "u long, v long")
    assert rows(components(df)) == closure([e for e in edges if e[0] != e[1]])


def test_shortest_pages_keep_ties(spark, rows):
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 4)], "page_id long, component long")
    lengths = spark.createDataFrame([(1, 5), (2, 3), (3, 3), (4, 9)], "page_id long, n_words long")
    got = page_graph.shortest_pages(labels, lengths)
    assert rows(got, "component", "page_id") == {(1, 2), (1, 3), (4, 4)}


def test_component_reports(spark, rows):
    labels = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5), (7, 5)], "page_id long, component long")
    assert rows(page_graph.component_count(labels)) == {(2, 5)}
    assert rows(page_graph.component_sizes(labels)) == {(1, 2), (5, 3)}
    assert (2, 5, 3, 7) in rows(page_graph.component_members(labels))


@pytest.mark.parametrize("threshold,radius", [(0.3, 0.125), (0.9, 0.5), (0.2, 0.4)])
def test_a_cover_unfolds_to_all_found_pairs(spark, rows, threshold, radius):
    rnd = random.Random(11)
    texts = corpus(9)
    for base in (texts[6], texts[9], " ".join(rnd.choices(WORDS, k=80))):
        for _ in range(12):
            words = base.split()
            words[rnd.randrange(len(words))] = rnd.choice(WORDS)
            texts.append(" ".join(words))
    vectors = similarity.build_vectors(as_pages(spark, texts))
    found = cover.cover(vectors, threshold, radius)
    expected = rows(similarity.found_pairs(vectors, threshold), "page_a", "page_b")
    got = [tuple(r) for r in cover.unfolded(vectors, found).collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    assert closure([tuple(r) for r in cover.links(found).collect()]) == closure(expected) or not expected
    assert all(r["dist"] <= radius * threshold for r in found.members.collect())


def test_a_large_group_of_near_copies_takes_one_row_each(spark):
    """2,000 contents that differ in one rare word each, and some others."""
    rnd = random.Random(4)
    pages = [{**{f"w{j:02}": 0.5 for j in range(12)}, f"x{i}": 0.02} for i in range(2000)]
    pages += [{f"w{rnd.randrange(12):02}": 0.5, f"y{i % 7}": rnd.uniform(1, 2)} for i in range(40)]
    vectors = vectors_of(spark, *pages)
    found = cover.cover(vectors, 0.4)
    assert found.members.count() >= 1999
    assert found.leaders.count() + found.listed.count() < 1000
    links = cover.links(found).collect()
    assert {root for v, root in closure([tuple(r) for r in links]) if v < 2000} == {0}


def test_tiles_follow_the_size_of_the_vectors(spark):
    """Few blocks or many, the distances are the same; few send each vector less often."""
    terms = spark.range(60).selectExpr("id rep", "explode(sequence(id % 5, 6)) word", "1.0D + id weight")
    ends = spark.range(60).selectExpr("id x", "explode(sequence(0L, id - 1)) y").where("x > 0")
    pairs = ends.selectExpr("x", "y", "1.0D norm_x", "1.0D norm_y")
    by_words = similarity.taken_off(pairs, terms, "euclid", contents_per_block=1, words_per_block=20)
    one = similarity.taken_off(pairs, terms, "euclid", contents_per_block=1, words_per_block=1 << 22)
    whole = similarity.taken_off(pairs, terms, "euclid")
    want = {(x, y): 2.0 * (1 + x) * (1 + y) * (7 - max(x % 5, y % 5)) for x in range(60) for y in range(x)}
    for got in (by_words, one, whole):
        assert {(r["x"], r["y"]): r["off"] for r in got.collect()} == want


@pytest.mark.parametrize("metric", similarity.METRICS)
@pytest.mark.parametrize("per_meeting", [0.0, 1e9])
@pytest.mark.parametrize("diagonal", [True, False])
def test_a_tile_finds_its_pairs_by_meetings_or_products(monkeypatch, metric, per_meeting, diagonal):
    rnd = random.Random(6)
    monkeypatch.setattr(similarity, "PER_MEETING", per_meeting)
    monkeypatch.setattr(similarity, "MEETINGS", 40)
    monkeypatch.setattr(similarity, "COMMON", 4)
    monkeypatch.setattr(similarity, "LEFT_CONTENTS", 7)
    monkeypatch.setattr(similarity, "RIGHT_CONTENTS", 5)
    pages = [{w: rnd.choice([0.1, 0.3, 0.7]) for w in rnd.sample(range(30), rnd.randrange(1, 12))} for _ in range(60)]
    block = [0 if diagonal else i % 2 for i in range(60)]
    tile = pa.table({
        "a": [0] * 60, "b": [0 if diagonal else 1] * 60, "block": block, "rep": [*range(100, 160)],
        "norm_sq": [sum(x * x for x in p.values()) for p in pages],
        "words": [sorted(p) for p in pages], "weights": [[p[w] for w in sorted(p)] for p in pages],
    })
    want = {}
    for i, j in itertools.combinations(range(60), 2):
        x, y = pages[i], pages[j]
        if metric == "euclid":
            sq = sum((x.get(w, 0) - y.get(w, 0)) ** 2 for w in x.keys() | y.keys())
        else:
            sq = sum((x.get(w) or y.get(w)) ** 2 for w in x.keys() ^ y.keys())
        heavy = sum(v * v for v in [*x.values(), *y.values()]) > (0.9 + 5e-7) ** 2
        if (diagonal or block[i] != block[j]) and heavy and sq <= (0.9 + 5e-7) ** 2:
            want[100 + i, 100 + j] = pytest.approx(sq, abs=1e-9)
    got = similarity._search(metric, 0.9, None, False)(tile).to_pylist()
    assert {tuple(sorted((r["x"], r["y"]))): r["dist_sq"] for r in got} == want and len(got) == len(want) > 5


def test_the_search_makes_no_row_per_meeting(spark):
    """Vectors are all that is shuffled: no join of words, pairs or candidates."""
    vectors = similarity.build_vectors(as_pages(spark, corpus(5)))
    plan = similarity.found_pairs(vectors, 0.3)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CoGroup" not in plan and "FlatMapGroupsInArrow" in plan


def test_connecting_pairs_take_a_row_per_content(spark):
    """300 near copies are 44,850 pairs, but 299 rows connect them."""
    pages = [{**{f"w{j:02}": 0.5 for j in range(12)}, f"x{i}": 0.02} for i in range(300)]
    vectors = vectors_of(spark, *pages)
    assert similarity.found_pairs(vectors, 0.4).count() == 300 * 299 // 2
    rows = similarity.connecting_pairs(vectors, 0.4).collect()
    assert len(rows) == 299 and {r for _, r in closure([tuple(r) for r in rows])} == {0}


def test_a_vector_is_shuffled_once_however_many_blocks(spark):
    """Blocks are rows of their own, which every tile reads; no copy per tile is written."""
    vectors = similarity.build_vectors(as_pages(spark, corpus(5)))
    plan = similarity.found_pairs(vectors, 0.3, pages_per_split=3)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "explode" not in plan and "Generate" not in plan


def test_a_block_is_a_row_that_gives_its_contents_back():
    blocks = [
        pa.table({
            "block": [b] * 3, "rep": [b * 10 + i for i in range(3)], "norm_sq": [1.0, 2.0, b + 0.5],
            "words": [[1, 5], [b], [7, 8, 9]], "weights": [[0.5, 0.1], [2.0], [1.0, b + 0.0, 3.0]],
        })
        for b in range(3)
    ]
    row = [similarity._as_row(t).to_pylist()[0] for t in blocks]
    tiles = [(a, b) for a in range(3) for b in range(a, 3)]
    batch = pa.RecordBatch.from_pylist(
        [{"a": a, "left": row[a]["vectors"], "b": b, "right": row[b]["vectors"]} for a, b in tiles]
    )
    got = list(similarity._in_tiles(lambda t: t.combine_chunks())([batch]))
    for (a, b), tile in zip(tiles, got, strict=True):
        sides = blocks[a].to_pylist() + (blocks[b].to_pylist() if a != b else [])
        assert [{k: r[k] for k in blocks[a].column_names} for r in tile.to_pylist()] == sides
        assert set(tile["a"].to_pylist()) == {a} and set(tile["b"].to_pylist()) == {b}


@pytest.mark.parametrize("metric", similarity.METRICS)
@pytest.mark.parametrize("seed,threshold", [(1, 0.1), (2, 0.3), (3, 0.9)])
def test_every_pair_is_listed_with_copies_and_light_pairs(spark, monkeypatch, metric, seed, threshold):
    """Copies in one row and in several, light pages, and pages whose words weigh nothing."""
    monkeypatch.setattr(similarity, "PAGES_PER_ROW", 2)
    texts = corpus(seed) + ["ba be"] * 5
    texts = [f"everywhere {t}" if t else "everywhere everywhere" for t in texts] + ["everywhere"] * 3
    vectors = similarity.build_vectors(as_pages(spark, texts))
    expected = brute(texts, threshold, metric)
    pairs = similarity.found_pairs(vectors, threshold, metric, pages_per_split=9, every=True).collect()
    got = {(r["page_a"], r["page_b"]): r["dist"] for r in pairs}
    assert len(got) == len(pairs) and set(got) == set(expected)
    assert got == {p: pytest.approx(d, abs=2e-6) for p, d in expected.items()}
    n = len(texts)
    assert {(a, b) for a, b in itertools.combinations(range(n - 3, n), 2)} <= set(got)


def test_neighbours_of_every_pair_are_pages(spark, rows):
    texts = corpus(3)
    vectors = similarity.build_vectors(as_pages(spark, texts))
    own = vectors.copies.selectExpr("page_id", "page_id rep")
    got = similarity.neighbours(similarity.found_pairs(vectors, 0.9, every=True), own)
    both = {(*p, d) for (a, b), d in brute(texts, 0.9, "euclid").items() for p in ((a, b), (b, a))}
    assert rows(got, "page_id", "similar_id") == {p[:2] for p in both} and got.count() == len(both)


@pytest.mark.parametrize("connecting", [False, True])
def test_a_tile_in_small_portions_finds_the_same(monkeypatch, connecting):
    """Runs, portions and hubs that are compared with all: 300 contents that share most words."""
    rnd = random.Random(8)
    pages = [{w: rnd.choice([0.05, 0.1, 0.2]) for w in rnd.sample(range(60), rnd.randrange(1, 50))} for _ in range(300)]
    tile = pa.table({
        "a": [0] * 300, "b": [1] * 300, "block": [0] * 150 + [1] * 150, "rep": [*range(300)],
        "norm_sq": [sum(x * x for x in p.values()) for p in pages],
        "words": [sorted(p) for p in pages], "weights": [[p[w] for w in sorted(p)] for p in pages],
    })
    monkeypatch.setattr(similarity, "PER_PRODUCT", 1e9)
    whole = similarity._search("euclid", 0.55, None, connecting)(tile).to_pydict()
    for name, n in (("MEETINGS", 30), ("ENTRIES", 40), ("COMPARED", 20), ("CONNECTED", 10), ("LONG", 20), ("PER_MEETING", 1e6)):
        monkeypatch.setattr(similarity, name, n)
    if not connecting:
        monkeypatch.setattr(similarity, "KNOWN_WORDS", 3)
    some = list(similarity._parts("euclid", 0.55, None, connecting)(tile))
    assert connecting or len(some) > 10
    some = pa.concat_tables(some).to_pydict()
    pairs = [{tuple(sorted(p)) for p in zip(t["x"], t["y"], strict=True)} for t in (whole, some)]
    assert pairs[0] == pairs[1] and len(some["x"]) == len(pairs[1]) > 100


def test_a_long_block_is_several_rows_and_each_goes_on_once(spark, monkeypatch):
    """Rows of the product are many, but the vectors of a block's row are on one of a tile's."""
    monkeypatch.setattr(similarity, "WORDS_PER_ROW", 4)
    block = pa.table({
        "block": [3] * 6, "rep": [*range(6)], "norm_sq": [1.0] * 6,
        "words": [[1, 5, 6], [2], [7, 8, 1 << 20], [], [1], [2, 3, 4, 5, 6, 7, 8, 9]], "weights": [[0.5] * n for n in (3, 1, 3, 0, 1, 8)],
    })
    rows = similarity._as_row(block).to_pylist()
    assert len(rows) > 2 and [r["piece"] for r in rows] == [*range(len(rows))] and {r["block"] for r in rows} == {3}
    product = [
        {"a": 3, "left": x["vectors"] if y["piece"] == 0 else None, "b": 4, "right": y["vectors"] if x["piece"] == 0 else None}
        for x in rows for y in rows
    ]
    batches = [pa.RecordBatch.from_pylist(product[:5]), pa.RecordBatch.from_pylist(product[5:])]
    tile = list(similarity._in_tiles(lambda t: t.combine_chunks())(batches))
    assert len(tile) == 1 and tile[0]["rep"].to_pylist() == [*range(6)] * 2
    assert tile[0]["words"].to_pylist() == block["words"].to_pylist() * 2


def test_pairs_of_blocks_of_several_rows(spark, monkeypatch):
    texts = corpus(2)
    expected = brute(texts, 0.9, "euclid")
    real = similarity._as_row

    def small(table):
        similarity.WORDS_PER_ROW = 8
        return real(table)

    monkeypatch.setattr(similarity, "_as_row", small)
    vectors = similarity.build_vectors(as_pages(spark, texts))
    pairs = similarity.found_pairs(vectors, 0.9, pages_per_split=20, every=True)
    assert {(r["page_a"], r["page_b"]) for r in pairs.collect()} == set(expected)
