"""Resampling, centroid clustering and embedding near-duplicates against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.llm import centroids, embedding_dups, resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# --- resampling ----------------------------------------------------------------


def plain_resample(docs, target, size=1, buckets=10_000, min_words=20, percent=10, seed=2024):
    def buckets_of(text):
        w = plain_words(text)
        runs = [" ".join(w[i : i + n]) for n in range(1, size + 1) for i in range(len(w) - n + 1)]
        return [zlib.crc32(x.encode()) % buckets for x in runs]

    own = [buckets_of(t) for _, t in docs]
    s, t = Counter(b for x in own for b in x), Counter(b for x in target for b in buckets_of(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
        for b in range(buckets)
    ]
    rows = []
    for (i, text), bs in zip(docs, own, strict=True):
        weight = sum(gain[b] for b in bs) // len(bs) if bs else 0
        name = "null" if i is None else i
        h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append([i, len(plain_words(text)), len(bs), weight, score, None])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    for place, r in enumerate(able[: len(able) * percent // 100]):
        r[5] = place + 1
    return sorted(map(tuple, rows), key=str)


def random_texts(n, seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(200)] + ["É", "日本", "Ab", "x-y", "a\x00b"]
    return [" ".join(rnd.choices(words, k=rnd.choice([0, 1, 5, 19, 20, 60, 400]))) for _ in range(n)]


def test_bit_planes_give_the_exact_sum():
    rnd = np.random.default_rng(1)
    for scale in (0, 1, 2, 5000, 10**6):
        gain = rnd.integers(-scale, scale + 1, 10_000)
        planes = resampling.GainPlanes(gain)
        for most in (1, 2, 1000, 2**30):
            counts = rnd.integers(0, most, 10_000)
            assert planes.total(counts) == sum(map(int.__mul__, counts.tolist(), gain.tolist()))
    assert resampling.GainPlanes(np.full(9, -8)).total(np.full(9, 3)) == -216


@pytest.mark.parametrize("size, buckets, percent", [(1, 10_000, 10), (3, 64, 50), (2, 7, 100)])
def test_resample(spark, monkeypatch, size, buckets, percent):
    monkeypatch.setattr(resampling, "PART", 17)
    texts = [*random_texts(150, 3), None, "", "- -", "W1 " * 5000]
    docs = [(i * 7 % 160, t) for i, t in enumerate(texts)] + [(None, texts[5]), (None, None)]
    docs += [docs[6], docs[6]]  # repeated rows
    target = [*random_texts(8, 4)[:6], None, "", "É 日本"]
    rows = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, score int, id string")
    found = resampling.resample(
        rows.repartition(5),
        spark.createDataFrame([(t,) for t in target], "text string"),
        size=size, buckets=buckets, percent=percent,
    )
    expected = plain_resample(docs, target, size, buckets, percent=percent)
    assert sorted(map(tuple, found.collect()), key=str) == expected


def test_nothing_to_resample(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    one = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert resampling.resample(empty, empty).collect() == []
    found = resampling.resample(one, empty).collect()
    assert [(r["n_features"], r["rank"]) for r in sorted(found)] == [(2, None), (0, None)]


def test_all_ids_equal(spark):
    """A score that every row has is still cut by rank, and ranks stay distinct."""
    rows = spark.createDataFrame([(5, "a " * 30)] * 50, "doc_id long, text string").repartition(7)
    found = resampling.resample(rows, rows.limit(3)).collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == [1, 2, 3, 4, 5]


# --- centroid clustering -------------------------------------------------------


def plain_clusters(rows, k=8, rounds=10, components=64, scale=1024, seed=3):
    def fits(v):
        return v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if fits(v)]
    name = lambda i: "null" if i is None else i
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{name(r[0])}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in order[:k]]
    for step in range(rounds + 1):
        own = [min((far(v, c), j) for j, c in enumerate(centres)) for _, v in kept]
        for j in range(len(centres) if step < rounds else 0):
            if mine := [v for (_, v), (_, c) in zip(kept, own, strict=True) if c == j]:
                centres[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return sorted(((i, c, d) for (i, _), (d, c) in zip(kept, own, strict=True)), key=str), centres


def clustered(n, width, seed, spread=0.1):
    rnd = np.random.default_rng(seed)
    middles = rnd.normal(0, 1, (5, width))
    return (middles[rnd.integers(0, 5, n)] + rnd.normal(0, spread, (n, width))).astype(np.float32).tolist()


def test_bounds_hold_and_leave_out_centroids():
    rnd = np.random.default_rng(0)
    for width, pool in ((64, 64), (64, 3), (3, 10), (1, 2), (5, 1)):
        points = rnd.integers(-2000, 2000, (400, width))
        simplex = centroids.Simplex(points[:pool])
        z = simplex.apex(points)
        true = np.sqrt(centroids.squared(points, points[:50]))
        flipped = z[:50] * np.append(np.ones(z.shape[1] - 1), -1)
        lower = np.linalg.norm(z[:, None] - z[None, :50], axis=2)
        upper = np.linalg.norm(z[:, None] - flipped[None], axis=2)
        assert (lower <= true + 1e-2).all() and (true <= upper + 1e-2).all()
    points = np.floor(np.array(clustered(2000, 64, 1)) * 1024).astype(np.int64)
    simplex = centroids.Simplex(points[:64])
    label, best, compared = centroids.nearest(points, simplex.apex(points), points[:8], simplex)
    exact = centroids.squared(points, points[:8])
    assert (label == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert compared < 0.5 * exact.size


@pytest.mark.parametrize("width, k, rounds, pivots", [(64, 8, 10, 12), (4, 3, 4, 2), (2, 40, 2, 1)])
def test_clusters(spark, width, k, rounds, pivots):
    vectors = clustered(120, width, 5, spread=0.5)
    rows = [(i, v) for i, v in enumerate(vectors)]
    rows += [(900 + i, vectors[0]) for i in range(60)] + [(3, vectors[9]), (3, vectors[9]), (None, vectors[2])]
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.5], [*vectors[1][1:], None], [*vectors[1][1:], nan], [*vectors[1][1:], -inf]]
    rows += [(5000 + i, v) for i, v in enumerate(bad) if v is None or width > 1 or len(v) != 1]
    table = spark.createDataFrame(
        [(*r, 1, 2.0) for r in rows], "vec_id long, embedding array<float>, cluster int, distance double"
    )
    found, centres = centroids.cluster(
        table.repartition(4), k=k, rounds=rounds, components=width, pivots=pivots
    )
    expected, plain = plain_clusters(rows, k, rounds, width)
    assert sorted(map(tuple, found.collect()), key=str) == expected
    assert centres.tolist() == plain


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    found, centres = centroids.cluster(spark.createDataFrame([], schema))
    assert found.collect() == [] and len(centres) == 0
    same = spark.createDataFrame([(i, [1.5] * 64) for i in range(3)] + [(9, [1e9] * 64)], schema)
    found, centres = centroids.cluster(same)
    assert [tuple(r) for r in sorted(found.collect())] == [(0, 0, 0), (1, 0, 0), (2, 0, 0)]
    assert len(centres) == 3


# --- embedding near-duplicates -------------------------------------------------


def plain_links(rows, cosine=0.95):
    """``{(row, other row)}`` of all linked rows, and each row's component id."""
    def fits(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    units = [np.array(v, float) / np.linalg.norm(v) if fits(v) else None for _, v in rows]
    pairs, label = set(), list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(units):
        for j in range(i):
            b = units[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= cosine:
                pairs.add((j, i))
                label[root(i)] = root(j)
    groups = {}
    for i, (name, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(name)
    low = {r: min((x for x in ids if x is not None), default=None) for r, ids in groups.items()}
    degree = Counter(x for p in pairs for x in p)
    return [(name, degree[i], low[root(i)]) for i, (name, _) in enumerate(rows)]


def near_copies(n, groups, size, seed, spread, width=64):
    rnd = np.random.default_rng(seed)
    base = rnd.normal(0, 1, (n, width))
    near = [base[g] + rnd.normal(0, spread, (size, width)) for g in range(groups)]
    return np.concatenate([base, *near]).tolist()


@pytest.mark.parametrize(
    "leaf, tile, sample, trees", [(1024, 2048, 16_384, 6), (60, 25, 90, 16), (40, 1000, 10_000, 16)]
)
def test_embedding_links(spark, monkeypatch, leaf, tile, sample, trees):
    monkeypatch.setattr(embedding_dups, "PAIRS", 100)
    monkeypatch.setattr(embedding_dups, "BLOCK", 30)
    monkeypatch.setattr(embedding_dups, "PASS_CELLS", 7)
    vectors = near_copies(200, 12, 6, 1, 0.2) + near_copies(1, 1, 120, 2, 0.15)
    rows = list(enumerate(vectors))
    rows += [(1000 + i, vectors[0]) for i in range(5)] + [(1, [2 * x for x in vectors[1]])]
    rows += [(None, vectors[3]), (None, [1.0, 2.0]), (2000, [1.0, 2.1]), (2001, [1e300, -1e300]), (2002, [1e300, -9e299])]
    bad = [None, [], [0.0] * 64, [None, 1.0], [float("nan"), 1.0], [float("inf"), 1.0]]
    rows += [(3000 + i, v) for i, v in enumerate(bad)]
    rows = [(i, v) for i, v in rows if not v or v[0] is None or abs(v[0]) < 1e299]
    random.Random(5).shuffle(rows)
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, c int")
    found = embedding_dups.near_duplicates(
        table.repartition(5), leaf=leaf, tile=tile, sample=sample, trees=trees
    )
    assert sorted(map(tuple, found.collect()), key=str) == sorted(plain_links(rows), key=str)


def test_very_long_vectors_do_not_overflow(spark):
    rows = [(1, [1e300, 1e300]), (2, [1e-300, 1e-300]), (3, [5e-324, 0.0]), (4, [1e308, 0.0])]
    found = embedding_dups.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sorted(map(tuple, found.collect())) == [(1, 1, 1), (2, 1, 1), (3, 1, 3), (4, 1, 3)]


def test_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert embedding_dups.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    found = embedding_dups.near_duplicates(spark.createDataFrame([(1, None), (2, None)], schema))
    assert sorted(map(tuple, found.collect())) == [(1, 0, 1), (2, 0, 2)]


def test_default_forest_finds_what_lies_near_the_bound():
    """Recall of pairs of cosine 0.95 to 0.96 that meet in some leaf, at a depth of six or more."""
    rnd = np.random.default_rng(7)
    base = rnd.normal(0, 1, (30_000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    other = rnd.normal(0, 1, (3_000, 64))
    other -= (other * base[:3000]).sum(axis=1, keepdims=True) * base[:3000]
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cos = rnd.uniform(0.95, 0.96, (3_000, 1))
    rows = np.concatenate([base, cos * base[:3000] + np.sqrt(1 - cos**2) * other])
    strip = embedding_dups.half_spill(0.95, 64)
    shared, largest, depth = np.zeros(3000, bool), 0, 0
    for cell in (64 * 64, 64 * 64 + 1, 64 * 64 + 2):  # half of the trees
        nodes = embedding_dups.grow(rows[::3], len(rows), cell, 13, strip, 1024)
        for own, leaf in embedding_dups.leaves_of(rows, nodes, cell, 13, strip):
            inside = np.zeros(len(rows), bool)
            inside[own] = True
            shared |= inside[:3000] & inside[30_000:]
            largest, depth = max(largest, len(own)), depth + 1
    assert shared.mean() > 0.97 and largest < 1400 and depth > 150
