"""Toxic passages as maximum-scoring segments of token log-odds.

**Tokens.**  Words are scored by the odds of toxic against clean labelled documents that
hold them.  The share of toxic documents is estimated with Dirichlet (here two-class,
so Beta) priors chained from general to special: all documents, the word's first four
characters, its first six, the word itself; each level's prior is the estimate of the
level before it, with a fixed weight.  An unseen word so takes the odds of its beginning.
Counts are kept in three tables of fixed size, indexed by a hash of the feature, which
bounds what is broadcast at any corpus size (10 MB).

**Segments.**  Log-odds less a constant drift have a negative mean in clean text.  A
linear scan (Ruzzo and Tompa, 1999) finds all maximal-scoring segments.

**Calibration.**  Under the scores seen in clean training documents, the best segment of
``n`` tokens follows an extreme-value law (Karlin and Altschul, 1990): with ``lam`` the
positive root of ``E[exp(lam * s)] = 1``, a score ``S`` has ``E = K n exp(-lam S)``
chance segments; ``K`` follows from the same histogram by their series over sums of
tokens.  A document's evidence is the sum of ``lam S - ln(K n)`` over its
significant segments, or that of its best segment if none is, and a logistic curve
fitted on the histogram of all training documents turns it into a probability.  There,
each document is scored with its own counts taken out.

Labels are read for training rows only, and scoring reads nothing but the text.  At most
``MAX_LABELS`` labelled rows train (chosen by a hash of the id); so few ids and labels are
broadcast, and the texts are not shuffled.

Defined cases: a null or empty text has no token and gets the lowest evidence; a null or
missing label, a null id, or a label other than 0 or 1 trains nothing; a document with
several labels trains once for each; without any training document, or with one class
only, every score is the prior share of toxic documents (0 if there is none).
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.text import alnum_words, per_text
from pageloom.plans.staging import stage, unstage

#: Feature levels: leading characters (0: the whole word) and the table's bits.
LEVELS = ((4, 18), (6, 20), (0, 20))
OFFSETS = tuple(sum(1 << b for _, b in LEVELS[:i]) for i in range(len(LEVELS)))
SLOTS = sum(1 << b for _, b in LEVELS)
#: Weight of the prior at each level, in documents.
PRIOR = 8.0
#: What every token costs, in log-odds.
DRIFT = 1.0
#: Expected number of chance segments below which a segment is significant.
SIGNIFICANT = 0.05
THRESHOLD = 0.7
#: Scores are counted in steps of 1 / STEPS between -SPAN and SPAN for calibration.
STEPS, SPAN = 16, 16
#: Labelled rows that train, at most: a sample by a hash of the id if there are more.
MAX_LABELS = 100_000
#: Words whose scores a task remembers before it starts anew.
REMEMBERED = 400_000


def slots(word: bytes) -> tuple[int, ...]:
    """The word's place in each table (short words have no shorter beginning)."""
    text = word.decode("utf-8", "replace")
    return tuple(
        offset + (zlib.crc32((text[:n] if n else text).encode(), n + 1) & ((1 << bits) - 1))
        for (n, bits), offset in zip(LEVELS, OFFSETS, strict=True)
    )


class Scores(dict):
    """word -> log-odds less the drift; ``own`` takes one label's document out."""

    def __init__(self, toxic: np.ndarray, clean: np.ndarray, share: float, own: int | None = None):
        super().__init__()
        self.toxic, self.clean, self.share, self.own = toxic, clean, share, own
        self.base = math.log(share / (1 - share))

    def __missing__(self, word: bytes) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        s = self.share
        for i in slots(word):
            t, c = int(self.toxic[i]), int(self.clean[i])
            if self.own == 1:
                t = max(t - 1, 0)
            elif self.own == 0:
                c = max(c - 1, 0)
            s = (t + PRIOR * s) / (t + c + PRIOR)
        value = self[word] = math.log(s / (1 - s)) - self.base - DRIFT
        return value


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(start, end, score)``, in linear time."""
    found: list[list] = []  # start, end, sum before, sum after, where to look next
    total = 0.0
    for i, x in enumerate(scores):
        if x <= 0:
            total += x
            continue
        start, before, j = i, total, len(found) - 1
        total += x
        while True:
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                found.append([start, i + 1, before, total, j])
                break
            start, before = found[j][0], found[j][2]
            del found[j:]
            j = len(found) - 1
    return [(a, b, after - before) for a, b, before, after, _ in found]


@dataclass
class Law:
    """Extreme-value constants and the logistic curve."""

    lam: float = 1.0
    k: float = 0.1
    slope: float = 0.0
    bias: float = 0.0

    def evidence(self, n: int, found: list[tuple[int, int, float]]) -> float:
        if not found:
            return -math.log(self.k * max(n, 1) + 1)
        room = math.log(self.k * n + 1)
        each = [self.lam * s - room for _, _, s in found]
        good = [x for x in each if x > -math.log(SIGNIFICANT)]
        return sum(good) if good else max(each)

    def probability(self, evidence: float) -> float:
        z = max(-40.0, min(40.0, self.slope * max(-30.0, min(60.0, evidence)) + self.bias))
        return 1 / (1 + math.exp(-z))


@dataclass
class Model:
    toxic: np.ndarray
    clean: np.ndarray
    share: float  #: of toxic documents, 0 or 1 if there is one class only
    law: Law


def _count_features(batches):
    """Per task: documents of each label that hold each feature."""
    counts = np.zeros((2, SLOTS), np.int32)
    totals = [0, 0]
    for batch in batches:
        for text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            places = {i for w in set(alnum_words(text)) for i in slots(w)}
            counts[label, np.fromiter(places, np.int64, len(places))] += 1
            totals[label] += 1
    used = np.flatnonzero(counts.any(axis=0))
    slot = np.concatenate([[-1], used])
    for at in range(0, len(slot), 100_000):
        part = slice(at, at + 100_000)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(slot[part], pa.int32()),
                *(
                    pa.array(np.concatenate([[totals[y]], counts[y, used]])[part], pa.int64())
                    for y in (1, 0)
                ),
            ],
            names=["slot", "toxic", "clean"],
        )


def _count_scores(held, law: Law):
    """Per task: histograms over the training documents, scored without themselves.

    Kind 0: token scores of clean documents.  Kind 1 and 2: evidence of clean and of
    toxic documents under ``law``.
    """

    def run(batches):
        toxic, clean, share = held.value
        tables = [Scores(toxic, clean, share, own) for own in (0, 1)]
        kinds = [np.zeros(2 * STEPS * SPAN * 4 + 1, np.int64) for _ in range(3)]

        def add(kind, values):
            half = len(kinds[kind]) // 2
            at = np.clip(np.rint(np.asarray(values) * STEPS) + half, 0, 2 * half).astype(int)
            np.add.at(kinds[kind], at, 1)

        for batch in batches:
            for text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                table = tables[label]
                scores = [table[w] for w in alnum_words(text)]
                if label == 0 and scores:
                    add(0, scores)
                add(1 + label, [law.evidence(len(scores), segments(scores))])
        for kind, counts in enumerate(kinds):
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used), kind), pa.int32()),
                    pa.array((used - len(counts) // 2) / STEPS, pa.float64()),
                    pa.array(counts[used], pa.int64()),
                ],
                names=["kind", "value", "n"],
            )

    return run


def _histogram(rows: DataFrame, held, law: Law) -> list[dict[float, int]]:
    counted = rows.mapInArrow(_count_scores(held, law), "kind int, value double, n long")
    out: list[dict[float, int]] = [{}, {}, {}]
    for r in counted.groupBy("kind", "value").agg(F.sum("n").alias("n")).collect():
        out[r["kind"]][r["value"]] = r["n"]
    return out


def extreme_law(scores: dict[float, int]) -> Law:
    """``lam`` and ``K`` of independent tokens with the given histogram of scores."""
    s = np.array(list(scores), float)
    p = np.array(list(scores.values()), float)
    if not len(s) or s.max() <= 0 or (p @ s) >= 0:
        return Law()
    p /= p.sum()
    low, high = 1e-6, 1.0
    while p @ np.exp(high * s) < 1:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if p @ np.exp(mid * s) < 1 else (low, mid)
    return Law(lam=high, k=lattice_constant(s, p, high))


def lattice_constant(s: np.ndarray, p: np.ndarray, lam: float) -> float:
    """``K`` for tokens of score ``s``, multiples of ``1 / STEPS``, with probability ``p``.

    With ``S_k`` the sum of ``k`` tokens, ``d`` the span of the scores and
    ``H = lam E[s exp(lam s)]``, it is ``lam d exp(-2 sigma) / (H (1 - exp(-lam d)))``, where
    ``sigma`` sums ``(P(S_k >= 0) + E[exp(lam S_k); S_k < 0]) / k`` over all ``k``.  Under
    the probabilities ``p exp(lam s)`` sums drift upwards, and both terms are chances that a
    sum is on the wrong side of zero, which fall geometrically.
    """
    step = np.rint(s * STEPS).astype(int)
    span = int(np.gcd.reduce(step))
    step //= max(span, 1)
    d = span / STEPS
    low, width = int(step.min()), int(step.max() - step.min()) + 1
    one = np.zeros(width)
    np.add.at(one, step - low, p)
    tilted = one * np.exp(lam * d * (np.arange(width) + low))
    tilted /= tilted.sum()
    mean = lam * d * float(tilted @ (np.arange(width) + low))  # H
    sigma, below, above = 0.0, one, tilted
    for k in range(1, 5000):
        at = np.arange(len(below)) + k * low
        term = (below[at >= 0].sum() + above[at < 0].sum()) / k
        sigma += term
        if term < 1e-7 or len(below) > 1 << 19:
            break
        below, above = (_convolve(x, y) for x, y in ((below, one), (above, tilted)))
    return float(max(lam * d * math.exp(-2 * sigma) / (mean * -math.expm1(-lam * d)), 1e-6))


def _convolve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = len(a) + len(b) - 1
    size = 1 << (n - 1).bit_length()
    return np.clip(np.fft.irfft(np.fft.rfft(a, size) * np.fft.rfft(b, size), size)[:n], 0, None)


def logistic(clean: dict[float, int], toxic: dict[float, int]) -> tuple[float, float]:
    """Slope and bias by Newton steps on two weighted histograms (slope from 0 up)."""
    x = np.clip(np.array([*clean, *toxic]), -30, 60)
    y = np.array([0.0] * len(clean) + [1.0] * len(toxic))
    n = np.array([*clean.values(), *toxic.values()], float)
    w = np.zeros(2)
    rows = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -40, 40)))
        slope = rows.T @ (n * (y - p)) - np.array([1e-2, 1e-3]) * w
        bend = (rows * (n * p * (1 - p))[:, None]).T @ rows + np.diag([1e-2, 1e-3])
        step = np.linalg.solve(bend, slope)
        step *= min(1.0, 2 / max(np.abs(step).max(), 1e-12))
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0]), 0.0), float(w[1])


def held_out(doc_id: Column | str) -> Column:
    """Rows that never train: those whose id, as text, has a CRC-32 of 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(known: DataFrame, most: int) -> DataFrame:
    """All rows, or ``most`` of them by a hash of the id."""
    n = known.count()
    h = F.xxhash64("_id")
    if n > most:  # a little more than needed, so that few rows are sorted
        bound = int(-(2**63) + 2**64 * min(1.0, 1.2 * most / n + 1e-4))
        known = known.where(h <= F.lit(min(bound, 2**63 - 1)))
    return known.orderBy(h, "_id", "_y").limit(most)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    text: str = "text",
    key: str = "doc_id",
    label: str = "toxic",
    max_labels: int = MAX_LABELS,
) -> Model:
    """Count the labelled training documents, then calibrate on all of them."""
    spark = docs.sparkSession
    known = labels.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("_y"))
    known = known.where("_id IS NOT NULL AND _y IN (0, 1)").where(~held_out("_id"))
    sample = stage(_sample(known, max_labels), "labels")
    own = docs.select(F.col(key).alias("_id"), F.col(text).alias("_t"))
    # at most `max_labels` rows of an id and a number
    rows = stage(own.join(F.broadcast(sample), "_id").select("_t", "_y"), "training")
    counted = (
        rows.mapInArrow(_count_features, "slot int, toxic long, clean long")
        .groupBy("slot")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    toxic, clean = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
    n = [0, 0]
    for r in counted.toLocalIterator():
        if r["slot"] < 0:
            n = [r["clean"], r["toxic"]]
        else:
            toxic[r["slot"]], clean[r["slot"]] = r["toxic"], r["clean"]
    if not n[0] or not n[1]:
        return Model(toxic, clean, float(bool(n[1])), Law())
    share = n[1] / sum(n)
    held = spark.sparkContext.broadcast((toxic, clean, share))
    law = extreme_law(_histogram(rows, held, Law())[0])
    _, below, above = _histogram(rows, held, law)
    law.slope, law.bias = logistic(below, above)
    unstage(rows)
    return Model(toxic, clean, share, law)


SCORED = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("evidence", T.DoubleType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("passages", T.ArrayType(T.LongType())),
    ]
)


def score(docs: DataFrame, model: Model, out: str, *, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``out``: ``score, evidence, n_words, passages``.

    ``passages`` is the flat list of starts and ends (exclusive, in words) of the
    significant segments.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m: Model = held.value
        if m.share in (0.0, 1.0):
            return lambda value: (m.share, 0.0, len(alnum_words(value)), [])
        table, law = Scores(m.toxic, m.clean, m.share), m.law

        def one(value):
            scores = [table[w] for w in alnum_words(value)]
            found = segments(scores)
            evidence = law.evidence(len(scores), found)
            room = math.log(law.k * len(scores) + 1) - math.log(SIGNIFICANT)
            passages = [x for a, b, s in found if law.lam * s > room for x in (a, b)]
            return law.probability(evidence), evidence, len(scores), passages

        return one

    return docs.withColumn(out, per_text(make, SCORED)(F.col(text)))


def query(spark, sf_dir: str) -> DataFrame:
    """op7: toxicity of every document, learnt from rows that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score(docs, fit(docs, labels), "t")
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        F.col("t.score").alias("score"),
        (F.col("t.score") >= THRESHOLD).cast("int").alias("predicted"),
        (F.size("t.passages") / 2).cast("long").alias("n_passages"),
    )
