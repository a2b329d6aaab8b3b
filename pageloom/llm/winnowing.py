"""Document fingerprints by winnowing (Schleimer, Wilkerson and Aiken, 2003).

Every run of ``k`` characters is hashed with a rolling polynomial; of every ``window``
consecutive hashes the smallest is kept, the rightmost one where several are equal,
together with its position.  Two texts that share a run of ``window + k - 1`` characters
share a kept hash, and no match shorter than ``k`` is ever reported.

The hash of a run is the difference of two prefix sums modulo 2^64, mixed and cut to 40
bits; the low 24 bits of the compared number hold the position, counted down, so that
one minimum gives both the smallest hash and the rightmost place.  Texts longer than
2^23 characters are taken in overlapping parts; nothing is cut off.

Defined cases: a null text is an empty one and has no hashes; a text shorter than ``k``
characters is one run; equal texts have equal fingerprints; two texts without hashes are
alike (1), one with and one without are not (0).
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.text import per_text

K, WINDOW = 12, 16
#: Odd multiplier of the rolling hash, its inverse modulo 2^64, and the mixer's factor.
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)
MIX = np.uint64(0xFF51AFD7ED558CCD)
PART = 1 << 23
_POS = np.uint64((1 << 24) - 1)
_HASH = ~_POS

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int, name: str, base: int) -> np.ndarray:
    """``base`` to the 0th, 1st, ... power modulo 2^64 (grown as longer texts come)."""
    have = _powers[name]
    if len(have) < n:
        steps = np.full(max(n, 2 * len(have)), base, np.uint64)
        steps[0] = 1
        have = _powers[name] = np.multiply.accumulate(steps)
    return have[:n]


def _runs(codes: np.ndarray, k: int) -> np.ndarray:
    """Mixed hash of every run of ``k`` codes, in the high 40 bits."""
    n = len(codes)
    terms = (codes.astype(np.uint64) + np.uint64(1)) * _power(n, "down", UNBASE)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    h = (sums[k:] - sums[: n - k + 1]) * _power(n - k + 1, "up", BASE)
    h ^= h >> np.uint64(33)
    h *= MIX
    h ^= h >> np.uint64(29)
    h *= MIX
    return h & _HASH


def _minima(keys: np.ndarray, window: int) -> np.ndarray:
    """Minimum of every ``window`` consecutive keys."""
    have, out = 1, keys
    while have < window:
        step = min(have, window - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def winnow(text: str | None, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Kept hashes (40 bits) and their positions, in text order."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    n = len(codes)
    if n == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    k = min(k, n)
    n_runs = n - k + 1
    window = min(window, n_runs)
    n_windows = n_runs - window + 1
    hashes, places = [], []
    for at in range(0, n_windows, PART):
        ends = min(at + PART, n_windows) + window - 1
        runs = _runs(codes[at : ends + k - 1], k)
        low = _minima(runs | (_POS - np.arange(len(runs), dtype=np.uint64)), window)
        first = np.ones(len(low), bool)
        np.not_equal(low[1:], low[:-1], out=first[1:])
        low = low[first]
        hashes.append(low >> np.uint64(24))
        places.append((_POS - (low & _POS)).astype(np.int64) + at)
    h, p = np.concatenate(hashes), np.concatenate(places)
    keep = np.ones(len(p), bool)
    keep[1:] = p[1:] != p[:-1]
    return h[keep], p[keep]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the distinct hashes of both that both have."""
    x, y = np.unique(a), np.unique(b)
    both = len(np.intersect1d(x, y, assume_unique=True))
    either = len(x) + len(y) - both
    return both / either if either else 1.0


def digest(hashes: np.ndarray) -> str:
    """The kept hashes in text order as one short string."""
    return hashlib.sha256(hashes.astype("<u8").tobytes()).hexdigest()[:32]


KEPT = T.StructType(
    [
        T.StructField("hashes", T.ArrayType(T.LongType())),
        T.StructField("positions", T.ArrayType(T.LongType())),
    ]
)


def fingerprints(df: DataFrame, out: str, *, text="text", k=K, window=WINDOW) -> DataFrame:
    """``df`` with a struct column ``out``: the kept ``hashes`` and their ``positions``."""

    def make():
        def one(value):
            h, p = winnow(value, k, window)
            return h.astype(np.int64), p

        return one

    return df.withColumn(out, per_text(make, KEPT)(F.col(text)))


# --- a text, its edited form and the next document ---------------------------

#: Rows that one range of ids is meant to hold.
ROWS_PER_RANGE = 10_000

COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def edit(text: str, following: str) -> str:
    """The last quarter replaced by as much (or all) of the following text's start."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _compare(rows: Iterator[tuple], k: int, window: int) -> Iterator[tuple]:
    """Rows ``(place, doc_id, text)`` in order, each against the next of its range.

    ``place`` is twice the range, plus one for the row borrowed from the next range.
    """
    last = None
    for place, doc_id, text in rows:
        here = winnow(text, k, window)[0]
        if last is not None and last[0] == place // 2:
            _, last_id, last_text, last_kept = last
            changed = edit(last_text, text)
            kept = winnow(changed, k, window)[0]
            yield (
                last_id,
                len(last_text),
                hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(),
                digest(last_kept),
                digest(kept),
                likeness(last_kept, kept),
                likeness(last_kept, here),
            )
        last = None if place % 2 else (place // 2, doc_id, text, here)


def _compare_batches(k: int, window: int):
    kinds = (pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64())
    names = [c.split()[0] for c in COMPARED.split(", ")]

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        held = []
        for row in _compare(rows(), k, window):
            held.append(row)
            if len(held) == 10_000:
                yield pack(held)
                held = []
        if held:
            yield pack(held)

    def pack(held):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=t) for c, t in zip(zip(*held, strict=True), kinds, strict=True)],
            names=names,
        )

    return run


def compare_with_next(
    docs: DataFrame,
    *,
    k: int = K,
    window: int = WINDOW,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Each text, its edited form and the next document by ``doc_id``, compared.

    Ids are cut into ranges by quantiles; their number follows the input, and only the
    bounds and the lowest id of each range reach the driver.  The first row of a range
    is also sent to the range before it, that of the first range to the last one; then
    every range is read once, in order.  The texts are shuffled once.

    Null ids come last; rows with equal ids follow one another by text.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    n = rows.count()
    pieces = max(1, n // rows_per_range)
    cuts = (
        rows.approxQuantile("doc_id", [i / pieces for i in range(1, pieces)], 0.25 / pieces)
        if pieces > 1
        else []
    )
    bounds = spark.sparkContext.broadcast(sorted({int(c) for c in cuts}))

    def part_of(i):
        return len(bounds.value) + 1 if i is None else bisect.bisect_right(bounds.value, i)

    @F.arrow_udf("int")
    def part(ids: pa.Array) -> pa.Array:
        return pa.array([part_of(i) for i in ids.to_pylist()], type=pa.int32())

    lowest = rows.groupBy(part("doc_id").alias("part")).agg(F.min("doc_id").alias("low"))
    firsts = {r["part"]: r["low"] for r in lowest.toLocalIterator()}
    parts = sorted(firsts)
    before = dict(zip(parts, parts[-1:] + parts[:-1], strict=True))
    ends = spark.sparkContext.broadcast((firsts, before))

    @F.arrow_udf("array<int>")
    def places(ids: pa.Array) -> pa.Array:
        low, previous = ends.value
        out = []
        for i in ids.to_pylist():
            p = part_of(i)
            out.append([2 * p, 2 * previous[p] + 1] if i == low[p] else [2 * p])
        return pa.array(out, type=pa.list_(pa.int32()))

    dealt = (
        rows.select(F.explode(places("doc_id")).alias("place"), "doc_id", "text")
        .repartition(max(1, len(parts)), F.expr("place div 2"))
        .sortWithinPartitions("place", F.col("doc_id").asc_nulls_last(), "text")
    )
    return dealt.mapInArrow(_compare_batches(k, window), COMPARED)


def query(spark, sf_dir: str) -> DataFrame:
    """op5: every document, its edited text and the next document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return compare_with_next(docs.select("doc_id", "text"))
