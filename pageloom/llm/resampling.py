"""Importance resampling towards a target text collection, by bit-sliced sums.

Every run of 1 to ``size`` words is hashed to one of ``buckets`` buckets.  A bucket's
*gain* says how much likelier it is in the target texts than in the documents; a
document's *weight* is the floored mean gain of its features.  To the weight comes Gumbel
noise from a keyed hash of the id, and the highest scores are drawn: a draw without
replacement with probabilities in proportion to ``exp(weight / 1000)``.

**Exact weights.**  A document's bucket counts are cut into bit planes: bit ``b`` of
plane ``k`` is bit ``k`` of the count of bucket ``b``.  The gains are whole numbers and
are held as signed (two's complement) planes of the same width.  A product of bits is an
AND, a sum over buckets a population count, and so

    sum of count * gain  =  sum over k, j of  2^k * 2^j * popcount(C_k & G_j),

where the highest gain plane counts negatively.  No rounding occurs, and a text of any
length needs only as many planes as its largest count has bits.

**Draw.**  The scores' histogram is taken in two steps of bounded size, which gives the
lowest score drawn.  Only the rows from there on are sorted, in ranges, and a rank is the
row's place in its range plus the rows of the ranges before.

Three scans: bucket sums of both tables (one bounded table per task, added up), scores,
and the sort of the drawn rows.  The texts are never shuffled.

Defined cases: a null or empty text, or one without words, has no features and weight 0;
repeated rows are rows of their own, each counted, scored and (if drawn) ranked; ties go
to the smaller id, a null id comes last and is hashed as the word ``null``; without rows
of ``min_words`` words nothing is drawn; an empty target has equal counts everywhere.
No other column is read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.text import alnum_words, per_text
from pageloom.plans.staging import stage

BUCKETS = 10_000
SIZE = 1
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
#: Features whose buckets are counted at once.
PART = 1 << 16
#: Scores per step of the first histogram.
STEP = 256

SCORED = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight", "score")]
)


def features(words: list[bytes], size: int) -> Iterable[bytes]:
    """All runs of 1 to ``size`` words, joined by one space."""
    yield from words
    for n in range(2, size + 1):
        yield from map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False))


def bucket_counts(text: str | None, size: int = SIZE, buckets: int = BUCKETS):
    """``(number of words, number of features, counts per bucket)`` of one text."""
    words = alnum_words(text)
    found, n, counts = features(words, size), 0, np.zeros(buckets, np.int64)
    while part := list(map(zlib.crc32, islice(found, PART))):
        n += len(part)
        counts += np.bincount(np.array(part, np.int64) % buckets, minlength=buckets)
    return len(words), n, counts


def _plane(bits: np.ndarray) -> int:
    """Booleans as one large number."""
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


class GainPlanes:
    """Signed whole numbers as bit planes."""

    def __init__(self, gains: np.ndarray):
        gains = np.asarray(gains, np.int64)
        most = int(max(gains.max(initial=0), -1 - gains.min(initial=0)))
        width = most.bit_length()
        self.planes = [(1 << j, _plane((gains >> j) & 1)) for j in range(width)]
        self.planes.append((-(1 << width), _plane(gains < 0)))

    def total(self, counts: np.ndarray) -> int:
        """The exact sum of ``counts * gains``."""
        out = 0
        for k in range(int(counts.max(initial=0)).bit_length()):
            own = _plane((counts >> k) & 1)
            out += sum(value * (own & g).bit_count() for value, g in self.planes) << k
        return out


def _sums(size: int, buckets: int):
    """Per task: the counts of all its texts, as ``(bucket, n)``."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                total += bucket_counts(text.as_py(), size, buckets)[2]
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"]
        )

    return run


def corpus_counts(rows: DataFrame, text: str, size: int, buckets: int) -> list[int]:
    """Features per bucket of a whole table; ``buckets`` numbers reach the driver."""
    found = rows.select(text).mapInArrow(_sums(size, buckets), "bucket int, n long")
    out = [0] * buckets
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(own: list[int], target: list[int]) -> np.ndarray:
    """``floor(1000 ln(share in the target / share among the documents))``, add-one."""
    n = len(own)
    over, under = float(sum(own) + n), float(sum(target) + n)
    ratio = ((t + 1) * over / ((s + 1) * under) for s, t in zip(own, target, strict=True))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def noise(seed: int, doc_id) -> int:
    """Floored Gumbel noise in thousandths, from a hash of the id."""
    name = "null" if doc_id is None else str(doc_id)
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(own_gains: np.ndarray, seed: int, size: int, buckets: int):
    """A column function: the score struct of a ``(key, text)`` struct."""

    def make():
        planes = GainPlanes(own_gains)

        def one(row: dict) -> tuple:
            n_words, n, counts = bucket_counts(row["text"], size, buckets)
            weight = planes.total(counts) // n if n else 0
            return n_words, n, weight, weight + noise(seed, row["key"])

        return one

    return per_text(make, SCORED)


def lowest_drawn(rows: DataFrame, k: int) -> int | None:
    """The score of the ``k``-th highest row of ``(score)``; None if there is none."""
    step = F.floor(F.col("score") / STEP).cast("long")
    left = k
    for r in sorted(rows.groupBy(step.alias("s")).count().collect(), reverse=True):
        if left <= r["count"]:
            inside = rows.where(step == r["s"]).groupBy("score").count().collect()
            for q in sorted(inside, reverse=True):
                if left <= q["count"]:
                    return q["score"]
                left -= q["count"]
        left -= r["count"]
    return None


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``place``: 1, 2, 3 ... in the given order, without a single-task sort.

    ``order`` must say all; otherwise equal rows may change places.
    """
    spark = rows.sparkSession
    at = F.monotonically_increasing_id()
    sorted_rows = stage(rows.orderBy(*order).withColumn("at", at), "ranges")
    piece = F.shiftright("at", 33)
    before, offsets = 0, []
    for r in sorted(sorted_rows.groupBy(piece.alias("piece")).count().collect()):
        offsets.append((r["piece"], before))
        before += r["count"]
    # one row per task of the sort
    starts = spark.createDataFrame(offsets, "piece long, before long")
    placed = sorted_rows.withColumn("piece", piece).join(F.broadcast(starts), "piece")
    place = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    return placed.withColumn("place", place).drop("piece", "before", "at")


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    size: int = SIZE,
    buckets: int = BUCKETS,
    seed: int = SEED,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """``(id, n_words, n_features, weight, score, rank)`` per row of ``docs``.

    Of the rows with ``min_words`` words or more, ``percent`` in a hundred (rounded
    down) are drawn and have a rank.
    """
    own = corpus_counts(docs, text, size, buckets)
    aim = corpus_counts(target, target_text, size, buckets)
    value = scored(gains(own, aim), seed, size, buckets)
    row = F.struct(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    rows = docs.select(F.col(key).alias("id"), value(row).alias("s"))
    rows = stage(rows.select("id", "s.*", F.monotonically_increasing_id().alias("row")), "scores")
    able = F.col("n_words") >= min_words
    k = rows.where(able).count() * percent // 100
    cut = lowest_drawn(rows.where(able), k) if k else None
    none = F.lit(None).cast("long")
    fields = ["id", "n_words", "n_features", "weight", "score"]
    if cut is None:
        return rows.select(*fields, none.alias("rank"))
    drawn = able & (F.col("score") >= cut)
    order = (F.desc("score"), F.asc_nulls_last("id"), F.asc("row"))
    high = ranked(rows.where(drawn), *order)
    place = F.when(F.col("place") <= k, F.col("place"))
    return high.select(*fields, place.alias("rank")).unionByName(
        rows.where(~drawn).select(*fields, none.alias("rank"))
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op11: all documents, with the benchmark as the target."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text")
    found = resample(docs, target)
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


#: CRC-32 is worked out in SQL for the distinct words: its table follows from the
#: polynomial by eight shifts.
ORACLE = r"""
WITH RECURSIVE crc_step AS (
  SELECT i AS b, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1
  FROM crc_step WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY b) AS t FROM crc_step WHERE k = 8),
dw AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
bw AS (
  SELECT unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark),
dt AS MATERIALIZED (
  SELECT r, word, count(*) AS n FROM (SELECT r, unnest(w) AS word FROM dw) GROUP BY r, word),
bt AS (SELECT word, count(*) AS n FROM bw GROUP BY word),
vocabulary AS (SELECT word FROM dt UNION SELECT word FROM bt),
hashed AS MATERIALIZED (
  SELECT word, xor(list_reduce(
      [4294967295::BIGINT] || list_transform(range(1, len(h) // 2 + 1),
        lambda i: ('0x' || substr(h, (2 * i - 1)::BIGINT, 2))::BIGINT),
      lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295::BIGINT) % 10000 AS bucket
  FROM (SELECT word, hex(encode(word)) AS h FROM vocabulary), crc_table),
s AS (SELECT bucket, sum(n) AS n FROM dt JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS n FROM bt JOIN hashed USING (word) GROUP BY bucket),
totals AS (
  SELECT coalesce((SELECT sum(n) FROM s), 0) AS all_s, coalesce((SELECT sum(n) FROM t), 0) AS all_t),
gain AS (
  SELECT b.bucket, floor(1000 * ln(
      (coalesce(t.n, 0) + 1)::DOUBLE * (all_s + 10000)::DOUBLE
      / ((coalesce(s.n, 0) + 1)::DOUBLE * (all_t + 10000)::DOUBLE)))::BIGINT AS g
  FROM range(10000) b(bucket) LEFT JOIN s ON s.bucket = b.bucket
       LEFT JOIN t ON t.bucket = b.bucket, totals),
sums AS (
  SELECT r, sum(n * g) AS total FROM dt JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY r),
weighed AS (
  SELECT r, doc_id, len(w)::BIGINT AS n_features,
         CASE WHEN len(w) = 0 THEN 0
              ELSE ((total - (((total % len(w)) + len(w)) % len(w))) // len(w))::BIGINT END AS weight,
         ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT AS h
  FROM dw LEFT JOIN sums USING (r)),
scores AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM weighed),
places AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS place,
         count(*) OVER () AS able
  FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= (10 * able) // 100 THEN place END AS rank
FROM scores LEFT JOIN places USING (r)
"""
