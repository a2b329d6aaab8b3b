"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Every run of ``window`` consecutive words of a benchmark item is a pattern (an item
with fewer words, but not none, is one pattern).  A document is scanned with tables
after Wu and Manber (1994), with words in place of characters: the two words that end
the current position give a *shift*, and most positions are skipped; where the shift is
zero, the bucket of that suffix, split by the first two words, names the patterns to
compare directly.

The documents are not shuffled.  Patterns go to the tasks in blocks of bounded size:
items are cut into overlapping pieces, pieces are dealt over as many blocks as their
total size needs, and each block is one more scan over the documents, whose hits are
added to those before.

Defined cases: a null or empty text has no words, no hits and is not contaminated; a
null or empty item, or one without words, has no pattern; an item that occurs twice in
the table counts once; repeated document rows give repeated rows; an empty benchmark
leaves all documents clean.  Other columns of either table are not read, and keep their
values whatever they are called (only a column named ``out`` is replaced).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.text import alnum_words, per_text, unused
from pageloom.plans.staging import stage

#: UTF-8 bytes of benchmark words in one block (a task's tables take some 80 times that).
BLOCK_BYTES = 2_000_000
#: Words of one piece of an item, besides the overlap.
PIECE_WORDS = 2_000
#: Blocks scanned in one pass before the hits are written.
BLOCKS_PER_PASS = 4

HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


class WuManber:
    """Patterns of one length, searched together."""

    def __init__(self, patterns: Iterable[tuple[bytes, ...]], length: int):
        self.length = length
        self.block = min(2, length)
        # last word of a block -> word before it -> how far the block's end is from
        # the end of a pattern, at least
        self.shift: dict[bytes, dict[bytes | None, int]] = defaultdict(dict)
        self.buckets: dict[tuple, dict[tuple, list[tuple]]] = defaultdict(dict)
        for p in patterns:
            self.shift[p[0]]  # a known word: a pattern may begin at it
            for end in range(self.block - 1, length):
                before = p[end - 1] if self.block == 2 else None
                row, far = self.shift[p[end]], length - 1 - end
                row[before] = min(row.get(before, length), far)
            bucket = self.buckets[p[length - self.block :]]
            bucket.setdefault(p[: self.block], []).append(p)

    def find(self, words: list[bytes]) -> Iterable[tuple[int, tuple[bytes, ...]]]:
        """Start and pattern of every occurrence."""
        m, block, shift = self.length, self.block, self.shift
        i, n = m - 1, len(words)
        while i < n:
            row = shift.get(words[i])
            if row is None:
                i += m
                continue
            step = row.get(words[i - 1] if block == 2 else None, m - block + 1)
            if step:
                i += step
                continue
            first = i - m + 1
            bucket = self.buckets.get(tuple(words[i - block + 1 : i + 1]))
            for p in bucket.get(tuple(words[first : first + block]), ()) if bucket else ():
                if tuple(words[first : i + 1]) == p:
                    yield first, p
            i += 1


def merge(spans: Iterable[tuple[int, int]]) -> list[int]:
    """Union of half-open intervals, as a flat list of starts and ends."""
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def windows(words: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    size = min(size, len(words))
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


def _pieces(size: int):
    """Items cut into pieces that share ``size - 1`` words, so that no window is lost."""

    def cut(batches):
        for batch in batches:
            rows = []
            for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = alnum_words(text)
                for at in range(0, max(len(words) - size + 1, min(len(words), 1)), PIECE_WORDS):
                    piece = b" ".join(words[at : at + PIECE_WORDS + size - 1]).decode()
                    rows.append((item, piece, len(piece.encode())))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[k] for r in rows], type=t)
                    for k, t in enumerate((pa.string(), pa.string(), pa.int64()))
                ],
                names=["item", "piece", "n_bytes"],
            )

    return cut


def _scan(block, window: int):
    """Add the hits of one broadcast block to those found so far."""

    def make():
        owners: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
        for item, piece in block.value:
            for w in windows(piece.encode().split(), window):
                owners[w].add(item)
        by_length = defaultdict(list)
        for w in owners:
            by_length[len(w)].append(w)
        tables = [WuManber(ws, length) for length, ws in sorted(by_length.items())]

        def scan(row: dict) -> tuple:
            words = alnum_words(row["text"])
            before = row["before"] or {"spans": [], "items": []}
            flat = before["spans"]
            spans = set(zip(flat[::2], flat[1::2], strict=True))
            items = set(before["items"])
            for table in tables:
                for at, w in table.find(words):
                    spans.add((at, at + len(w)))
                    items |= owners[w]
            return len(words), merge(spans), sorted(items)

        return scan

    return per_text(make, HITS)


def with_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    out: str,
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a struct column ``out``: ``n_words``, ``spans``, ``items``.

    ``spans`` is the flat list of starts and ends (exclusive, in words) of the parts of
    the text that occur in the benchmark, ``items`` the ids of the items they come
    from, sorted as strings.  A column of ``docs`` with the name ``out`` is replaced.
    """
    spark = docs.sparkSession
    pieces = stage(
        benchmark.select(F.col(item).cast("string"), F.col(item_text))
        .mapInArrow(_pieces(window), "item string, piece string, n_bytes long")
        .where("item IS NOT NULL")
        .distinct(),
        "pieces",
    )
    total = pieces.agg(F.sum("n_bytes")).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    found = docs.withColumn(out, F.lit(None).cast(HITS))
    for b in range(blocks):
        own = pieces.where(F.pmod(F.xxhash64("item", "piece"), F.lit(blocks)) == b)
        held = spark.sparkContext.broadcast(
            [(r[0], r[1]) for r in own.select("item", "piece").toLocalIterator()]
        )
        row: Column = F.struct(F.col(text).alias("text"), F.col(out).alias("before"))
        found = found.withColumn(out, _scan(held, window)(row))
        if b % BLOCKS_PER_PASS == BLOCKS_PER_PASS - 1 and b + 1 < blocks:
            found = stage(found, "hits")
    return found


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", out: str = "hits", **options
) -> DataFrame:
    """``docs`` with ``out``: ``n_words, n_hit, spans, items, contaminated``.

    Contaminated: some word is hit and at least one word in twenty is.
    """
    raw = unused(docs, f"{out}_raw")
    found = with_hits(docs, benchmark, raw, text=text, **options)
    spans = F.col(f"`{raw}`.spans")
    evens = F.filter(spans, lambda _, i: i % 2 == 0)
    odds = F.filter(spans, lambda _, i: i % 2 == 1)
    n_hit = F.aggregate(
        F.zip_with(odds, evens, lambda b, a: b - a), F.lit(0).cast("long"), lambda s, x: s + x
    )
    n_words = F.col(f"`{raw}`.n_words")
    return found.withColumn(
        out,
        F.struct(
            n_words.alias("n_words"),
            n_hit.alias("n_hit"),
            spans.alias("spans"),
            F.col(f"`{raw}`.items").alias("items"),
            ((n_hit > 0) & (20 * n_hit >= n_words)).alias("contaminated"),
        ),
    ).drop(raw)


def query(spark, sf_dir: str) -> DataFrame:
    """op2: every document against every benchmark item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    h = decontaminate(docs, benchmark)
    return h.select(
        "doc_id",
        F.col("hits.n_words").alias("n_words"),
        F.col("hits.n_hit").alias("n_hit"),
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
        F.col("hits.contaminated").alias("contaminated"),
    )


ORACLE = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS g
  FROM (SELECT item_id, w, least(13, len(w)) AS m,
               unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i
        FROM bw WHERE len(w) > 0)),
grams AS (
  SELECT doc_id, i, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i
        FROM dw, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
occ AS (SELECT doc_id, i, m, item_id FROM grams JOIN win USING (m, g)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS p FROM occ) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM occ) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
