"""SimHash near-duplicates by the general pigeonhole principle.

**Fingerprint.**  64 bits; a bit is set if it is set in more than half of the XXH64
hashes of the text's word shingles.

**Search** (after Qin et al., "GPH: Similarity Search in Hamming Space", 2018).  The 64
bits are grouped into ``m = distance + 1`` partitions.  If thresholds ``t_i >= -1`` add
up to ``distance - m + 1`` (here: to 0), two fingerprints within ``distance`` bits agree
to within ``t_i`` in at least one partition; a partition with ``t_i = -1`` is not
looked at.  So

1. equal fingerprints are one vertex, however many texts share them;
2. bits that go together are put into the same partition (their correlation is one
   64 x 64 table of sums, the only thing sent to the driver);
3. for every fingerprint a dynamic programme picks the thresholds with the least
   estimated work.  The estimate multiplies the histograms of a partition's two halves
   (tables of fixed size);
4. a fingerprint is filed under its value in every partition, and probes, with its own
   thresholds, all values within ``t_i``;
5. pairs that meet are verified on all 64 bits.

Where a partition's value is shared by many fingerprints (known from the same tables, so
filing and probing decide alike), the key is made longer by the same principle: the
other bits are cut into ``distance + 1`` parts, one of which must be equal.  The key of
a hot value is so spread over many groups, and no link is lost.

Defined cases: a null or empty text, or one without words, has fingerprint zero, which
links like any other; equal ids share a component if their fingerprints do; a null id
never names a component unless all its ids are null; an empty table has no rows.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.llm.text import per_text, space_words, unused
from pageloom.operators.components import components
from pageloom.plans.staging import stage

BITS = 64
SHINGLE = 3
DISTANCE = 2
SEED = 42
#: Fingerprints that share a value, from which its key is made longer.
SHARED = 256
#: Work of one probe, in candidates.
PROBE = 2.0
#: Shingles whose bits are counted at once.
PART = 1 << 16


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The 64-bit fingerprint, unsigned."""
    words = space_words(text)
    if not words:
        return 0
    size = min(size, len(words))
    hashed = functools.partial(xxhash.xxh64_digest, seed=SEED)
    n = len(words) - size + 1
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, PART):
        part = words[at : at + PART + size - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(size)), strict=False))
        digests = np.frombuffer(b"".join(map(hashed, shingles)), np.uint8).reshape(-1, 8)
        counts += np.unpackbits(digests, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(text: Column, size: int = SHINGLE) -> Column:
    """The fingerprint as a (signed) long."""

    def make():
        return lambda value: signed(fingerprint(value, size))

    return per_text(make, T.LongType())(text)


def _bit_rows(values: np.ndarray) -> np.ndarray:
    """Bit 0 is the lowest."""
    return ((values.view(np.uint64)[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(
        np.int64
    )


def _bit_products(batches):
    """Per task: how often two bits are set together."""
    total = np.zeros((BITS, BITS), np.int64)
    for batch in batches:
        rows = _bit_rows(batch.column(0).to_numpy(zero_copy_only=False))
        total += rows.T @ rows
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(BITS), pa.int32()), pa.array(total.tolist(), pa.list_(pa.int64()))],
        names=["bit", "n"],
    )


def correlation(distinct: DataFrame) -> np.ndarray:
    """Absolute correlation of the bits of all distinct fingerprints."""
    rows = distinct.select("fp").mapInArrow(_bit_products, "bit int, n array<long>")
    summed = rows.select("bit", F.posexplode("n").alias("other", "n")).groupBy("bit", "other")
    together = np.zeros((BITS, BITS))
    for r in summed.agg(F.sum("n").alias("n")).collect():
        together[r["bit"], r["other"]] = r["n"]
    n = max(distinct.count(), 1)
    p = np.diag(together) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    out = np.abs(together / n - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(out, 0)
    return out


def partitions(bond: np.ndarray, m: int) -> list[list[int]]:
    """``m`` groups of bits, as equal as can be; each next bit is the one closest to
    the group so far, each group begins with the strongest bond left."""
    left, out = set(range(BITS)), []
    for i in range(m):
        width = BITS * (i + 1) // m - BITS * i // m
        seed = max(left, key=lambda b: (max((bond[b, c] for c in left), default=0), -b))
        group = [seed]
        left.remove(seed)
        while len(group) < width:
            b = max(left, key=lambda b: (bond[b, group].sum(), -b))
            group.append(b)
            left.remove(b)
        out.append(sorted(group))
    return out


def pack(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each value, as a number."""
    v = values.view(np.uint64)
    out = np.zeros(len(v), np.int64)
    for i, b in enumerate(bits):
        out |= ((v >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << i
    return out


class Plan:
    """Partitions, their halves' histograms, and what follows from them."""

    def __init__(self, groups: list[list[int]], distance: int):
        self.groups, self.distance = groups, distance
        self.m = len(groups)
        self.halves = [(g[: len(g) // 2], g[len(g) // 2 :]) for g in groups]
        #: Parts of the bits outside a partition, for longer keys.
        self.rest = []
        for i in range(self.m):
            others = [b for j, g in enumerate(groups) if j != i for b in g]
            self.rest.append([others[k :: distance + 1] for k in range(distance + 1)])
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []
        self.total = 0

    def load(self, tables, total: int) -> Plan:
        """Histograms of the halves; also at each exact distance from a value."""
        self.tables, self.total = tables, total
        self.near = [tuple(self._around(t) for t in pair) for pair in tables]
        return self

    def _around(self, counts: np.ndarray) -> np.ndarray:
        """Row ``d``: fingerprints whose half differs in exactly ``d`` bits."""
        width = int(len(counts)).bit_length() - 1
        rows = np.zeros((self.distance + 1, len(counts)))
        rows[0] = counts
        for bit in range(width):
            flipped = rows[:, np.arange(len(counts)) ^ (1 << bit)]
            rows[1:] += flipped[:-1]
        return rows

    def half_values(self, values: np.ndarray, i: int):
        return tuple(pack(values, h) for h in self.halves[i])

    def hot(self, i: int, key: np.ndarray) -> np.ndarray:
        """Whether a partition's value may be shared by many fingerprints."""
        low = len(self.halves[i][0])
        a, b = self.tables[i]
        return np.minimum(a[key & ((1 << low) - 1)], b[key >> low]) > SHARED

    def work(self, values: np.ndarray, i: int) -> np.ndarray:
        """Row ``t + 1``: estimated candidates and probes of partition ``i`` at ``t``."""
        from math import comb

        a, b = self.half_values(values, i)
        near_a, near_b = self.near[i]
        out = np.zeros((self.distance + 2, len(values)))
        total = max(self.total, 1)
        for t in range(self.distance + 1):
            exact = sum(near_a[d][a] * near_b[t - d][b] for d in range(t + 1)) / total
            out[t + 1] = out[t] + exact + PROBE * comb(len(self.groups[i]), t)
        return out

    def thresholds(self, values: np.ndarray) -> np.ndarray:
        """Per fingerprint and partition, thresholds of least total work."""
        n, goal = len(values), self.distance - self.m + 1
        low = -self.m
        # best[s - low]: least work of the partitions so far with thresholds adding to s
        width = self.distance - low + 1
        best = np.full((width, n), np.inf)
        best[-low] = 0
        choices = []
        for i in range(self.m):
            work = self.work(values, i)
            new, choice = np.full((width, n), np.inf), np.zeros((width, n), np.int8)
            for s in range(low, self.distance + 1):
                for t in range(-1, self.distance + 1):
                    if low <= s - t <= self.distance:
                        cost = best[s - t - low] + work[t + 1]
                        better = cost < new[s - low]
                        new[s - low][better] = cost[better]
                        choice[s - low][better] = t
            best = new
            choices.append(choice)
        out = np.zeros((self.m, n), np.int64)
        s = np.full(n, goal)
        for i in range(self.m - 1, -1, -1):
            out[i] = choices[i][s - low, np.arange(n)]
            s = s - out[i]
        return out

    def keys(self, values: np.ndarray, i: int, key: np.ndarray):
        """``(rows, part, sub)``: the keys under which a partition's value is looked up.

        ``part`` numbers the partition and, for hot values, the part of the other bits
        whose value is ``sub``.
        """
        hot = self.hot(i, key)
        cold = np.flatnonzero(~hot)
        yield cold, i * 8, np.zeros(len(cold), np.int64)
        warm = np.flatnonzero(hot)
        for k, bits in enumerate(self.rest[i]):
            yield warm, i * 8 + k + 1, pack(values[warm], bits)


KEYS = "part int, value long, sub long, fp long"


def _emit(rows):
    for fp, part, value, sub in rows:
        if len(fp):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(fp), part, np.int32)),
                    pa.array(value),
                    pa.array(sub),
                    pa.array(fp),
                ],
                names=["part", "value", "sub", "fp"],
            )


def _file(held):
    """Every fingerprint under its value in every partition."""

    def run(batches):
        plan = held.value
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i in range(plan.m):
                value = pack(fp, plan.groups[i])
                for rows, part, sub in plan.keys(fp, i, value):
                    yield from _emit([(fp[rows], part, value[rows], sub)])

    return run


def _flips(width: int, t: int) -> list[int]:
    """All masks of at most ``t`` of ``width`` bits."""
    from itertools import combinations

    return [sum(1 << b for b in c) for d in range(t + 1) for c in combinations(range(width), d)]


def _probe(held):
    """Every fingerprint under all values within its thresholds."""

    def run(batches):
        plan = held.value
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            chosen = plan.thresholds(fp)
            for i in range(plan.m):
                value = pack(fp, plan.groups[i])
                for t in range(plan.distance + 1):
                    own = np.flatnonzero(chosen[i] == t)
                    for mask in _flips(len(plan.groups[i]), t) if len(own) else ():
                        seen = value[own] ^ mask
                        for rows, part, sub in plan.keys(fp[own], i, seen):
                            yield from _emit([(fp[own][rows], part, seen[rows], sub)])

    return run


def _halves_table(plan: Plan):
    """Per task: histograms of the halves of all partitions."""

    def run(batches):
        counts = [[np.zeros(1 << len(h), np.int64) for h in pair] for pair in plan.halves]
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i in range(plan.m):
                for side, v in enumerate(plan.half_values(fp, i)):
                    counts[i][side] += np.bincount(v, minlength=len(counts[i][side]))
        for i, pair in enumerate(counts):
            for side, c in enumerate(pair):
                used = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(used), 2 * i + side, np.int32)),
                        pa.array(used.astype(np.int64)),
                        pa.array(c[used]),
                    ],
                    names=["half", "value", "n"],
                )

    return run


def make_plan(distinct: DataFrame, distance: int) -> Plan:
    """Group the bits and count the halves over all distinct fingerprints."""
    plan = Plan(partitions(correlation(distinct), distance + 1), distance)
    counted = distinct.select("fp").mapInArrow(_halves_table(plan), "half int, value long, n long")
    tables = [tuple(np.zeros(1 << len(h), np.int64) for h in pair) for pair in plan.halves]
    for r in counted.groupBy("half", "value").agg(F.sum("n").alias("n")).toLocalIterator():
        tables[r["half"] // 2][r["half"] % 2][r["value"]] = r["n"]
    total = int(tables[0][0].sum())
    return plan.load(tables, total)


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``(u, v)``: all pairs ``u < v`` of distinct fingerprints within the distance (1 to 6).

    ``distinct`` is a staged table of distinct, non-null longs ``fp``.
    """
    if not 1 <= distance <= 6:  # tables of 2^32 entries without partitions; keys number eight parts
        raise ValueError("a distance of 1 to 6 bits")
    held = distinct.sparkSession.sparkContext.broadcast(make_plan(distinct, distance))
    key = ["part", "value", "sub"]
    filed = distinct.select("fp").mapInArrow(_file(held), KEYS).withColumnRenamed("fp", "filed")
    probes = distinct.select("fp").mapInArrow(_probe(held), KEYS)
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("filed"))) <= distance
    return (
        probes.join(filed, key)
        .where((F.col("fp") != F.col("filed")) & near)
        .select(F.least("fp", "filed").alias("u"), F.greatest("fp", "filed").alias("v"))
        .distinct()
    )


def classes(ids: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``(fp, id, fp_of_id)`` of each distinct fingerprint's component.

    ``ids`` has ``id, fp`` per document.  ``id`` is the smallest of the component, and
    ``fp_of_id`` the smallest fingerprint that it has there.
    """
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", F.col("fp").alias("of")))
    own = stage(ids.groupBy("fp").agg(first.alias("first")), "fingerprints")
    linked = components(stage(links(own, distance), "links"))
    linked = stage(linked.select(F.col("vertex").alias("fp"), "component"), "linked")
    named = own.join(linked, "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    lowest = named.groupBy("component").agg(F.min("first").alias("lowest"))
    return stage(
        named.join(lowest, "component").select(
            "fp", F.col("lowest.id").alias("id"), F.col("lowest.of").alias("fp_of_id")
        ),
        "classes",
    )


def near_duplicates(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """``(id, fp, component_id)`` per row of ``docs``."""
    own = stage(
        docs.select(F.col(key).alias("id"), fingerprints(F.col(text), size).alias("fp")), "simhash"
    )
    found = classes(own, distance).select("fp", F.col("id").alias("component_id"))
    return own.join(found, "fp").select("id", "fp", "component_id")


def one_of_each(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of its smallest id.

    Texts are fingerprinted once, into a narrow table.  Rows are found again by their id;
    only those of ids that stand on texts of several fingerprints need theirs a second time.
    """
    fp, name = (unused(docs, f"__simhash_{c}") for c in ("fp", "id"))
    ids = docs.select(F.col(key).alias("id"), fingerprints(F.col(text), size).alias("fp"))
    ids = stage(ids, "simhash")
    # a name that is never null, so that join and duplicates need the same shuffle
    named = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))
    many = ids.groupBy(named(F.col("id")).alias(name)).agg(F.min("fp").alias("a"), F.max("fp").alias("b"))
    many = stage(many.where("a <> b").select(name), "ids-of-many")
    kept = classes(ids, distance).select(
        named(F.col("id")).alias(name), F.col("fp_of_id").alias(fp)
    )
    kept = stage(kept.distinct(), "kept")
    own = docs.withColumn(name, named(F.col(key)))
    plain = kept.join(many, name, "left_anti").select(name)
    first = own.join(plain, name, "left_semi").dropDuplicates([name])
    rest = own.join(many, name, "left_semi").withColumn(fp, fingerprints(F.col(text), size))
    rest = rest.join(kept, [name, fp], "left_semi").dropDuplicates([name, fp])
    return first.unionByName(rest.drop(fp)).drop(name)


def query(spark, sf_dir: str) -> DataFrame:
    """op3: fingerprint and component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = near_duplicates(docs)
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
