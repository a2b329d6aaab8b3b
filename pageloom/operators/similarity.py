"""Pages within a distance of each other, exactly and without comparing all.

A page is its vector of TF-IDF weights, all of them >= 0.  Two distances exist:

* ``euclid``: ``sqrt(sum (a_w - b_w)^2)``, a missing word counting as 0;
* ``symdiff``: ``sqrt(sum w^2)`` over the words that only one page holds.

A pair belongs to the result if its distance, rounded to six digits, is at most
``t``.  Three kinds of pairs are kept apart, because two of them need no
search and would only be a long list:

1. **Copies.**  Pages with the same words, equally often, have distance 0.
   They are one *content*; its lowest page id stands for it, and
   :attr:`Vectors.copies` maps every page to it.
2. **Light pairs.**  ``|a|^2 + |b|^2 <= t^2`` puts the distance under ``t``
   whatever the words are.  The norms in :attr:`Vectors.norms` say it all.
3. **Found pairs**, every other pair: :func:`found_pairs` lists them.

The three together are the whole result (``tests/test_similarity.py`` unfolds
and compares them with all pairs).  :func:`found_pairs` lists the first two as well, page
by page, if it is told to list every pair; the registered pair queries do.

Finding rests on one order of all words, rarest first.  At the first word that two
pages share, the words before it are in one of them only, so their squared weights,
``before_x + before_y``, are part of the squared distance.  A pair within ``t`` thus
meets at a word where that sum is at most ``t^2``, and the common words, which come
last, hardly ever are such a place.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.functions.text import ascii_words
from pageloom.operators.dictionary import word_numbers
from pageloom.operators.terms import count_rows, counted_words
from pageloom.plans.staging import stage

#: Distances are compared after rounding to six digits.
HALF_UNIT = 5e-7

#: Contents that one block of the search may hold, however short they are.
PAGES_PER_SPLIT = 200_000

#: Words are compared up to this much squared weight before them, in units of ``t^2``.
#: 1 is enough to find every pair; more makes more rows meet and fewer pairs verified.
COMPARED_MASS = 1.0

#: Meetings of pairs at words, and entries of vectors, that a tile looks at together.
MEETINGS, ENTRIES = 1 << 18, 1 << 19
#: Words of a vector from which it is compared for itself.
LONG = 128
#: A word on at least one content of a tile in so many is multiplied as a dense column.
COMMON = 32
#: Work of a meeting and of a dense product, in entries added one by one.
PER_MEETING, PER_PRODUCT = 8.0, 0.01
#: Contents of the two sides that are multiplied at once.
LEFT_CONTENTS, RIGHT_CONTENTS = 2048, 512
#: Dense columns of a product at most, the most common words first.
COLUMNS = 4096
#: Pairs of a tile that are compared, and found ones that are connected, together.
COMPARED, CONNECTED = 1 << 18, 1 << 20
#: Pairs of pages that a tile gives at once.
ROWS = 1 << 18
#: Word numbers below this are looked up as they are; larger ones are numbered anew in a tile.
KNOWN_WORDS = 4 << 20

#: Words, with repeats over contents, of one block; a tile of the verification holds two
#: blocks, and vectors travel once for every block there is.
WORDS_PER_BLOCK = 3 << 19
#: Words of one row of a block.  Spark copies a row several times and each time as a whole,
#: so rows are small, and a block is several.
WORDS_PER_ROW = 1 << 19
#: Copies of a content that a row of a block stands for, if all pages are listed.
PAGES_PER_ROW = 512
#: Blocks of at least ``CONTENTS_PER_BLOCK`` contents that there are in any case, so that
#: all cores have tiles.
LEAST_BLOCKS, CONTENTS_PER_BLOCK = 8, 1024

METRICS = ("euclid", "symdiff")


@dataclass(frozen=True)
class Vectors:
    """Vectors of the distinct contents.

    ``copies``: ``(page_id, rep)`` for every page with a token.
    ``norms``: ``(rep, n_pages, norm_sq)`` per content.
    ``terms``: ``(rep, word, df, weight, norm_sq, before)``; ``word`` is a number in the
    order of all words, ``before`` the squared weight of the content's words that come
    first in it.
    ``lengths``: ``(page_id, n_words)`` for every page with a token.
    """

    copies: DataFrame
    norms: DataFrame
    terms: DataFrame
    lengths: DataFrame | None = None


def build_vectors(pages: DataFrame, keep: Column | None = None) -> Vectors:
    """Collapse copies, weigh the words, and order each content's words.

    Weights are ``n / length * ln(N / df)``, where ``df`` counts the kept pages,
    copies included, and ``N`` all pages of the input.
    """
    n_all = pages.agg(F.count("*").alias("n")).scalar()
    kept = pages if keep is None else pages.where(keep)
    # the only pass over the text
    by_page = counted_words(kept, ascii_words, "page_id")
    counted = stage(by_page.withColumn("signature", F.unhex(_signature("counts"))), "counted")
    counted = counted.where("n_words > 0")  # not before: it would split the text again
    signed = counted.select("page_id", "n_words", "signature")
    contents = stage(
        signed.groupBy("signature").agg(
            F.min("page_id").alias("rep"), F.count("*").alias("n_pages")
        ),
        "contents",
    )
    copies = signed.select("page_id", "signature").join(contents, "signature").select("page_id", "rep")
    # one page stands for its copies, before its words become rows
    once = counted.join(contents.select(F.col("rep").alias("page_id"), "n_pages"), "page_id")
    tf = stage(
        count_rows(once, "page_id", "n_pages", "n_words").withColumnRenamed("page_id", "rep"), "tf"
    )
    numbers = word_numbers(tf.groupBy("word").agg(F.sum("n_pages").alias("df")))
    of_page = Window.partitionBy("rep")
    in_order = of_page.orderBy("word").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    square = F.col("weight") * F.col("weight")
    idf = F.ln(n_all / F.col("df"))
    ordered = (
        tf.join(numbers, "word")
        .select(
            "rep", "n_pages", F.col("word_id").alias("word"), "df",
            (F.col("n") / F.col("n_words") * idf).alias("weight"),
        )
        .withColumn("norm_sq", F.sum(square).over(of_page))
        .withColumn("before", F.sum(square).over(in_order) - square)
    )
    vectors = stage(ordered, "vectors")
    norms = stage(
        vectors.groupBy("rep").agg(
            F.max("n_pages").alias("n_pages"), F.max("norm_sq").alias("norm_sq")
        ),
        "norms",
    )
    return Vectors(copies, norms, vectors.drop("n_pages"), signed.select("page_id", "n_words"))


def _signature(counts: str) -> Column:
    """Digest of a page's words and their numbers; sorted, so that order does not count."""
    item = lambda c: F.concat_ws(" ", c["word"], c["n"].cast("string"))
    return F.sha2(F.array_join(F.transform(counts, item), " "), 256)


def _reach(threshold: float) -> float:
    return threshold + HALF_UNIT


def packed_vectors(terms: DataFrame) -> DataFrame:
    """``(rep, norm_sq, words, weights)``, a row per content, its words in their order."""
    entries = F.sort_array(F.collect_list(F.struct("word", "weight")))
    return (
        terms.where("weight > 0")
        .groupBy("rep")
        .agg(F.max("norm_sq").alias("norm_sq"), entries.alias("t"))
        .select("rep", "norm_sq", F.col("t.word").alias("words"), F.col("t.weight").alias("weights"))
    )


def found_pairs(
    vectors: Vectors,
    threshold: float,
    metric: str = "euclid",
    pages_per_split: int = PAGES_PER_SPLIT,
    among_light: bool = True,
    every: bool = False,
) -> DataFrame:
    """``(page_a, page_b, dist)`` with ``page_a < page_b``, both lowest of their copies.

    Without ``among_light``, pairs of two contents that are both in some light
    pair are left out; a graph does not need them.  With ``every``, all pages within the
    threshold are listed: copies, light pairs, and pairs of copies of the contents found.
    That list grows with the square of the copies and of the light pages.
    """
    if every:
        packed = stage(_with_pages(vectors), "packed")
        found = _tiled(packed, threshold, metric, pages_per_split)
    else:
        found = _searched(vectors, threshold, metric, pages_per_split, among_light, False)
    pairs = found.select(
        F.least("x", "y").alias("page_a"),
        F.greatest("x", "y").alias("page_b"),
        F.round(F.sqrt("dist_sq"), 6).alias("dist"),
    )
    return pairs.where((F.col("dist") <= threshold) & (F.col("page_a") < F.col("page_b")))


def _with_pages(vectors: Vectors) -> DataFrame:
    """:func:`packed_vectors` with ``pages``: of each content a row per so many copies.

    Contents without a weight are here, too; no word finds them, but light pairs hold them.
    """
    parts = F.ceil(F.col("n_pages") / PAGES_PER_ROW)
    pages = (
        vectors.copies.join(vectors.norms.select("rep", "n_pages"), "rep")
        .withColumn("part", F.pmod(F.xxhash64("page_id"), parts))
        .groupBy("rep", "part")
        .agg(F.collect_set("page_id").alias("pages"))
    )
    packed = packed_vectors(vectors.terms).drop("norm_sq")
    none = lambda c: F.coalesce(c, F.array().cast(packed.schema[c].dataType)).alias(c)
    return (
        vectors.norms.select("rep", "norm_sq").join(packed, "rep", "left").join(pages, "rep")
        .select("rep", "part", "norm_sq", none("words"), none("weights"), "pages")
    )


def connecting_pairs(
    vectors: Vectors,
    threshold: float,
    metric: str = "euclid",
    pages_per_split: int = PAGES_PER_SPLIT,
) -> DataFrame:
    """``(page_a, page_b)``: contents that connect all that :func:`found_pairs` connects.

    Pairs of light contents are left out.  Of a tile's pairs only the lowest content of
    what they connect is kept with each of the others, so a group of near copies takes a
    row per content and tile, not one per pair.
    """
    found = _searched(vectors, threshold, metric, pages_per_split, False, True)
    return found.select(F.least("x", "y").alias("page_a"), F.greatest("x", "y").alias("page_b"))


def _searched(
    vectors: Vectors, threshold: float, metric: str, pages_per_split: int, among_light: bool, connecting: bool
) -> DataFrame:
    """``(x, y, dist_sq)`` of contents; see :func:`_tiled`."""
    lightest = None
    if not among_light:
        lightest = vectors.norms.agg(F.min("norm_sq").alias("m")).first()["m"]
    packed = stage(packed_vectors(vectors.terms), "packed")
    return _tiled(packed, threshold, metric, pages_per_split, lightest, connecting)


def _tiled(
    packed: DataFrame,
    threshold: float,
    metric: str,
    pages_per_split: int,
    lightest: float | None = None,
    connecting: bool = False,
) -> DataFrame:
    """``(x, y, dist_sq)``, searched in tiles of two blocks of contents.

    Contents are dealt over blocks by a hash, so that a block has at most about
    ``WORDS_PER_BLOCK`` words and ``pages_per_split`` contents.  A block is a few rows, written
    to the shuffle once; the product of blocks with blocks only reads it again for each of
    its tiles, and a row's vectors go on with the first row of the other block only.  The meetings of pairs at words, their candidates and their distances never
    leave the tile.  If ``packed`` has ``pages``, all pairs of pages are given.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    sums = packed.agg(F.count("*").alias("n"), F.sum(F.size("words")).alias("words")).first()
    few = min(LEAST_BLOCKS, -(-sums["n"] // CONTENTS_PER_BLOCK))
    blocks = max(few, -(-(sums["words"] or 0) // WORDS_PER_BLOCK), -(-sums["n"] // pages_per_split), 1)
    own = F.pmod(F.xxhash64("rep", *[c for c in ("part",) if c in packed.columns]), F.lit(blocks)).cast("int")
    whole = (
        packed.withColumn("block", own)
        .groupBy("block")
        .applyInArrow(_as_row, "block int, piece int, vectors binary")
        .repartitionById(blocks, F.col("block"))
    )
    # a product, as a broadcast would hold all blocks in every executor
    left = whole.toDF("a", "of_a", "left").hint("shuffle_replicate_nl")
    tiles = left.join(whole.toDF("b", "of_b", "right"), F.col("a") <= F.col("b")).select(
        "a", F.when(F.col("of_b") == 0, F.col("left")).alias("left"),
        "b", F.when(F.col("of_a") == 0, F.col("right")).alias("right"),
    )
    search = _parts(metric, threshold, lightest, connecting)
    return tiles.mapInArrow(_in_tiles(search), "x long, y long, dist_sq double")


def _as_row(table: pa.Table) -> pa.Table:
    """The contents of one block as a row, or several if they are long, compressed."""
    columns = ("rep", "norm_sq", "words", "weights", "pages")
    contents = table.select([c for c in columns if c in table.column_names]).combine_chunks()
    words = _whole(contents["words"])
    flat = words.flatten()
    if len(flat) and -1 < flat.to_numpy().min() and flat.to_numpy().max() < 1 << 31:
        narrow = words.cast(pa.list_(pa.int32()))
        contents = contents.set_column(contents.column_names.index("words"), "words", narrow)
    turn = np.cumsum(words.value_lengths().to_numpy().astype(np.int64)) // WORDS_PER_ROW
    cuts = [0, *(np.flatnonzero(np.diff(turn)) + 1), len(contents)]
    rows = []
    for first, last in itertools.pairwise(cuts):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, contents.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(contents.slice(first, last - first))
        rows.append(sink.getvalue().to_pybytes())
    block, pieces = table["block"][0].as_py(), range(len(rows))
    return pa.table({
        "block": pa.array([block] * len(rows), pa.int32()), "piece": pa.array(pieces, pa.int32()),
        "vectors": pa.array(rows, pa.binary()),
    })


def _in_tiles(search):
    """``search`` on the contents of each tile ``(a, left, b, right)``: a table or several.

    A tile's rows are the products of its blocks' rows; each block's row is on one of them.
    """

    def contents(vectors):
        return pa.ipc.open_stream(vectors.as_buffer()).read_all()

    def tile(a, b, lefts, rights):
        sides = [t.append_column("block", pa.array(np.full(len(t), a))) for t in lefts]
        if a != b:
            sides += [t.append_column("block", pa.array(np.full(len(t), b))) for t in rights]
        lefts.clear(), rights.clear()
        words = max((t.schema.field("words") for t in sides), key=lambda f: f.type.value_type.bit_width)
        both = pa.concat_tables([t.set_column(t.column_names.index("words"), words, t["words"].cast(words.type)) for t in sides])
        for name, block in (("a", a), ("b", b)):
            both = both.append_column(name, pa.array(np.full(len(both), block)))
        return both

    def run(batches):
        tiles = {}
        for batch in batches:
            for a, left, b, right in zip(*(batch[c] for c in ("a", "left", "b", "right")), strict=True):
                a, b = a.as_py(), b.as_py()
                lefts, rights = tiles.setdefault((a, b), ([], []))
                if left.is_valid:
                    lefts.append(contents(left))
                if right.is_valid and a != b:
                    rights.append(contents(right))
            del batch, left, right
        for a, b in [*tiles]:
            # not kept here, so that a search may drop the tile's table
            found = search(tile(a, b, *tiles.pop((a, b))))
            for table in [found] if isinstance(found, pa.Table) else found:
                yield from table.to_batches()

    return run


def _spread(firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``first, first + 1, ...`` of all given runs, one after the other."""
    return np.repeat(firsts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()


@dataclass
class _Tile:
    """The vectors of a tile, flat: a content's words stand from ``starts`` to ``ends``."""

    reps: np.ndarray
    sizes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    word: np.ndarray
    weight: np.ndarray
    n_words: int

    @classmethod
    def of_table(cls, table: pa.Table) -> _Tile:
        words, weights = _whole(table["words"]), _whole(table["weights"])
        sizes = words.value_lengths().to_numpy().astype(np.int64)
        word = words.flatten().to_numpy()
        top = int(word.max()) + 1 if len(word) else 1
        if top > KNOWN_WORDS or len(word) and word.min() < 0:
            known, word = np.unique(word, return_inverse=True)
            top = len(known)
        reps, weight = _whole(table["rep"]).to_numpy(), weights.flatten().to_numpy()
        ends = np.cumsum(sizes)
        return cls(reps, sizes, ends - sizes, ends, word.astype(np.int32), weight, top)

    def slices(self, first: int, last: int):
        """Runs of contents with about ``ENTRIES`` words each."""
        while first < last:
            until = np.searchsorted(self.ends[:last], self.starts[first] + ENTRIES, "right")
            yield first, (first := max(first + 1, int(until)))

    def entries(self, first: int, last: int):
        """Content, word, weight and the squared weight before it, of a run of contents."""
        own = slice(self.starts[first], self.ends[last - 1])
        sizes = self.sizes[first:last]
        of = np.repeat(np.arange(first, last, dtype=np.int32), sizes)
        square = self.weight[own] ** 2
        before = np.cumsum(square) - square
        at = np.minimum(self.starts[first:last] - own.start, max(len(before) - 1, 0))
        if len(before):
            before -= np.repeat(before[at], sizes)
        return of, self.word[own], self.weight[own], np.maximum(before, 0.0)

    def repeated(self, count: int) -> bool:
        """Whether a content has a word twice (a page table with repeated ids)."""
        for first, last in self.slices(0, count):
            of, word, _, _ = self.entries(first, last)
            if (np.diff(word)[np.diff(of) == 0] == 0).any():
                return True
        return False

    def taken_off(self, laid: np.ndarray, seen: np.ndarray, metric: str) -> np.ndarray:
        """What shared words take off; equal contents of ``laid`` stand together.

        A laid content's words are laid out once, and the vectors of all that it is
        compared with are looked up in them: short ones together, about ``ENTRIES`` words
        at a time, long ones each for itself.
        """
        off, held = np.zeros(len(laid)), np.zeros(self.n_words)
        if metric == "euclid":
            top = 1.0
            taken = lambda mine, theirs: 2.0 * np.dot(mine, theirs)
        else:  # laid out as parts of the largest weight, so that ceil tells what is there
            top = self.weight.max(initial=0.0) or 1.0
            taken = lambda mine, theirs: top * top * np.dot(mine, mine) + np.dot(theirs * theirs, np.ceil(mine))
        turn = np.cumsum(self.sizes[seen]) // ENTRIES
        cuts = np.flatnonzero((np.diff(laid) != 0) | (np.diff(turn) != 0)) + 1
        for begin, end in zip([0, *cuts], [*cuts, len(laid)], strict=True):
            at = self.starts[laid[begin]]
            own = slice(at, at + self.sizes[laid[begin]])
            held[self.word[own]] = self.weight[own] / top
            n = self.sizes[seen[begin:end]]
            if n.sum() >= LONG * len(n):
                firsts = self.starts[seen[begin:end]]
                for k, (first, last) in enumerate(zip(firsts.tolist(), (firsts + n).tolist(), strict=True), begin):
                    off[k] = taken(held.take(self.word[first:last]), self.weight[first:last])
            else:
                flat = _spread(self.starts[seen[begin:end]], n)
                mine, theirs = held[self.word[flat]] * top, self.weight[flat]
                if metric == "euclid":
                    part = 2 * mine * theirs
                else:
                    part = np.where(mine > 0, mine * mine + theirs * theirs, 0.0)
                off[begin:end] = np.add.reduceat(part, np.cumsum(n) - n)
            held[self.word[own]] = 0.0
        return off


def _search(metric: str, threshold: float, lightest: float | None, connecting: bool):
    """What :func:`_parts` finds in one tile, as one table."""
    parts = _parts(metric, threshold, lightest, connecting)
    return lambda table: pa.concat_tables(parts(table))


def _parts(metric: str, threshold: float, lightest: float | None, connecting: bool):
    """The found pairs of one tile, part by part, or what connects them.

    A pair of contents meets at a word that both hold, as long as the weight before it in
    the two is at most ``mass * t^2`` together.  One side's entries are sorted by word and
    that weight, so an entry of the other meets a run of them.  Of a pair's shared words,
    exactly those up to ``mass * t^2`` are met, so everything else that comes earlier in the
    order is unshared.  With ``B`` the weight of both up to and including the last word met,
    the squared distance is at least ``max(B, mass * t^2)`` (or that of both pages, if less)
    less what the words met take off; for ``euclid``, also ``B`` less that, plus the least
    that the rest can add.  What this leaves is compared in full.

    Besides the vectors and the sorted entries of one side, all of it is of bounded size:
    the other side is taken in runs of contents, their meetings in portions, and a content
    with more meetings than the first side has words is compared with all of it instead.
    """
    reach = _reach(threshold)
    limit = reach * reach
    most = limit * COMPARED_MASS + 1e-9
    euclid = metric == "euclid"

    def pairs(t: _Tile, norm, left: tuple[int, int], right: tuple[int, int]):
        """``(x, y, dist_sq)`` of all found pairs, in parts."""
        root, same, repeated = np.sqrt(norm), left == right, t.repeated(len(norm))

        def possible(i, j):
            keep = norm[i] + norm[j] > limit
            if euclid:
                keep &= np.abs(root[i] - root[j]) <= reach
            if lightest is not None:
                keep &= np.maximum(norm[i], norm[j]) + lightest > limit
            return keep

        def near(i, j):
            if repeated:  # a page table with repeated ids: the heavier one is laid out
                heavier = (norm[i] > norm[j]) | ((norm[i] == norm[j]) & (t.reps[i] < t.reps[j]))
                seen, laid = np.where(heavier, j, i), np.where(heavier, i, j)
            else:
                longer = t.sizes[i] > t.sizes[j]
                seen, laid = np.where(longer, j, i), np.where(longer, i, j)
            order = np.argsort(laid, kind="stable")
            i, j = seen[order], laid[order]
            dist_sq = np.maximum(norm[i] + norm[j] - t.taken_off(j, i, metric), 0.0)
            ok = dist_sq <= limit
            return j[ok], i[ok], dist_sq[ok]

        # a word's entries by the weight before it, as the fraction of one sorted number
        lists = []
        for run in t.slices(*left):
            of, word, weight, before = t.entries(*run)
            met = before <= most
            lists.append((word[met] + before[met] / (2 * most), of[met], weight[met], before[met]))
        if not lists:
            return
        key, list_of, list_weight, list_before = (np.concatenate(c) for c in zip(*lists, strict=True))
        del lists
        order = np.argsort(key, kind="stable")
        key, list_of, list_weight, list_before = (c[order] for c in (key, list_of, list_weight, list_before))
        del order

        def run_of(first, last):
            """The entries of a run of contents that meet others, and where."""
            of, word, weight, before = t.entries(first, last)
            met = before <= most
            of, word, weight, before = of[met], word[met], weight[met], before[met]
            lo = np.searchsorted(key, word, "left")
            hi = np.searchsorted(key, word + (0.5 - before / (2 * most)) + 1e-6, "right")
            n = np.maximum(hi - lo, 0)
            any_ = n > 0
            return of[any_], weight[any_], before[any_], lo[any_], n[any_]

        def candidates():
            for first, last in t.slices(*right):
                of, weight, before, lo, n = run_of(first, last)
                each = np.bincount(of - first, n, last - first)
                whole = (each * PER_MEETING > t.ends[left[1] - 1] - t.starts[left[0]]) & (not repeated)
                for j in first + np.flatnonzero(whole):
                    i = np.arange(left[0], j if same else left[1])
                    i = i[possible(i, j) & (t.sizes[i] > 0)]
                    if len(i):
                        yield i, np.full(len(i), j)
                some = ~whole[of - first]
                of, weight, before, lo, n = of[some], weight[some], before[some], lo[some], n[some]
                # whole contents, about MEETINGS at a time
                done = np.cumsum(n)
                ends = np.append(np.flatnonzero(np.diff(of)) + 1, len(of))
                at, base = 0, 0
                while at < len(of):
                    k = np.searchsorted(done[ends - 1], base + MEETINGS, "right")
                    end = ends[max(k - 1, np.searchsorted(ends, at, "right"))]
                    l = _spread(lo[at:end], n[at:end])
                    p = np.repeat(np.arange(at, end), n[at:end])
                    at, base = end, done[end - 1]
                    i, j = list_of[l], of[p]
                    keep = (list_before[l] + before[p] <= most) & possible(i, j)
                    if same:
                        keep &= i < j
                    l, p, i, j = l[keep], p[keep], i[keep], j[keep]
                    if not len(l):
                        continue
                    # one sort of whole numbers: the pair, then the meeting's place
                    code = (j - j[0]).astype(np.int64) * (left[1] - left[0]) + (i - left[0])
                    bits = int(len(code) - 1).bit_length()
                    if int(code.max()).bit_length() + bits < 63:
                        place = np.sort((code << bits) | np.arange(len(code)))
                        code, place = place >> bits, place & ((1 << bits) - 1)
                    else:
                        place = np.argsort(code, kind="stable")
                        code = code[place]
                    l, p = l[place], p[place]
                    begin = np.append(0, np.flatnonzero(np.diff(code)) + 1)
                    i, j = i[place[begin]], j[place[begin]]
                    wi, wj = list_weight[l], weight[p]
                    before_i, before_j = list_before[l], before[p]
                    off = np.add.reduceat(2 * wi * wj if euclid else wi * wi + wj * wj, begin)
                    first_met = np.minimum.reduceat(before_i + before_j, begin)
                    upto_i = np.maximum.reduceat(before_i + wi * wi, begin)
                    upto_j = np.maximum.reduceat(before_j + wj * wj, begin)
                    both = upto_i + upto_j
                    least = np.minimum(norm[i] + norm[j], np.maximum(both, limit * COMPARED_MASS)) - off
                    if euclid:
                        rest = np.sqrt(np.maximum(norm[i] - upto_i, 0)) - np.sqrt(np.maximum(norm[j] - upto_j, 0))
                        least = np.maximum(least, both - off + rest * rest)
                    # a little slack, so that rounding errors of the sums lose no pair
                    ok = (first_met <= limit + 1e-9) & (least <= limit + 1e-9)
                    if ok.any():
                        yield i[ok], j[ok]

        if not repeated and _product_is_less(t, sum(run_of(*run)[4].sum() for run in t.slices(*right))):
            yield from _products(t, norm, np.arange(*left), np.arange(*right), limit, euclid, lightest)
            return
        waiting = []
        for i, j in candidates():
            waiting.append((i, j))
            if sum(len(w[0]) for w in waiting) > COMPARED:
                yield near(*(np.concatenate(c) for c in zip(*waiting, strict=True)))
                waiting = []
        if waiting:
            yield near(*(np.concatenate(c) for c in zip(*waiting, strict=True)))

    def run(table):
        a, b = table["a"][0].as_py(), table["b"][0].as_py()
        second = _whole(table["block"]).to_numpy() != a
        if (np.diff(second.astype(np.int8)) < 0).any():
            table = table.take(np.argsort(second, kind="stable"))
        cut = int(len(second) - second.sum())
        t, norm = _Tile.of_table(table), _whole(table["norm_sq"]).to_numpy()
        pages = _whole(table["pages"]) if "pages" in table.column_names else None
        del table
        left, right = (0, cut), (0, cut) if a == b else (cut, len(norm))
        found = pairs(t, norm, left, right)
        if connecting:
            x, y = _connected(len(norm), found, threshold)
            found = [(x, y, np.zeros(len(x)))]
        yield _pair_table(t.reps[:0], t.reps[:0], norm[:0])
        if pages is None:
            for x, y, dist_sq in found:
                yield _pair_table(t.reps[x], t.reps[y], dist_sq)
            return
        n = pages.value_lengths().to_numpy().astype(np.int64)
        flat, firsts = pages.flatten().to_numpy(), np.cumsum(n) - n
        for x, y, dist_sq in itertools.chain(found, light(t, norm, left, right)):
            dist_sq = np.where(t.reps[x] == t.reps[y], 0.0, dist_sq)  # rows of one content
            for i, j, of in _products_of(n[x], n[y]):
                yield _pair_table(flat[firsts[x[of]] + i], flat[firsts[y[of]] + j], dist_sq[of])
        if left == right:  # copies in one row
            for i, j, of in _products_of(n, n):
                i, j, of = i[i < j], j[i < j], of[i < j]
                yield _pair_table(flat[firsts[of] + i], flat[firsts[of] + j], np.zeros(len(of)))

    def light(t: _Tile, norm, left: tuple[int, int], right: tuple[int, int]):
        """The light pairs; only contents that are in one are multiplied."""
        lightest_of = [norm[slice(*side)].min() for side in (left, right)]
        some = [
            np.flatnonzero(norm[slice(*side)] + other <= limit) + side[0]
            for side, other in ((left, lightest_of[1]), (right, lightest_of[0]))
        ]
        yield from _products(t, norm, *some, limit, euclid, None, among_light=True)

    return run


def _products_of(n: np.ndarray, m: np.ndarray):
    """Of sets of ``n`` and ``m`` elements all ``(element, element, which sets)``, in parts."""
    sizes = n * m
    done, at = np.cumsum(sizes), 0
    while at < len(n):
        end = max(at + 1, np.searchsorted(done, (done[at - 1] if at else 0) + ROWS, "right"))
        of = np.repeat(np.arange(at, end), sizes[at:end])
        k = _spread(np.zeros(end - at, dtype=np.int64), sizes[at:end])
        yield k // m[of], k % m[of], of
        at = end


def _pair_table(x, y, dist_sq) -> pa.Table:
    return pa.table({"x": x, "y": y, "dist_sq": dist_sq})


def _common(word: np.ndarray, n_words: int, contents: int) -> tuple[np.ndarray, np.ndarray]:
    """On how many contents a word is, and whether it is multiplied as a dense column."""
    each = np.bincount(word, minlength=n_words)
    common = each * COMMON >= max(contents, 1)
    if common.sum() > COLUMNS:
        common &= each > np.partition(each[common], -COLUMNS - 1)[-COLUMNS - 1]
    return each, common


def _product_is_less(t: _Tile, meetings: int) -> bool:
    """Whether all distances of a tile are less work than so many meetings."""
    each, common = _common(t.word, t.n_words, len(t.reps))
    rare = each[~common].astype(float)
    return meetings * PER_MEETING > common.sum() * float(len(t.reps)) ** 2 / 2 * PER_PRODUCT + (rare @ rare) / 2


def _products(
    t: _Tile, norm, left, right, limit: float, euclid: bool, lightest: float | None, among_light: bool = False
):
    """``(x, y, dist_sq)`` of the found pairs, or the light ones, from all products of two sides.

    For thresholds that leave hardly a word out, and for light pairs.  Words on many pages are multiplied as
    dense blocks, the others entry by entry.
    """
    _, common = _common(t.word, t.n_words, len(t.reps))
    column = np.cumsum(common) - 1
    same = len(left) == len(right) and (left == right).all()

    def part(contents):
        e = _spread(t.starts[contents], t.sizes[contents])
        of, word, weight = np.repeat(np.arange(len(contents)), t.sizes[contents]), t.word[e], t.weight[e]
        often = common[word]
        dense = np.zeros((len(contents), common.sum()))
        dense[of[often], column[word[often]]] = weight[often]
        return dense, of[~often], word[~often], weight[~often]

    for at in range(0, len(left), LEFT_CONTENTS):
        own = left[at : at + LEFT_CONTENTS]
        dense_i, of_i, word, weight_i = part(own)
        order = np.argsort(word, kind="stable")
        of_i, word, weight_i = of_i[order], word[order], weight_i[order]
        for start in range(at if same else 0, len(right), RIGHT_CONTENTS):
            other = right[start : start + RIGHT_CONTENTS]
            dense_j, of_j, sought, weight_j = part(other)
            if euclid:
                off = 2 * (dense_j @ dense_i.T)
            else:
                off = (dense_j**2) @ (dense_i > 0).T.astype(float) + (dense_j > 0).astype(float) @ (dense_i**2).T
            lo = np.searchsorted(word, sought, "left")
            n = np.searchsorted(word, sought, "right") - lo
            done, begin = np.cumsum(n), 0
            while begin < len(n):
                end = max(begin + 1, np.searchsorted(done, (done[begin - 1] if begin else 0) + MEETINGS, "right"))
                i, j = _spread(lo[begin:end], n[begin:end]), np.repeat(np.arange(begin, end), n[begin:end])
                wi, wj = weight_i[i], weight_j[j]
                value = 2 * wi * wj if euclid else wi * wi + wj * wj
                off += np.bincount(of_j[j] * len(own) + of_i[i], value, off.size).reshape(off.shape)
                begin = end
            both = norm[other][:, None] + norm[own]
            dist_sq = np.maximum(both - off, 0.0)
            near = (dist_sq <= limit) & (both <= limit if among_light else both > limit)
            if lightest is not None:
                near &= np.maximum(norm[other][:, None], norm[own]) + lightest > limit
            if same:
                near &= other[:, None] > own
            j, i = np.nonzero(near)
            yield other[j], own[i], dist_sq[near]


def _connected(n: int, found, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """``(content, lowest)`` of what the found pairs connect, held as such on the way."""
    lowest, waiting = np.arange(n), []

    def joined(parts):
        own = np.flatnonzero(lowest != np.arange(n))
        x, y = (np.concatenate([*c]) for c in zip(*parts, (own, lowest[own]), strict=True))
        return _lowest_connected(n, x, y)

    for x, y, dist_sq in found:
        near = np.floor(np.sqrt(dist_sq) / (2 * HALF_UNIT) + 0.5) * (2 * HALF_UNIT) <= threshold + 1e-12
        waiting.append((x[near], y[near]))
        if sum(len(w[0]) for w in waiting) > CONNECTED:
            lowest, waiting = joined(waiting), []
    lowest = joined(waiting)
    x = np.flatnonzero(lowest != np.arange(n))
    return x, lowest[x]


def _lowest_connected(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of ``0 .. n - 1``, the lowest that each is connected with."""
    lowest = np.arange(n)
    while True:
        low = np.minimum(lowest[x], lowest[y])
        if (lowest[x] == lowest[y]).all():
            return lowest
        # hook the lowest known, so that a whole group follows
        np.minimum.at(lowest, lowest[x], low)
        np.minimum.at(lowest, lowest[y], low)
        np.minimum.at(lowest, x, low)
        np.minimum.at(lowest, y, low)
        while (lowest[lowest] != lowest).any():
            lowest = lowest[lowest]


def taken_off(
    pairs: DataFrame,
    terms: DataFrame,
    metric: str,
    contents_per_block: int = CONTENTS_PER_BLOCK,
    words_per_block: int = WORDS_PER_BLOCK,
) -> DataFrame:
    """``pairs`` (``x, y, norm_x, norm_y``) with ``off``: what shared words take off.

    Contents are dealt over blocks, and a pair belongs to the tile of its two blocks.  A
    tile gets the vectors that its pairs need, packed, once each; so a vector travels at
    most as often as there are blocks, however many pairs it is in, and no row per pair
    and word is made.  A tile holds at most two blocks, whose number follows the size of
    the vectors.
    """
    needed = stage(
        pairs.select(F.explode(F.array("x", "y")).alias("rep")).distinct(), "compared"
    )
    packed = stage(
        terms.where("weight > 0")
        .join(needed, "rep", "left_semi")
        .groupBy("rep")
        .agg(F.collect_list(F.struct("word", "weight")).alias("t"))
        .select("rep", F.col("t.word").alias("words"), F.col("t.weight").alias("weights")),
        "packed",
    )
    sums = packed.agg(F.count("*").alias("n"), F.sum(F.size("words")).alias("words")).first()
    few = min(LEAST_BLOCKS, -(-sums["n"] // contents_per_block))
    blocks = max(few, -(-(sums["words"] or 0) // words_per_block), 1)
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    tiled = pairs.withColumn("a", F.least(block("x"), block("y"))).withColumn(
        "b", F.greatest(block("x"), block("y"))
    )
    ends = tiled.select("a", "b", F.explode(F.array("x", "y")).alias("rep")).distinct()
    sent = ends.join(packed, "rep").select(
        F.col("a").alias("of_a"), F.col("b").alias("of_b"), "rep", "words", "weights"
    )
    return (
        tiled.groupBy("a", "b")
        .cogroup(sent.groupBy("of_a", "of_b"))
        .applyInArrow(
            _tile(metric), "x long, y long, norm_x double, norm_y double, off double"
        )
    )


def _tile(metric: str):
    """What shared words take off the pairs of one tile."""

    def run(pairs, vectors):
        tile = _Tile.of_table(vectors)
        place = np.argsort(tile.reps)
        ids = [pairs[c].combine_chunks().to_numpy() for c in ("x", "y")]
        x, y = (place[np.searchsorted(tile.reps, i, sorter=place)] for i in ids)
        order = np.argsort(x, kind="stable")
        off = np.zeros(len(x))
        off[order] = tile.taken_off(x[order], y[order], metric)
        return pairs.select(["x", "y", "norm_x", "norm_y"]).append_column("off", pa.array(off))

    return run


def light_pages(vectors: Vectors, threshold: float) -> DataFrame:
    """``(rep, n_pages, norm_sq)`` of the contents that are in some light pair.

    Any two of them with ``norm_sq`` summing to at most ``t^2`` are a pair.
    """
    limit = _reach(threshold) ** 2
    lowest = F.min(F.struct("norm_sq", "rep"))
    lightest = vectors.norms.agg(lowest["norm_sq"].alias("m")).scalar()
    its_rep = vectors.norms.agg(lowest["rep"].alias("m")).scalar()
    others = vectors.norms.where(F.col("rep") != its_rep)
    second = others.agg(F.min("norm_sq").alias("m")).scalar()
    partner = F.when(F.col("rep") == its_rep, second).otherwise(lightest)
    return vectors.norms.where(F.col("norm_sq") + partner <= limit)


def neighbours(pairs: DataFrame, copies: DataFrame) -> DataFrame:
    """Each pair seen from both sides: ``(page_id, similar_id, dist)``.

    Every page has its rows, copies too; ``similar_id`` is the lowest of its copies, and
    the others are in ``copies``.  If every pair of pages is given, a page is its own only
    copy.  Rows, not lists: a page may have any number of neighbours.
    """
    ends = F.array(
        F.struct(F.col("page_a").alias("rep"), F.col("page_b").alias("similar_id")),
        F.struct(F.col("page_b").alias("rep"), F.col("page_a").alias("similar_id")),
    )
    both = stage(pairs.select(F.inline(ends), "dist"), "both-ends")
    return both.join(stage(copies, "copies"), "rep").select("page_id", "similar_id", "dist")


def similarity_vertices(vectors: Vectors, threshold: float) -> DataFrame:
    """``(page_id, vertex)``: pages that are surely connected share a vertex.

    Copies do, and so do all contents that are in a light pair: each of them is
    within ``t`` of the lightest content.
    """
    limit = _reach(threshold) ** 2
    lightest = vectors.norms.agg(F.min("norm_sq").alias("m")).scalar()
    light = F.col("norm_sq") + lightest <= limit
    hub = vectors.norms.where(light).agg(F.min("rep").alias("m")).scalar()
    vertex = stage(
        vectors.norms.select("rep", F.when(light, hub).otherwise(F.col("rep")).alias("vertex")),
        "vertices",
    )
    return vectors.copies.join(vertex, "rep").select("page_id", "vertex")


