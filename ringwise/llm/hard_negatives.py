"""Hard negatives: rows of another label that score just below an anchor's positives.

Scores are inner products of integer components, exact by a residue number system: component matrices
are multiplied modulo several small primes in float32, where every sum of products stays below 2^24 and so is
exact, and the signed scores are put together from the residues by Chinese remaindering (mixed radix). As many
primes are taken as the largest possible score needs, from one aggregate over all components.

All anchors meet all rows in tiles: rows and anchors are dealt evenly by a hash of their numbers, never by
label, so that a label of a third of all rows is no hot key. A tile holds at most ``tile`` rows and as many anchors, and is
worked on in blocks of about a million scores. Two passes run: the first finds each anchor's
best rows of its own label, its positives; the second finds, for each of an anchor's positives, the best rows of other labels
whose scores lie in the window below the positive's. A tile sends on the best few of each only, and a window
over an anchor (or an anchor's positive) chooses among the tiles' best.

Defined cases: rows with a null label, a null vector, or any null or non-finite component take no part;
shorter vectors count as filled up with zeros; higher scores come first, ties by smaller key, null keys
last; every row counts, repeated ones too, and an anchor's repeated row can be its positive, but not the
row itself; a positive of negative score has an empty window; an anchor without positives gives no rows, as an
empty table does; other input columns are not read. Components so large that a score could reach 2^53 raise an error.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringwise.llm.common import Scratch

#: Primes below this are used, the largest first.
BELOW = 256
#: Integers up to this are exact in float32.
EXACT = 1 << 24
#: Scores stay below this, so that residues are put together in 64 bits.
MOST = 1 << 53
#: Rows, and anchors, of a tile at most; scores of a block.
TILE = 1 << 16
BLOCK_ANCHORS, BLOCK_ROWS = 512, 2_048
NONE = np.iinfo(np.int64).min


def primes_for(largest: int) -> list[int]:
    """The largest primes below ``BELOW`` whose product exceeds twice the largest score."""
    chosen, product = [], 1
    for n in range(BELOW - 1, 1, -1):
        if all(n % d for d in range(2, int(n**0.5) + 1)):
            if product > 2 * largest + 1:
                break
            chosen.append(n)
            product *= n
    return chosen


def residues(q: np.ndarray, prime: int) -> np.ndarray:
    """Residues nearest to zero, as float32."""
    r = q % prime
    return (r - prime * (r > prime // 2)).astype(np.float32)


def modular_product(a: np.ndarray, b: np.ndarray, prime: int) -> np.ndarray:
    """a @ b.T modulo the prime, of residues: components are summed in runs whose sums are exact."""
    run = EXACT // (prime // 2) ** 2 if prime > 3 else EXACT
    total = np.zeros((len(a), len(b)), np.int64)
    for at in range(0, a.shape[1], run):
        total += (a[:, at : at + run] @ b[:, at : at + run].T).astype(np.int64)
        total %= prime
    return total


def signed(parts: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The numbers of these residues that are nearest to zero (Chinese remainders by mixed radix)."""
    value, radix = parts[0].copy(), primes[0]
    for part, prime in zip(parts[1:], primes[1:], strict=True):
        value += radix * ((part - value) % prime * pow(radix, -1, prime) % prime)
        radix *= prime
    value[value > radix // 2] -= radix
    return value


def scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of all rows of a with all rows of b, given their residues for each prime."""
    return signed([modular_product(x, y, p) for x, y, p in zip(a, b, primes, strict=True)], primes)


def best(owner: np.ndarray, score: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Indices of each owner's first k by falling score, then by place."""
    order = np.lexsort((place, -score, owner))
    of = owner[order]
    return order[np.arange(len(of)) - np.searchsorted(of, of) < k]


def _dense(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Matrix of a column of lists, filled up with zeros."""
    lists = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class _Tile:
    """Anchors and rows of one tile, the rows by key (null last) and number."""

    def __init__(self, anchors: pa.Table, rows: pa.Table, width: int, primes: list[int]):
        self.rows = rows.sort_by([("key", "ascending"), ("row", "ascending")])  # nulls go last
        self.row, self.label = (self.rows[c].to_numpy() for c in ("row", "label"))
        self.anchor, self.anchor_label = (anchors[c].to_numpy() for c in ("row", "label"))
        self.anchors, self.width, self.primes = anchors, width, primes

    def blocks(self):
        """(first anchor, first row, scores) of every block."""
        for a in range(0, self.anchors.num_rows, BLOCK_ANCHORS):
            q = _dense(self.anchors["q"].slice(a, BLOCK_ANCHORS), self.width)
            left = [residues(q, p) for p in self.primes]
            for r in range(0, self.rows.num_rows, BLOCK_ROWS):
                q = _dense(self.rows["q"].slice(r, BLOCK_ROWS), self.width)
                yield a, r, scores(left, [residues(q, p) for p in self.primes], self.primes)


def _positives(width: int, primes: list[int], k: int) -> Callable:
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        t = _Tile(anchors, rows, width, primes)
        found = [np.zeros((3, 0), np.int64)]
        for a, r, s in t.blocks():
            n_a, n_r = s.shape
            own = t.anchor_label[a : a + n_a, None] == t.label[None, r : r + n_r]
            own &= t.anchor[a : a + n_a, None] != t.row[None, r : r + n_r]
            s[~own] = NONE
            least = np.partition(s, n_r - k, axis=1)[:, n_r - k] if n_r > k else np.full(n_a, NONE)
            i, j = np.nonzero((s >= least[:, None]) & (s != NONE))
            some = np.stack([i + a, j + r, s[i, j]])
            found.append(some[:, best(some[0], some[2], some[1], k)])
        i, j, s = np.concatenate(found, axis=1)
        top = best(i, s, j, k)
        i, j, s = i[top], j[top], s[top]
        columns = [anchors["row"].take(pa.array(i)), t.rows["row"].take(pa.array(j)), t.rows["key"].take(pa.array(j)), pa.array(s)]
        return pa.table(columns, names=["anchor", "row", "key", "score"])

    return run


def _negatives(width: int, primes: list[int], k: int, low: int) -> Callable:
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        t = _Tile(anchors, rows, width, primes)
        ranks = max([len(p) for p in anchors["positives"].to_pylist()], default=0)
        high = np.full((anchors.num_rows, ranks), NONE)
        for n, positives in enumerate(anchors["positives"].to_pylist()):
            high[n, : len(positives)] = [p["score"] for p in positives]
        # low * positive <= 100 * negative <= 100 * positive; none can hold where the positive is negative
        from_score = np.where(high >= 0, -((-low * np.maximum(high, 0)) // 100), MOST)
        to_score = np.where(high >= 0, high, -MOST)
        found = [np.zeros((4, 0), np.int64)]
        for a, r, s in t.blocks():
            if not ranks:
                break
            lo, hi = from_score[a : a + len(s)], to_score[a : a + len(s)]
            inside = (s >= lo.min(axis=1)[:, None]) & (s <= hi.max(axis=1)[:, None])
            inside &= t.anchor_label[a : a + len(s), None] != t.label[None, r : r + s.shape[1]]
            i, j = np.nonzero(inside)
            s = s[i, j]
            for n in range(ranks):
                fits = np.flatnonzero((s >= lo[i, n]) & (s <= hi[i, n]))
                fits = fits[best(i[fits], s[fits], j[fits], k)]
                found.append(np.stack([i[fits] + a, j[fits] + r, s[fits], np.full(len(fits), n)]))
        i, j, s, n = np.concatenate(found, axis=1)
        top = best(i * max(ranks, 1) + n, s, j, k)
        i, j, s, n = i[top], j[top], s[top], n[top]
        columns = [anchors["row"].take(pa.array(i)), pa.array(n.astype(np.int32)), t.rows["row"].take(pa.array(j)), t.rows["key"].take(pa.array(j)), pa.array(s)]
        return pa.table(columns, names=["anchor", "nth", "row", "key", "score"])

    return run


def components(vectors: DataFrame, key: str, vector: str, label: str, scale: int, is_anchor: Column) -> DataFrame:
    """Rows that take part: key, label, anchor and the integer components ``q``."""
    plain = F.col(vector)
    sound = F.forall(plain, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    taking_part = F.col(label).isNotNull() & plain.isNotNull() & sound
    q = F.transform(plain, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return vectors.where(taking_part).select(
        F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"), q.alias("q")
    )


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    scale: int = 256,
    tile: int = TILE,
) -> DataFrame:
    """(anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score): see the module.

    ``low`` is the least score of a negative in hundredths of its positive's.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "negatives")
    rows = components(vectors, key, vector, label, scale, is_anchor)
    rows = scratch.save(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    biggest = F.max(F.greatest(F.coalesce(F.array_max("q"), F.lit(0)), -F.coalesce(F.array_min("q"), F.lit(0))))
    n, n_anchors, top, width = rows.agg(F.count(F.lit(1)), F.count_if("anchor"), biggest, F.max(F.size("q"))).first()
    top, width = top or 0, width or 0
    largest = width * top * top
    if top < 0 or largest >= MOST:
        raise ValueError(f"components up to {top} in {width} dimensions: scores could reach {MOST}")
    primes = primes_for(largest)
    cores = spark.sparkContext.defaultParallelism
    row_tiles = max(-(-n // tile), min(2 * cores, -(-n // BLOCK_ROWS)), 1)
    anchor_tiles = max(-(-n_anchors // tile), 1)
    if top < 1 << 31:
        rows = rows.withColumn("q", F.col("q").cast("array<int>"))  # half the bytes to send

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        """Each row to its place among its own tiles, and to each of the other side's."""
        place = F.pmod(F.xxhash64("row"), F.lit(n_own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        # columns anew, as both sides come from one table
        return df.select(*[F.col(c).alias(c) for c in df.columns], place.alias(own), every.alias(other)).repartition(row_tiles * anchor_tiles, "a", "r").groupBy("a", "r")

    all_rows = rows.select("row", "key", "label", "q")
    anchors = rows.where("anchor").drop("anchor")
    tiles = dealt(anchors, "a", anchor_tiles, "r", row_tiles).cogroup(dealt(all_rows, "r", row_tiles, "a", anchor_tiles))
    near = tiles.applyInArrow(_positives(width, primes, positives), "anchor long, row long, key long, score long")
    order = (F.desc("score"), F.asc_nulls_last("key"), "row")
    first = Window.partitionBy("anchor").orderBy(*order)
    near = near.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= positives)
    near = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("nth", "key", "score"))).alias("positives"))
    near = scratch.save(near, "positives")

    wanted = anchors.join(near.withColumnRenamed("anchor", "row"), "row")
    tiles = dealt(wanted, "a", anchor_tiles, "r", row_tiles).cogroup(dealt(all_rows, "r", row_tiles, "a", anchor_tiles))
    far = tiles.applyInArrow(_negatives(width, primes, negatives, low), "anchor long, nth int, row long, key long, score long")
    first = Window.partitionBy("anchor", "nth").orderBy(*order)
    far = far.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    named = wanted.select(F.col("row").alias("anchor"), F.col("key").alias("anchor_id"), "positives")
    positive = F.get("positives", F.col("nth"))
    return far.join(named, "anchor").select(
        "anchor_id",
        positive["key"].alias("positive_id"),
        positive["nth"].alias("positive_rank"),
        "rank",
        F.col("key").alias("negative_id"),
        positive["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
