"""Ranked lexical search: the best documents for each of a stated set of items, by exact search in sparse ball trees.

A document is a sparse vector over the items' terms, an item the vector of its terms' weights, and a score
their inner product; documents may have no term in common with any item, and then have no vector.

1. Vectors. Every whole text is cut into terms; the numbers of occurrences of the items' terms are written, with all
   documents' lengths. Document frequencies and lengths, over all documents, give weights and values.
2. Trees. Documents are sorted by two least hashes of their terms, so that like ones lie together, with ties in
   random order, so that a group of copies spreads. Every ``BLOCK`` documents in turn (fewer long ones) make a
   balanced tree: a node's documents are halved by which of two far ones they are nearer to, down to leaves of ``LEAF``.
3. Bounds. A node has a centroid, and a radius for each band of terms; bands hold like numbers of occurrences, the commonest terms
   alone. No document below it scores more than centroid times item plus the bands' radii times the item's norms in them.
   Radii and bounds are widened by more than rounding can amount to, so no document is lost.
4. Search. For each item, the subtrees of highest bound are opened first until no bound reaches the score that the item's
   ``best``-th document has so far in this task; the documents of a leaf are scored exactly in 64-bit
   integers. Each task sends on the best few for each item, and a window chooses among them.

Items are worked on in batches of at most ``BATCH_CHARS`` characters (a longer item is one alone), whose
terms alone go to the tasks; their number grows with the items, not with the documents.

Defined cases: a null or empty text has no terms; an item without terms, or whose terms no document holds, gives no rows;
rows of equal keys count each; equal scores are ordered by key, null keys last; repeated items get a ranking each; a
weight of 0 (a term in nearly all documents) adds nothing, and documents of score 0 are left out; empty tables give no rows;
other input columns are not read. A task holds one block: at most ``BLOCK`` documents and ``ENTRIES`` numbers.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringwise.llm.common import Scratch

BLOCK = 2_048
ENTRIES = 1 << 20
#: Documents that are cut into terms at once.
ROWS = 1_000
LEAF = 8
BANDS = 1_024
#: Blocks of a task where there are enough of them: their documents compete before any are sent on.
BLOCKS_A_TASK = 32
#: Items whose bounds are worked out together.
TOGETHER = 64
BATCH_CHARS = 1 << 20
#: Relative widening of radii and bounds; rounding stays many orders below.
SLACK = 1e-9

#: Bytes of terms (letters, digits, all of other scripts), A-Z lower-cased; others become blanks.
_TERM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII."""
    return text.translate(_TERM).split()


def values(tf: np.ndarray, n: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """Saturated numbers of occurrences in documents of n terms."""
    m = 75 + 25 * n * n_docs // max(length, 1)
    return 1_000_000_000 * tf // (1_000 * tf + 12 * m)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1_000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _vectors(vocabulary: list[bytes]) -> Callable:
    """(key, n, terms' numbers, occurrences, two least hashes) of documents that hold any term at all."""
    number = {t: i for i, t in enumerate(vocabulary)}
    marks = np.random.default_rng(7).permutation(len(vocabulary)), np.random.default_rng(8).permutation(len(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            out: list[list] = [[] for _ in range(6)]
            bodies = batch.column(1).cast(pa.binary())
            for key, body in zip(batch.column(0).to_pylist(), bodies, strict=True):
                found = terms(body.as_py() or b"")
                if not found:
                    continue
                ours = sorted((number[t], c) for t, c in Counter(found).items() if t in number)
                term = [t for t, _ in ours]
                least = [int(m[term].min()) if term else -1 for m in marks]
                for column, value in zip(out, (key, len(found), term, [c for _, c in ours], *least), strict=True):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["key", "n", "term", "tf", "near", "next"])

    return run


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values one after the other, their number in each row)."""
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def _frequencies(n_terms: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            df += np.bincount(_flat(batch.column(0))[0], minlength=n_terms)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(df[held])], ["term", "df"])

    return run


class Rows:
    """Sparse rows one after the other: ``term`` and ``x`` from ``at[i]`` to ``at[i + 1]``."""

    def __init__(self, term: np.ndarray, x: np.ndarray, sizes: np.ndarray):
        self.term, self.x, self.at = term, x, np.concatenate([[0], np.cumsum(sizes)])

    def __len__(self) -> int:
        return len(self.at) - 1

    def take(self, rows: np.ndarray) -> Rows:
        sizes = np.diff(self.at)[rows]
        places = np.arange(sizes.sum()) + np.repeat(self.at[rows] - (np.cumsum(sizes) - sizes), sizes)
        return Rows(self.term[places], self.x[places], sizes)

    def sums(self, numbers: np.ndarray) -> np.ndarray:
        """Sum of the numbers, one an entry, of each row."""
        upto = np.concatenate([[0], np.cumsum(numbers)])
        return upto[self.at[1:]] - upto[self.at[:-1]]

    def dot(self, dense: np.ndarray) -> np.ndarray:
        return self.sums(self.x * dense[self.term])


def halves(rows: Rows, n_terms: int) -> np.ndarray:
    """The order in which every node of the tree is a run of rows: nodes are halved where they have over ``LEAF``."""
    order = np.arange(len(rows))
    x = rows.x.astype(np.float64)
    norms = rows.sums(x * x)
    runs = [(0, len(rows))]
    dense = np.zeros(n_terms)
    while runs:
        a, b = runs.pop()
        if b - a <= LEAF:
            continue
        part = rows.take(order[a:b])
        part.x = part.x.astype(np.float64)
        own = norms[order[a:b]]

        def distance(i: int, part=part, own=own) -> np.ndarray:
            entries = slice(part.at[i], part.at[i + 1])
            dense[part.term[entries]] = part.x[entries]
            out = own + own[i] - 2 * part.dot(dense)
            dense[part.term[entries]] = 0
            return out

        one = distance(int(np.argmax(distance(0))))
        other = distance(int(np.argmax(one)))
        order[a:b] = order[a:b][np.argsort(one - other, kind="stable")]
        runs += [(a, (a + b) // 2), ((a + b) // 2, b)]
    return order


class Tree:
    """A balanced ball tree over sparse integer rows; nodes are numbered from the root, children in pairs."""

    def __init__(self, rows: Rows, bands: np.ndarray):
        self.order = halves(rows, len(bands))
        self.rows = rows = rows.take(self.order)
        # terms of this block alone
        self.terms, local = np.unique(rows.term, return_inverse=True)
        self.bands = bands[self.terms]
        n_bands = int(bands.max(initial=0)) + 1
        nodes, self.child = [(0, len(rows))], []
        for a, b in nodes:  # grows while it is read
            self.child.append(len(nodes) if b - a > LEAF else -1)
            if b - a > LEAF:
                nodes += [(a, (a + b) // 2), ((a + b) // 2, b)]
        self.nodes = nodes
        row = np.repeat(np.arange(len(rows)), np.diff(rows.at))
        x = rows.x.astype(np.float64)
        self.centroid, self.radius = [], np.zeros((len(nodes), n_bands))
        number = np.zeros(len(self.terms), np.int64)
        for i, (a, b) in enumerate(nodes):
            entries = slice(rows.at[a], rows.at[b])
            here, own = local[entries], x[entries]
            sums = np.bincount(here, own, len(self.terms))
            held = np.flatnonzero(sums)
            c = sums[held] / (b - a)
            number[held] = np.arange(len(held))
            place = number[here]
            self.centroid.append((held, c))
            # squares of x - c, band by band: those of c, corrected where the row has the term
            squares = np.bincount(self.bands[held], c * c, n_bands)
            at = (row[entries] - a) * n_bands + self.bands[here]
            moved = np.bincount(at, own * (own - 2 * c[place]), (b - a) * n_bands).reshape(b - a, n_bands)
            size = np.bincount(at, own * own, (b - a) * n_bands).reshape(b - a, n_bands).max(axis=0, initial=0)
            farthest = np.maximum(moved.max(axis=0, initial=-np.inf) + squares, 0)
            self.radius[i] = np.sqrt(farthest + SLACK * (squares + size)) * (1 + SLACK)

    def bounds(self, of_terms: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
        """For every node and item (its terms and their weights), what no document below scores more than."""
        q = np.zeros((len(self.terms), len(weights)))
        norms = np.zeros((self.radius.shape[1], len(weights)))
        for i, (t, w) in enumerate(zip(of_terms, weights, strict=True)):
            place = np.searchsorted(self.terms, t)
            here = (place < len(self.terms)) & (self.terms[np.minimum(place, len(self.terms) - 1)] == t) if len(self.terms) else np.zeros(len(t), bool)
            place, w = place[here], w[here].astype(np.float64)
            q[place, i] = w
            norms[:, i] = np.sqrt(np.bincount(self.bands[place], w * w, len(norms)))
        middle = np.stack([c @ q[held] for held, c in self.centroid])
        return (middle + self.radius @ norms) * (1 + SLACK)

    def search(self, q: np.ndarray, bound: np.ndarray, least: int, best: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(rows, scores, leaves opened) of at least the best documents whose score reaches ``least``."""
        bound = bound.tolist()
        heap = [(-bound[0], 0)]
        rows, found = [], []
        top: list[int] = []  # the best scores of this tree
        opened = 0
        while heap:
            high, node = heapq.heappop(heap)
            if -high < max(least, 1):
                break
            if (child := self.child[node]) >= 0:
                for c in (child, child + 1):
                    if bound[c] >= max(least, 1):
                        heapq.heappush(heap, (-bound[c], c))
                continue
            opened += 1
            a, b = self.nodes[node]
            at = self.rows.at[a : b + 1]
            entries = slice(at[0], at[-1])
            products = np.concatenate([[0], np.cumsum(self.rows.x[entries] * q[self.rows.term[entries]])])
            score = products[at[1:] - at[0]] - products[at[:-1] - at[0]]
            good = np.flatnonzero(score >= max(least, 1))
            if len(good):
                rows.append(good + a)
                found.append(score[good])
                top = heapq.nlargest(best, [*top, *score[good].tolist()])
                if len(top) == best:
                    least = max(least, top[-1])
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), opened
        return self.order[np.concatenate(rows)], np.concatenate(found), opened


def _first(score: np.ndarray, key: np.ndarray, null: np.ndarray, best: int) -> np.ndarray:
    """Places of the first by falling score, then by key, null keys last."""
    return np.lexsort((key, null, -score))[:best]


def term_bands(df: np.ndarray) -> np.ndarray:
    """Band of each term: terms by falling frequency, the commonest alone, rarer ones with others of like total."""
    order = np.argsort(-df, kind="stable")
    share = np.cumsum(df[order]) / max(df.sum(), 1)
    bands = np.zeros(len(df), np.int64)
    bands[order] = np.minimum(np.floor(share * (BANDS - 1)).astype(np.int64), BANDS - 1)
    return np.unique(bands, return_inverse=True)[1] if len(df) else bands


def _searched(items: list[tuple[np.ndarray, np.ndarray]], df: np.ndarray, n_docs: int, length: int, best: int) -> Callable:
    """Best documents of a task's blocks for each item; an item is its terms and their weights."""
    n_terms, bands = len(df), term_bands(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in items]

        def block(parts: list[tuple]) -> None:
            key, null, n, term, tf, sizes = (np.concatenate(c) for c in zip(*parts, strict=True))
            tree = Tree(Rows(term, values(tf, np.repeat(n, sizes), n_docs, length), sizes), bands)
            q = np.zeros(n_terms, np.int64)
            for at in range(0, len(items), TOGETHER):
                some = items[at : at + TOGETHER]
                bounds = tree.bounds([t for t, _ in some], [w for _, w in some])
                for i, (t, w) in enumerate(some, at):
                    score, held, none = tops[i]
                    least = int(score[-1]) if len(score) == best else 1
                    q[t] = w
                    rows, found, _ = tree.search(q, bounds[:, i - at], least, best)
                    q[t] = 0
                    if len(rows):
                        score, held, none = (np.concatenate(c) for c in ((score, found), (held, key[rows]), (none, null[rows])))
                        keep = _first(score, held, none, best)
                        tops[i] = score[keep], held[keep], none[keep]

        parts, n_rows, n_entries = [], 0, 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                size = np.diff(batch.column(2).offsets.to_numpy())[at:]
                fits = int(np.searchsorted(np.cumsum(size), ENTRIES - n_entries, side="right"))
                end = at + max(min(fits, BLOCK - n_rows), 0 if parts else 1)
                if end > at:
                    part = batch.slice(at, end - at)
                    term, sizes = _flat(part.column(2))
                    key = part.column(0)
                    parts.append((key.fill_null(0).to_numpy(), key.is_null().to_numpy(zero_copy_only=False), part.column(1).to_numpy(), term, _flat(part.column(3))[0], sizes))
                    n_rows, n_entries, at = n_rows + end - at, n_entries + len(term), end
                if at < batch.num_rows:
                    block(parts)
                    parts, n_rows, n_entries = [], 0, 0
        if parts:
            block(parts)
        sizes = [len(s) for s, _, _ in tops]
        held = np.concatenate([k for _, k, _ in tops]) if tops else np.zeros(0, np.int64)
        null = np.concatenate([k for _, _, k in tops]) if tops else np.zeros(0, bool)
        score = np.concatenate([s for s, _, _ in tops]) if tops else held
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(sizes), dtype=np.int32), np.array(sizes, np.int64))), pa.array(held, mask=null), pa.array(score)], ["item", "key", "score"]
        )

    return run


def _batches(items: DataFrame, item: str, text: str, scratch: Scratch) -> Iterator[list[tuple]]:
    """(item, text) rows of some items at a time, all batches of bounded size but where one item is longer."""
    size = F.char_length("text") + F.lit(16)
    listed = items.select(F.col(item).alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text")).where(F.col("text") != "")
    listed = scratch.save(listed.withColumn("row", F.monotonically_increasing_id()), "items")
    total, longest = listed.agg(F.sum(size), F.max(size)).first()
    if total is None:
        return
    # dealt by a hash: batches of half the bound on average, and those that come out larger are cut again here
    n = -(-2 * total // BATCH_CHARS)
    dealt = listed.withColumn("batch", F.pmod(F.xxhash64("row"), F.lit(n)))
    for b in range(n):
        part: list[tuple] = []
        chars = 0
        for r in dealt.where(F.col("batch") == b).orderBy("row").toLocalIterator():
            if part and chars + len(r["text"]) > BATCH_CHARS:
                yield part
                part, chars = [], 0
            part.append((r["item"], r["text"]))
            chars += len(r["text"]) + 16
        if part:
            yield part


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", best: int = 20
) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``best`` documents."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    results = None
    for b, batch in enumerate(_batches(items, item, item_text, scratch)):
        found = [Counter(terms(t.encode())) for _, t in batch]
        vocabulary = sorted(set().union(*found))
        if not vocabulary:
            continue
        vectors = rows.mapInArrow(_vectors(vocabulary), "key long, n long, term array<int>, tf array<long>, near int, next int")
        vectors = scratch.save(vectors, f"vectors-{b}")
        n_docs, length, entries = vectors.agg(F.count(F.lit(1)), F.sum("n"), F.sum(F.size("term").cast("long"))).first()
        if not n_docs:
            return spark.createDataFrame([], _schema(items, item))
        # one row a term of this batch's items
        counted = vectors.select("term").mapInArrow(_frequencies(len(vocabulary)), "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
        df = np.zeros(len(vocabulary), np.int64)
        for r in counted.collect():
            df[r["term"]] = r["df"]
        w = np.array([weight(int(d), n_docs) for d in df])
        number = {t: i for i, t in enumerate(vocabulary)}
        wanted = []
        for counts in found:
            t = np.array(sorted(number[x] for x in counts), np.int64)
            wanted.append((t, np.array([counts[vocabulary[i]] for i in t], np.int64) * w[t] if len(t) else t))
        held = vectors.where(F.size("term") > 0)
        blocks = -(-n_docs // BLOCK) + entries // ENTRIES
        n_tasks = max(-(-blocks // BLOCKS_A_TASK), min(2 * spark.sparkContext.defaultParallelism, blocks))
        dealt = held.repartitionByRange(n_tasks, "near", "next", F.xxhash64("key", "n")).sortWithinPartitions("near", "next")
        tops = dealt.select("key", "n", "term", "tf").mapInArrow(_searched(wanted, df, n_docs, length, best), "item int, key long, score long")
        first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
        tops = tops.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= best)
        names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(batch)], f"item int, item_id {items.schema[item].dataType.simpleString()}")
        # a row an item of this batch
        named = tops.join(F.broadcast(names), "item").select("item_id", "rank", F.col("key").alias("doc_id"), "score")
        results = named if results is None else results.unionByName(named)
    return spark.createDataFrame([], _schema(items, item)) if results is None else results


def _schema(items: DataFrame, item: str) -> str:
    return f"item_id {items.schema[item].dataType.simpleString()}, rank int, doc_id long, score long"
