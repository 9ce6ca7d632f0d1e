"""N-gram Jaccard join with a prefix tree: documents whose five-word shingle sets are 0.8 alike.

1. Sets. Words are hashed from their bytes, shingles from their words' hashes (64 bits). Equal sets
   are one node of the graph of links.
2. Order. A fixed table of ``CELLS`` counters, filled by all documents, tells frequent shingles
   from rare ones. The larger the input, the more shingles share a counter, so those that are shared in spite of a low one are counted
   by themselves, and those that over ``FEW`` texts share come last (a bitmap of ``BITS`` bits has them). The global order is by that,
   counter and hash. Any order gives right results; without that bitmap, lines that some dozen texts share tie most sets of a large input
   together in one cluster.
3. Candidates. Two sets that are 0.8 alike share one of the first n - ceil(0.8 n) + 1 shingles of
   each, their prefixes. Where up to ``FEW`` sets share such a shingle, those of matching sizes are
   paired, and pairs stay whose prefixes have enough in common: all other common shingles lie
   outside one of the prefixes. Where more sets share it, they are chained in order of size while
   neighbours' sizes match, so no more links come up than sets; those of one batch are chained before they are
   shuffled, and a chain goes on as one row. Components of pairs and chains are clusters: no
   two alike sets lie in different ones.
4. Trees. A cluster's sets are put in a prefix tree, ordered from frequent to rare so that
   overlaps are shared. Each set walks the tree built so far, adding up the overlap along the
   way, and leaves subtrees whose sizes and remaining lengths can't reach the overlap needed, or
   whose sets all belong to its own component already.
5. Clusters of over ``BLOCK`` sets (longer ones count more) are cut in blocks by size. Each block is joined in itself; then
   one set of each component goes on to the next round, until they fit in a block. At last the
   sets outside their cluster's largest component meet all blocks of matching sizes, block by
   block, so no link between components is lost. Sets within one component need no links.

Components of links give the classes. Defined cases: a null text, or one without words, has no
shingles, links with nothing and is its own component; texts of one to four words are one shingle;
equal rows are linked unless empty; a null key never is a component's name unless all keys are
null; an empty table gives no rows; input columns named like those that the operator adds are
replaced. Sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringwise.llm.common import BITS, Scratch, chunks, lean, others, split, utf8
from ringwise.llm.graph import components
from ringwise.operators.ranking import later_in_group

ADDED = ("n_shingles", "component_id")
SHINGLE = 5
CELLS = 1 << 20
PART = 1 << 12
#: Bytes of text that are worked on at once: few enough that arrays stay in a core's cache.
TEXTS = 1 << 17
#: Sets of a cluster that one task joins, of ``USUAL`` shingles each; longer ones count as more.
BLOCK = 2_000
USUAL = 600
#: Sets sharing a prefix shingle that are paired; a fixed number, so that pairs grow with the input.
FEW = 16
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
#: An odd number and its inverse modulo 2^64: hashes of words are differences of prefix sums.
_BASE = 0x5851F42D4C957F2D
_UNBASE = pow(_BASE, -1, 1 << 64)
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _K[1]
    x = (x ^ (x >> np.uint64(27))) * _K[2]
    return x ^ (x >> np.uint64(31))


_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if n > len(_tables.get(base, ())):
        out = np.full(max(n, TEXTS), base, np.uint64)
        out[:1] = 1
        out = np.multiply.accumulate(out)
        if n > TEXTS:  # a long text's own table isn't kept
            return out
        _tables[base] = out
    return _tables[base][:n]


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of one text after the other, their number in each); ``lower`` takes A-Z as small letters."""
    n_texts, n = len(offsets) - 1, len(raw)
    none = np.zeros(0, np.uint64), np.zeros(n_texts, np.int64)
    if not n:
        return none
    letter = ~_BLANK[raw]
    cut = np.zeros(n + 1, bool)
    cut[offsets[:-1]] = True
    before = np.concatenate([[False], letter[:-1]]) & ~cut[:n]
    starts = np.flatnonzero(letter & ~before)
    after = np.concatenate([letter[1:], [False]]) & ~cut[1:]
    ends = np.flatnonzero(letter & ~after) + 1
    if not len(starts):
        return none
    values = _LOWER[raw] if lower else raw.astype(np.uint64)
    values += np.uint64(1)
    values *= _powers(_BASE, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    word = _mix((sums[ends] - sums[starts]) * _powers(_UNBASE, n)[starts] + (ends - starts).astype(np.uint64) * _K[0])
    return word, np.diff(np.searchsorted(starts, offsets))


def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingles of one text after the other, their number in each)."""
    n_texts = len(offsets) - 1
    word, n_words = word_hashes(raw, offsets, lower=True)
    if not len(word):
        return np.zeros(0, np.uint64), np.zeros(n_texts, np.int64)
    text = np.repeat(np.arange(n_texts), n_words)
    shingle = word.copy()
    m = len(word)
    for k in range(1, SHINGLE):
        shingle[: m - k] = _mix(shingle[: m - k] * _K[0] + word[k:])
    whole = np.zeros(m, bool)
    whole[: max(m - SHINGLE + 1, 0)] = text[: max(m - SHINGLE + 1, 0)] == text[SHINGLE - 1 :]
    first = np.cumsum(n_words) - n_words
    for i in np.flatnonzero((n_words > 0) & (n_words < SHINGLE)):
        value = np.array([n_words[i]], np.uint64)
        for w in word[first[i] : first[i] + n_words[i]]:
            value = _mix(value * _K[0] + w)
        shingle[first[i]], whole[first[i]] = value[0], True
    shingle, text = shingle[whole], text[whole]
    order = np.lexsort((shingle, text))
    shingle, text = shingle[order], text[order]
    new = np.ones(len(shingle), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (text[1:] != text[:-1])
    return shingle[new], np.bincount(text[new], minlength=n_texts)


def _sets(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, shingles, counts) of a batch's texts, some at a time."""
    raw, offsets = utf8(column)
    for a, b in chunks(offsets, TEXTS):
        part = offsets[a : b + 1]
        yield a, b, *shingle_sets(raw[part[0] : part[-1]], part - part[0])


def _cell(shingle: np.ndarray) -> np.ndarray:
    return (shingle >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def frequencies(texts: DataFrame, scratch: Scratch) -> np.ndarray:
    """How many documents' shingles fall in each of the ``CELLS`` cells: a table of fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, some = np.zeros(CELLS, np.int64), False
        for batch in batches:
            for _, _, shingle, _ in _sets(batch.column(0)):
                table += np.bincount(_cell(shingle), minlength=CELLS)
                some = True
        if some:
            parts = [table[i : i + PART].astype("<i8").tobytes() for i in range(0, CELLS, PART)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["part", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(PART, np.int64)
        for counts in rows["counts"]:
            total += np.frombuffer(counts, "<i8")
        return pd.DataFrame({"part": rows["part"].iloc[:1].astype("int32"), "counts": [total.tobytes()]})

    counted = texts.mapInArrow(lean(count), "part int, counts binary").withColumn("some", F.pmod(F.spark_partition_id(), F.lit(64)))
    added = counted.groupBy("part", "some").applyInPandas(add, "part int, counts binary")
    added = added.groupBy("part").applyInPandas(add, "part int, counts binary")
    out = np.zeros(CELLS, np.int64)
    for row in scratch.save(added, "cells").collect():  # CELLS numbers, whatever the input
        out[row["part"] * PART : (row["part"] + 1) * PART] = np.frombuffer(row["counts"], "<i8")
    return out


def _longer(n: int) -> int:
    """Shingles of a set of n that are counted one by one: what may come into its prefix when frequent ones leave it."""
    return min(n, int(prefix_length(np.int64(n))) * 3 // 2 + 4)


def shared_often(texts: DataFrame, often: Broadcast, scratch: Scratch) -> np.ndarray:
    """Bitmap of ``BITS`` bits, by the low bits of hashes, of the shingles that over ``FEW`` texts have among the first of their own."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, shingle, counts in _sets(batch.column(0)):
                ends = np.cumsum(counts)
                frequency = often.value[_cell(shingle)]
                parts = []
                for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
                    if n:
                        order = np.argsort(frequency[end - n : end], kind="stable")
                        parts.append(shingle[end - n : end][order[: _longer(n)]])
                if parts:
                    spots, n_texts = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(spots.view(np.int64)), pa.array(n_texts.astype(np.int32))], ["spot", "texts"])

    counted = texts.mapInArrow(lean(first), "spot long, texts int").repartition("spot").groupBy("spot").agg(F.sum("texts").alias("texts"))
    # these functions count bits from 1 on
    place = F.pmod("spot", F.lit(BITS)) + 1
    placed = counted.where(F.col("texts") > FEW).select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    bits = scratch.save(placed.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")), "often")
    out = np.zeros(BITS // 8, np.uint8)
    for row in bits.collect():  # BITS bits, whatever the input
        out[(row["bucket"] - 1) * len(row["bits"]) : row["bucket"] * len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)
    return out


def _last(shingle: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether the bitmap has the shingles."""
    place = shingle & np.uint64(8 * len(bits) - 1)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1


def prefix_length(n: np.ndarray) -> np.ndarray:
    """Shingles of a set of n of which a set 0.8 alike shares one at least: n - ceil(0.8 n) + 1."""
    return n - (4 * n + 4) // 5 + 1


def _prefixes(shared: Broadcast, last: Broadcast):
    """Node, size and ordered prefix of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for batch in batches:
            for a, b, shingle, counts in _sets(batch.column(2)):
                out: list[list] = [[], [], []]
                ends = np.cumsum(counts)
                frequency = often[_cell(shingle)] + (_last(shingle, last.value).astype(np.int64) << 48)
                for i in range(b - a):
                    own = shingle[ends[i] - counts[i] : ends[i]]
                    n = int(counts[i])
                    if n:
                        name = _mix(np.cumsum(_mix(own * _K[0] + np.arange(n, dtype=np.uint64)))[-1:] + np.uint64(n))
                        order = np.argsort(frequency[ends[i] - n : ends[i]], kind="stable")  # sets are in order of hash
                        out[2].append(own[order[: int(prefix_length(np.int64(n)))]].tobytes())
                    else:
                        name = np.zeros(1, np.uint64)
                        out[2].append(b"")
                    out[0].append(int(name.view(np.int64)[0]))
                    out[1].append(n)
                columns = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], ["row", "key", "node", "n", "prefix"])

    return run


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From prefixes: a row a shingle and set, or, where over ``FEW`` sets of a batch share it, the batch's links and chains.

    Rows are (spot, least, most, u, v, kind): kind 0 is a set, 1 a chain with its range of sizes, 2 a link from u to v.
    """
    for batch in batches:
        for from_row in range(0, batch.num_rows, 2_000):
            part = batch.slice(from_row, 2_000)
            prefixes = [np.frombuffer(p, np.uint64) for p in part["prefix"].to_pylist()]
            lengths = np.array([len(p) for p in prefixes], np.int64)
            if not lengths.sum():
                continue
            shingle = np.concatenate(prefixes)
            node = np.repeat(part["node"].to_numpy(), lengths)
            size = np.repeat(part["n"].to_numpy(), lengths)
            order = np.lexsort((node, size, shingle))
            shingle, node, size = shingle[order], node[order], size[order]
            new = np.ones(len(shingle), bool)
            new[1:] = shingle[1:] != shingle[:-1]
            group = np.cumsum(new) - 1
            many = np.bincount(group)[group] > FEW
            linked = np.zeros(len(node), bool)
            linked[1:] = many[1:] & ~new[1:] & (5 * size[:-1] >= 4 * size[1:])
            at = np.flatnonzero(linked)
            first = np.flatnonzero(~linked)
            last = np.append(first[1:], len(node)) - 1
            links = np.unique(np.stack([node[at - 1], node[at]]), axis=1)
            zero = np.zeros(links.shape[1], np.int64)
            columns = [
                np.concatenate([_mix(links[1].view(np.uint64) + _K[0]), shingle[first]]).view(np.int64),
                np.concatenate([zero, size[first]]),
                np.concatenate([zero, size[last]]),
                np.concatenate([links[0], node[first]]),
                np.concatenate([links[1], np.zeros(len(first), np.int64)]),
                np.concatenate([zero + 2, many[first].astype(np.int64)]).astype(np.int8),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["spot", "least", "most", "u", "v", "kind"])


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v, pair) from a stream sorted by shingle and least size; ``pair`` says that prefixes decide on it."""
    spot, rows, chained, most, node = None, [], False, 0, 0
    out: tuple[list, list, list] = ([], [], [])

    def put(u: int, v: int, pair: bool) -> None:
        if u != v:
            for column, value in zip(out, (min(u, v), max(u, v), pair), strict=True):
                column.append(value)

    def follow(least: int, upto: int, u: int) -> None:
        nonlocal most, node
        if 5 * most >= 4 * least:
            put(node, u, False)
        most, node = max(most, upto) if 5 * most >= 4 * least else upto, u

    def end() -> None:
        if not chained:
            for i, (_, n, u) in enumerate(rows):
                for _, m, v in rows[:i]:
                    if 5 * m >= 4 * n:
                        put(v, u, True)
        rows.clear()

    def flush() -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.bool_())
        ready = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["u", "v", "pair"])
        for column in out:
            column.clear()
        return ready

    for batch in batches:
        kinds = batch["kind"].to_numpy()
        for u, v in zip(batch["u"].to_numpy()[kinds == 2].tolist(), batch["v"].to_numpy()[kinds == 2].tolist(), strict=True):
            put(u, v, False)
        keep = kinds != 2
        spots = batch["spot"].to_numpy()[keep]
        if len(spots):
            # shingles that occur once are left out of the loop, but for the ends of the batch
            near = np.zeros(len(spots), bool)
            near[[0, -1]] = True
            near[1:] |= spots[1:] == spots[:-1]
            near[:-1] |= spots[1:] == spots[:-1]
            columns = [spots, *(batch[c].to_numpy()[keep] for c in ("least", "most", "u")), kinds[keep]]
            for key, least, upto, u, kind in zip(*(c[near].tolist() for c in columns), strict=True):
                if key != spot:
                    end()
                    spot, chained = key, False
                if chained:
                    follow(least, upto, u)
                    continue
                rows.append((least, upto, u))
                if kind == 1 or len(rows) > FEW:
                    chained, (_, most, node) = True, rows[0]
                    for row in rows[1:]:
                        follow(*row)
                    rows.clear()
        if out[0]:
            yield flush()
    end()
    if out[0]:
        yield flush()


def _common(pairs: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs whose prefixes leave room for 0.8: common shingles outside them lie outside one of them at most.

    Prefixes travel as 32 bits a shingle, which can only make them seem more alike.
    """

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [np.unique(np.frombuffer(p, np.uint64).astype(np.uint32)).tobytes() for p in batch["prefix"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["node"], batch["n"], pa.array(cut, pa.binary())], ["node", "n", "low"])

    low = scratch.save(nodes.mapInArrow(lean(short), "node long, n long, low binary"), "low")
    side = lambda name: low.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("low").alias(f"low_{name}"))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            sizes = zip(batch["n_u"].to_pylist(), batch["n_v"].to_pylist(), strict=True)
            for (n, m), a, b in zip(sizes, batch["low_u"].to_pylist(), batch["low_v"].to_pylist(), strict=True):
                common = len(np.intersect1d(np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32), assume_unique=True))
                # two shingles of a set may share their 32 bits
                lost = int(prefix_length(np.int64(n))) - len(a) // 4 + int(prefix_length(np.int64(m))) - len(b) // 4
                rest = max(n - int(prefix_length(np.int64(n))), m - int(prefix_length(np.int64(m))))
                keep.append(9 * (common + lost + rest) >= 4 * (n + m))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", "n_u", "n_v", "low_u", "low_v").mapInArrow(lean(decide), "u long, v long")


class _Branch:
    """A stretch of the tree: its ranks, what follows, the sets that end here, and bounds of all sets below."""

    __slots__ = ("ranks", "children", "ending", "least", "longest", "member", "uniform")

    def __init__(self, ranks: np.ndarray):
        self.ranks, self.children, self.ending = ranks, {}, []
        self.least, self.longest = 1 << 62, 0
        self.member, self.uniform = -1, True


class Tree:
    """Prefix tree of sets of ranks in ascending order, with components of the sets found alike."""

    def __init__(self, n_ranks: int):
        self.root = _Branch(np.zeros(0, np.int64))
        self.stamp = np.zeros(n_ranks, np.int64)
        self.sets: list[np.ndarray] = []
        self.sizes: list[int] = []
        self.parent: list[int] = []

    def add(self, ranks: np.ndarray, size: int) -> int:
        self.sets.append(ranks)
        self.sizes.append(size)
        self.parent.append(len(self.parent))
        return len(self.parent) - 1

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def union(self, x: int, y: int) -> None:
        self.parent[self.find(y)] = self.find(x)

    def insert(self, x: int) -> None:
        ranks, branch, at = self.sets[x], self.root, 0
        while True:
            self._note(branch, x, len(ranks) - at)
            if at == len(ranks):
                branch.ending.append(x)
                return
            child = branch.children.get(int(ranks[at]))
            if child is None:
                child = _Branch(ranks[at:])
                branch.children[int(ranks[at])] = child
                self._note(child, x, 0)
                child.ending.append(x)
                return
            n = min(len(child.ranks), len(ranks) - at)
            same = child.ranks[:n] == ranks[at : at + n]
            common = n if same.all() else int(same.argmin())
            if common < len(child.ranks):
                upper = _Branch(child.ranks[:common])
                upper.least, upper.longest = child.least, child.longest + len(child.ranks) - common
                upper.member, upper.uniform = child.member, child.uniform
                child.ranks = child.ranks[common:]
                upper.children[int(child.ranks[0])] = child
                branch.children[int(ranks[at])] = upper
                child = upper
            branch, at = child, at + common

    def _note(self, branch: _Branch, x: int, below: int) -> None:
        branch.least = min(branch.least, self.sizes[x])
        branch.longest = max(branch.longest, below)
        if branch.member < 0:
            branch.member = x
        elif branch.uniform:
            branch.uniform = self.find(branch.member) == self.find(x)

    def alike(self, x: int, link) -> None:
        """Calls link(x, y) for inserted sets y alike to x, one at least in each component that has any."""
        ranks, size = self.sets[x], self.sizes[x]
        has, mark = self.stamp, x + 1  # a rank that x has bears its mark
        has[ranks] = mark
        stack = [(self.root, 0)]
        while stack:
            branch, overlap = stack.pop()
            if branch.member < 0 or (branch.uniform and self.find(branch.member) == self.find(x)):
                continue
            own = branch.ranks
            rest = len(ranks)
            if len(own):
                overlap += int(np.count_nonzero(has[own] == mark))
                rest = len(ranks) - int(np.searchsorted(ranks, own[-1], side="right"))
            if 9 * (overlap + min(rest, branch.longest)) < 4 * (size + branch.least):
                continue
            for y in branch.ending:
                if 9 * overlap >= 4 * (size + self.sizes[y]) and self.find(x) != self.find(y):
                    self.union(x, y)
                    link(x, y)
            # the likeliest child comes off the stack first
            stack.extend((c, overlap) for r, c in branch.children.items() if has[r] != mark)
            stack.extend((c, overlap) for r, c in branch.children.items() if has[r] == mark)


def join_sets(nodes: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], side: np.ndarray, known: np.ndarray) -> list[tuple[int, int]]:
    """Links between sets of side 0 and all others (side 0 only: among themselves).

    ``known`` are components already found; one link at least is given for any two sets alike of
    different components, or a path of such links.
    """
    every, inverse, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # frequent first; shingles of one set never overlap and only count for its size
    rank_of = np.empty(len(every), np.int64)
    rank_of[np.lexsort((every, -df))] = np.arange(len(every))
    n_ranks = int((df > 1).sum())
    ranks, at = rank_of[inverse], 0
    tree = Tree(n_ranks)
    for s, n in zip(sets, sizes, strict=True):
        own = np.sort(ranks[at : at + len(s)])
        tree.add(own[own < n_ranks], int(n))
        at += len(s)
    by_known: dict[int, int] = {}
    for x, c in enumerate(known):
        tree.union(by_known.setdefault(int(c), x), x)
    links: list[tuple[int, int]] = []
    link = lambda x, y: links.append((int(nodes[x]), int(nodes[y])))
    order = np.lexsort((nodes, sizes))
    one_sided = bool((side == 1).any())
    for x in order[side[order] == 1] if one_sided else []:
        tree.insert(int(x))
    for x in order[side[order] == 0] if one_sided else order:
        tree.alike(int(x), link)
        if not one_sided:
            tree.insert(int(x))
    return links


def _join(rows: pd.DataFrame) -> pd.DataFrame:
    links: list[tuple[int, int]] = []
    for _, group in rows.groupby("cluster", sort=False):
        if len(group) > 1:
            sets = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
            links += join_sets(group["node"].to_numpy(), group["n"].to_numpy(), sets, group["side"].to_numpy(), group["known"].to_numpy())
    return pd.DataFrame(links or np.zeros((0, 2), np.int64), columns=["u", "v"], dtype="int64")


def _joined(rows: DataFrame) -> DataFrame:
    """Links from rows (task, cluster, side, known, node, n, shingles): a task joins each of its clusters."""
    return rows.groupBy("task").applyInPandas(_join, "u long, v long")


def _links(sets: DataFrame, scratch: Scratch, block: int) -> DataFrame:
    """Links (u, v) among sets (cluster, node, n, shingles) that give the components of all links."""
    light = sets.select("cluster", "node", "n")
    counts = scratch.save(light.groupBy("cluster").agg(F.ceil(F.sum(_weight())).alias("members")), "counts")
    n_sets, largest = counts.agg(F.coalesce(F.sum("members"), F.lit(0)), F.coalesce(F.max("members"), F.lit(0))).first()
    tasks = max(1, 4 * n_sets // block)
    small = sets.join(counts.where(F.col("members") <= block).select("cluster"), "cluster", "left_semi")
    small = small.select(F.pmod(F.xxhash64("cluster"), F.lit(tasks)).alias("task"), "cluster", F.lit(0).alias("side"), F.col("node").alias("known"), "node", "n", "shingles")
    links = scratch.save(_joined(small), "links-small")
    if largest <= block:
        return links
    large = light.join(counts.where(F.col("members") > block).select("cluster"), "cluster", "left_semi")
    members, n = scratch.save(large, "large"), 0
    chosen = members
    while True:  # each round leaves one set a component of each block
        n += 1
        placed = scratch.save(_in_blocks(chosen, block), f"placed-{n}")
        rows = sets.drop("n").join(placed, ["cluster", "node"])
        rows = rows.select(F.xxhash64("cluster", "block").alias("task"), "cluster", F.lit(0).alias("side"), F.col("node").alias("known"), "node", "n", "shingles")
        found = scratch.save(_joined(rows), f"links-{n}")
        links = links.unionByName(found)
        blocks = placed.agg(F.max("block")).first()[0]
        if not blocks:
            break
        roots = scratch.save(components(found, scratch, f"round-{n}"), f"roots-{n}")
        heads = placed.join(roots, "node", "left").where(F.coalesce("root", "node") == F.col("node"))
        chosen_next = scratch.save(heads.select("cluster", "node", "n"), f"chosen-{n}")
        if scratch.rows(f"chosen-{n}") == placed.count():
            break  # nothing was alike: what is left is for the last step
        chosen = chosen_next
    roots = scratch.save(components(links, scratch, "so-far"), "roots-so-far")
    known = members.join(roots, "node", "left").select("cluster", "node", "n", F.coalesce("root", "node").alias("known"))
    known = scratch.save(known, "known")
    sizes = known.groupBy("cluster", "known").agg(F.count("*").alias("c"))
    main = scratch.save(sizes.groupBy("cluster").agg(F.max_by("known", F.struct("c", "known")).alias("main")), "main")
    apart = known.join(main, "cluster").where(F.col("known") != F.col("main"))
    apart = scratch.save(_in_blocks(apart.select("cluster", "node", "n"), block // 2), "apart")
    if apart.isEmpty():
        return links
    blocks = scratch.save(_in_blocks(members, block // 2), "blocks")
    bounds = lambda df, name: df.groupBy("cluster", F.col("block").alias(name)).agg(F.min("n").alias(f"{name}_lo"), F.max("n").alias(f"{name}_hi"))
    meets = bounds(apart, "a").join(bounds(blocks, "b"), "cluster").where("5 * a_hi >= 4 * b_lo and 5 * b_hi >= 4 * a_lo")
    meets = scratch.save(meets.select("cluster", "a", "b"), "meets")
    parts = [
        part.join(meets, (part["cluster"] == meets["cluster"]) & (part["block"] == meets[name])).select(meets["cluster"], "a", "b", "node", F.lit(side).alias("side"))
        for part, name, side in ((apart, "a", 0), (blocks, "b", 1))
    ]
    pairs = parts[0].unionByName(parts[1]).join(known, ["cluster", "node"])
    rows = pairs.join(sets.drop("n"), ["cluster", "node"]).select(F.xxhash64("cluster", "a", "b").alias("task"), "cluster", "side", "known", "node", "n", "shingles")
    return links.unionByName(scratch.save(_joined(rows), "links-apart"))


def _in_blocks(members: DataFrame, block: int) -> DataFrame:
    """Numbers the blocks of each cluster's sets in order of size, by one range-partitioned sort: no task holds a whole cluster."""
    weighed = members.withColumn("weight", F.greatest(F.lit(USUAL), F.col("n")))
    ranked = later_in_group(weighed, ["cluster"], ["n", "node"], weight="weight")
    return ranked.withColumn("block", F.floor(F.col("later") / F.lit(USUAL * block))).drop("weight", "later")


def _weight() -> Column:
    return F.greatest(F.lit(1.0), F.col("n") / USUAL)


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK, classes: bool = False) -> DataFrame:
    """Input columns but the text, n_shingles and component_id: the least key among all linked documents.

    ``classes`` adds ``class``, a name of the component that no two share, null without words.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    context = docs.sparkSession.sparkContext
    kept = others(docs, *ADDED, text)
    body = F.coalesce(F.col(text), F.lit(""))
    often = context.broadcast(frequencies(docs.select(body.alias("text")), scratch))  # 8 MB
    scratch.drop("cells")
    last = context.broadcast(shared_often(docs.select(body.alias("text")), often, scratch))  # 8 MB
    scratch.drop("often")
    row = F.struct(F.lit(0).alias("__"), *kept)
    source = docs.select(row.alias("row"), F.xxhash64(body).alias("key"), body.alias("text"))
    fields = [source.schema["row"], T.StructField("key", T.LongType()), T.StructField("node", T.LongType()), T.StructField("n", T.LongType()), T.StructField("prefix", T.BinaryType())]
    rows = scratch.save(source.mapInArrow(lean(_prefixes(often, last)), T.StructType(fields)), "prefixes")
    scratch.drop()

    nodes = rows.where("n > 0").select("node", "n", "prefix").dropDuplicates(["node"])
    rows_of = nodes.mapInArrow(lean(_chain), "spot long, least long, most long, u long, v long, kind byte")
    matched = rows_of.repartition("spot").sortWithinPartitions("spot", "least", "u").mapInArrow(lean(_matched), "u long, v long, pair boolean")
    # a link of a chain stays, whatever the prefixes say
    matched = scratch.save(matched.groupBy("u", "v").agg(F.min("pair").alias("pair")), "matched")
    scratch.drop()
    near = matched.where(~F.col("pair")).select("u", "v").unionByName(_common(matched.where("pair"), nodes, scratch))
    near = scratch.save(near, "near")
    scratch.drop("low")
    clusters = scratch.save(components(near, scratch, "cluster").withColumnRenamed("root", "cluster"), "clusters")

    wanted = rows.where("n > 0").groupBy("node").agg(F.min("key").alias("key")).join(clusters, "node")
    wanted = scratch.save(wanted, "wanted")
    # most texts are in no cluster: they aren't shuffled
    clustered, _ = split(source.select("key", "text"), "key", wanted.select("key"), scratch, "wanted-bits")
    texts = clustered.dropDuplicates(["key"]).join(wanted, "key").select("cluster", "node", "text")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, shingle, n in _sets(batch.column(2)):
                ends, part = np.cumsum(n), batch.slice(a, b - a)
                sets = [shingle[ends[i] - n[i] : ends[i]].tobytes() for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n), pa.array(sets, pa.binary())], ["cluster", "node", "n", "shingles"])

    sets = scratch.save(texts.mapInArrow(lean(whole), "cluster long, node long, n long, shingles binary"), "sets")
    scratch.drop()
    links = scratch.save(_links(sets, scratch, block), "links")
    roots = scratch.save(components(links, scratch, "class"), "classes")
    scratch.drop("sets")

    placed = rows.select("row", "n", "node").join(roots, "node", "left").withColumn("class", F.coalesce("root", "node"))
    placed = placed.withColumn("doc", F.col("row")[key])
    least = scratch.save(placed.where("n > 0").groupBy("class").agg(F.min("doc").alias("least")), "least")
    result = placed.withColumn("class", F.when(F.col("n") > 0, F.col("class"))).join(least, "class", "left")
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc"))
    out = [F.col("row")[c].alias(c) for c in kept] + [F.col("n").alias("n_shingles"), component.alias("component_id")]
    return result.select(*out, *(["class"] if classes else []))


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents of ``docs`` that stay: of each group of linked ones the one with the least key.

    Where a key is repeated, the least hash of the text decides; equal rows stay once. Documents
    without words all stay.
    """
    scratch = Scratch(docs.sparkSession, "representatives")
    hashed = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    light = join(hashed, "key", "text", classes=True).where("class is not null").select("key", "hash", "class")
    light = scratch.save(light, "light")
    rank = F.struct(F.col("key").isNull().alias("last"), "key", "hash")
    best = scratch.save(light.groupBy("class").agg(F.min(rank).alias("best")), "best")
    away = light.join(best, "class").where(rank != F.col("best")).select(F.col("key").alias("__key"), F.col("hash").alias("__hash"))
    away = scratch.save(away.distinct(), "away")
    again = light.groupBy("key", "hash").agg(F.count("*").alias("n")).where("n > 1")
    again = scratch.save(again.select(F.col("key").alias("__key"), F.col("hash").alias("__hash")), "again")
    same = F.col(key).eqNullSafe(F.col("__key")) & F.xxhash64(text).eqNullSafe(F.col("__hash"))
    # the others stay as they are: only texts that may be away or come again are shuffled
    spots = away.unionByName(again).select(F.xxhash64("__key", "__hash").alias("__spot"))
    named, clear = split(docs.withColumn("__spot", F.xxhash64(F.col(key), F.xxhash64(text))), "__spot", spots, scratch, "bits")
    left = named.drop("__spot").join(away, same, "left_anti")
    once = left.join(again, same, "left_semi").withColumn("__hash", F.xxhash64(text)).dropDuplicates([key, "__hash"]).drop("__hash")
    return clear.drop("__spot").unionByName(left.join(again, same, "left_anti")).unionByName(once)
