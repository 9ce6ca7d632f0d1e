"""Suffix-array dedup: bytes covered by a string of ``width`` bytes that starts anywhere else too.

A distributed difference-cover algorithm on suffixes cut at ``width`` bytes:

1. Triples. In each text, every position is named after its three bytes; the names of three
   neighbouring positions give the name of nine bytes, and so on by recursion up to 243 bytes. A
   name is a 64-bit hash of the triple of names below it, so equal strings have equal names in all
   texts and no ranks have to be sent back.
2. Cover. Of the ``STEP`` (157) positions that follow each position, the one with the least nine-byte
   name is sampled. This depends on these bytes alone, so two equal strings of ``width`` bytes have
   a sampled position at the same distance from their starts: that is what a difference cover
   is for. About one position in 79 is sampled.
3. Sampled suffixes are sorted by the name of their first ``width`` - 156 bytes, and
   neighbours are compared. Those whose prefix is found once only can't lie in a repeated string.
4. The remaining suffixes, those that a surviving sampled one stands for, are merged in. The first and
   the last of them are sorted by the name of all their ``width`` bytes, and neighbours compared. If
   both are repeated, all between them are covered whether repeated or not. Else the positions of
   that name meet with the bytes around their equal prefix: these tell all suffixes that they stand
   for apart, which are sorted and compared in the task. A name of more than ``TOGETHER`` positions is
   dealt over several tasks; one row for each different suffix of a task is then sorted once more, to settle those left open.

Rows with equal names within one batch are known to be repeated; they are sorted under a random
key, but for one that meets the other batches' rows. So a passage in a third of all documents
is spread over all tasks. Sorted partitions are compared as a stream, so memory is bounded. Equal
texts (by a 64-bit hash) are worked on once; a text with a copy goes as a whole.

Passages of words are found in the same way: a symbol is a word's code of ``CODE`` bytes there, not a byte, and only positions
where words begin are named, sampled and compared.

Defined cases: a null text is empty; texts shorter than ``width`` bytes lose nothing; runs that
overlap themselves count; repeated rows are copies of each other; an empty table gives no rows;
input columns named like those that the operator adds are replaced. Memory of a task is about
60 bytes a byte of its segment of 2^16 bytes, besides the batch of texts itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringwise.llm.common import Scratch, chunks, lean, others, split, utf8
from ringwise.llm.jaccard_join import word_hashes

ADDED = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "removed", "n_passage_words")
WIDTH = 400
#: Bytes of the longest names, and positions of which one is sampled, from the widest strings down: the first two that suit the width.
STEP = 157
SPAN = 243
SPANS = ((SPAN, STEP), (SPAN, 64), (81, 64), (81, 32), (27, 24), (27, 16))
#: Positions of a text, or of texts one after the other, that are worked on at once: few enough that arrays stay in a core's cache.
SEGMENT = 1 << 16
#: Characters of a word's code, six bits of its hash each, see ``without_passages``.
CODE = 3
_DIGITS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+-", np.uint8)
#: The code of each value of a hash's last bits.
_CODES = np.stack([_DIGITS[np.arange(1 << (6 * CODE)) >> (6 * i) & 63] for i in range(CODE)], axis=1)
#: Positions of one name whose suffixes one task compares.
TOGETHER = 2_000
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _triple(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    x = a * _K[0]
    x += b
    x *= _K[1]
    x ^= x >> np.uint64(29)
    x += c
    x *= _K[2]
    x ^= x >> np.uint64(32)
    return x


def reach_of(width: int) -> tuple[int, int]:
    """(bytes of the longest names, positions of which one is sampled): a string of ``width`` bytes is two names that may overlap."""
    for span, step in SPANS:
        if span + step <= width <= 2 * span:
            return span, step
    raise ValueError(f"width {width} must be a name and a step at least, and two names at most, of {SPANS}")


def triple_names(raw: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """Names of the 9 and of the ``span`` bytes from each position on (as far as these lie in ``raw``)."""
    wide = raw.astype(np.uint64)
    if raw.dtype == np.uint8:
        names = wide[:-2] | wide[1:-1] << np.uint64(8) | wide[2:] << np.uint64(16)
        names *= _K[0]
    else:
        names = _triple(wide[:-2], wide[1:-1], wide[2:])
    nine, length = names, 3
    while length < span:
        names = _triple(names[: -2 * length], names[length:-length], names[2 * length :])
        length *= 3
        if length == 9:
            nine = names
    return nine, names


def prefix_name(names: np.ndarray, at: np.ndarray, length: int, span: int = SPAN) -> np.ndarray:
    """Name of ``length`` bytes (one span to two) from the names of their first and last span."""
    x = names[at] * _K[1]
    x ^= x >> np.uint64(31)
    return (x + names[at + (length - span)]) * _K[2]


def _segments(raw: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    for s in range(0, len(raw) - width + 1, SEGMENT):
        yield s, raw[s : s + SEGMENT + width - 1]


def _text_ends(offsets: np.ndarray, s: int, n: int) -> np.ndarray:
    """End of the text that each of the n positions from s on lies in."""
    first = int(np.searchsorted(offsets, s, side="right")) - 1
    last = int(np.searchsorted(offsets, s + n, side="left"))
    starts = np.clip(offsets[first:last], s, s + n)
    ends = np.clip(offsets[first + 1 : last + 1], s, s + n)
    return np.repeat(offsets[first + 1 : last + 1], ends - starts)


def sampled(raw: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """(position, first and last start of a window that it stands for, prefix name) of the sampled positions."""
    span, step = reach_of(width)
    core = width - step + 1
    found: list[tuple[np.ndarray, ...]] = []
    for s, part in _segments(raw, width):
        nine, names = triple_names(part, span)
        n, bits = len(part) - width + 1, np.uint64(len(part).bit_length())
        least = (nine >> bits << bits) | np.arange(len(nine), dtype=np.uint64)
        reach = 1
        while reach < step:
            more = min(reach, step - reach)
            least = np.minimum(least[:-more], least[more:])
            reach += more
        at = (least[:n] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        starts = np.flatnonzero(_text_ends(offsets, s, n) >= np.arange(s + width, s + n + width))
        if not len(starts):
            continue
        at = at[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
        last = np.append(new[1:], True)
        found.append((at[new] + s, starts[new] + s, starts[last] + s, prefix_name(names, at[new], core, span)))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    at, lo, hi, name = (np.concatenate(c) for c in zip(*found, strict=True))
    # a position that two segments found is one
    same = np.zeros(len(at), bool)
    same[1:] = at[1:] == at[:-1]
    end = np.append(~same[1:], True)
    return at[~same], lo[~same], hi[end], name[~same]


def window_names(raw: np.ndarray, starts: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Names of the first and last bytes, a span each, of the windows at ascending starts: together, of all."""
    span, _ = reach_of(width)
    first, second = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    for s, part in _segments(raw, width):
        a, b = np.searchsorted(starts, [s, s + SEGMENT])
        if a < b:
            names = triple_names(part, span)[1]
            first[a:b], second[a:b] = names[starts[a:b] - s], names[starts[a:b] - s + width - span]
    return first, second


def _symbols(raw: np.ndarray, offsets: np.ndarray, unit: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of ``unit`` bytes, offsets in symbols) of texts one after the other."""
    raw, offsets = raw[offsets[0] : offsets[-1]], offsets - offsets[0]
    if unit == 1:
        return raw, offsets
    wide = raw.reshape(-1, unit)
    symbols = wide[:, 0].astype(np.uint32)
    for i in range(1, unit):
        symbols |= wide[:, i].astype(np.uint32) << np.uint32(8 * i)
    return symbols, offsets // unit


def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One name of both, the key that rows are sorted by."""
    x = (first + second * _K[0]) * _K[1]
    return x ^ (x >> np.uint64(32))


def _spread(first: np.ndarray, second: np.ndarray, sure: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sort key, known to be repeated): equal rows of a batch but for one go under random keys."""
    order = np.lexsort((second, first))
    equal = np.zeros(len(order), bool)
    equal[1:] = (first[order][1:] == first[order][:-1]) & (second[order][1:] == second[order][:-1])
    again = np.zeros(len(order), bool)
    again[order] = equal
    sure = sure | again
    sure[order[:-1][equal[1:]]] = True
    spot = _mixed(first, second)
    row = np.flatnonzero(again).astype(np.uint64)
    spot[again] = (spot[again] ^ (row * _K[0] + _K[1])) * _K[2]
    return spot, sure


def _neighbours(batches: Iterator[pa.RecordBatch], payload: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted stream that are sure, or equal in ``first`` and, if there, ``second`` to the row before or after."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.concat_batches([held, batch])
        first = batch["first"].to_numpy()
        like = first[1:] == first[:-1]
        if "second" in batch.schema.names:
            second = batch["second"].to_numpy()
            like &= second[1:] == second[:-1]
        repeated = batch["sure"].to_numpy(zero_copy_only=False).astype(bool)
        repeated[1:] |= like
        repeated[:-1] |= like
        # the last row waits for what follows; if it is repeated already, it says so then
        held = batch.slice(batch.num_rows - 1)
        if repeated[-1]:
            held = held.set_column(held.schema.get_field_index("sure"), "sure", pa.array([True]))
        out = batch.slice(0, batch.num_rows - 1).filter(pa.array(repeated[:-1])).select(payload)
        if out.num_rows:
            yield out
    if held is not None and held["sure"][0].as_py():
        yield held.select(payload)


def _repeated(rows: DataFrame, payload: list[str]) -> DataFrame:
    """The rows (spot, first, second or none, sure, payload) whose names some other row has too; ``spot`` follows from the names."""
    schema = T.StructType([rows.schema[c] for c in payload])
    ordered = rows.repartition("spot").sortWithinPartitions("spot")
    return ordered.mapInArrow(lean(lambda batches: _neighbours(batches, payload)), schema)


def _packed(at: np.ndarray, lo: np.ndarray, hi: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Position in its text with the distances back to the first and last window start (each below STEP) in one long."""
    return ((at - start) << 16) | ((at - lo) << 8) | (at - hi)


def _unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last window start)."""
    at = packed >> 16
    return at - ((packed >> 8) & 255), at - (packed & 255)


def _sample(width: int, unit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for from_row in range(0, batch.num_rows, 2_000):
                part = batch.slice(from_row, 2_000)
                keys, row, copies = np.unique(part.column(0).to_numpy(), return_index=True, return_counts=True)
                raw, offsets = _symbols(*utf8(part.column(1).take(pa.array(row))), unit)
                at, lo, hi, name = sampled(raw, offsets, width)
                text = np.searchsorted(offsets, at, side="right") - 1
                spot, sure = _spread(name, np.zeros(len(at), np.uint64), copies[text] > 1)
                columns = [spot.view(np.int64), name.view(np.int64), sure, keys[text], _packed(at, lo, hi, offsets[text])]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["spot", "first", "sure", "key", "at"])

    return run


def _listed(part: pa.RecordBatch, unit: int) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """(symbols, offsets, listed values, text of each) of rows (key, text, list)."""
    raw, offsets = _symbols(*utf8(part.column(1)), unit)
    lists = part.column(2)
    text = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
    return raw, offsets, lists.flatten(), text


def _ends(width: int, unit: int):
    """Rows of the first and last windows of each text's listed positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for from_row in range(0, batch.num_rows, 1_000):
                part = batch.slice(from_row, 1_000)
                raw, offsets, listed, text = _listed(part, unit)
                packed = np.asarray(listed.to_numpy(zero_copy_only=False), np.int64)
                lo, hi = _unpack(packed)
                one = lo == hi
                start = np.concatenate([lo, hi[~one]])
                owner = np.concatenate([np.arange(len(lo)), np.flatnonzero(~one)])
                sides = np.concatenate([np.where(one, 2, 1), np.ones((~one).sum(), np.int64)])
                place = start + offsets[text[owner]]
                order = np.argsort(place, kind="stable")
                place, owner, sides = place[order], owner[order], sides[order]
                first, second = window_names(raw, place, width)
                spot, sure = _spread(first, second, np.zeros(len(place), bool))
                key = part.column(0).to_numpy()[text[owner]]
                columns = [spot.view(np.int64), first.view(np.int64), second.view(np.int64), sure, key, packed[owner], sides]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["spot", "first", "second", "sure", "key", "at", "sides"])

    return run


def _around(width: int, unit: int):
    """The listed positions (at, name, parts, wanted) with the step - 1 symbols on either side of their prefix.

    Of positions that only serve to be compared with, one of a kind in a batch is enough.
    """
    step = reach_of(width)[1]
    n, core = step - 1, width - step + 1
    # the symbols to the left from the prefix outwards, then those to the right
    sides = np.concatenate([n - 1 - np.arange(n), n + core + np.arange(n)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for from_row in range(0, batch.num_rows, 1_000):
                part = batch.slice(from_row, 1_000)
                raw, offsets, listed, text = _listed(part, unit)
                packed, name, parts, wanted = (listed.field(f).to_numpy(zero_copy_only=False) for f in ("at", "name", "parts", "wanted"))
                if not len(packed):
                    continue
                place = (packed >> 16) + offsets[text]
                padded = np.concatenate([np.zeros(n, raw.dtype), raw, np.zeros(n, raw.dtype)])
                wanted = wanted.astype(bool)
                # symbols of other texts don't matter: no window reaches them
                around = padded[place[:, None] + sides].view(np.uint8)
                kind = row_names(around) ^ name.view(np.uint64) * _K[0] ^ (packed & 0xFFFF).astype(np.uint64)
                _, once, inverse, count = np.unique(kind, return_index=True, return_inverse=True, return_counts=True)
                head = np.zeros(len(packed), bool)
                head[once] = True
                keep = np.flatnonzero(wanted | head)
                # where a kind occurs twice here, all its windows are repeated
                twice = (count[inverse] > 1)[keep]
                ends = np.arange(len(keep) + 1, dtype=np.int32) * np.int32(around.shape[1])
                near = pa.Array.from_buffers(pa.binary(), len(keep), [None, pa.py_buffer(ends), pa.py_buffer(around[keep].tobytes())])
                columns = [name[keep], parts[keep], part.column(0).to_numpy()[text[keep]], packed[keep], wanted[keep], twice]
                yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in columns], near], ["name", "parts", "key", "at", "wanted", "twice", "around"])

    return run


def row_names(rows: np.ndarray) -> np.ndarray:
    """A name of the bytes of each row."""
    wide = np.pad(rows, ((0, 0), (0, -rows.shape[1] % 8))).view(np.uint64)
    x = (wide + np.arange(1, wide.shape[1] + 1, dtype=np.uint64) * _K[2]) * _K[0]
    x ^= x >> np.uint64(29)
    x *= _K[1]
    x ^= x >> np.uint64(32)
    return x.sum(axis=1)


def prefix_names(context: np.ndarray) -> np.ndarray:
    """Names of the first 0, 1, .. symbols of each row."""
    out = np.zeros((len(context), context.shape[1] + 1), np.uint64)
    for i in range(context.shape[1]):
        x = (out[:, i] + context[:, i].astype(np.uint64) + np.uint64(1)) * _K[0]
        out[:, i + 1] = x ^ (x >> np.uint64(29))
    return out


def _compare(rows: pa.RecordBatch, unit: int) -> pa.RecordBatch:
    """Windows of positions of whole names: those wanted and repeated, and those that other tasks must see."""
    name, packed = rows["name"].to_numpy().view(np.uint64), rows["at"].to_numpy()
    around = np.frombuffer(b"".join(rows["around"].to_pylist()), np.uint8 if unit == 1 else np.uint32).reshape(len(name), -1)
    n = around.shape[1] // 2  # a step less one
    left, right = prefix_names(around[:, :n]), prefix_names(around[:, n:])
    back, least = (packed >> 8) & 255, packed & 255
    count = back - least + 1
    owner = np.repeat(np.arange(len(name)), count)
    delta = least[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    before, after = left[owner, delta], right[owner, n - delta]
    first = (name[owner] + before * _K[1]) * _K[2] ^ delta.astype(np.uint64)
    second = (after ^ (before >> np.uint64(7))) * _K[0] + name[owner]
    order = np.lexsort((second, first))
    like = (first[order][1:] == first[order][:-1]) & (second[order][1:] == second[order][:-1])
    again = rows["twice"].to_numpy(zero_copy_only=False).astype(bool)[owner]
    again[order[1:][like]] = True
    again[order[:-1][like]] = True
    wanted = rows["wanted"].to_numpy(zero_copy_only=False).astype(bool)[owner]
    many = rows["parts"].to_numpy()[owner] > 1
    # known ones are done; other tasks must see one row a window, which stands for itself only if it isn't done
    head = np.ones(len(owner), bool)
    head[order[1:]] = ~like
    done, shown = np.flatnonzero(wanted & again), np.flatnonzero(many & head)
    keep = np.concatenate([done, shown])
    start = (packed >> 16)[owner] - delta
    columns = [c[keep].view(np.int64) for c in (_mixed(first, second), first, second)]
    is_open = np.arange(len(keep)) >= len(done)
    columns += [~is_open, rows["key"].to_numpy()[owner][keep], start[keep], np.where(is_open, (wanted & ~again)[keep], True), is_open]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["spot", "first", "second", "sure", "key", "at", "wanted", "open"])


def _compared(batches: Iterator[pa.RecordBatch], unit: int) -> Iterator[pa.RecordBatch]:
    """``_compare`` over a stream of positions sorted by name and part."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.concat_batches([held, batch])
        name, piece = batch["name"].to_numpy(), batch["part"].to_numpy()
        new = np.flatnonzero((name[1:] != name[:-1]) | (piece[1:] != piece[:-1])) + 1
        end, at = int(new[-1]) if len(new) else 0, 0
        while at < end:  # whole names, some thousand positions at a time
            upto = int(new[min(np.searchsorted(new, at + 5_000), len(new) - 1)])
            yield _compare(batch.slice(at, upto - at), unit)
            at = upto
        held = batch.slice(end)
    if held is not None and held.num_rows:
        yield _compare(held, unit)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_RUNS_DDL = "array<struct<start: bigint, end: bigint>>"


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mask of the n bytes that lie in any of the intervals."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:-1]) > 0


def _cut(keep_text: bool, keep_spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8(batch.column(1))
            starts, ends = batch.column(2), batch.column(3)
            out: list[list] = [[], [], [], [], []]
            for i in range(batch.num_rows):
                body = raw[offsets[i] : offsets[i + 1]]
                gone = covered(len(body), np.array(starts[i].as_py(), np.int64), np.array(ends[i].as_py(), np.int64))
                kept = body[~gone].tobytes()
                edge = np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))
                out[0].append(int(gone.sum()))
                out[1].append(int((edge == 1).sum()))
                out[2].append(hashlib.sha256(kept).hexdigest())
                # bytes may be cut inside a character; what is left of it can't be read as text
                out[3].append(kept.decode("utf-8", "ignore") if keep_text else None)
                runs = zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)
                out[4].append([{"start": a, "end": b} for a, b in runs] if keep_spans else None)
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), _RUNS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(out, types, strict=True)]], ["key", "n_removed", "n_spans", "kept_sha256", "kept_text", "removed"]
            )

    return run


def _merged(shared: DataFrame, status: DataFrame, scratch: Scratch, width: int, unit: int) -> DataFrame:
    """(key, start, end) of the repeated windows of positions whose first and last ones aren't both repeated."""
    names = status.groupBy("name").agg(F.count("*").alias("n"), F.max(~F.col("whole")).alias("open")).where("open")
    names = scratch.save(names.select("name", F.ceil(F.col("n") / TOGETHER).cast("long").alias("parts")), "open")
    mates = status.join(names, "name").select("key", F.struct("at", "name", "parts", (~F.col("whole")).alias("wanted")).alias("one"))
    mates = mates.groupBy("key").agg(F.collect_list("one").alias("at"))
    rows = shared.drop("at").join(mates, "key").select("key", "text", "at")
    schema = "name long, parts long, key long, at long, wanted boolean, twice boolean, around binary"
    rows = rows.mapInArrow(lean(_around(width, unit)), schema).withColumn("part", F.pmod(F.xxhash64("key", "at"), F.col("parts")))
    rows = rows.repartition("name", "part").sortWithinPartitions("name", "part")
    schema = "spot long, first long, second long, sure boolean, key long, at long, wanted boolean, open boolean"
    compared = scratch.save(rows.mapInArrow(lean(lambda batches: _compared(batches, unit)), schema), "compared")
    done = compared.where("wanted and sure").select("key", "at")
    seen = _repeated(compared.where("open").drop("open"), ["key", "at", "wanted"]).where("wanted").select("key", "at")
    return done.unionByName(seen).select("key", F.col("at").alias("start"), (F.col("at") + width).alias("end"))


def _spans(texts: DataFrame, width: int, scratch: Scratch, unit: int = 1) -> tuple[DataFrame, DataFrame]:
    """(texts that share a prefix of a sampled suffix, once each; repeated strings of their symbols) of (key, text): (key, text, at), (key, start, end)."""
    long_texts = texts.where(F.octet_length("text") >= width * unit)
    rows = long_texts.mapInArrow(lean(_sample(width, unit)), "spot long, first long, sure boolean, key long, at long")
    alive = scratch.save(_repeated(rows, ["first", "key", "at"]).withColumnRenamed("first", "name"), "alive")
    scratch.drop()
    alive = scratch.save(alive.distinct(), "alive_once")
    scratch.drop("alive")
    listed = alive.groupBy("key").agg(F.collect_list("at").alias("at"))
    # most texts share nothing: they aren't shuffled
    sharing, _ = split(long_texts, "key", alive.select("key").distinct(), scratch, "alive_bits")
    shared = scratch.save(sharing.dropDuplicates(["key"]).join(listed, "key"), "texts")
    scratch.drop()

    ends = _repeated(shared.mapInArrow(lean(_ends(width, unit)), "spot long, first long, second long, sure boolean, key long, at long, sides long"), ["key", "at", "sides"])
    sides = ends.groupBy("key", "at").agg(F.sum("sides").alias("sides"))
    status = alive.join(sides, ["key", "at"], "left").select("name", "key", "at", (F.coalesce("sides", F.lit(0)) >= 2).alias("whole"))
    status = scratch.save(status, "status")
    scratch.drop("alive_once")
    single = _merged(shared, status, scratch, width, unit)
    lo = F.shiftright("at", 16) - F.shiftright("at", 8).bitwiseAND(255)
    hi = F.shiftright("at", 16) - F.col("at").bitwiseAND(255)
    runs = status.where("whole").select("key", lo.alias("start"), (hi + width).alias("end"))
    spans = scratch.save(single.unionByName(runs), "spans")
    scratch.drop("open", "compared", "status")
    return shared, spans


def dedup(
    docs: DataFrame,
    text: str = "text",
    width: int = WIDTH,
    keep_text: bool = False,
    keep_spans: bool = False,
    words: DataFrame | None = None,
) -> DataFrame:
    """Input columns but the text, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept_text and the runs of bytes removed.

    ``words`` is what ``passage_words`` found in ``docs``; its column follows the others then.
    """
    reach_of(width)
    scratch = Scratch(docs.sparkSession, "suffix")
    kept = others(docs, *ADDED, text)
    body = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.xxhash64(body).alias("key"), body.alias("text"))
    shared, spans = _spans(texts, width, scratch)

    grouped = spans.groupBy("key").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    cut = shared.drop("at").join(grouped, "key").select("key", "text", "starts", "ends")
    cut = scratch.save(cut.mapInArrow(lean(_cut(keep_text, keep_spans)), f"key long, n_removed long, n_spans long, kept_sha256 string, kept_text string, removed {_RUNS_DDL}"), "cut")
    scratch.drop("texts", "spans")
    copies = texts.where(F.octet_length("text") >= width).groupBy("key").agg((F.count("*") > 1).alias("copied")).where("copied")
    found = cut.join(copies, "key", "full")
    found = scratch.save(found if words is None else found.join(words, "key", "full"), "found")
    scratch.drop("cut")

    out_text = [F.col("text")] if keep_text else []
    rows = docs.select(F.struct(F.lit(0).alias("__"), *kept).alias("__row"), F.xxhash64(body).alias("key"), body.alias("text"))
    # texts with nothing found aren't shuffled; hashes follow the split, as both parts read all rows
    named, clear = (
        part.select("__row", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256"), *out_text)
        for part in split(rows, "key", found.select("key"), scratch, "found_bits")
    )
    n_gone = F.when(F.col("copied"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0)))
    n_spans = F.when(F.col("copied"), F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0)))
    rest = F.when(F.col("copied"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha256"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    result = named.join(found, "key", "left").unionByName(clear, allowMissingColumns=True).select(
        *[F.col("__row")[c].alias(c) for c in kept],
        "n_bytes",
        n_gone.cast("long").alias("n_removed"),
        n_spans.cast("long").alias("n_spans"),
        rest.alias("kept_sha256"),
        *([F.when(F.col("copied"), F.lit("")).otherwise(F.coalesce("kept_text", "text")).alias("kept_text")] if keep_text else []),
        *([F.when(F.col("copied"), whole).otherwise(F.coalesce("removed", F.array().cast(_RUNS_DDL))).alias("removed")] if keep_spans else []),
        *([F.coalesce("n_passage_words", F.lit(0)).cast("long").alias("n_passage_words")] if words is not None else []),
    )
    return result


_PIECE = re.compile(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def _without_words(at_text: int, at_runs: int):
    """Rows with the words of the runs cut out of the text together with the blanks after them."""

    def cut(text: str, runs: list[dict]) -> str:
        pieces = _PIECE.findall(text)
        kept = ~covered(len(pieces), np.array([r["start"] for r in runs], np.int64), np.array([r["end"] for r in runs], np.int64))
        lead = text[: len(text) - sum(map(len, pieces))]
        return lead + "".join(p for p, k in zip(pieces, kept, strict=True) if k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 1_000) for b in batches for at in range(0, b.num_rows, 1_000)):
            runs = batch.column(at_runs)
            texts = batch.column(at_text).to_pylist()
            for i in np.flatnonzero(runs.value_lengths().fill_null(0).to_numpy()).tolist():
                texts[i] = cut(texts[i], runs[i].as_py())
            columns = [pa.array(texts, pa.string()) if c == at_text else batch.column(c) for c in range(batch.num_columns) if c != at_runs]
            yield pa.RecordBatch.from_arrays(columns, [n for c, n in enumerate(batch.schema.names) if c != at_runs])

    return run


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (key, text): the key and the codes of the text's words, one after the other."""
    for batch in batches:
        raw, offsets = utf8(batch.column(1))
        for a, b in chunks(offsets, SEGMENT):
            hashed, n_words = word_hashes(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            digits = _CODES[(hashed & np.uint64(len(_CODES) - 1)).astype(np.int64)]
            ends = np.concatenate([[0], np.cumsum(n_words * CODE)]).astype(np.int64)
            codes = pa.Array.from_buffers(pa.large_string(), b - a, [None, pa.py_buffer(ends), pa.py_buffer(digits.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), codes.cast(pa.string())], ["text_key", "text"])


def _passages(docs: DataFrame, text: str, n_words: int, scratch: Scratch) -> DataFrame:
    """(text_key, n, runs) of the texts with a passage of ``n_words`` words or more that is found elsewhere too.

    The key is ``dedup``'s, a hash of the text; runs are of words, ordered, and may overlap. A text that is a copy as a whole
    has one run of all its ``n`` words.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    coded = docs.select(F.xxhash64(body).alias("text_key"), body.alias("text")).mapInArrow(lean(_coded), "text_key long, text string")
    codes = scratch.save(coded.where(F.octet_length("text") >= CODE * n_words).select("text_key", F.xxhash64("text").alias("key"), "text"), "codes")
    _, spans = _spans(codes.select("key", "text"), n_words, scratch, CODE)
    scratch.drop("texts")
    # as many rows as texts, without them
    keys = codes.select("text_key", "key", (F.octet_length("text") / CODE).cast("long").alias("n"))
    keys = keys.groupBy("text_key", "key", "n").agg(F.count("*").alias("rows"))
    copies = keys.groupBy("key").agg((F.sum("rows") > 1).alias("copied")).where("copied")
    runs = spans.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("runs"))
    found = scratch.save(runs.join(copies, "key", "full"), "runs")
    everything = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n").alias("end")))
    out = keys.join(found, "key").select("text_key", "n", F.when(F.col("copied"), everything).otherwise(F.col("runs")).alias("runs"))
    out = scratch.save(out, "passages")
    scratch.drop("codes", "spans", "runs")
    return out


def without_passages(docs: DataFrame, text: str = "text", n_words: int = 51) -> DataFrame:
    """The documents without passages of ``n_words`` words or more that are found elsewhere too, whatever blanks part the words.

    Texts are written as codes, three characters of a word's hash, and a code is one symbol, see ``_spans``. All copies go. Null texts
    stay null; a text that is a copy as a whole ends up empty.
    """
    scratch = Scratch(docs.sparkSession, "passages")
    columns = docs.columns
    found = _passages(docs, text, n_words, scratch).select("text_key", "runs")
    rows = docs.withColumn("text_key", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    named, clear = split(rows, "text_key", found.select("text_key"), scratch, "bits")
    cut = named.join(found, "text_key", "left").select(*columns, "runs")
    return clear.select(*columns).unionByName(cut.mapInArrow(lean(_without_words(columns.index(text), len(columns))), docs.schema))


def passage_words(docs: DataFrame, text: str = "text", n_words: int = 51) -> DataFrame:
    """(key, n_passage_words) of the texts with a passage of ``n_words`` words or more that is found elsewhere too: how many words lie in such.

    The key is ``dedup``'s, a hash of the text. These are the words that ``without_passages`` removes, all those of a text that is a copy of another.
    """
    found = _passages(docs, text, n_words, Scratch(docs.sparkSession, "passage-words"))
    # runs are in order of their starts: each adds what lies after the ends of those before it
    added = "(a, r) -> struct(a.n + greatest(0L, r.end - greatest(a.upto, r.start)) as n, greatest(a.upto, r.end) as upto)"
    n = F.expr(f"aggregate(runs, struct(0L as n, 0L as upto), {added}, a -> a.n)")
    return found.select(F.col("text_key").alias("key"), n.alias("n_passage_words"))
