"""Packing: cost-balanced sequences of bounded length.

Documents are tokenised in Arrow batches; each becomes its ids and a closing id 0. They are
scattered over groups of about ``group_tokens`` ids, whose number follows from the input's bytes,
and every group is packed by itself. In a group of t ids there are ceil(t / 1024) sequences. A
piece of n ids costs ``linear`` n + ``quadratic`` n². Runs of 1024 ids fill a sequence of their
own; the documents' ends follow in descending order of cost, each to the sequence of lowest cost
among those that can still hold it whole. Where none can, it is cut to fill the sequence with
most room, and what is left goes on. So all sequences of a group are full but the last ids short
of a multiple of 1024; those are padded.

Defined cases: a null or empty text has the closing id alone; repeated rows are packed each; a
null key is kept; an empty table gives no rows. Rows in a group are ordered by key, size and ids
before they are packed. Input columns other than key and text are not read.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringwise.llm.common import give_back, held, lean, let_go

CAPACITY = 1024
#: Fixed value: how the byte-level BPE splits texts before it merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NOT_LATIN = re.compile("[^\x00-\u024f]").search

class Encoder:
    """Ids of whole texts by a byte-level BPE given as a file of ``tokenizers``, two bytes an id.

    Texts of Latin characters go through ``tiktoken`` with the vocabulary read from that file,
    which gives the same ids in a third of the time, as tests hold; all others, for which the two
    libraries' tables of Unicode may differ, through ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        byte = {c: b for b, c in enumerate(_byte_characters())}
        # merges have ids in their order, so that an id is its token's rank
        ranks = {bytes(byte[c] for c in token): i for token, i in self.tokenizer.get_vocab().items() if token not in special}
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        out = [b""] * len(texts)
        other = []
        for i, text in enumerate(texts):
            if _NOT_LATIN(text):
                other.append(i)
            elif text:
                out[i] = self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint16).tobytes()
        found = self.tokenizer.encode_batch([texts[i] for i in other], add_special_tokens=False)
        for i, ids in zip(other, found, strict=True):
            out[i] = np.array(ids.ids, np.uint16).tobytes()
        return out


def _byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def encoder(path: str) -> Encoder:
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def tokenised(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids binary: unsigned 16-bit little-endian, closing 0 included, place)."""
    place = F.monotonically_increasing_id()
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), place.alias("place"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        enc = encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [e + b"\0\0" for e in enc.encode([t or "" for t in part.column(1).to_pylist()])]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), part.column(2)], ["doc_id", "ids", "place"])

    return rows.mapInArrow(lean(encode, holds=True), "doc_id long, ids binary, place long")


class Room:
    """Sequences by the room they have left: the cheapest one with at least some room, or the roomiest.

    A tree over the possible amounts of room holds the least cost below each node.
    """

    def __init__(self, n: int, capacity: int):
        self.size = 1 << (capacity).bit_length()
        self.heaps: list[list] = [[] for _ in range(self.size)]
        self.least: list = [(float("inf"), -1)] * (2 * self.size)
        self.heaps[capacity] = [(0.0, s) for s in range(n)]
        self._renew(capacity)

    def _renew(self, room: int) -> None:
        heap = self.heaps[room]
        at = room + self.size
        self.least[at] = heap[0] if heap else (float("inf"), -1)
        while at > 1:
            at >>= 1
            self.least[at] = min(self.least[2 * at], self.least[2 * at + 1])

    def _find(self, room: int) -> int:
        """Amount of room of the cheapest sequence with at least ``room``; -1 if there is none."""
        lo, hi, best, at = room + self.size, 2 * self.size, (float("inf"), -1), 0
        while lo < hi:
            if lo & 1:
                if self.least[lo] < best:
                    best, at = self.least[lo], lo
                lo += 1
            if hi & 1:
                hi -= 1
                if self.least[hi] < best:
                    best, at = self.least[hi], hi
            lo >>= 1
            hi >>= 1
        if not at:
            return -1
        while at < self.size:
            at = 2 * at if self.least[2 * at] == best else 2 * at + 1
        return at - self.size

    def _most(self) -> int:
        at = 1
        while at < self.size:
            at = 2 * at + 1 if self.least[2 * at + 1][1] >= 0 else 2 * at
        return at - self.size

    def take(self, length: int) -> tuple[int, float, int]:
        """(sequence, its cost, its room) to put a piece of this length in, or the start of one."""
        room = self._find(length)
        if room < 0:
            room = self._most()
        cost, sequence = heapq.heappop(self.heaps[room])
        self._renew(room)
        return sequence, cost, room

    def give(self, sequence: int, cost: float, room: int) -> None:
        if room:
            heapq.heappush(self.heaps[room], (cost, sequence))
            self._renew(room)


def assign(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of all pieces of documents of these lengths."""
    pieces, ends, sequence = [], [], 0
    for d, n in enumerate(lengths):
        for start in range(0, n - capacity + 1, capacity):
            pieces.append((d, start, capacity, sequence, 0))
            sequence += 1
        if n % capacity:
            ends.append((-(n % capacity), d, n - n % capacity))
    room = Room(-(-sum(-e[0] for e in ends) // capacity), capacity)
    heapq.heapify(ends)  # cost grows with length: the longest first
    while ends:
        minus, d, start = heapq.heappop(ends)
        s, cost, left = room.take(-minus)
        n = min(-minus, left)
        pieces.append((d, start, n, sequence + s, capacity - left))
        room.give(s, cost + linear * n + quadratic * n * n, left - n)
        if n < -minus:
            heapq.heappush(ends, (minus + n, d, start + n))
    return pieces


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    linear: float = 1.0,
    quadratic: float = 1.0 / 1024,
    group_tokens: int = 2_000_000,
    seed: int = 5,
) -> DataFrame:
    """Pieces: doc_id, start, length, sequence_id, offset, doc_tokens and ``ids`` (binary, unsigned 32-bit)."""
    # a byte is one id at most, and a document has one more
    total = docs.agg(F.sum(F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long") + 1)).first()[0] or 0
    groups = max(1, -(-total // (2 * group_tokens)))
    ids = tokenised(docs, tokenizer, key, text)
    ids = ids.withColumn("group", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "place"), F.lit(groups)))

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        let_go(False)  # the encoder, all texts are in ids here
        give_back()  # what the group before took
        rows = rows.assign(n=rows["ids"].map(len)).sort_values(["doc_id", "n", "ids"], kind="stable", na_position="last")
        bodies = [np.frombuffer(b, np.uint16) for b in rows["ids"]]
        keys, group = rows["doc_id"].to_numpy(), int(rows["group"].iloc[0])
        out = assign([len(b) for b in bodies], capacity, linear, quadratic)
        d, start, length, sequence, offset = (np.array(c, np.int64) for c in zip(*out, strict=True))
        return pd.DataFrame(
            {
                "doc_id": keys[d],
                "start": start,
                "length": length,
                "sequence_id": (group << 32) + sequence,
                "offset": offset,
                "doc_tokens": np.array([len(b) for b in bodies], np.int64)[d],
                "ids": [bodies[i][s : s + n].astype("<u4").tobytes() for i, s, n in zip(d, start, length, strict=True)],
            }
        ).astype({"doc_id": "Int64"})

    schema = "doc_id long, start long, length long, sequence_id long, offset long, doc_tokens long, ids binary"
    return ids.groupBy("group").applyInPandas(packed, schema)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the checksum of their ids in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
