"""Language ID by bit-sliced Bloom filters over byte n-grams.

The filter is one table of ``slots`` cells; cell c holds words of up to 64 bits, a bit for each language, so
the bits of one language over all cells are that language's own Bloom filter. An n-gram sets its
languages' bits in ``hashes`` cells; the AND of these cells gives all languages that contain it
at one look. A text's n-grams give one such mask each, the masks' bits are counted per language,
and the counts are corrected for false positives: with n n-grams of which a share f is expected
by chance (the language's share of cells set, to the power ``hashes``), h hits stand for
(h - n f) / (1 - f) true ones. The language with most of them wins; ties go to the first name.

Learning. Documents count once for an n-gram. From a sample of about ``sample_docs`` labelled
documents a language (a parameter; by a hash of the key) the document frequencies are counted in
Spark; a language contains the n-grams found in at least ``least`` of its documents whose rate is
at least ``share`` of their highest rate in any language, the ``most_grams`` most frequent ones.
Only these bounded lists reach the driver.

Defined cases: a null text, or one without a letter (Unicode category L), is ``und`` with score 0,
as is everything if nothing could be learned; a text none of whose n-grams is known gets the
first learned language with score 0; short texts are padded by spaces; 64 languages share a word, and
each further 64 take one more a cell (8 MB); null labels aren't learned from; repeated rows count each; an empty table gives
no rows; input columns named like those that the operator adds are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringwise.llm.common import chunks, lean, others, utf8

ADDED = ("lang_pred", "score")
GRAM = 5
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
#: Bytes of text that are worked on at once.
BLOCK = 1 << 18
#: ASCII letters in lower case; white space and digits as a space.
FOLD = np.array(
    [c + 32 if 65 <= c <= 90 else 32 if c <= 32 or 48 <= c <= 57 else c for c in range(256)], np.uint8
)


def grams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes of all n-grams, number of them in each text) of consecutive texts, each between two pairs of spaces."""
    lengths = np.diff(offsets)
    padded = np.full(len(raw) + 4 * len(lengths), 32, np.uint8)
    shift = 4 * np.repeat(np.arange(len(lengths)), lengths) + 2
    padded[np.arange(len(raw)) + shift] = FOLD[raw]
    code = np.zeros(len(padded) - GRAM + 1, np.uint64)
    for i in range(GRAM):
        code = (code << np.uint64(8)) | padded[i : len(padded) - GRAM + 1 + i]
    counts = np.maximum(lengths + 4 - GRAM + 1, 0)
    starts = np.cumsum(lengths + 4) - (lengths + 4)
    keep = np.zeros(len(code) + 1, np.int8)
    np.add.at(keep, starts[counts > 0], 1)
    np.add.at(keep, (starts + counts)[counts > 0], -1)
    return code[np.cumsum(keep[:-1]) > 0], counts


def cells(codes: np.ndarray, slots: int, hashes: int) -> Iterator[np.ndarray]:
    shift = np.uint64(64 - slots.bit_length() + 1)
    for m in MULTIPLIERS[:hashes]:
        yield ((codes ^ (codes >> np.uint64(17))) * np.uint64(m)) >> shift


@dataclass(frozen=True)
class Filters:
    names: list[str]
    table: np.ndarray
    false_rate: np.ndarray
    hashes: int

    @staticmethod
    def build(contained: dict[str, np.ndarray], slots: int, hashes: int) -> Filters:
        names = sorted(contained)
        kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if np.iinfo(k).bits >= min(64, len(names)))
        sliced = [np.zeros(slots, kind) for _ in range(0, len(names), 64)]  # a word a cell for each 64 languages
        for bit, name in enumerate(names):
            for at in cells(contained[name], slots, hashes):
                np.bitwise_or.at(sliced[bit // 64], at, kind(1 << bit % 64))
        filled = [float(((sliced[b // 64] >> kind(b % 64)) & kind(1)).mean()) for b in range(len(names))]
        table = sliced[0] if len(sliced) == 1 else np.stack(sliced).T  # cells x words, the cells of a word side by side
        return Filters(names, table, np.array(filled) ** hashes, hashes)

    def hits(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(texts x languages) corrected numbers of n-grams that a language contains, and of all n-grams."""
        codes, counts = grams(raw, offsets)
        places = list(cells(codes, len(self.table), self.hashes))
        edges = np.concatenate([[0], np.cumsum(counts)])
        out = np.zeros((len(counts), len(self.names)))
        for bit in range(len(self.names)):
            if bit % 64 == 0:
                words, mask = self.table if self.table.ndim == 1 else self.table[:, bit // 64], None
                for at in places:
                    mask = words[at] if mask is None else mask & words[at]
            ones = np.concatenate([[0], np.cumsum((mask >> mask.dtype.type(bit % 64)) & mask.dtype.type(1), dtype=np.int64)])
            raw_hits = ones[edges[1:]] - ones[edges[:-1]]
            out[:, bit] = (raw_hits - counts * self.false_rate[bit]) / (1 - self.false_rate[bit])
        return np.maximum(out, 0), counts


def learn(
    labelled: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "lang",
    sample_docs: int = 2_000,
    least: int = 3,
    share: float = 0.5,
    most_grams: int = 30_000,
    slots: int = 1 << 20,
    hashes: int = 3,
    seed: int = 11,
) -> Filters | None:
    """Filters of the labels' languages; None if there is nothing to learn from."""
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).alias("label")).where(
        "label is not null and text is not null"
    )
    n_docs = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).orderBy("label").collect()}
    if not n_docs:
        return None
    # a row a language
    figures = [(k, min(1.0, sample_docs / n), float(min(sample_docs, n))) for k, n in n_docs.items()]
    sizes = F.broadcast(labelled.sparkSession.createDataFrame(figures, "label string, part double, sampled double"))
    draw = F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.join(sizes, "label").where(draw < F.col("part")).select("label", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = np.array(batch.column(0).to_pylist(), object)
            raw, offsets = utf8(batch.column(1))
            for a, b in chunks(offsets, BLOCK):
                part = offsets[a : b + 1]
                codes, counts = grams(raw[part[0] : part[-1]], part - part[0])
                doc = np.repeat(np.arange(b - a, dtype=np.uint64), counts)
                order = np.lexsort((codes, doc))
                codes, doc = codes[order], doc[order]
                new = np.ones(len(codes), bool)
                new[1:] = (codes[1:] != codes[:-1]) | (doc[1:] != doc[:-1])
                owner = labels[a:b][doc[new].astype(np.int64)]
                for name in set(owner):
                    found, n = np.unique(codes[new][owner == name], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(found), pa.string()), pa.array(found.astype(np.int64)), pa.array(n)], ["label", "gram", "n"]
                    )

    counted = sample.mapInArrow(lean(count), "label string, gram long, n long").groupBy("label", "gram").agg(F.sum("n").alias("n"))
    rated = counted.join(sizes, "label").withColumn("rate", F.col("n") / F.col("sampled")).withColumn("top", F.max("rate").over(Window.partitionBy("gram")))
    chosen = rated.where((F.col("rate") >= F.col("top") * share) & (F.col("n") >= F.least(F.lit(least), F.col("sampled"))))
    order = Window.partitionBy("label").orderBy(F.desc("n"), "gram")
    chosen = chosen.withColumn("at", F.row_number().over(order)).where(F.col("at") <= most_grams).select("label", "gram")
    found = chosen.toArrow()  # at most most_grams rows a language
    names, codes = np.array(found["label"].to_pylist(), object), found["gram"].to_numpy().view(np.uint64)
    order = np.argsort(names, kind="stable")
    names, codes = names[order], codes[order]
    contained = {name: codes[np.searchsorted(names, name) : np.searchsorted(names, name, side="right")] for name in n_docs}
    return Filters.build(contained, slots, hashes)


def predict(docs: DataFrame, filters: Filters | None, text: str = "text") -> DataFrame:
    """Input columns, ``lang_pred`` and ``score``: the winner's share of all corrected hits."""
    kept = others(docs, *ADDED)
    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    if filters is None:
        return docs.select(*kept, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # slots cells of at most 8 bytes for each 64 languages

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f: Filters = shared.value
        names = np.array([*f.names, "und"], object)
        for batch in batches:
            raw, offsets = utf8(batch.column(batch.num_columns - 2))
            best, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for a, b in chunks(offsets, BLOCK):
                part = offsets[a : b + 1]
                hits = f.hits(raw[part[0] : part[-1]], part - part[0])[0]
                best[a:b], total = hits.argmax(axis=1), hits.sum(axis=1)
                score[a:b] = np.where(total > 0, hits[np.arange(len(hits)), best[a:b]] / np.maximum(total, 1e-12), 0.0)
            known = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            columns = [batch.column(i) for i in range(batch.num_columns - 2)]
            columns += [pa.array(names[np.where(known, best, len(f.names))], pa.string()), pa.array(np.where(known, score, 0.0))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *ADDED])

    fields = [docs.schema[c] for c in kept] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    rows = docs.select(*kept, F.col(text).alias("__text"), lettered.alias("__lettered"))
    return rows.mapInArrow(lean(label), T.StructType([T.StructField(f.name, f.dataType, True) for f in fields]))


def held_out(key: Column) -> Column:
    """The contract's fold: documents that are never learned from."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Learns on the documents outside the fold, predicts all: (input columns, lang_pred, score)."""
    return predict(docs, learn(docs.where(~held_out(F.col("doc_id")))))
