"""Document fingerprints: threshold-scaled sketches.

A fingerprint holds every five-word shingle's 64-bit hash below the fixed fraction 1 / ``scale`` of
the hash range, so its size follows the text's, fingerprints merge by union, and containment
can be estimated between very unequal documents. A text none of whose shingles falls below
keeps its smallest hash, which a merge may drop as it lies above the fraction. A text of one to
four words is one shingle.

``compare`` sets each document against an edited copy of itself and against the next document in
descending order of keys. Documents are dealt once, by ranges of keys that hold about
``bucket_bytes`` each: the ranges come from a histogram of ``cells`` intervals of equal width, at
most 2^20 rows. The next document is the next row of the range, or the first of the next range.

Only DataFrame functions run. Defined cases: a null text is empty; a text without words has an
empty fingerprint, and two empty ones have likeness 1; null keys come last; rows of equal keys
are ordered by their texts' hashes, equal rows in any order; a single document is its own next; an
empty table gives no rows; other input columns are not read. All rows of one key share a task,
which spills.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ringwise.llm.common import Scratch, words

SHINGLE = 5
LOWEST = -(1 << 63)


def with_sketch(df: DataFrame, text: str, out: str, scale: int) -> DataFrame:
    """Adds the sorted array of the kept hashes. Steps are columns of their own so that none is evaluated twice."""
    limit = F.lit(LOWEST + (1 << 64) // scale - 1)
    step = df.withColumn("__words", F.transform(words(F.col(text)), lambda w: F.xxhash64(w)))
    count = F.size("__words")
    windows = F.transform(F.sequence(F.lit(0), count - SHINGLE), lambda i: F.xxhash64(*[F.get("__words", i + k) for k in range(SHINGLE)]))
    every = F.when(count >= SHINGLE, windows).when(count > 0, F.array(F.xxhash64("__words"))).otherwise(F.array().cast("array<bigint>"))
    step = step.withColumn("__all", every).withColumn("__low", F.array_distinct(F.filter("__all", lambda h: h <= limit)))
    none_low = (F.size("__low") == 0) & (F.size("__all") > 0)
    kept = F.when(none_low, F.array(F.array_min("__all"))).otherwise(F.sort_array("__low"))
    return step.withColumn(out, kept).drop("__words", "__all", "__low")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sketches, 1 for two empty ones."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / both)


def containment(a: Column, b: Column) -> Column:
    """Share of sketch a found in sketch b; 1 for an empty a."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def printed(sketch: Column) -> Column:
    return F.concat_ws(",", F.transform(sketch, lambda h: F.lower(F.hex(h))))


def fingerprint(docs: DataFrame, text: str = "text", scale: int = 4) -> DataFrame:
    """Input columns and ``fingerprint``, the sketch in hexadecimal."""
    return with_sketch(docs, text, "__sketch", scale).withColumn("fingerprint", printed(F.col("__sketch"))).drop("__sketch")


def _ranges(light: DataFrame, bucket_bytes: int) -> tuple[int, int]:
    """Lowest key and width of the cells."""
    lo, hi, total = light.agg(F.min("doc_id"), F.max("doc_id"), F.sum("bytes")).first()
    n_cells = int(min(1 << 20, max(64, 8 * (total or 0) // bucket_bytes)))
    lo, hi = (0, 0) if lo is None else (lo, hi)
    return lo, max(1, -(-(hi - lo + 1) // n_cells))


def compare(docs: DataFrame, key: str = "doc_id", text: str = "text", scale: int = 4, bucket_bytes: int = 8 << 20) -> DataFrame:
    """One row a document: see the module; with containment in the edited and in the next document."""
    scratch = Scratch(docs.sparkSession, "fingerprints")
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), body.alias("text")).withColumn("hash", F.xxhash64("text"))
    light = scratch.save(rows.select("doc_id", "hash", (F.octet_length("text").cast("long") + 64).alias("bytes")), "light")
    lo, width = _ranges(light, bucket_bytes)

    def cell(doc_id: Column) -> Column:
        # decimals, as a range of keys may be wider than a long; null keys lie below all others
        place = F.floor((doc_id.cast("decimal(20,0)") - F.lit(lo).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)"))
        return F.coalesce(place.cast("long"), F.lit(-1))

    upto = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        light.groupBy(cell(F.col("doc_id")).alias("cell"))
        .agg(F.sum("bytes").alias("bytes"), F.min(F.struct(F.bitwise_not("doc_id").alias("down"), "hash")).alias("first"))
        .withColumn("bucket", F.floor(F.coalesce(F.sum("bytes").over(upto), F.lit(0)) / bucket_bytes))
    )
    cells = scratch.save(cells, "cells")
    # the first document of the next lower bucket that has any; after the lowest, that of the highest
    firsts = cells.groupBy("bucket").agg(F.max_by("first", "cell").alias("first"))
    top_first = F.last("first").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    following = firsts.select("bucket", F.coalesce(F.lag("first").over(Window.orderBy("bucket")), top_first).alias("first"))
    following = scratch.save(following.select("bucket", F.bitwise_not("first.down").alias("to_id"), F.col("first.hash").alias("to_hash")), "following")
    same = F.col("doc_id").eqNullSafe(F.col("to_id")) & (F.col("hash") == F.col("to_hash"))
    # at most 2^20 rows, one a range
    heads = rows.join(F.broadcast(following), same).select("bucket", "text").dropDuplicates(["bucket"])
    heads = with_sketch(heads, "text", "sketch", scale)
    heads = scratch.save(heads.select("bucket", F.col("text").alias("head_text"), F.col("sketch").alias("head_sketch")), "heads")

    dealt = rows.withColumn("cell", cell(F.col("doc_id"))).join(F.broadcast(cells.select("cell", "bucket")), "cell").drop("cell")
    dealt = with_sketch(dealt.repartition("bucket"), "text", "sketch", scale)
    down = Window.partitionBy("bucket").orderBy(F.col("doc_id").desc_nulls_last(), "hash")
    paired = dealt.withColumn("__next", F.lead(F.struct("text", "sketch")).over(down)).join(heads, "bucket", "left")
    paired = paired.select(
        "doc_id",
        "text",
        "sketch",
        F.char_length("text").cast("long").alias("n_chars"),
        F.coalesce(F.col("__next.text"), F.col("head_text")).alias("next_text"),
        F.when(F.col("__next").isNotNull(), F.col("__next.sketch")).otherwise(F.col("head_sketch")).alias("next_sketch"),
    )
    moved = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - moved), F.substring("next_text", F.lit(1), moved)
    )
    paired = with_sketch(paired.withColumn("edited", edited), "edited", "edited_sketch", scale)
    return paired.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("sketch")).alias("fingerprint"),
        printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("contained_in_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("contained_in_next"),
    )
