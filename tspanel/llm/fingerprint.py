"""Threshold-scaled sketches of documents.

A fingerprint keeps every distinct hash of a text's word shingles that lies
below a fixed fraction of the hash range, however many those are. Sketches of
different sizes stay comparable: the union of two sketches is the sketch of the
union, and the part of A's hashes that B has estimates how much of A lies in B.
A text with no hash below the bound keeps its smallest one, so that short texts
have a fingerprint; ``merge`` drops such a hash again beside any below it.

Everything is DataFrame functions. The next document (descending id) comes from
a window inside id ranges; only the first row of each range crosses over.

Defined results: null and empty texts, and texts without a word, have the empty
fingerprint, of likeness 1 to an empty one and 0 to any other; fewer than five
words make one shingle; equal texts have equal fingerprints; rows of equal id
follow each other by text, null ids come after all others; the only row of a
table is its own next document; an empty table gives an empty result. Extra
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

K = 5
#: A hash is kept if it is below this part of the signed 64-bit range.
FRACTION = 1 / 4
LOW = -(1 << 63)


def words(text: Column) -> Column:
    """Lower-cased words of a text: runs without blanks and the controls 9 to 13."""
    return F.filter(F.split(F.lower(text), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def shingle_hashes(text: Column, k: int = K) -> Column:
    """The hashes of a text's k-word shingles (in order, with repeats)."""
    hashed = F.transform(words(text), lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        long = F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))
        return F.when(F.size(h) >= k, long).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))

    return F.get(F.transform(F.array(hashed), shingles), F.lit(0))


def sketch(text: Column, fraction: float = FRACTION, k: int = K) -> Column:
    """Sorted array of the kept hashes of a text."""
    bound = LOW + int(fraction * (1 << 64))

    def keep(h: Column) -> Column:
        low = F.array_sort(F.array_distinct(F.filter(h, lambda x: x < F.lit(bound))))
        return F.when((F.size(low) > 0) | (F.size(h) == 0), low).otherwise(F.array(F.array_min(h)))

    return F.get(F.transform(F.array(shingle_hashes(F.coalesce(text, F.lit("")), k)), keep), F.lit(0))


def render(kept: Column) -> Column:
    return F.array_join(F.transform(kept, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of two texts' shingles together, from their sketches."""
    bound = LOW + int(fraction * (1 << 64))
    both = F.array_sort(F.array_union(a, b))
    low = F.filter(both, lambda x: x < F.lit(bound))
    return F.when(F.size(low) > 0, low).otherwise(F.slice(both, 1, 1))


def containment(a: Column, b: Column) -> Column:
    """Which part of a's shingles b is estimated to have; 1 if a is empty."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity; two empty sketches are alike."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(shared / (F.size(a) + F.size(b) - shared))


def range_cuts(rows: DataFrame, key: str, rows_per_range: int = 2000, most: int = 10_000) -> list[int]:
    """Ascending values of ``key`` that part the rows into ranges of about equal size."""
    ranges = min(most, rows.count() // rows_per_range)
    if ranges < 2:
        return []
    parts = [i / ranges for i in range(1, ranges)]
    return sorted(set(rows.agg(F.percentile_approx(key, parts, 10 * ranges).alias("c")).first()["c"] or []))


def range_of(key: Column, cuts: list[int]) -> Column:
    """How many cuts are not above ``key`` counted from the largest, by halving: the largest keys are in
    range 0, null ones in the last."""
    if not cuts:
        return F.lit(0)
    table = F.array(*[F.lit(c).cast("bigint") for c in cuts])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= len(cuts)) & (F.get(table, at + step - 1) <= key), at + step).otherwise(at))
    return F.lit(len(cuts)) - F.when(key.isNull(), F.lit(0)).otherwise(below)


def with_next(docs: DataFrame, fraction: float = FRACTION, rows_per_range: int = 2000) -> DataFrame:
    """(doc_id, text, kept, next): each row with its sketch and, as struct ``next``, the text and sketch of
    the row that follows in descending id (after the last row: the first).

    Rows are dealt out by id ranges. Each range also gets a copy of the next range's first row, behind
    its own, so a window within the range finds every row's follower.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cuts = range_cuts(docs.select("doc_id"), "doc_id", rows_per_range)
    placed = rows.withColumn("range", range_of(F.col("doc_id"), cuts).cast("int"))
    # one id a range, at most 10,000 of them: their rows are looked up by a broadcast of the ids
    heads = placed.groupBy("range").agg(F.max("doc_id").alias("first_id"))
    before = F.lag("range").over(W.orderBy("range"))
    heads = heads.withColumn("goes_to", F.coalesce(before, F.max("range").over(W.partitionBy())))
    found = rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("first_id"))).groupBy("goes_to") \
        .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
    copies = found.select(F.lit(None).cast("bigint").alias("doc_id"), F.col("t.text").alias("text"), F.col("goes_to").cast("int").alias("range"), F.lit(True).alias("copy"))
    dealt = placed.withColumn("copy", F.lit(False)).unionByName(copies).repartition("range").withColumn("kept", sketch(F.col("text"), fraction))
    order = W.partitionBy("range").orderBy("copy", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")
    return dealt.withColumn("next", F.lead(F.struct("text", "kept")).over(order)).where("NOT copy").select("doc_id", "text", "kept", "next")


def fingerprint_edits(docs: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of texts and of their edited forms (the last half of the code points replaced by the
    first as many of the next document), with the likeness of both and that to the next document's."""
    rows = with_next(docs, fraction)
    n = F.length("text").cast("long")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), (n - half).cast("int")), F.substring(F.col("next.text"), F.lit(1), half))
    # a one-element array holds a value that later expressions use more than once
    both = F.get(F.transform(F.array(edited), lambda e: F.struct(F.sha2(e, 256).alias("sha"), sketch(e, fraction).alias("kept"))), F.lit(0))
    out = rows.withColumn("n_chars", n).withColumn("edit", both)
    return out.select("doc_id", "n_chars", F.col("edit.sha").alias("edited_sha256"), render(F.col("kept")).alias("fingerprint"),
                      render(F.col("edit.kept")).alias("edited_fingerprint"),
                      likeness(F.col("kept"), F.col("edit.kept")).alias("near_edited"),
                      likeness(F.col("kept"), F.col("next.kept")).alias("near_next"))
