"""Removal of repeated strings by induced sorting of suffixes.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts
somewhere else in the corpus. Two such strings are equal exactly if the
suffixes that start there share a prefix of LENGTH bytes, which in the sorted
order of suffixes shows in the common-prefix values of neighbours.

Induced sorting sorts a sample of the suffixes and infers the order of all the
others from it, a character at a time to the left, together with the common
prefixes: the suffix at i - 1 is placed by its first byte and the place of the
suffix at i, and its common prefix with its neighbour is one more than the
least value between the two places before. Here:

* The sample are the anchors: in each string of LENGTH bytes the place whose
  ``K``-byte substring has the least hash (the first of equal ones). Equal strings have their
  anchors at the same distance, so a string can only be repeated among those
  whose anchors have equal substrings: those make up a shard. About one place
  in 170 is an anchor; only anchors are shuffled, not suffixes.
* Anchors whose surroundings (all strings that they are the anchor of, laid
  over each other) are equal are repeated altogether; one of each is kept.
* The suffixes at what is left of a shard are sorted, and those that begin up to
  LENGTH - K bytes before are induced from them step by step. Shards are dealt
  out over partitions and sorted externally by Spark; a task holds one shard.
  A shard of more than ``UNIT`` different surroundings is not held at all: its
  strings are hashed one by one and counted by key.

Hashes are of 64 bits and compared among the strings of one shard and distance.

Defined results: null texts are empty; texts shorter than LENGTH bytes stay
whole; strings never cross rows; a repeat within one text counts, overlapping or
not; repeated rows (and ids) are different places, so equal long rows all go;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tspanel.llm.common import Scratch, lean, mix64, numbered, prefix_hash, slices, span_hash
from tspanel.llm.jaccard import _groups

LENGTH, K = 400, 64
#: String starts handled at a time, and the different surroundings a task holds of one shard.
PIECE, UNIT = 1 << 20, 20_000
FILTER_BITS = 1 << 26


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, anchor, first, last, key, surroundings) for the runs of string starts that share an anchor.

    Positions are within the slice. Long slices go a piece at a time; a run that reaches the end of a
    piece is left to the next one, which begins with it.
    """
    width, upto = length - k + 1, 0
    step = max(PIECE, 2 * width)
    while upto < len(data) - length + 1:
        at = upto
        part = data[at:at + step + length - 1]
        starts = len(part) - length + 1
        upto = at + starts
        run = prefix_hash(part)
        hashed = span_hash(run, np.arange(len(part) - k + 1), np.arange(k, len(part) + 1))
        bits = np.uint64(max(1, len(part).bit_length()))
        value = (hashed >> bits << bits) | np.arange(len(hashed), dtype=np.uint64)
        blocks = -(-len(value) // width)
        grid = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
        grid[:len(value)] = value
        grid = grid.reshape(blocks, width)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:starts], ahead[width - 1:width - 1 + starts])
        place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        text = np.searchsorted(offsets, np.arange(at, at + starts), side="right") - 1
        inside = np.arange(at, at + starts) + length <= offsets[text + 1]
        p = np.flatnonzero(inside)
        if not len(p):
            continue
        new = np.ones(len(p), bool)
        new[1:] = (place[p[1:]] != place[p[:-1]]) | (text[p[1:]] != text[p[:-1]])
        heads = np.flatnonzero(new)
        first, last = p[heads], p[np.append(heads[1:], len(p)) - 1]
        if upto < len(data) - length + 1 and last[-1] == starts - 1:
            # a run has no more than ``width`` starts, so others come before it or the next piece is further on
            upto = at + int(first[-1])
            heads, first, last = heads[:-1], first[:-1], last[:-1]
            if not len(heads):
                continue
        a = place[first]
        around = mix64(span_hash(run, first, last + length) + ((a - first) * 1024 + (last - first)).astype(np.uint64))
        yield text[first], a + at, first + at, last + at, hashed[a].view(np.int64), around.view(np.int64)


def _bit(row, a):
    """Bit of an anchor in the filter of fixed size (arrays)."""
    return (((row >> 33) * 7919 + (row & ((1 << 33) - 1))) * 104729 + a) % FILTER_BITS


def _bit_column():
    """The same as a column."""
    part = F.shiftright("row", 33) * 7919 + F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    return (part * 104729 + F.col("a")) % FILTER_BITS


def _anchor_rows(docs: DataFrame, length: int, k: int) -> DataFrame:
    def work(batches):
        for batch in batches:
            for rows, data, offsets in slices(batch):
                ids = rows.column(0).to_numpy()
                for text, a, first, last, key, around in anchors(data, offsets, length, k):
                    base = offsets[text]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[text], key, around, a - base, first - base, last - base)],
                                                     names=["row", "key", "around", "a", "first", "last"])

    return docs.mapInArrow(lean(work), "row long, key long, around long, a long, first long, last long")


def _contexts(docs: DataFrame, bits, length: int, k: int) -> DataFrame:
    """(key, row, a, bytes before the anchor in its strings, bytes from it on) of anchors that pass the filter."""

    def work(batches):
        table = bits.value
        for batch in batches:
            for rows, data, offsets in slices(batch):
                ids, raw = rows.column(0).to_numpy(), data.tobytes()
                for text, a, first, _, key, _ in anchors(data, offsets, length, k):
                    base, row = offsets[text], ids[text]
                    bit = _bit(row, a - base)
                    hit = np.flatnonzero((table[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
                    to = np.minimum(a + length, offsets[text + 1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key[hit]), pa.array(row[hit]), pa.array((a - base)[hit]),
                         pa.array([raw[x:y] for x, y in zip(first[hit].tolist(), a[hit].tolist(), strict=True)], pa.binary()),
                         pa.array([raw[x:y] for x, y in zip(a[hit].tolist(), to[hit].tolist(), strict=True)], pa.binary())],
                        names=["key", "row", "a", "left", "right"])

    return docs.mapInArrow(lean(work), "key long, row long, a long, left binary, right binary")


def _range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least of values[lo..hi] (both included), for each pair."""
    out = values[hi].copy()
    wide = np.flatnonzero(hi > lo)
    if not len(wide):
        return out
    span = hi[wide] - lo[wide] + 1
    table, size = values, 1
    while len(wide):
        now = (span >= size) & (span < 2 * size)
        at = wide[now]
        out[at] = np.minimum(table[lo[at]], table[hi[at] - size + 1])
        wide, span = wide[~now], span[~now]
        if len(wide):
            table = np.minimum(table[:-size], table[size:]) if len(table) > size else table
            size *= 2
    return out


def induce(group: np.ndarray, lefts: list[bytes], rights: list[bytes], near: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """(distance, members) of strings that begin ``distance`` bytes before their anchor and are repeated.

    Members have a shard (``group``), the bytes from their first string start to the anchor, and from the anchor
    on. ``near`` is the least distance of a member's own strings: nearer ones belong to other anchors.
    """
    size = np.fromiter(map(len, rights), np.int64, len(rights))
    far = np.fromiter(map(len, lefts), np.int64, len(lefts))
    order = np.array(sorted(range(len(group)), key=lambda i: (group[i], rights[i])), np.int64)
    # common prefixes of neighbours among the sorted anchors' suffixes
    common = np.zeros(len(order), np.int64)
    grid = np.frombuffer(b"".join(r.ljust(length, b"\0") for r in rights), np.uint8).reshape(len(rights), length)
    for i in range(1, len(order), 4096):
        x, y = order[i - 1:i + 4095], order[i:i + 4096]
        x = x[:len(y)]
        differ = grid[x] != grid[y]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
        common[i:i + 4096] = np.where(group[x] == group[y], np.minimum(same, np.minimum(size[x], size[y])), -1)
    if len(common):
        common[0] = -1
    before = np.zeros((len(lefts), int(far.max(initial=0))), np.uint8)
    for i, left in enumerate(lefts):
        if left:
            before[i, :len(left)] = np.frombuffer(left, np.uint8)[::-1]
    for distance in range(int(far.max(initial=0)) + 1):
        if distance:
            # place the suffixes one byte further left: by that byte, then as the suffixes after them stand
            active = np.flatnonzero(far[order] >= distance)
            who = order[active]
            byte = before[who, distance - 1]
            turn = np.lexsort((byte, group[who])) if len(who) else np.zeros(0, np.int64)
            at, who, byte = active[turn], who[turn], byte[turn]
            alike = np.zeros(len(who), bool)
            alike[1:] = (group[who[1:]] == group[who[:-1]]) & (byte[1:] == byte[:-1])
            fresh = np.where(np.append(False, group[who[1:]] == group[who[:-1]]) if len(who) else alike, 0, -1)
            j = np.flatnonzero(alike)
            fresh[j] = 1 + _range_min(common, at[j - 1] + 1, at[j])
            order, common = who, fresh
        if not len(order):
            return
        hit = common >= length
        hit[:-1] |= common[1:] >= length
        found = order[hit]
        found = found[near[found] <= distance]
        if len(found):
            yield distance, found


def _spans(row: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring string starts of a row as covered byte ranges."""
    if not len(row):
        return row, start, start
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > start[:-1] + 1)
    heads = np.flatnonzero(new)
    return row[heads], start[heads], start[np.append(heads[1:], len(row)) - 1] + length


def _induced(requests: DataFrame, contexts: DataFrame, length: int) -> DataFrame:
    """Covered ranges (row, begins, ends) found by induced sorting, shard by shard."""
    rows = requests.select("key", "row", "a", "first", "last", "ask", F.lit(None).cast("binary").alias("left"), F.lit(None).cast("binary").alias("right")) \
        .unionByName(contexts.select("key", "row", "a", F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last"), F.lit(None).cast("boolean").alias("ask"), "left", "right"))

    def work(batches):
        for table in _groups(batches, 1):
            key, row, a = (table.column(i).to_numpy() for i in range(3))
            # a request stands right before its context; contexts without one came through the filter by chance
            here = np.asarray(pc.is_null(table.column(6)))
            pair = np.flatnonzero(here[:-1] & ~here[1:] & (row[1:] == row[:-1]) & (a[1:] == a[:-1]) & (key[1:] == key[:-1]))
            if not len(pair):
                continue
            ask = table.column(5).take(pair).to_pylist()
            first, last = (table.column(i).take(pair).to_numpy() for i in (3, 4))
            lefts, rights = table.column(6).take(pair + 1).to_pylist(), table.column(7).take(pair + 1).to_pylist()
            asked = np.array(ask, bool)
            found = list(induce(np.unique(key[pair], return_inverse=True)[1], lefts, rights, a[pair] - last, length))
            member = np.concatenate([m for _, m in found]) if found else np.zeros(0, np.int64)
            start = np.concatenate([a[pair][m] - d for d, m in found]) if found else member
            keep = asked[member]
            out = _spans(row[pair][member[keep]], start[keep], length)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["row", "begins", "ends"])

    ordered = rows.repartition("key").sortWithinPartitions("key", "row", "a", F.col("left").isNotNull())
    return ordered.mapInArrow(lean(work), "row long, begins long, ends long")


def _counted(requests: DataFrame, contexts: DataFrame, length: int) -> DataFrame:
    """The same for shards too large to hold: every string of theirs as a row, counted by its hash."""

    def work(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                key, row, a, last, ask, left, right = (batch.column(c)[i].as_py() for c in range(7))
                run = prefix_hash(np.frombuffer(left + right, np.uint8))
                start = np.arange(last - (a - len(left)) + 1)
                h = span_hash(run, start, start + length).view(np.int64)
                n = len(start)
                yield pa.RecordBatch.from_arrays([pa.array([key] * n, pa.int64()), pa.array(len(left) - start), pa.array(h), pa.array([row] * n, pa.int64()),
                                                  pa.array(start + a - len(left)), pa.array([ask] * n, pa.bool_())], names=["key", "distance", "h", "row", "start", "ask"])

    found = contexts.join(requests.select("row", "a", "last", "ask"), ["row", "a"]).select("key", "row", "a", "last", "ask", "left", "right")
    strings = found.mapInArrow(lean(work), "key long, distance long, h long, row long, start long, ask boolean")
    twice = strings.groupBy("key", "distance", "h").agg(F.count("*").alias("n")).where("n > 1")
    return strings.where("ask").join(twice, ["key", "distance", "h"]).select("row", F.col("start").alias("begins"), (F.col("start") + length).alias("ends"))


def repeated_spans(docs: DataFrame, scratch: Scratch, length: int = LENGTH, k: int = K, unit: int = UNIT) -> DataFrame:
    """(row, begins, ends): byte ranges whose union are the bytes to remove; ``docs`` has row and text."""
    found = scratch.keep(_anchor_rows(docs, length, k), "anchors")
    keys = found.groupBy("key").agg(F.count("*").alias("n"), F.min("around").alias("lo"), F.max("around").alias("hi")).where("n > 1")
    # written first: a join of two plain tables can be split where a key is frequent
    keys = scratch.keep(keys.select("key", (F.col("lo") < F.col("hi")).alias("mixed")), "keys")
    shared = scratch.keep(found.join(keys, "key"), "shared")
    scratch.drop(found, keys)
    alike = shared.groupBy("key", "around").agg(F.count("*").alias("n"), F.first("mixed").alias("mixed"), F.min(F.struct("row", "a", "first", "last")).alias("one"))
    alike = scratch.keep(alike, "surroundings")
    whole = shared.join(alike.where("n > 1").select("key", "around"), ["key", "around"]).select("row", F.col("first").alias("begins"), (F.col("last") + length).alias("ends"))
    whole = scratch.keep(whole, "whole")
    scratch.drop(shared)
    asked = alike.where("mixed").select("key", "one.*", (F.col("n") == 1).alias("ask"))
    sizes = asked.groupBy("key").agg(F.count("*").alias("m"))
    requests = scratch.keep(asked.join(sizes, "key"), "requests")
    scratch.drop(alike)
    x = _bit_column() + 1
    pages = requests.groupBy(F.bitmap_bucket_number(x).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(x)).alias("bits"))
    bits = np.zeros((FILTER_BITS // 32768, 4096), np.uint8)
    for r in pages.toLocalIterator():
        bits[r["page"] - 1] = np.frombuffer(r["bits"], np.uint8)
    contexts = _contexts(docs, docs.sparkSession.sparkContext.broadcast(bits.ravel()), length, k)
    small, large, held = requests.where(F.col("m") <= unit), requests.where(F.col("m") > unit), [requests]
    if large.limit(1).count():
        contexts = scratch.keep(contexts, "contexts")
        held.append(contexts)
        part = _induced(small, contexts, length).unionByName(_counted(large, contexts, length))
    else:
        part = _induced(small, contexts, length)
    part = scratch.keep(part, "induced")
    scratch.drop(*held)
    return whole.unionByName(part)


def _apply(docs: DataFrame, spans: DataFrame, keep: list[str], digests: bool) -> DataFrame:
    """Rows of ``docs`` (row, text and the ``keep`` columns as k_...) without the bytes of their spans."""
    merged = spans.groupBy("row").agg(F.collect_list(F.struct("begins", "ends")).alias("spans"))
    frame = docs.join(merged, "row", "left").select(*[f"k_{c}" for c in keep], "text", "spans")
    at = len(keep)
    fields = [T.StructField(c, docs.schema[f"k_{c}"].dataType) for c in keep]
    added = [("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType())]
    added += [("kept_sha256", T.StringType())] if digests else [("text", T.StringType())]
    schema = T.StructType([*fields, *[T.StructField(c, t) for c, t in added]])

    def work(batches):
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, spans_ in zip(batch.column(at), batch.column(at + 1), strict=True):
                raw = (text.as_py() or "").encode()
                kept, end, n = [], 0, 0
                for s, e in sorted((x["begins"], x["ends"]) for x in (spans_.as_py() or [])):
                    if s > end or not n:
                        kept.append(raw[end:s])
                        n += 1
                    end = max(end, e)
                kept.append(raw[end:])
                left = b"".join(kept)
                for o, v in zip(out, (len(raw), len(raw) - len(left), n, hashlib.sha256(left).hexdigest() if digests else left.decode("utf-8", "ignore")), strict=True):
                    o.append(v)
            arrays = [pa.array(o, pa.int64()) for o in out[:3]] + [pa.array(out[3], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], *arrays], names=schema.names)

    return frame.mapInArrow(lean(work), schema)


def _run(docs: DataFrame, keep: list[str], digests: bool, length: int, k: int, unit: int) -> DataFrame:
    scratch = Scratch(docs.sparkSession, "suffix-dedup")
    rows = numbered(docs, scratch, text=F.col("text"), **{f"k_{c}": F.col(c) for c in keep})
    spans = repeated_spans(rows.select("row", "text"), scratch, length, k, unit)
    return _apply(rows, spans, keep, digests)


def removal_digests(docs: DataFrame, length: int = LENGTH, k: int = K, unit: int = UNIT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the digest of the bytes that stay."""
    return _run(docs, ["doc_id"], True, length, k, unit)


def remove_repeats(docs: DataFrame, carry: tuple[str, ...] = (), length: int = LENGTH, k: int = K, unit: int = UNIT) -> DataFrame:
    """doc_id, the ``carry`` columns, counts and the ``text`` that stays (parts of a cut character go)."""
    return _run(docs, ["doc_id", *carry], False, length, k, unit)
