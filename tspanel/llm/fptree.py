"""Ranked lexical search with document FP-trees.

Every item's terms are searched in all documents; the score adds up whole
numbers per term (frequency in the document against the document's length,
times the term's weight). The plan:

* Texts are cut into terms once; of each document only the terms that some item
  has are kept, with their frequencies (a restricted term vector). The number of
  documents, all terms and the documents a term stands in are counted over the
  whole corpus.
* Each task takes ``UNIT`` vectors at a time. For an item, the vectors that hold
  one of its terms are put into a trie, terms in descending document frequency,
  so that documents share the paths of frequent terms. A node holds the greatest
  frequency of its term and the least length measure ``m`` among the documents
  below it, which bounds its term's part of a score; the largest sum of such
  parts on any way further down bounds what a subtree can add.
* A depth-first walk takes the most promising child first and leaves out subtrees
  whose bound stays below the tenth best score so far (also of earlier units of
  the task). Documents that end at a node are scored exactly.
* Ten documents of each item and task are ranked for the whole table.

Items are worked on in blocks of about ``BLOCK_TERMS`` terms, which is all that
is sent to the tasks; documents are read once for each block.

Defined results: null texts have no term and are never found; equal scores go by
ascending document id, null ids last, rows of equal id as they come; items of equal or null
id are items of their own; items without a term find nothing; texts of any
length are cut into terms in pieces; empty tables give an empty result; further
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tspanel.llm.common import Scratch

UNIT = 16_384
BLOCK_TERMS = 200_000
#: Cells of one tree's table; longer items take fewer documents at a time.
CELLS = 1 << 22
PIECE = 1 << 20

_TERM = np.full(256, 0x20, np.uint8)
for _lo, _hi in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _TERM[_lo:_hi + 1] = np.arange(_lo, _hi + 1)
_TERM[0x41:0x5B] = np.arange(0x61, 0x7B)
_TERM = _TERM.tobytes()


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, a piece at a time; pieces end where no term does."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_TERM)
    at = 0
    while at < len(data):
        to = data.find(b" ", at + PIECE)
        to = len(data) if to < 0 else to
        yield data[at:to].split()
        at = to


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [Counter(t for piece in terms(x) for t in piece) for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("item_id"), pa.array([list(c) for c in found], pa.list_(pa.binary())),
                                          pa.array([list(c.values()) for c in found], pa.list_(pa.int64()))], ["item", "item_id", "terms", "times"])


def _restrict(vocabulary: dict[bytes, int]):
    """Documents to (doc_id, n, terms of the vocabulary, their frequencies)."""
    known = vocabulary.get

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ids, tfs = [], [], []
            for text in batch.column("text"):
                size, found = 0, Counter()
                for piece in terms(text.as_py()):
                    size += len(piece)
                    found.update(map(known, piece))
                found.pop(None, None)
                n.append(size)
                ids.append(list(found))
                tfs.append(list(found.values()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                                              pa.array(tfs, pa.list_(pa.int64()))], ["doc_id", "n", "ids", "tfs"])
    return work


class _Item:
    """An item's terms in descending document frequency, and the best documents so far."""

    def __init__(self, number: int, ids: list[int], times: list[int], df: np.ndarray, weight: np.ndarray):
        order = sorted(range(len(ids)), key=lambda i: (-df[ids[i]], ids[i]))
        self.number = number
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.weight = np.array([weight[ids[i]] * times[i] for i in order], np.int64)
        self.best: list[tuple[int, int, bool]] = []

    def floor(self, k: int) -> int:
        return -self.best[-1][0] if len(self.best) == k else 1


def _part(weight, tf, m):
    """A term's part of a score: grows with tf, falls with m."""
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class _Tree:
    """FP-tree of the documents of a unit that hold one of an item's terms.

    Documents are sorted so that those of a subtree stand next to each other: ``ranks`` and
    ``tfs`` hold a document a row (terms as ranks in the item's order), a level's nodes are arrays.
    """

    def __init__(self, item: _Item, doc: np.ndarray, rank: np.ndarray, tf: np.ndarray, m: np.ndarray):
        order = np.argsort(doc, kind="stable")
        doc, rank, tf = doc[order], rank[order], tf[order]
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        size = np.diff(np.r_[first, len(doc)])
        words = []
        for w in range(0, len(item.ids), 64):
            bit = np.where((rank >= w) & (rank < w + 64), np.uint64(1) << (63 - np.clip(rank - w, 0, 63)).astype(np.uint64), np.uint64(0))
            words.append(~np.bitwise_or.reduceat(bit, first))
        by = np.argsort(words[0], kind="stable") if len(words) == 1 else np.lexsort(words[::-1])
        deep = int(size.max())
        row = np.repeat(np.argsort(by), size)
        col = np.arange(len(doc)) - np.repeat(first, size)
        self.ranks = np.full((len(by), deep), len(item.ids), np.int32)
        self.tfs = np.zeros((len(by), deep), np.int64)
        self.ranks[row, col], self.tfs[row, col] = rank, tf
        self.docs = doc[first][by]
        self.size = size[by]
        self.m = m[self.docs]
        self.weight = item.weight
        self._levels(deep)

    def _levels(self, deep: int) -> None:
        same = np.zeros(len(self.docs), np.int64)
        if len(same) > 1:
            differs = self.ranks[1:] != self.ranks[:-1]
            same[1:] = np.where(differs.any(axis=1), differs.argmax(axis=1), deep)
        self.begin, self.end, self.part, self.parent, self.below = [], [], [], [], []
        before = np.zeros(len(same), np.int64)
        for d in range(deep):
            at = np.flatnonzero(self.size > d)
            fresh = same[at] <= d
            start = np.flatnonzero(fresh)
            tf, m = np.maximum.reduceat(self.tfs[at, d], start), np.minimum.reduceat(self.m[at], start)
            self.part.append(_part(self.weight[self.ranks[at[start], d]], tf, m))
            self.begin.append(at[start])
            self.end.append(at[np.r_[start[1:], len(at)] - 1] + 1)
            self.parent.append(before[at[start]])
            self.below.append(np.zeros(len(start), np.int64))
            before[at] = np.cumsum(fresh) - 1
        for d in range(deep - 1, 0, -1):
            up = self.parent[d]
            start = np.flatnonzero(np.r_[True, up[1:] != up[:-1]])
            self.below[d - 1][up[start]] = np.maximum.reduceat(self.part[d] + self.below[d], start)

    def search(self, item: _Item, ids: np.ndarray, null: np.ndarray, k: int) -> None:
        """Depth first; ``item.best`` holds (-score, doc_id, null id) of the k best."""
        stack: list[tuple[int, int, int, int]] = []       # bound, level, node, parts of the levels above

        def open_children(d: int, lo: int, hi: int, above: int) -> None:
            bound = above + self.part[d][lo:hi] + self.below[d][lo:hi]
            good = np.flatnonzero(bound >= item.floor(k))
            for i in good[np.argsort(bound[good], kind="stable")].tolist():
                stack.append((int(bound[i]), d, lo + i, above))

        open_children(0, 0, len(self.begin[0]), 0)
        while stack:
            bound, d, node, above = stack.pop()
            if bound < item.floor(k):
                continue
            begin, end = int(self.begin[d][node]), int(self.end[d][node])
            lo, hi = np.searchsorted(self.parent[d + 1], [node, node + 1]).tolist() if d + 1 < len(self.parent) else (0, 0)
            here = int(self.end[d + 1][hi - 1]) if lo < hi else begin
            if here < end:                                # a path's own documents stand behind those of longer paths
                parts = _part(self.weight[self.ranks[here:end, :d + 1]], self.tfs[here:end, :d + 1], self.m[here:end, None]).sum(axis=1)
                good = np.flatnonzero(parts >= item.floor(k))
                if len(good):
                    docs = self.docs[here:end][good]
                    best = np.lexsort((ids[docs], null[docs], -parts[good]))[:k]
                    found = [(-int(parts[good][i]), int(ids[docs[i]]), bool(null[docs[i]])) for i in best]
                    item.best = sorted(item.best + found, key=lambda x: (x[0], x[2], x[1]))[:k]
            if lo < hi:
                open_children(d + 1, lo, hi, above + int(self.part[d][node]))


def _search(items: list[tuple[int, list[int], list[int]]], df: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int, k: int, unit: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [_Item(number, ids, times, df, weight) for number, ids, times in items]
        held, rows = [], 0

        def unit_done():
            table = pa.Table.from_batches(held).combine_chunks()
            ids = table.column("doc_id").combine_chunks()
            null = np.asarray(ids.is_null())
            doc_id = ids.fill_null(0).to_numpy(zero_copy_only=False)
            lists, tfs = table.column("ids").combine_chunks(), table.column("tfs").combine_chunks()
            size = np.diff(lists.offsets.to_numpy())
            term, tf = lists.flatten().to_numpy(), tfs.flatten().to_numpy()
            m = 100 - 75 + (75 * table.column("n").to_numpy() * n_docs) // n_terms
            order = np.argsort(term, kind="stable")
            doc, tf = np.repeat(np.arange(len(size)), size)[order], tf[order]
            bounds = np.searchsorted(term[order], np.arange(len(df) + 1))
            for item in found:
                lo, hi = bounds[item.ids], bounds[item.ids + 1]
                step = max(1, CELLS // max(1, len(item.ids)))
                for a in range(0, len(size), step):       # long items: fewer documents a tree
                    if step < len(size):
                        lo = bounds[item.ids] + [int(np.searchsorted(doc[x:y], a)) for x, y in zip(bounds[item.ids], bounds[item.ids + 1], strict=True)]
                        hi = bounds[item.ids] + [int(np.searchsorted(doc[x:y], a + step)) for x, y in zip(bounds[item.ids], bounds[item.ids + 1], strict=True)]
                    spans = [(x, y) for x, y in zip(lo.tolist(), hi.tolist(), strict=True)]
                    if any(x < y for x, y in spans):
                        at = np.concatenate([np.arange(x, y) for x, y in spans])
                        rank = np.repeat(np.arange(len(spans)), [y - x for x, y in spans])
                        _Tree(item, doc[at], rank, tf[at], m).search(item, doc_id, null, k)

        for batch in batches:
            for at in range(0, batch.num_rows, unit):
                held.append(batch.slice(at, unit))
                rows += held[-1].num_rows
                if rows >= unit:
                    unit_done()
                    held, rows = [], 0
        if rows:
            unit_done()
        out = [(i.number, None if null else doc, -score) for i in found for score, doc, null in i.best]
        cols = list(zip(*out, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["item", "doc_id", "score"])
    return work


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, unit: int = UNIT, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents of each item, of those with a score above 0."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "fptree")
    numbered = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), "text")
    wanted = scratch.keep(numbered.mapInArrow(_item_terms, "item long, item_id long, terms array<binary>, times array<long>"), "items")
    total = wanted.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_terms))
    found, texts = None, docs.select("doc_id", "text")
    for block in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()      # about block_terms terms
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in rows for t in r["terms"]}))}
        vectors = scratch.keep(texts.mapInArrow(_restrict(vocabulary), "doc_id long, n long, ids array<int>, tfs array<long>"), "vectors")
        n_docs, n_terms = vectors.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(1))).first()
        df = np.zeros(len(vocabulary), np.int64)
        for r in vectors.select(F.explode("ids").alias("id")).groupBy("id").count().collect():  # one row a term of the block
            df[r["id"]] = r["count"]
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        plan = [(r["item"], [vocabulary[bytes(t)] for t in r["terms"]], list(r["times"])) for r in rows if r["terms"]]
        best = vectors.where(F.size("ids") > 0).mapInArrow(_search(plan, df, weight, n_docs, n_terms, k, unit), "item long, doc_id long, score long")
        found = best if found is None else found.unionByName(best)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(wanted.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
