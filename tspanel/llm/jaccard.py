"""N-gram Jaccard join with a count-vector R-tree.

A document is the set of its distinct word shingles; two link when their sets'
Jaccard similarity reaches the threshold. The shingles are hashed into
``GROUPS`` groups, and a set's numbers of shingles in the groups are a point.
Two sets share at most the sum of the smaller coordinates of their points, and
an R-tree over points (its nodes hold the largest coordinates and the range of
sizes below them) finds the points where that sum reaches what a link takes.
Surviving pairs are verified on the sets themselves.

An R-tree over the whole corpus would compare most points with most others, as
random texts of a size lie close together in so many dimensions. So trees are
built only over sets that can link at all: sets that link share one of their
first n - ceil(0.75 n) + 1 shingles in any common order (a pigeonhole, nothing
is lost), and each such shingle has a tree. The order puts frequent shingles
last, by a table of fixed size of how often hashes occur in the whole corpus.

Equal sets are one class throughout. Links are looked for in rounds: first every
set is held against one of its group, then against the nearest (by the bound) of
the group's largest component, and at last all pairs of different components
that the R-tree lets pass are verified, so that no link between components is
missed and those within one need not be listed. A group larger than ``UNIT`` is
cut into blocks, and pairs of blocks are worked on apart.

Defined results: null and empty texts and texts without a word have an empty set
and link with nothing; fewer than five words make one shingle; rows of equal text
link (but for empty sets), also when ids repeat; a null id never names a component
unless all of its rows have none; an empty table gives an empty result; columns
other than those asked for are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tspanel.llm.common import Scratch, lean, numbered, shingle_sets, slices
from tspanel.llm.components import connected_components

#: Bytes of texts handed to numpy at a time: hashing takes some forty times as many.
SLICE = 1 << 18
#: Counters of the table of frequencies, and counters of a row of it in transit.
COUNTERS, PAGE = 1 << 20, 1 << 12
#: Coordinates of a point, and points that one tree holds.
GROUPS, UNIT, FANOUT = 256, 4096, 16
#: Tokens of a class by which pairs already listed under an earlier token are known.
LEAD = 32
#: The largest coordinate that is told apart.
TOP = 255
#: Bits of the filter that tells which sets the second pass has to hand on.
FILTER_BITS = 1 << 26
PERCENT = 75


def needed(n1, n2):
    """The least overlap with which sets of these sizes link."""
    return (PERCENT * (n1 + n2) + 99 + PERCENT) // (100 + PERCENT)


def point(hashes: np.ndarray) -> np.ndarray:
    return np.minimum(np.bincount((hashes & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS), TOP).astype(np.uint8)


class CountTree:
    """R-tree over points: levels from the points up, each of ``FANOUT`` times fewer boxes."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((points[:, 1], points[:, 0], sizes))
        top, low, high = points[self.order], sizes[self.order], sizes[self.order]
        self.levels = [(top, low, high)]
        while len(top) > 1:
            heads = np.arange(0, len(top), FANOUT)
            top, low, high = np.maximum.reduceat(top, heads), np.minimum.reduceat(low, heads), np.maximum.reduceat(high, heads)
            self.levels.append((top, low, high))

    def search(self, queries: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, point, bound) wherever the bound on the overlap reaches what a link takes."""
        who = np.arange(len(queries))
        box = np.zeros(len(queries), np.int64)
        bound = np.zeros(len(queries), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            top, low, high = self.levels[depth]
            near = (PERCENT * sizes[who] <= 100 * high[box]) & (PERCENT * low[box] <= 100 * sizes[who])
            who, box = who[near], box[near]
            bound = np.concatenate([_shared(queries[who[i:i + 8192]], top[box[i:i + 8192]]) for i in range(0, len(who), 8192)] or [np.zeros(0, np.int64)])
            least = needed(sizes[who], np.maximum(low[box], (PERCENT * sizes[who] + 99) // 100))
            ok = bound >= least
            who, box, bound = who[ok], box[ok], bound[ok]
            if depth:
                below = len(self.levels[depth - 1][0])
                child = (box[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                who, child = np.repeat(who, FANOUT)[child < below], child[child < below]
                box = child
        return who, self.order[box], bound


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bound on the overlap of sets from their points; a coordinate at the top of its range bounds nothing."""
    least = np.minimum(a, b)
    sums = least.sum(axis=1, dtype=np.int64)
    sums[(least == TOP).any(axis=1)] = np.iinfo(np.int64).max
    return sums


def _frequencies(texts: DataFrame, k: int):
    """How often hashes occur in the corpus's sets, by their leading bits: a table of ``COUNTERS`` numbers."""

    def count(batches):
        sums = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for _, data, offsets in slices(batch, limit=SLICE):
                sets = shingle_sets(data, offsets, k)
                sums += np.bincount((np.concatenate(sets) >> np.uint64(44)).astype(np.int64), minlength=COUNTERS)
        pages = sums.reshape(-1, PAGE)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(pages)), pa.int32()), pa.array([zlib.compress(p.tobytes(), 1) for p in pages], pa.binary())], names=["page", "counts"])

    def add(batches):
        page, total = None, None
        for batch in batches:
            for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if p != page:
                    if page is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([page], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["page", "counts"])
                    page, total = p, np.zeros(PAGE, np.int64)
                total += np.frombuffer(zlib.decompress(c), np.int64)
        if page is not None:
            yield pa.RecordBatch.from_arrays([pa.array([page], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["page", "counts"])

    schema = "page int, counts binary"
    pages = texts.mapInArrow(lean(count), schema).repartition("page").sortWithinPartitions("page").mapInArrow(lean(add), schema)
    table = np.zeros((COUNTERS // PAGE, PAGE), np.int64)
    for row in pages.collect():            # of fixed size; an iterator would run a job for each partition
        table[row["page"]] = np.frombuffer(row["counts"], np.int64)
    # only the order matters: ranks of 4 bytes
    return np.unique(table.ravel(), return_inverse=True)[1].astype(np.uint32)


def _ids(sets: list[np.ndarray], rows: list[int]) -> tuple[list[bytes | None], list[int]]:
    """Of each set: a 128-bit name (None if empty), and a hash that is of this set in this row."""
    names = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
    return names, [xxhash.xxh3_64_intdigest((x or b"") + r.to_bytes(8, "little")) & (FILTER_BITS - 1) for x, r in zip(names, rows, strict=True)]


def _named(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, row, set name, n) of every row."""

    def work(batches):
        for batch in batches:
            for rows, data, offsets in slices(batch, limit=SLICE):
                sets = shingle_sets(data, offsets, k)
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                                                  pa.array([len(s) for s in sets], pa.int64())], names=["doc_id", "row", "name", "n"])

    return docs.mapInArrow(lean(work), "doc_id long, row long, name binary, n long")


def _classes(docs: DataFrame, k: int, ranks) -> DataFrame:
    """One row a distinct set: name, n, its point, its first shingles in the common order, and the filter's bit of the first row that has it."""

    def work(batches):
        rank = ranks.value
        for batch in batches:
            for rows, data, offsets in slices(batch, limit=SLICE):
                sets = shingle_sets(data, offsets, k)
                names, bits = _ids(sets, rows.column(1).to_pylist())
                first = []
                for s in sets:
                    size = len(s) - (PERCENT * len(s) + 99) // 100 + 1 if len(s) else 0
                    first.append(s[np.lexsort((s, rank[(s >> np.uint64(44)).astype(np.int64)]))[:size]].view(np.int64))
                out = pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), rows.column(1), pa.array(bits, pa.int64()),
                     pa.array(first, pa.list_(pa.int64())), pa.array([point(s).tobytes() for s in sets], pa.binary())], names=["name", "n", "row", "bit", "first", "point"])
                yield out.filter(pc.is_valid(out.column(0)))

    found = docs.select("row", F.col("row").alias("row2"), "text").mapInArrow(lean(work), "name binary, n long, row long, bit long, first array<long>, point binary")
    one = found.groupBy("name").agg(F.min(F.struct("row", "bit")).alias("r"), F.first("n").alias("n"), F.first("first").alias("first"), F.first("point").alias("point"))
    return one.select(F.monotonically_increasing_id().alias("cid"), "name", "n", "r.bit", "first", "point")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Batches of rows sorted by the first ``keys`` columns, cut only between groups of equal keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:keys]]
        new = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in key])) + 1 if batch.num_rows > 1 else np.zeros(0, np.int64)
        if held:
            last = [c[-1].as_py() for c in held[-1].columns[:keys]]
            if any(a != b[0] for a, b in zip(last, key, strict=True)):
                yield pa.Table.from_batches(held)
                held = []
        if len(new):
            at = int(new[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, at)])
            held, batch = [], batch.slice(at)
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _shared_first(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(token, cid, n, pos, before) of first shingles that classes of sizes near enough have in common; of shingles
    that exactly the same classes have, one, with the least place of them all. ``before``: the class's tokens at
    lesser places, of its ``LEAD`` first ones."""

    def keep(batches):
        # by size, a class has a partner if the one before or after it is near enough; the last row waits for the next batch
        last, met = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = batch if last is None else pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            token, n = whole.column(0).to_numpy(), whole.column(2).to_numpy()
            near = (token[1:] == token[:-1]) & (PERCENT * n[1:] <= 100 * n[:-1])
            ok = np.zeros(len(token), bool)
            ok[0] = met
            ok[1:] |= near
            ok[:-1] |= near
            yield whole.slice(0, len(ok) - 1).filter(pa.array(ok[:-1]))
            last, met = whole.slice(len(ok) - 1), bool(ok[-1])
        if met:
            yield last

    rows = classes.select(F.posexplode("first").alias("pos", "token"), "cid", "n").select("token", "cid", "n", "pos")
    shared = scratch.keep(rows.repartition("token").sortWithinPartitions("token", "n").mapInArrow(lean(keep), "token long, cid long, n long, pos int"), "shared")
    alike = shared.groupBy("token").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("cid")).alias("x"), F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("y"))
    named = shared.join(alike, "token").groupBy("m", "x", "y", "cid", "n").agg(F.min("token").alias("token"), F.min("pos").alias("pos"))
    one = scratch.keep(named.select("token", "cid", "n", "pos"), "one")
    lead = one.groupBy("cid").agg(F.slice(F.array_sort(F.collect_list(F.struct("pos", "token"))), 1, LEAD).alias("lead"))
    before = F.transform(F.filter("lead", lambda e: e["pos"] < F.col("pos")), lambda e: e["token"])
    out = scratch.keep(one.join(lead, "cid").select("token", "cid", "n", "pos", before.alias("before")), "groups")
    scratch.drop(shared, one)
    return out


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(cid, hashes) of the ``wanted`` classes, from another pass over the texts.

    A filter of fixed size tells the tasks which rows to hand on; what it lets through by chance ends at the join.
    """
    named = classes.join(wanted, "cid", "left_semi").select("cid", "name", "bit")
    x = F.col("bit") + 1
    pages = named.groupBy(F.bitmap_bucket_number(x).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(x)).alias("bits"))
    bits = np.zeros((FILTER_BITS // 32768, 4096), np.uint8)
    for row in pages.collect():            # of fixed size, as above
        bits[row["page"] - 1] = np.frombuffer(row["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits.ravel())

    def work(batches):
        table = shared.value
        for batch in batches:
            for rows, data, offsets in slices(batch, limit=SLICE):
                sets = shingle_sets(data, offsets, k)
                names, bit = _ids(sets, rows.column(1).to_pylist())
                at = np.array(bit, np.int64)
                hit = np.flatnonzero((table[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
                hit = [i for i in hit.tolist() if names[i] is not None]
                yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in hit], pa.binary()), pa.array([sets[i].tobytes() for i in hit], pa.binary())], names=["name", "hashes"])

    found = docs.select("row", F.col("row").alias("row2"), "text").mapInArrow(lean(work), "name binary, hashes binary")
    return found.join(named.select("name", "cid"), "name").groupBy("name").agg(F.first("cid").alias("cid"), F.first("hashes").alias("hashes")).drop("name")


def _units(cands: DataFrame, labels: DataFrame, points: DataFrame) -> DataFrame:
    """Rows of groups that still have more than one component, with their points, in units of bounded size."""
    rows = cands.join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn("comp", F.coalesce("component", "cid")).drop("component")
    open_ = rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m")).where("lo < hi")
    rows = rows.join(open_.select("token", F.ceil(F.col("m") / UNIT).alias("b")), "token")
    mine = F.pmod(F.xxhash64("cid"), F.col("b"))
    rows = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("b") - 1)))
    rows = rows.select("token", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "cid", "n", "comp", "pos", "before")
    rows = rows.join(points, "cid").select("token", "i", "j", "comp", "cid", "n", "point", "pos", "before")
    return rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "comp", "cid")


def _pairs(units: DataFrame, mode: str) -> DataFrame:
    """Candidate pairs of different components: ``star``, ``nearest`` or ``all`` (see the module's text)."""

    def work(batches):
        for table in _groups(batches, 3):
            token, i, j, comp, cid, n = (table.column(c).to_numpy() for c in range(6))
            pos = table.column(7).to_numpy()
            points = np.frombuffer(b"".join(table.column(6).to_pylist()), np.uint8).reshape(-1, GROUPS)
            new = np.concatenate([[True], (token[1:] != token[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
            heads = np.flatnonzero(new)
            if mode == "star":
                center = np.repeat(heads, np.diff(np.append(heads, len(new))))
                who = np.flatnonzero(comp != comp[center])
                bound = np.concatenate([_shared(points[who[a:a + 8192]], points[center[who[a:a + 8192]]]) for a in range(0, len(who), 8192)] or [np.zeros(0, np.int64)])
                ok = bound >= needed(n[who], n[center[who]])
                found = [(who[ok], center[who[ok]], bound[ok])]
            else:
                found = [_unit_pairs(a, b, comp, n, points, mode) for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(new)], strict=True)]
            x, y, bound = (np.concatenate([f[k] for f in found]) for k in range(3))
            if mode == "all":
                # what stands behind the first common shingle bounds the overlap; pairs met at an earlier one are listed there
                ok = np.minimum(n[x] - pos[x], n[y] - pos[y]) >= needed(n[x], n[y])
                x, y, bound = x[ok], y[ok], bound[ok]
                ok = ~_met_before(table.column(8).combine_chunks(), x, y)
                x, y, bound = x[ok], y[ok], bound[ok]
            least = bound / np.maximum(1, n[x] + n[y] - bound)
            a, b = (cid[x], cid[y]) if mode != "all" else (np.minimum(cid[x], cid[y]), np.maximum(cid[x], cid[y]))
            out = np.unique(np.rec.fromarrays([a, b, least], names="x,y,bound"))
            yield pa.RecordBatch.from_arrays([pa.array(out["x"]), pa.array(out["y"]), pa.array(out["bound"])], names=["x", "y", "bound"])

    pairs = units.mapInArrow(lean(work), "x long, y long, bound double")
    if mode == "all":
        return pairs.groupBy("x", "y").agg(F.max("bound").alias("bound")).select("x", "y")
    return pairs.groupBy("x").agg(F.max_by("y", F.struct("bound", "y")).alias("y"))


def _met_before(before: pa.ListArray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the rows x and y have an earlier token in common."""
    offsets, tokens = before.offsets.to_numpy(), before.flatten().to_numpy()
    table, size = np.zeros((len(before), LEAD), np.int64), np.diff(offsets)
    row = np.repeat(np.arange(len(before)), size)
    table[row, np.arange(len(tokens)) - np.repeat(offsets[:-1] - offsets[0], size)] = tokens
    met = np.zeros(len(x), bool)
    for at in range(0, len(x), 2048):
        a, b = x[at:at + 2048], y[at:at + 2048]
        real = (np.arange(LEAD) < size[a][:, None])[:, :, None] & (np.arange(LEAD) < size[b][:, None])[:, None, :]
        met[at:at + 2048] = ((table[a][:, :, None] == table[b][:, None, :]) & real).any(axis=(1, 2))
    return met


def _unit_pairs(a: int, b: int, comp, n, points, mode):
    """Pairs within the rows a..b (one unit, sorted by component)."""
    rows = np.arange(a, b)
    names, size = np.unique(comp[a:b], return_counts=True)
    if len(names) < 2:
        return (np.zeros(0, np.int64),) * 3
    if mode == "nearest":
        main = rows[comp[a:b] == names[np.argmax(size)]]
        rest = rows[comp[a:b] != names[np.argmax(size)]]
        who, at, bound = CountTree(points[main], n[main]).search(points[rest], n[rest])
        order = np.lexsort((at, -bound / np.maximum(1, n[rest[who]] + n[main[at]] - bound), who))
        first = order[np.concatenate([[True], who[order][1:] != who[order][:-1]])] if len(order) else order
        return rest[who[first]], main[at[first]], bound[first]
    who, at, bound = CountTree(points[rows], n[rows]).search(points[rows], n[rows])
    ok = (comp[rows[who]] != comp[rows[at]]) & (who < at)
    return rows[who[ok]], rows[at[ok]], bound[ok]


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link."""

    def work(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(s, t, assume_unique=True))
                ok.append(100 * shared >= PERCENT * (len(s) + len(t) - shared))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    own = sets.select("cid", "hashes")
    both = pairs.join(own.select(F.col("cid").alias("y"), F.col("hashes").alias("hy")), "y") \
        .join(own.select(F.col("cid").alias("x"), F.col("hashes").alias("hx")), "x").select("x", "y", "hx", "hy")
    return both.mapInArrow(lean(work), "a long, b long")


def link_sets(docs: DataFrame, scratch: Scratch, k: int) -> tuple[DataFrame, DataFrame]:
    """(classes, labels): the distinct sets, and the component of each class that links with another."""
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(_frequencies(docs.select("text"), k))
    full = scratch.keep(_classes(docs, k, ranks), "classes")
    cands = _shared_first(full, scratch)
    classes = scratch.keep(full.drop("first"), "names")
    scratch.drop(full)
    points = classes.select("cid", "point")
    sets, held = None, [cands]
    labels = spark.createDataFrame([], "node long, component long")
    for mode in ("star", "nearest", "all"):
        pairs = scratch.keep(_pairs(_units(cands, labels, points), mode), "pairs")
        wanted = pairs.select(F.col("x").alias("cid")).union(pairs.select("y")).distinct()
        wanted = scratch.keep(wanted if sets is None else wanted.join(sets.select("cid"), "cid", "left_anti"), "wanted")
        if wanted.limit(1).count():
            more = scratch.keep(_sets(docs, classes, wanted, k), "sets")
            sets = more if sets is None else sets.unionByName(more)
            held.append(more)
        if sets is None:
            scratch.drop(pairs, wanted)
            continue
        found = scratch.keep(_verify(pairs, sets), mode)
        scratch.drop(pairs, wanted)
        if found.limit(1).count():         # else the components stay; they stand for the links of earlier rounds
            links = found.unionByName(labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
            after = scratch.keep(connected_components(links, scratch), "labels")
            if hasattr(labels, "_scratch_path"):
                scratch.drop(labels)
            labels = after
        scratch.drop(found)
    scratch.drop(*held)
    return classes, labels


def _components(rows: DataFrame, scratch: Scratch, k: int) -> DataFrame:
    """``components`` of rows that have been numbered and written."""
    classes, labels = link_sets(rows, scratch, k)
    known = classes.select("cid", "name").join(labels.withColumnRenamed("node", "cid"), "cid", "left") \
        .select("name", F.coalesce("component", "cid").alias("comp"))
    named = scratch.keep(_named(rows, k), "named")
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    by_class = named.where("name IS NOT NULL").groupBy("name").agg(lead.alias("lead")).join(known, "name")
    by_comp = by_class.groupBy("comp").agg(F.min("lead").alias("lead"))
    leads = scratch.keep(by_class.select("name", "comp").join(by_comp, "comp").select("name", "lead"), "leads")
    scratch.drop(classes, *([labels] if hasattr(labels, "_scratch_path") else []))
    out = named.join(leads, "name", "left")
    single = F.col("name").isNull()
    return out.select("row", "doc_id", F.col("n").alias("n_shingles"), F.when(single, F.col("doc_id")).otherwise(F.col("lead.doc_id")).alias("component_id"),
                      F.when(single, F.col("row")).otherwise(F.col("lead.row")).alias("first_row"))


def components(docs: DataFrame, k: int = 5) -> DataFrame:
    """(row, doc_id, n_shingles, component_id, first_row) of every row: ``row`` numbers the rows, ``first_row`` is
    the row that stands for the component."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    rows = numbered(docs, scratch, doc_id=F.col("doc_id"), text=F.col("text"))
    out = _components(rows.select("doc_id", "row", "text"), scratch, k)
    scratch.drop(rows)
    return out


def keep_representatives(docs: DataFrame, k: int = 5) -> DataFrame:
    """The rows of ``docs`` that stand for their component (its smallest id); rows without a word all stay."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    rows = numbered(docs, scratch, **{f"k_{c}": F.col(c) for c in docs.columns})
    gone = _components(rows.select(F.col("k_doc_id").alias("doc_id"), "row", F.col("k_text").alias("text")), scratch, k).where("row <> first_row")
    return rows.join(gone.select("row"), "row", "left_anti").select(*[F.col(f"k_{c}").alias(c) for c in docs.columns])
