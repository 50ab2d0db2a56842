"""Links between near vectors of a label, found in robust-pruned flat graphs.

Two vectors of one label link if their cosine reaches the threshold. Equal
vectors are one node with a number of copies. Then:

* **Overlapping cluster shards.** A label's nodes are divided among sampled
  centres until a shard holds at most ``SHARD`` nodes; a node goes to its
  nearest centre and to all that are at most ``OVERLAP`` degrees farther (twice
  the threshold's angle, 23 degrees at 0.98, would lose no pair at all; the audit
  widens it up to there if it has to). It asks in the shard of its nearest centre
  and is asked for in all. A group too dense to be divided is dealt in
  pairs of blocks, so that each pair of its nodes meets in a shard; there all ask.
* **Graph.** In a shard every node gets at most ``DEGREE`` neighbours by robust
  pruning (a candidate goes if it is clearly closer to a neighbour chosen before
  than to the node), some of them from far candidates, and the edges back. The
  adjacency lists that a node got in its shards are united.
* **Search.** In a shard, each node that asks is searched greedily from the medoids
  of the shard's cells over the united lists until it is met itself (or the pool
  is used up); from there on what lies within reach is expanded as long as
  something new within reach is found.
* **Verification** of all pairs found in double precision; a pair that is looked for in
  several shards counts in the least of them.
* **Audit.** For a sample of nodes the links are counted by brute force over all
  vectors. Below ``RECALL`` the shards overlap more and the pool is widened, and
  the search runs again.

Links stay inside their task: it returns how many a node has and which nodes are
connected, so rows grow with the nodes, not with the links. Shards are the unit
of work and of memory; a task holds one.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components, and those without a label, link with nothing; vectors of different
length never link; rows of equal vectors link, also when ids repeat; a null id
names no component unless all its rows have none; an empty table gives an empty
result; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tspanel.llm.common import Scratch
from tspanel.llm.components import connected_components

SHARD = 4096
OVERLAP = 4.0
DEGREE, FAR_DEGREE, BACK_DEGREE = 24, 8, 16
NEAR_POOL, FAR_POOL = 96, 48
POOL, MEDOIDS = 48, 16
#: Robust pruning: a candidate goes if ALPHA times its distance to a chosen neighbour is not above that to the node.
ALPHA = 1.2
#: Cosines below the threshold that are still expanded.
SLACK = 0.02
SAMPLE, RECALL = 128, 0.99
QUERIES = 512


def units(vectors: pa.Array) -> np.ndarray:
    """Unit vectors in double precision (scaled first, so that squares neither vanish nor overflow)."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    v = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def build_graph(v: np.ndarray, seed: int = 1) -> np.ndarray:
    """Adjacency of a shard (rows of neighbours, -1 where there are fewer) by robust pruning."""
    v = v.astype(np.float32)
    n = len(v)
    rng = np.random.default_rng(seed)
    out = np.full((n, DEGREE + FAR_DEGREE + BACK_DEGREE), -1, np.int32)
    if n == 1:
        return out
    for at in range(0, n, QUERIES):
        own = np.arange(at, min(n, at + QUERIES))
        sims = v[own] @ v.T
        sims[np.arange(len(own)), own] = -np.inf
        near = min(NEAR_POOL, n - 1)
        pool = np.argpartition(-sims, near - 1, axis=1)[:, :near]
        far = rng.integers(0, n, (len(own), FAR_POOL))
        out[own, :DEGREE] = _pruned(v, own, pool, sims, DEGREE)
        out[own, DEGREE:DEGREE + FAR_DEGREE] = _pruned(v, own, far, sims, FAR_DEGREE)
    kept = out[:, :DEGREE + FAR_DEGREE]
    a, col = np.nonzero(kept >= 0)
    b = kept[a, col]
    order = np.lexsort((rng.random(len(b)), b))           # edges back: some of each node, whichever came first or last
    b, a = b[order], a[order]
    place = np.arange(len(b)) - np.searchsorted(b, b)
    some = place < BACK_DEGREE
    out[b[some], DEGREE + FAR_DEGREE + place[some]] = a[some]
    return out


def _pruned(v: np.ndarray, own: np.ndarray, pool: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
    """Of each node's pool the nearest, then the nearest not shadowed by one chosen before, and so on."""
    rows = np.arange(len(own))
    sim = np.take_along_axis(sims, pool, axis=1)
    order = np.argsort(-sim, axis=1, kind="stable")
    pool, sim = np.take_along_axis(pool, order, axis=1), np.take_along_axis(sim, order, axis=1)
    alive, held = np.isfinite(sim), v[pool]
    out = np.full((len(own), degree), -1, np.int32)
    for d in range(degree):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        picked = pool[rows, first]
        out[some, d] = picked[some]
        between = np.einsum("npd,nd->np", held, v[picked])
        shadowed = ALPHA * ALPHA * (1 - between) <= (1 - sim) + 1e-7
        alive &= ~(shadowed & some[:, None])
        alive &= pool != picked[:, None]
    return out


def medoids(v: np.ndarray) -> np.ndarray:
    """The member nearest to the middle of each of some cells of the shard."""
    seeds = np.linspace(0, len(v) - 1, min(MEDOIDS, len(v))).astype(int)
    cell = (v @ v[seeds].T).argmax(axis=1)
    out = set()
    for c in np.unique(cell):
        members = np.flatnonzero(cell == c)
        out.add(int(members[(v[members] @ v[members].mean(axis=0)).argmax()]))
    return np.array(sorted(out))


def range_search(v: np.ndarray, graph: np.ndarray, entries: np.ndarray, reach: float, pool: int = POOL, asks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(query, found) of the members whose cosine reaches ``reach``, as far as the search sees them; queries are the members that ask (all)."""
    v = v.astype(np.float32)
    asks = np.arange(len(v)) if asks is None else np.flatnonzero(asks)
    qs, fs = [asks[:0]], [asks[:0]]
    for at in range(0, len(asks), QUERIES):
        own = asks[at:at + QUERIES]
        q, f = _search(v, graph, own, entries, reach, pool)
        qs.append(q)
        fs.append(f)
    return np.concatenate(qs), np.concatenate(fs)


def _search(v, graph, own, entries, reach, pool):
    n, rows = len(v), np.arange(len(own))
    seen = np.zeros((len(own), n), bool)
    ids = np.full((len(own), pool), -1, np.int64)
    sim = np.full((len(own), pool), -np.inf, np.float32)
    k = min(pool, len(entries))
    ids[:, :k] = entries[:k]
    sim[:, :k] = v[own] @ v[entries[:k]].T
    seen[:, entries[:k]] = True
    opened = ids < 0
    found_q, found_n = [], []

    def note(row, node, s):
        hit = s >= reach
        found_q.append(row[hit])
        found_n.append(node[hit])

    note(np.repeat(rows, k), ids[:, :k].ravel(), sim[:, :k].ravel())
    active = rows[~seen[rows, own]]
    while len(active):                                    # greedy: the nearest that is not yet opened, until the query itself is met
        best = np.where(opened[active], -np.inf, sim[active]).argmax(axis=1)
        opened[active, best] = True
        near = graph[ids[active, best]].astype(np.int64)
        fresh = (near >= 0) & ~seen[active[:, None], near]
        fresh &= _first_of_row(near)
        got = np.where(fresh, np.einsum("qrd,qd->qr", v[near], v[own[active]]), -np.inf).astype(np.float32)
        r, c = np.nonzero(fresh)
        seen[active[r], near[r, c]] = True
        note(active[r], near[r, c], got[r, c])
        all_ids = np.concatenate([ids[active], np.where(fresh, near, -1)], axis=1)
        all_sim = np.concatenate([sim[active], got], axis=1)
        all_open = np.concatenate([opened[active], ~fresh], axis=1)
        top = np.argpartition(-all_sim, pool - 1, axis=1)[:, :pool]
        ids[active], sim[active] = np.take_along_axis(all_ids, top, axis=1), np.take_along_axis(all_sim, top, axis=1)
        opened[active] = np.take_along_axis(all_open, top, axis=1)
        active = active[~(opened[active].all(axis=1) | seen[active, own[active]])]
    q, f = np.concatenate(found_q), np.concatenate(found_n)
    edge_q, edge_n = q, f                                 # within reach: expand until nothing new is within reach
    while len(edge_q):
        next_q, next_n = [], []
        for a in range(0, len(edge_q), 1 << 16):
            row = np.repeat(edge_q[a:a + (1 << 16)], graph.shape[1])
            node = graph[edge_n[a:a + (1 << 16)]].astype(np.int64).ravel()
            good = node >= 0
            row, node = row[good], node[good]
            new = ~seen[row, node]
            key = np.unique(row[new] * n + node[new])
            row, node = key // n, key % n
            seen[row, node] = True
            s = np.einsum("id,id->i", v[own[row]], v[node]) if len(row) else np.zeros(0, np.float32)
            hit = s >= reach
            next_q.append(row[hit])
            next_n.append(node[hit])
        edge_q, edge_n = np.concatenate(next_q), np.concatenate(next_n)
        q, f = np.concatenate([q, edge_q]), np.concatenate([f, edge_n])
    return own[q], f


def _first_of_row(near: np.ndarray) -> np.ndarray:
    """Marks the first of equal neighbours in each row."""
    order = np.argsort(near, axis=1, kind="stable")
    by = np.take_along_axis(near, order, axis=1)
    first = np.ones_like(by, bool)
    first[:, 1:] = by[:, 1:] != by[:, :-1]
    out = np.empty_like(first)
    np.put_along_axis(out, order, first, axis=1)
    return out


def verified(v: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs (smaller place first) whose cosine reaches the threshold in double precision."""
    n = len(v)
    keys = np.unique(np.minimum(a, b)[a != b].astype(np.int64) * n + np.maximum(a, b)[a != b])
    good = [keys[:0]]
    for at in range(0, len(keys), 1 << 17):
        part = keys[at:at + (1 << 17)]
        good.append(part[np.einsum("id,id->i", v[part // n], v[part % n]) >= threshold])
    keys = np.concatenate(good)
    return keys // n, keys % n


def least_members(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least place connected with each of n places by the links a-b."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[a], least[b])
        now = least.copy()
        np.minimum.at(now, least[a], low)
        np.minimum.at(now, least[b], low)
        now = now[now]
        if (now == least).all():
            return least
        least = now


# --- on Spark ---------------------------------------------------------------

def _nodes(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """All rows with the hashes of their vector (null: takes no part), and one node for each label and vector."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    ok = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(some, F.lit(False)) & ~F.coalesce(bad, F.lit(False))
    flat = F.transform("embedding", lambda x: F.when(x == 0, F.abs(x)).otherwise(x))      # -0 is 0
    named = rows.select("vec_id", F.col("label").cast("string").alias("label"), flat.alias("embedding"), ok.alias("ok"))
    hashed = scratch.keep(named.select("vec_id", "label", "embedding", "ok", F.when(F.col("ok"), F.xxhash64("label", "embedding")).alias("h1"),
                                       F.when(F.col("ok"), F.xxhash64(F.lit(7), F.col("embedding"), F.col("label"))).alias("h2")), "rows")
    group = F.xxhash64("label", F.size("embedding"))
    nodes = hashed.where("ok").groupBy("h1", "h2").agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"),
                                                       F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    return hashed, scratch.keep(nodes.select(F.monotonically_increasing_id().alias("node"), "*", group.alias("group")), "nodes")


def _dealt(placed: DataFrame, shard: int) -> DataFrame:
    """Shards that no centre divides, as pairs of blocks: ``blocks`` is a shard's number of them."""
    block = F.pmod(F.xxhash64(F.lit(3), F.col("node")), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    pairs = placed.select("node", "shard", "asks", block.alias("own"), other)
    return pairs.select("node", F.xxhash64("shard", F.least("own", "other"), F.greatest("own", "other")).alias("shard"), "asks")


def _to_centres(overlap: float):
    def work(batches):
        for batch in batches:
            node, shard = batch.column("node").to_pylist(), np.array(batch.column("shard").to_pylist(), np.int64)
            sizes = np.asarray(pa.compute.list_value_length(batch.column("embedding")))
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            nodes, shards, child, home = [], [], [], []
            for s, d in set(zip(shard.tolist(), sizes.tolist(), strict=True)):
                at = np.flatnonzero((shard == s) & (sizes == d))
                rows = batch.take(pa.array(at))
                centres = units(rows.column("centres").slice(0, 1).flatten())
                angle = np.degrees(np.arccos(np.clip(units(rows.column("embedding")) @ centres.T, -1, 1)))
                nearest = angle.argmin(axis=1)
                r, c = np.nonzero(angle <= angle.min(axis=1, keepdims=True) + overlap)
                home += (asks[at[r]] & (c == nearest[r])).tolist()
                nodes += [node[i] for i in at[r].tolist()]
                shards += [s] * len(r)
                child += c.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(shards, pa.int64()), pa.array(child, pa.int64()), pa.array(home, pa.bool_())],
                                             ["node", "parent", "child", "asks"])
    return work


def _shards(nodes: DataFrame, scratch: Scratch, overlap: float, shard: int) -> DataFrame:
    """(node, shard, asks): each node in one shard or more; none holds many more than ``shard`` nodes."""
    placed = nodes.select("node", F.col("group").alias("shard"), F.lit(True).alias("asks"))
    done = []
    while True:
        sizes = placed.groupBy("shard").agg(F.count("*").alias("size"))
        big = scratch.keep(sizes.where(F.col("size") > shard), "big")
        if big.isEmpty():
            done.append(placed)
            break
        done.append(placed.join(big, "shard", "left_anti"))
        at = placed.join(big, "shard").join(nodes.select("node", "embedding"), "node")
        wanted = F.least(F.lit(64), F.greatest(F.lit(4), F.ceil(4 * F.col("size") / shard)))
        order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(5), F.col("shard"), F.col("node")))
        drawn = at.withColumn("nth", F.row_number().over(order)).where("nth <= 64").where(F.col("nth") <= wanted)
        centres = drawn.groupBy("shard").agg(F.collect_list("embedding").alias("centres"))
        moved = at.join(centres, "shard").select("node", "shard", "asks", "embedding", "centres") \
            .mapInArrow(_to_centres(overlap), "node long, parent long, child long, asks boolean")
        moved = scratch.keep(moved.withColumn("shard", F.xxhash64("parent", "child")), "placed")
        grown = moved.groupBy("shard", "parent").agg(F.count("*").alias("now")).join(big.select(F.col("shard").alias("parent"), "size"), "parent")
        stuck = grown.where((F.col("now") > shard) & (F.col("now") * 2 > F.col("size"))).select("shard", F.ceil(F.col("now") * 2 / shard).cast("long").alias("blocks"))
        stuck = scratch.keep(stuck, "stuck")
        done.append(_dealt(moved.join(stuck, "shard"), shard))
        placed = moved.select("node", "shard", "asks").join(stuck, "shard", "left_anti")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more.select(out.columns))
    return out


def _build(table: pa.Table) -> pa.Table:
    node = np.array(table.column("node").to_pylist(), np.int64)
    order = np.argsort(node)
    graph = build_graph(units(table.column("embedding"))[order])
    node = node[order]
    near = [node[row[row >= 0]] for row in graph]
    return pa.table({"node": pa.array(node), "near": pa.array(near, pa.list_(pa.int64()))})


def _links(threshold: float, pool: int):
    def work(table: pa.Table) -> pa.Table:
        node = np.array(table.column("node").to_pylist(), np.int64)
        order = np.argsort(node)
        table, node = table.take(pa.array(order)), node[order]
        v, copies, own = units(table.column("embedding")), table.column("copies").to_numpy(), table.column("shard")[0].as_py()
        near = table.column("near").combine_chunks()
        where = np.repeat(np.arange(len(node)), np.diff(near.offsets.to_numpy()))
        to = near.flatten().to_numpy()
        place = np.minimum(np.searchsorted(node, to), len(node) - 1)
        here = node[place] == to                          # neighbours in other shards are not at hand
        where, place = where[here], place[here]
        col = np.arange(len(where)) - np.searchsorted(where, where)
        graph = np.full((len(node), int(col.max(initial=0)) + 1), -1, np.int32)
        graph[where, col] = place
        asks = table.column("asks").to_numpy()
        a, b = range_search(v, graph, medoids(v), threshold - SLACK, pool, asks)
        a, b = verified(v, a, b, threshold)
        member = least_members(len(node), a, b)
        shards = table.column("shards").combine_chunks()
        row, lower = np.repeat(np.arange(len(node)), np.diff(shards.offsets.to_numpy())), shards.flatten()
        lower, asking = lower.field("shard").to_numpy(), lower.field("asks").to_numpy(zero_copy_only=False)
        row, lower, asking = row[lower < own], lower[lower < own], asking[lower < own]
        counted = np.ones(len(a), bool)
        if len(lower):                                    # pairs that are also looked for in a lesser shard count there
            bit = np.unique(lower, return_inverse=True)[1]
            member_of, asks_in = np.zeros((2, len(node), (int(bit.max()) >> 3) + 1), np.uint8)
            np.bitwise_or.at(member_of, (row, bit >> 3), (1 << (bit & 7)).astype(np.uint8))
            np.bitwise_or.at(asks_in, (row[asking], bit[asking] >> 3), (1 << (bit[asking] & 7)).astype(np.uint8))
            for at in range(0, len(a), 1 << 17):
                s = slice(at, at + (1 << 17))
                counted[s] = ~(member_of[a[s]] & member_of[b[s]] & (asks_in[a[s]] | asks_in[b[s]])).any(axis=1)
        a, b = a[counted], b[counted]
        links = np.bincount(a, copies[b], len(node)) + np.bincount(b, copies[a], len(node))
        several = np.diff(shards.offsets.to_numpy()) > 1
        open_ = np.zeros(len(node), bool)
        open_[member[several]] = True
        return pa.table({"node": pa.array(node), "links": pa.array(links.astype(np.int64)), "least": pa.array(node[member]), "open": pa.array(open_[member])})
    return work


def _count_near(sample: pa.Array, labels: list[str], threshold: float):
    """Brute force: links of each sampled node among the nodes of a batch."""
    probe = [np.array(x, np.float64) for x in sample.to_pylist()]

    def work(batches):
        for batch in batches:
            sizes = np.asarray(pa.compute.list_value_length(batch.column("embedding")))
            label, copies = np.array(batch.column("label").to_pylist(), object), batch.column("copies").to_numpy()
            n = np.zeros(len(probe))
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d)
                v = units(batch.column("embedding").take(pa.array(at)))
                mine = [i for i, p in enumerate(probe) if len(p) == d]
                if mine:
                    cos = units(pa.array([probe[i] for i in mine], pa.list_(pa.float64()))) @ v.T
                    same = np.array([labels[i] for i in mine], object)[:, None] == label[at][None, :]
                    n[mine] += ((cos >= threshold) & same) @ copies[at]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(probe)), pa.int64()), pa.array(n.astype(np.int64))], ["probe", "links"])
    return work


def audit(nodes: DataFrame, counted: DataFrame, threshold: float, sample: int = SAMPLE) -> float:
    """Share of the links found, over a sample of nodes (half of them with links), by brute force over all nodes."""
    told = nodes.join(counted.select("node", "links"), "node").select("label", "embedding", "links", F.xxhash64(F.lit(9), F.col("node")).alias("h"))
    some = told.where("links > 0").orderBy("h").limit(sample // 2).unionByName(told.orderBy("h").limit(sample // 2)).collect()
    if not some:
        return 1.0
    embeddings = pa.array([r["embedding"] for r in some], pa.list_(pa.float64()))
    near = nodes.select("label", "embedding", "copies").mapInArrow(_count_near(embeddings, [r["label"] for r in some], threshold), "probe long, links long")
    true = {r["probe"]: r["links"] - 1 for r in near.groupBy("probe").agg(F.sum("links").alias("links")).collect()}
    total = sum(true.values())
    return sum(min(r["links"], true[i]) for i, r in enumerate(some)) / total if total else 1.0


def near_links(rows: DataFrame, threshold: float = 0.98, shard: int = SHARD, overlap: float = OVERLAP, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``rows`` (vec_id, embedding, label)."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "flatgraph")
    hashed, nodes = _nodes(rows, scratch)
    pool, lossless = POOL, 2 * math.degrees(math.acos(threshold))
    while True:
        where = _shards(nodes, scratch, overlap, shard).groupBy("node", "shard").agg(F.max("asks").alias("asks"))
        lists = where.groupBy("node").agg(F.collect_list(F.struct("shard", "asks")).alias("shards"))
        spread = nodes.select("node", "embedding", "copies").join(lists, "node").withColumn("at", F.explode("shards"))
        placed = scratch.keep(spread.select("node", "embedding", "copies", "shards", F.col("at.shard").alias("shard"), F.col("at.asks").alias("asks")), "placed")
        graphs = placed.select("node", "shard", "embedding").groupBy("shard").applyInArrow(_build, "node long, near array<long>")
        united = graphs.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
        found = placed.join(united, "node").groupBy("shard").applyInArrow(_links(threshold, pool), "node long, links long, least long, open boolean")
        found = scratch.keep(found, "links")
        # a copy's links: the other copies of its own vector, and all copies of the vectors linked with it
        counted = found.groupBy("node").agg(F.sum("links").alias("links")).join(nodes.select("node", "copies"), "node") \
            .select("node", (F.col("links") + F.col("copies") - 1).alias("links"))
        if overlap >= lossless or audit(nodes, counted, threshold) >= recall:
            break
        overlap, pool = min(2 * overlap, lossless), 2 * pool
    edges = found.where("open").select(F.col("node").alias("a"), F.col("least").alias("b"))
    joined = connected_components(edges, scratch).select("node", "component")
    closed = found.where("not open").select("node", F.col("least").alias("component"))
    member = joined.unionByName(closed).unionByName(found.where("open").select("node").distinct().join(joined.select("node"), "node", "left_anti")
                                                    .select("node", F.col("node").alias("component")))
    named = member.join(nodes.select("node", "vec_id"), "node")
    names = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    told = counted.join(member, "node").join(names, "component").join(nodes.select("node", "h1", "h2"), "node").select("h1", "h2", "links", "component_id")
    out = hashed.join(told, ["h1", "h2"], "left")
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
