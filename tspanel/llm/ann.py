"""Approximate nearest neighbours by NN-descent.

The index is a graph: every vector's ``degree`` best neighbours found. It starts
from blocks of vectors that lie on the same side of random planes (several deals;
the planes are drawn from a sample of some ``SAMPLE`` vectors and halve it, every vector is
put into its blocks, and what is the same to a plane goes to either side); each
round joins every node's neighbours (and a bounded
number of nodes it is a neighbour of) with each other, as a neighbour of a neighbour
is likely a neighbour, and keeps the best. Pairs that met in an earlier round
are not compared again, and rounds end when few neighbours still change.

A query walks the graph greedily: of the best ``pool`` nodes it knows, all that are
not yet expanded are, until none is left. It starts at its own node if it
is an indexed row, and at a few entry nodes. Edges, pools and answers are all scored in double
precision, so near copies are told apart wherever their cosines differ as doubles. Where the k-th of a pool
ties with its last, all nodes of that score stay and are expanded, as the smaller ids may be among them.

Equal vectors are one node; a node stands for its ``k + 1`` smallest ids, which
are all that can be among a query's k nearest, so crowds of copies cost nothing.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component
take no part, nor do rows with a null id or with another dimension than most (the
more frequent, then the larger one); rows repeated with id and vector count once;
ties go to the smaller id; fewer candidates than k give as many rows; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tspanel.llm.common import Scratch, mix64
from tspanel.llm.jaccard import _groups

#: Vectors that the first blocks' planes are drawn from, the least of them that a plane halves, and rows compared at a time.
SAMPLE, FEWEST, PIECE = 2048, 16, 1024


@dataclass(frozen=True)
class AnnConfig:
    degree: int = 24
    reverse: int = 24
    rounds: int = 12
    settled: float = 0.005      # rounds end when this part of the neighbours changes
    offers: int = 8             # pairs that a node hands on of one neighbourhood
    deals: int = 12
    block: int = 512            # vectors of a first block
    pool: int = 128
    entries: int = 8
    tie: float = 1e-15          # scores this near are one (the rounding of a double's cosine)
    stored: str = "float32"     # what nodes carry; float64 if the embeddings are not floats


def usable(table: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v) of the rows that take part, v as doubles."""
    v = F.col(embedding).cast("array<double>")
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.where(good)
    most = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return rows.where(F.size("v") == (most["dim"] if most else 0))


def _nodes(rows: DataFrame, k: int, stored: str) -> tuple[DataFrame, DataFrame]:
    """(members, nodes): the k + 1 smallest ids of each distinct vector with it, and for each node its vector times a power of two (``stored``, exact)."""
    named = rows.withColumn("name", F.sha2(F.array_join("v", ","), 256)).withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
    best = named.dropDuplicates(["vec_id", "name"])
    for keys in (["name", "salt"], ["name"]):
        best = best.withColumn("r", F.row_number().over(W.partitionBy(*keys).orderBy("vec_id"))).where(F.col("r") <= k + 1)
    members = best.withColumn("node", F.min("vec_id").over(W.partitionBy("name"))).select("vec_id", "node", "v")

    def unit(batches):
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), np.float64).reshape(batch.num_rows, -1)
            if not len(x):
                continue
            x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x.astype(stored)], pa.binary())], names=["node", "unit"])

    return members, members.where("vec_id = node").select("node", "v").mapInArrow(unit, "node long, unit binary")


def _units(column, cfg: AnnConfig) -> np.ndarray:
    x = np.frombuffer(b"".join(column.to_pylist()), cfg.stored).reshape(len(column), -1).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _planes(nodes: DataFrame, n: int, levels: int, cfg: AnnConfig) -> tuple[np.ndarray, np.ndarray]:
    """(deal, place, component) and (deal, place): trees of planes, each halving what its place has of a sample; places as in a heap, from 1."""
    chance = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    found = sorted((r["node"], bytes(r["unit"])) for r in nodes.where(chance < F.lit(SAMPLE / n)).collect())
    dim = len(found[0][1]) // np.dtype(cfg.stored).itemsize if found else 1
    x = _units(pa.array([u for _, u in found], pa.binary()), cfg) if found else np.zeros((0, dim))
    rng = np.random.default_rng(1)
    planes, cuts = np.zeros((cfg.deals, 1 << levels, dim)), np.zeros((cfg.deals, 1 << levels))
    for d in range(cfg.deals):
        held = {1: np.arange(len(x))}
        for place in range(1, 1 << levels):
            mine = held.pop(place, np.zeros(0, np.int64))
            if len(mine) < 2:
                continue
            p, q = rng.choice(mine, 2, replace=False)
            value = x[mine] @ (x[p] - x[q])
            planes[d, place], cuts[d, place] = x[p] - x[q], np.median(value)
            upper = value > cuts[d, place]
            held[2 * place], held[2 * place + 1] = mine[~upper], mine[upper]
    return planes, cuts


def _start(nodes: DataFrame, n: int, cfg: AnnConfig) -> DataFrame:
    """A first graph (v, u, sim): in several deals, the best of a node's block are its neighbours."""
    levels = min(max(0, int(np.ceil(np.log2(max(1, n) / cfg.block)))), int(np.log2(SAMPLE // FEWEST)))
    subs = max(1, -(-n // (cfg.block << levels)))
    deals = cfg.deals if levels else 1
    most = -(-cfg.degree // min(2, deals))
    trees = nodes.sparkSession.sparkContext.broadcast(_planes(nodes, n, levels, cfg) if levels else None)

    def deal(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, node = _units(batch.column(1), cfg), batch.column(0).to_numpy()
            for d in range(deals):
                luck = mix64(node.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(d))
                at = np.ones(len(node), np.int64)
                for level in range(levels):
                    planes, cuts = trees.value
                    over = np.einsum("ij,ij->i", x, planes[d][at]) - cuts[d][at]
                    by_chance = (luck >> np.uint64(level)) & np.uint64(1) == 1
                    at = 2 * at + np.where(np.abs(over) < 1e-12, by_chance, over > 0)
                at = at * subs + ((luck >> np.uint64(32)) % np.uint64(subs)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), d, np.int32)), pa.array(at), batch.column(0), batch.column(1)], names=["deal", "block", "node", "unit"])

    def join(batches):
        for table in _groups(batches, 2):
            d, b, node = (table.column(i).to_numpy() for i in range(3))
            x = _units(table.column(3), cfg)
            heads = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (b[1:] != b[:-1])]))
            for lo, hi in zip(heads.tolist(), [*heads[1:].tolist(), len(d)], strict=True):
                for a in range(lo, hi, PIECE):
                    z = min(a + PIECE, hi)
                    s = x[a:z] @ x[a:z].T
                    np.fill_diagonal(s, -2.0)
                    if z - a > most:
                        bar = np.partition(s, z - a - most, axis=1)[:, z - a - most]
                        s = np.where(s >= bar[:, None], s, -2.0)
                    i, j = np.nonzero(s > -2)
                    yield pa.RecordBatch.from_arrays([pa.array(node[a + i]), pa.array(node[a + j]), pa.array(s[i, j])], names=["v", "u", "sim"])

    rows = nodes.mapInArrow(deal, "deal int, block long, node long, unit binary")
    return rows.repartition("deal", "block").sortWithinPartitions("deal", "block").mapInArrow(join, "v long, u long, sim double")


def _offers(rows: DataFrame, cfg: AnnConfig) -> DataFrame:
    """Pairs (v, u, sim) better than v's worst neighbour, from joining each owner's members with each other."""
    most = cfg.degree + 2 * cfg.reverse

    def block(owner, member, new, kth, x) -> tuple[np.ndarray, ...]:
        heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        who = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(owner))))
        at = np.arange(len(owner)) - heads[who]
        ok = at < most
        who, at, idx = who[ok], at[ok], np.flatnonzero(ok)
        slot = np.full((len(heads), most), -1)
        slot[who, at] = idx
        real = slot >= 0
        full = np.where(real, slot, 0)
        s = np.matmul(x[full], x[full].transpose(0, 2, 1))
        worth = real[:, :, None] & real[:, None, :] & (new[full][:, :, None] | new[full][:, None, :]) & (member[full][:, :, None] != member[full][:, None, :])
        s = np.where(worth & (s > kth[full][:, :, None]), s, -2.0)
        if most > cfg.offers:
            bar = np.partition(s, most - cfg.offers, axis=2)[:, :, most - cfg.offers]
            s = np.where(s >= bar[:, :, None], s, -2.0)
        g, i, j = np.nonzero(s > -2)
        return member[full[g, i]], member[full[g, j]], s[g, i, j]

    def join(batches):
        for table in _groups(batches, 1):
            owner, member, new, kth = (table.column(i).to_numpy() for i in range(4))
            x = _units(table.column(4), cfg)
            # an owner's member may come both ways: one is enough
            order = np.lexsort((~new, member, owner))
            owner, member, new, kth, x = owner[order], member[order], new[order].astype(bool), kth[order], x[order]
            once = np.ones(len(owner), bool)
            once[1:] = (owner[1:] != owner[:-1]) | (member[1:] != member[:-1])
            # an owner without a new member has nothing to hand on
            heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            once &= np.repeat(np.logical_or.reduceat(new, heads), np.diff(np.append(heads, len(owner))))
            if not once.any():
                continue
            owner, member, new, kth, x = owner[once], member[once], new[once], kth[once], x[once]
            cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))[::256].tolist()
            parts = [block(owner[a:b], member[a:b], new[a:b], kth[a:b], x[a:b]) for a, b in zip(cuts, [*cuts[1:], len(owner)], strict=True)]
            v, u, s = (np.concatenate([p[k] for p in parts]) for k in range(3))
            order = np.lexsort((u, v))
            v, u, s = v[order], u[order], s[order]
            once = np.ones(len(v), bool)
            once[1:] = (v[1:] != v[:-1]) | (u[1:] != u[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(v[once]), pa.array(u[once]), pa.array(s[once])], names=["v", "u", "sim"])

    return rows.repartition("owner").sortWithinPartitions("owner").mapInArrow(join, "v long, u long, sim double")


def _best(edges: DataFrame, degree: int) -> DataFrame:
    """The ``degree`` best distinct neighbours of each node, with the worst kept similarity (-2 while there are fewer)."""

    def merge(batches):
        for table in _groups(batches, 1):
            v, u, sim = (table.column(i).to_numpy() for i in range(3))
            new = table.column(3).to_numpy()
            order = np.lexsort((new, u, v))
            v, u, sim, new = v[order], u[order], sim[order], new[order]
            once = np.ones(len(v), bool)
            once[1:] = (v[1:] != v[:-1]) | (u[1:] != u[:-1])
            v, u, sim, new = v[once], u[once], sim[once], new[once]
            order = np.lexsort((u, -sim, v))
            v, u, sim, new = v[order], u[order], sim[order], new[order]
            heads = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
            size = np.diff(np.append(heads, len(v)))
            rank = np.arange(len(v)) - np.repeat(heads, size)
            worst = np.where(size >= degree, sim[np.minimum(heads + degree - 1, len(v) - 1)], -2.0)
            kth = np.repeat(worst, size)
            ok = rank < degree
            yield pa.RecordBatch.from_arrays([pa.array(a[ok]) for a in (v, u, sim, new, kth)], names=["v", "u", "sim", "new", "kth"])

    return edges.select("v", "u", "sim", "new").repartition("v").sortWithinPartitions("v").mapInArrow(merge, "v long, u long, sim double, new boolean, kth double")


def build(nodes: DataFrame, scratch: Scratch, cfg: AnnConfig) -> DataFrame:
    """The neighbour graph (v, u, sim) of ``nodes`` (node, unit)."""
    n = nodes.count()
    graph = scratch.keep(_best(_start(nodes, n, cfg).withColumn("new", F.lit(True)), cfg.degree), "graph")
    for _ in range(cfg.rounds):
        changed = graph.where("new").count()
        if changed <= cfg.settled * n * cfg.degree:
            break
        known = nodes.join(graph.groupBy("v").agg(F.first("kth").alias("kth")), F.col("node") == F.col("v")).select(F.col("node").alias("member"), "kth", "unit")
        followers = graph.groupBy("u").agg(F.count("*").alias("m"))
        chance = F.pmod(F.xxhash64("u", "v"), F.lit(1 << 20)) / F.lit(float(1 << 20))
        back = graph.join(followers, "u").where(chance < F.lit(float(cfg.reverse)) / F.col("m")).select(F.col("u").alias("owner"), F.col("v").alias("member"), "new")
        both = graph.select(F.col("v").alias("owner"), F.col("u").alias("member"), "new").unionByName(back)
        rows = both.join(known, "member").select("owner", "member", "new", "kth", "unit")
        better = _offers(rows, cfg).withColumn("new", F.lit(True))
        after = scratch.keep(_best(graph.select("v", "u", "sim", F.lit(False).alias("new")).unionByName(better), cfg.degree), "graph")
        scratch.drop(graph)
        graph = after
    return graph


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame, scratch: Scratch, cfg: AnnConfig, k: int = 5) -> DataFrame:
    """(query_id, node): the pool of each query (query_id, node or null, unit) after its walk."""
    ways = scratch.keep(graph.select("v", "u").unionByName(graph.select(F.col("u").alias("v"), F.col("v").alias("u"))).distinct(), "ways")
    first = [r["node"] for r in nodes.select("node").orderBy(F.xxhash64("node"), "node").limit(cfg.entries).collect()]
    begin = queries.select("query_id", F.explode(F.array_distinct(F.concat(F.array(*[F.lit(x) for x in first]).cast("array<bigint>"), F.array("node")))).alias("node")).where("node IS NOT NULL")
    pool, schema = None, "query_id long, node long, sim double, turn boolean"

    def unseen(front, known):
        """What stands next to the nodes of ``front`` and is not ``known``."""
        beside = front.select("query_id", F.col("node").alias("v")).join(ways, "v").select("query_id", F.col("u").alias("node"), F.lit(False).alias("seen"))
        # one exchange for this and the join with the vectors
        both = beside.unionByName(known.select("query_id", "node", F.lit(True).alias("seen"))).repartition("node")
        return both.groupBy("query_id", "node").agg(F.max("seen").alias("seen")).where("NOT seen").select("query_id", "node")

    def rank(batches):
        """Score what is new, keep the best of the pool; what stays of the new is to be expanded.

        The row without a node has the query's own vector, and rows without a similarity are new.
        """
        for table in _groups(batches, 1):
            asked, fresh = (np.flatnonzero(table.column(i).is_null().to_numpy()) for i in (1, 2))
            q, node, sim = table.column(0).to_numpy(), *(table.column(i).fill_null(x).to_numpy() for i, x in ((1, 0), (2, 0.0)))
            fresh, sim, new = np.setdiff1d(fresh, asked, assume_unique=True), sim.copy(), np.zeros(len(q), bool)
            new[fresh] = True
            if len(fresh):
                mine, units = _units(table.column(3).take(pa.array(asked)), cfg), _units(table.column(3).take(pa.array(fresh)), cfg)
                sim[fresh] = np.einsum("ij,ij->i", mine[np.searchsorted(q[asked], q[fresh])], units)
            q, node, sim, new = (np.delete(a, asked) for a in (q, node, sim, new))
            if not len(q):
                continue
            order = np.lexsort((node, -sim, q))
            q, node, sim, new = (a[order] for a in (q, node, sim, new))
            heads = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
            size = np.diff(np.append(heads, len(q)))
            place = np.arange(len(q)) - np.repeat(heads, size)
            # the query's own node may be one of the best k + 1
            worst = sim[heads + np.minimum(size, cfg.pool) - 1]
            tied = sim[heads + np.minimum(size, min(k + 1, cfg.pool)) - 1] - worst <= cfg.tie
            ok = (place < cfg.pool) | (np.repeat(tied, size) & (sim >= np.repeat(worst, size) - cfg.tie))
            yield pa.RecordBatch.from_arrays([pa.array(a[ok]) for a in (q, node, sim, new)], names=["query_id", "node", "sim", "turn"])

    nothing = F.lit(None).cast("double").alias("sim")
    vectors = queries.select("query_id", F.lit(None).cast("long").alias("node"), nothing, "unit")
    to_see = begin.unionByName(unseen(begin, begin))
    while True:
        rows = vectors.unionByName(to_see.join(nodes, "node").select("query_id", "node", nothing, "unit"))
        if pool is not None:
            rows = rows.unionByName(pool.select("query_id", "node", "sim", F.lit(None).cast("binary").alias("unit")))
        before, pool = pool, scratch.keep(rows.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(rank, schema), "pool")
        if before is not None:
            scratch.drop(before)
        turn = pool.where("turn")
        if not turn.limit(1).count():
            return pool.select("query_id", "node")
        to_see = unseen(turn, pool)


def nearest(table: DataFrame, is_query, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", cfg: AnnConfig | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found by cosine of each row for which ``is_query`` (a condition on vec_id) holds."""
    narrow = table.select(F.col(embedding)).schema[0].dataType.simpleString() == "array<float>"
    cfg = replace(cfg or AnnConfig(), stored="float32" if narrow else "float64")
    scratch = Scratch(table.sparkSession, "ann")
    rows = scratch.keep(usable(table, vec_id, embedding), "rows")
    members, nodes = _nodes(rows, k, cfg.stored)
    members, nodes = scratch.keep(members, "members"), scratch.keep(nodes, "nodes")
    graph = build(nodes, scratch, cfg)
    asked = rows.where(is_query).dropDuplicates(["vec_id"]).select(F.col("vec_id").alias("query_id"), F.col("v").alias("qv"))
    own = rows.where(is_query).withColumn("name", F.array_join("v", ",")).dropDuplicates(["vec_id"]) \
        .join(members.where("vec_id = node").select("node", F.array_join("v", ",").alias("name")), "name").select(F.col("vec_id").alias("query_id"), "node")
    found = search(own.join(nodes, "node").select("query_id", "node", "unit"), nodes, graph, scratch, cfg, k)
    near = found.join(members, "node").where("vec_id <> query_id").join(asked, "query_id")

    def cosine(batches):
        for batch in batches:
            a = np.array(batch.column(2).to_pylist(), np.float64).reshape(batch.num_rows, -1)
            b = np.array(batch.column(3).to_pylist(), np.float64).reshape(batch.num_rows, -1)
            s = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s)], names=["query_id", "vec_id", "score"])

    scored = near.select("query_id", "vec_id", "qv", "v").mapInArrow(cosine, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
