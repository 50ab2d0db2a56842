"""Lexical search, conversation repair and near links against plain Python, on messy and empty tables too."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest

from tspanel.llm import conversations, flatgraph, fptree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- 11: ranked lexical search ----------------------------------------------

def ranked(docs, items, k):
    tf = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in tf:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // max(1, n_terms)
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t, q in Counter(TERM.findall((text or "").translate(LOWER))).items() if t in c)
            if s > 0:
                scores.append((-s, doc is None, doc or 0))
        out += [(item, i + 1, None if none else doc, -s) for i, (s, none, doc) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def messy_docs():
    rng = random.Random(11)
    words = [f"w{int(rng.paretovariate(0.6)) % 200}" for _ in range(4000)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))) for i in range(400)]
    docs += [(1000 + i, docs[3][1]) for i in range(40)] + [(5, docs[5][1]), (None, docs[3][1]), (2000, None), (2001, ""), (2002, " .,;"), (2003, "W1 é_w2-Ω Ｘ w1w2\x00w3")]
    return docs + [(2004, "w1 w2 " * 300_000 + "w9")]


@pytest.mark.parametrize(("unit", "block"), [(50, 200_000), (7, 10), (16_384, 40)])
def test_search_equals_brute_force(spark, monkeypatch, unit, block):
    rng = random.Random(12)
    docs = messy_docs()
    items = [(i, " ".join(f"W{rng.randint(0, 120)}" for _ in range(rng.randint(1, 30)))) for i in range(12)] + [(3, "w1 w1 w2"), (None, "w3 w4"), (50, None), (51, "nowhere"), (52, "")]
    items.append((60, " ".join(f"w{i}" for i in range(150))))
    monkeypatch.setattr(fptree, "PIECE", 1000)
    d = spark.createDataFrame([(a, b, "x", 1) for a, b in docs], "doc_id long, text string, item string, score int").repartition(3)
    q = spark.createDataFrame([(a, b, 5) for a, b in items], "item_id long, text string, rank int")
    got = sorted([tuple(r) for r in fptree.rank_documents(d, q, 10, unit, block).collect()], key=str)
    want = ranked(docs, items, 10)
    assert got == want


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert fptree.rank_documents(docs, items).collect() == []
    assert fptree.rank_documents(some, items).collect() == []
    assert fptree.rank_documents(docs, some.withColumnRenamed("doc_id", "item_id")).collect() == []


# --- 12: conversation structure ---------------------------------------------

NEXT = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def repaired(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha) by plain recursion over all edits."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        solid = text.rstrip(" \t\n\x0b\f\r")
        faults.append("b" if not solid else "d" if (role, text) in seen else "" if solid[-1] in ".!?" else "t")
        seen.add((role, text))

    @cache
    def best(i, state):
        """Cheapest (cost, audit) from row i on, ties by audit; inserts before deciding, at most two in a row."""
        found = []
        if i == len(rows):
            if state in (0, 3):
                found.append((0, ""))
        else:
            role, cut = rows[i][2], 3 * (faults[i] == "t")
            c, a = best(i + 1, state)
            found.append((c + 4, "D" + a))
            if faults[i] not in ("b", "d"):
                to, _ = NEXT[state]
                c, a = best(i + 1, to)
                found.append((c + 3 + cut, "R" + a))
                if role[:1] == NEXT[state][1][0]:
                    found.append((c + cut, "K" + a))
                if state == 0 and role[:1] == "s":
                    c, a = best(i + 1, 1)
                    found.append((c + cut, "K" + a))
        return min(found + inserted(i, state, 2))

    def inserted(i, state, left):
        if not left:
            return []
        to = NEXT[state][0]
        c, a = bare(i, to, left - 1)
        return [(c + 3, "I" + a)]

    @cache
    def bare(i, state, left):
        found = []
        if i == len(rows):
            found += [(0, "")] if state in (0, 3) else []
        else:
            cut = 3 * (faults[i] == "t")
            c, a = best(i + 1, state)
            found.append((c + 4, "D" + a))
            if faults[i] not in ("b", "d"):
                c, a = best(i + 1, NEXT[state][0])
                found.append((c + 3 + cut, "R" + a))
                if rows[i][2][:1] == NEXT[state][1][0]:
                    found.append((c + cut, "K" + a))
                if state == 0 and rows[i][2][:1] == "s":
                    c, a = best(i + 1, 1)
                    found.append((c + cut, "K" + a))
        more = inserted(i, state, left)
        return min(found + more) if found or more else (1 << 40, "")

    cost, audit = best(0, 0)
    lines, state, at = [], 0, 0
    for e in audit:
        if e == "I":
            state, name = NEXT[state]
            lines.append(f"{name}:")
            continue
        _, _, role, text = rows[at]
        at += 1
        if e == "R":
            state, name = NEXT[state]
            lines.append(f"{name}:{text}")
        elif e == "K":
            state = 1 if state == 0 and role[:1] == "s" else NEXT[state][0]
            lines.append(f"{role}:{text}")
    turns = {r[1] for r in rows if r[1] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()


def messy_turns():
    rng = random.Random(3)
    rows = []
    for conv in range(120):
        at = 0
        for _ in range(rng.randint(1, 9)):
            at += rng.choice([1, 1, 1, 2, 0])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "u", "A"])
            rows.append((conv, rng.choice([at, at, at, None]), role, rng.choice(["Yes.", "No!", "and then", " \n", "", None, "a b?", "Ω.", "x.\u0085", "end. \t"])))
    rows += [(None, 1, "user", "Hi."), (None, None, None, None), (None, 2, "assistant", "Hello.")] + [(500, 0, "user", "Same.")] * 7
    return rows + [(501, i, ["user", "assistant"][i % 2], f"Line {i % 40}.") for i in range(700)] + [(502, 0, "system", "z" * 300_000 + "."), (502, 1, "user", "q?")]


@pytest.mark.parametrize("bits", [2, 10])
def test_repair_equals_plain_recursion(spark, monkeypatch, bits):
    import sys
    sys.setrecursionlimit(20_000)
    monkeypatch.setattr(conversations, "BLOCK_BITS", bits)
    rows = messy_turns()
    by = defaultdict(list)
    for r in damaged(rows):
        by[r[0]].append(r)
    want = {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in {r[0] for r in rows}} | {c: repaired(x) for c, x in by.items()}
    frame = spark.createDataFrame([(*r, 7, "x") for r in rows], "conv_id long, turn long, role string, text string, copies int, block string").repartition(4)
    got = {r[0]: tuple(r)[1:] for r in conversations.repair(conversations.damage(frame)).collect()}
    assert got == want
    turns = conversations.repaired_turns(conversations.damage(frame)).orderBy("conv_id", "position").collect()
    lines = defaultdict(list)
    for r in turns:
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    assert all(hashlib.sha256("\n".join(lines[c]).encode("utf-8", "surrogatepass")).hexdigest() == w[-1] for c, w in want.items())


def test_repair_of_an_empty_table(spark):
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.repair(conversations.damage(rows)).collect() == []
    assert conversations.repaired_turns(rows).collect() == []


# --- 13: near links ---------------------------------------------------------

def linked(rows, threshold=0.98):
    ok = [r[1] is not None and r[2] is not None and len(r[1]) and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    unit = [np.array(r[1], float) / np.linalg.norm(np.array(r[1], float)) if o else None for r, o in zip(rows, ok)]
    near = [[j for j in range(len(rows)) if j != i and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= threshold]
            for i in range(len(rows))]
    out = []
    for i, r in enumerate(rows):
        todo, seen = [i], {i}
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        c = min(ids) if ids else None
        out.append((r[0], len(near[i]), c, r[0] == c))
    return Counter(out)


def messy_vectors():
    rng = np.random.default_rng(4)
    f = np.float32
    rows = [(i, rng.normal(size=16).astype(f).tolist(), i % 3) for i in range(240)]
    base = rng.normal(size=16)
    rows += [(300 + i, (base + 0.08 * rng.normal(size=16)).astype(f).tolist(), 1) for i in range(150)]
    rows += [(500 + i, rows[7][1], 1) for i in range(30)] + [(600, rows[7][1], 2), (601, [2 * x for x in rows[7][1]], 1)]
    chain = rng.normal(size=16)
    for i in range(12):
        chain = chain + 0.12 * rng.normal(size=16)
        rows.append((700 + i, chain.astype(f).tolist(), 0))
    rows += [(800, None, 1), (801, [0.0] * 16, 1), (802, [float("nan")] * 16, 1), (803, [1.0, None] * 8, 1), (804, [float("inf")] + [1.0] * 15, 1), (805, rows[7][1], None),
             (806, [], 1), (807, [1.0, 2.0], 1), (808, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (None, rows[9][1], 0), (3, rows[3][1], 0), (3, rows[3][1], 0), (None, [5.0, -1.0], 2)]
    return rows


@pytest.mark.parametrize("shard", [4096, 40])
def test_links_equal_brute_force(spark, shard):
    rows = messy_vectors()
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, node int, shard string").repartition(5)
    got = Counter(tuple(r) for r in flatgraph.near_links(frame, shard=shard, recall=1.0).collect())
    assert got == linked(rows)


def test_links_of_an_empty_table(spark):
    assert flatgraph.near_links(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_graph_search_finds_what_brute_force_finds():
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(300, 32))
    v = np.repeat(centres, 5, axis=0) + 0.1 * rng.normal(size=(1500, 32))
    v = np.concatenate([v, centres[0] + 0.1 * rng.normal(size=(400, 32))])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    graph = flatgraph.build_graph(v)
    assert graph.shape[1] == flatgraph.DEGREE + flatgraph.FAR_DEGREE + flatgraph.BACK_DEGREE
    a, b = flatgraph.verified(v, *flatgraph.range_search(v, graph, flatgraph.medoids(v), 0.96), 0.98)
    want = np.argwhere(np.triu(v @ v.T >= 0.98, 1))
    assert len(a) >= 0.999 * len(want)
    assert set(zip(a.tolist(), b.tolist())) <= {tuple(x) for x in want.tolist()}


# --- results do not follow how a scan is split --------------------------------

@pytest.fixture
def moving_executors(spark, monkeypatch):
    """Executors come and go: every table written changes the default parallelism, which the next scan is split by."""
    from tspanel.llm.common import Scratch

    keep, n = Scratch.keep, [0]

    def moved(self, df, name):
        out = keep(self, df, name)
        n[0] += 1
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", str([4, 40, 1, 13][n[0] % 4]))
        return out

    monkeypatch.setattr(Scratch, "keep", moved)
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    yield
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("name", ["op4_suffix_dedup", "op8_jaccard_rtree", "op11_fptree_search", "op12_conversation_repair", "op13_flat_graph"])
def test_results_while_executors_move(spark, tmp_path, request, name):
    from tspanel.llm import catalog

    for table in ("documents", "benchmark", "conversations", "embeddings"):
        spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").repartition(24).write.parquet(f"{tmp_path}/{table}.parquet")
    want = Counter(tuple(r) for r in catalog.QUERIES[name](spark, str(tmp_path)).collect())
    request.getfixturevalue("moving_executors")
    assert Counter(tuple(r) for r in catalog.QUERIES[name](spark, str(tmp_path)).collect()) == want


def test_representatives_while_executors_move(spark, tmp_path, request):
    from tspanel.llm import jaccard

    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(24).write.parquet(f"{tmp_path}/documents.parquet")

    def kept():
        return Counter(r["doc_id"] for r in jaccard.keep_representatives(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect())

    want = kept()
    request.getfixturevalue("moving_executors")
    assert kept() == want
