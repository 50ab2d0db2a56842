"""Each document operator against plain Python on a messy table, and on an empty one."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute
from tests.llm.conftest import messy_rows
from tspanel.llm import ann, catalog, common, components, fingerprint, jaccard, langid, licenses, mixing, suffix_dedup, toxicity
from tspanel.llm.common import Scratch, drawn, with_hashes

ROWS = messy_rows()


def run(spark, name, folder):
    return [tuple(r) for r in catalog.QUERIES[name](spark, folder).collect()]


def same(got, want):
    assert Counter(got) == Counter(want)


def test_language_id(spark, messy):
    got = run(spark, "op1_language_id", messy)
    assert len(got) == len(ROWS)
    assert Counter((g[0], g[1]) for g in got) == Counter((d, zlib.crc32(str(d if d is not None else "").encode()) % 4 == 2) for d, *_ in ROWS)
    pred = {g[0]: g[2] for g in got}
    assert pred[400] == pred[401] == pred[402] == pred[403] == "und"
    labelled = [(pred[d], lang) for d, t, lang, *_ in ROWS if d is not None and d < 90]
    assert sum(a == b for a, b in labelled) >= 0.95 * len(labelled)
    assert all(0 <= g[3] <= 1 for g in got)


def plain_grams(text):
    """Counter of the one to three characters of marked runs of letters; (length, characters) sorts ties."""
    out, runs = Counter(), re.findall(r"[^\W\d_]+", (text or "").lower())
    runs = ["".join(c for c in r if c.isalpha()) for r in runs]
    for r in runs:
        marked = "\x01" + r + "\x01"
        out.update((1, c) for c in r)
        out.update((2, marked[i:i + 2]) for i in range(len(marked) - 1))
        out.update((3, marked[i:i + 3]) for i in range(len(marked) - 2))
    return out


def plain_order(grams):
    return [g for g, _ in sorted(grams.items(), key=lambda c: (-c[1], c[0]))][:400]


def test_language_id_equals_out_of_place_distances(spark, messy):
    """Every text against profiles made in plain Python (the messy table is smaller than the sample's bound)."""
    totals = {}
    for d, t, lang, *_ in ROWS:
        if t is not None and lang is not None and zlib.crc32(str(d if d is not None else "").encode()) % 4 != 2:
            totals.setdefault(lang, Counter()).update(plain_grams(t))
    profiles = {lang: {g: i for i, g in enumerate(plain_order(c))} for lang, c in totals.items()}
    want = Counter()
    for d, t, *_ in ROWS:
        own = plain_order(plain_grams(t))
        away = {lang: sum(min(400, abs(ranks[g] - i)) if g in ranks else 400 for i, g in enumerate(own)) for lang, ranks in profiles.items()}
        best = min(away, key=lambda x: (away[x], x))
        want[(d, best, round(1 - away[best] / (400 * len(own)), 12)) if own else (d, "und", 0.0)] += 1
    assert Counter((g[0], g[2], round(g[3], 12)) for g in run(spark, "op1_language_id", messy)) == want


def test_profile_distance_by_hand():
    ident = langid.Identifier({"a": [ord("x"), ord("y")], "b": [ord("y"), ord("x")]}, 2)
    # x is the most frequent n-gram of "xxx y", so profile a is in place
    name, score = ident.predict("xxx")
    assert name == "a" and 0 <= score <= 1


def test_byte_bpe_and_counts(spark, messy):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want2, want3 = [], []
    for d, t, *_ in ROWS:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        text = tok.decode(ids, skip_special_tokens=False)
        want2.append((d, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        want3.append((d, len((t or "").encode()), len(ids), len(ids) > 512))
    same(run(spark, "op2_bpe", messy), want2)
    same(run(spark, "op3_token_counts", messy), want3)


def test_character_classes_agree_with_the_tokenizer():
    from tspanel.llm.bpe import ByteBPE, read_spec
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, own = Tokenizer.from_file(path), ByteBPE(read_spec(path))
    texts = [f"a{c}a1{c}1!{c}! {c}" for c in map(chr, [*range(0x3100), *range(0xE000, 0xE010), *range(0xFE00, 0x10000), *range(0x1D400, 0x1D500), *range(0x1F600, 0x1F650)])]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_decoding_round_trip(spark, messy):
    from tspanel.llm import bpe
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{messy}/documents.parquet").select("doc_id", "text")
    back = bpe.decode_documents(bpe.encode_documents(docs, path), path)
    same([(r["doc_id"], r["text"]) for r in back.collect()], [(d, t or "") for d, t, *_ in ROWS])


@pytest.mark.parametrize("unit", [20_000, 3])
def test_repeats(spark, messy, unit):
    docs = spark.read.parquet(f"{messy}/documents.parquet")
    got = [tuple(r) for r in suffix_dedup.removal_digests(docs, unit=unit).collect()]
    want = brute.removal([t for _, t, *_ in ROWS], 400)
    same(got, [(d, *w) for (d, *_), w in zip(ROWS, want, strict=True)])


def test_repeats_of_small_alphabets(spark):
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("ab"), rng.integers(0, 300))) for _ in range(40)]
    texts += ["ab" * 100, "aaab" * 40, texts[0][:80] + texts[1][:90]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for length, k in ((12, 4), (20, 8)):
        got = {r[0]: tuple(r)[1:] for r in suffix_dedup.removal_digests(docs, length=length, k=k).collect()}
        assert [got[i] for i in range(len(texts))] == brute.removal(texts, length)


def test_pieces_cut_no_run(monkeypatch):
    rng = np.random.default_rng(6)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    offsets = np.array([0, 1300, 1310, 4100, 5000])

    def runs():
        return sorted(r for part in suffix_dedup.anchors(data, offsets, 40, 8) for r in zip(*(x.tolist() for x in part), strict=True))

    whole = runs()
    for piece in (97, 256, 1024):
        monkeypatch.setattr(suffix_dedup, "PIECE", piece)
        assert runs() == whole


def test_fingerprints(spark, messy):
    got = run(spark, "op6_threshold_sketch", messy)
    order = sorted(((d is not None, d or 0), t or "") for d, t, *_ in ROWS)
    assert len(got) == len(ROWS)
    by_text = {}
    for g in got:
        if g[0] is not None and g[0] < 400:
            text = next(t for d, t, *_ in ROWS if d == g[0])
            assert g[1] == len(text)
            by_text.setdefault(text, set()).add(g[3])
            after = next(t for d, t, *_ in sorted((r for r in ROWS if r[0] is not None and r[0] < g[0]), key=lambda r: -r[0]) or [(0, "", 0)]) if g[0] else None
            if after is not None:
                half = len(text) // 2
                edited = text[:len(text) - half] + after[:half]
                assert g[2] == hashlib.sha256(edited.encode()).hexdigest()
                if text == edited:
                    assert g[5] == 1.0
        assert 0 <= g[5] <= 1 and 0 <= g[6] <= 1
    assert all(len(v) == 1 for v in by_text.values()) and order


def test_next_row_across_ranges(spark):
    docs = spark.createDataFrame([(i * 7, f"text {i}") for i in range(500)], "doc_id long, text string")
    rows = fingerprint.with_next(docs, rows_per_range=20).select("doc_id", "next.text").collect()
    assert {r[0]: r[1] for r in rows} == {i * 7: f"text {(i - 1) % 500}" for i in range(500)}


def test_sketches_merge(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(90))
    row = spark.createDataFrame([(a, b)], "a string, b string").select(
        fingerprint.sketch(F.col("a")).alias("x"), fingerprint.sketch(F.col("b")).alias("y")) \
        .select(fingerprint.containment(F.col("x"), fingerprint.merge(F.col("x"), F.col("y"))), fingerprint.likeness(F.col("x"), F.col("y"))).first()
    assert row[0] == 1.0 and row[1] == 0.0


def test_toxicity(spark, messy):
    got = run(spark, "op7_toxicity", messy)
    assert len(got) == len(ROWS) and all(0 <= g[2] <= 1 and g[3] == int(g[2] >= 0.3) for g in got)


def test_samples_hold_a_copied_text_once(spark):
    """A text that is most of its class is always drawn, once, with the weight of its copies."""
    rows = [("hot text of the class", 1)] * 4000 + [(f"awful thing {i}", 1) for i in range(1000)]
    df = spark.createDataFrame(rows, "text string, toxic int")
    got = drawn(with_hashes(df), ["toxic"], F.lit(0.02), 100).collect()
    hot = [r for r in got if r["text"] == "hot text of the class"]
    assert [(r["copies"], r["chance"]) for r in hot] == [(4000, 1.0)] and len({r["text"] for r in got}) == len(got) < 60
    assert abs(sum(r["copies"] / r["chance"] for r in got) - 5000) < 1500
    # a profile is not filled by one text
    texts = [("zzz qqq", "xx")] * 3000 + [(f"alpha beta {chr(97 + i % 20)}{chr(97 + i // 20 % 20)}", "xx") for i in range(400)]
    profile = langid.fit_profiles(spark.createDataFrame(texts, "text string, lang string"), cfg=langid.LangConfig(max_docs=200))["xx"]
    assert ord("z") in profile and ord("b") in profile


def test_counterfactual_penalty(spark):
    """Groups that stand in many toxic sentences are not themselves toxic."""
    rows = [(f"the {g} are {w} people {i}", int(w == "awful")) for i in range(30) for g, w in
            (("muslims", "awful"), ("muslims", "awful"), ("christians", "kind"), ("christians", "kind"), ("christians", "awful"), ("muslims", "kind"))]
    df = spark.createDataFrame(rows, "text string, toxic int")
    fair = toxicity.fit(df, toxicity.ToxicConfig(min_gain=0.0, fairness=50.0))
    plain = toxicity.fit(df, toxicity.ToxicConfig(min_gain=0.0, fairness=0.0))

    def gap(m):
        return abs(m.score("we met muslims today") - m.score("we met christians today"))

    assert gap(fair) < 0.5 * gap(plain)
    assert fair.score("the people are awful") > 0.5 > fair.score("the muslims are kind")
    assert toxicity.swapped({"women", "x"}, toxicity.IDENTITY_GROUPS) == {"men", "x"}


@pytest.mark.parametrize("unit", [4096, 4])
def test_jaccard(spark, messy, monkeypatch, unit):
    monkeypatch.setattr(jaccard, "UNIT", unit)
    same(run(spark, "op8_jaccard_rtree", messy), brute.components([(d, t) for d, t, *_ in ROWS]))


def test_count_tree_loses_no_pair():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 62, rng.integers(5, 400)).astype(np.uint64)) for _ in range(60)]
    sets += [np.unique(np.concatenate([s[rng.random(len(s)) < 0.93], rng.integers(0, 1 << 62, 4).astype(np.uint64)])) for s in sets]
    points, sizes = np.stack([jaccard.point(s) for s in sets]), np.array([len(s) for s in sets])
    who, at, bound = jaccard.CountTree(points, sizes).search(points, sizes)
    found = dict(zip(zip(who.tolist(), at.tolist(), strict=True), bound.tolist(), strict=True))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            shared = len(np.intersect1d(a, b))
            if 100 * shared >= 75 * (len(a) + len(b) - shared):
                assert found[i, j] >= shared
    assert len(found) < len(sets) ** 2 / 4


def test_jaccard_pair_hidden_from_every_center(spark, monkeypatch):
    """B and C link, but every first shingle that they share also stands in a class before them that links with neither."""
    b = [f"b{i}" for i in range(64)]
    fill = [[f"f{j}x{i}" for i in range(31)] for j in range(2)]
    docs = [(1, b), (2, [*b[:-1], "other"]), (3, b[:34] + fill[0]), (4, fill[1] + b[30:])]
    docs += [(10 + n, fill[0] + [f"m{n}x{i}" for i in range(n)] + fill[1]) for n in (50, 150, 300)]
    rows = [(d, " ".join(w)) for d, w in docs]
    classes = jaccard._classes
    monkeypatch.setattr(jaccard, "_classes", lambda *a: classes(*a).withColumn("cid", F.col("cid") + F.when(F.col("n") == 60, 1 << 40).otherwise(0)))
    got = jaccard.components(spark.createDataFrame(rows, "doc_id long, text string"))
    same([tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()], brute.components(rows))


def test_jaccard_jobs_do_not_follow_the_partitions(spark, messy, monkeypatch):
    """Tables of fixed size come to the driver in one job each; rounds that find no link leave the components alone."""
    calls, connect = [], components.connected_components
    monkeypatch.setattr(jaccard, "connected_components", lambda *a: calls.append(1) or connect(*a))
    b = [f"b{i}" for i in range(64)]
    docs = spark.createDataFrame([(1, " ".join(b)), (2, " ".join([*b[:-1], "other"])), (3, " ".join(f"c{i}" for i in range(64)))], "doc_id long, text string")
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(k) for k in keys]
    jobs = {}
    try:
        spark.conf.set(keys[1], "false")
        for n in (4, 40):
            spark.conf.set(keys[0], str(n))
            spark.sparkContext.setJobGroup(f"jaccard-{n}", "")
            same([tuple(r) for r in jaccard.components(docs).select("doc_id", "component_id").collect()], [(1, 1), (2, 1), (3, 3)])
            jobs[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"jaccard-{n}"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in zip(keys, before, strict=True):
            spark.conf.set(k, v)
    assert jobs[4] > 20 and jobs[40] < jobs[4] + 30, jobs
    assert len(calls) == 2, calls


def test_representatives(spark, messy):
    docs = spark.read.parquet(f"{messy}/documents.parquet").select("doc_id", "text")
    kept = Counter(r["doc_id"] for r in jaccard.keep_representatives(docs).collect())
    # two components can be named alike when an id repeats: their texts tell them apart
    named = [(d, t, n, c) for (d, t, *_), (_, n, c) in zip(ROWS, brute.components([(d, t) for d, t, *_ in ROWS]), strict=True)]
    assert kept == Counter([d for d, _, n, _ in named if not n] + [d for d, _ in {(d, t) for d, t, n, c in named if n and d == c}])


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (3, 2)]
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"))
    assert {tuple(r) for r in got.collect()} == {(i, 0) for i in range(41)} | {(100 + i, 100) for i in range(30)}


def test_mixing(spark, messy):
    got = run(spark, "op9_mixing", messy)
    size = {d: len(brute.WORD.findall(t or "")) for d, t, *_ in ROWS if d is not None and d != 404}
    assert len(got) == len(ROWS) and all(g[1] == size[g[0]] for g in got if g[0] in size) and all(0 <= g[4] <= 2 * g[1] for g in got)
    want = brute.sources([(s, len(brute.WORD.findall(t or ""))) for _, t, _, s, _ in ROWS])
    mixed = mixing.mix(spark.read.parquet(f"{messy}/documents.parquet")).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("source_size").alias("n")).collect()
    for r in mixed:
        n, target = want[r["source"]]
        assert r["n"] == n and abs(r["target"] - target) <= 1e-6 * max(1, target) and abs(r["taken"] - target) <= 8 + 0.001 * target
    assert Counter(run(spark, "op9_mixing", messy)) == Counter(got)


@pytest.mark.parametrize("slots", [1 << 20, 300])
def test_mixing_equals_the_schedule_walked_slot_by_slot(spark, messy, slots):
    docs = spark.read.parquet(f"{messy}/documents.parquet")
    got = Counter((r["doc_id"], r["size"], r["taken"]) for r in mixing.mix(docs, slots=slots).collect())
    assert got == Counter(brute.mixed([(d, t, s) for d, t, _, s, _ in ROWS], slots, mixing.FINEST))


def test_small_sources_of_a_large_mix(spark):
    """Sources of a few words get their targets at any size of the corpus, and the schedule does not grow with it."""
    sizes = [("a", 3_000_000_000), ("b", 1000), ("c", 1_799_990_000), ("d", 2000), ("e", 5000), (None, 2000)]
    for scale in (1, 10_000):
        rows = [(s, n * scale if n > 10_000 else n) for s, n in sizes]
        targets = mixing.source_targets(spark.createDataFrame(rows, "source string, source_size long"))
        got = {r["source"]: r["n"] for r in mixing.schedule(targets).groupBy("source").agg(F.count("*").alias("n")).collect()}
        for r in targets.collect():
            assert abs(got[r["source"]] * r["block"] - r["target"]) <= 8 + 0.01 * r["target"]
        assert sum(got.values()) == targets.first()["n_slots"] <= (1 << 20) + 2 * mixing.FINEST * len(sizes)


def test_schedule_is_low_discrepancy(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 3000), (None, 500), ("c", 0)], "source string, source_size long")
    targets = mixing.source_targets(sizes)
    plan = [(r["slot"], r["source"], r["turn"]) for r in mixing.schedule(targets).orderBy("slot").collect()]
    want = {r["source"]: r["target"] / r["total"] for r in targets.collect()}
    assert [p[0] for p in plan] == list(range(len(plan))) and len(plan) == 6750
    seen = Counter()
    for i, (_, s, turn) in enumerate(plan):
        assert turn == seen[s]
        seen[s] += 1
        assert abs(seen[s] - (i + 1) * want[s]) < 8


def test_nearest_neighbours(spark, tmp_path):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 24)).astype(np.float32)
    x[100:140] = x[3]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(2000, None, 0), (2050, [0.0] * 24, 0), (2100, [float("nan")] + [1.0] * 23, 0), (2150, [float("inf")] * 24, 0), (None, [1.0] * 24, 0), (2200, [1.0, None] + [1.0] * 22, 0), (2250, [], 0), (2300, [1.0, 2.0], 0), rows[50]]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {}
    for q, rank, v, s in sorted(run(spark, "op5_nn_descent", str(tmp_path))):
        got.setdefault(q, []).append((rank, v, s))
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    assert sorted(got) == list(range(0, 900, 50))
    hits = 0
    for q, found in got.items():
        sims = u @ u[q]
        best = sorted((-round(float(s), 12), i) for i, s in enumerate(sims) if i != q)[:5]
        hits += len({i for _, i in best} & {v for _, v, _ in found})
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5] and all(abs(s - sims[v]) < 1e-9 for _, v, s in found)
    assert hits >= 0.9 * 5 * len(got)
    assert [v for _, v, _ in got[100]] == [3, 101, 102, 103, 104]


def test_nearest_among_noisy_copies(spark):
    """Thousands of nearly equal vectors, whose cosines differ by far less than a half float tells."""
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=64) + noise * rng.normal(size=(n, 64)) for noise, n in ((1e-2, 1500), (1e-3, 2500))]).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for q, v in ann.nearest(table, F.col("vec_id") % 100 == 0).select("query_id", "vec_id").collect():
        got.setdefault(q, set()).add(v)
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    for part in (range(0, 1500, 100), range(1500, 4000, 100)):
        hits = 0
        for q in part:
            sims = u @ u[q]
            sims[q] = -2
            hits += len(got[q] & set(np.argsort(-sims)[:5].tolist()))
        assert hits >= 0.9 * 5 * len(part)


def test_ties_beyond_the_pool(spark):
    """More nodes of the k-th score than a pool holds: the smaller ids still count."""
    rng = np.random.default_rng(9)
    x = np.zeros((300, 304))
    x[:, 0] = 1.0
    x[np.arange(300), 1 + rng.permutation(300)] = 1.0
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.nearest(table, F.col("vec_id") % 100 == 50).orderBy("query_id", "rank").select("query_id", "vec_id").collect()
    assert [tuple(r) for r in got] == [(q, v) for q in (50, 150, 250) for v in range(5)]


def test_few_rounds_and_steps(spark, monkeypatch):
    """Every round of the graph and every step of the search costs whole exchanges, however small the table is."""
    kept, keep = Counter(), common.Scratch.keep

    def counted(self, df, name):
        kept[name] += 1
        return keep(self, df, name)

    monkeypatch.setattr(common.Scratch, "keep", counted)
    x = np.random.default_rng(11).normal(size=(1500, 24)).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for q, v in ann.nearest(table, F.col("vec_id") % 50 == 0).select("query_id", "vec_id").collect():
        got.setdefault(q, set()).add(v)
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    sims = u @ u.T - 2 * np.eye(len(u))
    assert sum(len(got[q] & set(np.argsort(-sims[q])[:5].tolist())) for q in got) >= 0.9 * 5 * 30
    assert kept["graph"] + kept["pool"] <= 12, kept


def test_few_vectors(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in ann.nearest(table, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert [g[:3] for g in got] == [(0, 1, 1), (0, 2, 2)] and abs(got[0][3] - 0.5 ** 0.5) < 1e-12


def test_licences(spark, messy):
    got = {g[0]: g for g in run(spark, "op10_license_scan", messy) if g[0] is not None}
    assert got[408][2] == "MIT" and got[409][2] == "Apache-2.0"
    assert sum(g[2] is not None for g in got.values()) == 2
    # 409 is little but a licence: its directory s0/0/4 has it
    assert got[409][1] == "s0/0/4/409" and got[400][4] is None


def test_inheritance_and_cosines(spark):
    files = [("p/LICENSE", "Released under the MIT License."), ("p/a.c", "code"), ("p/q/b.c", "code"), ("p/q/r/c.c", "x\nLicensed under CC BY-NC 4.0.\n" + "y z " * 50),
             ("p/q/r/d.c", None), ("p/q/LICENSE", "Licensed under the Apache License, Version 2.0."), ("other/e.c", ""), ("top", "no folder"), (None, "no path")]
    out = licenses.scan_tree(spark.createDataFrame(files, "path string, text string")).collect()
    got = {r["path"]: (r["license"], r["inherited_from"]) for r in out}
    assert got == {"p/LICENSE": ("MIT", None), "p/a.c": ("MIT", "p"), "p/q/b.c": ("Apache-2.0", "p/q"), "p/q/r/c.c": ("CC-BY-NC-4.0", None), "p/q/r/d.c": ("Apache-2.0", "p/q"),
                   "p/q/LICENSE": ("Apache-2.0", None), "other/e.c": (None, None), "top": (None, None), None: (None, None)}
    held = licenses.Templates({}, 1.0, (("A", "x y"), ("B", "y z z")))
    score, name = held.best(["y", "z"])
    assert name == "B" and abs(score - 3 / (2 ** 0.5 * 5 ** 0.5)) < 1e-12


def test_full_licence_files_and_wrapped_headers(spark):
    full = dict(licenses.full_texts())
    files = [(f"{name}/LICENSE", f"Copyright (c) 2021 Some Holder. All rights reserved.\n\n{text}") for name, text in full.items()]
    files += [(f"{name}/src/{i}.c", f"int f{i}(void) {{ return {i}; }}") for name in full for i in range(3)]
    wrapped = {"BSD-3-Clause": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:",
               "GPL-3.0": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
               "Apache-2.0": "Licensed under the Apache License,\nVersion 2.0 (the License);\nyou may not use this file\nexcept in compliance with the License.",
               "MPL-2.0": "This Source Code Form is subject to the terms\nof the Mozilla Public License,\nv. 2.0.",
               "MIT": "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated\ndocumentation files"}
    code = "\n".join(f"total{i} = first{i} + second{i}" for i in range(40))
    for mark in ("# ", " * ", "// ", "dnl "):
        files += [(f"code/{name}{mark.strip()[:1]}.py" if mark != "// " else f"code/{name}-slash.py", code + "\n" + "\n\n".join(mark + x for x in text.split("\n")) + "\n" + code)
                  for name, text in wrapped.items()]
    got = {r["path"]: r for r in licenses.scan_tree(spark.createDataFrame(files, "path string, text string")).collect()}
    for name in full:
        assert got[f"{name}/LICENSE"]["license"] == name and got[f"{name}/LICENSE"]["is_license_file"]
        assert [(got[f"{name}/src/{i}.c"]["license"], got[f"{name}/src/{i}.c"]["inherited_from"]) for i in range(3)] == [(name, name)] * 3
    for path, r in got.items():
        if path.startswith("code/"):
            assert r["own_license"] == next(n for n in full if path.startswith(f"code/{n}")) and not r["is_license_file"]


def plain_scan(files: list[tuple]) -> dict:
    """path -> (own licence, score, licence, inherited from): every line, every run and the whole text by definition."""
    lined = {p: [re.findall(r"[^\W_]+", re.sub(r"^\s*(?:dnl|rem)\b", "", x.lower())) for x in (t or "").split("\n")] for p, t in files}
    notices = [(n, Counter(licenses.terms(t))) for n, t in licenses.TEMPLATES]
    whole = notices + [(n, Counter(licenses.terms(t))) for n, t in licenses.full_texts()]
    known = {w for _, c in whole for w in c}
    idf = {w: math.log((1 + len(files)) / (1 + sum((t is not None) and w in licenses.terms(t) for _, t in files))) + 1 for w in known}
    rare = math.log((1 + len(files)) / 2) + 1

    def cosines(words, templates):
        def vector(c):
            return {w: n * idf.get(w, rare) for w, n in c.items()}

        a = vector(Counter(words))
        for name, c in templates:
            b = vector(c)
            dot = sum(x * b.get(w, 0.0) for w, x in a.items())
            if dot:
                yield dot / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values())), name

    def best(found):
        return min(found, key=lambda c: (-round(c[0], 9), c[1]), default=(0.0, None))

    own, holders = {}, {}
    for p, lines in lined.items():
        of_all = best(cosines([w for x in lines for w in x], whole))
        full = [x for x in lines if x]
        runs = [[w for x in full[i:j] for w in x] for i in range(len(full)) for j in range(i + 1, min(len(full), i + licenses.RUN) + 1)]
        own[p] = best([of_all, *(c for r in runs for c in cosines(r, notices) if c[0] >= licenses.THRESHOLD), *(c for x in full for c in cosines(x, notices))])
        if of_all[0] >= licenses.THRESHOLD and "/" in p:
            holders.setdefault(p.rpartition("/")[0], []).append((-round(own[p][0], 9), own[p][1], p))
    out = {}
    for p, (score, name) in own.items():
        name = name if score >= licenses.THRESHOLD else None
        above = ["/".join(p.split("/")[:n]) for n in range(p.count("/"), 0, -1)]
        near = next((d for d in above if d in holders), None)
        out[p] = (name, round(score, 9), name or (near and min(holders[near])[1]), near if name is None else None)
    return out


def test_licences_equal_plain_scan(spark):
    rng = random.Random(8)
    words = "the license this file is under terms software use free public may not code data line total use of and".split()
    pieces = [t for _, t in licenses.TEMPLATES]
    files = []
    for i in range(60):
        lines = [" ".join(rng.choices(words, k=rng.randint(0, 9))) for _ in range(rng.randint(0, 30))]
        if i % 3 == 0:
            notice = rng.choice(pieces).split()
            cut = sorted(rng.sample(range(1, len(notice)), min(len(notice) - 1, rng.randint(0, 4))))
            wrapped = [" ".join(notice[a:b]) for a, b in zip([0, *cut], [*cut, len(notice)], strict=True)]
            lines = wrapped if i % 12 == 0 else lines[:9] + wrapped * rng.randint(1, 3) + lines[9:]
        files.append((f"r{i % 2}/" + "/".join(f"d{rng.randint(0, 2)}" for _ in range(i % 4)) + f"/f{i}", "\n".join(lines)))
    files += [("r0/none", None), ("r1/empty", ""), ("top", pieces[0])]
    got = {r["path"]: (r["own_license"], round(r["own_score"], 9), r["license"], r["inherited_from"]) for r in licenses.scan_tree(spark.createDataFrame(files, "path string, text string")).collect()}
    want = plain_scan(files)
    for p in want:
        assert got[p][0] == want[p][0] and abs(got[p][1] - want[p][1]) < 2e-9 and got[p][2:] == want[p][2:], p
    assert sum(w[0] is not None for w in want.values()) >= 15 and sum(w[3] is not None for w in want.values()) >= 3


def test_licence_runs_of_many_equal_lines():
    """20,000 equal or alternating lines take seconds, whatever the blocks."""
    held = licenses.Templates({}, 2.0)
    wrapped = ["This Source Code Form is subject to the terms", "of the Mozilla Public License,", "v. 2.0."]
    for lines in (["under the license version"] * 20_000, wrapped * 7000, [f"{x} {i}" for i in range(5000) for x in wrapped]):
        began = time.monotonic()
        score, _ = held.best_run([licenses.terms(x) for x in lines])
        assert score > 0.5 and time.monotonic() - began < 60


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_empty_tables(spark, empty, name):
    assert run(spark, name, empty) == []
