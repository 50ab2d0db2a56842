"""The stages of the corpus pipeline on a small table, each on its own input."""

from __future__ import annotations

import hashlib
import os
from collections import Counter
from urllib.parse import urlparse

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tests.llm import brute
from tspanel.llm import bpe, suffix_dedup
from tspanel.llm.common import Scratch, give_back, numbered

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    scratch = Scratch(spark, "pipeline-test")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before, seen = [r.asDict() for r in docs.collect()], {}
    for name, stage in cp.STAGES:
        docs = scratch.keep(stage(spark, docs, FOLDER), name)
        after = [r.asDict() for r in docs.collect()]
        if name != cp.STAGES[-1][0]:
            assert docs.columns == list(cp.COLUMNS)
        seen[name] = (before, after)
        before = after

    old, new = seen["language_id"]
    kept = {r["doc_id"] for r in new}
    assert all(r["doc_id"] in kept for r in old if any(c.isalpha() for c in r["text"]))

    old, new = seen["jaccard"]
    want = {c for _, _, c in brute.components([(r["doc_id"], r["text"]) for r in old])}
    assert Counter(r["doc_id"] for r in new) == Counter(want)

    old, new = seen["suffix_dedup"]
    want = {r["doc_id"]: w for r, w in zip(old, brute.removal([r["text"] for r in old], cp.PASSAGE), strict=True)}
    assert len(new) == len(old)
    for r in new:
        if not want[r["doc_id"]][1]:
            assert hashlib.sha256(r["text"].encode()).hexdigest() == want[r["doc_id"]][3]
        assert r["n_chars"] == len(r["text"])

    old, new = seen["mixing"]
    copies = Counter(r["doc_id"] for r in new)
    assert set(copies) <= {r["doc_id"] for r in old} and max(copies.values()) <= 2
    words = {r["doc_id"]: len(brute.WORD.findall(r["text"])) for r in old}
    targets = brute.sources([(r["source"], words[r["doc_id"]]) for r in old])
    taken = Counter()
    for r in new:
        taken[r["source"]] += words[r["doc_id"]]
    most = max(words.values())
    assert all(abs(taken[s] - t) <= 2 * most for s, (_, t) in targets.items())

    old, new = seen["encode"]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] for r in old}
    assert len(new) == len(old)
    for r in new:
        assert r["token_ids"] == tok.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_stages_on_messy_and_empty_tables(spark, messy, empty):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing columns; and no row at all."""
    for folder in (messy, empty):
        scratch = Scratch(spark, "pipeline-messy")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for name, stage in cp.STAGES:
            before = docs.count()
            docs = scratch.keep(stage(spark, docs, folder), name)
            if name != cp.STAGES[-1][0]:
                assert docs.columns == list(cp.COLUMNS)
            assert docs.count() <= 2 * before
        assert (docs.count() > 0) == (folder == messy)


def test_batches_to_python_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    """10,000 rows are too many at a time where texts are long; the session's own setting comes back."""
    import pyarrow as pa

    spark.range(0, 6000, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 400) AS text").write.parquet(f"{tmp_path}/documents.parquet")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "bytes"])

    monkeypatch.setattr(cp, "STAGES", [("sizes", lambda spark, docs, sf_dir: docs.mapInArrow(sizes, "n long, bytes long"))])
    before = spark.conf.get(cp.BATCH_CONF)
    got = cp.run(spark, str(tmp_path)).collect()
    assert sum(r["n"] for r in got) == 6000 and max(r["bytes"] for r in got) <= cp.BATCH_BYTES + 100_000
    assert spark.conf.get(cp.BATCH_CONF) == before


def _resident_mb() -> float:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6


def test_encoding_keeps_no_free_memory(spark, monkeypatch):
    """Workers outlive a task: what its allocators have free afterwards must not stay with them."""
    tasks = []
    docs = spark.createDataFrame([(0, "")], "doc_id long, text string")
    with monkeypatch.context() as m:
        m.setattr(type(docs), "mapInArrow", lambda self, work, schema: tasks.append(work))
        bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), ids=True, digests=True)
    texts = [" ".join(f"w{i}x{j * 7919 % 9973}" for j in range(400)) for i in range(700)]

    def batches():
        for at in range(0, len(texts), 350):
            yield pa.RecordBatch.from_arrays([pa.array(range(at, at + 350), pa.int64()), pa.array(texts[at:at + 350])], names=["doc_id", "text"])

    give_back()
    assert sum(out.num_rows for out in tasks[0](batches())) == len(texts)
    after = _resident_mb()
    give_back()
    assert after - _resident_mb() < 15


def _folders(spark) -> set[str]:
    return set(os.listdir(urlparse(spark.sparkContext.getCheckpointDir()).path))


def test_only_the_outputs_of_stages_stay(spark, monkeypatch):
    """What stages write for themselves goes when their result is written, or when they fail."""
    stages = [("jaccard", cp.jaccard_groups), ("suffix_dedup", cp.repeated_passages), ("mixing", cp.mix_sources)]
    monkeypatch.setattr(cp, "STAGES", stages)
    before = _folders(spark)
    got = cp.run(spark, FOLDER)
    (left,) = _folders(spark) - before
    assert left.startswith("pipeline-")
    assert sorted(os.listdir(f"{urlparse(spark.sparkContext.getCheckpointDir()).path}/{left}")) == [f"{i:03d}-{n}" for i, (n, _) in enumerate(stages, 1)]
    assert got.count() > 0

    def fails(spark, docs, sf_dir):
        Scratch(spark, "failing").keep(docs, "docs")
        raise ValueError("stage failed")

    monkeypatch.setattr(cp, "STAGES", [("failing", fails)])
    with pytest.raises(ValueError, match="stage failed"):
        cp.run(spark, FOLDER)
    assert not [f for f in _folders(spark) if f.startswith("failing")]
    # outside the pipeline an operator's folder stays, as its lazy result reads from it
    cp.repeated_passages(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"), FOLDER).count()
    assert [f for f in _folders(spark) - before if f.startswith("suffix-dedup-")]


def test_repeats_leave_only_what_their_spans_read(spark):
    """Anchors, surroundings and requests go as soon as nothing reads them."""
    scratch = Scratch(spark, "suffix-test")
    docs = spark.createDataFrame([(i, " ".join(f"shared{j}" for j in range(60)) + f" own{i} " + " ".join(f"w{i}x{j}" for j in range(60))) for i in range(9)], "doc_id long, text string")
    rows = numbered(docs, scratch, text=docs.text)
    spans = suffix_dedup.repeated_spans(rows.select("row", "text"), scratch, 200)
    assert {f[4:] for f in os.listdir(urlparse(scratch.root).path)} == {"rows", "whole", "induced"}
    assert spans.select("row").distinct().count() == 9
