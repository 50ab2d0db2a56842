from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators add or use inside; a table may have them already.
CLASH = ("row", "key", "size", "score", "lang_pred", "n_tokens", "n_bytes", "range", "copy", "kept", "next", "component_id", "taken", "path", "license", "token", "n")


def messy_rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, repeated rows and ids, near copies, repeated passages and a long text."""
    rng = random.Random(5)
    vocab = {"en": ["the", "and", "that", "whether", "thing", "other", "with"], "de": ["und", "nicht", "für", "schön", "straße", "über", "dass"],
             "fr": ["été", "où", "être", "français", "garçon", "avec", "pour"]}
    rows, passage = [], " ".join(f"shared{i}" for i in range(70))
    for i in range(90):
        lang = ["en", "de", "fr"][i % 3]
        words = [rng.choice(vocab[lang]) + str(rng.choice(["", "en", "er", "le"])) for _ in range(rng.randint(1, 120))]
        text = " ".join(words)
        if i % 9 == 0:
            text += "\n" + passage
        rows.append((i, text, lang, f"s{i % 4}" if i % 4 else "s0", len(text)))
    copy = rows[10][1]
    rows += [(200 + i, copy, "de", "s0", len(copy)) for i in range(6)]
    base = rows[12][1].split() + [f"w{i}" for i in range(60)]
    for i in range(8):
        near = list(base)
        near[3 * i] = f"edit{i}"
        rows.append((300 + i, " ".join(near), "en", "s1", 1))
    rows += [(400, None, None, None, None), (401, "", None, None, None), (402, " \n\t ", "en", None, 4), (403, "... !!! 123", "en", "s9", 11), (404, "one two", None, "s1", 7),
             (404, "one two", None, "s1", 7), (404, "another text of the same id", "en", "s1", 3), (None, "a text without an id but with words in it", "en", "s2", 1),
             (None, None, None, None, None), (405, "word " * 40_000, "en", "s3", 1), (406, "don't you'll 'S  x　y<|endoftext|>z 12ab\n\n q", "en", "s3", 1),
             (407, "x" * 30_000, "en", "s3", 1), (408, "Some notes.\nReleased under the MIT License.\nMore of it.", "en", "s1", 1), (409, "Licensed under the Apache License, Version 2.0.", "en", "s0", 1)]
    return rows


@pytest.fixture(scope="session")
def messy(spark, tmp_path_factory):
    """Folder with the messy documents (and columns of clashing names), labels and embeddings."""
    from pyspark.sql import functions as F

    out = tmp_path_factory.mktemp("messy")
    docs = spark.createDataFrame(messy_rows(), SCHEMA)
    docs.select("*", *[F.lit("x").alias(c) for c in CLASH]).repartition(3).write.parquet(f"{out}/documents.parquet")
    labels = [(i, 1, int(i % 3 == 0)) for i in range(90)] + [(1000, None, None), (None, 1, 1), (5, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return str(out)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("empty")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{out}/embeddings.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{out}/conversations.parquet")
    return str(out)
