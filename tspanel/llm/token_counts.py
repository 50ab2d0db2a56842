"""Token counts from distinct pre-tokens.

A text's token count is the sum, over its pre-tokens, of how many pieces each
one has. Pieces are counted once per distinct pre-token of the corpus; that
table is joined to the documents' pre-token frequencies and the products are
summed, so no id of any document is ever formed.

Pre-tokens are Zipf-distributed: the ``hot`` most frequent short ones (a table
of at most ``hot`` rows of at most ``hot_bytes`` bytes, whatever the corpus)
travel with the tasks and are added up while the documents are read; all the
others go through the join, where no key is frequent any more.

Defined results: a null text counts as empty (0 bytes, 0 tokens); special
strings inside a text count as one token; repeated rows and repeated or null
ids give one row each; an empty table gives an empty result. Columns of the
input other than those in ``keep`` are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tspanel.llm.bpe import CHUNK_CHARS, ByteBPE, read_spec, split_pretokens
from tspanel.llm.common import Scratch

#: A task's running counts are handed on when they hold so many pre-tokens.
FLUSH = 300_000


def _chunks(column: pa.Array):
    """(index of the first text, texts) of a bounded number of characters each."""
    first, group, size = 0, [], 0
    for i, x in enumerate(column):
        group.append(x.as_py() or "")
        size += len(group[-1])
        if size >= CHUNK_CHARS:
            yield first, group
            first, group, size = i + 1, [], 0
    if group:
        yield first, group


def _plain(bpe: ByteBPE, texts: list[str]):
    """Plain pieces of the texts, whose each is, and the special tokens of each text."""
    pieces, owner, special = [], [], [0] * len(texts)
    for i, text in enumerate(texts):
        for piece, mark in bpe.pieces(text):
            if mark is None:
                pieces.append(piece)
                owner.append(i)
            else:
                special[i] += 1
    return pieces, owner, special


def pretoken_table(docs: DataFrame, text: str, spec) -> DataFrame:
    """Every distinct pre-token of the corpus with its frequency and its number of pieces."""

    def frequencies(batches):
        bpe, seen = ByteBPE(spec.value), Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["pretoken", "freq"])

        for batch in batches:
            for _, texts in _chunks(batch.column(0)):
                seen.update(split_pretokens(_plain(bpe, texts)[0])[0])
                if len(seen) > FLUSH:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    def pieces(batches):
        bpe = ByteBPE(spec.value)
        for batch in batches:
            n = bpe.count_pretokens(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n)], names=["pretoken", "freq", "pieces"])

    freq = docs.select(text).mapInArrow(frequencies, "pretoken string, freq long").groupBy("pretoken").agg(F.sum("freq").alias("freq"))
    return freq.mapInArrow(pieces, "pretoken string, freq long, pieces long")


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 hot: int = 200_000, hot_bytes: int = 32) -> DataFrame:
    """The ``keep`` columns with ``n_bytes`` and ``n_tokens`` of each text (a kept column of either name gives way)."""
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(read_spec(tokenizer))
    keep = tuple(c for c in keep if c not in ("n_bytes", "n_tokens"))
    scratch = Scratch(spark, "token-counts")
    table = scratch.keep(pretoken_table(docs, text, spec), "pretokens")
    short = table.where(F.octet_length("pretoken") <= hot_bytes).orderBy(F.desc("freq"), "pretoken").limit(hot)
    frequent = spark.sparkContext.broadcast({r["pretoken"]: r["pieces"] for r in short.select("pretoken", "pieces").toLocalIterator()})
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("kept"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("pretoken", T.StringType()), T.StructField("freq", T.LongType()),
                           T.StructField("n_bytes", T.LongType()), T.StructField("kept", rows.schema["kept"].dataType)])

    def spread(batches):
        """A row for each text (what the frequent pre-tokens add up to), and one for each other distinct pre-token in it."""
        bpe, known = ByteBPE(spec.value), frequent.value
        for batch in batches:
            for first, texts in _chunks(batch.column(2)):
                plain, owner, base = _plain(bpe, texts)
                tokens, at = split_pretokens(plain)
                rest: list[Counter] = [Counter() for _ in texts]
                for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                    for token, n in Counter(tokens[a:b]).items():
                        size = known.get(token)
                        if size is None:
                            rest[owner[k]][token] += n
                        else:
                            base[owner[k]] += size * n
                ids = batch.column(1).slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([str(x) for x in ids], pa.string()), pa.array(base, pa.int64()),
                     pa.array([len(x.encode()) for x in texts], pa.int64()), batch.column(0).slice(first, len(texts))], names=schema.names)
                n = sum(map(len, rest))
                if n:
                    who = np.repeat(ids.to_numpy(), [len(r) for r in rest])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(who), pa.array([t for r in rest for t in r], pa.string()), pa.array([v for r in rest for v in r.values()], pa.int64()),
                         pa.nulls(n, pa.int64()), pa.nulls(n, batch.schema.field(0).type)], names=schema.names)

    parts = rows.mapInArrow(spread, schema)
    # a text's own row (n_bytes is set) brings its sum as it is: its key is only there to spread it
    joined = parts.join(table.select("pretoken", "pieces"), "pretoken", "left")
    size = F.when(F.col("n_bytes").isNotNull(), F.col("freq")).otherwise(F.col("freq") * F.col("pieces"))
    summed = joined.groupBy("row").agg(F.first("kept", ignorenulls=True).alias("kept"), F.max("n_bytes").alias("n_bytes"), F.sum(size).alias("n_tokens"))
    return summed.select(*[F.col("kept")[c].alias(c) for c in keep], "n_bytes", "n_tokens")
