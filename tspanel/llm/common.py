"""Helpers shared by the document operators.

Operators that run numpy inside tasks take ``RecordBatch`` iterators
(``mapInArrow``) and cut every batch into slices of bounded size, so a task's
memory depends on the longest single text, not on the number of rows.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tspanel.session import ensure_checkpoint_dir

#: Texts handed to numpy at a time; a longer single text is a slice of its own.
SLICE_BYTES = 1 << 20

#: Rows of a few numbers that may be broadcast.
SMALL = 1_000_000

#: A word: a run of bytes other than blank and the controls 9 to 13.
WORD = "[^\\x20\\x09-\\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id):
    """crc32 of the id's text leaves 2 on division by 4 (a null id counts as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def with_hashes(rows: DataFrame) -> DataFrame:
    """``rows`` with h1, h2 (a text's name) and spread (its place in 0..1)."""
    spread = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rows.withColumn("h1", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit(1), F.col("text"))).withColumn("spread", spread)


def drawn(named: DataFrame, keys: list[str], share, bound: int, value: str = "text") -> DataFrame:
    """A sample of the distinct (text, keys) of ``named`` (rows with hashes), each with its ``copies``, the ``chance`` it was drawn with and ``value``.

    A text is drawn by its hash with the chance ``share`` (a column over ``keys``) times its copies, so ``share``
    of the rows bounds the texts expected (``bound``: up to ``SMALL`` of them their hashes are broadcast), and no text comes more than once.
    """
    names = ["h1", "h2", *keys]
    sizes = named.groupBy(*names, "spread").agg(F.count("*").alias("copies")).withColumn("chance", F.least(F.lit(1.0), F.col("copies") * share))
    chosen = sizes.where(F.col("spread") < F.col("chance")).drop("spread")
    found = named.drop("spread").join(F.broadcast(chosen) if bound <= SMALL else chosen, names)
    return found.groupBy(*names, "copies", "chance").agg(F.first(value).alias(value)).drop("h1", "h2")


#: The scratches opened inside the ``released`` block that runs, if any.
_opened: ContextVar[list[Scratch] | None] = ContextVar("opened", default=None)


class Scratch:
    """A folder of this run under the shared checkpoint folder.

    ``keep`` writes a frame as Parquet there and reads it back, which cuts its
    lineage on storage that survives lost executors; ``drop`` deletes one that
    no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        opened = _opened.get()
        if opened is not None:
            opened.append(self)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        self._delete(*[df._scratch_path for df in frames])

    def clear(self) -> None:
        """Deletes the whole folder."""
        self._delete(self.root)

    def _delete(self, *paths: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for p in paths:
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(conf).delete(path, True)
        gc.collect()
        jvm.System.gc()        # lets Spark's cleaner remove the shuffle files of plans that are done


@contextmanager
def released() -> Iterator[None]:
    """Deletes the scratches opened inside on leaving: for steps whose result stands elsewhere by then."""
    opened: list[Scratch] = []
    outer = _opened.set(opened)
    try:
        yield
    finally:
        _opened.reset(outer)
        for scratch in opened:
            scratch.clear()


def numbered(docs: DataFrame, scratch: Scratch, **columns) -> DataFrame:
    """The given columns of ``docs`` with ``row``, written once: a number made anew in each job would follow how the scan happens to be split."""
    return scratch.keep(docs.select(*[c.alias(n) for n, c in columns.items()], F.monotonically_increasing_id().alias("row")), "rows")


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of ``batch`` a slice at a time: (rows, UTF-8 bytes, offsets); a null text has no bytes."""
    texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at, n = 0, len(texts)
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        to = min(to, n)
        yield batch.slice(at, to - at), data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def give_back() -> None:
    """Hands free memory of this process back to the system; the allocators of Arrow and of C keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # of glibc only
    if trim:
        trim(0)


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` that gives free memory back when a task ends: workers stay, also idle, while later stages run beside them."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


# --- 64-bit hashing of byte strings inside numpy arrays ---------------------

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_POWERS: dict[int, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (xor-shift and multiply)."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _powers(base: int, n: int) -> np.ndarray:
    got = _POWERS.get(base)
    if got is None or len(got) < n:
        size = 1 << max(16, (n - 1).bit_length())
        got = np.empty(size, np.uint64)
        got[0] = 1
        done = 1
        while done < size:
            step = _U(pow(base, done, 1 << 64))
            got[done:2 * done] = got[:done] * step
            done *= 2
        if size <= 1 << 22:
            _POWERS[base] = got
    return got[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums whose differences hash every substring (see ``span_hash``)."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes start..end, the same wherever they stand."""
    raw = prefix[end] - prefix[start]
    return mix64(raw * _powers(_INV, len(prefix))[start] + (end - start).astype(np.uint64) * _U(0xA24BAED4963EE407))


# --- words and word shingles ------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased (A-Z) words of a slice, and where each text's words begin."""
    inside = ~_SPACE[data]
    here, last = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    here[:-1] = inside
    last[1:] = inside
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    starts = np.flatnonzero(here & (~last | border))
    ends = np.flatnonzero(last & (~here | border))
    hashes = span_hash(prefix_hash(_LOWER[data]), starts, ends)
    return hashes, np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each text; fewer words make one shingle."""
    words, at = word_hashes(data, offsets)
    if len(words) >= k:
        joint = np.zeros(len(words) - k + 1, np.uint64)
        for j in range(k):
            joint = mix64(joint + words[j:len(words) - k + 1 + j])
    else:
        joint = np.zeros(0, np.uint64)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(joint[a:b - k + 1]))
        elif b > a:
            h = np.zeros(1, np.uint64)
            for j in range(a, b):
                h = mix64(h + words[j:j + 1])
            out.append(mix64(h + _U(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
