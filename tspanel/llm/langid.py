"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent character n-grams, the most
frequent first. A document gets its own list, and the language whose profile it
is least out of place with is the prediction: the sum over the document's
n-grams of how far each one's rank is from its rank in the profile, an absent
n-gram counting as far as the profile is long.

N-grams (one to three characters) are taken from runs of letters, lower-cased,
with a mark for the beginning and the end of a run. Fitting reads a bounded
sample of the labelled rows (``max_docs`` a language, chosen by a hash of the
text); prediction reads every character of every text.

Defined results: a null text, an empty one and one without a letter are
``und`` with score 0; equal distances go to the smaller language name; repeated
rows are predicted one by one; an empty table gives an empty result; with no
labelled row to learn from, every text is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tspanel.llm.common import drawn, lean, with_hashes

UNKNOWN = "und"
EDGE = 1


@dataclass(frozen=True)
class LangConfig:
    profile_size: int = 400
    max_docs: int = 3000
    max_languages: int = 10_000


_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def text_grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram keys of a text, ascending, and how often each occurs."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    run = np.full(len(codes) + 2, EDGE, np.int64)
    run[1:-1][letter] = codes[letter]
    keep = np.ones(len(run), bool)
    keep[1:] = (run[1:] != EDGE) | (run[:-1] != EDGE)
    run = run[keep]
    one = run[run != EDGE]
    two = (run[:-1] << 21) | run[1:]
    mid = run[1:-1] != EDGE
    three = (two[:-1][mid] << 21) | run[2:][mid]
    return np.unique(np.concatenate([one, two, three]), return_counts=True)


def top_grams(text: str | None, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, ties by key."""
    keys, counts = text_grams(text)
    return keys[np.argsort(-counts, kind="stable")[:size]]


def fit_profiles(labelled: DataFrame, text: str = "text", lang: str = "lang",
                 cfg: LangConfig | None = None) -> dict[str, list[int]]:
    """Profiles of the languages in ``labelled``; rows with a null text or language teach nothing."""
    cfg = cfg or LangConfig()
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(cfg.max_languages + 1).collect()}
    if len(sizes) > cfg.max_languages:
        raise ValueError(f"more than {cfg.max_languages} languages")
    if not sizes:
        return {}
    share = F.create_map(*[F.lit(x) for k, n in sorted(sizes.items()) for x in (k, min(1.0, cfg.max_docs / n))])
    # a text counts as often as copies of it would be among that share of the rows, at least once
    of_lang = share[F.col("lang")]
    sample = drawn(with_hashes(rows), ["lang"], of_lang, cfg.max_docs * len(sizes)).select("text", "lang", F.greatest(F.lit(1), F.round(F.col("copies") * of_lang)).cast("long").alias("times"))

    def count(batches):
        for batch in batches:
            sums: dict[str, list] = {}
            for text_, lang_, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys, n = text_grams(text_)
                sums.setdefault(lang_, []).append((keys, n * times))
            for lang_, parts in sums.items():
                keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(where, weights=np.concatenate([p[1] for p in parts]), minlength=len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang_] * len(keys)), pa.array(keys), pa.array(n)], names=["lang", "gram", "n"])

    totals = sample.mapInArrow(lean(count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = W.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = totals.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= cfg.profile_size)
    profiles: dict[str, list[int]] = {}
    for r in best.select("lang", "rank", "gram").orderBy("lang", "rank").collect():
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return profiles


class Identifier:
    """The profiles laid out for lookup: rank of every n-gram in every language."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.names = sorted(profiles)
        self.size = size
        self.keys = np.unique(np.concatenate([np.array(profiles[x], np.int64) for x in self.names])) if self.names else np.zeros(0, np.int64)
        self.ranks = np.full((len(self.names), len(self.keys) + 1), 1 << 20, np.int64)
        for i, x in enumerate(self.names):
            grams = np.array(profiles[x], np.int64)
            self.ranks[i, np.searchsorted(self.keys, grams)] = np.arange(len(grams))

    def predict(self, text: str | None) -> tuple[str, float]:
        grams = top_grams(text, self.size)
        if not len(grams) or not self.names:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.keys, grams)
        at[(at == len(self.keys)) | (self.keys[np.minimum(at, len(self.keys) - 1)] != grams)] = len(self.keys)
        away = np.minimum(np.abs(self.ranks[:, at] - np.arange(len(grams))), self.size).sum(axis=1)
        best = int(np.argmin(away))
        return self.names[best], 1.0 - float(away[best]) / (self.size * len(grams))


def identify(docs: DataFrame, profiles: dict[str, list[int]], text: str = "text",
             cfg: LangConfig | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (1: every n-gram at its profile's rank) appended."""
    cfg = cfg or LangConfig()
    clash = {"lang_pred", "score"} & set(docs.columns)
    docs = docs.drop(*clash)
    at = docs.columns.index(text)

    def predict(batches):
        ident = Identifier(profiles, cfg.profile_size)
        for batch in batches:
            got = [ident.predict(x.as_py()) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(lean(predict), schema)
