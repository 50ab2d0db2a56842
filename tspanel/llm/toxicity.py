"""Toxicity scores by a counterfactually regularised classifier.

A logistic regression over the words of a text, fitted to minimise the log loss
on the labelled sentences plus a ridge term plus ``fairness`` times the squared
change of the score when the identity terms of a sentence are swapped for
others of their group ("women" for "men"). A weight that an identity term would
earn by standing in toxic sentences is thus held back, which keeps neutral
mentions of a group from being called toxic.

Features are distinct words (runs of letters, lower-cased): the identity terms,
and the ``features`` words whose presence says most about the label, by the
log-likelihood ratio of the counts over all labelled rows (at least ``min_gain``). The weights are fitted on a
bounded sample of the distinct labelled texts (``max_rows`` are expected, by a hash of the text, the
toxic and the others alike; a text of many copies is the likelier drawn, and weighs as
many rows as it stands for); the scores read every word of every text.

Defined results: null and empty texts score as a text without a known word;
rows with a null label or text teach nothing; without a toxic and a clean row
to learn from every score is the share of toxic rows (0 if there are none);
repeated rows are scored one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tspanel.llm.common import SMALL, Scratch, drawn, with_hashes

#: Terms that name a group of people; each is swapped for the next one of its line.
IDENTITY_GROUPS: tuple[tuple[str, ...], ...] = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"), ("she", "he"), ("her", "his"),
    ("gay", "straight"), ("lesbian", "heterosexual"), ("transgender", "cisgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("africans", "europeans", "asians", "americans"),
    ("immigrants", "natives"), ("old", "young"), ("disabled", "deaf", "blind"),
    ("frauen", "männer"), ("mujeres", "hombres"), ("femmes", "hommes"),
)

WORDS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class ToxicConfig:
    features: int = 2000
    min_docs: int = 5
    min_gain: float = 10.0
    max_rows: int = 20_000
    fairness: float = 10.0
    ridge: float = 1e-4
    steps: int = 400
    groups: tuple[tuple[str, ...], ...] = field(default=IDENTITY_GROUPS)


@dataclass(frozen=True)
class ToxicModel:
    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        get = self.weights.get
        z = self.bias + sum(get(w, 0.0) for w in sorted(self.weights.keys() & set(WORDS.findall((text or "").lower()))))
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))


def swapped(words: set[str], groups: tuple[tuple[str, ...], ...]) -> set[str]:
    """The counterfactual: every identity term replaced by the next of its group."""
    turn = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    return {turn.get(w, w) for w in words}


def _words(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(toxic, h1, h2, spread, words) of every row: the distinct words instead of the text, written once for all that ``fit`` reads."""

    def cut(batches):
        for batch in batches:
            words = [sorted(set(WORDS.findall(t.as_py().lower()))) for t in batch.column(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(words, pa.list_(pa.string()))], names=["toxic", "h1", "h2", "spread", "words"])

    named = with_hashes(rows).select("toxic", "h1", "h2", "spread", "text")
    return scratch.keep(named.mapInArrow(cut, "toxic int, h1 long, h2 long, spread double, words array<string>"), "words")


def _word_counts(rows: DataFrame) -> DataFrame:
    """(word, docs, toxic): in how many labelled texts a word occurs, and in how many toxic ones."""
    return rows.select(F.explode("words").alias("word"), "toxic").groupBy("word").agg(F.count("*").alias("docs"), F.sum("toxic").alias("toxic"))


def with_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of the labelled rows of ``docs``; labels travel to the texts as long as they are few numbers, not texts to the labels."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").select("doc_id", "toxic")
    few = known.limit(SMALL + 1).count() <= SMALL
    return docs.join(F.broadcast(known) if few else known, "doc_id").select("text", "toxic")


def fit(labelled: DataFrame, cfg: ToxicConfig | None = None) -> ToxicModel:
    """Learn from (text, toxic) rows; what reaches the driver is bounded by ``max_rows`` and ``features``."""
    cfg = cfg or ToxicConfig()
    scratch = Scratch(labelled.sparkSession, "toxicity")
    known_rows = labelled.where("text IS NOT NULL AND toxic IS NOT NULL")
    rows = _words(known_rows.select("text", F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic")), scratch)
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("k")).first()
    n, k = total["n"], total["k"]
    if not n or not k or k == n:
        p = k / n if n else 0.0
        return ToxicModel({}, 500.0 if p == 1 else -500.0)
    share = F.when(F.col("toxic") == 1, min(1.0, cfg.max_rows / 2 / k)).otherwise(min(1.0, cfg.max_rows / 2 / (n - k)))

    def term(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    def cell(docs, toxic):
        return term(toxic, docs * (k / n)) + term(docs - toxic, docs * (1 - k / n))

    gain = cell(F.col("docs"), F.col("toxic")) + cell(F.lit(n) - F.col("docs"), F.lit(k) - F.col("toxic"))
    telling = _word_counts(rows).withColumn("gain", F.round(gain, 6)).where((F.col("docs") >= cfg.min_docs) & (F.col("gain") >= cfg.min_gain))
    best = telling.orderBy(F.desc("gain"), "word").limit(cfg.features)
    terms = [t for g in cfg.groups for t in g]
    vocab = {w: i for i, w in enumerate(sorted({r["word"] for r in best.select("word").collect()} | set(terms)))}
    known = set(vocab)

    def present(batches):
        for batch in batches:
            words = [sorted(known & set(x)) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([[vocab[w] for w in x] for x in words], pa.list_(pa.int32())), batch.column(1), batch.column(2)], names=["at", "toxic", "stands"])

    sample = drawn(rows, ["toxic"], share.cast("double"), cfg.max_rows, "words").select("words", "toxic", (F.col("copies") / F.col("chance")).alias("stands")) \
        .mapInArrow(present, "at array<int>, toxic int, stands double")
    got = sorted((tuple(r["at"]), r["toxic"], r["stands"]) for r in sample.collect())
    scratch.drop(rows)
    names = sorted(vocab)
    other = [sorted(vocab[w] for w in swapped({names[i] for i in at}, cfg.groups)) for at, _, _ in got]
    return _descend([g[0] for g in got], other, np.array([g[1] for g in got], float), np.array([g[2] for g in got]), names, cfg)


def _descend(at: list, other: list, y: np.ndarray, weight: np.ndarray, names: list[str], cfg: ToxicConfig) -> ToxicModel:
    """Gradient steps with per-weight scaling on the penalised loss; rows weigh as many as they stand for."""

    def flat(rows):
        return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array([i for r in rows for i in r], np.int64)

    row, col = flat(at)
    moved = [i for i, (a, b) in enumerate(zip(at, other, strict=True)) if list(a) != list(b)]
    row2, col2 = flat([other[i] for i in moved])
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    w = np.zeros(len(names) + 1)
    weight = weight / weight.sum()
    w[-1] = np.log((weight * y).sum() / (weight * (1 - y)).sum())
    for step in range(1, cfg.steps + 1):
        p = 1 / (1 + np.exp(-(w[-1] + np.bincount(row, w[col], len(y)))))
        pull = weight * (p - y)
        if moved:
            p2 = 1 / (1 + np.exp(-(w[-1] + np.bincount(row2, w[col2], len(moved)))))
            gap = 2 * cfg.fairness * weight[moved] * (p[moved] - p2)
            pull[moved] += gap * p[moved] * (1 - p[moved])
        grad = np.zeros_like(w)
        grad[:-1] = np.bincount(col, pull[row], len(names)) + cfg.ridge * w[:-1]
        grad[-1] = pull.sum()
        if moved:
            back = -gap * p2 * (1 - p2)
            grad[:-1] += np.bincount(col2, back[row2], len(names))
            grad[-1] += back.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= 0.1 * (1 - step / (cfg.steps + 1)) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return ToxicModel({n: float(x) for n, x in zip(names, w[:-1], strict=True) if x}, float(w[-1]))


def score_documents(docs: DataFrame, model: ToxicModel, keep: tuple[str, ...] = ("doc_id",), text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The ``keep`` columns with ``score`` and ``predicted`` (kept columns of these names give way)."""
    frame = docs.select(*[c for c in keep if c not in ("score", "predicted")], docs[text].alias("__text"))
    schema = T.StructType([*frame.schema.fields[:-1], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for batch in batches:
            s = [shared.value.score(t.as_py()) for t in batch.columns[-1]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(s, pa.float64()), pa.array([int(x >= threshold) for x in s], pa.int32())], names=schema.names)

    return frame.mapInArrow(work, schema)
