"""Mixing sources to target weights by a low-discrepancy schedule.

Slot t of the schedule holds the golden-ratio point frac(t / phi), as the
32-bit integer t * 2654435769 mod 2^32, so every engine gets the same points.
They begin anew after 2^32 slots; each such epoch then rounds the sources' spans
in another way, so that they come out right over all epochs.
The points are mapped through the cumulative shares of the sources, which gives
each slot a source and each source its share in every stretch of the schedule; a
source's slots are ranked by pages of slots, and the r-th takes the r-th block of
the source's documents. Blocks are equal numbers of tokens cut from the
source's documents in a shuffled (md5) order, and begin anew when all are used.

Targets: sources share ``epochs`` times all tokens by weight; a target stops at
``cap`` times its source's tokens and the excess is shared anew by weight until
none is above. A block has the tokens that ``slots`` slots leave to each. Sources whose
target is below ``FINEST`` such blocks have smaller ones, 1/``FINEST`` of their target (a token at least),
and a share of the slots that is larger by as much: so they come as near their targets in a large corpus
as in a small one, and the schedule has at most ``slots`` slots and ``FINEST`` times 2 for each source.

Nothing sorts or sums a whole source in one task: documents are dealt out by
source and leading hash bits, and running totals come from the totals of those.
A document is joined to the schedule through the blocks that its tokens lie in, by (source, block).

Defined results: a null text has size 0, takes part and gets 0; a null source
is a source of its own, last in order; documents without words and sources of
size 0 take nothing; repeated rows are separate documents (equal ones in an
order of no consequence: their sizes are equal); an empty table gives an empty
result; input columns named like an added one give way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tspanel.llm.common import WORD, Scratch

GOLDEN = 2654435769            # 2^32 / phi
RANGE = 1 << 32
CELLS = 4096
FINEST = 4096                  # blocks that a target has at least (of a token or more)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), epochs: float = 1.5, cap: float = 2.0,
                   slots: int = 1 << 20) -> DataFrame:
    """From (source, source_size): one row a source with weight, target, ``block`` (tokens that a slot takes of it), ``blocks`` (of the
    source), ``upto`` (shares of the slots added up in order), ``total`` (of them) and ``n_slots`` (of the schedule).

    Sources reach their caps in the order of size / weight. Those before the first source that its
    share of the rest does not overfill stop at their caps; it and the later ones share the rest by weight.
    The windows without a key run over one row a source, never over documents.
    """
    by_name = W.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    ranked = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    filling = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    before = filling.rowsBetween(W.unboundedPreceding, -1)
    everyone = W.partitionBy()
    limit = F.col("source_size") * F.lit(float(cap))
    held = ranked.withColumn("capped", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(float(cap))) \
        .withColumn("open", F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))) \
        .withColumn("level", (F.sum("source_size").over(everyone) * F.lit(float(epochs)) - F.col("capped")) / F.col("open")) \
        .withColumn("level", F.max(F.when(F.col("level") * F.col("weight") <= limit, F.col("level"))).over(everyone))
    out = held.withColumn("target", F.least(limit, F.coalesce(F.col("level") * F.col("weight"), limit)))
    common = F.ceil(F.sum("target").over(everyone) / slots)
    out = out.withColumn("block", F.greatest(F.lit(1), F.least(common, F.floor(F.col("target") / FINEST)))) \
        .withColumn("blocks", F.ceil(F.col("source_size") / F.col("block")))
    out = out.withColumn("upto", F.sum(F.col("target") / F.col("block")).over(by_name.rowsBetween(W.unboundedPreceding, 0)))
    return out.withColumn("total", F.max("upto").over(everyone)).withColumn("n_slots", F.floor("total")) \
        .select("source", "source_size", "weight", "target", "block", "blocks", "upto", "total", "n_slots")


def _spans(targets: DataFrame) -> DataFrame:
    """(source, epoch, lo, hi): the points of each source in each 2^32 slots."""
    order = W.partitionBy("epoch").orderBy(F.col("source").isNull(), "source")
    epochs = targets.where("target > 0 AND n_slots > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_slots") - 1) / RANGE))))
    # golden-ratio offsets: the rounded spans add up to the unrounded ones over the epochs
    shift = F.col("epoch") * F.lit(GOLDEN) % F.lit(RANGE) / F.lit(float(RANGE))
    return epochs.withColumn("hi", F.least(F.lit(RANGE), F.floor(F.col("upto") / F.col("total") * RANGE + shift))) \
        .withColumn("lo", F.coalesce(F.lag("hi").over(order), F.lit(0))).where("hi > lo").select("source", "epoch", "lo", "hi", "n_slots")


def schedule(targets: DataFrame) -> DataFrame:
    """(slot, source, turn) of the mix: the source of each slot, and the slot's rank among the source's."""
    cell = RANGE // CELLS
    spans = _spans(targets)
    spans = spans.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / cell), F.floor((F.col("hi") - 1) / cell))))
    pages = targets.agg(F.max("n_slots").alias("n")).where("n > 0") \
        .select("n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / CELLS))).alias("page")).repartition("page")
    points = pages.select("page", F.explode(F.sequence(F.col("page") * CELLS, F.least(F.col("page") * CELLS + CELLS, F.col("n")) - 1)).alias("slot"))
    points = points.withColumn("point", F.col("slot") % F.lit(RANGE) * F.lit(GOLDEN) % F.lit(RANGE)).withColumn("cell", F.floor(F.col("point") / cell)) \
        .withColumn("epoch", F.floor(F.col("slot") / RANGE))
    placed = points.join(spans.select("epoch", "cell", "lo", "hi", "source"), ["epoch", "cell"]).where("point >= lo AND point < hi").select("slot", "page", "source")
    # ranks from the counts of each page of slots, so that no source is sorted in one task
    counts = placed.groupBy("source", "page").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("source").orderBy("page").rowsBetween(W.unboundedPreceding, -1)
    base = counts.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    ranked = placed.withColumn("r", F.row_number().over(W.partitionBy("source", "page").orderBy("slot")))
    return ranked.alias("p").join(base.alias("b"), (F.col("p.page") == F.col("b.page")) & F.col("p.source").eqNullSafe(F.col("b.source"))) \
        .select("p.slot", "p.source", (F.col("b.base") + F.col("p.r") - 1).alias("turn"))


def streams(sized: DataFrame, buckets: int) -> DataFrame:
    """``sized`` with ``begins``, where each document's tokens begin in its source's shuffled stream."""
    dealt = sized.withColumn("deal", F.floor(F.conv(F.substring("key", 1, 5), 16, 10).cast("int") * buckets / (1 << 20)))
    sums = dealt.groupBy("source", "deal").agg(F.sum("size").alias("n"))
    earlier = W.partitionBy("source").orderBy("deal").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    own = F.sum("size").over(W.partitionBy("source", "deal").orderBy("key", "row").rowsBetween(W.unboundedPreceding, -1))
    return dealt.withColumn("own", F.coalesce(own, F.lit(0))).alias("d") \
        .join(sums.alias("s"), (F.col("d.deal") == F.col("s.deal")) & F.col("d.source").eqNullSafe(F.col("s.source"))) \
        .select(*[f"d.{c}" for c in sized.columns], (F.col("s.base") + F.col("d.own")).alias("begins"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), epochs: float = 1.5, cap: float = 2.0,
        slots: int = 1 << 20, seed: str = "mix", buckets: int = 1024, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, ``taken`` (the tokens that the
    scheduled blocks take of it; a block that is scheduled twice counts twice) and the ``carry`` columns."""
    scratch = Scratch(docs.sparkSession, "mixing")
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.md5("text"), F.lit(""))))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = scratch.keep(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", *[c for c in carry if c not in ("doc_id", "source")],
                                     size.alias("size"), key.alias("key")), "sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = scratch.keep(source_targets(totals, weights, epochs, cap, slots).coalesce(1), "targets")
    # the r-th slot of a source takes its block r modulo the number of its blocks, at most `cap` times round
    slots_of = schedule(targets).alias("p").join(targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source"))) \
        .where(F.col("p.turn") < F.floor(F.col("t.blocks") * F.lit(float(cap))))
    times = slots_of.groupBy(F.col("p.source").alias("source"), (F.col("p.turn") % F.col("t.blocks")).alias("nth")).agg(F.count("*").alias("times"))
    at = streams(sized.where("size > 0").select("row", "source", "size", "key"), buckets)
    pieces = at.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))) \
        .select("d.row", "d.source", "d.begins", (F.col("d.begins") + F.col("d.size")).alias("ends"), "t.block") \
        .withColumn("nth", F.explode(F.sequence(F.floor(F.col("begins") / F.col("block")), F.floor((F.col("ends") - 1) / F.col("block")))))
    inside = F.least("c.ends", (F.col("c.nth") + 1) * F.col("c.block")) - F.greatest("c.begins", F.col("c.nth") * F.col("c.block"))
    taken = pieces.alias("c").join(times.alias("n"), (F.col("c.nth") == F.col("n.nth")) & F.col("c.source").eqNullSafe(F.col("n.source"))) \
        .groupBy("c.row").agg(F.sum(inside * F.col("n.times")).alias("taken"))
    rows = sized.join(taken, "row", "left").alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
    return rows.select(*[f"d.{c}" for c in sized.columns if c not in ("row", "key")], "t.source_size", "t.target",
                       F.coalesce("d.taken", F.lit(0)).cast("long").alias("taken"))
