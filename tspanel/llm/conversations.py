"""Repair of conversation structure by a checkpointed dynamic programme.

A conversation should read ``(system)? (user assistant)+``. Edits on its rows
cost: keep 0, change the role to user or assistant 3, delete 4, insert an empty
user or assistant row 3; a row that is blank or repeats an earlier one has to be
deleted, one whose text breaks off costs 3 more unless it is deleted. The
cheapest edits are found by backward costs: ``V[i][s]`` is what the rows from i
on cost if the rows before them ended in state s (nothing yet, system, user,
assistant). Walking forward, the ASCII-least letter that keeps to the cheapest
cost is taken (Delete, Insert, Keep, Rerole), which gives the least audit.

Costs are not kept for every row. Rows are sorted by conversation and turn
across the cluster and cut into blocks of ``BLOCK`` rows:

* each block is folded into its costs from every state to every state (blocks
  in parallel, whichever conversation they belong to),
* the blocks of a conversation, last one first, give the costs at the end of
  each block: the checkpoints,
* the walk forward reads a block, recomputes its costs from its checkpoint and
  emits the edits. It streams over the rows and holds one block at a time; it is
  sequential in a conversation, as the digest of its repaired text is.

Conversations within one block need no checkpoint. Equal rows (of one turn) are
counted before anything is sorted, so a row repeated a million times is one.

Defined results: a null role or text is one space; null turns come first; a null
``conv_id`` is a conversation of its own, named null; rows of equal turn are
taken by role, then text; a role counts by its first letter (none if empty);
very long texts are hashed in pieces as they come; a conversation whose rows were
all dropped has zeros, an empty audit and the hash of nothing; an empty table
gives an empty result; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tspanel.llm.common import Scratch

#: 2^10 rows a block: a conversation of a million rows has a thousand checkpoints.
BLOCK_BITS = 10

#: States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
_NEXT = (2, 2, 3, 2)
_WANTS = ("u", "u", "a", "u")
_ROLES = ("", "system", "user", "assistant")
_END = (0, 6, 3, 0)
_INSERT, _REROLE, _DELETE, _CUT = 3, 3, 4, 3
_FAR = 1 << 60

DIGESTS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "conv_id long, position long, edit string, role string, text string"


def damage(rows: DataFrame) -> DataFrame:
    """The rows with faults put in by crc32 of ``conv_id:turn`` modulo 20; ``copies`` says how often a row stands (0: dropped)."""
    blank = F.lit(" ")
    text = F.coalesce("text", blank)
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    code = F.crc32(key.cast("binary")) % 20
    return rows.select(
        "conv_id", "turn",
        F.when(code == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"))


def _sorted_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows with their copies, faults and ``at``, their place in the order of all rows."""
    blank = F.lit(" ")
    copies = F.col("copies").cast("long") if "copies" in rows.columns else F.lit(1)
    named = rows.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), copies.alias("copies"))
    distinct = named.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies")) \
        .withColumn("digest", F.sha2("text", 256)).withColumn("when", F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn")))
    standing = distinct.where("copies > 0")
    first = standing.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(F.min("when").alias("first"))
    seen = distinct.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    solid = F.rtrim("text", F.lit(" \t\n\x0b\f\r"))
    fault = F.when(solid == "", "b").when(F.col("first") < F.col("when"), "d").when(~F.substring(solid, -1, 1).isin(".", "!", "?"), "t").otherwise("")
    told = seen.select("conv", "turn", "role", "text", "copies", fault.alias("fault"))
    order = ["conv", "turn", "role"]
    dealt = told.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    return dealt.withColumn("at", F.monotonically_increasing_id()).withColumn("block", F.shiftright("at", BLOCK_BITS))


def _closed(v: list[int]) -> list[int]:
    """Costs if empty rows may be inserted first."""
    user, bot = min(v[2], _INSERT + v[3]), min(v[3], _INSERT + v[2])
    return [min(v[0], _INSERT + user), min(v[1], _INSERT + user), user, bot]


def _before(after: list[int], initial: str, fault: str, copies: int) -> list[int]:
    """Costs before a row (and its further copies, which all go) from those behind it."""
    if fault in ("b", "d"):
        return [x + _DELETE * copies for x in after]
    rest = [x + _DELETE * (copies - 1) for x in after] if copies > 1 else after
    cut = _CUT if fault == "t" else 0
    out = []
    for s in range(4):
        cost = min(_DELETE + rest[s], _REROLE + cut + rest[_NEXT[s]])
        if initial == _WANTS[s]:
            cost = min(cost, cut + rest[_NEXT[s]])
        elif s == 0 and initial == "s":
            cost = min(cost, cut + rest[1])
        out.append(cost)
    return _closed(out)


def _columns(batch: pa.RecordBatch, *names: str):
    return zip(*[batch.column(n).to_pylist() for n in names], strict=True)


def _fold_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (conv, block), last one first, folded into the costs from each state to each state."""
    key, costs, out = None, None, []

    def close():
        if key is not None:
            out.append((*key, [x for v in costs for x in v]))

    for batch in batches:
        for conv, block, initial, fault, copies in _columns(batch, "conv", "block", "initial", "fault", "copies"):
            if (conv, block) != key:
                close()
                key, costs = (conv, block), [_closed([0 if s == k else _FAR for s in range(4)]) for k in range(4)]
            if copies:
                costs = [_before(v, initial, fault, copies) for v in costs]
        yield _table(out, "conv", "block", "costs")
        out = []
    close()
    yield _table(out, "conv", "block", "costs")


def _checkpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a conversation, last one first: the costs at the end of each."""
    conv, now = object(), None
    for batch in batches:
        out = []
        for c, block, costs in _columns(batch, "conv", "block", "costs"):
            if c != conv:
                conv, now = c, list(_END)
            out.append((c, block, now))
            now = [min(costs[4 * k + s] + now[k] for k in range(4)) for s in range(4)]
        yield _table(out, "conv", "block", "ends")


def _table(rows: list[tuple], *names: str) -> pa.RecordBatch:
    kinds = {"costs": pa.list_(pa.int64()), "ends": pa.list_(pa.int64())}
    cols = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, cols, strict=True)], list(names))


class _Walk:
    """The walk forward over one conversation; holds the rows of one block."""

    def __init__(self, conv, turns: bool):
        self.conv, self.turns, self.out = conv, turns, []
        self.rows, self.ends = [], list(_END)
        self.state = self.cost = self.lines = 0
        self.count = {"b": 0, "d": 0, "t": 0}
        self.illegal = self.distinct = 0
        self.last, self.low, self.high, self.turn = None, None, None, None
        self.audit, self.hash = [], hashlib.sha256()

    def take(self, turn, role: str, text: str, copies: int, fault: str) -> None:
        if turn is not None and turn != self.turn:
            self.low, self.high, self.turn = turn if self.low is None else self.low, turn, turn
            self.distinct += 1
        initial = role[:1]
        if self.last is not None:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.illegal += copies - 1
        self.last = initial
        if fault == "b":
            self.count["b"] += copies
        else:
            self.count["d"] += copies - (fault != "d")
            self.count["t"] += fault == "t"
        self.rows.append((role, text, copies, fault))

    def _line(self, role: str, text: str, edit: str) -> None:
        if self.lines:
            self.hash.update(b"\n")
        self.hash.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines += 1
        if self.turns:
            self.out.append((self.conv, self.lines, edit, role, text))

    def _insert(self) -> None:
        self.audit.append("I")
        self.cost += _INSERT
        self.state = _NEXT[self.state]
        self._line(_ROLES[self.state], "", "I")

    def walk_block(self) -> None:
        """Costs of the block's rows from its checkpoint, then the least letters that keep to them."""
        costs = [self.ends]
        for role, _, copies, fault in reversed(self.rows):
            costs.append(_before(costs[-1], role[:1], fault, copies))
        costs.reverse()
        for (role, text, copies, fault), now, after in zip(self.rows, costs, costs[1:], strict=False):
            if fault not in ("b", "d"):
                rest, cut = _DELETE * (copies - 1), _CUT if fault == "t" else 0
                while now[self.state] != _DELETE + rest + after[self.state] and now[self.state] == _INSERT + now[_NEXT[self.state]]:
                    self._insert()
                s, initial = self.state, role[:1]
                kept = _NEXT[s] if initial == _WANTS[s] else 1 if s == 0 and initial == "s" else None
                if now[s] != _DELETE + rest + after[s]:
                    keep = kept is not None and now[s] == cut + rest + after[kept]
                    self.state = kept if keep else _NEXT[s]
                    self.audit.append("K" if keep else "R")
                    self.cost += cut + (0 if keep else _REROLE)
                    self._line(role if keep else _ROLES[self.state], text, self.audit[-1])
                    copies -= 1
            self.audit.append("D" * copies)
            self.cost += _DELETE * copies
        self.rows = []

    def close(self) -> list[tuple]:
        if self.last is None:
            return [] if self.turns else [(self.conv, 0, 0, 0, 0, 0, 0, "", self.hash.hexdigest())]
        self.walk_block()
        while _END[self.state]:
            self._insert()
        if self.turns:
            return self.out
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return [(self.conv, gaps, self.count["b"], self.count["d"], self.count["t"], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())]


def _walker(turns: bool):
    names = [f.split()[0] for f in (TURNS if turns else DIGESTS).split(", ")]
    kinds = {"edit": pa.string(), "role": pa.string(), "text": pa.string(), "audit": pa.string(), "repaired_sha256": pa.string()}

    def pack(rows):
        cols = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, cols, strict=True)], names)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block, out = None, None, []
        for batch in batches:
            for conv, b, ends, turn, role, text, copies, fault in _columns(batch, "conv", "block", "ends", "turn", "role", "text", "copies", "fault"):
                if now is None or conv != now.conv:
                    out += now.close() if now else []
                    now, block = _Walk(conv, turns), b
                elif b != block:
                    now.walk_block()
                    block = b
                if ends is not None:
                    now.ends = ends
                elif copies:
                    now.take(turn, role, text, copies, fault)
                if len(now.out) > 1000:
                    out += now.out
                    now.out = []
            yield pack(out)
            out = []
        yield pack(now.close() if now else [])
    return walk


def _walked(rows: DataFrame, turns: bool) -> DataFrame:
    scratch = Scratch(rows.sparkSession, "conversations")
    kept = scratch.keep(_sorted_rows(rows), "rows")
    steps = kept.select("conv", "block", "at", F.substring("role", 1, 1).alias("initial"), "fault", "copies")
    spans = steps.groupBy(F.col("conv").alias("c")).agg(F.min("block").alias("lo"), F.max("block").alias("hi")).where("lo < hi")
    long = steps.join(spans, F.col("conv").eqNullSafe(F.col("c")), "left_semi").repartition("block").sortWithinPartitions(F.col("block"), F.col("conv"), F.col("at").desc())
    folded = long.mapInArrow(_fold_blocks, "conv long, block long, costs array<long>")
    ends = folded.repartition("conv").sortWithinPartitions("conv", F.col("block").desc()).mapInArrow(_checkpoints, "conv long, block long, ends array<long>")
    marks = scratch.keep(ends, "checkpoints")
    both = kept.withColumn("ends", F.lit(None).cast("array<long>")).unionByName(marks, allowMissingColumns=True)
    order = both.repartition("conv").sortWithinPartitions("conv", "block", F.col("at").asc_nulls_first())
    return order.mapInArrow(_walker(turns), TURNS if turns else DIGESTS)


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost and letters of the cheapest edits, digest of the repaired text.

    ``rows``: conv_id, turn, role, text and optionally copies (how often the row stands; 0 names a conversation only).
    """
    return _walked(rows, False)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position (from 1), edit (K, R or I), role, text."""
    return _walked(rows, True)
