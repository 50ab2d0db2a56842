"""Byte-level BPE encoding and decoding with forced boundaries.

A vocabulary of byte strings admits only some pairs of neighbouring bytes: a
pair that stands inside no token can never be merged across, so it is a
certain cut. A text is cut into pre-tokens, each pre-token is cut at such
pairs, the fragments are encoded independently (once for every distinct one)
and their ids are concatenated.

The tokenizer file is read on the driver and travels with the tasks, so
executors need no copy of it. Supported are files of a byte-level pre-tokenizer
with the usual contraction pattern, no normaliser, and added tokens that match
as plain strings; anything else raises.

Defined results: a null text is empty, an empty text has no ids; special
strings inside a text become their ids; repeated rows are encoded one by one;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tspanel.llm.common import give_back, lean

#: Characters handled at a time, and distinct pre-tokens after which those not met since the last such point are forgotten.
CHUNK_CHARS = 1 << 19
CACHE = 60_000

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
_CLASS: np.ndarray | None = None


def char_classes() -> np.ndarray:
    """Of each code point: letter, number, white space or other."""
    global _CLASS
    if _CLASS is None:
        _CLASS = np.zeros(0x110000, np.uint8)
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, every):
                a, b = ord(m[0][0]), ord(m[0][-1])
                _CLASS[a:b + 1] = kind
        _CLASS[0xD800:0xE000] = OTHER
    return _CLASS


def pretoken_starts(codes: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin in ``codes``, texts laid end to end; ``borders`` are the texts' first positions.

    A pre-token is a contraction (``'s 't 're 've 'm 'll 'd``), or a run of
    letters, of numbers or of other characters with the blank before it, or a
    run of white space but for its last character when something follows.
    """
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = char_classes()[codes]
    first = np.zeros(n, bool)
    first[borders[borders < n]] = True
    last = np.zeros(n, bool)
    last[:-1] = first[1:]
    last[-1] = True
    space = kind == SPACE
    joins = np.zeros(n, bool)                      # the character before is a blank of the same text
    joins[1:] = codes[:-1] == 0x20
    joins &= ~first
    run = first.copy()                             # a run of one class begins
    run[1:] |= kind[1:] != kind[:-1]
    start = np.where(space, run, run & ~joins)
    ends_run = np.ones(n, bool)                    # white space before something else
    ends_run[:-1] = ~space[1:]
    start |= space & ends_run & ~last
    quote = np.flatnonzero((codes == 0x27) & run & ~joins)
    if len(quote):
        after = np.concatenate([codes, np.zeros(3, codes.dtype)])
        stop = np.concatenate([first, np.ones(3, bool)])
        one, two = after[quote + 1], after[quote + 2]
        in1 = ~stop[quote + 1]
        in2 = in1 & ~stop[quote + 2]
        short = in1 & np.isin(one, [ord(c) for c in "stmd"])
        long = in2 & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
        start[quote[short | long] + 1] = False
        for hit, width in ((short, 2), (long, 3)):
            to = quote[hit] + width
            to = to[to < n]
            # what follows a contraction begins anew, except a blank's follower, which joins the blank
            start[to] = True
    return np.flatnonzero(start)


def split_pretokens(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Pre-tokens of the texts, and where each text's begin in the list."""
    whole = "".join(texts)
    sizes = np.array([0, *map(len, texts)], np.int64).cumsum()
    codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = pretoken_starts(codes, sizes[:-1])
    cut = starts.tolist()
    return [whole[a:b] for a, b in zip(cut, [*cut[1:], len(whole)], strict=True)], np.searchsorted(starts, sizes)


def _byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in the file: itself if printable, else from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """Tables of one tokenizer file and the work on batches of texts."""

    def __init__(self, spec: str):
        conf = json.loads(spec)
        pre, model = conf["pre_tokenizer"], conf["model"]
        plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in conf["added_tokens"])
        if conf["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or model["type"] != "BPE" or not plain:
            raise ValueError("not a plain byte-level BPE file")
        back = _byte_chars()
        self.special = {t["content"]: t["id"] for t in conf["added_tokens"]}
        self.bytes_of: dict[int, bytes] = {i: bytes(back[c] for c in t) for t, i in model["vocab"].items() if t not in self.special}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        ids = {t: i for t, i in model["vocab"].items()}
        self.byte_id = np.zeros(256, np.int64)
        for c, b in back.items():
            self.byte_id[b] = ids[c]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([(ids[a] << 32) | ids[b] for a, b in merges], np.int64)
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.pairs, self.rank, self.made = keys[order], order.astype(np.int64), made
        self.inside = np.zeros((256, 256), bool)     # pairs of bytes that stand inside some token
        for token in self.bytes_of.values():
            b = np.frombuffer(token, np.uint8)
            self.inside[b[:-1], b[1:]] = True
        self.cache: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}           # the cache as it was when it was last full
        self.marks = re.compile("|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None

    def _ranks(self, ids: np.ndarray) -> np.ndarray:
        key = (ids[:-1] << 32) | ids[1:]
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.rank[at], len(self.made))

    def encode_fragments(self, data: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of fragments laid end to end (``owner`` numbers them, ascending from 0), and their owners.

        Every round merges, in each fragment that still can, all places of its lowest-ranked pair.
        """
        none = len(self.made)
        ids = self.byte_id[data]
        done_ids, done_owner = [], []
        while len(ids):
            rank = np.full(len(ids), none, np.int64)
            rank[:-1] = np.where(owner[1:] == owner[:-1], self._ranks(ids), none)
            head = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            size = np.diff(np.append(head, len(ids)))
            least = np.repeat(np.minimum.reduceat(rank, head), size)
            idle = least == none
            if idle.any():
                done_ids.append(ids[idle])
                done_owner.append(owner[idle])
                ids, owner, rank, least = ids[~idle], owner[~idle], rank[~idle], least[~idle]
                if not len(ids):
                    break
            hit = rank == least
            at = np.flatnonzero(hit)
            run = np.concatenate([[True], np.diff(at) != 1])      # neighbouring places overlap: every second counts
            nth = np.arange(len(at)) - np.repeat(np.flatnonzero(run), np.diff(np.append(np.flatnonzero(run), len(at))))
            at = at[nth % 2 == 0]
            ids[at] = self.made[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, owner = ids[keep], owner[keep]
        all_ids = np.concatenate(done_ids) if done_ids else np.zeros(0, np.int64)
        all_owner = np.concatenate(done_owner) if done_owner else np.zeros(0, np.int64)
        order = np.argsort(all_owner, kind="stable")
        return all_ids[order], all_owner[order]

    def encode_pretokens(self, tokens: list[str]) -> list[bytes]:
        """The ids (little-endian, 4 bytes each) of each pre-token: cut at forced boundaries, encode, concatenate."""
        if not tokens:
            return []
        raw = [t.encode() for t in tokens]
        data = np.frombuffer(b"".join(raw), np.uint8)
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        token = np.repeat(np.arange(len(raw)), sizes)
        begins = np.ones(len(data), bool)
        begins[1:] = (token[1:] != token[:-1]) | ~self.inside[data[:-1], data[1:]]
        fragment = np.cumsum(begins) - 1
        ids, owner = self.encode_fragments(data, fragment)
        per = np.bincount(token[begins][owner], minlength=len(raw)).cumsum() * 4
        blob = ids.astype("<u4").tobytes()
        return [blob[a:b] for a, b in zip([0, *per[:-1].tolist()], per.tolist(), strict=True)]

    def count_pretokens(self, tokens: list[str]) -> np.ndarray:
        return np.fromiter((len(x) >> 2 for x in self.encode_pretokens(tokens)), np.int64, len(tokens))

    def pieces(self, text: str) -> list[tuple[str, int | None]]:
        """The text cut at special strings: (plain text, None) and (special string, id)."""
        if not self.marks or not any(s in text for s in self.special):
            return [(text, None)]
        out, at = [], 0
        for m in self.marks.finditer(text):
            out += [(text[at:m.start()], None), (m[0], self.special[m[0]])]
            at = m.end()
        return [*out, (text[at:], None)]

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 4-byte integers."""
        out: list[bytes] = []
        group: list[str] = []
        shape: list[list[int | None]] = []        # of each text: a special id, or None for the next piece in the group
        size = 0

        def flush() -> None:
            tokens, at = split_pretokens(group)
            if len(self.cache) > CACHE:
                self.before, self.cache = self.cache, {}
            new = [t for t in dict.fromkeys(tokens) if t not in self.cache]
            known = [t for t in new if t in self.before]
            self.cache.update(zip(known, map(self.before.__getitem__, known), strict=True))
            new = [t for t in new if t not in self.before]
            self.cache.update(zip(new, self.encode_pretokens(new), strict=True))
            get = self.cache.__getitem__
            parts = iter([b"".join(map(get, tokens[a:b])) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)])
            out.extend(b"".join(next(parts) if x is None else x.to_bytes(4, "little") for x in s) for s in shape)

        for text in texts:
            cut = self.pieces(text or "")
            group += [t for t, i in cut if i is None]
            shape.append([i for _, i in cut])
            size += len(text or "")
            if size >= CHUNK_CHARS:
                flush()
                group, shape, size = [], [], 0
        if shape:
            flush()
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are not UTF-8 become the replacement character."""
        get = self.bytes_of
        return b"".join([get[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_documents(docs: DataFrame, tokenizer: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                     ids: bool = True, digests: bool = False) -> DataFrame:
    """The ``keep`` columns of ``docs`` with ``n_tokens``, and on request ``token_ids`` (array), and the
    digests of the ids and of the text decoded from them. A kept column named like an added one gives way."""
    added = ["n_tokens", *["token_ids"] * ids, *["ids_sha256", "decoded_sha256"] * digests]
    keep = tuple(c for c in keep if c not in added)
    shared = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer))
    kinds = {"n_tokens": T.LongType(), "token_ids": T.ArrayType(T.LongType()), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
    frame = docs.select(*keep, docs[text].alias("__text"))
    schema = T.StructType([*frame.schema.fields[:-1], *[T.StructField(c, kinds[c]) for c in added]])

    def work(batches):
        bpe = ByteBPE(shared.value)
        for batch in batches:
            got = bpe.encode(batch.column(len(keep)).to_pylist())
            cols = {"n_tokens": pa.array([len(g) >> 2 for g in got], pa.int64())}
            if ids:
                at = np.array([0, *(len(g) >> 2 for g in got)], np.int32).cumsum(dtype=np.int32)
                cols["token_ids"] = pa.ListArray.from_arrays(pa.array(at), pa.array(np.frombuffer(b"".join(got), "<u4").astype(np.int64)))
            if digests:
                cols["ids_sha256"] = pa.array([hashlib.sha256(g).hexdigest() for g in got], pa.string())
                cols["decoded_sha256"] = pa.array([hashlib.sha256(bpe.decode(g).encode()).hexdigest() for g in got], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *[cols[c] for c in added]], names=[*keep, *added])
            del got, cols
            give_back()

    return frame.mapInArrow(lean(work), schema)


def decode_documents(encoded: DataFrame, tokenizer: str, token_ids: str = "token_ids", text: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids appended as ``text``; a null array is the empty text."""
    encoded = encoded.drop(text)
    at = encoded.columns.index(token_ids)
    shared = encoded.sparkSession.sparkContext.broadcast(read_spec(tokenizer))

    def work(batches):
        bpe = ByteBPE(shared.value)
        for batch in batches:
            got = [bpe.decode(np.array(x or [], "<u4").tobytes()) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.string())], names=[*batch.schema.names, text])

    return encoded.mapInArrow(lean(work), T.StructType([*encoded.schema.fields, T.StructField(text, T.StringType())]))
