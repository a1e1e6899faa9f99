"""Repeated passages: bytes of a document that a document with a smaller key also has, in runs of ``length``.

The order of suffixes is built block by block with a difference cover. Of the positions of a document, those
in a cover modulo ``period`` are the sample; any two positions share an offset below the period at which both
are in it. So two equal strings of ``length`` bytes hold, at the same place of both, an equal sample suffix of
``length - period + 1`` bytes. Suffixes are told apart to a depth of ``length`` only, and only equality
matters, so they are ordered by fingerprints of their first bytes.

1. Sample suffixes go to blocks by their first bytes; each block is sorted by itself, and says of each suffix
   whether another one is equal. All others are done with.
2. The rest are ranked by the bytes around them that a match through them can cover. A suffix whose rank
   also occurs in a smaller document is a match with all strings through it. Those with a rank that is
   alone among suffixes with equal first bytes are no match. These ranks settle long ties: inner parts of
   copies are not looked at byte by byte.
3. What remains is where copies begin and end. There every single suffix goes to its block and is
   sorted with the others, to the full depth.

Which bytes are matched after step 2, and which suffixes are open, is stored, so steps 1 and 2 are not worked out
again.

A block holds a bounded part of the input, one string per chunk of documents at most, so neither a block nor
a task grows with how often a string repeats; first bytes that very many chunks share are spread by rank.

A null text counts as empty. Texts shorter than ``length`` bytes lose nothing. Keys are integers; a null key
counts as smaller than all others. Rows that repeat a key are the same document: neither is smaller, so what
only they share stays in both. An empty table gives an empty result. Only key and text are read.
Strings are told apart by fingerprints: single ones by 64 bits and 24 of an independent second one, ranks by the bits
of their block's key (40 at least) and 48 of their own.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import stored
from .exchange import BUCKET_BYTES, CHUNK_BYTES, Chunk, answered, bucket_count, chunk_texts, over_chunks, pack, pack_sorted, split, unpack, unpack_sorted
from .prints import mix, places, prints, windows

#: Perfect difference sets, by period.
COVERS = {
    3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
}
#: First bytes shared by more chunks than this are spread over blocks by rank.
HOT_CHUNKS = 64
_NULL_KEY = -(1 << 63)


@dataclass(frozen=True)
class Depth:
    """The length of a match, and the sample that finds it."""

    length: int
    key_bits: int

    @property
    def period(self) -> int:
        return max(p for p in COVERS if 3 * p <= max(2 * self.length, 9))

    @property
    def first_bytes(self) -> int:
        return self.length - self.period + 1

    @property
    def key_mask(self) -> np.uint64:
        return np.uint64((1 << 64) - (1 << (64 - self.key_bits)))


class Work:
    """What one chunk knows of its suffixes, as far as the answers go."""

    def __init__(self, chunk: Chunk, depth: Depth):
        self.data, self.depth = chunk.data, depth
        self.starts, self.ends = chunk.offsets[:-1], chunk.offsets[1:]
        self.doc_key = np.array([_NULL_KEY if k is None else k for k in chunk.keys], np.int64)
        # Sample positions, in documents long enough to hold a match.
        size = self.ends - self.starts
        inside = np.zeros(depth.period, bool)
        inside[list(COVERS[depth.period])] = True
        picked = []
        for doc in np.nonzero(size >= depth.length)[0]:
            at = np.arange(size[doc] - depth.first_bytes + 1)
            picked.append((doc, self.starts[doc] + at[inside[at % depth.period]]))
        self.at = np.concatenate([p for _, p in picked]) if picked else np.empty(0, np.int64)
        self.doc = np.repeat([d for d, _ in picked], [len(p) for _, p in picked]).astype(np.int64)
        self.first = windows(self.data, self.at, depth.first_bytes)
        self.keys, self.of = places(self.first & depth.key_mask)
        self.times = np.bincount(self.of, minlength=len(self.keys))

    def rank(self, shared: np.ndarray) -> None:
        """Keep the suffixes that occur elsewhere, given for each key 0 (no), 1 (yes) or 2 (in very many chunks)."""
        flag = np.maximum(shared, (self.times > 1).astype(np.uint8))[self.of]
        live = flag > 0
        at, self.doc = self.at[live], self.doc[live]
        reach = self.depth.period - 1
        around = prints(
            self.data,
            np.maximum(at - reach, self.starts[self.doc]),
            np.minimum(at + self.depth.length, self.ends[self.doc]),
        )
        # What is cut off by the document's ends is part of the rank.
        left = np.minimum(at - self.starts[self.doc], reach).astype(np.uint64)
        self.at, around = at, mix(around + left * np.uint64(0xD6E8FEB86659FD93))
        hot = flag[live] == 2
        first = self.first[live]
        keys = np.where(hot, mix(around * np.uint64(0xA0761D6478BD642F) + first), first) & self.depth.key_mask
        rank = around & np.uint64((1 << 64) - (1 << 16))
        # One entry for each key and rank, with the smallest document that has it.
        key_of_doc = self.doc_key[self.doc]
        order = np.lexsort((key_of_doc, rank, keys))
        new = np.ones(len(order), bool)
        new[1:] = (keys[order][1:] != keys[order][:-1]) | (rank[order][1:] != rank[order][:-1])
        entry = np.empty(len(order), np.int64)
        entry[order] = np.cumsum(new) - 1
        self.entry, chosen = entry, order[new]
        self.entry_key, self.entry_rank = keys[chosen], rank[chosen]
        self.entry_doc, self.entry_hot = key_of_doc[chosen], hot[chosen].astype(np.uint8)

    def suffixes(self, settled: np.ndarray) -> None:
        """Mark the matches, given for each entry 0 (none), 1 (all) or 2 (open), and list the open suffixes."""
        later = self.doc_key[self.doc] > self.entry_doc[self.entry]
        verdict = np.where(later, 1, settled[self.entry])
        low = np.maximum(self.at - self.depth.period + 1, self.starts[self.doc])
        high = np.minimum(self.at, self.ends[self.doc] - self.depth.length) + 1
        self.hit = _covered(len(self.data), low[verdict == 1], high[verdict == 1])
        self.open_at = np.nonzero(_covered(len(self.data), low[verdict == 2], high[verdict == 2]) & ~self.hit)[0]


class Open:
    """The matches of a chunk as far as ranks tell them, and the suffixes that they leave open."""

    def __init__(self, chunk: Chunk, depth: Depth, state: dict[int, bytes]):
        self.data, self.depth = chunk.data, depth
        self.hit = np.unpackbits(unpack(state[0], "u1"), count=len(chunk.data)).astype(bool)
        self.open_at = open_at = unpack_sorted(state[1], "<u8").astype(np.int64)
        whole = windows(self.data, open_at, depth.length)
        keys = np.array([_NULL_KEY if k is None else k for k in chunk.keys], np.int64)
        doc_key = keys[np.searchsorted(chunk.offsets[1:], open_at, "right")]
        order = np.lexsort((doc_key, whole))
        new = np.ones(len(order), bool)
        new[1:] = whole[order][1:] != whole[order][:-1]
        entry = np.empty(len(order), np.int64)
        entry[order] = np.cumsum(new) - 1
        chosen = order[new]
        self.open_entry, self.chosen = entry, open_at[chosen]
        self.open_key, self.open_doc = whole[chosen], doc_key[chosen]
        self.hit[open_at[doc_key > self.open_doc[entry]]] = True

    def check(self) -> np.ndarray:
        """24 more bits of each open entry, independent of its key."""
        return (windows(self.data, self.chosen, self.depth.length, point=1) >> np.uint64(40)).astype(np.uint32)

    def removed(self, found: np.ndarray) -> np.ndarray:
        """Which bytes go, given for each open entry whether a smaller document has it."""
        self.hit[self.open_at[found[self.open_entry] > 0]] = True
        at = np.nonzero(self.hit)[0]
        return _covered(len(self.data), at, at + self.depth.length)


def _covered(size: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in one of the ranges; empty ranges cover nothing."""
    real = low < high
    steps = np.zeros(size + 1, np.int32)
    np.add.at(steps, low[real], 1)
    np.add.at(steps, high[real], -1)
    return np.cumsum(steps[:-1]) > 0


def _in_order(answers: dict[int, bytes], dtype: str = "u1") -> np.ndarray:
    parts = [unpack(answers[b], dtype) for b in sorted(answers)]
    return np.concatenate(parts) if parts else np.empty(0, dtype)


def _shared(hot_chunks: int, columns: dict[str, np.ndarray], _: np.ndarray) -> np.ndarray:
    """Whether other chunks have a key (1), and whether very many have it (2)."""
    codes, distinct = pd.factorize(columns["key"])
    counts = np.bincount(codes, minlength=len(distinct))
    return np.where(counts > hot_chunks, 2, np.where(counts > 1, 1, 0)).astype(np.uint8)[codes]


def _settled(columns: dict[str, np.ndarray], _: np.ndarray) -> np.ndarray:
    """0: no smaller document and no other rank; 1: a smaller document has the rank; 2: other ranks may match."""
    keys, rank, doc = columns["key"], columns["rank"], columns["doc"]
    order = np.lexsort((doc, rank, keys))
    k, r, d = keys[order], rank[order], doc[order]
    new_key = np.ones(len(k), bool)
    new_key[1:] = k[1:] != k[:-1]
    new_rank = new_key.copy()
    new_rank[1:] |= r[1:] != r[:-1]
    least = d[np.nonzero(new_rank)[0]][np.cumsum(new_rank) - 1]
    key_number = np.cumsum(new_key) - 1
    several = np.bincount(key_number, new_rank)[key_number] > 1
    open_ = several | (columns["hot"][order] > 0)
    reply = np.empty(len(k), np.uint8)
    reply[order] = np.where(d > least, 1, np.where(open_, 2, 0))
    return reply


def _found(columns: dict[str, np.ndarray], _: np.ndarray) -> np.ndarray:
    """Whether a smaller document has the string."""
    keys, check, doc = columns["key"], columns["check"], columns["doc"]
    order = np.lexsort((doc, check, keys))
    k, c, d = keys[order], check[order], doc[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    reply = np.empty(len(k), np.uint8)
    reply[order] = d > d[np.nonzero(new)[0]][np.cumsum(new) - 1]
    return reply


def _asked(number: int, buckets: int, key: np.ndarray, **columns: np.ndarray) -> Iterator[dict]:
    for bucket, part in split(key, buckets):
        yield {"chunk": number, "bucket": bucket, "key": pack_sorted(key[part])} | {
            n: pack(c[part]) for n, c in columns.items()
        }


def remove_repeats(
    documents: DataFrame, key: str = "doc_id", text: str = "text", length: int = 50, with_text: bool = True,
    chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES, hot_chunks: int = HOT_CHUNKS,
) -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans, kept_sha256, and, unless ``with_text`` is off, ``kept``,
    the bytes that are left (cuts may fall within a character)."""
    if length < 7:
        raise ValueError("a match has at least 7 bytes")
    chunks = chunk_texts(documents.selectExpr(f"CAST(`{key}` AS BIGINT) AS `{key}`", f"`{text}`"), key, text, chunk_bytes)
    buckets = bucket_count(chunks, bucket_bytes)
    # Ten bits beyond the number of suffixes: about one false candidate in a thousand.
    depth = Depth(length, min(64, max(40, 34 + (buckets - 1).bit_length())))

    def ask_samples(chunk: Chunk) -> Iterator[dict]:
        yield from _asked(chunk.number, buckets, Work(chunk, depth).keys)

    def ranked(chunk: Chunk, shared: dict) -> Work:
        work = Work(chunk, depth)
        work.rank(_in_order(shared))
        return work

    def ask_ranks(chunk: Chunk, shared: dict) -> Iterator[dict]:
        w = ranked(chunk, shared)
        yield from _asked(chunk.number, buckets, w.entry_key, rank=w.entry_rank, doc=w.entry_doc, hot=w.entry_hot)

    def opened(chunk: Chunk, shared: dict, settled: dict) -> Iterator[dict]:
        work = ranked(chunk, shared)
        work.suffixes(_in_order(settled))
        for part, packed in enumerate((pack(np.packbits(work.hit)), pack_sorted(work.open_at.astype("<u8")))):
            yield {"chunk": chunk.number, "bucket": part, "answer": packed}

    def ask_suffixes(chunk: Chunk, state: dict) -> Iterator[dict]:
        w = Open(chunk, depth, state)
        yield from _asked(chunk.number, buckets, w.open_key, check=w.check(), doc=w.open_doc)

    def remove(chunk: Chunk, state: dict, found: dict) -> Iterator[dict]:
        gone = Open(chunk, depth, state).removed(_in_order(found))
        for doc, name in enumerate(chunk.keys):
            part = slice(*chunk.offsets[doc : doc + 2])
            own = gone[part]
            kept = chunk.data[part][~own].tobytes()
            yield {
                key: name, "n_bytes": len(own), "n_removed": int(own.sum()),
                "n_spans": int((own & ~np.concatenate([[False], own[:-1]])).sum()) if len(own) else 0,
                "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept,
            }

    head = "chunk bigint, bucket int, key binary"
    one = stored(answered(over_chunks(chunks, ask_samples, head), {"key": "<u8"}, functools.partial(_shared, hot_chunks)), "repeats-shared")
    two = stored(
        answered(
            over_chunks(chunks, ask_ranks, f"{head}, rank binary, doc binary, hot binary", [one]),
            {"key": "<u8", "rank": "<u8", "doc": "<i8", "hot": "u1"}, _settled,
        ),
        "repeats-settled",
    )
    state = stored(over_chunks(chunks, opened, "chunk bigint, bucket int, answer binary", [one, two]), "repeats-state")
    three = stored(
        answered(
            over_chunks(chunks, ask_suffixes, f"{head}, check binary, doc binary", [state]),
            {"key": "<u8", "check": "<u4", "doc": "<i8"}, _found,
        ),
        "repeats-found",
    )
    schema = f"{key} bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return over_chunks(chunks, remove, schema + (", kept binary" if with_text else ""), [state, three])
