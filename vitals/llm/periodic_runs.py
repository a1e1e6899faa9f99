"""Maximal periodic runs of words, found by internal pattern matching in dyadic blocks.

A run is a stretch of words with a smallest period q, at least ``min_exponent`` periods and ``min_length``
words long, that no neighbouring word extends. For every power of two b, the blocks of b words that begin
at multiples of b/2 are looked for in the window that follows them: a wavelet tree over the suffix array
of the words gives the next occurrence of a block, as the least position above its own among the suffixes
that begin with it. Within a run with b/2 < q <= b, a block's occurrences are an arithmetic progression of
difference q (a primitive word of length q occurs in its powers at multiples of q only), so the distance
to the next occurrence is the candidate period. Four periods hold at least one such block, whatever the
alignment, so no run is missed. Neighbouring blocks with one candidate are one progression; less than b/2
words on either side of it are compared word by word, which gives the run's ends exactly. A stretch found
so has no smaller period, as the block would have occurred sooner.

Words are compared, never hashed, and numbered per batch of texts; suffixes are sorted by doubling, only
those not yet alone in their class. All queries of a batch go through the tree together. Memory is a few
dozen bytes per word of the batch, which is about 100,000 words or one longer text. Nothing is shuffled.

A null or empty text has no words and no runs; texts with a null, equal or repeated key are rows of their
own; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of texts that are searched together.
BATCH_WORDS = 100_000

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class WaveletTree:
    """An array of numbers below 2**bits, split level by level by their bits; ranges of it are queried in bulk."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        for bit in reversed(range(bits)):
            zero = (values >> bit) & 1 == 0
            packed = np.zeros((len(values) >> 6) + 1, np.uint64)
            raw = np.packbits(zero, bitorder="little")
            packed.view(np.uint8)[: len(raw)] = raw
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed[:-1]), dtype=np.int64)])
            self.levels.append((packed, before, int(np.count_nonzero(zero))))
            values = np.concatenate([values[zero], values[~zero]])

    @staticmethod
    def _zeros(level, i: np.ndarray) -> np.ndarray:
        """How many of the first i entries of a level have a zero bit."""
        packed, before, _ = level
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(packed[word] & below)

    def successor(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The least entry above ``value`` within [low, high), -1 where there is none."""
        lo, hi, above, smaller = low, high, value + 1, np.zeros(len(low), np.int64)
        for i, level in enumerate(self.levels):
            zlo, zhi = self._zeros(level, lo), self._zeros(level, hi)
            one = (above >> (self.bits - 1 - i)) & 1 == 1
            smaller += np.where(one, zhi - zlo, 0)
            lo, hi = np.where(one, level[2] + lo - zlo, zlo), np.where(one, level[2] + hi - zhi, zhi)
        found = np.flatnonzero(smaller < high - low)
        lo, hi, rank = low[found], high[found], smaller[found]
        entry = np.zeros(len(found), np.int64)
        for i, level in enumerate(self.levels):
            zlo, zhi = self._zeros(level, lo), self._zeros(level, hi)
            zeros = zhi - zlo
            one = rank >= zeros
            entry += np.where(one, 1 << (self.bits - 1 - i), 0)
            rank = rank - np.where(one, zeros, 0)
            lo, hi = np.where(one, level[2] + lo - zlo, zlo), np.where(one, level[2] + hi - zhi, zhi)
        result = np.full(len(low), -1, np.int64)
        result[found] = entry
        return result


def suffixes(words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
    """The suffix array of several texts, one after the other, and the blocks that occur more than once.

    ``words`` are numbers, ``begin`` and ``end`` the limits of each word's text. No suffix leaves its text,
    and the suffixes of a text stand together. Blocks come per level as (length, starts, low, high): the
    suffixes that begin with the block at a start are those at [low, high) of the array. Sorting stops at
    half the longest text, beyond which no block is asked for.
    """
    n = len(words)
    order = np.lexsort((words, begin))
    change = (np.diff(words[order], prepend=-1) != 0) | (np.diff(begin[order], prepend=-1) != 0)
    change[:1] = True
    firsts = np.flatnonzero(change)
    sizes = np.diff(np.append(firsts, n))
    array, rank = order, np.empty(n, np.int64)
    rank[order] = np.repeat(firsts, sizes)
    size = np.repeat(sizes, sizes)
    slots = np.flatnonzero(size > 1)
    size, width, longest = size[slots], 1, int((end - begin).max(initial=0))
    blocks = []
    while len(slots) and 2 * width <= longest:
        at = array[slots]
        low, stop = rank[at], end[at]
        own = ((at - begin[at]) % max(1, width // 2) == 0) & (at + width <= stop)
        blocks.append((width, at[own], low[own], (low + size)[own]))
        # Suffixes alike in the first words are ordered by those that follow them; a text's end is first.
        after = np.where(at + width < stop, rank[np.minimum(at + width, n - 1)], -1)
        order = np.lexsort((after, low))
        at, low, after = at[order], low[order], after[order]
        array[slots] = at
        change = (np.diff(low, prepend=-1) != 0) | (np.diff(after, prepend=-2) != 0)
        firsts = np.flatnonzero(change)
        sizes = np.diff(np.append(firsts, len(at)))
        rank[at] = np.repeat(slots[firsts], sizes)
        size = np.repeat(sizes, sizes)
        slots, size = slots[size > 1], size[size > 1]
        width *= 2
    return array, blocks


def runs_of(
    words: np.ndarray, begin: np.ndarray, end: np.ndarray, min_length: int, min_exponent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, period) of all runs of the texts, by start, then period."""
    array, blocks = suffixes(words, begin, end)
    found = [np.empty((3, 0), np.int64)]
    if blocks:
        tree = WaveletTree(array - begin[array], int((end - begin).max()).bit_length())
        starts, low, high = (np.concatenate([b[i] for b in blocks]) for i in (1, 2, 3))
        distance = tree.successor(low, high, starts - begin[starts]) - (starts - begin[starts])
        ends = np.cumsum([len(b[1]) for b in blocks])
        for (width, at, _, _), d in zip(blocks, np.split(distance, ends[:-1])):
            step = max(1, width // 2)
            near = (d > width // 2) & (d <= width)
            order = np.argsort(at[near])
            at, d = at[near][order], d[near][order]
            if not len(at):
                continue
            split = (np.diff(at) != step) | (np.diff(d) != 0) | (np.diff(begin[at]) != 0)
            last = np.append(np.flatnonzero(split), len(at) - 1)
            first = np.append(0, last[:-1] + 1)
            left, right, period = at[first], at[last] + width, d[first]
            if step > 1:
                steps = np.arange(1, step)
                back = left[:, None] - steps
                same = (back >= begin[left][:, None]) & (words[back] == words[back + period[:, None]])
                left = left - np.logical_and.accumulate(same, axis=1).sum(axis=1)
                ahead = right[:, None] + steps - 1 + period[:, None]
                inside = ahead < end[left][:, None]
                ahead = np.where(inside, ahead, 0)
                same = inside & (words[ahead] == words[ahead - period[:, None]])
                right = right + np.logical_and.accumulate(same, axis=1).sum(axis=1)
            stop = right + period
            long = stop - left >= np.maximum(min_length, min_exponent * period)
            found.append(np.stack([left[long], stop[long], period[long]]))
    start, stop, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


def _searched(keys: pa.Array, texts: list[list[bytes]], min_length: int, min_exponent: int) -> pa.RecordBatch:
    numbers: dict[bytes, int] = {}
    sizes = np.array([len(t) for t in texts], np.int64)
    words = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64, int(sizes.sum()))
    limits = np.concatenate([[0], np.cumsum(sizes)])
    begin, end = np.repeat(limits[:-1], sizes), np.repeat(limits[1:], sizes)
    start, stop, period = runs_of(words, begin, end, min_length, min_exponent)
    # Words after a run's first period go.
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, stop, -1)
    stays = np.cumsum(depth[:-1]) == 0
    own = np.searchsorted(limits, start, "right") - 1
    text_of = np.searchsorted(own, np.arange(len(texts) + 1))
    collapsed = []
    for i, text in enumerate(texts):
        if text_of[i] < text_of[i + 1]:
            text = [text[k] for k in np.flatnonzero(stays[limits[i] : limits[i + 1]])]
        collapsed.append(b" ".join(text))
    runs = pa.StructArray.from_arrays(
        [pa.array(start - limits[own]), pa.array(stop - start), pa.array(period)], ["start", "length", "period"]
    )
    return pa.RecordBatch.from_arrays(
        [
            keys,
            pa.array(sizes),
            pa.ListArray.from_arrays(pa.array(text_of, pa.int32()), runs),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ],
        names=["key", "n_words", "runs", "collapsed"],
    )


def find_runs(
    documents: DataFrame, key: str = "doc_id", text: str | Column = "text", min_length: int = 6, min_exponent: int = 4
) -> DataFrame:
    """Per row: key, n_words, runs (by start, then period; word numbers from 0) and the collapsed text.

    Collapsing drops the words that a run contains after its first period and joins the rest by spaces.
    """
    if min_exponent < 4:
        raise ValueError("blocks at half their length are sure to lie in runs of four periods or more only")
    slim = documents.select(F.col(f"`{key}`").alias("key"), (F.col(text) if isinstance(text, str) else text).alias("text"))
    kind = slim.schema["key"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, held, first = [], 0, 0
            for i, raw in enumerate(batch.column(1).cast(pa.large_binary())):
                texts.append((raw.as_py() or b"").split())
                held += len(texts[-1])
                if held >= BATCH_WORDS or i + 1 == batch.num_rows:
                    yield _searched(batch.column(0).slice(first, len(texts)), texts, min_length, min_exponent)
                    texts, held, first = [], 0, i + 1

    return slim.mapInArrow(work, f"key {kind}, n_words bigint, runs {RUNS}, collapsed string").withColumnRenamed("key", key)


def run_digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The run of the greatest exact exponent (ties: smallest start, then period), and hashes of runs and text."""
    steeper = lambda a, b: a["length"] * b["period"] - b["length"] * a["period"]
    best = F.aggregate(
        "runs",
        F.get("runs", F.lit(0)),
        # Runs come by start, then period, so the first of equal ones stays.
        lambda kept, run: F.when(steeper(run, kept) > 0, run).otherwise(kept),
    )
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    return found.withColumn("best", best).select(
        key, F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(F.expr("(1000 * best.length) div best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
