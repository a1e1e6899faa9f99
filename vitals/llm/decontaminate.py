"""Passages of benchmark items within documents, found by one Aho-Corasick automaton.

Texts are normalised to words: A-Z in lower case, words of ASCII letters, digits and whatever is not
ASCII. Every window of ``window`` consecutive words of an item (an item of fewer words is one window) is a
pattern. The automaton reads words, not characters: words of the patterns have numbers, any other word is
0 and leads back to the root. A document is read once, whole; overlapping and touching occurrences are
merged into spans, whose word numbers are mapped back to code points of the original text.

The automaton is bounded: benchmarks are cut into pieces of ``PIECE_WORDS`` windows, which overlap by a
window less one word, and pieces are dealt by hash to blocks of about ``BLOCK_WORDS`` words; words beyond
``LONG_WORD`` bytes stand as their SHA-256 there and in documents. So a block is at most some 7 MB, is
collected and broadcast by itself, and makes an automaton of at most a million states or so. A usual benchmark
is one block. A larger one is a stated query set read in blocks: a pass over the documents for each, every
pass adding to the spans and items of the passes before, which are stored in the shared folder.
Documents are never shuffled, whatever passage they share.

Documents: a null or empty text has no words; rows with a null, equal or repeated key are rows of their
own; an empty table gives an empty result. Items: a null or wordless text has no windows; rows that share an
id are one item; an item without id marks words but is neither counted nor listed. Without items nothing
is contaminated. Only the named columns are read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

WINDOW = 10
PIECE_WORDS = 1_000
BLOCK_WORDS = 100_000
LONG_WORD = 64

#: What normalising makes of every byte of UTF-8.
_FORM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
SPANS = "array<struct<begin: bigint, end: bigint>>"
RUNS = "array<struct<first: bigint, last: bigint>>"


def normal_words(text: bytes) -> list[bytes]:
    words = text.translate(_FORM).split()
    for i in [i for i, w in enumerate(words) if len(w) > LONG_WORD]:
        words[i] = b"\0" + hashlib.sha256(words[i]).hexdigest().encode()
    return words


def pieces(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """Distinct (item, words): the words of the items in overlapping pieces, joined by spaces."""
    slim = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{text}`").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
                words = normal_words(raw.as_py() or b"")
                windows = max(len(words) - window + 1, 1) if words else 0
                cut = [
                    b" ".join(words[i : min(i + PIECE_WORDS, windows) + window - 1]) for i in range(0, windows, PIECE_WORDS)
                ]
                if cut:
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(cut), pa.string()), pa.array(cut)], names=["item", "words"])

    return slim.mapInArrow(work, "item string, words binary").distinct()


def blocks_of(benchmark: DataFrame, item: str, text: str, window: int, block_words: int) -> Iterator[list]:
    """The blocks of pieces, one after the other; one empty block where there are no pieces."""
    cut = stored(pieces(benchmark, item, text, window), "benchmark-pieces")
    # A piece of n words holds n - 1 spaces.
    spaces = F.length(F.regexp_replace(F.col("words").cast("string"), "[^ ]", ""))
    total = cut.agg(F.sum(spaces + 1)).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    block = F.pmod(F.xxhash64("item", "words"), F.lit(blocks))
    for b in range(blocks):
        yield [(r.item, bytes(r.words)) for r in cut.filter(block == b).collect()]


class Windows:
    """The automaton of a block: ``numbers`` of words, and per pattern its length and its items."""

    def __init__(self, block: list[tuple[str | None, bytes]], window: int):
        self.numbers: dict[bytes, int] = {}
        self.patterns: list[tuple[int, set]] = []
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for item, joined in block:
            ids = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in joined.split(b" "))
            length = min(window, len(ids))
            for i in range(len(ids) - length + 1):
                pattern = ids[i : i + length]
                at = self.automaton.get(pattern, -1)
                if at < 0:
                    at = len(self.patterns)
                    self.automaton.add_word(pattern, at)
                    self.patterns.append((length, set()))
                if item is not None:
                    self.patterns[at][1].add(item)
        self.automaton.make_automaton()

    def occurrences(self, words: list[bytes], runs: list[tuple[int, int]], items: set) -> list[tuple[int, int]]:
        """Runs of hit words (first, last), merged with those given; the items found are added to ``items``."""
        number, seen, merged = self.numbers.get, set(), []
        if self.patterns:
            for last, at in self.automaton.iter(tuple([number(w, 0) for w in words])):
                seen.add(at)
                first = last - self.patterns[at][0] + 1
                while merged and first <= merged[-1][1] + 1:
                    first = min(first, merged.pop()[0])
                merged.append((first, last))
        for at in seen:
            items |= self.patterns[at][1]
        if not runs or not merged:
            return merged or runs
        joined = []
        for first, last in sorted(merged + runs):
            if joined and first <= joined[-1][1] + 1:
                joined[-1] = (joined[-1][0], max(joined[-1][1], last))
            else:
                joined.append((first, last))
        return joined


@functools.lru_cache(maxsize=1)
def _windows(block: Broadcast, window: int) -> Windows:
    return Windows(block.value, window)


def original(text: bytes, runs: list[tuple[int, int]]) -> list[dict]:
    """The code points (begin, end) of the original text that the runs of words cover."""
    if not runs:
        return []
    letter = np.frombuffer(text.translate(_FORM), np.uint8) != 32
    edge = np.diff(letter.astype(np.int8), prepend=0, append=0)
    points = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return [{"begin": int(points[starts[a]]), "end": int(points[ends[z]])} for a, z in runs]


def find_benchmark(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per row: key, n_words, n_hit, items (ids as strings, sorted), spans (code points, end exclusive)."""
    spark = documents.sparkSession
    named = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = named.schema["key"].dataType.simpleString()
    rest = f"n_words bigint, runs {RUNS}, items array<string>, spans {SPANS}"
    schema = f"key {kind}, text string, {rest}"
    state = spark.createDataFrame([], schema).schema
    frame = named.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in state.fields[2:]])

    def passed(frame: DataFrame, block: list) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            windows = _windows(shared, window)
            for batch in batches:
                counts, all_runs, all_items, all_spans = [], [], [], []
                texts = batch.column(1).cast(pa.large_binary())
                for raw, given, known in zip(texts, batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                    raw = raw.as_py() or b""
                    words, items = normal_words(raw), set(known or ())
                    runs = windows.occurrences(words, [(r["first"], r["last"]) for r in given or ()], items)
                    counts.append(len(words))
                    all_runs.append([{"first": a, "last": z} for a, z in runs])
                    all_items.append(sorted(items))
                    all_spans.append(original(raw, runs))
                made = [counts, all_runs, all_items, all_spans]
                kinds = [batch.schema.field(i).type for i in (2, 3, 4, 5)]
                columns = [pa.array(m, k) for m, k in zip(made, kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=batch.schema.names)

        return frame.mapInArrow(work, schema)

    for n, block in enumerate(blocks_of(benchmark, item, item_text, window, block_words)):
        frame = passed(stored(frame, "contaminated") if n else frame, block)
    n_hit = F.aggregate("runs", F.lit(0).cast("bigint"), lambda n, r: n + r["last"] - r["first"] + 1)
    return frame.select(F.col("key").alias(key), "n_words", n_hit.alias("n_hit"), F.array_sort("items").alias("items"), "spans")
