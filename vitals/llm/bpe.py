"""Byte-level BPE encoding and decoding with a transducer of frequent words.

The vocabulary file gives tokens and merges; nothing is trained. Texts are cut into words by the
byte-level pattern of the vocabulary's family. All words of the table are counted, the frequent ones are
merged once on the driver and compiled, with their ids, into a minimal acyclic transducer of bounded
size. Its file goes to the executors with Spark's file distribution and is memory-mapped there. Words
that it lacks are merged exactly, lowest rank first, so results do not depend on which words it holds.

A null text counts as empty: no ids, and the empty text decoded. The special token's string in a text is
the special token, as in the library. Every row is encoded by itself: repeated rows get equal results,
an empty table an empty one. Columns other than key and text are not read. A text is handled whole;
blocks of texts are cut by size, so memory is a multiple of the longest text or of a block.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from .common import blocks, stored
from .lexicon import compile_lexicon, look_up

#: Words in the transducer at most; bounds its file to about 10 MB.
LEXICON_WORDS = 1 << 17
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)


@functools.cache
def _classes() -> np.ndarray:
    """The kind of every code point, by the Unicode tables of the tokenizers library."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    everything, place = "".join(map(chr, points)), np.array(points)
    table = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
        # What is not of this kind is left out, so the pieces are the characters of this kind.
        others = pre_tokenizers.Split(Regex(f"[^{pattern}]+"), "removed")
        for _, (begin, end) in others.pre_tokenize_str(everything):
            table[place[begin:end]] = kind
    return table


def words_of(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where words begin, as byte positions, in texts that begin at ``bounds``; the pattern is
    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+ on each text."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(points)
    if not n:
        return np.empty(0, np.int64)
    if n == len(data):
        place, begins = None, bounds
    else:
        lead = (data & 0xC0) != 0x80
        place = np.nonzero(lead)[0]
        begins = np.searchsorted(place, bounds)
    kind = _classes()[points]
    text_start = np.zeros(n + 1, bool)
    text_start[begins] = True
    text_start[n] = True
    run_start = text_start[:-1].copy()
    run_start[1:] |= kind[1:] != kind[:-1]
    space = kind == _SPACE
    # The last of a run of white space that a word follows: it goes with the word if it is a blank.
    last = space.copy()
    last[:-1] &= ~space[1:] & ~text_start[1:-1]
    last[-1] = False
    joined = np.zeros(n, bool)
    joined[1:] = last[:-1] & (points[:-1] == 32)
    start = (run_start & ~joined) | last
    for i in np.nonzero((points == 39) & start & (kind == _OTHER))[0]:
        end = i + 1
        while end < n and end < i + 3 and kind[end] == _LETTER and not text_start[end]:
            end += 1
        tail = points[i + 1 : end].tobytes().decode("utf-32-le")
        size = 2 if tail[:1] in ("s", "t", "m", "d") and tail else 3 if tail in ("re", "ve", "ll") else 0
        if size:
            start[i + 1] = False
            if i + size < n and not text_start[i + size]:
                start[i + size] = True
    at = np.nonzero(start)[0]
    return at if place is None else place[at]


class Vocabulary:
    """Tokens as bytes and merges as ranks, from a vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        # Visible characters stand for bytes: printable Latin-1 for themselves, the others from 256 on.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ids = {token: i for token, i in whole["model"]["vocab"].items()}
        self.tokens = {i: bytes(byte_of[c] for c in token) for token, i in ids.items()}
        self.special = {t["content"].encode(): t["id"] for t in whole["added_tokens"]}
        self.tokens |= {i: text for text, i in self.special.items()}
        self.byte_ids = [0] * 256
        for c, b in byte_of.items():
            self.byte_ids[b] = ids[c]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(whole["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[left], ids[right]] = (rank, ids[left + right])

    def merge(self, word: bytes) -> list[int]:
        """Ids of a word: the pair of lowest rank is merged, the leftmost of equals, until none is left."""
        symbols = [self.byte_ids[b] for b in word]
        return self._merge_long(symbols) if len(symbols) > 100 else self._merge_short(symbols)

    def _merge_short(self, symbols: list[int]) -> list[int]:
        known = self.merges.get
        ranked = [known(pair) for pair in zip(symbols, symbols[1:])]
        while True:
            best, at = None, -1
            for i, found in enumerate(ranked):
                if found is not None and (best is None or found[0] < best[0]):
                    best, at = found, i
            if best is None:
                return symbols
            symbols[at : at + 2] = [best[1]]
            del ranked[at]
            if at:
                ranked[at - 1] = known((symbols[at - 1], best[1]))
            if at < len(ranked):
                ranked[at] = known((best[1], symbols[at + 1]))

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The same with a heap, for words whose length would make the plain way slow."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(found[0], i, pair) for i, pair in enumerate(zip(symbols, symbols[1:])) if (found := self.merges.get(pair))]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i] if symbols[i] >= 0 else n
            if j >= n or (symbols[i], symbols[j]) != pair:
                continue
            symbols[i], symbols[j] = self.merges[pair][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if found := self.merges.get(new := (symbols[i], symbols[after[i]])):
                    heapq.heappush(heap, (found[0], i, new))
            if before[i] >= 0 and (found := self.merges.get(new := (symbols[before[i]], symbols[i]))):
                heapq.heappush(heap, (found[0], before[i], new))
        return [s for s in symbols if s >= 0]

    def token_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """All tokens one after the other, and where each id's begins."""
        texts = [self.tokens.get(i, b"") for i in range(max(self.tokens) + 1)]
        return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])


def _gather(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """pool[start : start + size] of all pieces, one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


def _segments(data: np.ndarray, offsets: np.ndarray, special: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Where texts begin once special tokens are cut out, and the ids of the parts (-1: ordinary text)."""
    cuts: dict[int, int] = {}
    whole = data.tobytes()
    for text, i in special.items():
        at = whole.find(text)
        while at >= 0:
            row = np.searchsorted(offsets, at, "right")
            if at + len(text) <= offsets[row]:
                cuts[at] = i
                cuts.setdefault(at + len(text), -1)
                at = whole.find(text, at + len(text))
            else:
                at = whole.find(text, at + 1)
    begins = np.unique(np.concatenate([offsets[:-1], np.fromiter(cuts, np.int64, len(cuts))]))
    begins = begins[begins < len(data)]
    ids = np.full(len(begins), -1, np.int64)
    for at, i in cuts.items():
        if i >= 0:
            ids[np.searchsorted(begins, at)] = i
    return begins, ids


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    hashes = np.full(len(starts), 0xCBF29CE484222325, np.uint64)
    live, at = np.arange(len(starts)), starts.copy()
    while len(live):
        hashes[live] = (hashes[live] ^ data[at]) * np.uint64(0x100000001B3)
        at = at + 1
        on = at < ends[live]
        live, at = live[on], at[on]
    return hashes


def count_words(documents: DataFrame, text: str, special: dict[bytes, int]) -> DataFrame:
    """(word, n) over all texts. Words of one block whose hashes collide are counted as one of them,
    which at worst leaves a word out of the transducer."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[bytes, int] = {}
            for _, data, offsets in blocks(batch.column(0)):
                begins, kinds = _segments(data, offsets, special)
                starts = words_of(data, begins)
                ends = np.append(starts[1:], len(data))
                _, first, n = np.unique(_word_hashes(data, starts, ends), return_index=True, return_counts=True)
                raw = data.tobytes()
                for s, e, c in zip(starts[first].tolist(), ends[first].tolist(), n.tolist()):
                    word = raw[s:e]
                    counts[word] = counts.get(word, 0) + c
            yield pa.RecordBatch.from_pydict(
                {"word": pa.array(counts.keys(), pa.binary()), "n": pa.array(counts.values(), pa.int64())}
            )

    return documents.select(text).mapInArrow(work, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int) -> list[bytes]:
    """The words above the lowest frequency, in steps of a sixteenth of an octave, that keeps them within ``most``.

    Words of more than 64 bytes stay out, which bounds the automaton.
    """
    step = F.floor(F.log2("n") * 16).cast("int")
    short = stored(counts.filter(F.length("word") <= 64).withColumn("step", step), "bpe-words")
    total, lowest = 0, None
    for row in short.groupBy("step").count().orderBy(F.desc("step")).collect():  # at most 16 * 64 rows
        total += row["count"]
        if total > most:
            break
        lowest = row["step"]
    if lowest is None:
        return []
    return sorted(bytes(r["word"]) for r in short.filter(F.col("step") >= lowest).select("word").collect())


def _save(arrays: dict[str, np.ndarray], path: str) -> dict[str, tuple[int, str, int]]:
    """Write the arrays one after the other; where each lies, its type and its length."""
    places = {}
    with open(path, "wb") as file:
        for name, array in arrays.items():
            file.write(b"\0" * (-file.tell() % 64))
            places[name] = (file.tell(), array.dtype.str, len(array))
            file.write(array.tobytes())
        file.write(b"\0" * 64)
    return places


def _mapped(path: str, places: dict[str, tuple[int, str, int]]) -> dict[str, np.ndarray]:
    whole = np.memmap(path, np.uint8, "r")
    return {
        name: whole[at : at + n * np.dtype(kind).itemsize].view(kind).view(np.ndarray)
        for name, (at, kind, n) in places.items()
    }


class Encoder:
    """Encodes blocks of texts; keeps ids of recent words that the transducer lacks."""

    def __init__(self, vocabulary: Vocabulary, lexicon: dict[str, np.ndarray], recent: int = 1 << 15):
        self.vocabulary, self.lexicon, self.recent = vocabulary, lexicon, recent
        self.unseen: dict[bytes, list[int]] = {}
        self.token_pool, self.token_starts = vocabulary.token_bytes()

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where those of each text begin."""
        begins, kinds = _segments(data, offsets, self.vocabulary.special)
        starts = words_of(data, begins)
        ends = np.append(starts[1:], len(data))
        sizes = np.zeros(len(starts), np.int64)
        at = np.zeros(len(starts), np.int64)
        numbers = look_up(self.lexicon, data, starts, ends) if len(starts) else np.empty(0, np.int32)
        special_at = np.nonzero(kinds >= 0)[0]
        own: list[int] = []
        special = np.zeros(len(starts), bool)
        if len(special_at):
            # A special token's words become one word with its id and others without ids.
            stop = np.append(begins[1:], len(data))
            for i in special_at:
                inside = slice(*np.searchsorted(starts, [begins[i], stop[i]]))
                special[inside] = True
                at[inside.start], sizes[inside.start] = len(own), 1
                own.append(int(kinds[i]))
        raw = data.tobytes()
        base = len(self.lexicon["ids"])
        at[special] += base
        known = (numbers >= 0) & ~special
        found = numbers[known]
        at[known] = self.lexicon["id_starts"][found]
        sizes[known] = self.lexicon["id_starts"][found + 1] - at[known]
        for w in np.nonzero((numbers < 0) & ~special)[0].tolist():
            word = raw[starts[w] : ends[w]]
            ids = self.unseen.get(word)
            if ids is None:
                if len(self.unseen) >= self.recent:
                    self.unseen.clear()
                ids = self.vocabulary.merge(word)
                if len(word) <= 256:
                    self.unseen[word] = ids
            at[w], sizes[w] = base + len(own), len(ids)
            own.extend(ids)
        pool = np.concatenate([self.lexicon["ids"], np.array(own, np.int32)])
        ids = _gather(pool, at, sizes).astype("<u4")
        before = np.concatenate([[0], np.cumsum(sizes)])
        return ids, before[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, and where those of each id begin."""
        starts = self.token_starts[ids]
        sizes = self.token_starts[ids + 1] - starts
        return _gather(self.token_pool, starts, sizes), np.concatenate([[0], np.cumsum(sizes)])


@functools.lru_cache(maxsize=1)
def _encoder(name: str, places: tuple, vocabulary) -> Encoder:
    return Encoder(vocabulary.value, _mapped(SparkFiles.get(name), dict(places)))


def build_lexicon(words: list[bytes], vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    return compile_lexicon(words, [vocabulary.merge(w) for w in words])


def _with_encoder(
    documents: DataFrame, key: str, text: str, vocabulary_path: str, most: int, columns: dict[str, tuple[str, pa.DataType]],
    rows: Callable[[Encoder, np.ndarray, np.ndarray], list[list]], keep: Sequence[str] = (),
) -> DataFrame:
    """The key of each row, columns to ``keep``, and the columns that ``rows`` makes of blocks of texts."""
    spark = documents.sparkSession
    vocabulary = Vocabulary(vocabulary_path)
    words = frequent_words(count_words(documents, text, vocabulary.special), most)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    folder = tempfile.mkdtemp(prefix="lexicon-")
    places = tuple(_save(build_lexicon(words, vocabulary), os.path.join(folder, name)).items())
    # Spark's file server hands the driver's file to every executor, also to those that join later.
    spark.sparkContext.addFile(os.path.join(folder, name))
    shared = spark.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, places, shared)
        for batch in batches:
            for row, data, offsets in blocks(batch.column(1)):
                made = rows(encoder, data, offsets)
                kept = [batch.column(c).slice(row, len(offsets) - 1) for c in (0, *range(2, batch.num_columns))]
                yield pa.RecordBatch.from_arrays(
                    kept
                    + [values if isinstance(values, pa.Array) else pa.array(values, kind) for values, (_, kind) in zip(made, columns.values(), strict=True)],
                    names=["key", *keep, *columns],
                )

    slim = documents.select(F.col(key).alias("key"), F.col(text).alias("text"), *[F.col(f"`{c}`") for c in keep])
    carried = {"key": slim.schema["key"], **{c: slim.schema[c] for c in keep}}
    named = {n: f.dataType.simpleString() for n, f in carried.items()} | {n: t for n, (t, _) in columns.items()}
    schema = ", ".join(f"`{n}` {t}" for n, t in named.items())
    return slim.mapInArrow(work, schema).withColumnRenamed("key", key)


def _texts(encoder: Encoder, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """The decoded texts; bytes that are no UTF-8 are replaced as the library does."""
    data, starts = encoder.decode(ids)
    raw = data.tobytes()
    cuts = starts[bounds].tolist()
    return [raw[a:b].decode("utf-8", "replace").encode() for a, b in zip(cuts, cuts[1:])]


def encode(
    documents: DataFrame, key: str = "doc_id", text: str = "text",
    vocabulary: str = VOCABULARY, lexicon_words: int = LEXICON_WORDS,
) -> DataFrame:
    """Per row: key, ids, and the text decoded from the ids."""

    def rows(encoder: Encoder, data: np.ndarray, offsets: np.ndarray) -> list[list]:
        ids, bounds = encoder.encode(data, offsets)
        each = [ids[a:b].astype(np.int32) for a, b in zip(bounds[:-1], bounds[1:])]
        return [each, [t.decode() for t in _texts(encoder, ids, bounds)]]

    columns = {"ids": ("array<int>", pa.list_(pa.int32())), "decoded": ("string", pa.string())}
    return _with_encoder(documents, key, text, vocabulary, lexicon_words, columns, rows)


def encode_digests(
    documents: DataFrame, key: str = "doc_id", text: str = "text",
    vocabulary: str = VOCABULARY, lexicon_words: int = LEXICON_WORDS, keep: Sequence[str] = (), with_ids: bool = False,
) -> DataFrame:
    """Per row: key, columns to ``keep``, n_tokens, the hashes of its ids and of its decoded text, and, if asked
    for, the ``ids`` themselves."""

    def rows(encoder: Encoder, data: np.ndarray, offsets: np.ndarray) -> list[list]:
        ids, bounds = encoder.encode(data, offsets)
        raw, cuts = ids.tobytes(), (bounds * 4).tolist()
        return [
            np.diff(bounds),
            [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(cuts, cuts[1:])],
            [hashlib.sha256(t).hexdigest() for t in _texts(encoder, ids, bounds)],
            *([pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))] if with_ids else []),
        ]

    columns = {
        "n_tokens": ("bigint", pa.int64()), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string()),
    } | ({"ids": ("array<int>", pa.list_(pa.int32()))} if with_ids else {})
    return _with_encoder(documents, key, text, vocabulary, lexicon_words, columns, rows, keep)
