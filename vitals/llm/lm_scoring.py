"""Language-model scores by deleted interpolation.

Bigram, unigram and uniform estimates are mixed with weights that depend on how often the context was
seen, in octaves of its count:

    P(w | u) = a(u) count(u, w) / count(u) + b(u) count(w) / N + c(u) / (V + 1)

A text is its words, in lower case (A-Z), and one end; an end is also what precedes the first word.
Counts are over the training documents, those whose key's crc32 modulo ``folds`` is not ``held_out``. The
weights are learned by expectation-maximisation on one more fold of the training documents, ``deleted``:
its counts are taken from all counts to get estimates that have not seen it. The final score uses all
training counts with these weights.

Words and pairs are counted across chunks of texts: every chunk asks for the counts of the words and pairs
it holds and gives its own. Words are told apart by 63 bits of two independent polynomial fingerprints, pairs by
63 bits of those of their words; two of n different keys are mistaken for one another with a chance of n**2 / 2**64.
Rounds of EM run over a table of the deleted fold's counts; only sums per octave (65 at most) reach the driver.

A null text counts as empty and has one token, its end. A null key is the text '' to crc32. Rows that
repeat are scored, and counted, each. Without training documents every text has score 0. An empty table
gives an empty result. Only key and text are read.
"""

from __future__ import annotations

import warnings
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .exchange import Chunk, answered, bucket_count, chunk_texts, over_chunks, pack, pack_sorted, split, unpack
from .prints import mix, places, prints

#: Bytes with A-Z in lower case and all white space as blanks.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9:14] = 32
#: The fingerprint of an end; no word is looked at for it.
_END = np.uint64(0x5851F42D4C957F2D)
_COUNTS = [("train", "<u8"), ("deleted", "<u8"), ("own", "u1")]
OCTAVES = 65
#: Weights that move less in a round are learned.
SETTLED = 1e-4


@dataclass(frozen=True)
class Folds:
    folds: int = 7
    held_out: int = 2
    deleted: int = 3

    def of(self, key: object) -> int:
        return zlib.crc32(("" if key is None else str(key)).encode()) % self.folds


def octave(counts: np.ndarray) -> np.ndarray:
    """0 for 0, else one more than the whole part of the binary logarithm."""
    result = np.zeros(len(counts), np.int64)
    seen = counts > 0
    result[seen] = np.frexp(counts[seen].astype(np.float64))[1]
    return result


class Tokens:
    """The words and pairs of a chunk, as places in one ascending list of keys.

    The lowest bit of a key tells words (0) from pairs (1).
    """

    def __init__(self, chunk: Chunk, folds: Folds):
        # A word begins after white space or with its text, and ends likewise.
        data = _FOLD[chunk.data]
        space = np.concatenate([[True], data == 32, [True]])
        begins = np.zeros(len(data) + 1, bool)
        begins[chunk.offsets] = True
        starts = np.nonzero(~space[1:-1] & (space[:-2] | begins[:-1]))[0]
        ends = np.nonzero(~space[1:-1] & (space[2:] | begins[1:]))[0] + 1
        doc = np.searchsorted(chunk.offsets, starts, "right") - 1
        sizes = np.bincount(doc, minlength=len(chunk.keys)) + 1
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        hashes = np.full(int(sizes.sum()), _END, np.uint64)
        own = prints(data, starts, ends) + mix(prints(data, starts, ends, point=1) * np.uint64(0x9E3779B97F4A7C15))
        hashes[np.arange(len(starts)) + doc] = mix(own)
        context = np.concatenate([[_END], hashes[:-1]]).astype(np.uint64)
        self.fold = np.array([folds.of(k) for k in chunk.keys])
        fold = np.repeat(self.fold, sizes)
        pair = mix(context * np.uint64(0x9E3779B97F4A7C15) + hashes)
        self.keys, place = places(np.concatenate([hashes & ~np.uint64(1), pair | np.uint64(1)]))
        n = len(hashes)
        self.word, self.pair = place[:n], place[n:]
        # The place of a context is that of the word before; an end precedes each text.
        self.context = np.concatenate([[self.word[self.ends[0] - 1]], self.word[:-1]])
        count = lambda rows: np.bincount(np.concatenate([self.word[rows], self.pair[rows]]), minlength=len(self.keys))
        self.train = count(fold != folds.held_out).astype(np.uint32)
        self.deleted = count(fold == folds.deleted).astype(np.uint32)
        self.in_deleted = fold == folds.deleted


def _sums(columns: dict[str, np.ndarray], _: np.ndarray) -> np.ndarray:
    """For each entry the sums over all entries of its key, and whether it is the first of them."""
    codes, distinct = pd.factorize(columns["key"])
    reply = np.empty(len(codes), _COUNTS)
    for name in ("train", "deleted"):
        # Sums of whole numbers in double precision are exact to 2**53.
        reply[name] = np.bincount(codes, columns[name], len(distinct)).astype(np.uint64)[codes]
    first = np.empty(len(distinct), np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    reply["own"] = 0
    reply["own"][first] = 1
    return reply


def _answer(answers: dict[int, bytes]) -> np.ndarray:
    return np.concatenate([unpack(answers[b], np.dtype(_COUNTS)) for b in sorted(answers)])


def learn_weights(statistics: DataFrame, n_words: int, n_known: int, rounds: int = 1000) -> np.ndarray:
    """Weights (octave, order) of pair, word and uniform estimates by expectation-maximisation.

    ``statistics`` has packed columns octave, pair (an estimate), word (a count) and n, for each word that
    the deleted fold has in a context. An octave without any takes the weights of the nearest below.
    Rounds go on until no weight moves by ``SETTLED``; where ``rounds`` do not suffice, a warning says so.
    """
    weights = np.full((OCTAVES, 3), 1 / 3)
    weights[0] = (0, 0.5, 0.5)
    if not n_words:
        return np.tile([0.0, 0.0, 1.0], (OCTAVES, 1))

    def expect(current: np.ndarray):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((OCTAVES, 3))
            for batch in batches:
                for row in batch.to_pylist():
                    level, n = unpack(row["octave"], "u1"), unpack(row["n"], "<u4")
                    parts = current[level] * np.stack(
                        [
                            unpack(row["pair"], "<f4"),
                            unpack(row["word"], "<f4") / n_words,
                            np.full(len(level), 1 / (n_known + 1)),
                        ],
                        axis=1,
                    )
                    parts *= (n / parts.sum(axis=1))[:, None]
                    for order in range(3):
                        sums[:, order] += np.bincount(level, parts[:, order], OCTAVES)
            level, order = np.nonzero(sums)
            yield pa.RecordBatch.from_pydict(
                {"octave": pa.array(level, pa.int32()), "part": pa.array(order, pa.int32()), "mass": sums[level, order]}
            )

        return work

    for _ in range(rounds):
        sums = np.zeros((OCTAVES, 3))
        shares = statistics.mapInArrow(expect(weights), "octave int, part int, mass double")
        for row in shares.groupBy("octave", "part").agg(F.sum("mass").alias("mass")).collect():
            sums[row["octave"], row["part"]] = row["mass"]
        seen = sums.sum(axis=1) > 0
        # Sums of fractions depend on their order in the last digits; the weights should not.
        found = np.round(sums[seen] / sums[seen].sum(axis=1, keepdims=True), 9)
        moved = np.abs(found - weights[seen]).max(initial=0.0)
        weights[seen] = found
        for level in np.nonzero(~seen)[0]:
            if level > 1:
                weights[level] = weights[level - 1]
        if moved < SETTLED:
            break
    else:
        warnings.warn(f"weights still moved by {moved:.1e} after {rounds} rounds", RuntimeWarning, stacklevel=2)
    return weights


def score(
    documents: DataFrame, key: str = "doc_id", text: str = "text", folds: Folds = Folds(), **sizes: int
) -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    chunks = chunk_texts(documents, key, text, **{k: v for k, v in sizes.items() if k == "chunk_bytes"})
    buckets = bucket_count(chunks, **{k: v for k, v in sizes.items() if k == "bucket_bytes"})

    def ask(chunk: Chunk) -> Iterator[dict]:
        t = Tokens(chunk, folds)
        for bucket, part in split(t.keys, buckets):
            yield {
                "chunk": chunk.number, "bucket": bucket, "key": pack_sorted(t.keys[part]),
                "train": pack(t.train[part]), "deleted": pack(t.deleted[part]),
            }

    asked = over_chunks(chunks, ask, "chunk bigint, bucket int, key binary, train binary, deleted binary")
    counts = stored(answered(asked, {"key": "<u8", "train": "<u4", "deleted": "<u4"}, _sums), "lm-counts")

    def tell(chunk: Chunk, given: dict) -> Iterator[dict]:
        """What the chunk adds to the totals, and the statistics of its deleted documents."""
        t, c = Tokens(chunk, folds), _answer(given)
        is_word = (t.keys & np.uint64(1)) == 0
        rest = (c["train"] - c["deleted"]).astype(np.float64)
        at = np.nonzero(t.in_deleted)[0]
        _, first, n = np.unique(t.pair[at], return_index=True, return_counts=True)
        at = at[first]
        context, pair = rest[t.context[at]], rest[t.pair[at]]
        yield {
            "train": int(t.train[is_word].sum()), "deleted": int(t.deleted[is_word].sum()),
            "known": int(((c["own"] > 0) & is_word & (c["train"] > 0)).sum()),
            "octave": pack(octave(context).astype(np.uint8)),
            "pair": pack(np.divide(pair, context, out=np.zeros(len(at)), where=context > 0).astype(np.float32)),
            "word": pack(rest[t.word[at]].astype(np.float32)), "n": pack(n.astype(np.uint32)),
        }

    statistics = stored(
        over_chunks(
            chunks, tell,
            "train bigint, deleted bigint, known bigint, octave binary, pair binary, word binary, n binary", [counts],
        ),
        "lm-statistics",
    )
    total = statistics.agg(F.sum("train").alias("train"), F.sum("deleted").alias("deleted"), F.sum("known").alias("known")).first()
    n_train, n_known = total["train"] or 0, total["known"] or 0
    weights = learn_weights(statistics.select("octave", "pair", "word", "n"), n_train - (total["deleted"] or 0), n_known)

    def finish(chunk: Chunk, given: dict) -> Iterator[dict]:
        t, c = Tokens(chunk, folds), _answer(given)
        seen = c["train"].astype(np.float64)
        word, context, pair = seen[t.word], seen[t.context], seen[t.pair]
        mix = weights[octave(context)]
        likely = (
            mix[:, 0] * np.divide(pair, context, out=np.zeros(len(word)), where=context > 0)
            + mix[:, 1] * word / max(n_train, 1)
            + mix[:, 2] / (n_known + 1)
        )
        logs, base = np.log10(likely), np.log10((word + 1) / (n_train + n_known + 1))
        known = (word > 0).astype(np.int64)
        for i, name in enumerate(chunk.keys):
            part = slice(t.starts[i], t.ends[i])
            yield {
                key: name, "held_out": bool(t.fold[i] == folds.held_out), "n_tokens": int(t.ends[i] - t.starts[i]),
                "n_known": int(known[part].sum()), "train_tokens": n_train,
                "base_score": float(base[part].sum()), "score": float(logs[part].sum()),
            }

    kind = documents.schema[key].dataType.simpleString()
    return over_chunks(
        chunks, finish,
        f"{key} {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
        [counts],
    )
