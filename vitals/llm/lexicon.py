"""A minimal acyclic transducer from words to lists of ids, in flat arrays that can be memory-mapped.

The words form an automaton whose equal suffixes are shared, built from sorted words. Every transition
carries how many words come before it below its state; the sum along a word's path is the word's number
in sorted order, and the ids of all words lie one after the other in that order. So states are shared
between words with different ids.

A state keeps its outgoing bytes as 256 bits, and how many lie before each 64 of them, so that a transition
is found by counting bits. Many words are looked up at once, one byte of each per step.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np


def _minimal(words: Iterable[bytes]) -> tuple[list[dict[int, int]], list[bool]]:
    """Transitions and final flags of the minimal automaton of sorted, distinct words; state 0 is the root."""
    edges: list[dict[int, int]] = [{}]
    final: list[bool] = [False]
    known: dict[tuple, int] = {}
    free: list[int] = []
    path: list[tuple[int, int, int]] = []  # (parent, byte, child) of the last word, not yet shared
    last = b""

    def share(down_to: int) -> None:
        while len(path) > down_to:
            parent, byte, child = path.pop()
            shape = (final[child], tuple(edges[child].items()))
            same = known.setdefault(shape, child)
            if same != child:
                edges[parent][byte] = same
                free.append(child)

    for word in words:
        common = 0
        for x, y in zip(word, last):
            if x != y:
                break
            common += 1
        share(common)
        state = path[-1][2] if path else 0
        for byte in word[common:]:
            if free:
                child = free.pop()
                edges[child], final[child] = {}, False
            else:
                child = len(edges)
                edges.append({})
                final.append(False)
            edges[state][byte] = child
            path.append((state, byte, child))
            state = child
        final[state] = True
        last = word
    share(0)
    return edges, final


def compile_lexicon(words: Sequence[bytes], ids: Sequence[Sequence[int]]) -> dict[str, np.ndarray]:
    """Arrays of the transducer of the words, sorted and distinct, each with its ids."""
    edges, final = _minimal(words)
    below: dict[int, int] = {}
    stack = [0]
    while stack:  # words that end at or below a state, children first
        state = stack[-1]
        missing = [t for t in edges[state].values() if t not in below]
        if missing:
            stack.extend(missing)
        else:
            below[state] = final[state] + sum(below[t] for t in edges[state].values())
            stack.pop()
    order = {state: i for i, state in enumerate(sorted(below))}
    bits = np.zeros((len(order), 4), np.uint64)
    first = np.zeros((len(order), 4), np.int32)
    to, before = [], []
    for state, i in order.items():
        words_before = int(final[state])
        counts = [0, 0, 0, 0]
        begin = len(to)
        for byte in sorted(edges[state]):
            bits[i, byte >> 6] |= np.uint64(1 << (byte & 63))
            counts[byte >> 6] += 1
            to.append(order[edges[state][byte]])
            before.append(words_before)
            words_before += below[edges[state][byte]]
        first[i] = begin + np.cumsum([0, *counts[:3]])
    return {
        "bits": bits.ravel(),
        "first": first.ravel(),
        "to": np.array(to, np.int32),
        "before": np.array(before, np.int32),
        "final": np.array([final[s] for s in order], bool),
        "id_starts": np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]).astype(np.int32),
        "ids": np.array([i for x in ids for i in x], np.int32),
    }


def look_up(lexicon: dict[str, np.ndarray], data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Numbers of the words data[start:end]; -1 for those that the lexicon lacks. Words are not empty."""
    bits, first, to, before, final = (lexicon[n] for n in ("bits", "first", "to", "before", "final"))
    result = np.full(len(starts), -1, np.int32)
    if not len(to):
        return result
    word = np.arange(len(starts), dtype=np.int32)
    at = starts.astype(np.int64)
    left = (ends - starts).astype(np.int32)
    state = np.zeros(len(starts), np.int32)
    number = np.zeros(len(starts), np.int32)
    while len(word):
        byte = data[at]
        quarter = state * 4 + (byte >> 6)
        here = bits[quarter]
        shift = (byte & 63).astype(np.uint64)
        edge = first[quarter] + np.bitwise_count(here & ((np.uint64(1) << shift) - np.uint64(1)))
        has = (here >> shift & np.uint64(1)).astype(bool)
        edge[~has] = 0
        state, number, left = to[edge], number + before[edge], left - 1
        ended = has & (left == 0)
        done = ended & final[state]
        result[word[done]] = number[done]
        on = has & ~ended
        word, state, number, left, at = word[on], state[on], number[on], left[on], at[on] + 1
    return result
