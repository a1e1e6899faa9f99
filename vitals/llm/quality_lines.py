"""Quality rules that clean lines first and judge documents by what is left.

A line with a word fails when it has no sentence end or a symbol for every other word (punctuation), when it
is mostly short items between separators (navigation), when it repeats an earlier line of its text, or when it holds a
phrase of site boilerplate. Failing lines are removed. A document is rejected when it failed one of
the base rules (too few words, too many repeated words) or keeps too small a share of its words.

Null and empty texts have no words and are rejected; a null key is passed on. Each row is judged by
itself, so repeated rows get equal results and an empty table an empty one. Columns other than key and
text are not read. A text is handled whole; memory is a small multiple of the longest text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_SPACES = " \t\n\v\f\r"
_SYMBOLS = "#*$%&|<>"
_SENTENCE_END = re.compile(r"[.!?…。！？][\"'”’»)\]]*(?:\s|$)")
_SEPARATORS = re.compile(r"[|»›•·]")
_BOILERPLATE = re.compile(
    r"all rights reserved|terms of (?:use|service)|privacy policy|cookie (?:policy|settings)|we use cookies"
    r"|javascript|lorem ipsum|click here to|sign up for our newsletter|skip to (?:main )?content",
    re.IGNORECASE,
)


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the rules."""

    min_words: int = 50
    max_repeated_percent: int = 50
    #: A line is navigation when it has this many separators, and at least one to so many words.
    min_separators: int = 3
    words_per_separator: int = 4
    #: A line with more symbols for its words than this fails as punctuation.
    max_symbols_per_word: float = 0.5
    #: A document must keep this share of its words.
    min_kept_share: float = 0.5


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words which the text holds at least twice."""
    n = len(words)
    if n < 4:
        return 0
    codes: dict[bytes, int] = {}
    c = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, n)
    # Ranks of pairs first: the product of two ranks of one text stays far below 2**63.
    pair = np.unique(c[:-1] * len(codes) + c[1:], return_inverse=True)[1]
    triple = pair[:-1] * len(codes) + c[2:]
    _, rank, counts = np.unique(triple, return_inverse=True, return_counts=True)
    again = counts[rank] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(covered.sum())


def failing_rule(line: str, n_words: int, rules: LineRules) -> str | None:
    """The first rule that a line with words fails."""
    separators = len(_SEPARATORS.findall(line))
    if separators >= rules.min_separators and separators * rules.words_per_separator >= n_words:
        return "navigation"
    if _BOILERPLATE.search(line):
        return "boilerplate"
    symbols = sum(line.count(c) for c in _SYMBOLS)
    if symbols > rules.max_symbols_per_word * n_words or not _SENTENCE_END.search(line):
        return "punctuation"
    return None


def judge(text: str, rules: LineRules) -> tuple:
    words = text.encode().split()
    n_words = len(words)
    seen: set[str] = set()
    kept_lines: list[str] = []
    n_lines = n_dup = kept_words = 0
    for line in text.split("\n"):
        line_words = len(line.encode().split())
        if not line_words:
            continue
        n_lines += 1
        if line in seen:
            n_dup += 1
            continue
        seen.add(line)
        if failing_rule(line, line_words, rules) is None:
            kept_lines.append(line)
            kept_words += line_words
    repeat = repeated_words(words)
    base_failed = n_words < rules.min_words or 100 * repeat > rules.max_repeated_percent * n_words
    return (
        n_words,
        len(text) - sum(text.count(c) for c in _SPACES),
        sum(text.count(c) for c in _SYMBOLS),
        n_dup,
        repeat,
        base_failed,
        not base_failed and kept_words >= rules.min_kept_share * n_words,
        n_lines,
        n_lines - len(kept_lines),
        kept_words,
        "\n".join(kept_lines),
    )


_FIELDS = [
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("n_lines", pa.int64()),
    ("n_lines_removed", pa.int64()), ("n_words_kept", pa.int64()), ("cleaned", pa.string()),
]


def clean(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    rules: LineRules = LineRules(),
    with_text: bool = True,
) -> DataFrame:
    """Per document: measures, verdict and, unless ``with_text`` is off, the cleaned text."""
    fields = _FIELDS if with_text else _FIELDS[:-1]
    slim = documents.select(key, text)
    schema = f"`{key}` {slim.schema[0].dataType.simpleString()}, " + ", ".join(
        f"{n} {'bigint' if t == pa.int64() else 'boolean' if t == pa.bool_() else 'string'}" for n, t in fields
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                judged = [judge(t or "", rules) for t in part.column(1).to_pylist()]
                columns = list(zip(*judged, strict=True))[: len(fields)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True))],
                    names=[key, *(n for n, _ in fields)],
                )

    return slim.mapInArrow(work, schema)
