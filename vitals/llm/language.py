"""Language identification by fusing evidence with Bayes' rule.

Four kinds of evidence about a text's language are combined: its letters (byte trigrams under a model
per language, and under a uniform model for text that is in none of them), the language that its markup
declares, its address suffix, and its host. How far a declaration or a suffix can be trusted is counted
over the whole table; hosts have priors smoothed towards the other hosts of their parent domain, these
towards the whole table, all by grouped aggregation. A host without dots, such as the name of a source, has
no suffix and no other hosts in its parent, so its prior is smoothed towards the whole table at once. A document is rejected when no language has ``min_confidence``, when
the fused evidence speaks for no language, or when its text has nothing but white space.

The trigram models are fitted on a bounded sample of rows that declare a language: about
``rows_per_language`` for each, chosen by a hash of the key. Everything else covers all rows.

A null text counts as empty and is rejected (``und``). A missing declaration or suffix is no evidence; a
missing host is a host of its own. Texts too short to tell count in no table. Repeated rows get equal results; an empty table gives an empty one.
Only the named columns are read. Counts are per host, so a host with a third of all rows is one row of
the priors; Spark splits its rows in the join.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, digest, digested, stored, utf8
from .url_filter import host_of

LANGUAGES = ("de", "en", "es", "fr")
#: The class of text in none of the languages.
UNKNOWN = "und"
_BINS = 1 << 16


@dataclass(frozen=True)
class FusionRules:
    rows_per_language: int = 2000
    #: Neighbouring trigrams overlap, so a text's evidence counts for a part only.
    text_weight: float = 0.3
    #: Pseudo-counts of declarations and suffixes, and of the parent in a prior.
    table_smoothing: float = 10.0
    prior_strength: float = 50.0
    min_confidence: float = 0.5


def _trigram_bins(data: np.ndarray) -> np.ndarray:
    """A bin for every three neighbouring bytes, ASCII letters in lower case, digits alike, space runs as they are."""
    b = _FOLD[data]
    return ((b[:-2].astype(np.uint32) * 31 + b[1:-1]) * 1031 + b[2:]) * np.uint32(2654435761) >> np.uint32(16)


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[48:58] = 48
_FOLD[[9, 10, 11, 12, 13]] = 32


def _per_text(table: np.ndarray, bins: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums (text, class) of the table's rows over the trigrams that lie within each text.

    One class at a time, so that memory is some twenty bytes for each byte of text.
    """
    ends = np.maximum(offsets[1:] - 2, offsets[:-1])
    sums = np.zeros((len(offsets) - 1, table.shape[1]))
    running = np.zeros(len(bins) + 1)
    for c in range(table.shape[1]):
        np.cumsum(table[:, c][bins], dtype=np.float64, out=running[1:])
        # Texts of no trigram may begin beyond the last one.
        low, high = np.minimum(offsets[:-1], len(bins)), np.minimum(ends, len(bins))
        sums[:, c] = running[high] - running[low]
    return sums


def trigram_counts(labelled: DataFrame) -> DataFrame:
    """(label, bin, n) of a frame (label, text); at most one row per label and bin."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, label in enumerate(batch.column(0).to_pylist()):
                own = data[offsets[i] : offsets[i + 1]]
                if len(own) > 2:
                    table = tables.setdefault(label, np.zeros(_BINS, np.int64))
                    table += np.bincount(_trigram_bins(own), minlength=_BINS)
        for label, table in tables.items():
            bins = np.nonzero(table)[0]
            yield pa.RecordBatch.from_pydict(
                {"label": pa.array([label] * len(bins)), "bin": pa.array(bins, pa.int32()), "n": pa.array(table[bins])}
            )

    counts = labelled.mapInArrow(count, "label string, bin int, n bigint")
    return counts.groupBy("label", "bin").agg(F.sum("n").alias("n"))


def fit_trigrams(
    documents: DataFrame, key: str, text: str, declared: str, languages: Sequence[str], rows_per_language: int
) -> np.ndarray:
    """Log-probabilities (bin, class) of the languages and, last, of the uniform model."""
    labelled = documents.select(
        F.col(declared).alias("label"), F.col(text).alias("text"), F.pmod(F.xxhash64(key), F.lit(1 << 20)).alias("draw")
    ).filter(F.col("label").isin(*languages) & F.col("text").isNotNull())
    sizes = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    chosen = reduce(
        Column.__or__,
        [(F.col("label") == l) & (F.col("draw") < int((1 << 20) * min(1.0, rows_per_language / n))) for l, n in sizes.items()],
        F.lit(False),
    )
    totals = np.zeros((len(languages), _BINS))
    # At most one row per language and bin.
    found = trigram_counts(labelled.filter(chosen).select("label", "text")).toArrow()
    which = np.array([languages.index(label) for label in found["label"].to_pylist()], np.int64)
    totals[which, found["bin"].to_numpy()] = found["n"].to_numpy()
    totals += 0.05
    logs = np.log(totals / totals.sum(axis=1, keepdims=True))
    return np.vstack([logs, np.full(_BINS, -np.log(_BINS))]).T.astype(np.float32).copy()


def text_evidence(documents: DataFrame, text: str, logs: np.ndarray, carried: Sequence[str]) -> DataFrame:
    """The carried columns, the bytes of the text other than space, and its log-likelihood per class."""
    classes = logs.shape[1]
    slim = documents.select(F.coalesce(F.col(text), F.lit("")).alias("text"), *carried)
    passed = slim.schema.fields[1:]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in passed) + ", n_filled bigint, logs array<double>"
    shared = documents.sparkSession.sparkContext.broadcast(logs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for row, data, offsets in blocks(batch.column(0)):
                n = len(offsets) - 1
                sums = np.zeros((n, classes))
                if len(data) > 2:
                    sums = _per_text(table, _trigram_bins(data), offsets)
                filled = np.concatenate([[0], np.cumsum(_FOLD[data] != 32)])
                counts = np.diff(filled[offsets])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(row, n) for c in batch.columns[1:]),
                        pa.array(counts, pa.int64()),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(n + 1) * classes, pa.int32()), pa.array(sums.ravel(), pa.float64())
                        ),
                    ],
                    names=[*(f.name for f in passed), "n_filled", "logs"],
                )

    return slim.mapInArrow(work, schema)


def _host_priors(rows: DataFrame, names: Sequence[str], top: np.ndarray, strength: float) -> DataFrame:
    """Class shares of each host, pulled towards those of its parent's other hosts, and these to the table's.

    A host's own counts are taken from its parent's, so that they count once.
    """
    of = lambda by: rows.groupBy(*by).agg(
        *[F.count_if(F.col("likely") == n).alias(f"n_{n}") for n in names], F.count("*").alias("n")
    )
    others = lambda c: F.col(f"p.{c}") - F.col(f"h.{c}")
    up = lambda i, n: (others(f"n_{n}") + strength * float(top[i])) / (others("n") + strength)
    return of(["host", "parent"]).alias("h").join(of(["parent"]).alias("p"), "parent").select(
        "host",
        F.array(*[
            (F.col(f"h.n_{n}") + strength * up(i, n)) / (F.col("h.n") + strength) for i, n in enumerate(names)
        ]).alias("prior"),
    )


def identify(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    declared: str = "lang",
    host: str | Column = "source",
    languages: Sequence[str] = LANGUAGES,
    rules: FusionRules = FusionRules(),
    row: Column | None = None,
) -> DataFrame:
    """Per row: key, language, confidence, text_language, declared, rejected, and ``row`` where it is given."""
    marked = [] if row is None else ["row"]
    names = [*languages, UNKNOWN]
    whole = documents.select(
        F.col(key).alias("id"),
        F.col(text).alias("text"),
        F.lower(F.col(declared)).alias("declared"),
        (F.col(host) if isinstance(host, str) else host).alias("host"),
        *([] if row is None else [row.alias("row")]),
    ).select(
        "id", "text", "declared", *marked,
        F.coalesce("host", F.lit("")).alias("host"),
        # The parent of a.b.c.d is c.d; a host without dots is its own.
        F.coalesce(F.substring_index("host", ".", -2), F.lit("")).alias("parent"),
        F.when(F.col("host").contains("."), F.substring_index("host", ".", -1)).otherwise("").alias("suffix"),
    )
    logs = fit_trigrams(whole, "id", "text", "declared", list(languages), rules.rows_per_language)
    seen = stored(
        text_evidence(whole, "text", logs, ["id", "declared", "host", "parent", "suffix", *marked])
        .withColumn(
            "likely",
            F.when(F.col("n_filled") < 3, UNKNOWN).otherwise(
                F.element_at(F.array(*map(F.lit, names)), F.array_position("logs", F.array_max("logs")).cast("int"))
            ),
        )
        .withColumn("declared", F.coalesce("declared", F.lit(""))),
        "language-evidence",
    )
    k = len(names)
    # How often each class declares what, and has which suffix: small tables, values against classes.
    told = seen.filter("n_filled > 2")
    whole_table = told.agg(*[F.count_if(F.col("likely") == n).alias(n) for n in names]).first()
    n_of = np.array([whole_table[n] for n in names], float)
    top = (n_of + 1) / (n_of.sum() + k)

    def reliability(column: str) -> DataFrame:
        """log P(value | class), smoothed by the value's share of the whole table."""
        total = float(max(n_of.sum(), 1))
        counts = told.groupBy(column).agg(
            *[F.count_if(F.col("likely") == n).alias(f"n_{n}") for n in names], F.count("*").alias("n")
        )
        return counts.select(
            column,
            F.array(*[
                F.log(
                    (F.col(f"n_{n}") + rules.table_smoothing * F.col("n") / total)
                    / (float(n_of[i]) + rules.table_smoothing)
                )
                for i, n in enumerate(names)
            ]).alias(f"{column}_log"),
        ).filter(F.col(column) != "")

    per_host = stored(_host_priors(told, names, top, rules.prior_strength), "language-priors")
    joined = (
        seen.join(per_host, "host", "left")
        .join(stored(reliability("declared"), "language-declared"), "declared", "left")
        .join(stored(reliability("suffix"), "language-suffix"), "suffix", "left")
    )
    # What no table has says nothing: no evidence of a value, and the whole table's shares of a host.
    nothing = F.array(*[F.lit(0.0)] * k)
    joined = joined.select(
        "id", "declared", "logs", "likely", "n_filled", *marked,
        F.coalesce("declared_log", nothing).alias("declared_log"), F.coalesce("suffix_log", nothing).alias("suffix_log"),
        F.coalesce("prior", F.array(*[F.lit(float(t)) for t in top])).alias("prior"),
    )
    scored = joined.withColumn(
        "evidence",
        F.array(*[
            rules.text_weight * F.col("logs")[i] + F.col("declared_log")[i] + F.col("suffix_log")[i] + F.log(F.col("prior")[i])
            for i in range(k)
        ]),
    ).withColumn("best", F.array_max("evidence"))
    return scored.select(
        F.col("id").alias(key),
        F.element_at(F.array(*map(F.lit, names)), F.array_position("evidence", F.col("best")).cast("int")).alias("fused"),
        (1 / F.aggregate("evidence", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("best")))).alias("share"),
        F.col("likely").alias("text_language"),
        F.nullif("declared", F.lit("")).alias("declared"),
        (F.col("n_filled") > 0).alias("lettered"),
        *marked,
    ).withColumn(
        "rejected",
        ~F.col("lettered") | (F.col("fused") == UNKNOWN) | (F.col("share") < rules.min_confidence),
    ).select(
        key,
        F.when(F.col("rejected"), UNKNOWN).otherwise(F.col("fused")).alias("language"),
        F.round("share", 6).alias("confidence"),
        "text_language", "declared", "rejected", *marked,
    )


#: Markup, and what is not prose: comments, programs, styles and menus.
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|nav)\b.*?(?:</\1\s*>|\Z)|<[a-z/!?][^<>]*>", re.I | re.S)


def page_text(page: str | None) -> str | None:
    """The text of a page, a space for each piece of markup."""
    return page if page is None else html.unescape(_MARKUP.sub(" ", page))


def identify_pages(
    pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", **options
) -> DataFrame:
    """``identify`` for web pages: host and suffix are those of the address, the language that of the html tag."""
    host = F.regexp_replace(host_of(F.col(url)), r"^.*@|\.?(?::\d*)?$", "")
    lang = F.regexp_extract(page, r"(?i)<html\b[^<>]*?\slang\s*=\s*[\"']?([a-z]{2,3})\b", 1)
    slim = pages.select(
        F.col(key).alias("id"), F.nullif(host, F.lit("")).alias("host"), F.nullif(F.lower(lang), F.lit("")).alias("lang"),
        F.col(page).alias("page"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                found = pa.array([page_text(p) for p in part.column(3).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:3], found], names=["id", "host", "lang", "text"])

    texts = slim.mapInArrow(work, f"id {slim.schema['id'].dataType.simpleString()}, host string, lang string, text string")
    found = identify(stored(texts, "language-pages"), "id", "text", "lang", "host", **options)
    return found.withColumnRenamed("id", key)


def keep_identified(
    documents: DataFrame, key: str = "doc_id", text: str = "text", declared: str = "lang",
    host: str | Column = "source", **options,
) -> DataFrame:
    """The documents that are not rejected, with all their columns.

    A decision is joined back by a digest of the key and of all it depends on, so rows that share a key, or
    have none, each follow their own.
    """
    row = digest(F.col(key), F.col(text), F.col(declared), F.col(host) if isinstance(host, str) else host)
    rejected = identify(documents, key, text, declared, host, row=row, **options).filter("rejected").select("row")
    return digested(documents, row).join(stored(rejected.distinct(), "language-rejected"), "row", "left_anti").select("doc.*")
