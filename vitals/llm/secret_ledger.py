r"""Secret scans with an incremental ledger of blobs.

Every version of every text is addressed by the hash of its content. A ledger holds which blob was
scanned with which version of which rule, and what was found. A run scans only blobs, and of these only
rules, that the ledger does not have, appends one row per scanned blob in one write, and joins the
findings of all blobs back to all paths that hold them. A run that fails appends nothing.

A finding is the leftmost, longest-repetition match of a rule's pattern; matches do not overlap within a
rule, and those whose checked group is too short are dropped. Spans count code points, end exclusive.
Positions follow from the lengths of a rule's matches and of the text between them.

A null text counts as empty and has no findings. Rows that repeat a path, and paths with a null name,
each get the findings of their own text. Equal texts are one blob, however many rows hold it. An empty
table gives an empty result and leaves the ledger as it is. Only path and text are read. Everything is
DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .common import stored


@dataclass(frozen=True)
class SecretRule:
    kind: str
    pattern: str
    version: int = 1
    #: A match counts if this group has so many characters.
    group: int = 0
    min_chars: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


BASE_RULES = (
    SecretRule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2, min_chars=6,
    ),
    # Longest runs only, so the least length can be part of the pattern.
    SecretRule("access", r"AKIA[A-Z0-9]{16,}"),
    SecretRule("hex", r"[0-9a-f]{24,}"),
)
RULES = (
    *BASE_RULES,
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

_FINDING = "struct<rule:string,start:int,end:int>"


def spans(text: Column, rule: SecretRule) -> Column:
    """The rule's findings in a text."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    checked = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    # What precedes each match, and the match itself; what follows the last match has no match.
    steps = F.filter(
        F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), found.alias("hit"), checked.alias("part")),
        lambda s: s["hit"].isNotNull(),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_FINDING}>").alias("out"))

    def step(state: Column, s: Column) -> Column:
        begin = state["at"] + F.length(s["gap"])
        end = begin + F.length(s["hit"])
        one = F.array(F.struct(F.lit(rule.name).alias("rule"), begin.alias("start"), end.alias("end")))
        keep = F.length(s["part"]) >= rule.min_chars
        return F.struct(end.alias("at"), F.when(keep, F.concat(state["out"], one)).otherwise(state["out"]).alias("out"))

    walked = F.aggregate(steps, start, step, lambda state: state["out"])
    return F.when(text.rlike(rule.pattern), walked).otherwise(F.array().cast(f"array<{_FINDING}>"))


def _ledger(spark, path: str) -> DataFrame:
    schema = f"digest binary, rules array<string>, findings array<{_FINDING}>"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan(versions: DataFrame, ledger: str, path: str = "doc_id", text: str = "text", rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """Scan what the ledger lacks; per row of ``versions``: path, digest and all findings under these rules."""
    spark = versions.sparkSession
    names = F.array(*[F.lit(r.name) for r in rules])
    blobs = versions.select(F.col(path).alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text")).select(
        "path", F.unhex(F.sha2("text", 256)).alias("digest"), "text"
    )
    addressed = stored(blobs.select("path", "digest"), "secret-blobs")
    done = _ledger(spark, ledger).groupBy("digest").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("done"))
    # One path stands for each blob.
    unseen = stored(
        addressed.groupBy("digest").agg(F.min("path").alias("path"))
        .join(done, "digest", "left")
        .select("digest", "path", F.array_except(names, F.coalesce("done", F.array().cast("array<string>"))).alias("todo"))
        .filter(F.size("todo") > 0),
        "secret-unseen",
    )
    if not unseen.isEmpty():
        found = F.concat(*[
            F.when(F.array_contains("todo", r.name), spans(F.col("text"), r)).otherwise(F.array().cast(f"array<{_FINDING}>"))
            for r in rules
        ])
        scanned = (
            blobs.alias("b").join(unseen.alias("u"), F.expr("b.digest = u.digest AND b.path <=> u.path"))
            .select("b.digest", F.col("todo").alias("rules"), found.alias("findings"))
        )
        # Rows that repeat path and text are one blob too; their equal entries are merged when read.
        scanned.write.mode("append").parquet(ledger)
    known = (
        _ledger(spark, ledger)
        .select("digest", F.explode("findings").alias("f"))
        .filter(F.col("f.rule").isin(*[r.name for r in rules]))
        .groupBy("digest")
        .agg(F.collect_set("f").alias("findings"))
    )
    return addressed.join(known, "digest", "left").select(
        F.col("path").alias(path), "digest", F.coalesce("findings", F.array().cast(f"array<{_FINDING}>")).alias("findings")
    )


def scans_of(spark: SparkSession, ledger: str) -> DataFrame:
    """(digest, n_scans): with how many versions of rules each blob has been scanned, over all runs."""
    all_of = _ledger(spark, ledger).groupBy("digest").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("rules"))
    return all_of.select("digest", F.size("rules").cast("bigint").alias("n_scans"))


def _joined(findings: Column, rules: Sequence[SecretRule]) -> Column:
    """kind:start:end of the findings under these rules, by start, then rule as listed."""
    names = F.array(*[F.lit(r.name) for r in rules])
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    keyed = F.transform(
        F.filter(findings, lambda f: F.array_contains(names, f["rule"])),
        lambda f: F.struct(f["start"].alias("start"), F.array_position(names, f["rule"]).cast("int").alias("place"), f["end"].alias("end")),
    )
    return F.array_join(
        F.transform(F.array_sort(keyed), lambda k: F.concat_ws(":", F.element_at(kinds, k["place"]), k["start"], k["end"])), ","
    )


def digest_spans(scanned: DataFrame, path: str = "doc_id", rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, and all spans as text."""
    count = lambda r: F.size(F.filter("findings", lambda f: f["rule"] == r.name)).cast("bigint").alias(f"n_{r.kind}")
    return scanned.select(
        path, *[count(r) for r in BASE_RULES],
        F.sha2(_joined(F.col("findings"), BASE_RULES), 256).alias("base_sha256"),
        _joined(F.col("findings"), rules).alias("spans"), *[c for c in scanned.columns if c == "n_scans"],
    )
