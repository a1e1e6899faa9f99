"""The event tables of the given input by day, stored once and read by the reports.

A report of a day or an hour reads that day's files: ``dt`` is the partition, and rows are in the order of ``hour``,
so an hour is a few row groups of its day. A table is named by the files of its input and by the plan that makes it;
whoever needs it first writes it, beside its place, and moves it there whole.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import enrich, gold, quality
from ..schemas import BRONZE, GOLD, QUARANTINE, SILVER
from ..session import configure, scratch_root
from ..sources import derived
from ..sources.files import hadoop, move_new, path_exists
from ..sources.lake import read_table
from .fixed import processed_at


def _input_files(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files of a table."""
    files, root = hadoop(spark, path)
    found = sorted(
        f"{s.getPath().getName()} {s.getLen()} {s.getModificationTime()}" for s in files.listStatus(root) if not s.isDirectory()
    )
    return "\n".join([path, *found])


def _stored(spark: SparkSession, sf: str, name: str, schema, rows: DataFrame) -> DataFrame:
    # Without the numbers that each session and each use of a lambda count anew.
    plan = re.sub(r"#\d+L?|_\d+\b", "", rows._jdf.queryExecution().analyzed().toString())
    digest = hashlib.sha256("\n".join([_input_files(spark, f"{sf}/events.parquet"), plan]).encode()).hexdigest()[:24]
    path = f"{scratch_root(configure(spark))}/daily/{name}-{digest}"
    if not path_exists(spark, path):
        own = f"{path}.{uuid.uuid4().hex}"
        dealt = rows.select(schema.fieldNames()).hint("rebalance", "dt").sortWithinPartitions("dt", "hour")
        dealt.write.partitionBy("dt").parquet(own)
        move_new(spark, own, path)
    return read_table(spark, path, schema)


def _table(build: Callable[[SparkSession, str], DataFrame], schema) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: _stored(spark, sf, build.__name__.strip("_"), schema, build(spark, sf))


def _bronze(spark: SparkSession, sf: str) -> DataFrame:
    return derived.bronze(derived.raw_events(spark, sf))


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.to_silver(quality.classify(derived.raw_events(spark, sf)), processed_at())


def _quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return quality.rejected(quality.classify(quality.with_arrival(bronze(spark, sf))))


def _gold(spark: SparkSession, sf: str) -> DataFrame:
    return gold.gold_hourly(silver(spark, sf), processed_at())


bronze = _table(_bronze, BRONZE)
silver = _table(_silver, SILVER)
quarantine = _table(_quarantine, QUARANTINE)
gold_hours = _table(_gold, GOLD)
