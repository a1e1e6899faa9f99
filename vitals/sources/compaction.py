"""Compaction of hour partitions: the batches of an hour become one set of files.

Streams and jobs add batches to a table, a folder each below their hour, so an hour fills with small files.
``compact`` writes the rows of such hours anew, as one set, beside the table (``<table>.sets``), where no
stream that follows the table sees it. Then it publishes a manifest that says, per hour, which set is in force
and which batches are in it. That is one rename: before it readers see the batches, after it the set, never
both. ``lake.read_table`` and ``lake.read_hours`` follow the manifest by predicates on partition columns, so
replaced folders are not read. Batches added meanwhile are in no set and stay in force.

A replaced batch stays where it is until ``vacuum`` deletes it, and that is once every stream named as a
consumer has noted the batch as taken. So a running stream neither reads a row twice nor misses one. A replaced
batch that is written again stays replaced; it has the same rows, as batches are named by their content or origin.

Two compactions of one table may run at a time: the second to publish finds its version taken and fails; its
set is in no manifest and goes with the next vacuum. A compaction that crashed before it published left nothing
in force. The manifest holds names of folders, those of the hours that the table keeps.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.lineage import Hour
from ..schemas import PARTITIONS
from . import lake as tables
from .files import hadoop
from .lake import BATCH, Lake
from .manifest import SET, Manifest, publish, read_manifest, read_sets, sets_path


def listed(spark: SparkSession, path: str) -> dict[Hour, list[str]]:
    """The batches of every hour, from the names of folders."""
    found = defaultdict(list)
    for dt, hour, batch in tables.folders_below(spark, path, *PARTITIONS, BATCH):
        found[dt, hour].append(batch)
    return found


def compact(
    spark: SparkSession, path: str, schema: StructType, file_format: str,
    min_batches: int = 2, hours: Sequence[Hour] | None = None,
) -> list[Hour]:
    """Bring the hours with ``min_batches`` batches or more, a set counting as one, into one set each."""
    manifest = read_manifest(spark, path)
    chosen = {}
    for hour, batches in listed(spark, path).items():
        fresh = sorted(set(batches) - set(manifest.batches.get(hour, ())))
        if fresh and len(fresh) + (hour in manifest.sets) >= min_batches and (hours is None or hour in hours):
            chosen[hour] = fresh
    if not chosen:
        return []
    fresh = [(*hour, b) for hour, batches in chosen.items() for b in batches]
    rows = tables.read_batches(spark, path, schema, file_format, fresh).select(schema.fieldNames())
    earlier = [f"{h[0]}/{h[1]}/{manifest.sets[h]}" for h in chosen if h in manifest.sets]
    if earlier:
        rows = rows.unionByName(read_sets(spark, path, schema, file_format, earlier))
    # Named by what is in it, so a compaction that crashed is repeated in its place.
    name = hashlib.sha256(json.dumps([sorted(fresh), sorted(earlier)]).encode()).hexdigest()[:24]
    named = tables.by_hour(rows.withColumn(SET, F.lit(name)))
    tables.write_partitions(named, sets_path(path), file_format, *PARTITIONS, SET)
    sets = manifest.sets | dict.fromkeys(chosen, name)
    batches = manifest.batches | {h: [*manifest.batches.get(h, ()), *added] for h, added in chosen.items()}
    publish(spark, path, Manifest(manifest.version + 1, sets, batches))
    return sorted(chosen)


def vacuum(
    spark: SparkSession, lake: Lake, path: str, consumers: Sequence[str] = (), rereaders: Sequence[str] = ()
) -> list[str]:
    """Delete replaced batches that all consumers have taken, and sets no longer in force.

    What a rereader has taken stays, as it reads batches again by their names. Run it when no reader is older
    than the last compaction. Returns the batches deleted (dt/hour/batch).
    """
    manifest = read_manifest(spark, path)
    gone = set(manifest.replaced())
    days = F.col("dt").isin(sorted({h[0] for h in manifest.batches}))

    def taken(layer: str) -> set[str]:
        # As many rows as there are folders that wait.
        return {f"{r.dt}/{r.hour}/{r.source}" for r in tables.read_taken(spark, lake, layer).where(days).collect()}

    for layer in consumers:
        gone &= taken(layer)
    for layer in rereaders:
        gone -= taken(layer)
    present = [(dt, hour, b) for (dt, hour), names in listed(spark, path).items() for b in names]
    deleted = sorted(f"{dt}/{hour}/{b}" for dt, hour, b in present if f"{dt}/{hour}/{b}" in gone)
    for name in deleted:
        files, folder = hadoop(spark, tables.batch_folder(path, *name.split("/")))
        files.delete(folder, True)
    keep = set(manifest.in_force())
    for dt, hour, name in tables.folders_below(spark, sets_path(path), *PARTITIONS, SET):
        if f"{dt}/{hour}/{name}" not in keep:
            files, folder = hadoop(spark, f"{tables.hour_folder(sets_path(path), dt, hour)}/{SET}={name}")
            files.delete(folder, True)
    return deleted
