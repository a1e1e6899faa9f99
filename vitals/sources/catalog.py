"""The event tables as external, partitioned tables of the catalog, for sessions that know only their names.

Partitions are registered one by one, each with its folder, so planning a query lists the folders of the partitions
it needs and no others, and a compacted hour is the partition of its set. ``publish`` brings the catalog up to date
with the lake: it adds partitions that are new and drops those that compaction replaced or expiry deleted. What it
handles are names of folders. A session's catalog must outlive it for others to see the tables; the tables'
files belong to the lake and stay when a table is dropped.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from ..schemas import BRONZE, GOLD, PARTITIONS, QUARANTINE, SILVER
from .compaction import listed
from .lake import BATCH, Lake, batch_folder, folders_below, hour_folder
from .manifest import SET, read_manifest, sets_path

#: Partitions added or dropped by one statement.
AT_ONCE = 200
Partition = tuple[str, ...]


def _create(spark: SparkSession, table: str, path: str, schema: StructType, file_format: str, by: list[str]) -> None:
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in by]
    columns += [f"`{name}` string" for name in by]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}) USING {file_format} "
        f"PARTITIONED BY ({', '.join(by)}) LOCATION '{path}'"
    )


def _folders(spark: SparkSession, path: str, by: list[str]) -> dict[Partition, str]:
    """The partitions in force, and where their files are."""
    if BATCH not in by:
        return {hour: hour_folder(path, *hour) for hour in folders_below(spark, path, *PARTITIONS)}
    manifest = read_manifest(spark, path)
    replaced = set(manifest.replaced())
    found = {
        (*hour, batch): batch_folder(path, *hour, batch)
        for hour, batches in listed(spark, path).items()
        for batch in batches
        if f"{hour[0]}/{hour[1]}/{batch}" not in replaced
    }
    # Expiry deletes folders and leaves the manifest.
    present = set(folders_below(spark, sets_path(path), *PARTITIONS, SET))
    sets = {
        (*h, f"set-{s}"): f"{hour_folder(sets_path(path), *h)}/{SET}={s}" for h, s in manifest.sets.items() if (*h, s) in present
    }
    return found | sets


def _spec(by: list[str], partition: Partition) -> str:
    return ", ".join(f"{name}='{value}'" for name, value in zip(by, partition, strict=True))


def _bring_up_to_date(spark: SparkSession, table: str, by: list[str], wanted: Mapping[Partition, str]) -> tuple[int, int]:
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    known = {tuple(part.split("=", 1)[1] for part in row[0].split("/")) for row in rows}
    new, gone = sorted(set(wanted) - known), sorted(known - set(wanted))
    # Before the new ones are in, a reader sees a compacted hour without its rows rather than twice.
    for i in range(0, len(gone), AT_ONCE):
        specs = ", ".join(f"PARTITION ({_spec(by, p)})" for p in gone[i : i + AT_ONCE])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    for i in range(0, len(new), AT_ONCE):
        specs = " ".join(f"PARTITION ({_spec(by, p)}) LOCATION '{wanted[p]}'" for p in new[i : i + AT_ONCE])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
    return len(new), len(gone)


def publish(spark: SparkSession, lake: Lake, database: str = "default") -> dict[str, tuple[int, int]]:
    """Create the four event tables where they lack, and bring their partitions up to date: how many were added
    and dropped, by table."""
    with_batches = [*PARTITIONS, BATCH]
    tables = {
        "bronze_events": (lake.bronze, BRONZE, "json", with_batches),
        "silver_events": (lake.silver, SILVER, "parquet", with_batches),
        "quarantine_events": (lake.quarantine, QUARANTINE, "json", with_batches),
        "gold_device_hourly": (lake.gold, GOLD, "parquet", PARTITIONS),
    }
    changed = {}
    for name, (path, schema, file_format, by) in tables.items():
        table = f"`{database}`.`{name}`"
        _create(spark, table, path, schema, file_format, by)
        changed[name] = _bring_up_to_date(spark, table, by, _folders(spark, path, by))
    return changed
