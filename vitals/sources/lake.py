"""Tables of the lake: where they are, how they are read and written."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.clock import stream_order
from ..operators.lineage import Hour
from ..operators.serving import with_calendar
from ..schemas import ANSWER, BRONZE, GOLD, PARTITIONS, QUARANTINE, READING, READING_GOLD, SILVER
from ..session import configure
from .files import hadoop, path_exists
from .manifest import among, read_manifest, read_sets

BATCH = "batch"  # partition naming the write, below dt and hour


@dataclass(frozen=True)
class Lake:
    """Folders under one root. Every table has a root of its own, so no overwrite touches another."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    # Events: the four catalogued tables.
    @property
    def bronze(self) -> str:
        return self.path("bronze/events")

    @property
    def silver(self) -> str:
        return self.path("silver/events")

    @property
    def quarantine(self) -> str:
        return self.path("quarantine/events")

    @property
    def metrics(self) -> str:
        return self.path("metrics/minutes")

    def taken(self, layer: str) -> str:
        """Which partitions of its source the stream into a layer has taken."""
        return self.path(f"lineage/{layer}")

    @property
    def minute_counts(self) -> str:
        return self.path("metrics/minute_counts")

    @property
    def minutes(self) -> str:
        return self.path("metrics/all_minutes")

    @property
    def closed_gold(self) -> str:
        return self.path("gold/closed_hours")

    @property
    def late(self) -> str:
        return self.path("late/events")

    @property
    def closing(self) -> str:
        return self.path("lineage/closed_hours")

    @property
    def alarms(self) -> str:
        return self.path("metrics/alarms")

    @property
    def gold(self) -> str:
        return self.path("gold/device_hourly")

    # Readings.
    @property
    def readings_bronze(self) -> str:
        return self.path("readings/bronze")

    @property
    def readings_silver(self) -> str:
        return self.path("readings/silver")

    @property
    def readings_gold(self) -> str:
        return self.path("readings/gold")

    @property
    def readings_days(self) -> str:
        return self.path("readings/silver_by_day")

    @property
    def readings_gold_days(self) -> str:
        return self.path("readings/gold_by_day")

    @property
    def answers(self) -> str:
        return self.path("readings/answers")


def read_table(
    spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet"
) -> DataFrame:
    """Rows in the declared schema: a column a file lacks is null, a folder not yet written is empty.

    Where batches have been compacted, the sets in force are read in their place.
    """
    configure(spark)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    manifest = read_manifest(spark, path)
    if not manifest.sets:
        return reader(spark, schema, file_format).load(path).select(schema.fieldNames())
    rows = reader(spark, with_batch(schema), file_format).load(path)
    rows = rows.where(~among(BATCH, manifest.replaced())).select(schema.fieldNames())
    return rows.unionByName(read_sets(spark, path, schema, file_format, manifest.in_force()))


def with_batch(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(BATCH, StringType())])


def reader(spark: SparkSession, schema: StructType, file_format: str):
    reader = configure(spark).read.format(file_format).schema(schema)
    return reader.option("mode", "DROPMALFORMED") if file_format == "json" else reader


def latest_hour(spark: SparkSession, path: str) -> Hour | None:
    """The last hour partition of a table, by the names of folders."""

    def last(folder: str, level: str) -> str | None:
        files, root = hadoop(spark, folder)
        names = [s.getPath().getName() for s in files.listStatus(root)] if files.exists(root) else []
        return max((n.removeprefix(level) for n in names if n.startswith(level)), default=None)

    dt = last(path, "dt=")
    hour = last(f"{path}/dt={dt}", "hour=") if dt else None
    return (dt, hour) if hour else None


def folders_below(spark: SparkSession, path: str, *levels: str) -> list[tuple[str, ...]]:
    """The partitions of a table, by the names of its folders, one value per level."""
    files, pattern = hadoop(spark, "/".join([path, *[f"{level}=*" for level in levels]]))
    found = [s.getPath().toString().split("/")[-len(levels) :] for s in files.globStatus(pattern) or ()]
    return sorted(tuple(part.split("=", 1)[1] for part in parts) for parts in found)


def hour_folder(path: str, dt: str, hour: str) -> str:
    return f"{path}/dt={dt}/hour={hour}"


def batch_folder(path: str, dt: str, hour: str, batch: str) -> str:
    return f"{hour_folder(path, dt, hour)}/{BATCH}={batch}"


def read_batches(
    spark: SparkSession, path: str, schema: StructType, file_format: str, batches: Sequence[tuple[str, str, str]]
) -> DataFrame:
    """The batches (dt, hour, batch) of a table, with their names, listing no other folder of it."""
    named = with_batch(schema)
    folders = [folder for folder in (batch_folder(path, *b) for b in batches) if path_exists(spark, folder)]
    if not folders:
        return configure(spark).createDataFrame([], named)
    return reader(spark, named, file_format).option("basePath", path).load(folders).select(named.fieldNames())


def read_all_batches(spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet") -> DataFrame:
    """Rows of all batches that are there, with their names, whether a set stands for them or not."""
    if not path_exists(spark, path):
        return configure(spark).createDataFrame([], with_batch(schema))
    return reader(spark, with_batch(schema), file_format).load(path).select(with_batch(schema).fieldNames())


def batches_in(rows: DataFrame) -> list[tuple[str, str, str]]:
    """The partitions (dt, hour, batch) that rows lie in: as many as there are folders, not rows."""
    return sorted(map(tuple, rows.select(*PARTITIONS, BATCH).distinct().collect()))


def note_taken(spark: SparkSession, lake: Lake, layer: str, taken: Sequence[tuple[str, str, str]]) -> None:
    """Record that a layer has taken these partitions of its source; the same ones again replace themselves."""
    if taken:
        rows = spark.createDataFrame(taken, "dt STRING, hour STRING, source STRING").coalesce(1)
        name = hashlib.sha256(repr(taken).encode()).hexdigest()[:24]
        write_partitions(rows.withColumn(BATCH, F.lit(name)), lake.taken(layer), "parquet", "dt", BATCH)


def read_taken(spark: SparkSession, lake: Lake, layer: str) -> DataFrame:
    """(dt, hour, source): the partitions of its source that the stream into a layer has taken, once each."""
    schema = StructType([StructField(c, StringType()) for c in (*PARTITIONS, "source")])
    return read_table(spark, lake.taken(layer), schema).distinct()


def read_hours(
    spark: SparkSession, path: str, schema: StructType, hours: Sequence[Hour]
) -> DataFrame:
    """Some hour partitions of a Parquet table, listing no other folder of it; sets in force as in ``read_table``."""
    hours = list(dict.fromkeys(hours))
    manifest = read_manifest(spark, path)
    replaced = {hour: manifest.batches[hour] for hour in hours if hour in manifest.batches}
    names = [f"{dt}/{hour}/{b}" for (dt, hour), batches in replaced.items() for b in batches]
    rows = configure(spark).createDataFrame([], schema)
    folders = [folder for folder in (hour_folder(path, *h) for h in hours) if path_exists(spark, folder)]
    if folders:
        chosen = reader(spark, with_batch(schema) if names else schema, "parquet").option("basePath", path)
        rows = chosen.load(folders)
        rows = (rows.where(~among(BATCH, names)) if names else rows).select(schema.fieldNames())
    if names:
        sets = [f"{dt}/{hour}/{manifest.sets[dt, hour]}" for dt, hour in replaced]
        rows = rows.unionByName(read_sets(spark, path, schema, "parquet", sets))
    return rows


def bytes_of_hours(spark: SparkSession, path: str, hours: Sequence[Hour]) -> int:
    """Size of the files of some hour partitions."""
    total = 0
    for dt, hour in dict.fromkeys(hours):
        files, folder = hadoop(spark, f"{path}/dt={dt}/hour={hour}")
        if files.exists(folder):
            total += files.getContentSummary(folder).getLength()
    return total


def read_touched(spark: SparkSession, path: str, schema: StructType, touched: DataFrame) -> DataFrame:
    """The partitions named by a frame of (dt, hour), however many they are.

    Their days, a few thousand at most in any year of data, prune the scan; the hours are joined.
    """
    hours = touched.select(*PARTITIONS).distinct()
    days = [row.dt for row in hours.select("dt").distinct().collect()]
    table = read_table(spark, path, schema).where(F.col("dt").isin(days))
    return table.join(hours, PARTITIONS, "left_semi").select(schema.fieldNames())


def read_bronze(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, lake.bronze, BRONZE, "json")


def read_quarantine(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, lake.quarantine, QUARANTINE, "json")


def read_silver(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, lake.silver, SILVER)


def read_gold(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, lake.gold, GOLD)


def read_readings(spark: SparkSession, path: str, file_format: str) -> DataFrame:
    return read_table(spark, path, READING, file_format)


def load_dashboard(spark: SparkSession, path: str) -> DataFrame:
    """Reading gold with its calendar columns; no rows when there is no table yet."""
    return with_calendar(read_table(spark, path, READING_GOLD))


def load_answers(spark: SparkSession, path: str) -> DataFrame:
    """Answers from all files in which both fields are named; a line's field may be null."""
    if not path_exists(spark, path):
        return configure(spark).createDataFrame([], ANSWER)
    lines = configure(spark).read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.from_json("value", ANSWER).alias("row"),
        F.json_object_keys("value").alias("fields"),
    ).where("fields IS NOT NULL")
    names = [F.bool_or(F.array_contains("fields", name)).alias(name) for name in ANSWER.fieldNames()]
    named = lines.groupBy("file").agg(*names).where(" AND ".join(ANSWER.fieldNames()))
    return lines.join(named, "file", "left_semi").select("row.*")


# Table names queries refer to.
_VIEWS = {
    "bronze_events": read_bronze,
    "silver_events": read_silver,
    "quarantine_events": read_quarantine,
    "gold_device_hourly": read_gold,
}


def register_views(spark: SparkSession, lake: Lake) -> list[str]:
    """Name the four event tables for SQL; ``dt`` and ``hour`` are string partitions."""
    for name, read in _VIEWS.items():
        read(spark, lake).createOrReplaceTempView(name)
    return list(_VIEWS)


def by_hour(rows: DataFrame) -> DataFrame:
    """Bring each hour's rows together before writing, splitting an hour too large for one file.

    Otherwise every task would write a file for every hour it has rows of. Adaptive execution does
    the splitting, in batches and in streams without state.
    """
    return rows.hint("rebalance", *PARTITIONS)


def write_partitions(rows: DataFrame, path: str, file_format: str, *partitions: str) -> None:
    """Replace exactly the partitions present in ``rows``."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).format(file_format).save(path)


def overwrite_hours(rows: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Replace exactly the hour partitions present in ``rows``; all others stay as they are."""
    write_partitions(by_hour(rows), path, file_format, *PARTITIONS)


def write_batch(rows: DataFrame, path: str, batch: str, file_format: str) -> None:
    """Add one batch to its hour partitions; writing the same batch again replaces what it wrote."""
    write_batches(rows.withColumn(BATCH, F.lit(batch)), path, file_format)


def write_batches(rows: DataFrame, path: str, file_format: str) -> None:
    """Add rows to their hour partitions, each to the batch it names, replacing what these held."""
    write_partitions(by_hour(rows), path, file_format, *PARTITIONS, BATCH)


def batch_name(rows: DataFrame, sequence: str) -> str | None:
    """A name that follows from a batch's records: their number, first and last sequence numbers, and a
    hash of all. None for an empty batch."""
    order = F.struct(*stream_order(F.col(sequence)))
    found = rows.agg(
        F.count("*").alias("n"),
        F.min_by(sequence, order).alias("first"),
        F.max_by(sequence, order).alias("last"),
        F.bit_xor(F.xxhash64(sequence)).alias("hash"),
    ).first()
    if not found["n"]:
        return None
    text = "-".join(str(found[c]) for c in ("first", "last", "n", "hash"))
    return hashlib.sha256(text.encode()).hexdigest()[:24]


def write_named(rows: DataFrame, path: str, batch: str, file_format: str) -> None:
    """Add a batch to a table without hours; writing the same batch again replaces what it wrote."""
    write_partitions(rows.withColumn(BATCH, F.lit(batch)), path, file_format, BATCH)


def expire_partitions(spark: SparkSession, path: str, cutoff: str) -> list[str]:
    """Delete the day folders before ``cutoff`` ('yyyy-MM-dd'); no data is read or rewritten."""
    if not path_exists(spark, path):
        return []
    files, root = hadoop(spark, path)
    days = {
        status.getPath().getName().removeprefix("dt="): status.getPath()
        for status in files.listStatus(root)
        if status.isDirectory() and status.getPath().getName().startswith("dt=")
    }
    expired = sorted(day for day in days if day < cutoff)
    for day in expired:
        files.delete(days[day], True)
    return expired
