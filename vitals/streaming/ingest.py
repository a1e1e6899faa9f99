"""Streams into bronze, silver and quarantine.

Bronze keeps every record and is the table silver and quarantine are derived from: each of the two
reads bronze with a checkpoint of its own, so one can be replayed without the other.

Derivation is safe against replays. What a micro-batch of bronze rows says is which partitions of bronze
(arrival hour and batch) are new or written again; each is derived as a whole, under a name that follows
from it alone. So a bronze batch that is written again, files of it that reach a stream in several
micro-batches, or a stream that starts anew without its checkpoint, all end in the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.health import DEFAULT_THRESHOLDS, Thresholds
from ..operators import enrich, lineage, quality, readings
from ..plans.jobs import route_batch
from ..schemas import BRONZE, PARTITIONS
from ..sources import lake as tables
from ..sources.lake import Lake
from ..sources.streams import UNTIL_CAUGHT_UP, start_batches, start_numbered


def readings_to_bronze(
    messages: DataFrame, lake: Lake, trigger: Mapping = UNTIL_CAUGHT_UP
) -> StreamingQuery:
    """Reading messages, leniently parsed, to JSON files, partitioned by batch; only this job writes there.

    Messages have no ids, so batches are named by their number, and without the checkpoint that counts them
    the job does not start on a table that has batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        tables.write_named(readings.lenient_readings(batch), lake.readings_bronze, f"{batch_id:012d}", "json")

    return start_numbered(messages, "readings-bronze", write, lake.root, lake.readings_bronze, trigger)


def events_to_bronze(
    records: DataFrame, lake: Lake, trigger: Mapping = UNTIL_CAUGHT_UP
) -> StreamingQuery:
    """All records to JSON, partitioned by arrival hour, in a table that other jobs write too.

    Batches are named by their content, so one written again, by whichever job, replaces itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Only sequence numbers are read for the name.
        named = tables.batch_name(batch, "sequenceNumber")
        if named:
            tables.write_batch(quality.to_envelope(batch), lake.bronze, named, "json")

    return start_batches(records, "events-bronze", write, lake.root, lake.bronze, trigger)


def _derived(
    layer: str, bronze: DataFrame, lake: Lake, path: str, file_format: str,
    derive: Callable[[DataFrame], DataFrame], trigger: Mapping,
) -> StreamingQuery:
    """A stream that derives whole bronze partitions as they are added; ``derive`` keeps the column of names."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        taken = tables.batches_in(batch)
        rows = tables.read_batches(spark, lake.bronze, BRONZE, "json", taken)
        named = rows.withColumn(tables.BATCH, lineage.origin(F.col(tables.BATCH)))
        tables.write_batches(derive(quality.classify(quality.with_arrival(named))), path, file_format)
        tables.note_taken(spark, lake, layer, taken)

    return start_batches(bronze.select(*PARTITIONS, tables.BATCH), f"events-{layer}", write, lake.root, path, trigger)


def bronze_to_silver(
    bronze: DataFrame,
    lake: Lake,
    processed_at: Column | None = None,
    limits: Thresholds = DEFAULT_THRESHOLDS,
    trigger: Mapping = UNTIL_CAUGHT_UP,
) -> StreamingQuery:
    """Valid events, enriched, to Parquet partitioned by event hour."""
    processed = F.current_timestamp() if processed_at is None else processed_at

    def derive(classified: DataFrame) -> DataFrame:
        return enrich.to_silver(classified.drop(*PARTITIONS), processed, limits, [tables.BATCH])

    return _derived("silver", bronze, lake, lake.silver, "parquet", derive, trigger)


def bronze_to_quarantine(
    bronze: DataFrame, lake: Lake, trigger: Mapping = UNTIL_CAUGHT_UP
) -> StreamingQuery:
    """Rejected envelopes with their reasons, partitioned by arrival hour like bronze."""

    def derive(classified: DataFrame) -> DataFrame:
        return quality.rejected(classified, [tables.BATCH])

    return _derived("quarantine", bronze, lake, lake.quarantine, "json", derive, trigger)


def route_events(
    records: DataFrame,
    lake: Lake,
    processed_at: datetime | None = None,
    limits: Thresholds = DEFAULT_THRESHOLDS,
    trigger: Mapping = UNTIL_CAUGHT_UP,
) -> StreamingQuery:
    """All three tables from one stream, parsing each payload once; replayed batches replace themselves."""

    def write(batch: DataFrame, batch_id: int) -> None:
        route_batch(batch, lake, None, processed_at, limits)

    return start_batches(records, "events-route", write, lake.root, lake.root, trigger)
