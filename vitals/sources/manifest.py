"""Which sets of files stand for which batches of a table; see ``compaction``."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.lineage import Hour
from .files import hadoop, move_new

SET = "set"


@dataclass
class Manifest:
    """Per hour the set in force and the batches it replaces."""

    version: int = 0
    sets: dict[Hour, str] = field(default_factory=dict)
    batches: dict[Hour, list[str]] = field(default_factory=dict)

    def replaced(self) -> list[str]:
        return [f"{dt}/{hour}/{b}" for (dt, hour), names in self.batches.items() for b in names]

    def in_force(self) -> list[str]:
        return [f"{dt}/{hour}/{s}" for (dt, hour), s in self.sets.items()]


def sets_path(path: str) -> str:
    return f"{path}.sets"


def _manifests(path: str) -> str:
    return f"{sets_path(path)}/_manifest"


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    files, folder = hadoop(spark, _manifests(path))
    if not files.exists(folder):
        return Manifest()
    found = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().endswith(".json")]
    if not found:
        return Manifest()
    latest = max(found, key=lambda p: p.getName())
    stream = files.open(latest)
    try:
        hours = json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()
    keys = {tuple(name.split("/")): entry for name, entry in hours.items()}
    return Manifest(
        int(latest.getName().split(".")[0]),
        {hour: entry[SET] for hour, entry in keys.items()},
        {hour: entry["batches"] for hour, entry in keys.items()},
    )


def publish(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Make a manifest the one in force; fails if another of its version is there."""
    hours = {"/".join(h): {SET: s, "batches": sorted(manifest.batches[h])} for h, s in manifest.sets.items()}
    text = json.dumps(hours, sort_keys=True).encode()
    name = f"{manifest.version:012d}.json"
    own = f"{_manifests(path)}/.{name}-{hashlib.sha256(text).hexdigest()[:16]}"
    files, written = hadoop(spark, own)
    stream = files.create(written, True)
    try:
        stream.write(bytearray(text))
    finally:
        stream.close()
    if not move_new(spark, own, f"{_manifests(path)}/{name}"):
        raise FileExistsError(f"another manifest {name} of {path} exists")


def among(level: str, names: Sequence[str]) -> Column:
    """Whether a partition (dt, hour and the level below) is among those named; decided while planning."""
    listed = ", ".join(f"'{n}'" for n in names)
    return F.expr(f"concat_ws('/', dt, hour, `{level}`) IN ({listed})") if names else F.lit(False)


def read_sets(spark: SparkSession, path: str, schema: StructType, file_format: str, names: Sequence[str]) -> DataFrame:
    """The rows of the sets (dt/hour/set) named."""
    withset = StructType([*schema.fields, StructField(SET, StringType())])
    rows = spark.read.format(file_format).schema(withset).load(sets_path(path))
    return rows.where(among(SET, names)).select(schema.fieldNames())
