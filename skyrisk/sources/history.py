"""The history: day-partitioned Parquet, replaced day by day, published by a log of commits.

Layout under a root folder::

    data/load=<id>/day=<yyyy-MM-dd>/*.parquet   rows written by one load
    log/<version>.json                          one commit: its load, and the days it replaced
    snapshot/version=<n>/*.parquet              which load holds each day after commit n

A load rewrites only the days it touches, under an id of its own, so that no two loads write to
the same place, and is published by creating the next file of the log, which succeeds for one
load only. A load that finds the place taken looks at what was published since it read: if none
of its days was touched, what it wrote still holds, and it tries the next place; else it is
refused, and its rows are never seen. Readers follow the log from the newest snapshot; they see
whole loads or nothing of them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyrisk import schemas
from skyrisk.operators.upsert import assert_batch_keys, assert_no_dup, merge_upsert
from skyrisk.sources.shared import create_if_absent, names, read_text

SNAPSHOT_EVERY = 32  # commits that a reader follows at most, or a few more
SNAPSHOT_SCHEMA = T.StructType([T.StructField("day", T.DateType()), T.StructField("load", T.LongType())])


class ConcurrentLoadError(RuntimeError):
    """Another load replaced days that this one has read."""


@dataclass(frozen=True)
class Commit:
    """What one load did: `touched` days were read and replaced, `held` ones have rows now."""

    load: int
    touched: frozenset[date]
    held: frozenset[date]

    def text(self) -> str:
        days = {name: sorted(d.isoformat() for d in getattr(self, name)) for name in ("touched", "held")}
        return json.dumps({"load": self.load, **days})

    @classmethod
    def parse(cls, text: str) -> Commit:
        fields = json.loads(text)
        days = [frozenset(date.fromisoformat(d) for d in fields[name]) for name in ("touched", "held")]
        return cls(fields["load"], *days)


def _commits(spark: SparkSession, root: str, after: int) -> list[tuple[int, Commit]]:
    versions = [int(n.removesuffix(".json")) for n in names(spark, f"{root}/log") if n.endswith(".json") and not n.startswith(".")]
    return [(v, Commit.parse(read_text(spark, _place(root, v)))) for v in versions if v > after]


def _place(root: str, version: int) -> str:
    return f"{root}/log/{version:012d}.json"


def _snapshot(spark: SparkSession, root: str) -> tuple[int, dict[date, int]]:
    """The newest complete snapshot."""
    for name in sorted(names(spark, f"{root}/snapshot"), key=lambda n: -int(n.split("=")[-1])):
        if "_SUCCESS" in names(spark, f"{root}/snapshot/{name}"):
            rows = spark.read.schema(SNAPSHOT_SCHEMA).parquet(f"{root}/snapshot/{name}").collect()
            return int(name.split("=")[-1]), {r["day"]: r["load"] for r in rows}
    return 0, {}


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """The seed of measurement points; codes stay text, with their leading zeros."""
    points = spark.read.csv(path, header=True, schema=schemas.POINTS)
    return points.withColumn("code_insee", F.trim("code_insee"))


def live_days(spark: SparkSession, root: str) -> tuple[int, dict[date, int]]:
    """Newest version and, for it, the load that holds each day (one entry per day)."""
    version, days = _snapshot(spark, root)
    for number, commit in _commits(spark, root, version):
        days = {d: n for d, n in days.items() if d not in commit.touched} | {d: commit.load for d in commit.held}
        version = number
    return version, days


def publish(spark: SparkSession, root: str, commit: Commit, seen: int, alone: bool = False) -> int:
    """Add a commit to the log; return its version. `seen` is the version its load has read.

    Commits that came since and touched other days do not matter, unless the load has read the
    whole history (`alone`)."""
    while True:
        for version, other in _commits(spark, root, seen):
            if alone or other.touched & commit.touched:
                raise ConcurrentLoadError(f"Version {version} was published meanwhile; merge again")
            seen = version
        if create_if_absent(spark, _place(root, seen + 1), commit.text()):
            _take_snapshot(spark, root, seen + 1)
            return seen + 1


def _take_snapshot(spark: SparkSession, root: str, version: int) -> None:
    if version % SNAPSHOT_EVERY == 0:
        newest, days = live_days(spark, root)
        if newest == version and days:
            rows = spark.createDataFrame(sorted(days.items()), SNAPSHOT_SCHEMA).coalesce(1)
            rows.write.mode("errorifexists").parquet(f"{root}/snapshot/version={version}")


def read_days(spark: SparkSession, root: str, schema: T.StructType, days: dict[date, int]) -> DataFrame:
    """The rows of some days, each from the load that holds it."""
    columns = [f.name for f in schema]
    if not days:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField("load", T.LongType()), T.StructField("day", T.DateType())])
    paths = [f"{root}/data/load={load}/day={day.isoformat()}" for day, load in sorted(days.items())]
    return spark.read.schema(stored).option("basePath", f"{root}/data").parquet(*paths).select(*columns)


def read_history(
    spark: SparkSession, root: str, schema: T.StructType, start=None, end=None, only: Iterable[date] | None = None
) -> DataFrame:
    """Current rows; ``start`` and ``end`` (days, inclusive) or ``only`` some days prune whole folders."""
    _, days = live_days(spark, root)
    wanted = {d: n for d, n in days.items() if (start is None or d >= start) and (end is None or d <= end)}
    if only is not None:
        wanted = {d: wanted[d] for d in set(only) & set(wanted)}
    return read_days(spark, root, schema, wanted)


def days_of(df: DataFrame, time: str) -> set[date]:
    """The days of a frame: one value a day reaches the driver."""
    return {r["day"] for r in df.select(F.to_date(time).alias("day")).distinct().collect()}


def write_load(rows: DataFrame, root: str, time: str, order: str) -> tuple[int, DataFrame]:
    """Write rows into day folders of a new load; return its id and the rows with their `day`."""
    load = uuid.uuid4().int >> 65  # a positive long, of this load alone
    schema = T.StructType([*rows.schema.fields, T.StructField("day", T.DateType())])
    # One shuffle by day whose large days adaptive execution splits into several files.
    (
        rows.withColumn("day", F.to_date(time))
        .hint("rebalance", "day")
        .sortWithinPartitions("day", order)
        .write.mode("errorifexists")
        .partitionBy("day")
        .parquet(f"{root}/data/load={load}")
    )
    return load, rows.sparkSession.read.schema(schema).parquet(f"{root}/data/load={load}")


def replace_days(rows: DataFrame, root: str, time: str, order: str, days: Iterable[date]) -> int:
    """Put `rows` in the place of all rows of `days`; days without rows have no folder then."""
    days = frozenset(days)
    spark = rows.sparkSession
    seen, _ = live_days(spark, root)
    load, written = write_load(rows, root, time, order)
    held = frozenset(r["day"] for r in written.select("day").distinct().collect())
    if held - days:
        raise ValueError(f"Rows outside of the days to replace: {sorted(held - days)[:3]}")
    return publish(spark, root, Commit(load, days, held), seen)


def upsert_history(
    batch: DataFrame,
    root: str,
    schema: T.StructType,
    key: str,
    time: str,
    code: str,
    key_fixes_day: bool = True,
    retries: int = 0,
) -> int:
    """Merge a validated batch into the history and publish it; return the new version.

    ``key_fixes_day`` states that equal keys are on the same day, which holds when the
    key is a hash of the day: only the batch's days are then read. Without it, the key
    and time columns of the whole history are searched for the batch's keys. A load that was
    refused because of another one is merged again up to ``retries`` times.
    """
    # The checks and the write must see the same rows, ingestion instant included.
    held = batch.select(*schema.names).persist()
    try:
        assert_batch_keys(held, key)
        while True:
            try:
                return _upsert(held, root, schema, key, time, code, key_fixes_day)
            except ConcurrentLoadError:
                if retries <= 0:
                    raise
                retries -= 1
    finally:
        held.unpersist()


def _upsert(
    batch: DataFrame, root: str, schema: T.StructType, key: str, time: str, code: str, key_fixes_day: bool
) -> int:
    spark = batch.sparkSession
    version, days = live_days(spark, root)
    touched = days_of(batch, time)
    if not key_fixes_day and days:
        found = read_days(spark, root, schema, days).join(batch.select(key), key, "left_semi")
        touched |= days_of(found, time)
    target = read_days(spark, root, schema, {d: n for d, n in days.items() if d in touched})
    assert_no_dup(target, batch, key)
    load, written = write_load(merge_upsert(target, batch, key), root, time, code)
    assert_no_dup(written, batch, key)
    # A day whose rows all moved to another day has no folder any more.
    held = {r["day"] for r in written.select("day").distinct().collect()}
    return publish(spark, root, Commit(load, frozenset(touched), frozenset(held)), version, alone=not key_fixes_day)
