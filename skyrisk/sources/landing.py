"""Landing files: JSON payloads, yearly CSV archives, validated Parquet batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyrisk import schemas
from skyrisk.functions.keys import weather_key
from skyrisk.functions.scalars import any_of, is_missing, safe_double, strict_double
from skyrisk.operators.quality import ContractError, Rule, check, row_rule
from skyrisk.operators.reshape import union_by_name
from skyrisk.sources.shared import move, remove

DELIMITERS = ";,\t|"


def with_ingested_at(df: DataFrame, at: datetime | None = None) -> DataFrame:
    """One ingestion instant for the whole batch."""
    return df.withColumn("insere_a", F.current_timestamp() if at is None else F.lit(at))


def coerce_double(df: DataFrame, columns: Sequence[str], mode: str = "raise") -> DataFrame:
    """Columns to double. ``raise``: text that is no number fails the job; ``null``: becomes null."""
    if mode not in ("raise", "null"):
        raise ValueError(f"Unknown mode: {mode}")
    convert = strict_double if mode == "raise" else safe_double
    return df.withColumns({c: convert(c) for c in columns})


# --- Bulletins --------------------------------------------------------------------------


def read_bulletins(spark: SparkSession, path: str) -> DataFrame:
    """A bulletin payload (a JSON list of records), every field as text."""
    raw = spark.read.schema(schemas.BULLETIN_JSON).option("multiLine", True).json(path)
    return raw.withColumnRenamed("dep_nom", "nom_dep").select(*schemas.ARCHIVE_COLUMNS)


def _header(spark: SparkSession, path: str) -> str:
    lines = spark.read.text(path).limit(1).collect()
    if not lines:
        raise ContractError(f"Empty archive: {path}")
    return lines[0]["value"]


def read_archives(spark: SparkSession, paths: Mapping[int, str]) -> DataFrame:
    """Yearly CSV archives, whatever their delimiter and column order, tagged by year.

    Only the header line of each file reaches the driver. Gzip files are not splittable:
    one task reads each.
    """
    years = []
    for year, path in sorted(paths.items()):
        header = _header(spark, path)
        sep = max(DELIMITERS, key=header.count)
        frame = spark.read.csv(path, header=True, sep=sep, inferSchema=False)
        names = [c.strip().strip("﻿").lower() for c in frame.columns]
        frame = frame.toDF(*[schemas.ARCHIVE_RENAMES.get(n, n) for n in names])
        years.append(frame.withColumn("annee_archive", F.lit(year)))
    return union_by_name(years)


# --- Weather payloads -------------------------------------------------------------------


def payload_type(variables: Sequence[str]) -> T.ArrayType:
    daily = T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in variables]
    )
    return T.ArrayType(T.StructType([T.StructField("daily", daily)]))


def parse_payloads(
    payloads: DataFrame, variables: Sequence[str] = tuple(schemas.WEATHER_VARIABLES), body: str = "body"
) -> DataFrame:
    """(batch columns, answers): a single point comes as an object and is made a list."""
    text = F.trim(F.col(body))
    as_list = F.when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    others = [c for c in payloads.columns if c != body]
    # A malformed payload fails the job: it must not become an absent observation.
    parsed = F.from_json(as_list, payload_type(variables), {"mode": "FAILFAST"})
    return payloads.select(*others, parsed.alias("answers"))


def answers_by_point(parsed: DataFrame, manifest: DataFrame) -> DataFrame:
    """Answers matched to the requested points by position; both sides are kept."""
    answers = parsed.select("batch_id", F.posexplode("answers").alias("pos", "answer"))
    return manifest.join(answers, ["batch_id", "pos"], "full")


def payload_rules(variables: Sequence[str] = tuple(schemas.WEATHER_VARIABLES)) -> list[Rule]:
    """Rules on :func:`answers_by_point`: nothing missing, extra, misdated or incomplete."""
    daily = F.col("answer.daily")
    lengths = [F.coalesce(F.size(daily[v]), F.lit(-1)) for v in variables]
    times = daily["time"]
    one_day = F.coalesce(F.size(times) == 1, F.lit(False))
    return [
        row_rule("point_without_answer", F.col("code_insee").isNotNull() & daily.isNull()),
        row_rule("answer_without_point", F.col("code_insee").isNull()),
        row_rule("one_row_per_point", daily.isNotNull() & ~one_day),
        row_rule("variable_absent", daily.isNotNull() & any_of([n != 1 for n in lengths])),
        row_rule(
            "other_day",
            one_day & ~F.try_to_date(F.substring(times[0], 1, 10)).eqNullSafe(F.col("requested_day")),
        ),
    ]


def flatten_daily(
    answered: DataFrame, variables: Sequence[str] = tuple(schemas.WEATHER_VARIABLES), at: datetime | None = None
) -> DataFrame:
    """Raw weather rows, one per requested point and day, from checked answers."""
    daily = F.col("answer.daily")
    keep = [c for c in answered.columns if c not in ("answer", "code_insee", "requested_day", "pos")]
    zipped = F.arrays_zip(daily["time"].alias("time"), *[daily[v].alias(v) for v in variables])
    rows = answered.select(*keep, F.trim("code_insee").alias("code_insee"), "requested_day", F.inline(zipped))
    return with_ingested_at(rows, at).select(
        *keep,
        F.col("time").cast("timestamp").alias("time"),
        "code_insee",
        weather_key("requested_day", "code_insee").alias("row_hash"),
        "insere_a",
        *variables,
    )


def fallback_batch(
    primary: DataFrame, secondary: DataFrame, batch_key: str, required: Sequence[str]
) -> DataFrame:
    """Whole batches from ``secondary`` where the primary lacks any required value.

    The unit is the batch: one missing cell replaces every row of its batch. Rows of such
    a batch that the secondary does not answer are named by :func:`unanswered`.
    """
    bad = lacking_batches(primary, batch_key, required)
    kept = primary.join(bad, batch_key, "left_anti")
    replaced = secondary.join(bad, batch_key, "left_semi")
    return kept.select(*primary.columns).unionByName(replaced.select(*primary.columns))


def lacking_batches(primary: DataFrame, batch_key: str, required: Sequence[str]) -> DataFrame:
    """Batches of which some row lacks a required value."""
    lacking = any_of([is_missing(c) for c in required])
    state = primary.groupBy(batch_key).agg(F.max(lacking).alias("_lacking"))
    return state.where("_lacking").select(batch_key)


def unanswered(
    primary: DataFrame, secondary: DataFrame, batch_key: str, point: str, required: Sequence[str]
) -> DataFrame:
    """(batch, point) of primary rows that fall back but have no secondary row."""
    bad = lacking_batches(primary, batch_key, required)
    asked = primary.join(bad, batch_key, "left_semi").select(batch_key, point).distinct()
    return asked.join(secondary.select(batch_key, point), [batch_key, point], "left_anti")


# --- Validated batches ------------------------------------------------------------------


def observed(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, Callable[[], list[tuple[str, int]]]]:
    """The frame, and the (rule, violations) of rules that are measured, to be asked for once a
    job has read all of it: no pass of their own."""
    measured = [r for r in rules if r.measure is not None]
    if len(measured) < len(rules):
        raise ValueError("Rules about keys and groups cannot be measured row by row")
    seen = Observation()
    # The count keeps a frame without rows from being optimised away with its measures.
    totals = [F.coalesce(r.measure.cast("long"), F.lit(0)).alias(f"_{i}") for i, r in enumerate(measured)]
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *totals)

    def found() -> list[tuple[str, int]]:
        counts = seen.get
        return [(r.name, counts[f"_{i}"]) for i, r in enumerate(measured)]

    return watched, found


def refuse(found: Sequence[tuple[str, int]]) -> None:
    """Raise with the broken rules among (rule, violations)."""
    if broken := sorted((name, n) for name, n in found if n):
        raise ContractError("; ".join(f"{name} ({n})" for name, n in broken))


def land_checked(
    raw: DataFrame,
    shape: Callable[[DataFrame], DataFrame],
    path: str,
    raw_rules: Sequence[Rule] = (),
    rules: Sequence[Rule] = (),
    group_rules: Sequence[Rule] = (),
    order: Sequence[str] = (),
) -> DataFrame:
    """Validate while landing: `raw` is read once, by the job that writes `shape(raw)`.

    Rules on raw and on shaped rows are measured by that job; rules about keys and groups are
    asked of what it wrote. The batch is written beside its place, and moved there when every
    rule holds; a refused or interrupted one is removed, and what was at `path` stays. Files are
    sorted by `order` within themselves, without a shuffle.
    """
    spark, aside = raw.sparkSession, f"{path}.{uuid.uuid4().hex}"
    watched, raw_found = observed(raw, raw_rules)
    shaped, found = observed(shape(watched), rules)
    batch = shaped.sortWithinPartitions(*order) if order else shaped
    try:
        batch.write.parquet(aside)
        refuse([*raw_found(), *found()])
        landed = spark.read.schema(shaped.schema).parquet(aside)
        if group_rules:
            check(landed, group_rules)
        move(spark, aside, path)
    finally:
        remove(spark, aside)
    return spark.read.schema(shaped.schema).parquet(path)


def load_landing(df: DataFrame, path: str, expected: int | None = None) -> int:
    """Overwrite the landing folder with a batch; count its rows while writing."""
    seen = Observation("landing")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    rows = seen.get["rows"]
    if expected is not None and rows != expected:
        raise ContractError(f"Landing holds {rows} rows instead of {expected}")
    return rows


def landing_name(prefix: str, *stamps: Column | str) -> str:
    """Folder name of a batch: prefix and its day, instant or first and last year."""
    return "_".join([prefix, *[str(s) for s in stamps]])
