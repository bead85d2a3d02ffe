"""Keyed upsert as a DataFrame operation, with the checks around it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyrisk.operators.quality import ContractError


def batch_key_state(batch: DataFrame, key: str) -> DataFrame:
    """(rows, keys, ok): ok when the batch is not empty and its keys are present and unique."""
    counts = batch.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys"))
    return counts.withColumn("ok", (F.col("rows") > 0) & (F.col("rows") == F.col("keys")))


def assert_batch_keys(batch: DataFrame, key: str) -> int:
    """Fail on an empty batch and on a null or repeated key; return the row count."""
    state = batch_key_state(batch, key).first()
    if not state["ok"]:
        raise ContractError(f"Empty batch, or null or repeated {key}: {state['rows']} rows, {state['keys']} keys")
    return state["rows"]


def repeated_keys(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Keys of the batch present more than once in the target."""
    return (
        target.select(key)
        .join(batch.select(key).distinct(), key, "left_semi")
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
    )


def assert_no_dup(target: DataFrame, batch: DataFrame, key: str) -> None:
    found = repeated_keys(target, batch, key).limit(1).collect()
    if found:
        raise ContractError(f"{key} repeated in the target: {found[0][key]}")


def merge_upsert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Target rows replaced by the batch row of the same key, plus the new batch rows.

    Run :func:`assert_batch_keys` and :func:`assert_no_dup` first: the anti join would
    silently drop every copy of a key the target holds twice.
    """
    kept = target.join(batch.select(key), key, "left_anti").select(*target.columns)
    return kept.unionByName(batch.select(*target.columns))
