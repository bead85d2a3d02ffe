"""Helpers of the operators: rows of texts in bounded slices, words, hashes of UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"  # a word of the digest queries: a run without ASCII white space


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in slices of about `limit` text bytes, so that memory is bounded by
    the limit and the longest text."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    steps = np.cumsum(sizes, dtype=np.int64) // limit
    edges = [0, *(np.flatnonzero(np.diff(steps)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def per_text(df: DataFrame, key: str, text: str, schema: str, rows: Callable[[list[str]], dict]) -> DataFrame:
    """The key of every row with the columns of `schema` that `rows(texts)` gives for it.
    Null texts arrive as empty ones; other columns are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_pydict({"key": part.column(0), **rows(part.column(1).fill_null("").to_pylist())})

    key_type = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {key_type}, {schema}")
    return out.withColumnRenamed("key", key)


def held_out(key: str | Column, modulus: int, remainder: int) -> Column:
    """Is the row's checksum remainder the one that is kept from learning? Null keys are not."""
    name = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(name.cast("string").cast("binary")) % modulus == remainder, F.lit(False))
