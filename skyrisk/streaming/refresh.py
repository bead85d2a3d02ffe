"""The daily refresh: new landing files are validated and merged, each exactly once.

Each trigger takes the files that arrived since the last one, validates every micro-batch
as a whole and merges it by key. Replaying a micro-batch after a failure changes nothing,
because the merge is keyed. A refused micro-batch stops the query before anything is
written, and is taken again at the next run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyrisk import schemas
from skyrisk.plans.ingest import validated_bulletins
from skyrisk.sources.history import upsert_history


def refresh_bulletins(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] = validated_bulletins,
) -> None:
    """Merge every new bulletin file of ``landing`` into the history at ``root``, then stop.

    The progress of the refresh is kept under ``checkpoint``, by default in the shared
    folder the session names in ``spark.checkpoint.dir``.
    """
    if checkpoint is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            raise ValueError("Name a checkpoint folder, or set spark.checkpoint.dir")
        checkpoint = f"{shared}/refresh_bulletins"

    def merge(batch: DataFrame, _: int) -> None:
        raw = batch.withColumnRenamed("dep_nom", "nom_dep").select(*schemas.ARCHIVE_COLUMNS)
        upsert_history(prepare(raw), root, schemas.RAW_BULLETINS, schemas.HISTORY_KEY, "reference_time", "dep_code")

    files = spark.readStream.schema(schemas.BULLETIN_JSON).option("multiLine", True).json(landing)
    query = (
        files.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
