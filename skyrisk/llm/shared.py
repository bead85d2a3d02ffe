"""Tables written between the steps of an operator, in the folder that the cluster shares.

The folder is the one named by `spark.checkpoint.dir`. A session on one machine may lack it, as
in tests: then a folder of this machine serves that session; on a cluster the lack is an error.
A written table cuts the lineage: what was lost with an executor is read again, not computed
again.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@lru_cache(maxsize=8)
def _own(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"shared-{application}-")


def folder(spark: SparkSession) -> str:
    setting = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not setting:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all machines share")
        setting = _own(spark.sparkContext.applicationId)
    return setting.rstrip("/")


def landed(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table of their own."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


SMALL_BYTES = 4 << 20  # numbers that may be broadcast, as held in memory


def small(df: DataFrame) -> DataFrame:
    """A written table of numbers, to be broadcast if it is small; a larger one is shuffled like
    any other, with the same rows. The count is read from the files' footers."""
    return F.broadcast(df) if df.count() * 16 * len(df.columns) <= SMALL_BYTES else df
