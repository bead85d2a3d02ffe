"""The folder that the machines of a cluster share, and the few file operations on it.

The folder is the one the session names in `spark.checkpoint.dir`. A session on one machine may
lack it, as in tests: then a folder of this machine serves that session. On a cluster the lack
is an error, because executors and driver do not see each other's disks.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=8)
def _own(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"shared-{application}-")


def shared_folder(spark: SparkSession) -> str:
    setting = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not setting:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all machines share")
        setting = _own(spark.sparkContext.applicationId)
    return setting.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nobody else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table of their own; the lineage ends there."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@lru_cache(maxsize=8)
def _shipped(application: str) -> str:
    """This package as one archive, for workers that do not share the driver's path."""
    root = Path(__file__).resolve().parents[1]
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp()), f"{root.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    return archive


def ship(spark: SparkSession) -> None:
    """Send the code to the executors; Spark does so once per file name."""
    spark.sparkContext.addPyFile(_shipped(spark.sparkContext.applicationId))


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    where, files = _path(spark, path)
    files.delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; what was at the target is replaced."""
    where, files = _path(spark, source)
    to, _ = _path(spark, target)
    files.delete(to, True)
    files.mkdirs(to.getParent())
    if not files.rename(where, to):
        raise OSError(f"Cannot move {source} to {target}")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    where, files = _path(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place if there is none of its name; of several callers one succeeds.

    The file is written beside its place first, so that readers see all of it or nothing. On
    the local file system a hard link puts it in place, elsewhere a rename that does not
    overwrite: both are one atomic step of the file system (HDFS). An object store without such
    a rename needs one that writes on a condition; there this is not safe.
    """
    where, files = _path(spark, path)
    files.mkdirs(where.getParent())
    aside, _ = _path(spark, f"{where.getParent()}/.{where.getName()}.{uuid.uuid4().hex}")
    out = files.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if files.getScheme() == "file":
            try:
                os.link(aside.toUri().getPath(), where.toUri().getPath())
            except FileExistsError:
                return False
            return True
        context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
        never = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(aside, where, never)
        except Exception as error:  # the gateway wraps what the file system raises
            if "AlreadyExists" in str(error):
                return False
            raise
        return True
    finally:
        files.delete(aside, False)


def read_text(spark: SparkSession, path: str) -> str:
    where, files = _path(spark, path)
    stream = files.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
