"""Intermediate tables in the cluster's shared folder.

A written table cuts the lineage and survives the loss of executors. The folder is the one the
cluster names in ``spark.checkpoint.dir``; only a session whose executors are threads of the driver
may go without one and gets a temporary folder. The session's own settings are left alone.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# One process: the driver's own threads run the tasks.
_ONE_PROCESS = re.compile(r"local(\[.*\])?")
_own_folders: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not _ONE_PROCESS.fullmatch(context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if not _own_folders:
        _own_folders.append(tempfile.mkdtemp(prefix="tallyloom-"))
        atexit.register(shutil.rmtree, _own_folders[0], ignore_errors=True)
    return _own_folders[0]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame, computed once into Parquet and read back."""
    path = new_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table or folder made by :func:`new_path`; anything outside the folder is refused."""
    root = shared_folder(spark)
    if "/" in path.removeprefix(f"{root}/") or not path.startswith(f"{root}/"):
        raise ValueError(f"not a table of {root}: {path}")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(table: DataFrame) -> None:
    """Deletes the files of a table from :func:`written` that nothing will read any more."""
    spark = table.sparkSession
    root = shared_folder(spark)
    name = root.rpartition("/")[2]
    folders = {re.search(rf"{re.escape(name)}/([^/]+)/", file)[1] for file in table.inputFiles()}
    for folder in folders:
        remove(spark, f"{root}/{folder}")
