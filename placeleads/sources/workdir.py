"""Where jobs may put intermediate tables and stream checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared one that the session names in
    ``spark.checkpoint.dir``. Only a local session may do without that setting."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="placeleads-")
    return f"{shared.rstrip('/')}/placeleads/{purpose}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as that knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = file_system(spark, path)
    return system.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder with all that is in it."""
    system, place = file_system(spark, path)
    system.delete(place, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if there is no such folder."""
    system, place = file_system(spark, path)
    if not system.exists(place):
        return []
    return [s.getPath().getName() for s in system.listStatus(place) if s.isDirectory()]
