"""Tables in the folder that all executors share, written once so that later steps start from files."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; only where it is unset and the master is a single JVM (tests), a temporary folder."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if "dir" not in _local:
        folder = tempfile.TemporaryDirectory(prefix="spanloom-")
        atexit.register(folder.cleanup)
        _local["dir"] = f"file://{folder.name}"
    return _local["dir"]


def app_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder; it is deleted when the application ends."""
    path = f"{shared_dir(spark)}/spanloom-{spark.sparkContext.applicationId}"
    if _local.get("marked") != path:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(at)
        files.deleteOnExit(at)
        _local["marked"] = path
    return path


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to the shared folder and read back: its plan runs once, whichever executors are lost later."""
    spark = df.sparkSession
    path = f"{app_dir(spark)}/kept-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete all that this application has written to the shared folder; results that read it must be used before."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(app_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
