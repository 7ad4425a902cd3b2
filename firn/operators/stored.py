"""Tables that a plan writes on its way, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Paths that were made and not yet cleared.
_MADE: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in spark.checkpoint.dir, or where that is unset and Spark runs on one machine, in a folder of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="firn-")
        spark.sparkContext.setCheckpointDir(folder)
    _MADE.append(f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _MADE[-1]


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: several branches read it, and plans stay short. `clear` deletes it."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete all tables written so far. Results that read them and were not used by then cannot be read any more."""
    for path in _MADE:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _MADE.clear()
