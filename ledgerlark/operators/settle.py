"""Fix a frame that several branches of a plan read."""

from __future__ import annotations

import atexit
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_FOLDERS: set[str] = set()


def settle(frame: DataFrame, **options: str) -> DataFrame:
    """Write ``frame`` once as Parquet in the shared checkpoint folder and read it back.

    Used on frames (one row per product, invoice, customer, month, ...) that feed totals,
    medians and rankings at once: the sales lines are read a single time, and a lost
    executor costs a re-read of the grain, not of the lines.  Readers take only the
    columns and row groups they need.
    """
    spark = frame.sparkSession
    path = scratch_path(spark)
    frame.write.options(**options).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def scratch_path(spark: SparkSession) -> str:
    """A new path in this application's part of the shared checkpoint folder.

    All of that part goes when Python ends, whether or not the session was stopped before.
    """
    folder = f"{use_checkpoint_folder(spark).rstrip('/')}/ledgerlark-{spark.sparkContext.applicationId}"
    if folder not in _FOLDERS:
        _FOLDERS.add(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        atexit.register(_remove, path.getFileSystem(spark._jsc.hadoopConfiguration()), path)
    return f"{folder}/{uuid.uuid4().hex}"


def _remove(system, path) -> None:
    try:
        system.delete(path, True)
    except (Py4JError, OSError):  # the driver's JVM has gone first
        pass


def use_checkpoint_folder(spark: SparkSession) -> str:
    """The folder the session names; without one, a part of its warehouse, which is shared too."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or f"{warehouse}/_checkpoints")
    return context.getCheckpointDir()
