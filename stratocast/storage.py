"""Tables on the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset a temporary one in local mode, an error on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or "cluster" in master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _LOCAL.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="spark-"))
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written to the shared folder and read back, where several parts of a plan need it."""
    path = shared_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def write_archive(frame: DataFrame, path: str, partition_by: list[str]) -> None:
    """Doubles as floats, zstd, one folder per value of ``partition_by``; only the partitions that ``frame`` has are replaced."""
    doubles = {c: F.col(c).cast("float") for c, t in frame.dtypes if t == "double"}
    frame.withColumns(doubles).write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def read_archive(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What ``write_archive`` wrote, floats as doubles again; no rows where nothing has been written."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    wanted = spark.createDataFrame([], schema)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return wanted
    narrow = ", ".join(f"{c} {'float' if t == 'double' else t}" for c, t in wanted.dtypes)
    return spark.read.schema(narrow).parquet(path).select(*[F.col(c).cast(t).alias(c) for c, t in wanted.dtypes])
