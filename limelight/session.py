"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes shuffle partitions and splits skewed join partitions, so
# operators carry no partition counts of their own.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot partition is worth splitting once it holds more than one advisory partition
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.ui.enabled": "false",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint location the cluster names.

    Only a local session without the setting gets a temporary folder of its own; on a
    cluster such a folder would not be visible to the executors.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="limelight-"))
        base = context.getCheckpointDir()
    return f"{_own_scratch(spark, base)}/{label}-{uuid.uuid4().hex}"


def _own_scratch(spark: SparkSession, base: str) -> str:
    return f"{base.rstrip('/')}/limelight/{spark.sparkContext.applicationId}"


def _file_system(spark: SparkSession, path: str):
    """The store that holds a path, and the path as it names it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store holds it; a missing one is no error."""
    system, hadoop = _file_system(spark, path)
    system.delete(hadoop, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    system, hadoop = _file_system(spark, path)
    return system.exists(hadoop)


def rename_path(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder another name within its store; raises when that fails."""
    system, hadoop = _file_system(spark, path)
    target = _file_system(spark, to)[1]
    if not system.rename(hadoop, target):
        raise OSError(f"{path} could not be renamed to {to}")


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where it is missing."""
    system, hadoop = _file_system(spark, path)
    if not system.exists(hadoop):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(hadoop) if s.isDirectory())


def stored_once(df: DataFrame, label: str, file_rows: int = 0) -> DataFrame:
    """``df`` computed once, written to the shared scratch folder and read from there.

    With ``file_rows`` no file holds more rows than that.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.options(compression="zstd", maxRecordsPerFile=file_rows).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch data of this application, once its results have been read."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        remove_path(spark, _own_scratch(spark, base))
