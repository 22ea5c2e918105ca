"""Session settings and the checkpoint folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "worktide", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="worktide-checkpoint-"))
    return spark.sparkContext.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so that lost executors do not replay (or reorder) earlier stages."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The rows as Parquet in the checkpoint folder: for wide results that are read more than once.

    A checkpoint keeps whole rows uncompressed; files are compressed, read by column, and their size tells the planner
    whether a join can do without a shuffle. Order and partitions are not kept.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, path)
    return system.exists(target)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    system, target = _file_system(spark, path)
    return [f.getPath().getName() for f in system.listStatus(target)] if system.exists(target) else []


def make_folder(spark: SparkSession, path: str) -> None:
    system, target = _file_system(spark, path)
    system.mkdirs(target)


def remove_path(spark: SparkSession, path: str) -> None:
    system, target = _file_system(spark, path)
    system.delete(target, True)
