"""Session construction and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on; a cluster passes its own sizes on top.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str = "tallyloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from `spark.checkpoint.dir`.

    A session without that setting is an error: no folder of one machine stands in.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` to the shared folder and read it back, so a lost executor
    costs a re-read instead of a recomputation of everything before it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame, label: str = "stage") -> tuple[DataFrame, str]:
    """As `cut_lineage`, with the folder, for tables that `discard` removes later. The shuffle
    files behind `df` go when it is written; nothing reads them again."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(setting, before) if before is not None else spark.conf.unset(setting)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete tables that `written` made, once no plan to come reads them."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
