"""Stream sources over files and sinks in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import scratch_path


def stream_table(spark: SparkSession, folder: str, name: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """Stream the parquet files of `folder` whose name matches `name`, and the files of folders so named."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # a pattern even for one name: a stream takes a single file only from a pattern
    pattern = name if any(c in name for c in "*?[{") else f"[{name[0]}]{name[1:]}"
    return reader.parquet(f"{folder}/{pattern}")


def drain(stream: DataFrame, label: str, on_batch: Callable[[DataFrame, int], None] | None = None,
          mode: str = "append", path: str | None = None) -> str:
    """Run a stream over everything available and return the folder written.

    Without `on_batch` rows are appended as parquet with exactly-once file
    commits; with it each micro-batch is handed over, for upserts and fan-out.
    Progress is kept in the shared folder, so a restart resumes.
    """
    spark = stream.sparkSession
    out = path or scratch_path(spark, label)
    writer = stream.writeStream.outputMode(mode).trigger(availableNow=True) \
        .option("checkpointLocation", f"{out}-progress")
    if on_batch:
        query = writer.foreachBatch(on_batch).start()
    else:
        query = writer.format("parquet").start(out)
    query.awaitTermination()
    return out


def collected(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Rows an append-mode stream has produced, read back as a table."""
    path = drain(stream, label, mode=mode)
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def versioned(stream: DataFrame, label: str, mode: str = "update") -> DataFrame:
    """Every version an updating stream produced, with its `batch` number. A
    replayed micro-batch overwrites its own folder."""
    spark = stream.sparkSession
    out = scratch_path(spark, label)

    def save(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    drain(stream, label, save, mode, out)
    return spark.read.schema(stream.schema.add("batch", "long")).parquet(out)


def latest_version(versions: DataFrame, keys: list[str]) -> DataFrame:
    """Newest version per key."""
    rest = [c for c in versions.columns if c not in keys and c != "batch"]
    return versions.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("v")).select(*keys, "v.*")
