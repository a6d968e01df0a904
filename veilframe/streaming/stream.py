"""Structured Streaming: recipes on streams, windowed audit counts, resumable logs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.actions import Engine
from ..operators.selectors import Field


def stream_table(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A parquet folder or glob as a file stream; max_files is the flush interval."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isFile():
        # A file stream watches folders: the one file is picked out of its folder.
        return reader.option("pathGlobFilter", p.getName()).parquet(p.getParent().toString())
    return reader.parquet(path)


def rewrite(stream: DataFrame, engine: Engine, fields: list[Field]) -> DataFrame:
    """The compiled recipe on a stream: stateless, so append mode needs no watermark."""
    return engine.wide(stream, fields)


def audit_counts(stream: DataFrame, at: str = "ts", by: str = "event_type", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows for each window and kind; state is dropped once the watermark has passed."""
    return stream.withWatermark(at, late).groupBy(F.window(at, window), by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), by, "n")


def first_only(stream: DataFrame, key: str = "src_path") -> DataFrame:
    """Rows whose key no earlier row of the stream had: the keys seen are state, so no batch reads the log again."""
    return stream.dropDuplicates([key])


def append_first(path: str, key: str = "src_path") -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink: each batch has a folder of its own, so that one replayed after a crash replaces itself."""

    def sink(batch: DataFrame, epoch: int) -> None:
        batch.dropDuplicates([key]).write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    return sink


def latest(path: str) -> Callable[[DataFrame, int], None]:
    """A sink for update mode: the changed rows of each batch; `read_latest` takes the last of each key."""
    return lambda batch, epoch: batch.write.mode("overwrite").parquet(f"{path}/batch={epoch}")


def read_latest(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """The last state of each key, so windows that are still open when the stream ends are there too."""
    rows = spark.read.option("basePath", path).parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("__last")).select(*keys, "__last.*")


def run_available(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Everything that is there by now, then stop; a later run goes on from the checkpoint."""
    query = stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
