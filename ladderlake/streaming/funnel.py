"""The quality funnel over a stream of code records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.cleaning import funneled


def read_stream(spark: SparkSession, path: str, files_at_once: int = 100) -> DataFrame:
    """Records task, code, ts of JSON lines that arrive in a folder."""
    return spark.readStream.schema("task string, code string, ts timestamp").option("maxFilesPerTrigger", files_at_once).json(path)


def funnel(records: DataFrame, delay: str = "1 hour") -> DataFrame:
    """The first record of each task that arrives within the delay, with its repaired code, quality and error. Keys older than the delay leave the state. Also takes a DataFrame that isn't a stream."""
    once = records.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["task"]) if records.isStreaming else records.dropDuplicates(["task"])
    return funneled(once)


def write_stream(funneled: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Parquet by quality. The file sink writes each record exactly once over restarts."""
    w = funneled.writeStream.format("parquet").partitionBy("quality").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if once else w).start()
