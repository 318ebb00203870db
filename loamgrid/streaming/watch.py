"""An extension: the upstream watch as a stream. The library's other operators are batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.gates import upstream_changed


def watch(spark: SparkSession, folder: str, schema: str, act: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Watch reports (source_id, pinned, live, relation) that arrive as JSON lines; each batch's changed sources go to `act` once."""
    reports = spark.readStream.schema(schema).json(folder).filter(upstream_changed(F.col("relation")))
    return reports.writeStream.foreachBatch(act).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Events of each kind by window of event time; rows later than the watermark are left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
