"""Queries of streams: the events' table in files, replayed with availableNow and taken up again from the checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import table
from ..sources import paths
from ..streaming import releases
from .base import query

_KIND = """CASE WHEN event_type = 'purchase' AND user_id % 3 = 0 THEN 'confirmed' WHEN event_type = 'error' AND user_id % 4 = 0 THEN 'upstream' WHEN event_type = 'signup' AND user_id % 5 = 0 THEN 'scoped'
 WHEN value > 30 AND user_id % 10 = 0 THEN 'applied' WHEN event_type = 'view' AND user_id % 7 > 0 THEN 'scheduled' ELSE 'other' END"""
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _release_events(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), F.expr("timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts))").alias("ts"), F.to_date("ts").alias("day"), F.expr(_KIND).alias("kind"), "event_id")
    return rows.withColumn("release", F.when((F.col("kind") == "scheduled") & (F.col("event_id") % 6 > 0), F.date_add("day", (F.col("event_id") % 25).cast("int"))))


@query(f"""
WITH e AS (
    SELECT CAST(user_id AS VARCHAR) AS key, ts, {_KIND} AS kind, CASE WHEN event_id % 6 > 0 THEN CAST(ts AS DATE) + CAST(event_id % 25 AS INT) END AS release FROM events
), folded AS (
    SELECT key, bool_or(kind = 'confirmed') AS confirmed, bool_or(kind = 'scoped') AS scoped, bool_or(kind = 'applied') AS applied, bool_or(kind = 'upstream') AS upstream, arg_max({{'r': release}}, ts) FILTER (kind = 'scheduled') AS s FROM e GROUP BY key
), today AS (
    SELECT CAST(max(ts) - INTERVAL 10 DAY AS DATE) AS d FROM events
), states AS (
    SELECT key, CASE WHEN scoped AND applied THEN 'CURRENT_SCOPED_RECONCILED' WHEN confirmed AND upstream THEN 'READY_FOR_GUARDED_REINGESTION' WHEN confirmed THEN 'CURRENT_LEGAL_CONFIRMED_WAITING_UPSTREAM_PROJECTION'
           WHEN s.r IS NULL THEN 'UPCOMING_HOLD_NO_RELEASE_DATE' WHEN d < s.r THEN 'PRE_RELEASE_HOLD' ELSE 'RELEASE_DATE_REACHED_AWAITING_OFFICIAL_CURRENTNESS' END AS state
    FROM folded, today
)
SELECT key, state, state = 'READY_FOR_GUARDED_REINGESTION' AS candidate_eligible FROM states
""")
def release_states_streamed(spark, sf_dir):
    """The state that each key's stream ends in: files of six days, a tenth of the events a file late, a restart from the checkpoint after the third."""
    root = paths.new_folder(spark, "stream")
    events = _release_events(spark, sf_dir)
    first = events.agg(F.min("day")).first()[0]
    part = F.floor(F.datediff("day", F.lit(first)) / 6).cast("int")
    dealt = events.withColumn("file", F.least(part, F.lit(4)) + F.when((F.col("event_id") % 10 == 3) & (part < 4), 1).otherwise(0)).drop("event_id", "day")
    was = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        for files in ((0, 1, 2), (3, 4)):
            for n in files:
                dealt.filter(F.col("file") == n).drop("file").coalesce(1).write.mode("append").parquet(f"{root}/in")
            arriving = spark.readStream.schema(releases.EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
            stream = releases.release_states(arriving, "10 days").writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
            stream.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", was)
    changes = spark.read.schema(releases.CHANGES).parquet(f"{root}/out")
    last = changes.groupBy("key").agg(F.max_by(F.struct("state", "candidate_eligible"), "nth").alias("x")).select("key", "x.state", "x.candidate_eligible")
    return paths.read_and_removed(last, root)
