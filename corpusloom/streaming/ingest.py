"""Incremental ingest with Structured Streaming: idempotent appends, running counts, resumable.

Late data: the reference semantics have no event time, so event-time queries here choose a
watermark of one day and say so; a replay of a finite table gives what the batch query gives.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..store import run_folder


def dedup_key() -> Column:
    """One event a user, type and day."""
    return F.concat_ws("::", F.col("user_id").cast("string"), "event_type", F.to_date("ts").cast("string"))


#: Files of so many bytes together are taken by one micro-batch.
BATCH_BYTES = 8 << 30


def event_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int | None = None, bytes_per_trigger: int = BATCH_BYTES) -> DataFrame:
    """The events table as a stream of files, so many bytes (or, on request, files) a micro-batch, so that small files don't cost a batch each."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    whole = _is_folder(spark, path)
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet" if whole else name)
    stream = stream.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else stream.option("maxBytesPerTrigger", bytes_per_trigger)
    return stream.parquet(path if whole else folder).where(F.input_file_name().contains(f"/{name}"))


def _is_folder(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).isDirectory()


def upsert_new(batch: DataFrame, target: str, key: str = "dedup_key") -> None:
    """Append rows whose key the target lacks, the first of each key by event id."""
    spark = batch.sparkSession
    first = batch.groupBy(key).agg(F.min("event_id").alias("event_id"))
    try:
        known = spark.read.parquet(target).select(key)
    except Exception as missing:  # the first batch finds no table
        if "PATH_NOT_FOUND" not in str(missing) and "UNABLE_TO_INFER_SCHEMA" not in str(missing):
            raise
        known = first.limit(0).select(key)
    first.join(known, key, "left_anti").select(key, "event_id").write.mode("append").parquet(target)


def ingest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dedup_key, event_id) of the first event of each key, taken in micro-batches.

    A batch that is repeated after a failure appends nothing new, so the checkpoint may lag behind.
    """
    base = f"{run_folder(spark)}/ingest-{uuid.uuid4().hex}"
    keyed = event_stream(spark, sf_dir).select("event_id", dedup_key().alias("dedup_key"))
    query: StreamingQuery = keyed.writeStream.foreachBatch(lambda df, _: upsert_new(df, f"{base}/table")).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{base}/table")


def running_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_type, n, total) kept as streaming state and written whenever it changes; the last state is returned."""
    base = f"{run_folder(spark)}/counts-{uuid.uuid4().hex}"
    counts = event_stream(spark, sf_dir).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))
    query = counts.writeStream.outputMode("complete").foreachBatch(lambda df, n: df.withColumn("batch", F.lit(n)).write.mode("append").parquet(f"{base}/table")).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    states = spark.read.parquet(f"{base}/table")
    last = states.agg(F.max("batch").alias("batch"))
    return states.join(F.broadcast(last), "batch", "left_semi").select("event_type", "n", "cents")


def windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(day, event_type, n) by event time, with a watermark of one day; windows still open at the end are flushed by complete mode."""
    base = f"{run_folder(spark)}/windows-{uuid.uuid4().hex}"
    stream = event_stream(spark, sf_dir).withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", "1 day")
    counts = stream.groupBy(F.window("at", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    flat = counts.select(F.to_date("w.start").alias("day"), "event_type", "n")
    query = flat.writeStream.outputMode("complete").foreachBatch(lambda df, n: df.withColumn("batch", F.lit(n)).write.mode("append").parquet(f"{base}/table")).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    states = spark.read.parquet(f"{base}/table")
    last = states.agg(F.max("batch").alias("batch"))
    return states.join(F.broadcast(last), "batch", "left_semi").select("day", "event_type", "n")


QUERIES = {"stream_ingest": ingest_events, "stream_running_counts": running_counts, "stream_windowed_counts": windowed_counts}
ORACLE = {
    "stream_ingest": "SELECT concat_ws('::', user_id::VARCHAR, event_type, CAST(ts AS DATE)::VARCHAR) AS dedup_key, min(event_id) AS event_id FROM events GROUP BY 1",
    "stream_running_counts": "SELECT event_type, count(*)::BIGINT AS n, sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS cents FROM events GROUP BY event_type",
    "stream_windowed_counts": "SELECT CAST(ts AS DATE) AS day, event_type, count(*)::BIGINT AS n FROM events GROUP BY 1, 2",
}
