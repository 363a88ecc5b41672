"""Streaming forms of the pipeline, driven to completion over a staged topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import bucket_id
from ..operators import counters, pipeline
from ..schema import DEDUPE_TTL_MIN_S, DEDUPE_TTL_S
from ..sources import topics, webevents
from . import sinks, stateful

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _staged(spark: SparkSession, d: str, files: int = 3) -> tuple[str, str]:
    """The web events as a topic folder, in order of reception over a few files; and its parent."""
    folder = topics.shared_folder(spark)
    # slices of the reception time, derived and written once, then published oldest first
    rows = webevents.web_events(spark, d)
    at = rows.agg(F.min("received_at").alias("a"), F.max("received_at").alias("b")).select(F.unix_micros("a"), F.unix_micros("b")).first()
    if at[0] is None:
        rows.write.parquet(f"{folder}/in")
        return folder, f"{folder}/in"
    width = (at[1] - at[0]) // files + 1
    sliced = rows.withColumn("slice", F.floor((F.unix_micros("received_at") - at[0]) / width).cast("int"))
    sliced.write.partitionBy("slice").parquet(f"{folder}/sliced")
    for k in range(files):
        part = spark.read.schema(sliced.schema).parquet(f"{folder}/sliced").where(F.col("slice") == k).drop("slice")
        part.write.mode("append").parquet(f"{folder}/in")
    return folder, f"{folder}/in"


def _stream(spark: SparkSession, d: str, path: str) -> DataFrame:
    return spark.readStream.schema(webevents.web_events(spark, d).schema).parquet(path)


def topic_scan(spark: SparkSession, d: str) -> DataFrame:
    """Messages published to a topic and read back in small micro-batches: number, keys and last offset of each partition."""
    folder = topics.shared_folder(spark)
    rows = webevents.with_offsets(webevents.web_events(spark, d))
    topics.publish(topics.keyed(rows, F.to_json(F.struct("id", "type")), "raw-events"), f"{folder}/topic")
    read = topics.scan(spark, f"{folder}/topic", files_per_batch=2)
    _drain(read.writeStream.format("parquet").option("path", f"{folder}/out"), f"{folder}/cp")
    got = spark.read.schema(read.schema).parquet(f"{folder}/out")
    return got.groupBy("partition").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("key").alias("keys"), F.max("offset").alias("last_offset"))


def _drain(writer, checkpoint: str) -> None:
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stream_scan(spark: SparkSession, d: str) -> DataFrame:
    """Rows a partition read by a streaming scan from the first message."""
    folder, path = _staged(spark, d)
    _drain(_stream(spark, d, path).select("part", "id", "copy").writeStream.format("parquet").option("path", f"{folder}/out"), f"{folder}/cp")
    return spark.read.schema("part int, id string, copy int").parquet(f"{folder}/out").groupBy("part").agg(F.count(F.lit(1)).alias("n"))


def route_outputs(spark: SparkSession, d: str) -> DataFrame:
    """Accepted events and dead letters by reason, routed to two topics by one sink."""
    folder, path = _staged(spark, d)
    judged = pipeline.judged(_stream(spark, d, path)).select("id", "copy", "reason")
    _drain(judged.writeStream.foreachBatch(sinks.split_sink(f"{folder}/enriched", f"{folder}/dead")), f"{folder}/cp")
    both = [spark.read.schema("id string, copy int, reason string").parquet(f"{folder}/{x}").select(F.lit(x).alias("output"), F.coalesce("reason", F.lit("")).alias("reason")) for x in ("enriched", "dead")]
    return both[0].unionByName(both[1]).groupBy("output", "reason").agg(F.count(F.lit(1)).alias("n"))


def unique_stream(events: DataFrame, ttl_s: int = DEDUPE_TTL_S) -> DataFrame:
    """First deliveries of (site, id) within the ttl, which must outlast the allowed lateness."""
    if ttl_s < DEDUPE_TTL_MIN_S:
        raise ValueError(f"the dedupe ttl must be at least {DEDUPE_TTL_MIN_S} s")
    return events.withWatermark("received_at", f"{ttl_s} seconds").dropDuplicatesWithinWatermark(["site_id", "id"])


def stream_minute_counters(spark: SparkSession, d: str) -> DataFrame:
    """Counters of first deliveries: deltas of every micro-batch, summed on reading."""
    folder, path = _staged(spark, d)
    rows = unique_stream(pipeline.enriched(pipeline.accepted(_stream(spark, d, path))))

    def delta(batch: DataFrame) -> DataFrame:
        named = batch.groupBy("site_id", bucket_id(F.col("site_id"), F.col("ts")).alias("bucket_id"))
        return named.agg(*(x.alias(n) for n, x in counters.counter_columns(F.lit(False)).items()))

    _drain(rows.writeStream.foreachBatch(sinks.delta_sink(f"{folder}/deltas", delta)), f"{folder}/cp")
    return sinks.read_deltas(spark, f"{folder}/deltas").select("bucket_id", "pageviews", "clicks", "bot_events")


def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of human events by the stateful operator."""
    folder, path = _staged(spark, d)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        humans = pipeline.enriched(pipeline.accepted(_stream(spark, d, path))).where("not is_bot")
        out = stateful.assign(humans.withColumns({"order": F.col("event_id") * 2 + F.col("copy"), "payload": F.col("copy").cast("string")}))
        _drain(out.select("id", F.col("payload").cast("int").alias("copy"), "site_id", "visitor_id", "session_id", "new_session").writeStream.format("parquet").option("path", f"{folder}/out"), f"{folder}/cp")
    finally:
        if before is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return spark.read.schema("id string, copy int, site_id string, visitor_id string, session_id string, new_session boolean").parquet(f"{folder}/out")
