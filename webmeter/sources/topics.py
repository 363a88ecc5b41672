"""Topics as directories of Parquet files, and JSON reports.

Where the Kafka connector is on the class path the same frames go to the
``kafka`` source and sink; the directories need nothing but a shared folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import partition_key
from ..schema import MESSAGE


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that driver and executors share: below spark.checkpoint.dir, or the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def publish(messages: DataFrame, folder: str, mode: str = "append") -> None:
    """Appends messages (topic, partition, offset, key, value) to a topic."""
    messages.select(*MESSAGE.fieldNames()).write.mode(mode).parquet(folder)


def log_sink(messages: DataFrame):
    """Writer of a streaming query that prints its messages instead of publishing them."""
    return messages.selectExpr("topic", "key", "value").writeStream.format("console").option("truncate", False)


def poison(spark: SparkSession, topic: str) -> DataFrame:
    """Two messages that no consumer can use, with keys: broken JSON and an event without its required fields."""
    values = [(topic, 0, -1, "poison/1", "{oops"), (topic, 0, -1, "poison/2", '{"id":"poison"}')]
    return spark.createDataFrame(values, MESSAGE)


def keyed(events: DataFrame, value, topic: str) -> DataFrame:
    """Events as messages keyed by site and visitor; one partition keeps a visitor's order."""
    return events.select(F.lit(topic).alias("topic"), F.col("part").alias("partition"), F.col("offset").cast("long").alias("offset"), partition_key(F.col("site_id"), F.col("visitor_id")).alias("key"), value.alias("value"))


def scan(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Streaming scan of a topic from its first message."""
    reader = spark.readStream.schema(MESSAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path))


def create(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_report(report: DataFrame, folder: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(folder)


def read_report(spark: SparkSession, folder: str, schema: str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).json(folder)
