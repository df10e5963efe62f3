"""Unbounded sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def topic_options(
    servers: str,
    topic: str,
    starting: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source.

    ``starting`` ("latest" or "earliest") counts on the first start only. A
    trimmed topic is tolerated unless ``fail_on_data_loss``. ``max_offsets``
    bounds a micro-batch; ``min_partitions`` spreads few topic partitions
    over more tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def open_topic(spark: SparkSession, servers: str, topic: str, **settings) -> DataFrame:
    """Message stream of one topic; needs the Kafka package on the class path."""
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, **settings)).load()


def open_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """New files below ``path`` as a stream."""
    reader = spark.readStream.schema(schema).format(file_format)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def publish(df: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """Send a ``value`` column to a topic: a batch at once, a stream as a query."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if df.isStreaming:
        return (
            df.writeStream.format("kafka").options(**options)
            .option("checkpointLocation", checkpoint).start()
        )
    return df.write.format("kafka").options(**options).save()
