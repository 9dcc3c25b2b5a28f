"""Line sources for Structured Streaming (and their static counterparts).

Both give ``value`` (the line) and ``arrival_ts`` (the time the line entered
the system: the Kafka record timestamp, or the file's modification time), the
time that windows are computed on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lines import ARRIVAL


def kafka_lines(spark: SparkSession, bootstrap_servers: str, topics: str,
                starting_offsets: str = "latest", min_partitions: int | None = None,
                **options) -> DataFrame:
    """Message values of comma-separated ``topics`` as text; keys are dropped.

    ``min_partitions`` splits large topic partitions over more tasks, so a
    topic with few partitions still parses on every core. Needs the
    ``spark-sql-kafka`` package on the classpath.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topics)
              .option("startingOffsets", starting_offsets))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("value").cast("string").alias("value"),
                                F.col("timestamp").alias(ARRIVAL))


def text_lines(spark: SparkSession, path: str, streaming: bool = True,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of text files under ``path``; arrival time is the file modification time."""
    if streaming:
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    else:
        reader = spark.read.format("text")
    df = reader.load(path)
    return df.select("value", F.col("_metadata.file_modification_time").alias(ARRIVAL))
