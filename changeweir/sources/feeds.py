"""Where changes and snapshots come from."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeweir.schemas import CHANGE_RECORD, TOPIC_ROW


def change_source(
    spark: SparkSession,
    kind: str,
    location: str,
    schema: T.StructType | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A stream of changes.

    * ``kafka``: ``location`` is the topic; rows are Kafka's own, from the earliest
      offset. Needs Spark's Kafka connector on the class path and
      ``kafka.bootstrap.servers`` in ``options``.
    * ``files``: ``location`` is a folder of Parquet files of change records (or of
      ``schema``), picked up as they appear.
    * ``topic_files``: like ``files``, with Kafka's columns.
    """
    options = dict(options or {})
    if kind == "kafka":
        settings = {"startingOffsets": "earliest", "subscribe": location, **options}
        return spark.readStream.format("kafka").options(**settings).load()
    if kind in ("files", "topic_files"):
        columns = schema or (TOPIC_ROW if kind == "topic_files" else CHANGE_RECORD)
        return spark.readStream.schema(columns).options(**options).parquet(location)
    raise ValueError(f"unknown source kind {kind}")


def topic_rows(messages: DataFrame) -> DataFrame:
    """Text messages (``topic, offset, value``) in the shape a topic source delivers them."""
    return messages.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        "topic",
        F.lit(0).alias("partition"),
        "offset",
        F.timestamp_seconds(F.lit(0) + F.col("offset")).alias("timestamp"),
    )


def jdbc_snapshot(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    bounds: tuple[int, int],
    partitions: int,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A whole table over JDBC, read in ``partitions`` key ranges at once.

    ``bounds`` only place the cuts; rows outside them are read too. Credentials
    come in ``options``, from the session's configuration.
    """
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=key,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
            **dict(options or {}),
        )
        .load()
    )
