"""Streams over file drops: deduplication, windowed counts and upsert.

The checkpoint of a query is the high-water mark: a restarted query continues after the
last drop it finished.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from trackmill.sources.tables import ChangeTable


def drops(spark: SparkSession, path: str, schema: StructType, timestamp: str,
          files_per_trigger: int = 1000) -> DataFrame:
    """Parquet drops at ``path``, a folder or a glob, as a stream with a zoned event time,
    which a watermark needs.  ``files_per_trigger`` bounds a micro-batch, no result."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).withColumn(timestamp, F.col(timestamp).cast("timestamp"))


def table_drops(spark: SparkSession, path: str, schema: StructType, timestamp: str) -> DataFrame:
    """A stored table as a stream, be it one file or a folder of files.  Spark takes a plain
    path for a folder, but a glob for whatever it meets."""
    return drops(spark, f"{path[:-1]}[{path[-1]}]", schema, timestamp)


def deduplicated(stream: DataFrame, key: str, timestamp: str, delay: str,
                 repeated: bool = False) -> DataFrame:
    """First arrival per key.

    State lives as long as the watermark allows; a repeat arriving later than ``delay``
    is dropped as late.  ``repeated`` is for keys of which some occur very often in a
    batch: copies are then removed per source partition first, which keeps state twice.
    """
    watched = stream.withWatermark(timestamp, delay)
    if repeated:
        parted = watched.withColumn("_part", F.spark_partition_id())
        watched = parted.dropDuplicatesWithinWatermark([key, "_part"]).drop("_part")
    return watched.dropDuplicatesWithinWatermark([key])


def counts_per_field(stream: DataFrame, timestamp: str, field_name: str, width: str,
                     delay: str) -> DataFrame:
    """Changes per field and tumbling window; a window is final once the watermark has
    passed its end."""
    return (
        stream.withWatermark(timestamp, delay)
        .groupBy(F.window(timestamp, width), field_name)
        .agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("window_start"), field_name, "n")
    )


def run_to_end(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Append what has landed so far to parquet at ``path`` and read it back."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def upsert_stream(stream: DataFrame, table: ChangeTable, checkpoint: str) -> StreamingQuery:
    """Take every micro-batch into ``table``; the caller awaits the query.

    A batch replayed after a failure overwrites itself.  Batches are stored under the
    checkpoint they are counted by, so a query with a new checkpoint, which counts from 0
    again, replaces none of an earlier one.
    """
    source = "stream-" + hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    return (
        stream.writeStream.foreachBatch(lambda batch, number: table.take_in(batch, number, source))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class LateRows(StreamingQueryListener):
    """Rows that the queries of a session dropped for arriving after the watermark, by
    query, over all their progress; register it with ``spark.streams.addListener``."""

    def __init__(self) -> None:
        self.by_query: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.by_query.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        dropped = sum(int(operator.numRowsDroppedByWatermark) for operator in event.progress.stateOperators)
        key = str(event.progress.id)
        self.by_query[key] = self.by_query.get(key, 0) + dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
