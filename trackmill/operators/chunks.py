"""Time chunks: splitting a range and counting rows per chunk."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmill.functions.instants import Instant, as_utc, elapsed_hours, elapsed_seconds, instant
from trackmill.operators.filters import TimeWindow
from trackmill.operators.joins import chunk_index

OPEN_START = timedelta(days=30)


def time_chunks(spark: SparkSession, start: Instant, end: Instant, hours: int) -> DataFrame:
    """Split ``[start, end]`` into chunks of ``hours``; the last may be shorter."""
    if hours < 1:
        raise ValueError("granularity must be at least one hour")
    width = timedelta(hours=hours)
    count = max(-((as_utc(start) - as_utc(end)) // width), 0)
    begin = instant(start) + F.make_interval(hours=F.col("id") * hours)
    rows = spark.range(count).select(F.col("id").alias("chunk"), begin.alias("chunk_start"))
    return with_durations(rows.withColumn(
        "chunk_end",
        F.least(F.col("chunk_start") + F.make_interval(hours=F.lit(hours)), instant(end)),
    ))


def window_chunks(spark: SparkSession, window: TimeWindow, as_of: Instant) -> DataFrame:
    """Chunks of a window; an open end is ``as_of``, an open start 30 days earlier."""
    end = as_utc(window.until if window.until is not None else as_of)
    start = as_utc(window.since) if window.since is not None else end - OPEN_START
    return time_chunks(spark, start, end, window.granularity_hours)


def covering_chunks(df: DataFrame, timestamp: str, hours: int) -> DataFrame:
    """Chunks over the whole span of a column, as Spark finds it."""
    step = F.make_interval(hours=F.lit(hours))
    last = F.col("_end") - F.expr("INTERVAL '0.000001' SECOND")
    span = df.agg(F.min(timestamp).alias("_start"), F.max(timestamp).alias("_end"))
    starts = span.where(F.col("_start") < F.col("_end")).select(
        "_end", F.posexplode(F.sequence("_start", last, step)).alias("chunk", "chunk_start")
    )
    return with_durations(starts.select(
        F.col("chunk").cast("long").alias("chunk"),
        "chunk_start",
        F.least(F.col("chunk_start") + step, F.col("_end")).alias("chunk_end"),
    ))


def with_durations(chunks: DataFrame) -> DataFrame:
    return chunks.withColumns({
        "duration_seconds": elapsed_seconds(F.col("chunk_start"), F.col("chunk_end")),
        "duration_hours": elapsed_hours(F.col("chunk_start"), F.col("chunk_end")),
    })


def rows_per_chunk(
    df: DataFrame, timestamp: str, start: Instant, end: Instant, hours: int
) -> DataFrame:
    """Rows in every fixed-width chunk that has any, by arithmetic and not by a join."""
    chunk = chunk_index(F.col(timestamp), start, end, hours)
    inside = df.where(F.col(timestamp).between(instant(start), instant(end)))
    counted = inside.select(chunk.alias("chunk")).groupBy("chunk").agg(F.count("*").alias("n"))
    begin = instant(start) + F.make_interval(hours=F.col("chunk").cast("int") * hours)
    return counted.where(F.col("chunk").isNotNull()).select("chunk", begin.alias("chunk_start"), "n")
