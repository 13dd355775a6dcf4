"""What several operators share: reading, session settings, state of a Python worker."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of an Arrow batch.  Texts may be long, so a batch holds few of them: 256 texts of
# 100 kB are 25 MB.
BATCH_ROWS = 256

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session's Python stages."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def ascii_lower(column: Column) -> Column:
    """``A``-``Z`` in lower case, every other character as it is."""
    return F.translate(column, UPPER, UPPER.lower())


def worker_state(name: str, make: Callable[[], object]) -> object:
    """A value that this Python worker keeps from task to task, made at first use.

    A worker keeps one value: what another stage left there goes first, so that the memory
    of a worker does not grow with the stages it has served."""
    holder = sys.modules.setdefault("_llm_worker_state", types.ModuleType("_llm_worker_state"))
    if getattr(holder, "name", None) != name:
        holder.name = holder.value = None
        holder.value = make()
        holder.name = name
    return holder.value


def partitions_of(df: DataFrame) -> int:
    return max(1, df.rdd.getNumPartitions())
