"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations.

Every source has a target: its weight's share of all words, but at most ``MOST_TIMES`` its
own words, the excess shared anew.  A source's documents stand in a shuffled order and may
pass up to ``MOST_TIMES`` times.  Each passing gets a virtual finish time: the words of its
source up to and including it, divided by the source's target.  All passings are sorted by
finish time over the whole cluster, and the mix takes them until the budget, all words, is
used up; every source then stands within a document of its target.

Both orders are running sums over range partitions, so the source that holds a third of all
rows is spread over many tasks like any other run of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackmill.llm.prefix import running_sums
from trackmill.session import durable

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
WORD = r"[^\x20\x09-\x0D]+"


def text_size(text_col: str = "text"):
    """Words between blanks of a text; none in an absent one."""
    return F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most_times: int = MOST_TIMES
) -> DataFrame:
    """Target of each source: ``source``, ``source_size``, ``target``.

    Sources in code point order, the absent one last, weigh ``weights`` in turn.  ``sizes``
    is reduced to one row per source before anything else happens.

    With sources sorted by size over weight, those that reach their limit come first: a
    source is held at its limit if the limit is below its share of what the sources before
    it leave over.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    limits = sources.withColumn("weight", weight.cast("decimal(38,0)")).withColumn(
        "limit", (F.col("source_size") * most_times).cast("decimal(38,0)")
    )
    order = W.orderBy(
        (F.col("limit").cast("double") / F.col("weight").cast("double")).asc(), F.col("source").asc_nulls_last()
    )
    before, onward = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy(F.lit(0))
    left = (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))).cast("double")
    shares = limits.select(
        "source", "source_size", "weight", "limit", left.alias("left"),
        F.sum("weight").over(onward).cast("double").alias("weights_left"),
    )
    wanted = F.col("weight").cast("double") * F.col("left") / F.col("weights_left")
    held = F.col("limit").cast("double") <= wanted
    # The first source that is not held, with most weights left, sets the rate of all others.
    first = F.max_by(F.struct("left", "weights_left"), F.when(~held, F.col("weights_left"))).over(everything)
    rate = F.col("weight").cast("double") * first["left"] / first["weights_left"]
    return shares.select(
        "source", "source_size",
        F.when(held, F.col("limit").cast("double")).otherwise(rate).alias("target"),
    )


def fair_mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[int] = WEIGHTS, most_times: int = MOST_TIMES,
) -> DataFrame:
    """What the mix takes of every row: ``id``, ``source``, ``text_hash``, ``size``,
    ``source_size``, ``target``, ``copies`` and ``taken``, the words of all its copies.

    One row per input row.  Absent texts and texts without words have size 0; they stand in
    the mix once and take nothing from the budget.  Absent sources are one source.  Equal
    identifiers stand next to each other in an order their texts fix, so reruns agree.
    """
    sized = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), text_size(text_col).alias("size"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("shuffle"),
    )
    sized = durable(sized)
    targets = durable(source_targets(sized, weights, most_times))
    # One order for all sources: what stands before a source is the words of those before it.
    by_source = W.orderBy(F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    known = targets.withColumn("_first", F.coalesce(F.sum("source_size").over(by_source), F.lit(0)))
    order = [F.col("source").asc_nulls_last(), "shuffle", "id", "text_hash"]
    placed = running_sums(
        sized.withColumn("one", F.lit(1)), order, {"words_to": "size", "position": "one"}
    ).drop("one")
    queued = placed.alias("d").join(known.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select(
        "d.id", "d.source", "d.text_hash", "d.shuffle", "d.size", "d.position", "t.source_size", "t.target",
        (F.col("d.words_to") - F.col("t._first")).alias("own_words"),
    )
    passings = F.when(F.col("size") > 0, F.sequence(F.lit(0), F.lit(most_times - 1))).otherwise(F.array(F.lit(0)))
    passing = queued.withColumn("passing", F.explode(passings)).withColumn(
        "finish",
        F.when(F.col("target") > 0, (F.col("passing") * F.col("source_size") + F.col("own_words")) / F.col("target"))
        .otherwise(F.lit(0.0)),
    )
    finished = running_sums(passing, ["finish", F.col("source").asc_nulls_last(), "position"], {"used": "size"})
    budget = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0))).scalar()
    taken = (F.col("used") <= budget) | (F.col("size") == 0)
    return (
        finished.groupBy("position", "id", "source", "text_hash", "size", "source_size", "target")
        .agg(
            F.sum(F.when(taken, 1).otherwise(0)).alias("copies"),
            F.sum(F.when(taken, F.col("size")).otherwise(0)).alias("taken"),
        )
        .drop("position")
    )


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[int] = WEIGHTS, most_times: int = MOST_TIMES,
) -> DataFrame:
    """The documents of the mix with all their columns, whatever these are called, each as often as
    the mix takes it.

    Texts, identifiers and sources may be absent.  Rows that agree in all three are as good as one
    another: the mix takes as many of each in all.  An empty table gives no rows.
    """
    # A struct is never null and its absent members are equal, so absent keys meet too.
    same = F.struct(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.xxhash64(text_col).alias("text_hash"))
    plan = fair_mix(docs, id_col, text_col, source_col, weights, most_times).select(
        F.struct("id", "source", "text_hash").alias("_key"), F.col("copies").alias("_copies")
    )
    # One row for each key, with how often its rows go by; each of its rows takes the same part of
    # that, and the first few one more.  Written, so that the join with it can be split.
    plan = durable(plan.groupBy("_key").agg(F.sum("_copies").alias("_copies"), F.count("*").alias("_rows")))
    named = docs.select(F.struct("*").alias("_row"), same.alias("_key"))
    met = named.join(plan.where("_copies > 0"), "_key")
    # Only rows that are told apart by nothing need a number among their like.
    alone = met.where("_rows = 1").withColumn("_times", F.col("_copies"))
    number = F.row_number().over(W.partitionBy("_key").orderBy(F.lit(0))) - 1
    alike = met.where("_rows > 1").withColumn("_number", number).withColumn(
        "_times", F.floor(F.col("_copies") / F.col("_rows")) + F.when(F.col("_number") < F.col("_copies") % F.col("_rows"), 1).otherwise(0)
    ).drop("_number")
    taken = alone.unionByName(alike).where("_times > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))).select("_row.*")
