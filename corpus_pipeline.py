"""From raw documents to token files: five stages, each on all that the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the
columns of ``documents``.  Between two stages the documents are written to the shared folder
and read again, so a lost executor costs no more than the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackmill.llm import decontaminate, mixing, simhash, token_files, toxicity
from trackmill.llm.common import table
from trackmill.session import scratch_path


# Each stage says what it does with odd rows; rows are as its operator takes them, and an empty
# table gives an empty one.


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on their labelled rows, does not reject.  Absent and
    empty texts show no evidence and are judged alike; repeated rows stay or go together."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, whose SimHash fingerprints of three-word shingles
    are linked at two differing bits or fewer: that with the smallest identifier, absent ones last.
    Texts without words are one group; of repeated rows one stays."""
    return simhash.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, not even with a fifth of its words changed.  Absent and
    empty texts hold none; repeated rows stay or go together."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, so that sources meet their targets.  Absent sources
    are one source; texts without words stand in the mix once."""
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents; per document its identifier, start, length and checksum.  Absent
    identifiers stand first, an absent or empty text is its end id alone, repeated rows are repeated."""
    return token_files.token_files(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("source_mix", mix_sources),
    ("token_files", write_tokens),
]

# The models and the tokenizer are not SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
