"""Substring search through an index of trigrams.

The index has a row for each trigram of a text in lower case and the text's key, in folders by the
trigram's hash and sorted by it, beside a table of how many texts hold each trigram.  A text that
holds a term holds all its trigrams, so the postings of the term's rarest few are intersected, and the
search itself is run on the texts that are left.  The index proposes; it never decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmill.functions.text import contains_text
from trackmill.sources.tables import save_table

FOLDERS = 64
FOLDER = "gram_folder"
# Trigrams of a term that are looked up, the rarest first.
LOOKED_UP = 4
# Tasks that write one folder, at most.
DEALT = 16
# A trigram, read ahead of its first code point.
GRAM = r"(?s)(?![\x{DC00}-\x{DFFF}])(?=(...))"
# --- end of fixed values ---


def grams(text: Column) -> Column:
    """The different trigrams of a text in lower case, by code points."""
    # One search that looks at every place but takes nothing; a place amid a surrogate pair is none.
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(GRAM), F.lit(1)))


def folder(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(FOLDERS)).cast("int")


def build_index(issues: DataFrame, column: str, path: str, key: str = "id") -> TextIndex:
    """Write the index of a text column; absent texts and keys have no postings."""
    texts = issues.where(F.col(column).isNotNull() & F.col(key).isNotNull())
    postings = texts.select(key, F.explode(grams(F.col(column))).alias("gram")).withColumn(FOLDER, folder(F.col("gram")))
    # A folder is dealt to several tasks by the key, and so is a trigram that nearly all texts hold.  Not by
    # ranges: their bounds cost another pass over all texts.
    dealt = postings.repartition(FOLDER, F.pmod(F.xxhash64(key), F.lit(DEALT))).sortWithinPartitions(FOLDER, "gram", key)
    save_table(dealt, f"{path}/postings", [FOLDER])
    spark = issues.sparkSession
    counts = spark.read.parquet(f"{path}/postings").groupBy("gram", FOLDER).agg(F.count("*").alias("texts"))
    save_table(counts.repartition(FOLDER).sortWithinPartitions(FOLDER, "gram"), f"{path}/counts", [FOLDER])
    return TextIndex(spark, path, column, key)


class TextIndex:
    def __init__(self, spark: SparkSession, path: str, column: str, key: str = "id") -> None:
        self.spark, self.path, self.column, self.key = spark, path, column, key

    def term_grams(self, term: str) -> list[str]:
        """The trigrams of a term as the index has them; Spark lowers it as it does texts."""
        row = self.spark.range(1).select(grams(F.lit(term)).alias("grams")).first()
        return row["grams"]

    def rarest(self, term: str) -> list[str] | None:
        """The trigrams to look up, at most ``LOOKED_UP``; None where no text holds one of the term's."""
        wanted = self.term_grams(term)
        listed = self.spark.range(1).select(F.explode(F.lit(wanted)).alias("gram")).select("gram", folder(F.col("gram")).alias(FOLDER))
        folders = sorted({row[FOLDER] for row in listed.collect()})
        counts = self.spark.read.parquet(f"{self.path}/counts")
        held = counts.where(F.col(FOLDER).isin(folders) & F.col("gram").isin(wanted)).select("gram", "texts").collect()
        if len(held) < len(wanted):
            return None
        return [row["gram"] for row in sorted(held, key=lambda row: (row["texts"], row["gram"]))[:LOOKED_UP]]

    def candidates(self, term: str) -> DataFrame | None:
        """Keys of texts that hold the term's rarest trigrams; None for a term under three
        characters, about which the index says nothing."""
        if len(self.term_grams(term)) == 0:
            return None
        postings = self.spark.read.parquet(f"{self.path}/postings")
        looked_up = self.rarest(term)
        if looked_up is None:
            return postings.select(self.key).limit(0)
        listed = self.spark.range(1).select(F.explode(F.lit(looked_up)).alias("gram"))
        folders = sorted({row[0] for row in listed.select(folder(F.col("gram"))).collect()})
        own = postings.where(F.col(FOLDER).isin(folders) & F.col("gram").isin(looked_up))
        return own.groupBy(self.key).agg(F.count("*").alias("held")).where(F.col("held") == len(looked_up)).select(self.key)

    def search(self, issues: DataFrame, term: str) -> DataFrame:
        """Issues whose text holds the term, as the plain search finds them.  A term under three
        characters is looked for in every text."""
        found = self.candidates(term)
        if found is not None:
            issues = issues.join(found, self.key, "left_semi").select(*issues.columns)
        return issues.where(contains_text(F.col(self.column), term))
