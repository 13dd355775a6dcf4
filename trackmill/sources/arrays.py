"""Pretty-printed JSON arrays of any size, read by many tasks.

A JSON string holds no line break, so every line can be read by itself: without its strings, it
opens and closes so many brackets.  Where a file indents its records, a line that opens a bracket at
exactly the indentation of the first record begins one whatever the depth says, so the damage of a
record whose brackets do not close ends there.  Such a file is read in parts that end before these
lines, and a part knows its records without any other.

A file that does not indent its records is read in blocks of lines.  A block's lines are in order, and
the depth at which a block starts is the sum over the blocks before it, one row for each block.
From the depth a line starts at, each of its commas is known to part two records or to lie within
one, and so the line knows the records its pieces belong to.

Files compressed with bzip2 are read in blocks as well.  What is written between the steps is
compressed.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackmill.session import durable, scratch_path

# The parts of a line of JSON, and what parts and ends its values.
STRING = r'"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"?+'
TOKEN = STRING + r'|[\[\]{},]|[^"\[\]{},]+'
# A value in brackets with up to seven more levels in it.
CLOSED = reduce(lambda inner, _: rf'[\[{{](?:[^"\[\]{{}}]++|{STRING}|{inner})*+[\]}}]', range(8), r"(?!)")
# A record with what parts it from the next; as CLOSED, with the text between two strings or brackets in one step.
BETWEEN = r'[^"\[\]{}]*+'
RECORD = reduce(lambda inner, _: rf"[\[{{]{BETWEEN}(?:(?:{STRING}|{inner}){BETWEEN})*+[\]}}]", range(8), r"(?!)")
WHOLE = rf"\A *+(\t*+{RECORD})[ \n]*+,?[ \n]*+\z"
# --- end of fixed values ---

BLOCK = ["_file", "_block"]


def _read(spark: SparkSession, path: str, files: list[str] | None = None, among: bool = True, **options: str) -> DataFrame:
    text = spark.read.options(**options).text(path)
    if files:
        named = F.col("_metadata.file_path").isin(files)
        text = text.where(named if among else ~named)  # leaves the other files unread
    return text.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"), "value",
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, the block of it that a task read, and their place in the block."""
    return _read(spark, path)


def _written(df: DataFrame, path: str) -> DataFrame:
    """Rows written once, compressed, over what is there; serial numbers among them stay as they are."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _opened(line: Column) -> Column:
    """Brackets that a line opens and does not close; those that it closes count against them."""
    bare = F.regexp_replace(line, STRING, "")
    return F.length(F.regexp_replace(bare, r"[^\[{]", "")) - F.length(F.regexp_replace(bare, r"[^\]}]", ""))


def _indents(lines: DataFrame) -> DataFrame:
    """For each file the blanks before its first record, where a line begins with it and is
    indented, and how many lines begin like that: one row per file."""
    indent = F.regexp_extract("value", r"^([ \t]+)\{", 1)
    begins = F.col("value").contains("{") & F.col("value").rlike(r"^[ \t]+\{")  # few lines hold a bracket
    places = lines.where(begins).groupBy("_file", indent.alias("_indent")).agg(
        F.min(F.struct("_block", "_line")).alias("_place"), F.count("*").alias("_begin")
    )
    return durable(places.groupBy("_file").agg(F.min(F.struct("_place", "_indent", "_begin")).alias("_first")).select(
        "_file", "_first._indent", "_first._begin"
    ))


def _tokens(text: Column, token: str) -> Column:
    return F.regexp_extract_all(text, F.lit(token), F.lit(0))


def _pieces(tokens: Column, depth: Column) -> Column:
    """The pieces of a text between commas at depth 1, without the array's own brackets."""
    none = F.array().cast("array<string>")
    start = F.struct(depth.cast("int").alias("depth"), F.lit("").alias("open"), none.alias("done"))

    def step(state: Column, token: Column) -> Column:
        deeper = F.when(token.isin("[", "{"), 1).when(token.isin("]", "}"), -1).otherwise(0)
        after = (state["depth"] + deeper).cast("int")
        parts = (token == ",") & (state["depth"] == 1)
        # The array's own brackets lie between depths 0 and 1.
        own = (token.isin("[") & (state["depth"] == 0)) | (token.isin("]") & (state["depth"] == 1))
        text = F.when(own, state["open"]).otherwise(F.concat(state["open"], token))
        return F.struct(
            after.alias("depth"), F.when(parts, F.lit("")).otherwise(text).alias("open"),
            F.when(parts, F.concat(state["done"], F.array(state["open"]))).otherwise(state["done"]).alias("done"),
        )

    return F.aggregate(tokens, start, step, lambda state: F.concat(state["done"], F.array(state["open"])))


def _clean(text: Column) -> Column:
    """A record's text without blank lines."""
    return F.trim(F.array_join(F.filter(F.split(text, "\n"), lambda line: F.trim(line) != ""), "\n"))


def _indented_records(text: DataFrame, indents: DataFrame, indent: str, scratch: str) -> DataFrame:
    """The records of files that indent them, from the parts between the lines that begin one."""
    # Lines may also end in a carriage return, which parts no text yet.
    split = F.split(F.regexp_replace("value", "\r\n?", "\n"), rf"\n{indent}\{{")
    split = F.when(F.col("value").contains("\r"), split).otherwise(F.array("value"))
    begin = F.lit(indent + "{")
    parts = _written(text.select(*BLOCK, "_line", F.posexplode(split).alias("_at", "_part")).withColumn(
        "_begins", F.col("_part").startswith(begin)
    ), scratch)
    place = F.struct("_block", "_line", "_at")
    heads = parts.groupBy("_file").agg(F.min(F.struct(place.alias("_head"), "_begins")).alias("_first"), F.count("*").alias("_n"))
    heads = durable(heads.select("_file", "_first._head", "_first._begins", "_n"))
    # Before its first record a file has its array's bracket, unless it begins with the record.
    # One row per file; without the hint all parts are dealt by file before that is known.
    found = parts.join(F.broadcast(heads.select("_file", "_head")), "_file").select("_file", "_part", "_begins", (place != F.col("_head")).alias("_cut"))
    texts = found.select(
        "_file", F.when(F.col("_cut"), F.concat(begin, "_part")).otherwise(F.col("_part")).alias("_text"),
        (F.col("_cut") | F.col("_begins")).alias("_begun"),
    )
    # Most parts are a record and a comma: one look at the text, and its pieces are known.
    texts = texts.withColumn("_whole", F.when(F.col("_begun"), F.regexp_extract("_text", WHOLE, 1)).otherwise(""))
    closed = F.when(F.col("_whole") == "", _tokens(F.col("_text"), f"{CLOSED}|{TOKEN}"))
    texts = texts.withColumn("_closed", closed)
    # From depth 1 on, a value in brackets is one token where no bracket is left that closes more.
    plain = F.col("_begun") & ~F.arrays_overlap("_closed", F.array(F.lit("]"), F.lit("}")))
    tokens = F.when(plain, F.col("_closed")).otherwise(_tokens(F.col("_text"), TOKEN))
    pieces = F.transform(_pieces(tokens, F.col("_begun").cast("int")), _clean)
    blank = F.col("_whole").contains("\n\n") | F.col("_whole").contains(" \n")
    whole = F.array(F.when(blank, _clean(F.col("_whole"))).otherwise(F.col("_whole")))
    found = texts.select("_file", F.explode(F.when(F.col("_whole") != "", whole).otherwise(pieces)).alias("raw_json"))
    # A file that ends where a record begins has no part behind that.
    begun = F.col("_n") - 1 + F.col("_begins").cast("int")
    ended = heads.join(indents, "_file").where(F.col("_begin") > begun).select("_file", _clean(begin).alias("raw_json"))
    records = found.unionAll(ended).select(F.col("_file").alias("file"), "raw_json")
    return records.where(F.col("raw_json") != "")


def split_arrays(lines: DataFrame, scratch: str | None = None) -> DataFrame:
    """The records of the arrays as ``raw_json`` with their ``file``, by depth alone; ``lines`` as
    from :func:`read_lines`.  Text that is no part of an array's records is one more record, which
    then fails to parse."""
    scratch = scratch or scratch_path(lines.sparkSession, "array-lines")
    marked = _written(lines.select(*BLOCK, "_line", "value", _opened(F.col("value")).alias("_opened")), f"{scratch}/marked")
    above = W.partitionBy(*BLOCK).orderBy("_line").rowsBetween(W.unboundedPreceding, -1)
    earlier = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = marked.groupBy(*BLOCK).agg(F.sum("_opened").alias("_sum"))
    starts = starts.select(*BLOCK, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_depth_before"))
    placed = marked.withColumn("_above", F.coalesce(F.sum("_opened").over(above), F.lit(0)))
    cut = _written(placed.join(starts, BLOCK).select(
        *BLOCK, "_line", _pieces(_tokens(F.col("value"), TOKEN), F.col("_depth_before") + F.col("_above")).alias("_pieces")
    ), f"{scratch}/cut")
    # A record's number: commas before it, summed like depths.
    commas = cut.groupBy(*BLOCK).agg(F.sum(F.size("_pieces") - 1).alias("_commas"))
    commas = commas.select(*BLOCK, F.coalesce(F.sum("_commas").over(earlier), F.lit(0)).alias("_commas_before"))
    numbered = cut.withColumn("_own", F.coalesce(F.sum(F.size("_pieces") - 1).over(above), F.lit(0))).join(commas, BLOCK)
    pieces = numbered.select(
        *BLOCK, "_line", (F.col("_own") + F.col("_commas_before")).alias("_first"),
        F.posexplode("_pieces").alias("_at", "_piece"),
    )
    texts = F.sort_array(F.collect_list(F.struct("_block", "_line", "_at", "_piece")))
    records = pieces.where(F.trim(F.col("_piece")) != "").groupBy(
        "_file", (F.col("_first") + F.col("_at")).alias("_comma")
    ).agg(F.array_join(F.transform(texts, lambda piece: piece["_piece"]), "\n").alias("raw_json"))
    return records.select(F.col("_file").alias("file"), F.trim("raw_json").alias("raw_json"))


def read_arrays(spark: SparkSession, path: str, block_bytes: int | None = None, scratch: str | None = None) -> DataFrame:
    """The records of pretty-printed arrays, one array per file, as ``raw_json``.

    Files that are uncompressed or compressed with bzip2 are read in blocks of ``block_bytes``, by default of
    the session's ``spark.sql.files.maxPartitionBytes``, each by a task.  A missing path gives no rows.
    What is written between the steps goes to ``scratch``, by default a fresh path; a reader that names the same
    one again overwrites it, and must be done with the records of before.
    """
    try:
        lines = read_lines(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "raw_json string")
    scratch = scratch or scratch_path(spark, "array-parts")
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    try:
        if block_bytes:
            spark.conf.set(name, str(block_bytes))
        indents = _indents(lines)
        # The driver gets the names of the files, which it also lists to read them.
        groups = indents.groupBy("_indent").agg(F.collect_list("_file").alias("files")).collect()
        # The files are read and their parts written here.
        found = [
            _indented_records(_read(spark, path, files, lineSep=f"\n{indent}{{"), indents, indent, f"{scratch}/parts-{n}")
            for n, (indent, files) in enumerate(groups)
        ]
        indented = list(chain.from_iterable(files for _, files in groups))
        if not found or len(lines.inputFiles()) > len(indented):
            found.append(split_arrays(_read(spark, path, indented, False), f"{scratch}/lines"))
    finally:
        spark.conf.set(name, before)
    return reduce(DataFrame.unionAll, (records.select("raw_json") for records in found))
