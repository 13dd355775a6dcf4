"""Token files: the ids of whole documents in ascending order, packed with Simple-8b.

Documents are dealt to shards by ranges of their identifier and sorted inside; a shard's
task encodes them and packs them into blocks.  A block is one binary value:

* ``S8B1``, then the number of documents, of ids and of packed words (three u32);
* per document its identifier (i64, and a byte that says whether it has one) and the place
  of its first id in the block (u32);
* the packed words (u64).  All numbers are little-endian.

The places are what lets a reader decode a block at once and cut it into documents.  Files
are written by Spark, a Parquet file per shard with one block per row, so commits are atomic,
a lost task is simply repeated, and any store that Spark writes to will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trackmill.llm.common import small_batches
from trackmill.llm.simple8b import decode, encode
from trackmill.llm.subwords import VOCABULARY, worker_subwords
from trackmill.session import scratch_path

MAGIC = b"S8B1"
END_ID = 2
# A block is closed when it has this many ids; a document is never cut.
BLOCK_IDS = 1 << 16

BLOCKS = "shard int, block int, first_id long, n_ids long, payload binary"
TOKENS = "shard int, id long, first_id long, n_tokens long, ids_crc32 long"


def pack_block(identifiers: list[int | None], ids: list[np.ndarray]) -> bytes:
    lengths = np.array([len(own) for own in ids], np.int64)
    places = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype("<u4")
    words = encode(np.concatenate(ids) if ids else np.zeros(0, np.uint32)).astype("<u8")
    present = np.array([i is not None for i in identifiers], np.uint8)
    numbers = np.array([i or 0 for i in identifiers], "<i8")
    head = MAGIC + struct.pack("<III", len(ids), int(lengths.sum()), len(words))
    return head + numbers.tobytes() + present.tobytes() + places.tobytes() + words.tobytes()


def unpack_block(payload: bytes) -> tuple[list[int | None], list[np.ndarray]]:
    if payload[:4] != MAGIC:
        raise ValueError("not a block of packed ids")
    docs, total, n_words = struct.unpack_from("<III", payload, 4)
    at = 16
    numbers = np.frombuffer(payload, "<i8", docs, at)
    present = np.frombuffer(payload, np.uint8, docs, at + 8 * docs)
    places = np.frombuffer(payload, "<u4", docs, at + 9 * docs)
    ids = decode(np.frombuffer(payload, "<u8", n_words, at + 13 * docs)).astype("<u4")
    if len(ids) != total:
        raise ValueError("a block holds another number of ids than it says")
    identifiers = [int(n) if there else None for n, there in zip(numbers, present, strict=True)]
    return identifiers, np.split(ids, places[1:]) if docs else []


def _blocks(end_id: int, vocabulary: str):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        subwords = worker_subwords(vocabulary)
        end = np.array([end_id], "<u4").tobytes()
        held: list[int | None] = []
        ids: list[np.ndarray] = []
        size = 0

        def row() -> pa.RecordBatch:
            values = [[shard], [block], [first], [size], [pack_block(held, ids)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, kind) for v, kind in zip(values, kinds, strict=True)],
                names=["shard", "block", "first_id", "n_ids", "payload"],
            )

        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            for identifier, own in zip(batch.column(0).to_pylist(), subwords.encode(texts), strict=True):
                held.append(identifier)
                ids.append(np.frombuffer(own + end, "<u4"))
                size += len(ids[-1])
                if size >= BLOCK_IDS:
                    yield row()
                    block, first, size = block + 1, first + size, 0
                    held, ids = [], []
        if held:
            yield row()

    return pack


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for shard, first, payload in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            for identifier, ids in zip(*unpack_block(payload), strict=True):
                rows.append((shard, identifier, first, len(ids), zlib.crc32(ids.tobytes())))
                first += len(ids)
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        kinds = [pa.int32(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(v), kind) for v, kind in zip(columns, kinds, strict=True)],
            names=["shard", "id", "first_id", "n_tokens", "ids_crc32"],
        )


def write_token_files(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID, vocabulary: str = VOCABULARY,
) -> None:
    """Write the ids of all documents, absent identifiers first, then ascending.

    An absent text is empty and is its end id alone; equal identifiers stand in the order of
    their texts; an empty table writes no block.
    """
    spark = docs.sparkSession
    small_batches(spark)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    dealt = narrow.repartitionByRange("id").sortWithinPartitions("id", "text")
    dealt.mapInArrow(_blocks(end_id, vocabulary), BLOCKS).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document of written files: ``id``, ``start`` (ids of all documents before it),
    ``n_tokens`` with the end id, ``ids_crc32`` of its ids as unsigned 32-bit integers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 32)
    blocks = spark.read.schema(BLOCKS).parquet(path)
    # One row per shard, so their number is that of the files.
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("_ids"))
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("shard", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_start"))
    told = blocks.select("shard", "first_id", "payload").mapInArrow(_told, TOKENS)
    return told.join(F.broadcast(starts), "shard").select(
        "id", (F.col("_start") + F.col("first_id")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(
    docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID, vocabulary: str = VOCABULARY,
) -> DataFrame:
    """Write the token files, to a fresh folder of the shared store unless told otherwise,
    and read them back."""
    path = path or scratch_path(docs.sparkSession, "tokens")
    write_token_files(docs, path, id_col, text_col, end_id, vocabulary)
    return read_token_files(docs.sparkSession, path)
