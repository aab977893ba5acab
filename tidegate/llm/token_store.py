"""Token ids in bit-packed blocks.

File format: Parquet files are the container, one row per block of whole documents in ascending order of
their ids. A block has
  part, block      place of the block: files in order, blocks of a file in order
  doc_ids          ids of its documents, ascending
  offsets          where each document's token ids start inside the block, the end included
  ids_before       token ids of the file before this block
  width            bits of each token id, the least that hold the vocabulary
  payload          the token ids, least significant bit first, without gaps
`first_doc` and `last_doc` repeat the range of ids as columns with statistics, so a reader asks only for the
blocks it needs, and `offsets` tell it which bits to unpack. Spark's writer commits the files, so a lost
executor leaves none half written.

Defined results: a null or empty text has no token of its own, only the end id. A null id comes first.
Rows that repeat an id follow each other, ordered by their text. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.blocks import text_blocks
from tidegate.llm.encoders import WordEncoder
from tidegate.session import workspace

BLOCK_BYTES = 2_000_000  # of text

FILE_SCHEMA = (
    "part int, block int, first_doc long, last_doc long, doc_ids array<long>, offsets array<int>, ids_before long, "
    "width int, payload binary"
)
_FIRST = np.iinfo(np.int64).min


def width_of(vocabulary: int) -> int:
    """Bits that hold the ids 0 to vocabulary - 1."""
    return max(1, (max(vocabulary, 1) - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Fixed-width packing, least significant bit first."""
    ids = np.ascontiguousarray(ids, "<u4")
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def unpack(payload: bytes, width: int, start: int, end: int) -> np.ndarray:
    """The ids start to end - 1; only their bytes are looked at."""
    if end <= start:
        return np.zeros(0, np.uint32)
    if width in (8, 16, 32):
        size = width // 8
        return np.frombuffer(payload, f"<u{size}", end - start, start * size).astype(np.uint32)
    first = start * width // 8
    part = np.frombuffer(payload, np.uint8, -(-end * width // 8) - first, first)
    bits = np.unpackbits(part, bitorder="little")[start * width - first * 8 :][: (end - start) * width]
    whole = np.zeros((end - start, 32), np.uint8)
    whole[:, :width] = bits.reshape(-1, width)
    return np.packbits(whole, axis=1, bitorder="little").view("<u4").reshape(-1)


def write_tokens(
    documents: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 0, path: str | None = None
) -> str:
    """Encode every document with the tokenizer file, append `end_id`, and write blocks in order of the ids.

    Returns the folder; a new one in the shared folder if `path` is None.
    """
    from pyspark import TaskContext

    spark = documents.sparkSession
    path = path or workspace(spark, "tokens")
    encoder = WordEncoder(tokenizer)
    width = width_of(encoder.vocabulary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for number, block in enumerate(text_blocks(batches, BLOCK_BYTES)):
            lists = encoder.encode(block.column("text"), end_id)
            offsets = np.cumsum([0, *map(len, lists)])
            ids = block.column("doc_id")
            edge = ids.drop_null()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([edge[0].as_py() if len(edge) else None], pa.int64()),
                    pa.array([edge[-1].as_py() if len(edge) else None], pa.int64()),
                    pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                    pa.array([offsets.astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([before], pa.int64()),
                    pa.array([width], pa.int32()),
                    pa.array([pack(np.concatenate(lists), width)], pa.binary()),
                ],
                ["part", "block", "first_doc", "last_doc", "doc_ids", "offsets", "ids_before", "width", "payload"],
            )
            before += int(offsets[-1])

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(run, FILE_SCHEMA).write.option("compression", "zstd").parquet(path)
    return path


def read_blocks(spark, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def document_spans(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored document; start counts the ids of all before it."""
    blocks = read_blocks(spark, path)
    # One number per file, so what is sorted and sent to all tasks is as large as the list of files.
    totals = blocks.groupBy("part").agg(F.sum(F.element_at("offsets", -1).cast("long")).alias("n")).collect()
    before, base = 0, {}
    for row in sorted(totals):
        base[row.part] = before
        before += row.n
    shared = spark.sparkContext.broadcast(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                offsets = row["offsets"]
                sums = []
                for start, end in zip(offsets, offsets[1:], strict=False):
                    sums.append(zlib.crc32(unpack(row["payload"], row["width"], start, end).astype("<u4").tobytes()))
                at = np.array(offsets, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(at[:-1] + row["ids_before"] + shared.value[row["part"]], pa.int64()),
                        pa.array(np.diff(at), pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return blocks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(spark, path: str, doc_ids: list[int]) -> dict[int, np.ndarray]:
    """Token ids of single documents: reads the blocks whose range holds them and unpacks only their bits."""
    asked = F.lit(False)
    for i in doc_ids:
        asked = asked | ((F.col("first_doc") <= i) & (F.col("last_doc") >= i))
    out = {}
    for row in read_blocks(spark, path).where(asked).collect():
        for k, i in enumerate(row.doc_ids):
            if i in doc_ids:
                out[i] = unpack(row.payload, row.width, row.offsets[k], row.offsets[k + 1])
    return out
