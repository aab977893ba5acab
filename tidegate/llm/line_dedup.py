"""Lines that many documents share, found with two Bloom filters and dropped.

A line's key is the line without white space at its ends and with A-Z in lower case. Each block of documents
gives the 64-bit hashes of its distinct keys; by ranges of hashes they pass through a filter of hashes seen once
into a filter of hashes seen twice. The second filter goes to all tasks: its size follows the number of lines up
to a fixed bound, beyond which more lines are suspected and nothing else changes. Lines it doesn't hold occur
in one document only and never move. The others are suspected repeats: per block and key one row with the
places goes to the count of the whole keys, compared as text, and the places of confirmed keys go back to their
documents. Nothing is decided by a hash but what is left out of the shuffle.

Defined results: a null or empty text is one empty line. Keys without a character are never dropped. Each row
is a document, also if it repeats another; the rows of one id and one text lose the same lines. A null id is
an id like others. Columns other than the id and the text are carried along, whatever their names, but those
that the result adds (n_lines, n_dropped) replace columns of these names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.blocks import text_blocks
from tidegate.llm.bloom import RANGES, Filter, ranges_of, seen_twice
from tidegate.llm.stages import stored

MIN_DOCUMENTS = 10
MIN_CHARS = 1
BLOCK_BYTES = 8_000_000
SUSPECTS = "key binary, n long, places array<struct<doc_id:long,mark:long,mark2:long,lines:array<int>>>"
_CONTINUED = bytes(range(128, 192))


def line_keys(text: bytes | None) -> list[bytes]:
    """The key of every line; bytes.strip takes away exactly U+0020 and U+0009 to U+000D."""
    return list(map(bytes.strip, text.lower().split(b"\n"))) if text else [b""]


def _long_enough(keys: set[bytes], least: int) -> set[bytes]:
    keys.discard(b"")
    return keys if least <= 1 else {k for k in keys if len(k.translate(None, _CONTINUED)) >= least}


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))


def line_hashes(rows: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(part, n, hashes, again) of each block and range: its distinct keys' hashes, and those of several documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, BLOCK_BYTES):
            keys: list[bytes] = []
            for text in block.column("text").to_pylist():
                keys += _long_enough(set(line_keys(text)), min_chars)
            hashes, counts = np.unique(_hashes(keys), return_counts=True)
            again = hashes[counts > 1]
            own, more = ranges_of(hashes), ranges_of(again)
            parts = np.flatnonzero(np.diff(own)).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(parts, pa.int32()),
                    pa.array([int(own[p + 1] - own[p]) for p in parts], pa.int64()),
                    pa.array([hashes[own[p] : own[p + 1]].tobytes() for p in parts], pa.binary()),
                    pa.array([again[more[p] : more[p + 1]].tobytes() for p in parts], pa.binary()),
                ],
                ["part", "n", "hashes", "again"],
            )

    return rows.select("text").mapInArrow(run, "part int, n long, hashes binary, again binary")


def suspects(rows: DataFrame, twice, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per block and key that the filter holds: the documents it stands in, and the lines. `twice` is a broadcast Filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = twice.value
        for block in text_blocks(batches, BLOCK_BYTES):
            texts = [line_keys(text) for text in block.column("text").to_pylist()]
            sets = [list(_long_enough(set(keys), min_chars)) for keys in texts]
            held = seen.holds(_hashes([k for keys in sets for k in keys]))
            places: dict[bytes, list[tuple[int, list[int]]]] = {}
            at = 0
            for i, own in enumerate(sets):
                marked = {own[j] for j in np.flatnonzero(held[at : at + len(own)]).tolist()}
                at += len(own)
                if marked:
                    lines: dict[bytes, list[int]] = {}
                    for number, key in enumerate(texts[i]):
                        if key in marked:
                            lines.setdefault(key, []).append(number)
                    for key, numbers in lines.items():
                        places.setdefault(key, []).append((i, numbers))
            if places:
                yield _suspect_rows(block, places)

    return rows.mapInArrow(run, SUSPECTS)


def _suspect_rows(block: pa.RecordBatch, places: dict[bytes, list[tuple[int, list[int]]]]) -> pa.RecordBatch:
    found = [x for own in places.values() for x in own]
    ends = np.cumsum([0, *(len(numbers) for _, numbers in found)]).astype(np.int32)
    lines = pa.ListArray.from_arrays(ends, pa.array([n for _, numbers in found for n in numbers], pa.int32()))
    docs = block.take(pa.array([i for i, _ in found], pa.int64()))
    whole = pa.StructArray.from_arrays([docs.column("doc_id"), docs.column("mark"), docs.column("mark2"), lines], ["doc_id", "mark", "mark2", "lines"])
    counts = [len(own) for own in places.values()]
    listed = pa.ListArray.from_arrays(np.cumsum([0, *counts]).astype(np.int32), whole)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(places), pa.binary()), pa.array(counts, pa.int64()), listed], ["key", "n", "places"]
    )


def shared_lines(rows: DataFrame, min_documents: int, min_chars: int, keep_first: bool) -> DataFrame:
    """(doc_id, mark, mark2, lines): the numbers of the lines to drop, of every text that has any."""
    spark = rows.sparkSession
    blocks = stored(line_hashes(rows, min_chars), "line_hashes")
    count = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    shared = spark.sparkContext.broadcast(Filter(seen_twice(blocks, count), count))
    found = stored(suspects(rows, shared, min_chars), "suspects")
    shared.unpersist()
    totals = [F.sum("n").alias("total")]
    if keep_first:
        firsts = F.transform("places", lambda p: F.struct(p["doc_id"], p["mark"], p["mark2"], p["lines"][0].alias("line")))
        totals.append(F.min(F.array_min(firsts)).alias("first"))
    confirmed = found.groupBy("key").agg(*totals).where(F.col("total") >= min_documents).drop("total")
    hits = found.join(confirmed, "key")
    if keep_first:
        own = lambda p: F.struct(p["doc_id"], p["mark"], p["mark2"]).eqNullSafe(F.struct("first.doc_id", "first.mark", "first.mark2"))
        later = lambda p: F.when(own(p), F.slice(p["lines"], F.lit(2), F.greatest(F.size(p["lines"]) - 1, F.lit(0)))).otherwise(p["lines"])
        hits = hits.withColumn("places", F.transform("places", lambda p: p.withField("lines", later(p))))
    # The rows of one text give equal lists, of which a set keeps one.
    listed = hits.select(F.inline("places")).groupBy("doc_id", "mark", "mark2").agg(F.flatten(F.collect_set("lines")).alias("lines"))
    return listed.where(F.size("lines") > 0)


def _marks(text: str) -> list[Column]:
    """128 bits of a text, which with the id say which rows a list of lines belongs to."""
    return [F.xxhash64(text).alias("mark"), F.xxhash64(F.lit(1), text).alias("mark2")]


def drop_shared_lines(
    documents: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    min_chars: int = MIN_CHARS,
    keep_first: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents without lines whose keys stand in at least `min_documents` documents; adds n_lines and n_dropped.

    All lines of such a key go; with `keep_first` its first line in the document with the smallest id stays.
    """
    if min_documents < 2:
        raise ValueError("lines of one document are not looked at: min_documents must be at least 2")
    slim = documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = slim.select("doc_id", *_marks("text"), F.col("text").cast("binary").alias("text"))
    drops = shared_lines(rows, min_documents, min_chars, keep_first).toDF("_id", "_mark", "_mark2", "_lines")

    added = {"n_lines", "n_dropped"}
    whole = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns if c not in added]).alias("_row"))
    own, content = F.col("_row")[doc_id].cast("long"), F.col("_row")[text].cast("string")
    marked = whole.select("_row", own.alias("_own"), *[m.alias(f"_{name}") for m, name in zip(_marks_of(content), ("own_mark", "own_mark2"), strict=True)])
    same = F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_own_mark") == F.col("_mark")) & (F.col("_own_mark2") == F.col("_mark2"))
    joined = marked.join(drops, same, "left")
    lines = F.split(F.coalesce(content, F.lit("")), "\n", -1)
    # A lambda holds the lines, so that they are split once per row; array_except hashes the numbers.
    left = F.transform(
        F.array(lines),
        lambda own: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(own) - 1), F.col("_lines")), lambda i: own[i]), "\n"),
    )[0]
    cleaned = F.when(F.col("_lines").isNull(), content).otherwise(left)
    return joined.select(
        *[(cleaned if c == text else F.col("_row")[c]).alias(c) for c in documents.columns if c not in added],
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def _marks_of(text: Column) -> list[Column]:
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


LINES_SQL = r"""
WITH split AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
keyed AS (
  SELECT doc_id, i, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split),
gone AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(g.key) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN g.key IS NULL THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM keyed LEFT JOIN gone g USING (key) GROUP BY doc_id"""
