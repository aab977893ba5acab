"""Exact substring dedup over windows of words by super-k-mer partitioning.

A window is `window` consecutive words. Its minimiser is the smallest hash among its runs of `core` words,
so equal windows have equal minimisers and meet in one bucket. Consecutive windows of a document that share
a minimiser travel together as one packed string, a super-k-mer. In its bucket the windows are sorted, equal
ones are compared byte by byte, and all but the earliest are marked. A document loses each word that a
marked window covers.

Before anything travels, windows that repeat inside a block of documents are marked at once and only the
earliest goes on, so a passage that a third of all documents share is sent once per block. The strings of a
block for one bucket are compressed together. A minimiser with very many different windows would fill one
bucket; those that hold more than their share in a bounded sample of documents are left out of use, and their
windows go by their own hash, one by one, so they spread over all buckets and equal ones still meet.

Defined results: a null or empty text has no word and stays as it is; a text shorter than a window loses
nothing. Documents are ordered by id, a null id first. Rows that repeat an id count as the same document:
windows at the same place of it are not earlier than each other, so exact repeats of a row lose only what
the row itself would lose. Other columns pass through `remove_repeats` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.blocks import give_back, text_blocks
from tidegate.llm.stages import stored
from tidegate.llm.words import Words, ascii_words, flat_words, joined_words, prefix_hashes, run_hashes

WINDOW = 20
CORE = 4
BLOCK_BYTES = 4_000_000
SECTIONS = 8  # of a bucket, by minimiser; one is sorted at a time
SAMPLE_DOCS = 2000  # bound of the sample in which hot minimisers are looked for
LEAST_SHARE = 1e-5  # of all windows; what the sample can tell, and the bound of the list (1 / LEAST_SHARE)
LEVEL = 9  # of compression
_FIRST = np.iinfo(np.int64).min  # place of a null id in the order of ids

_PACKED = "bucket int, ids binary, versions binary, starts binary, cuts binary, text binary"
_MARKS = "doc_id long, version long, start int, n int"


def _first_equal(order: np.ndarray, hashes: np.ndarray, data: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each window the first window, in the present order, with the same bytes; itself if there is none.

    `order` sorts the hashes stably. Windows of equal hash and different bytes are told apart.
    """
    first = np.arange(len(order))
    if not len(order):
        return first
    ranked = hashes[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    lead = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    first[order] = lead
    text = data.tobytes()
    clash: dict[bytes, int] = {}
    for i in np.flatnonzero(first != np.arange(len(first))).tolist():
        j = first[i]
        own = text[low[i] : high[i]]
        if own != text[low[j] : high[j]]:
            first[i] = clash.setdefault(own, i)
    return first


def _runs(starts: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of consecutive numbers begin, and their lengths; `same` is False where a run must end."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = np.flatnonzero(np.concatenate([[True], (starts[1:] != starts[:-1] + 1) | ~same]))
    return begin, np.diff(np.concatenate([begin, [len(starts)]]))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def _minimisers(upto: np.ndarray, at: np.ndarray, window: int, core: int) -> np.ndarray:
    """The smallest hash of a run of `core` words in each window that starts at `at`."""
    cores = np.arange(max(len(upto) - core, 0))
    return _least(run_hashes(upto, cores, core), window - core + 1)[at]


def _window_starts(words: Words, window: int) -> np.ndarray:
    """First words of all windows; a window stays inside its text."""
    at = np.arange(max(len(words.begin) - window + 1, 0))
    return at[words.text[at] == words.text[at + window - 1]]


def _pack(block: pa.RecordBatch, window: int, core: int, buckets: int, hot: np.ndarray) -> pa.RecordBatch:
    """Super-k-mers of one block by bucket, and the marks of what repeats inside it (a row without text)."""
    ids = block.column("doc_id").fill_null(_FIRST).to_numpy()
    by_id = np.argsort(ids, kind="stable")
    texts = block.column("text").to_pylist()
    words = flat_words(ascii_words(texts[i]) for i in by_id)
    ids, versions = ids[by_id], block.column("version").to_numpy()[by_id]
    upto = prefix_hashes(words)
    at = _window_starts(words, window)
    low, high = words.begin[at], words.end[at + window - 1]
    hashes = run_hashes(upto, at, window)
    doc, start = words.text[at], at - words.first[words.text[at]]
    first = _first_equal(np.argsort(hashes, kind="stable"), hashes, words.data, low, high)
    repeated = (first != np.arange(len(first))) & ((ids[doc] != ids[doc[first]]) | (start != start[first]))
    rows: list[tuple] = []

    def add(bucket: int, who: np.ndarray, where: np.ndarray, cuts: np.ndarray, text: bytes) -> None:
        rows.append((bucket, *[x.tobytes() for x in (ids[who], versions[who], where.astype(np.int32), cuts.astype(np.int32))], text))

    marked = np.flatnonzero(repeated)
    begin, length = _runs(at[marked], doc[marked][1:] == doc[marked][:-1])
    if len(begin):
        # Any bucket will do; no text tells that these are marks.
        add(int(hashes[marked[0]] % np.uint64(buckets)), doc[marked][begin], start[marked][begin], length, b"")
    least = _minimisers(upto, at, window, core)
    if len(hot):
        least = np.where(np.isin(least, hot), hashes, least)
    sent = np.flatnonzero(~repeated)
    begin, length = _runs(at[sent], (least[sent][1:] == least[sent][:-1]) & (doc[sent][1:] == doc[sent][:-1]))
    lead = sent[begin]
    ends = high[sent[begin + length - 1]] if len(begin) else begin
    bucket = (least[lead] % np.uint64(buckets)).astype(np.int64)
    section = (least[lead] // np.uint64(buckets) % np.uint64(SECTIONS)).astype(np.int64)
    text, packer = words.data.tobytes(), zstandard.ZstdCompressor(level=LEVEL)
    order = np.lexsort((section, bucket))
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
        strings = b"\n".join([text[low[lead[i]] : ends[i]] for i in part.tolist()]) + b"\n"
        cuts = np.searchsorted(section[part], np.arange(SECTIONS + 1))
        add(int(bucket[part[0]]), doc[lead[part]], start[lead[part]], cuts, packer.compress(strings))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], pa.int32() if k == 0 else pa.binary()) for k in range(6)],
        ["bucket", "ids", "versions", "starts", "cuts", "text"],
    )


def _mark_batch(ids: np.ndarray, versions: np.ndarray, starts: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64(), mask=ids == _FIRST),
            pa.array(versions, pa.int64()),
            pa.array(starts.astype(np.int32), pa.int32()),
            pa.array(n.astype(np.int32), pa.int32()),
        ],
        ["doc_id", "version", "start", "n"],
    )


class _Packed(NamedTuple):
    """The super-k-mers of one block for one bucket; `cuts` bounds the sections among them, `edges` in the text."""

    ids: np.ndarray
    versions: np.ndarray
    starts: np.ndarray
    cuts: np.ndarray
    edges: np.ndarray
    text: bytes  # one string a line


def _sort_section(parts: list[_Packed], section: int, window: int) -> pa.RecordBatch:
    """Marks of the windows of one section of a bucket that are not the earliest of their kind."""
    spans = [slice(p.cuts[section], p.cuts[section + 1]) for p in parts]
    ids, versions, starts = (np.concatenate([p[k][s] for p, s in zip(parts, spans, strict=True)]) for k in range(3))
    strings = [x for p in parts for x in p.text[p.edges[section] : p.edges[section + 1]].split(b"\n")[:-1]]
    order = np.lexsort((starts, ids))
    ids, versions, starts = ids[order], versions[order], starts[order]
    words = joined_words([strings[i] for i in order.tolist()])
    del strings
    at = _window_starts(words, window)
    low, high = words.begin[at], words.end[at + window - 1]
    hashes = run_hashes(prefix_hashes(words), at, window)
    string = words.text[at]
    start = starts[string] + at - words.first[string]
    first = _first_equal(np.argsort(hashes, kind="stable"), hashes, words.data, low, high)
    marked = np.flatnonzero((ids[string] != ids[string[first]]) | (start != start[first]))
    begin, length = _runs(at[marked], string[marked][1:] == string[marked][:-1])
    who = string[marked][begin]
    return _mark_batch(ids[who], versions[who], start[marked][begin], length)


def _sort_bucket(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Marks of one bucket, from what all blocks sent to it.

    Its strings are kept as they came, block by block, and only those of one section are taken apart at a time.
    """
    give_back()
    unpacker = zstandard.ZstdDecompressor()
    parts: list[_Packed] = []
    for batch in batches:
        for i in range(batch.num_rows):
            numbers = [
                np.frombuffer(batch.column(name)[i].as_py(), kind)
                for name, kind in (("ids", "i8"), ("versions", "i8"), ("starts", "i4"), ("cuts", "i4"))
            ]
            packed = batch.column("text")[i].as_buffer()
            if packed.size:
                text = unpacker.decompress(packed)
                lines = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
                parts.append(_Packed(*numbers, np.concatenate([[0], lines])[numbers[3]], text))
            else:
                yield _mark_batch(*numbers)
        batch = packed = None  # else the last one stays while the sections are sorted
    for section in range(SECTIONS) if parts else ():
        yield _sort_section(parts, section, window)
    parts.clear()
    give_back()


def hot_minimisers(rows: DataFrame, window: int, core: int, share: float) -> np.ndarray:
    """Minimisers of more than `share` of the different windows in about SAMPLE_DOCS of the documents."""
    total = max(rows.select("doc_id").count(), 1)
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / float(1 << 20)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, BLOCK_BYTES):
            words = flat_words(ascii_words(text) for text in block.column("text").to_pylist())
            upto, at = prefix_hashes(words), _window_starts(words, window)
            _, once = np.unique(run_hashes(upto, at, window), return_index=True)
            least, n = np.unique(_minimisers(upto, at[once], window, core), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(least.view(np.int64)), pa.array(n.astype(np.int64))], ["m", "n"])

    counted = rows.where(place <= SAMPLE_DOCS / total).mapInArrow(count, "m long, n long")
    counted = stored(counted.groupBy("m").agg(F.sum("n").alias("n")), "minimisers")
    bound = share * (counted.agg(F.sum("n")).first()[0] or 0)
    found = [row.m for row in counted.where(F.col("n") > bound).select("m").collect()]
    return np.sort(np.array(found, np.int64).view(np.uint64))


def repeated_windows(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    core: int = CORE,
    hot_share: float | None = None,
) -> DataFrame:
    """(doc_id, version, start, n): windows start, start + 1, ... (n of them) that also start earlier.

    `version` is a hash of the text, for ids that occur with several texts. A minimiser is hot above
    `hot_share` of the windows, by default the mean share of a section.
    """
    spark = documents.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("version", F.xxhash64("text"))
    share = max(1 / (buckets * SECTIONS) if hot_share is None else hot_share, LEAST_SHARE)
    hot = spark.sparkContext.broadcast(hot_minimisers(rows, window, core, share))  # at most 1 / share numbers

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, BLOCK_BYTES):
            yield _pack(block, window, core, buckets, hot.value)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _sort_bucket(batches, window)

    packed = rows.mapInArrow(pack, _PACKED)
    return packed.repartitionById(buckets, F.col("bucket")).mapInArrow(sort, _MARKS)


def keep_words(words: list[bytes], marks: list[tuple[int, int]], window: int) -> list[bytes]:
    """The words that no marked window covers; marks are (first window, number of windows)."""
    if not marks:
        return words
    edge = np.zeros(len(words) + 1, np.int32)
    for start, n in marks:
        edge[start] += 1
        edge[start + n + window - 1] -= 1
    covered = np.cumsum(edge[:-1])
    return [words[i] for i in np.flatnonzero(covered == 0).tolist()]


def remove_repeats(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    core: int = CORE,
    hot_share: float | None = None,
) -> DataFrame:
    """All rows and columns; in `text` the kept words joined by one space, plus `n_words` and `n_removed`.

    A text that loses no word is left as it is.
    """
    # Inside, the other columns travel as one, so that no name of theirs can clash.
    others = [name for name in documents.columns if name not in (doc_id, text, "n_words", "n_removed")]
    rows = documents.select(
        F.col(f"`{doc_id}`").alias("id"),
        F.col(f"`{text}`").cast("string").alias("text"),
        F.struct(F.lit(None).cast("int").alias("_"), *[F.col(f"`{name}`") for name in others]).alias("others"),
    )
    marks = repeated_windows(rows, "id", "text", window, core, hot_share)
    marks = marks.groupBy("doc_id", "version").agg(F.collect_list(F.struct("start", "n")).alias("marks"))
    same = F.col("id").cast("long").eqNullSafe(F.col("doc_id")) & (F.xxhash64("text") == F.col("version"))
    joined = rows.join(marks, same, "left").select("id", "text", "others", "marks")
    schema = T.StructType(
        [*joined.schema.fields[:3], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    )

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, BLOCK_BYTES):
            texts, counts, gone = [], [], []
            for value, found in zip(block.column("text").to_pylist(), block.column("marks").to_pylist(), strict=True):
                words = ascii_words(value)
                kept = keep_words(words, [(m["start"], m["n"]) for m in found or ()], window)
                texts.append(b" ".join(kept).decode() if len(kept) < len(words) else value)
                counts.append(len(words))
                gone.append(len(words) - len(kept))
            columns = [block.column("id"), pa.array(texts, pa.string()), block.column("others")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(gone, pa.int64())], schema.fieldNames())

    names = {doc_id: F.col("id"), text: F.col("text")} | {name: F.col("others")[name] for name in others}
    order = [name for name in documents.columns if name in names]
    return joined.mapInArrow(clean, schema).select(*[names[name].alias(name) for name in order], "n_words", "n_removed")
