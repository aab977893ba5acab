"""Near-duplicate documents by SimHash with a byte-position inverted index.

A fingerprint has 64 bits over the hashed word shingles of a text. Two fingerprints that differ in at most 3
bits differ in at most 3 of 8 bytes, so they share at least 5 positional bytes. The inverted index lists
fingerprints under their positional bytes; the lists of each 5 of the 8 positions are intersected, which
retains exactly the pairs that reach this minimum count. Pairs inside a list are verified by tallying the
shared bytes and the differing bits. A list holds distinct fingerprints that agree in 40 bits, so it has at
most 2**24 members whatever the number of documents; a list is worked on in blocks, and a long one by looking
up the neighbours within 3 bits of its members, never by all its pairs.

Copies share a fingerprint and enter the index once. A list gives each member only a link to the first
member that it reaches inside the list, so links are as many as members. Components of the links are found
by alternating large and small stars; rounds are written to the shared folder.

Defined results: fewer words than a shingle: the whole sequence is one shingle; no word or a null text: the
fingerprint is zero and linked like any other. The component is named by the smallest id in it; a null id
is never the name unless all are null. Repeated rows and ids stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.blocks import text_blocks
from tidegate.llm.stages import stored
from tidegate.llm.words import ascii_words

SHINGLE = 3
SEED = 42
MOST_BITS = 3
MOST_PAIRWISE = 1024  # longer lists are searched by neighbours
BLOCK_BYTES = 4_000_000
_HASHES_AT_ONCE = 1 << 16
_MASKS = [sum(255 << (8 * p) for p in chosen) for chosen in combinations(range(8), 8 - MOST_BITS)]


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the words with A-Z in lower case."""
    words = ascii_words(text.encode().lower()) if text is not None else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    starts, ends = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _HASHES_AT_ONCE):
        part = zip(starts[at : at + _HASHES_AT_ONCE], ends[at : at + _HASHES_AT_ONCE], strict=True)
        hashes = np.array([digest(line[a:b], SEED) for a, b in part], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, bits): the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, BLOCK_BYTES):
            bits = np.array([fingerprint(x, shingle) for x in block.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(bits.view(np.int64))], ["doc_id", "bits"])

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, bits long")


def _lead(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n members the first member it is connected with by the links left - right."""
    lead = np.arange(n)
    while True:
        least = np.minimum(lead[left], lead[right])
        new = lead.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        np.minimum.at(new, lead, new)
        new = new[new]
        if (new == lead).all():
            return lead
        lead = new


def list_links(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of distinct fingerprints in one list: links from members to the first member they reach."""
    members = np.sort(members)
    left, right = [], []
    if len(members) <= MOST_PAIRWISE:
        for at in range(0, len(members), 256):
            differ = members[at : at + 256, None] ^ members[None, :]
            shared = (differ.view(np.uint8).reshape(*differ.shape, 8) == 0).sum(axis=2)
            close = (shared >= 8 - MOST_BITS) & (np.bitwise_count(differ) <= MOST_BITS)
            i, j = np.nonzero(close)
            left.append(i[i + at < j] + at)
            right.append(j[i + at < j])
    else:
        free = [k for k in range(64) if len(np.unique((members >> np.uint64(k)) & np.uint64(1))) > 1]
        for n in range(1, MOST_BITS + 1):
            for chosen in combinations(free, n):
                near = members ^ np.uint64(sum(1 << k for k in chosen))
                at = np.minimum(np.searchsorted(members, near), len(members) - 1)
                i = np.flatnonzero((members[at] == near) & (near > members))
                left.append(i)
                right.append(at[i])
    lead = _lead(len(members), np.concatenate(left), np.concatenate(right))
    linked = lead != np.arange(len(members))
    return members[linked], members[lead[linked]]


def links(prints: DataFrame) -> DataFrame:
    """(a, b): links between the distinct fingerprints `bits` of `prints`, enough to connect each component."""
    keys = F.array(*[F.xxhash64(F.lit(k), F.col("bits").bitwiseAND(_signed(mask))) for k, mask in enumerate(_MASKS)])
    lists = prints.select("bits", F.explode(keys).alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, np.zeros(0, np.uint64)
        for batch in batches:
            keys = batch.column("key").to_numpy()
            bits = batch.column("bits").to_numpy().view(np.uint64)
            if not len(keys):
                continue
            edges = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
            if key is not None and keys[0] == key:
                bits = np.concatenate([held, bits])
                edges[1:] += len(held)
            elif len(held) > 1:
                yield _batch(list_links(held))
            several = np.flatnonzero(np.diff(edges[:-1]) > 1)
            found = [list_links(bits[edges[i] : edges[i + 1]]) for i in several.tolist()]
            if found:
                yield _batch(tuple(map(np.concatenate, zip(*found, strict=True))))
            key, held = keys[-1], bits[edges[-2] :].copy()
        if len(held) > 1:
            yield _batch(list_links(held))

    sorted_lists = lists.repartition("key").sortWithinPartitions("key")
    return sorted_lists.mapInArrow(run, "a long, b long").distinct()


def _signed(mask: int):
    return F.lit(mask - (1 << 64) if mask >> 63 else mask)


def _batch(pair: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in pair], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of the undirected links (a, b): the root is the least node of the component.

    Large and small stars take turns until nothing changes. A node's least neighbour is aggregated before
    the shuffle and joined back, so a node with very many links is not gathered in one task.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    prints = stored(fingerprints(documents, doc_id, text, shingle), "fingerprints")
    classes = prints.groupBy("bits").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(classes.select("bits"))).select(F.col("node").alias("bits"), "root")
    linked = classes.join(roots, "bits", "left").select("bits", "first_id", F.coalesce("root", "bits").alias("root"))
    named = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_print = linked.join(named, "root").select("bits", "component_id")
    return prints.join(by_print, "bits").select(
        "doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id"
    )
