"""Near copies by Jaccard similarity of word shingles: seeded SimHash fingerprints in a byte-position inverted index.

Texts at similarity 0.8 differ in about 10 of the 64 bits of a SimHash fingerprint, too many for the 5 of 8 positional
bytes that operator 6 asks for. So a text has SEEDS fingerprints, and candidates are texts that share SHARED positional
bytes of one of them: at similarity 0.8 a pair shares none with a chance of 4 in 1,000, and a closer pair with less. The
index lists the texts under their positional bytes; the lists of two positions are intersected inside a task. Candidates
whose fingerprints together differ in more than APART of all bits are dropped (at similarity 0.8 three and a half
standard deviations off); of the others the similarity is computed from the whole sets of shingles.

Texts with the same set of shingles are one node. Nodes that are close to another in some list enter the index again,
now with a parity of their set: bits that differ between two parities are never more than the shingles in which the sets
differ, so pairs that differ in too many are dropped inside the lists, and no pair of the similarity is. What is left is
nearly always similar; members of a group just below the similarity make no pairs. In an intersected list each node gets
pairs with the first FIRST_SOME such nodes before it. The first of these are verified first, the others only where they
could still join components. Of lists in which a node has FIRST_SOME of them and perhaps more, only a first pair of each
node is taken; they are kept, and at last all their close pairs of different components are verified. So all candidates that
could join components are compared, and members of a large group, which find a partner among the first, cost a few
comparisons each.

Defined results: fewer words than a shingle: the whole sequence is one shingle. Texts without a word, nulls
among them, are copies of each other. Rows without an id take no part and are not in the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.blocks import give_back, text_blocks
from tidegate.llm.simhash import components
from tidegate.llm.stages import stored
from tidegate.llm.words import ascii_words

SHINGLE = 5
SIMILARITY = 0.8
SEEDS, SHARED = 5, 2
APART = 0.225
FIRST_SOME = 16
SEED = 42
BLOCK_BYTES = 4_000_000
PAIRS_AT_ONCE = 1 << 18
LEAST_PARITY, MOST_PARITY = 64, 8192  # bits
_POSITIONS = 8  # bytes of a fingerprint
_HASHES_AT_ONCE = 1 << 12
_chance = np.random.default_rng(SEED)
_FLIPS = _chance.integers(0, 1 << 64, SEEDS, np.uint64)
_FACTORS = _chance.integers(0, 1 << 64, SEEDS, np.uint64) | np.uint64(1)


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles, with A-Z in lower case."""
    words = ascii_words(text.encode().lower()) if text is not None else []
    if not words:
        return np.zeros(0, np.uint64)
    k, digest = min(shingle, len(words)), xxhash.xxh64_intdigest
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - k + 1].tolist()
    spans = zip(starts, ends[k - 1 :].tolist(), strict=True)
    return np.unique(np.fromiter((digest(line[a:b], SEED) for a, b in spans), np.uint64, len(starts)))


def node_of(hashes: np.ndarray) -> int:
    """The name of a set of shingles, as a signed long."""
    name = xxhash.xxh64_intdigest(hashes.tobytes(), SEED)
    return name - (1 << 64) if name >> 63 else name


def sketch(hashes: np.ndarray) -> list[int]:
    """The positional bytes of the fingerprints of a set that isn't empty, each as 256 * place + byte."""
    ones = np.zeros(64 * SEEDS, np.int64)
    for at in range(0, len(hashes), _HASHES_AT_ONCE):
        mixed = (hashes[at : at + _HASHES_AT_ONCE, None] ^ _FLIPS) * _FACTORS
        for shift in (32, 29):
            mixed ^= mixed >> np.uint64(shift)
            mixed *= _FACTORS
        mixed ^= mixed >> np.uint64(32)
        ones += np.unpackbits(mixed.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    places = np.packbits(2 * ones > len(hashes), bitorder="little")
    return (np.arange(len(places)) * 256 + places).tolist()


def parity(hashes: np.ndarray) -> bytes:
    """In which of 2 to 4 buckets for each hash an odd number of the hashes is, as bits; at most MOST_PARITY buckets.

    Halves put on each other by exclusive or are the parity in half as many buckets.
    """
    buckets = min(max(1 << (2 * len(hashes)).bit_length(), LEAST_PARITY), MOST_PARITY)
    counts = np.bincount((hashes & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def parities(texts: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(node, size, parity) of the different sets of shingles of the column `text`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, BLOCK_BYTES):
            sets = [shingle_set(x, shingle) for x in block.column("text").to_pylist()]
            columns = [pa.array(map(node_of, sets), pa.int64()), pa.array(map(len, sets), pa.int64()), pa.array(map(parity, sets), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "size", "parity"])

    return texts.select("text").mapInArrow(run, "node long, size long, parity binary").dropDuplicates(["node"])


def sketches(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, node, keys) of every row; no keys if it has no word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, BLOCK_BYTES):
            sets = [shingle_set(x, shingle) for x in block.column("text").to_pylist()]
            made = [sketch(hashes) if len(hashes) else [] for hashes in sets]
            nodes = pa.array(map(node_of, sets), pa.int64())
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), nodes, pa.array(made, pa.list_(pa.int64()))], ["doc_id", "node", "keys"])

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.where("doc_id IS NOT NULL").mapInArrow(run, "doc_id long, node long, keys array<long>")


def _binary(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix of bytes as values."""
    edges = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(matrix), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(matrix))])


def _matrix(column: pa.Array) -> np.ndarray:
    """Values of equal length as the rows of a matrix of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _words(prints: np.ndarray) -> np.ndarray:
    """Rows of bytes as 64-bit numbers, filled up with zeros; one array for each."""
    filled = np.zeros((len(prints), -(-prints.shape[1] // 8) * 8), np.uint8)
    filled[:, : prints.shape[1]] = prints
    return np.ascontiguousarray(filled.view(np.uint64).T)


def _close(words: np.ndarray, left: np.ndarray, right: np.ndarray, most: float | np.ndarray) -> np.ndarray:
    """Which pairs of rows differ in at most `most` bits."""
    apart = np.zeros(len(left), np.uint16)
    for own in words:
        apart += np.bitwise_count(own[left] ^ own[right])
    return apart <= most


def _folded(column: pa.Array) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The length of each parity, and for each length where the parities that are so long or longer stand, and their words."""
    lengths = pc.binary_length(column).to_numpy()
    folded, rows, matrix = {}, np.zeros(0, np.int64), np.zeros((0, 0), np.uint8)
    for length in np.unique(lengths)[::-1].tolist():
        while matrix.shape[1] > length:
            matrix = matrix[:, : matrix.shape[1] // 2] ^ matrix[:, matrix.shape[1] // 2 :]
        own = np.flatnonzero(lengths == length)
        matrix = np.concatenate([matrix.reshape(-1, length), _matrix(column.take(pa.array(own)))])
        rows = np.concatenate([rows, own])
        place = np.zeros(len(lengths), np.int64)
        place[rows] = np.arange(len(rows))
        folded[length] = place, _words(matrix)
    return lengths, folded


def _nearness(batch: pa.RecordBatch, similarity: float) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function that tells which pairs of rows (left, right) are close: in their prints and, if there are any, their parities."""
    prints = _matrix(batch.column("prints"))
    words, most = _words(prints), APART * 8 * prints.shape[1]
    if "parity" not in batch.schema.names:
        return lambda left, right: _close(words, left, right, most)
    sizes = batch.column("size").to_numpy()
    lengths, folded = _folded(batch.column("parity"))

    def near(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        close = _close(words, left, right, most)
        at = np.flatnonzero(close)
        left, right = left[at], right[at]
        # Sets of the similarity differ in no more shingles than this; the last term is for rounding.
        differ = (sizes[left] + sizes[right]) * ((1 - similarity) / (1 + similarity)) + 1e-6
        good = np.abs(sizes[left] - sizes[right]) <= differ
        least = np.minimum(lengths[left], lengths[right])
        for length in np.unique(least).tolist():
            place, bits = folded[length]
            some = np.flatnonzero(good & (least == length))
            good[some] = _close(bits, place[left[some]], place[right[some]], differ[some])
        close[at] = good
        return close

    return near


def postings(nodes: DataFrame) -> DataFrame:
    """(key, node, prints): nodes (node, keys) under their positional bytes, but the last that starts no SHARED positions.

    Their columns size and parity come along.
    """
    more = [name for name in ("size", "parity") if name in nodes.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column("keys")), 0))
            if not batch.num_rows:
                continue
            keys = batch.column("keys").flatten().to_numpy().reshape(batch.num_rows, -1)
            prints = _binary((keys & 255).astype(np.uint8))
            for place in range(keys.shape[1]):
                if place % _POSITIONS <= min(keys.shape[1], _POSITIONS) - min(keys.shape[1], SHARED):
                    columns = [pa.array(keys[:, place].copy()), batch.column("node"), prints, *map(batch.column, more)]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "node", "prints", *more])
        give_back()

    schema = "key long, node long, prints binary" + (", size long, parity binary" if more else "")
    return nodes.select("node", "keys", *more).mapInArrow(run, schema)


def _whole_lists(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches that are sorted by `key`, cut so that no list is in two of them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        last = int(np.searchsorted(keys, keys[-1]))
        if held and (last or held[-1].column(key)[-1].as_py() != keys[-1]):
            yield pa.concat_batches([*held, batch.slice(0, last)])
            held = []
        elif not held and last:
            yield batch.slice(0, last)
        held.append(batch.slice(last))
    if held:
        yield pa.concat_batches(held)


def _lists(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The intersected lists of whole postings, sorted: (step, row, list) for each distance `step` of the two positions."""
    key, node, prints = batch.column("key").to_numpy(), batch.column("node").to_numpy(), _matrix(batch.column("prints"))
    width, place = prints.shape[1], key >> 8
    for step in range(1, _POSITIONS) if width > 1 else (0,):
        valid = np.flatnonzero(place % _POSITIONS + step < min(_POSITIONS, width))
        lists = (key[valid] * 256 + prints[valid, place[valid] + step]) * _POSITIONS + step
        order = np.lexsort((node[valid], lists))
        yield step, valid[order], lists[order]


def _first_shared(prints: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The second position of the first list that each pair of rows of a list shares; with one position, that."""
    width = prints.shape[1]
    found = np.full(len(left), -1 if width > 1 else 0)
    for at in range(width if len(left) else 0):
        if at % _POSITIONS == 0:
            shared = np.zeros(len(left), np.int64)
        shared += prints[left, at] == prints[right, at]
        found[(found < 0) & (shared == SHARED)] = at
    return found


def _first_close(
    lists: np.ndarray, near: Callable[[np.ndarray, np.ndarray], np.ndarray], some: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """In sorted lists each row's first `some` close rows before it: (row, that row, their number), and the rows of open lists.

    A list is open if a row had found so many before it was compared with all.
    """
    start = np.searchsorted(lists, lists)
    place, count, k = np.arange(len(lists)) - start, np.zeros(len(lists), np.int64), 0
    active, found, opened = np.flatnonzero(place > 0), [], np.zeros(len(lists), bool)
    while len(active):
        left = start[active] + k
        close = near(active, left)
        if close.any():
            hit = active[close]
            found.append((hit, left[close], count[hit]))
            count[hit] += 1
        k += 1
        more = place[active] > k
        full = count[active] >= some
        opened[start[active[more & full]]] = True
        active = active[more & ~full]
    pairs = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3
    return *pairs, np.flatnonzero(opened[start])


def partnered(listed: DataFrame) -> DataFrame:
    """(node): the nodes of the postings that are close to another node in some list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_lists(batches, "key"):
            node, near, found = batch.column("node").to_numpy(), _nearness(batch, 0), []
            for _, rows, lists in _lists(batch):
                of_rows = _of_rows(near, rows)
                right, left, _, members = _first_close(lists, of_rows, 1)
                found.append(rows[_have_close(lists, of_rows, right, left, members)])
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(node[np.concatenate(found)]))], ["node"])
        give_back()

    return listed.repartition("key").sortWithinPartitions("key").mapInArrow(run, "node long").distinct()


def _have_close(
    lists: np.ndarray, near: Callable[[np.ndarray, np.ndarray], np.ndarray], right: np.ndarray, left: np.ndarray, members: np.ndarray
) -> np.ndarray:
    """Which rows are close to another of their list, from the pairs and the rows of open lists that _first_close gave."""
    close = np.zeros(len(lists), bool)
    close[left] = close[right] = True
    # Rows without a close one before them can have one among those after them that stopped before.
    order = members[np.lexsort((~close[members], lists[members]))]
    late = _first_close(lists[order], _of_rows(near, order), 1)[0]
    close[order[late]] = True
    return close


def _of_rows(near: Callable[[np.ndarray, np.ndarray], np.ndarray], rows: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    return lambda left, right: near(rows[left], rows[right])


def candidates(listed: DataFrame, some: int, similarity: float = SIMILARITY) -> DataFrame:
    """Close pairs (a, b, number) of the postings, numbered for each b from 0 to `some` - 1; and open lists (list, a, prints).

    A list is open if a node in it has `some` close ones before it and perhaps more. Of open lists all nodes that are close
    to another are given, but for each b only one pair with number 0. A pair of other lists is given by the first it is in.

    If the postings have parities, only pairs that may reach the similarity are close, and open lists have the parities.
    """
    more = [name for name in ("size", "parity") if name in listed.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_lists(batches, "key"):
            node, near, found = batch.column("node").to_numpy(), _nearness(batch, similarity), []
            prints, place = _matrix(batch.column("prints")), batch.column("key").to_numpy() >> 8
            for step, rows, lists in _lists(batch):
                of_rows = _of_rows(near, rows)
                right, left, number, members = _first_close(lists, of_rows, some)
                close = _have_close(lists, of_rows, right, left, members)
                opened = np.zeros(len(rows), bool)
                opened[members] = True
                sent = opened[right] & (number == 0)
                closed = np.flatnonzero(~opened[right])
                sent[closed] = _first_shared(prints, rows[left[closed]], rows[right[closed]]) == place[rows[right[closed]]] + step
                left, right, number = left[sent], right[sent], number[sent]
                found.append((node[rows[left]], node[rows[right]], number, opened[right]))
                if len(members):
                    members = members[close[members]]
                    own = batch.select(["prints", *more]).take(pa.array(rows[members]))
                    yield _candidate_batch(node[rows[members]], lists=lists[members], own=own.columns, more=more)
            a, b, number, opened = map(np.concatenate, zip(*found, strict=True))
            # Open lists are worked through at the end, so of their pairs one for each b of the batch is enough.
            late = np.flatnonzero(opened)
            late = late[np.lexsort((a[late], b[late]))]
            first = np.ones(len(late), bool)
            first[1:] = b[late[1:]] != b[late[:-1]]
            sent = np.concatenate([np.flatnonzero(~opened), late[first]])
            a, b, number = a[sent], b[sent], number[sent]
            yield _candidate_batch(a, b, number, more=more)
        give_back()

    by_key = listed.repartition("key").sortWithinPartitions("key")
    schema = "a long, b long, number long, list long, prints binary" + (", size long, parity binary" if more else "")
    return by_key.mapInArrow(run, schema)


def _candidate_batch(
    a: np.ndarray,
    b: np.ndarray | None = None,
    number: np.ndarray | None = None,
    lists: np.ndarray | None = None,
    own: list[pa.Array] | None = None,
    more: list[str] | None = None,
) -> pa.RecordBatch:
    names = ["prints", *(more or [])]
    columns = [pa.nulls(len(a), pa.int64()) if x is None else pa.array(x, pa.int64()) for x in (a, b, number, lists)]
    columns += own or [pa.nulls(len(a), pa.int64() if name == "size" else pa.binary()) for name in names]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "number", "list", *names])


def _between(lists: DataFrame, similarity: float) -> DataFrame:
    """(a, b): the close pairs of different components in the lists (list, node, root, prints, size, parity)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_lists(batches, "list"):
            key, node, root = (batch.column(name).to_numpy() for name in ("list", "node", "root"))
            near = _nearness(batch, similarity)
            found, held = [], 0
            edges = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
            for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                own = root[begin:end]
                _, inverse, sizes = np.unique(own, return_inverse=True, return_counts=True)
                if len(sizes) == 1:
                    continue
                # The largest component is last, so that its members are only looked up, never compared with each other.
                order = np.lexsort((inverse, sizes[inverse]))
                rows, runs = order + begin, inverse[order]
                ends = np.append(np.flatnonzero(np.diff(runs)) + 1, len(runs))
                beyond = ends[np.searchsorted(ends, np.arange(len(runs)), side="right")]
                for i in np.flatnonzero(beyond < len(runs)).tolist():
                    right = np.arange(beyond[i], len(runs))
                    right = right[near(np.full(len(right), rows[i]), rows[right])]
                    x, y = np.full(len(right), node[rows[i]]), node[rows[right]]
                    found.append((np.minimum(x, y), np.maximum(x, y)))
                    held += len(right)
                    if held > PAIRS_AT_ONCE:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["a", "b"])
                        found, held = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["a", "b"])
        give_back()

    return lists.repartition("list").sortWithinPartitions("list").mapInArrow(run, "a long, b long").distinct()


def similar(pairs: DataFrame, texts: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b) of the `pairs` (a, a_id, b, b_id) of nodes whose sets reach the similarity; `texts` is (doc_id, text).

    Of an id with several texts only that of the node counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: dict[str | None, tuple[np.ndarray, int]] = {}
            good = []
            for a, b, x, y in zip(*[batch.column(name).to_pylist() for name in ("a", "b", "a_text", "b_text")], strict=True):
                for t in (x, y):
                    if t not in sets:
                        hashes = shingle_set(t, shingle)
                        sets[t] = hashes, node_of(hashes)
                (left, a_node), (right, b_node) = sets[x], sets[y]
                both = len(np.intersect1d(left, right, assume_unique=True))
                good.append(a_node == a and b_node == b and both >= similarity * (len(left) + len(right) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))
            del sets
        give_back()

    # Written first, so that few ids go to the texts and the texts are not shuffled.
    ids = stored(pairs.select(F.explode(F.array("a_id", "b_id")).alias("doc_id")).distinct(), "candidate_ids")
    needed = stored(texts.join(ids, "doc_id", "left_semi"), "candidate_texts")
    rows = pairs.join(needed.toDF("a_id", "a_text"), "a_id").join(needed.toDF("b_id", "b_text"), "b_id")
    return rows.select("a", "b", "a_text", "b_text").mapInArrow(run, "a long, b long").distinct()


def near_copies(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY
) -> DataFrame:
    """(doc_id, component_id) of every row with an id: the smallest id of all that near copies connect with it."""
    texts = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = stored(sketches(documents, doc_id, text, shingle), "sketches")
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("id"), F.first("keys").alias("keys"))
    close = stored(nodes.join(stored(partnered(postings(nodes)), "partnered"), "node"), "partnered")
    texts = stored(texts.join(close.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi"), "close_texts")
    close = stored(close.join(parities(texts, shingle), "node"), "parities")
    found = stored(candidates(postings(close), FIRST_SOME, similarity), "candidates")
    numbered = stored(found.where("b IS NOT NULL").groupBy("a", "b").agg(F.min("number").alias("number")), "pairs")
    ids = close.select("node", "id")

    def verified(pairs: DataFrame) -> DataFrame:
        named = pairs.join(ids.toDF("a", "a_id"), "a").join(ids.toDF("b", "b_id"), "b").select("a", "a_id", "b", "b_id")
        return similar(stored(named, "pairs"), texts, shingle, similarity)

    def joined(more: DataFrame) -> DataFrame:
        return components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))

    def root_of(pairs: DataFrame, node: str, root: str) -> DataFrame:
        return pairs.join(roots.toDF(node, root), node, "left").withColumn(root, F.coalesce(root, node))

    roots = components(verified(numbered.where("number = 0").select("a", "b")))
    others = root_of(root_of(numbered.where("number > 0"), "a", "a_root"), "b", "b_root").where("a_root <> b_root")
    roots = joined(verified(others.select("a", "b")))
    lists = root_of(found.where("list IS NOT NULL").select("list", F.col("a").alias("node"), "prints", "size", "parity"), "node", "root")
    roots = joined(verified(_between(lists, similarity)))

    whole = nodes.select("node", "id").join(roots, "node", "left").select("node", "id", F.coalesce("root", "node").alias("root"))
    least = whole.groupBy("root").agg(F.min("id").alias("component_id"))
    return rows.select("doc_id", "node").join(whole.join(least, "root").select("node", "component_id"), "node").select("doc_id", "component_id")
