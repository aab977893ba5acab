"""Benchmark decontamination by q-gram filtering and banded alignment.

A benchmark item of m characters is found in a document where a piece of the document is within
e = floor(EDIT_RATE * m) edits of the item. Such a piece shares at least m - q + 1 - q * e character q-grams
with the item (q-gram lemma), all of them on diagonals (place in the document minus place in the item) that
differ by at most 2 * e. Diagonals are cut into overlapping bands, so one band holds them all. Bands that
reach the bound are verified by banded alignment.

Repeated characters (rules, table lines) share a q-gram at every place with every place of an item. Places of one
q-gram at equal steps are therefore a run, in the item and in the text, and two runs are counted diagonal by
diagonal rather than place by place. Counting goes through the text in pieces of bounded size, and a band is
judged and forgotten as soon as no later piece can reach it.

Texts are compared in lower case with runs of white space as one space.

Defined results: a null or empty item or document matches nothing. An item of fewer than q characters has no
q-gram and is looked up as it is, as whole words; a longer one with a bound below one shared q-gram cannot
occur, as EDIT_RATE * q < 1 leaves e = 0 there. Equal items with different ids are all reported, repeated
rows and ids are searched one by one, and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.blocks import text_blocks

Q = 10
EDIT_RATE = 0.05
BLOCK_BYTES = 2_000_000
ITEM_CHARS = 4_000_000  # characters of benchmark items searched for at once; more items take more passes
PIECE = 500_000  # diagonals counted at once

SCHEMA = "doc_id long, item_id long, edits int, start int, length int"
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 24


class ItemIndex(NamedTuple):
    ids: list[int | None]
    texts: list[str]
    sizes: np.ndarray
    edits: np.ndarray
    bounds: np.ndarray
    grams: np.ndarray  # distinct hashes in order
    steps: np.ndarray  # step between the places of each in its runs, 0 where it has none
    first: np.ndarray  # first run of each, the end included
    items: np.ndarray  # runs of places: item, first place and number of places
    places: np.ndarray
    lengths: np.ndarray
    known: np.ndarray  # a bit of each hash, to rule most others out
    short: list[int]  # items of fewer than q characters


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def q_grams(points: np.ndarray) -> np.ndarray:
    """Hashes of all windows of Q characters."""
    n = len(points) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # Windows of twice the length are put together from two halves: 1, 2, 4, 5, 10 characters.
    grams, size = points.astype(np.uint64), 1
    for bit in bin(Q)[3:]:
        step = _PRIME ** np.uint64(size)
        grams = grams[:-size] * step + grams[size:]
        size *= 2
        if bit == "1":
            grams = grams[:-1] * _PRIME + points[size:].astype(np.uint64)
            size += 1
    grams = (grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return grams ^ (grams >> np.uint64(32))


def index_items(items: list[tuple[int | None, str | None]], edit_rate: float = EDIT_RATE) -> ItemIndex:
    """The q-grams of items (id, text) with their places."""
    ids, texts = [i for i, _ in items], [normalise(t) for _, t in items]
    sizes = np.array([len(t) for t in texts], np.int64)
    edits = np.floor(sizes * edit_rate).astype(np.int64)
    grams = [q_grams(_points(t)) for t in texts]
    every = np.concatenate([*grams, np.zeros(0, np.uint64)])
    item = np.repeat(np.arange(len(texts)), [len(g) for g in grams])
    place = np.concatenate([*[np.arange(len(g)) for g in grams], np.zeros(0, np.int64)]).astype(np.int64)
    order = np.argsort(every, kind="stable")
    distinct, first = np.unique(every[order], return_index=True)
    gram = np.repeat(np.arange(len(distinct)), np.diff([*first, len(every)]))
    item, place = item[order], place[order]
    gap = np.where((gram[1:] == gram[:-1]) & (item[1:] == item[:-1]), place[1:] - place[:-1], 0)
    steps = np.zeros(len(distinct), np.int64)
    repeats = np.flatnonzero(gap)[::-1]
    steps[gram[1:][repeats]] = gap[repeats]  # of each, the first one
    begin, lengths = _runs(gap, steps[gram[1:]], len(every))
    known = np.zeros(1 << _FILTER_BITS, bool)
    known[(distinct >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
    short = [i for i, t in enumerate(texts) if 0 < len(t) < Q]
    return ItemIndex(
        ids, texts, sizes, edits, np.maximum(sizes - Q + 1 - Q * edits, 1), distinct, steps,
        np.searchsorted(gram[begin], np.arange(len(distinct) + 1)), item[begin], place[begin], lengths, known, short,
    )


def _runs(gap: np.ndarray, step: np.ndarray, n: int, most: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First member and length of the runs of n places: neighbours a step apart, at most `most` (of each place) long."""
    joined = np.concatenate([[False], (gap == step) & (gap > 0)])[:n]
    begin = np.flatnonzero(~joined)
    if most is not None and joined.any():
        inside = np.arange(n) - np.repeat(begin, np.diff([*begin, n]))
        begin = np.flatnonzero(inside % most == 0)
    return begin, np.diff([*begin, n])


def align(item: np.ndarray, piece: np.ndarray, most: int, low: int, high: int) -> tuple[int, int, int] | None:
    """(edits, start, length) of the part of `piece` closest to `item` within `most` edits; else None.

    Only diagonals low..high (place in the piece minus place in the item) are filled: one vector per
    character of the item.
    """
    width = high - low + 1
    diagonals = np.arange(low, high + 1)
    far = most + 1
    slope = np.arange(width)
    row = np.where((diagonals >= 0) & (diagonals <= len(piece)), 0, far)
    begin = diagonals.copy()
    for i, char in enumerate(item):
        at = diagonals + i  # the character of the piece that stands against it
        inside = (at >= 0) & (at < len(piece))
        same = np.zeros(width, bool)
        same[inside] = piece[at[inside]] == char
        step = row + ~same
        step[~inside] = far
        gone = np.concatenate([row[1:] + 1, [far]])  # the item's character is missing in the piece
        take = gone < step
        new, start = np.where(take, gone, step), np.where(take, np.concatenate([begin[1:], [0]]), begin)
        # Characters only the piece has: the least of what stands to the left, plus the distance.
        reach = new - slope
        best = np.minimum.accumulate(reach)
        lead = np.maximum.accumulate(np.where(reach == best, slope, 0))
        row, begin = np.minimum(best + slope, far), start[lead]
        row[(at + 1 < 0) | (at + 1 > len(piece))] = far
        if row.min() > most:
            return None
    k = int(row.argmin())
    end = int(diagonals[k]) + len(item)
    return int(row[k]), int(begin[k]), end - int(begin[k])


def _bands(points: np.ndarray, index: ItemIndex) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(item, lowest and highest diagonal) of the bands that share enough q-grams, piece by piece of the text."""
    grams = q_grams(points)
    at = np.flatnonzero(index.known[(grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
    if not len(at) or not len(index.grams):
        return
    which = np.minimum(np.searchsorted(index.grams, grams[at]), len(index.grams) - 1)
    real = index.grams[which] == grams[at]
    at, which = at[real], which[real]
    del grams, real
    # Runs of the text: places of one q-gram, as far apart as in the items, of a length that a piece can take.
    lists = np.diff(index.first)
    if index.steps[which].any():
        order = np.argsort(which, kind="stable")
        at, which = at[order], which[order]
        gap = np.where(which[1:] == which[:-1], at[1:] - at[:-1], 0)
        begin, length = _runs(gap, index.steps[which[1:]], len(at), np.clip(PIECE // lists[which], 1, PIECE))
        order = np.argsort(at[begin], kind="stable")
        begin, length = begin[order], length[order]
        at, which = at[begin], which[begin]
    else:
        length = np.ones(len(at), np.int64)
    reach = np.concatenate([[0], np.cumsum(index.lengths)])
    cost = (length - 1) * lists[which] + reach[index.first[which + 1]] - reach[index.first[which]]
    piece = np.cumsum(cost) // PIECE
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(at)]
    longest = int(index.sizes.max())
    span = len(points) + 2 * longest + 2
    keys, shared = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for start, stop in zip(cuts, cuts[1:], strict=False):
        item, diagonal, n = _diagonals(at[start:stop], which[start:stop], length[start:stop], index)
        diagonal += longest
        band = diagonal // (2 * index.edits[item] + 1)
        lower = np.flatnonzero(band)
        every = np.concatenate([keys, item * span + band, item[lower] * span + band[lower] - 1])
        n = np.concatenate([shared, n, n[lower]])
        order = np.argsort(every, kind="stable")
        every = every[order]
        first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])[: len(every)])
        keys, shared = every[first], np.add.reduceat(n[order], first) if len(first) else n
        item, band = keys // span, keys % span
        width = 2 * index.edits[item] + 1
        # What comes later starts at the next run or behind it.
        low, high = band * width - longest, (band + 2) * width - 1 - longest
        over = np.ones(len(keys), bool) if stop == len(at) else high < at[stop] - index.sizes[item]
        reached = over & (shared >= index.bounds[item])
        yield item[reached], low[reached], high[reached]
        keys, shared = keys[~over], shared[~over]


def _diagonals(at: np.ndarray, which: np.ndarray, length: np.ndarray, index: ItemIndex) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, diagonal, shared q-grams) of runs of a text against all runs of their q-gram in the items."""
    lists = index.first[which + 1] - index.first[which]
    run = np.repeat(index.first[which] - np.cumsum(lists) + lists, lists) + np.arange(lists.sum())
    at, length, step = np.repeat(at, lists), np.repeat(length, lists), np.repeat(index.steps[which], lists)
    other = index.lengths[run]
    lowest = at - index.places[run] - step * (other - 1)
    if (length == 1).all() and (other == 1).all():
        return index.items[run], lowest, np.ones(len(run), np.int64)
    # Two runs of a and b places meet on a + b - 1 diagonals: once on the outermost, min(a, b) times in the middle.
    n = length + other - 1
    pair = np.repeat(np.arange(len(run)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    met = np.minimum(np.minimum(k + 1, n[pair] - k), np.minimum(length, other)[pair])
    return index.items[run][pair], lowest[pair] + step[pair] * k, met


def search(texts: list[str | None], index: ItemIndex) -> list[tuple[int, int, int, int, int]]:
    """(text, item, edits, start, length) of each item found in each text, at its closest place."""
    plain = [normalise(t) for t in texts]
    starts = np.cumsum([0, *[len(t) + 1 for t in plain]])
    points = _points("\n".join([*plain, ""]))
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    for i in index.short:
        for d, text in enumerate(plain):
            at = f" {text} ".find(f" {index.texts[i]} ")
            if at >= 0:
                found[d, i] = (0, at, int(index.sizes[i]))
    for item, low, high in _bands(points, index):
        # A band near the end of a text may cover its neighbour, so both are aligned.
        left = np.searchsorted(starts, np.maximum(low, 0), side="right") - 1
        right = np.searchsorted(starts, np.minimum(high + index.sizes[item], len(points) - 1), side="right") - 1
        right = np.minimum(right, len(plain) - 1)
        for i, a, z, first, last in zip(*(x.tolist() for x in (item, low, high, left, right)), strict=True):
            for d in range(first, last + 1):
                if found.get((d, i), (1,))[0] == 0:
                    continue
                begin, end = int(starts[d]), int(starts[d + 1]) - 1
                size, edits = int(index.sizes[i]), int(index.edits[i])
                whole = plain[d].find(index.texts[i], max(a - begin, 0), max(z - begin, 0) + size)
                if whole >= 0:
                    found[d, i] = (0, whole, size)
                    continue
                match = align(_points(index.texts[i]), points[begin:end], edits, a - begin - edits, z - begin + edits)
                if match and match < found.get((d, i), (1 << 30, 0, 0)):
                    found[d, i] = match
    return [(d, i, *match) for (d, i), match in sorted(found.items())]


def _item_blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int | None, str | None]]]:
    """Items by hash into as many blocks as ITEM_CHARS asks for; each block goes through the driver alone."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text"))
    chars = items.agg(F.sum(F.length("text") + 100)).first()[0] or 0
    n = chars // ITEM_CHARS + 1
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect() if n > 1 else items.collect()
        yield [(r.item_id, r.text) for r in rows]


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    edit_rate: float = EDIT_RATE,
) -> DataFrame:
    """(doc_id, item_id, edits, start, length): one row for each item in each document that holds it.

    Start and length count characters of the normalised text. Items are searched for block by block.
    """
    _check(edit_rate)
    context = documents.sparkSession.sparkContext
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    out = None
    for items in _item_blocks(benchmark, item_id, item_text):
        shared = context.broadcast(index_items(items, edit_rate))  # bounded by ITEM_CHARS
        hits = rows.mapInArrow(_searcher(shared), SCHEMA)
        out = hits if out is None else out.unionByName(hits)
    return out


def _searcher(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, BLOCK_BYTES):
            hits = search(block.column("text").to_pylist(), shared.value)
            if hits:
                text, item, edits, start, length = zip(*hits, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("doc_id").take(pa.array(text)),
                        pa.array([shared.value.ids[i] for i in item], pa.int64()),
                        *[pa.array(x, pa.int32()) for x in (edits, start, length)],
                    ],
                    ["doc_id", "item_id", "edits", "start", "length"],
                )

    return run


def without_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    edit_rate: float = EDIT_RATE,
) -> DataFrame:
    """The documents, all columns, in which no benchmark item is found; nothing is shuffled."""
    _check(edit_rate)
    out = documents
    for items in _item_blocks(benchmark, item_id, item_text):
        shared = documents.sparkSession.sparkContext.broadcast(index_items(items, edit_rate))
        out = out.mapInArrow(_filter(shared, text), out.schema)
    return out


def _filter(shared, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, BLOCK_BYTES, text):
            leaked = {hit[0] for hit in search(block.column(text).to_pylist(), shared.value)}
            yield block.filter(pa.array([i not in leaked for i in range(block.num_rows)])) if leaked else block

    return run


def _check(edit_rate: float) -> None:
    if not edit_rate * Q < 1:
        raise ValueError("the edit rate must be below 1 / Q, or the bound of shared q-grams says nothing")
