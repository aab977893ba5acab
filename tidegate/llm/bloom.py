"""Bloom filters over 64-bit hashes, built range by range and bounded in size.

The top bits of a hash name its range, so each range is built by one task from whatever number of rows, in
memory that is fixed by the size of the filter and not by the rows. A whole filter has at most MOST_BITS
bits; beyond MOST_BITS / BITS_EACH hashes it tells less, it never forgets one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGE_BITS = 6
RANGES = 1 << RANGE_BITS
BITS_EACH = 16
MOST_BITS = 1 << 28  # 32 MB, what is sent to every task at most


def range_size(hashes: int) -> int:
    """Bits of each range for so many hashes: a power of two within the bound."""
    wanted = max(1024, -(-BITS_EACH * hashes // RANGES))
    return min(1 << (wanted - 1).bit_length(), MOST_BITS // RANGES)


def places(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash inside its range."""
    low, high = hashes & np.uint64(size - 1), (hashes >> np.uint64(29)) & np.uint64(size - 1)
    return low.astype(np.int64), high.astype(np.int64)


class Seen:
    """The filters of hashes seen once and seen twice, of one range."""

    def __init__(self, size: int):
        self.size = size
        self.once, self.twice = np.zeros(size, bool), np.zeros(size, bool)

    def add(self, hashes: np.ndarray, again: np.ndarray) -> None:
        """Distinct hashes of one block; `again` are those that the block holds more than once."""
        low, high = places(hashes, self.size)
        known = self.once[low] & self.once[high]
        for at in (low, high):
            self.twice[at[known]] = True
            self.once[at] = True
        for at in places(again, self.size):
            self.twice[at] = True


def ranges_of(hashes: np.ndarray) -> np.ndarray:
    """Where the ranges start in sorted hashes, the end included."""
    return np.searchsorted(hashes >> np.uint64(64 - RANGE_BITS), np.arange(RANGES + 1, dtype=np.uint64))


def seen_twice(blocks: DataFrame, hashes: int) -> DataFrame:
    """(part, bits): the filter of what two blocks hold or one block twice.

    `blocks` has (part, hashes, again) with the hashes as bytes; `hashes` is their number.
    """
    size = range_size(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Seen] = {}
        for batch in batches:
            for part, own, again in zip(*[batch.column(c).to_pylist() for c in ("part", "hashes", "again")], strict=True):
                if part not in seen:
                    seen[part] = Seen(size)
                seen[part].add(np.frombuffer(own, np.uint64), np.frombuffer(again, np.uint64))
        yield _packed({part: x.twice for part, x in seen.items()})

    return blocks.select("part", "hashes", "again").repartition("part").mapInArrow(run, "part int, bits binary")


def filter_of(hashes: DataFrame, count: int) -> DataFrame:
    """(part, bits): the filter of `count` hashes given as a signed long column `hash`."""
    size = range_size(count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            own = np.sort(batch.column("hash").to_numpy().view(np.uint64))
            edges = ranges_of(own)
            for part in np.flatnonzero(np.diff(edges)).tolist():
                if part not in seen:
                    seen[part] = np.zeros(size, bool)
                for at in places(own[edges[part] : edges[part + 1]], size):
                    seen[part][at] = True
        yield _packed(seen)

    part = F.shiftrightunsigned("hash", 64 - RANGE_BITS).cast("int")
    return hashes.select("hash", part.alias("part")).repartition("part").select("hash").mapInArrow(run, "part int, bits binary")


def _packed(bits: dict[int, np.ndarray]) -> pa.RecordBatch:
    parts = sorted(bits)
    return pa.RecordBatch.from_arrays(
        [pa.array(parts, pa.int32()), pa.array([np.packbits(bits[p], bitorder="little").tobytes() for p in parts], pa.binary())],
        ["part", "bits"],
    )


class Filter:
    """A whole filter: one row of bytes per range, RANGES of them, MOST_BITS bits at most."""

    def __init__(self, built: DataFrame, hashes: int):
        self.size = range_size(hashes)
        self.bits = np.zeros(RANGES * self.size // 8, np.uint8)
        for row in built.toLocalIterator():
            at = row.part * self.size // 8
            self.bits[at : at + self.size // 8] = np.frombuffer(bytes(row.bits), np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each hash may be in the filter; never false for one that is."""
        start = (hashes >> np.uint64(64 - RANGE_BITS)).astype(np.int64) * self.size
        out = np.ones(len(hashes), bool)
        for at in places(hashes, self.size):
            at += start
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1) != 0
        return out
