"""Blocks of text inside tasks: Arrow batches cut by size, and their bytes as flat numpy arrays."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def text_blocks(batches: Iterator[pa.RecordBatch], most_bytes: int, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of `batches` in order, in batches of about `most_bytes` of text; a longer text stands alone.

    Small batches are put together and large ones cut, so memory follows `most_bytes` and the longest text. What
    an earlier task left in the worker goes back to the machine before and after.
    """
    give_back()
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = 0
        for i, n in enumerate(lengths):
            if size and size + n > most_bytes:
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield pa.concat_batches(held) if len(held) > 1 else held[0]
                held, size, start = [], 0, i
            size += int(n)
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.concat_batches(held) if len(held) > 1 else held[0]
    give_back()


def give_back() -> None:
    """Return freed memory to the machine: workers are used again by later stages, and the C library keeps it else."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values one after another, and where each value starts (one more entry: the end)."""
    whole = pc.fill_null(column, "").cast(pa.large_string())
    whole = pa.concat_arrays([whole])
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    if whole.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(whole) + 1, np.int64)
    data = np.frombuffer(whole.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]
