import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tidegate.llm import substring_dedup, words
from tidegate.llm.words import ascii_words, flat_words, prefix_hashes


def texts_of(n, length=400):
    chance = np.random.default_rng(n)
    names = np.array([f"w{k}" for k in range(100_000)])
    return [" ".join(names[chance.integers(len(names), size=length)]) for _ in range(n)]


@pytest.fixture
def traced():
    tracemalloc.start()
    yield lambda: tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()


def test_hashing_words_takes_little_beside_them(traced):
    flat = flat_words(map(ascii_words, texts_of(1000)))
    prefix_hashes(flat)  # the tables of powers are made
    before = tracemalloc.get_traced_memory()[0]
    tracemalloc.reset_peak()
    prefix_hashes(flat)
    # Eight times the words' numbers, and what the bytes hashed at once take; before, 35 times the bytes.
    assert traced() - before < 8 * 8 * len(flat.begin) and traced() - before < 16 * len(flat.data)


@pytest.mark.parametrize("at_once", [1, 50, 1 << 18])
def test_hashes_by_pieces_are_the_same(monkeypatch, at_once):
    monkeypatch.setattr(words, "_HASHED_AT_ONCE", at_once)
    flat = flat_words(map(ascii_words, [None, "é b", "", "x " * 30 + "y" * 400 + " é b", " \n "]))
    own = np.diff(prefix_hashes(flat))
    assert flat.first.tolist() == [0, 0, 2, 2, 35, 35] and flat.text.tolist() == [1] * 2 + [3] * 33
    back = [int(h) * pow(int(words._BASE), -k, 1 << 64) % (1 << 64) for k, h in enumerate(own)]
    assert back[:2] == back[-2:] and len(set(back)) == 4 and len(set(back[2:32])) == 1


def test_a_bucket_is_sorted_in_few_times_its_strings(traced):
    blocks = []
    for k, block in enumerate([texts_of(500), texts_of(499), texts_of(500)[:100]]):
        rows = [pa.array(range(1000 * k, 1000 * k + len(block))), pa.array(block), pa.array([0] * len(block))]
        packed = substring_dedup._pack(pa.RecordBatch.from_arrays(rows, ["doc_id", "text", "version"]), 20, 4, 1, np.zeros(0, np.uint64))
        blocks += packed.to_pylist()
    batch = pa.RecordBatch.from_pylist(blocks, schema=packed.schema)
    least = sum(len(x) for x in texts_of(500) + texts_of(499) + texts_of(500)[:100]) * 3  # a word is in three strings
    list(substring_dedup._sort_bucket(iter([batch]), 20))  # the tables of powers are made
    before = tracemalloc.get_traced_memory()[0]
    tracemalloc.reset_peak()
    marks = pa.Table.from_batches(substring_dedup._sort_bucket(iter([batch]), 20)).to_pylist()
    assert traced() - before < 4 * least
    assert {m["doc_id"] for m in marks} == set(range(2000, 2100))
    assert sum(m["n"] for m in marks) == 100 * 381
