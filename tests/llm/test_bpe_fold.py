"""The fold of BPE words: its merges, and what it leaves in the driver."""

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from common import plan_of

from tidegate.llm import bpe


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def folded(spark, words, vocabulary):
    rows = spark.createDataFrame([([list(word) for word in words],)], "words array<array<int>>")
    return bpe.fold_words(rows, bpe.fold_tables(spark, vocabulary)).first().ids


def test_the_fold_merges_like_the_heap(spark, vocabulary):
    chance = np.random.default_rng(5)
    parts = [b"a", b"aa", b"ab", b"aba", b" the", b"tion", b"st", "é".encode(), "猫".encode(), b"\xff", b"0", b"=="]
    words = [b"".join(chance.choice(np.array(parts, object), n)) for n in (1, 2, 3, 5, 8, 13, 30) for _ in range(15)]
    words += [bytes([i]) for i in range(256)] + [b"a" * 256, b"ab" * 128, bytes(chance.integers(0, 256, 256, np.uint8).tolist())]
    words = [word[: bpe.LONGEST_FOLD] for word in words]
    assert folded(spark, words, vocabulary) == [bpe.merge_by_heap(word, vocabulary) for word in words]


def test_of_equal_ranks_the_first_is_merged(spark):
    """Two different pairs that make the same piece, one of them where the other would take its byte."""
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"ba": 257, b"aba": 258, b"cab": 259}
    small = bpe.Vocabulary(ranks)
    words = [b"ababa", b"abaaba", b"cababa", b"babab", b"cabcab", b"", b"aba"]
    assert folded(spark, words, small) == [bpe.merge_by_heap(word, small) for word in words]


def test_every_pair_is_found_and_no_other(vocabulary):
    slots, bases = vocabulary.table
    keys = np.array(list(vocabulary.pairs))
    left, right = keys >> 16, keys & 65535
    found = slots[bases[left] + right]
    assert (found >> bpe._RANK == np.array(list(vocabulary.pairs.values()))).all()
    assert ((found >> bpe._ID & 131071 == left) & (found & 131071 == right)).all() and (slots >= 0).sum() == len(keys)
    assert len(slots) > bases.max() + bpe._END


def test_plans_do_not_hold_the_tables(spark):
    """The driver keeps the text of each plan: 3.5 MB of literals for each write filled its memory."""
    docs = spark.createDataFrame([(1, "the cat"), (2, None)], "doc_id long, text string")
    made = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    assert len(plan_of(made)) < 100_000


def test_a_step_of_the_fold_copies_one_array(spark, vocabulary):
    """No list of ids beside that of ranks, and no function that costs an exception or a lazy list for each merge."""
    rows = spark.createDataFrame([([[116, 104, 101]],)], "words array<array<int>>")
    plan = plan_of(bpe.fold_words(rows, bpe.fold_tables(spark, vocabulary)))
    assert "aggregate(" in plan and not any(name in plan for name in ("named_struct(", "array_position(", "concat("))


def test_digests_of_a_block(vocabulary):
    """Empty first stretches, documents without words, long words and hot ones in one block."""
    texts = ["the cat, the cat", None, "", "  two  spaces", "x" * 300 + " end", "猫 猫", "\n"]
    block = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    hot_ids = bpe.merge_by_heap(b" cat", vocabulary)
    hot = bpe.HotWords(pa.array([" cat"]), np.array(hot_ids, np.int32), np.array([0, len(hot_ids)]))
    row = bpe._to_block(block, bpe._pretokeniser(public_tokenizers.PATTERN), {" cat": 0})
    ids = [[bpe.merge_by_heap(bytes(word), vocabulary) for word in row.column("words")[0].as_py()]]
    names = [name for name in row.schema.names if name != "words"]
    row = pa.RecordBatch.from_arrays([*map(row.column, names), pa.array(ids, pa.list_(pa.list_(pa.int32())))], [*names, "ids"])
    got = bpe._digests(row, hot, vocabulary, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"])
    decoded = [bpe.decode(x, vocabulary) for x in got.column("ids").to_pylist()]
    assert decoded == [(text or "").encode() for text in texts]
    assert got.column("n_tokens").to_pylist() == list(map(len, got.column("ids").to_pylist()))
