"""Folds of blocks begin with pairs made in Arrow batches; bases tell ids."""

import gc

import numpy as np
import pyarrow as pa
import public_tokenizers

from tidegate.llm import bpe


def test_folds_of_blocks_begin_with_ready_pairs(spark):
    """Spark looked up each byte's pair anew, and the id of each pair left, expression by expression."""
    vocabulary = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    words = [b" the", b"a", bytes(range(256)), b"ab" * 128, "猫é".encode(), b"  ", b"x"]
    pairs = bpe.byte_pairs(words, vocabulary.first)
    assert pairs.value_lengths().to_pylist() == list(map(len, words)) and len(bpe.byte_pairs([], vocabulary.first)) == 0
    rows = spark.createDataFrame(pa.table([pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pairs)], ["pairs"]))
    folded = bpe.fold_pairs(rows, bpe.fold_tables(spark, vocabulary)).toArrow()
    left, edges = bpe._lists(folded.column("left").combine_chunks())
    ids = np.split(bpe.left_ids(left, vocabulary.id_of_base), edges[1:-1])
    assert [x.tolist() for x in ids] == [bpe.merge_by_heap(word, vocabulary) for word in words]


def test_a_base_tells_its_id():
    vocabulary = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    bases = vocabulary.table[1]
    assert len(np.unique(bases)) == len(bases) and (vocabulary.id_of_base[bases] == np.arange(len(bases))).all()


def test_a_block_leaves_no_dictionaries_behind():
    """The numbers of the stretches referred to themselves, so 15 MB of each block stayed in the worker."""
    block = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array(["one two three"])], ["doc_id", "text"])
    pattern = bpe._pretokeniser(public_tokenizers.PATTERN)
    bpe._to_block(block, pattern, {})
    gc.collect()
    gc.disable()
    try:
        bpe._to_block(block, pattern, {})
        assert gc.collect() == 0
    finally:
        gc.enable()
