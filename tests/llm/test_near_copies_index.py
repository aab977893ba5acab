"""The candidates of near copies against the definition of their index."""

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from test_near_copies import corpus

from tidegate.llm import near_copies


def test_candidates_share_positional_bytes_of_a_fingerprint(spark):
    docs = spark.createDataFrame(list(enumerate(corpus())), "doc_id long, text string")
    nodes = near_copies.sketches(docs).dropDuplicates(["node"])
    prints = {r.node: np.array(r.keys).astype(np.uint8) for r in nodes.collect() if r.keys}
    want = set()
    for a, b in combinations(sorted(prints), 2):
        shared = (prints[a] == prints[b]).reshape(near_copies.SEEDS, 8).sum(axis=1)
        apart = np.bitwise_count(prints[a] ^ prints[b]).sum()
        if shared.max() >= near_copies.SHARED and apart <= near_copies.APART * 64 * near_copies.SEEDS:
            want.add((a, b))
    found = near_copies.candidates(near_copies.postings(nodes), 100).collect()
    assert {(r.a, r.b) for r in found} == want and len(want) > 100
    few = near_copies.candidates(near_copies.postings(nodes), 1).collect()
    numbered = {(r.a, r.b) for r in few if r.list is None}
    assert numbered < want and {r.b for r in few if r.list is None} == {b for _, b in want}
    members = {}
    for r in few:
        if r.list is not None:
            members.setdefault(r.list, set()).add(r.a)
    assert want - numbered <= {pair for own in members.values() for pair in combinations(sorted(own), 2)}


def test_parities_drop_no_pair_of_the_similarity(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    nodes = near_copies.sketches(docs).dropDuplicates(["node"])
    marked = nodes.join(near_copies.parities(docs), "node")
    loose = {(r.a, r.b) for r in near_copies.candidates(near_copies.postings(nodes), 100).collect()}
    strict = {(r.a, r.b) for r in near_copies.candidates(near_copies.postings(marked), 100).collect()}
    sets = {near_copies.node_of(x): set(x.tolist()) for x in map(near_copies.shingle_set, texts)}
    alike = {pair: len(sets[pair[0]] & sets[pair[1]]) / len(sets[pair[0]] | sets[pair[1]]) for pair in loose}
    similar = {pair for pair, x in alike.items() if x >= near_copies.SIMILARITY}
    assert similar <= strict <= {pair for pair, x in alike.items() if x > 0.76}
    assert 30 < len(similar) < len(loose) - 30


def test_parities_of_different_lengths_differ_in_no_more_bits_than_the_sets():
    chance = np.random.default_rng(2)
    hashes = np.unique(chance.integers(0, 1 << 64, 12_000, np.uint64))
    sets = [hashes[a : a + n] for n in (0, 1, 15, 16, 31, 33, 40, 500, 9000) for a in (0, 3, 2 * n)]
    lengths, folded = near_copies._folded(pa.array([near_copies.parity(x) for x in sets], pa.binary()))
    assert {*lengths.tolist()} == {8, 16, 128, 1024}
    for (i, a), (j, b) in combinations(enumerate(sets), 2):
        place, words = folded[int(min(lengths[i], lengths[j]))]
        apart = int(np.bitwise_count(words[:, place[i]] ^ words[:, place[j]]).sum())
        assert apart <= len(np.setxor1d(a, b))


def test_partnered_nodes_are_those_of_all_close_pairs(spark):
    """Also those whose only close node stands after them in a list, and was close to another before."""
    docs = spark.createDataFrame(list(enumerate(corpus())), "doc_id long, text string")
    nodes = near_copies.sketches(docs).dropDuplicates(["node"])
    for own in (nodes, nodes.withColumn("keys", F.expr("transform(keys, k -> k div 256 * 256 + k % 4)"))):
        listed = near_copies.postings(own)
        pairs = near_copies.candidates(listed, 1000).collect()
        want = {node for r in pairs for node in (r.a, r.b)}
        assert {r.node for r in near_copies.partnered(listed).collect()} == want and want
