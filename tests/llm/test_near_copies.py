"""The pipeline's near copies against brute force over the sets of shingles."""

import numpy as np

import corpus_pipeline
from tidegate.llm import near_copies


def shingles(text):
    words = (text or "").lower().split()
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def corpus():
    chance = np.random.default_rng(11)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", " \n", "one", "ONE", "one two", "a b c d e", "A b\tc d e", "a b c d f"]
    for k in range(30):
        base = list(chance.choice(words, 200))
        texts.append(" ".join(base))
        for edits in (1, 3, 4, 5, 8, 12):  # an edit changes five shingles of either text
            copy = list(base)
            for at in chance.choice(40, edits, replace=False):
                copy[int(at) * 5] = f"x{int(chance.integers(10**6))}"
            texts.append(" ".join(copy))
    return texts


def brute(texts):
    lead = list(range(len(texts)))
    sets = [shingles(t) for t in texts]
    close = [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(sets[i], sets[j]) >= 0.8]
    changed = True
    while changed:
        changed = False
        for i, j in close:
            least = min(lead[i], lead[j])
            changed |= lead[i] != lead[j]
            lead[i] = lead[j] = least
    return lead


def test_near_copies_equal_brute_force(spark):
    texts = corpus()
    docs = spark.createDataFrame([*enumerate(texts), (3, "one"), (None, texts[20])], "doc_id long, text string").repartition(3)
    rows = near_copies.near_copies(docs).collect()
    assert len(rows) == len(texts) + 1
    want = brute(texts)
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(want))
    assert len(set(want)) < len(texts) - 60
    assert near_copies.near_copies(docs.where("doc_id < 0")).count() == 0
    kept = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(set(want))
    assert sum(r.doc_id is None for r in kept) == 1


def test_a_member_unlike_the_first_of_its_list_is_compared_with_the_others(spark, monkeypatch):
    texts = corpus()[9:60]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute(texts)
    made = near_copies.sketches
    monkeypatch.setattr(near_copies, "sketches", lambda *args: made(*args).selectExpr("doc_id", "node", "0L AS bits", "array(1L) AS keys"))
    for first in (2, 16, 100):  # several rounds, a few, one
        monkeypatch.setattr(near_copies, "FIRST_SOME", first)
        assert {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()} == dict(enumerate(want))


def test_a_large_group_takes_few_comparisons(spark, monkeypatch):
    """Copies of one text around the limit: those with three changes are near only to those with one."""
    chance = np.random.default_rng(3)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(400):
        copy = list(base)
        for at in chance.choice(40, 1 + int(chance.integers(3)), replace=False):
            copy[int(at) * 5] = f"x{int(chance.integers(10**6))}"
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    compared, similar = [], near_copies.similar
    monkeypatch.setattr(near_copies, "similar", lambda pairs, *args: compared.append(pairs.count()) or similar(pairs, *args))
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()}
    assert got == dict(enumerate(brute(texts)))
    assert sum(compared) < 40 * len(texts)


def test_a_group_just_below_the_similarity_makes_few_pairs(spark, monkeypatch):
    """Copies of one text with twelve changes each are at about 0.74 to one another; every tenth is copied once more."""
    chance = np.random.default_rng(5)
    base = [f"w{i}" for i in range(800)]
    texts = []
    for n in range(200):
        copy = texts[-1].split() if n % 10 == 9 else list(base)
        for at in chance.choice(160, 1 if n % 10 == 9 else 12, replace=False):
            copy[int(at) * 5] = f"x{int(chance.integers(10**6))}"
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    compared, similar = [], near_copies.similar
    monkeypatch.setattr(near_copies, "similar", lambda pairs, *args: compared.append(pairs.count()) or similar(pairs, *args))
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()}
    want = brute(texts)
    assert got == dict(enumerate(want))
    assert 150 < len(set(want)) <= 180
    assert sum(compared) < 2 * len(texts)
