"""Operators that compare documents, and the pipeline, against brute force."""

import hashlib

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F
from test_near_copies import brute as brute_near_copies

import corpus_pipeline
from tidegate.llm import queries, simhash, substring_dedup

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n_words string, _marks int, bits string, key string"


def frame(spark, texts, ids=None):
    rows = [(i, t, "w", 1, "b", "k") for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute_print(text):
    words = [bytes(w) for w in (text or "").encode().lower().split()]
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest index that each fingerprint reaches by steps of at most 3 bits."""
    lead = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 3 and lead[j] < lead[i]:
                    lead[i], changed = lead[j], True
    return lead


def test_simhash_equals_brute_force(spark):
    chance = np.random.default_rng(1)
    base = " ".join(chance.choice(["alpha", "beta", "Gamma", "delta", "eps", "zeta"], 80))
    texts = [None, "", " \n ", "one", "ONE", "one two", "A b\tc", "a B c"]
    for _ in range(25):
        words = base.split()
        words[int(chance.integers(80))] = str(chance.integers(5))
        texts.append(" ".join(words))
    texts += [" ".join(chance.choice(["u", "v", "w", "x"], 30)) for _ in range(10)] + ["É x y z" * 50, base, base]
    docs = frame(spark, texts).unionByName(frame(spark, [texts[3], None], [3, None]))
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(texts) + 2
    prints = [brute_print(t) for t in texts]
    lead = brute_components(prints)
    for r in rows:
        if r.doc_id is not None:
            assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", lead[r.doc_id])
        else:
            assert (r.fingerprint, r.component_id) == ("0" * 16, lead[0])
    assert simhash.near_duplicates(docs.where("doc_id < 0")).count() == 0


@pytest.mark.parametrize("pairwise", [1, 1024])
def test_links_of_a_list(monkeypatch, pairwise):
    monkeypatch.setattr(simhash, "MOST_PAIRWISE", pairwise)
    chance = np.random.default_rng(2)
    base = int(chance.integers(1 << 62))
    members = {base}
    for _ in range(60):  # the members of a list agree in five bytes
        value = base
        for bit in chance.choice(24, int(chance.integers(1, 6)), replace=False):
            value ^= 1 << int(bit)
        members.add(value)
    array = np.array(sorted(members), np.uint64)
    left, right = simhash.list_links(array)
    lead = {int(x): int(x) for x in array} | {int(a): int(b) for a, b in zip(left, right, strict=True)}
    want = brute_components([int(x) for x in array])
    assert [lead[int(x)] for x in array] == [int(array[k]) for k in want]


def test_the_index_loses_no_pair(spark):
    chance = np.random.default_rng(3)
    prints = []
    for _ in range(150):
        a = int(chance.integers(1 << 63)) << 1
        b = a
        for bit in chance.choice(64, 3, replace=False):
            b ^= 1 << int(bit)
        prints += [a, b]
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    found = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "bits long")).collect()}
    assert all((a, b) in found or (b, a) in found for a, b in zip(signed[::2], signed[1::2], strict=True))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1040)] + [(7, 7)]
    rows = simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in rows} == {i: 0 for i in range(1, 61)} | {i: 1000 for i in range(1001, 1040)}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(documents, window):
    """Kept words of (id, words) in order of ids; a null id first."""
    first = {}
    order = sorted(range(len(documents)), key=lambda k: (documents[k][0] is not None, documents[k][0] or 0))
    for k in order:
        i, words = documents[k]
        for at in range(len(words) - window + 1):
            first.setdefault(tuple(words[at : at + window]), (i, at))
    out = []
    for i, words in documents:
        gone = {
            at + d
            for at in range(len(words) - window + 1)
            if first[tuple(words[at : at + window])] != (i, at)
            for d in range(window)
        }
        out.append([w for k, w in enumerate(words) if k not in gone])
    return out


@pytest.mark.parametrize("block, share", [(150, None), (4_000_000, None), (300, 0.002)])
def test_substring_dedup_equals_brute_force(spark, monkeypatch, block, share):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", block)
    chance = np.random.default_rng(4)
    passage = [f"p{k}" for k in range(30)]
    texts = [None, "", "few words", "same " * 90, "é x " * 40]
    for k in range(20):
        own = list(chance.choice(["a", "b", "c", "dd"], 40))
        at = int(chance.integers(41))
        texts.append((" " if k % 3 else "\n\t").join(own[:at] + (passage if k % 2 else passage[:19]) + own[at:]))
    texts += [texts[5], texts[6] + " end"]
    ids = [*range(100, 100 + len(texts)), 105, None, None]
    texts += [texts[5], texts[7], texts[8]]
    got = substring_dedup.remove_repeats(frame(spark, texts, ids), hot_share=share).collect()
    assert len(got) == len(texts) and got[0].key == "k"
    words = [[w.decode() for w in (t or "").encode().split()] for t in texts]
    kept = brute_repeats(list(zip(ids, words, strict=True)), substring_dedup.WINDOW)
    want = sorted((i or -1, len(w), len(w) - len(k), " ".join(k) if len(k) < len(w) else t or "") for i, w, k, t in zip(ids, words, kept, texts, strict=True))
    assert sorted((r.doc_id or -1, r.n_words, r.n_removed, r.text or "") for r in got) == want
    assert sum(r.n_removed for r in got) > 500
    assert substring_dedup.remove_repeats(frame(spark, ["x"]).where("doc_id < 0")).count() == 0


def test_hot_minimisers_are_found(spark):
    chance = np.random.default_rng(6)
    common = "aa bb cc dd ee ff gg hh".split()
    texts = [" ".join([*map(str, chance.integers(10**6, size=30)), *common, *map(str, chance.integers(10**6, size=30))]) for _ in range(200)]
    rows = frame(spark, texts).select("doc_id", "text")
    hot = substring_dedup.hot_minimisers(rows, 20, 4, 0.01)
    assert 1 <= len(hot) <= 5 and len(substring_dedup.hot_minimisers(rows, 20, 4, 0.9)) == 0


def test_versions_of_one_id_are_one_document(spark):
    long = " ".join(f"w{k}" for k in range(40))
    rows = substring_dedup.remove_repeats(frame(spark, [long, long, long + " more", long], [1, 1, 1, 2])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(1, 0), (1, 0), (1, 0), (2, 40)]


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n, q in queries.ALL.items() if q.sql])
def test_queries_equal_their_sql(spark, sql, name):
    got = queries.ALL[name].run(spark, SMALL).toPandas()
    want = sql.execute(queries.ALL[name].sql).df()[list(got.columns)]
    got, want = (x.astype(object).where(x.notna(), None).sort_values(list(x.columns)[:3]).reset_index(drop=True) for x in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_queries_without_sql_return_every_row(spark, sql):
    n = sql.execute("SELECT count(*) FROM documents").fetchone()[0]
    langs = dict(sql.execute("SELECT doc_id, lang FROM documents").fetchall())
    found = queries.ALL["op2_language_id"].run(spark, SMALL).collect()
    assert len(found) == n and np.mean([langs[r.doc_id] == r.lang_pred for r in found if r.held_out]) > 0.95
    labels = dict(sql.execute("SELECT doc_id, quality FROM labels").fetchall())
    scored = queries.ALL["op5_quality_classifier"].run(spark, SMALL).collect()
    assert len(scored) == n and np.mean([labels[r.doc_id] == r.predicted for r in scored if r.doc_id in labels and r.held_out]) > 0.85
    pages = queries.ALL["op3_html_extraction"].run(spark, SMALL).collect()
    assert len(pages) == sql.execute("SELECT count(*) FROM pages").fetchone()[0] and all(p.text for p in pages)
    items = sql.execute("SELECT item_id, text FROM benchmark").fetchall()
    texts = sql.execute("SELECT doc_id, text FROM documents").fetchall()
    leaks = {(r.doc_id, r.item_id) for r in queries.ALL["op4_benchmark_decontamination"].run(spark, SMALL).collect()}
    assert leaks == {(d, i) for d, t in texts for i, x in items if x in t}


def test_pipeline_equals_brute_force(spark, sql):
    """Each stage on what the one before it kept, in plain Python."""
    documents = sql.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()
    documents = [(i, t) for i, t in documents if t and any(map(str.isalpha, t))]
    lead = brute_near_copies([t for _, t in documents])
    documents = [d for k, d in enumerate(documents) if lead[k] == k]
    words = [(i, [w.decode() for w in t.encode().split()]) for i, t in documents]
    kept = brute_repeats(words, substring_dedup.WINDOW)
    documents = [(i, t if len(k) == len(w) else " ".join(k)) for (i, t), (_, w), k in zip(documents, words, kept, strict=True) if k]
    items = [" ".join(x.lower().split()) for (x,) in sql.execute("SELECT text FROM benchmark").fetchall()]
    documents = [(i, t) for i, t in documents if not any(x in " ".join(t.lower().split()) for x in items)]
    got = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in documents}


def test_stages_keep_columns_and_bear_odd_rows(spark):
    rows = [
        (1, "the house and the garden " * 3, "en", "s", 75), (1, "the house and the garden " * 3, "en", "s", 75), (2, None, None, None, None),
        (3, "123", "en", "s", 3), (None, "der hund und die katze", "de", None, 22), (5, " ".join(f"w{k}" for k in range(60)), "de", "s", None),
        (6, "x " + " ".join([f"y{k}" for k in range(60)] + [f"w{k}" for k in range(60)]), "de", "s", None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert [f.name for f in docs.schema] == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        sizes.append(docs.count())
    assert sizes == [5, 4, 4, 4]
    cut = docs.where("doc_id = 6").first()
    assert cut.text == "x " + " ".join(f"y{k}" for k in range(60)) and cut.n_chars == len(cut.text)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == 4
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where(F.lit(False)), SMALL).count() == 0
