"""Line dedup against plain Python and against SQL."""

import hashlib
import random

import pytest

from tidegate.llm import bloom, line_dedup
from tidegate.llm.queries import ALL

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n_lines string, `odd name` string"


def brute(rows, least=10, chars=1, keep_first=False):
    strip = " \t\n\x0b\x0c\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = [(text or "").split("\n") for _, text in rows]
    keys = [[line.strip(strip).translate(lower) for line in lines] for lines in split]
    counts, first = {}, {}
    for (doc, _), own in zip(rows, keys, strict=True):
        for key in set(own):
            counts[key] = counts.get(key, 0) + 1
            at = (doc is not None, doc or 0)
            first[key] = min(first.get(key, at), at)
    out = []
    for (doc, _), lines, own in zip(rows, split, keys, strict=True):
        kept, had = [], set()
        for line, key in zip(lines, own, strict=True):
            gone = len(key) >= chars and key != "" and counts[key] >= least
            if gone and keep_first and first[key] == (doc is not None, doc or 0) and key not in had:
                gone = False
            had.add(key)
            if not gone:
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def corpus():
    chance = random.Random(5)
    common = ["Share this", "  share THIS\t", "\x0bshare this", "Ünï Cödé", "a", "", " ", "é", "ß straße", "MENU\r", "menu"]
    rows = [(i, "\n".join(chance.choice([*common, f"own {i} {j}", f"few {chance.randrange(40)}"]) for j in range(chance.randrange(1, 9)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "x\n" * 3000 + "Share this"), (204, "share this" + " " * 500_000)]
    return rows


def run(spark, rows, **more):
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    return docs, line_dedup.drop_shared_lines(docs, **more)


@pytest.mark.parametrize("least, chars, keep_first", [(10, 1, False), (2, 1, False), (3, 5, False), (4, 1, True)])
def test_equals_brute_force(spark, least, chars, keep_first):
    rows = corpus()
    docs, got = run(spark, rows, min_documents=least, min_chars=chars, keep_first=keep_first)
    assert got.columns == ["doc_id", "text", "odd name", "n_lines", "n_dropped"]
    want = brute(rows, least, chars, keep_first)
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got.collect()) == sorted(want)
    assert sum(w[2] for w in want) > 20


def test_repeated_rows_null_ids_and_ids_with_several_texts(spark):
    rows = [(None, "a\nb")] * 6 + [(None, "a\nc")] * 5 + [(1, "a")] * 2 + [(1, "b\nd")] * 3 + [(2, "b\n\n")]
    _, got = run(spark, rows)
    assert sorted(((r.doc_id or -1), r.n_lines, r.n_dropped, r.text) for r in got.collect()) == sorted(
        ((d or -1), n, gone, t) for d, n, gone, t in brute(rows)
    )


def test_empty_table_and_threshold(spark):
    docs, got = run(spark, [])
    assert got.collect() == []
    with pytest.raises(ValueError):
        line_dedup.drop_shared_lines(docs, min_documents=1)


def test_a_full_filter_only_suspects_more(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MOST_BITS", bloom.RANGES * 8)
    rows = corpus()
    _, got = run(spark, rows)
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got.collect()) == sorted(brute(rows))


def test_lines_of_one_document_are_not_shuffled(spark):
    rows = [(i, f"only {i}\nhere {i}") for i in range(2000)] + [(i, "shared") for i in range(3000, 3012)]
    slim = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "0L AS mark", "0L AS mark2", "cast(text AS binary) AS text")
    blocks = line_dedup.line_hashes(slim)
    count = blocks.agg({"n": "sum"}).first()[0]
    shared = spark.sparkContext.broadcast(bloom.Filter(bloom.seen_twice(blocks, count), count))
    found = line_dedup.suspects(slim, shared).collect()
    assert sum(r.n for r in found if bytes(r.key) == b"shared") == 12
    assert len(found) < 60


def test_query_equals_sql(spark, tables_sql):
    name = "op12_line_dedup"
    got = ALL[name].run(spark, SMALL)
    want = tables_sql.execute(ALL[name].sql).fetchall()
    names = [c[0] for c in tables_sql.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want)
    texts = tables_sql.execute("SELECT doc_id, text FROM documents").fetchall()
    brutes = sorted((d, n, gone, hashlib.sha256(t.encode()).hexdigest()) for d, n, gone, t in brute(texts))
    assert sorted(tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()) == brutes
