"""Collocations against plain counting."""

import random
import re

import pytest
from tidegate.llm import bloom, collocations
from tidegate.llm.queries import ALL

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, subsumed=80, top=2000, longest=4):
    f, n = {}, {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] = n.get(lang, 0) + len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    key = lang, tuple(words[i : i + k])
                    f[key] = f.get(key, 0) + 1
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    dropped = set()
    for (lang, long), a in found.items():
        for k in range(2, len(long)):
            for i in range(len(long) - k + 1):
                part = lang, long[i : i + k]
                if 100 * a >= subsumed * found[part]:
                    dropped.add(part)
    out = {}
    for (lang, words), a in found.items():
        if (lang, words) not in dropped:
            cuts = [(2000000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    rows = []
    for lang, own in out.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(rows)


def corpus(seed=1):
    chance = random.Random(seed)
    words = ["The", "new", "york", "times", "é", "Ünï", "of", "a b", "x-y", "　", "İx", "rare"]
    sets = ["new york times", "NEW York", "of the new york", "a a a a a", "ice cream", "ice\tcream cone", "é\x0bé é", "of the"]
    rows = []
    for i in range(400):
        parts = [chance.choice([*sets, *words, f"only{i}"]) + chance.choice([" ", "  ", ", ", "\n", " ! ", "\t", " "]) for _ in range(chance.randrange(0, 30))]
        rows.append((chance.choice(["en", "de", None, "und", ""]), "".join(parts)))
    rows += [("en", None), (None, None), ("en", ""), ("zz", " .,;\n"), ("en", "big data " * 20_000), ("fr", "mot " * 100), ("one", "x")]
    return rows


def run(spark, rows, **more):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, phrase int, n string").repartition(4)
    got = collocations.collocations(docs, **more)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("more, brutes", [({}, {}), ({"min_count": 3, "subsumed": 50}, {"least": 3, "subsumed": 50}), ({"top": 4, "min_count": 5, "longest": 3}, {"top": 4, "least": 5, "longest": 3})])
def test_equals_brute_force(spark, monkeypatch, more, brutes):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 3000)
    rows = corpus()
    want = brute(rows, **brutes)
    assert run(spark, rows, **more) == want
    assert len(want) > 10


def test_full_filters_and_split_stripes_change_nothing(spark, monkeypatch):
    rows = corpus(2)
    monkeypatch.setattr(bloom, "MOST_BITS", bloom.RANGES * 8)
    monkeypatch.setattr(collocations, "HOT_SHARE", 1000)
    monkeypatch.setattr(collocations, "MOST_HELD", 10)
    assert run(spark, rows) == brute(rows)


def test_empty_tables_and_texts_without_words(spark):
    assert run(spark, []) == []
    assert run(spark, [("en", None), (None, ""), ("en", " . ")]) == []
    assert run(spark, [("en", "lone")] * 40) == []


def test_overlaps_and_ties(spark):
    rows = [("en", "a a a " * 5)] * 10 + [("en", "b c. d c. b e")] * 30
    assert run(spark, rows) == brute(rows)


def test_equals_brute_force_on_the_tables(spark, tables_sql):
    rows = tables_sql.execute("SELECT lang, text FROM documents").fetchall()
    got = sorted(tuple(r) for r in ALL["op13_phrase_collocations"].run(spark, SMALL).collect())
    assert got == brute(rows)
    assert got
