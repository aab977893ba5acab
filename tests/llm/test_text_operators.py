"""Operators on single texts against brute force, and on nulls, empty tables, ties and clashing columns."""

import base64
import hashlib
import pickle
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidegate.llm import bpe, decontaminate, html_text, langid, license_scan, quality_model, quality_rules, token_store
from tidegate.llm.encoders import WordEncoder

LONG = "the quick brown fox jumps over a lazy dog again and again " * 400
TEXTS = [
    None, "", " ", "a", "it's we'll  do   it\n\n now\t\n", "\n lead", "trail \n", "naïve façade — ﬁn ２３ ½ 中文字符 🙂🙂 é",
    "x" * 300, "ab" * 700, "1234567890 12 3", "<|endoftext|> hi", "\x1c\x85\xa0 y z", "  two", LONG, LONG,
]
SCHEMA = "doc_id long, text string, score string, lang_pred int, n_words string, ids string, labels string"


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, text, "s", 1, "w", "i", "l") for i, text in enumerate(TEXTS)]
    rows += [rows[4], (None, "no id here", *rows[0][2:]), (None, None, *rows[0][2:])]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(rows):
    return {r.doc_id: r for r in rows if r.doc_id is not None}


def encoding():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(documents, empty):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    got = bpe.round_trip(documents, path, pattern, ids=True).collect()
    assert len(got) == documents.count()
    library = encoding()
    for i, text in enumerate(TEXTS):
        want, row = library.encode_ordinary(text or ""), by_id(got)[i]
        assert row.ids == want and row.n_tokens == len(want), text
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.round_trip(empty, path, pattern).count() == 0


def test_a_heap_merges_like_the_fold(monkeypatch):
    vocabulary = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = encoding()
    for word in ("x" * 300, "ab" * 700, "unbelievablyso", "é" * 40, "a"):
        assert bpe.merge_by_heap(word.encode(), vocabulary) == library.encode_ordinary(word)
        assert bpe.decode(bpe.merge_by_heap(word.encode(), vocabulary), vocabulary) == word.encode()


def plain_phrases(letters, train):
    """Longest-match parsing with a search of the whole text for each phrase."""
    n = at = 0
    while at < len(letters):
        end = at + 1
        while end < len(letters) and letters[at : end + 1] in train:
            end += 1
        n, at = n + 1, end
    return n


def test_cross_parsing_equals_brute_force(monkeypatch):
    sample = {"aa": "the cat sat on the mat and the dog ran", "bb": "der hund lief um das haus und die katze"}
    texts = ["the dog sat", "das haus", "cat und hund", "zzz qqq", "x", "Ж the", "the cat " * 50]
    for few in (1, 100):
        monkeypatch.setattr(langid, "FEW", few)
        model = langid.fit(sample)
        phrases, lengths = langid.count_phrases(texts, model)
        for k, lang in enumerate(model.languages):
            train = " ".join(sample[lang].split())
            for i, text in enumerate(texts):
                letters = "".join(c.lower() if c.isalpha() else " " for c in text)
                letters = "".join(c for j, c in enumerate(letters) if c != " " or j == 0 or letters[j - 1] != " ")
                assert lengths[i] == len(letters) and phrases[k, i] == plain_phrases(letters, train)


def test_languages(spark, documents, empty):
    base = [("the house and the garden of the old man", "en"), ("das haus und der garten des alten mannes", "de")]
    labelled = spark.createDataFrame([(i, *base[i % 2]) for i in range(40)] + [(90, None, "en"), (91, "x", None)], "doc_id long, text string, lang string")
    model = langid.learn(labelled)
    assert model.languages == ["de", "en"]
    names, scores = langid.classify(["the old garden", "der alte garten", "12 34", None, ""], model)
    assert names == ["en", "de", "und", "und", "und"] and scores[2:] == [0, 0, 0] and all(0 <= s <= 1 for s in scores)
    rows = langid.predict(documents, model).collect()
    assert len(rows) == documents.count()
    assert {r.lang_pred for r in rows} <= {"de", "en", "und"} and by_id(rows)[0].lang_pred == "und"
    assert langid.label(documents, model).columns == [*[c for c in documents.columns if c not in ("score", "lang_pred")], "lang_pred", "score"]
    assert langid.predict(empty, model).count() == 0
    nothing = langid.learn(labelled.where("lang = 'none'"))
    assert {r.lang_pred for r in langid.predict(documents, nothing).collect()} == {"und"}
    held = {r.doc_id: r.h for r in labelled.select("doc_id", langid.held_out().alias("h")).collect()}
    assert held == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in held}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href=/a>menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div><!-- c -->
<article><h1>Head &amp; line</h1><p>First   long paragraph &eacute; with <b>bold</b> text<br>and more of it here.
<p>Short.<form><input>Sign up</form><p>Last paragraph of the article, with &lt;tags&gt; named.</p>
<section id="comments"><p>Reader comment that is quite long and chatty, really.</p></section></article>
<aside>Side</aside><div class="ad">Buy</div><footer>&copy; x</footer>"""


def test_html(spark):
    want = "Head & line First long paragraph é with bold text and more of it here. Short. Last paragraph of the article, with <tags> named."
    assert html_text.main_text(PAGE) == want
    assert html_text.main_text(PAGE + "</body></html>") == want
    assert html_text.main_text("<p>Only one paragraph, no article at all</p>") == "Only one paragraph, no article at all"
    plain = "<body><div><a>x</a><a>y</a></div><div>" + "<p>A long paragraph with many words in it, as articles have.</p>" * 6 + "</div></body>"
    assert html_text.main_text(plain).count("paragraph") == 6 and not html_text.main_text(plain).startswith("x")
    for broken in (None, "", "<", "<div", "&", "</p></div>", "<script>var a", "<nav><p>x"):
        html_text.main_text(broken)
    pages = spark.createDataFrame([(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (None, None, None, "t")], "page_id long, url string, html string, text string")
    rows = html_text.extract(pages).collect()
    assert sorted((r.n_chars, r.text) for r in rows) == [(0, ""), (len(want), want), (len(want), want)]
    assert html_text.extract(pages.where("page_id = 7")).count() == 0


def distance(item, text):
    """Fewest edits between an item and any part of a text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(last + (a != b), row[j] + 1, row[j - 1] + 1)
    return min(row)


def test_leaks_equal_brute_force(spark):
    chance = np.random.default_rng(5)
    letters = list("abcde fghij")
    items = ["".join(chance.choice(letters, n)).strip() for n in (40, 90, 90, 150, 200)]
    items += [items[1], "", None, "short"]

    def edited(text, n):
        out = list(text)
        for _ in range(n):
            k = int(chance.integers(len(out)))
            kind = chance.integers(3)
            out[k : k + 1] = [] if kind == 0 else ["z"] if kind == 1 else [out[k], "z"]
        return "".join(out)

    texts = [None, "", "short", "a short one", "shorter"]
    for k, item in enumerate(items[:5]):
        for n in (0, 1, 2, 4, 8, 12):
            noise = "".join(chance.choice(letters, 60))
            texts.append((noise if k != 2 else "") + edited(item, n) + (noise.upper() if n % 4 else ""))
    index = decontaminate.index_items(list(enumerate(items)))
    got = {(d, i): e for d, i, e, *_ in decontaminate.search(texts, index)}
    want = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            a, b = decontaminate.normalise(item), decontaminate.normalise(text)
            if not a or not b:
                continue
            if len(a) < decontaminate.Q:
                if f" {a} " in f" {b} ":
                    want[d, i] = 0
            elif (n := distance(a, b)) <= int(len(a) * decontaminate.EDIT_RATE):
                want[d, i] = n
    assert got == want and len(want) > 15
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[6], "x")], "doc_id long, text string, item_id string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    hits = decontaminate.find_leaks(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in hits if r.doc_id is not None} == set(want)
    kept = decontaminate.without_leaks(docs, benchmark)
    leaked = {d for d, _ in want}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [d for d in range(len(texts)) if d not in leaked]
    assert decontaminate.find_leaks(docs, benchmark.where("item_id < 0")).count() == 0
    assert decontaminate.without_leaks(docs.where("doc_id < 0"), benchmark).count() == 0


def test_benchmark_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one passage of the test set number 7 here"), (2, "clean")], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"one passage of the test set number {i} here") for i in range(9)], "item_id long, text string")
    whole = sorted(decontaminate.find_leaks(docs, items).collect())
    monkeypatch.setattr(decontaminate, "ITEM_CHARS", 300)
    assert sorted(decontaminate.find_leaks(docs, items).collect()) == whole
    assert [r.doc_id for r in decontaminate.without_leaks(docs, items).collect()] == [2]


def test_quality_model(spark, documents, empty):
    good, bad = "a calm sentence about rivers and hills", "$$$ WIN!!! free$$$ CLICK!!! now***"
    texts = spark.createDataFrame([(i, (good if i % 2 else bad) + f" {i}") for i in range(200)] + [(500, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)] + [(500, 1, 0), (3, None, 0), (4, 7, 0)], "doc_id long, quality int, toxic int")
    model = quality_model.learn(texts, labels)
    scores = {r.doc_id: r.score for r in quality_model.score(texts, model).collect()}
    assert all((scores[i] > 0.5) == (i % 2 == 1) for i in range(200))
    rows = quality_model.score(documents, model).collect()
    assert len(rows) == documents.count() and all(0 <= r.score <= 1 for r in rows)
    assert by_id(rows)[0].score == by_id(rows)[1].score
    assert quality_model.score(empty, model).count() == 0
    for none in (labels.where("quality = 5"), labels.where("quality = 1")):
        constant = quality_model.learn(texts, none)
        assert len({r.score for r in quality_model.score(documents, constant).collect()}) == 1


def test_blocks_of_documents_score_alike():
    model = quality_model.fit(["good calm words", "BAD $$$"] * 5, [1, 0] * 5)
    texts = ["good words and more", "", "x", "BAD $$$ calm\nwords " * 9, "ab"]
    one = [quality_model.log_odds(*quality_model.flat_bytes(quality_model.pa.array([t])), model)[0] for t in texts]
    assert np.allclose(quality_model.log_odds(*quality_model.flat_bytes(quality_model.pa.array(texts)), model), one)


def brute_rules(text):
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_rules_equal_brute_force(spark, documents, empty):
    got = quality_rules.judge(documents).collect()
    assert len(got) == documents.count()
    for i, text in enumerate(TEXTS[:14]):
        assert tuple(by_id(got)[i])[1:6] == brute_rules(text), text
    extra = ["a b c a b c d\na b c\n\n a b c\na b c", "x y z x y", "# a\n# a\n<|>", "one two three " * 60]
    rows = quality_rules.judge(spark.createDataFrame(list(enumerate(extra)), "doc_id long, text string")).collect()
    for i, text in enumerate(extra):
        assert tuple(by_id(rows)[i])[1:6] == brute_rules(text)
        n, _, _, _, repeats = brute_rules(text)
        assert by_id(rows)[i].base_failed == (n < 50 or 100 * repeats > 50 * n)
        assert not (by_id(rows)[i].base_failed and by_id(rows)[i].kept)
    assert quality_rules.judge(empty).count() == 0


def test_the_order_of_rules_changes_nothing(spark, documents):
    rows = quality_rules.signals(documents)
    forward, back = quality_rules.cascade(quality_rules.RULES), quality_rules.cascade(quality_rules.RULES[::-1])
    verdicts = rows.select("doc_id", forward.isNull().alias("a"), back.isNull().alias("b")).collect()
    assert all(r.a == r.b for r in verdicts)
    names = [r.name for r in quality_rules.in_order(documents.select("doc_id", "text"), quality_rules.RULES)]
    assert sorted(names) == sorted(r.name for r in quality_rules.RULES)
    plan = quality_rules.judge(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan


@pytest.mark.parametrize("width", [1, 5, 8, 11, 16, 17, 31, 32])
def test_packing(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1000, np.uint64).astype(np.uint32)
    packed = token_store.pack(ids, width)
    assert len(packed) == -(-1000 * width // 8)
    assert (token_store.unpack(packed, width, 0, 1000) == ids).all()
    assert (token_store.unpack(packed, width, 123, 457) == ids[123:457]).all() and len(token_store.unpack(packed, width, 9, 9)) == 0


def test_strings_of_special_tokens_are_read_as_the_library_reads_them():
    file = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, encoder = Tokenizer.from_file(file), WordEncoder(file)
    texts = ["hello <|endoftext|> x", "a<|endoftext|>b c", " <|endoftext|>,, z", "word<|endoftext|>", "  <|endoftext|>  \n y", "<|endoftext |>", "hello x"]
    assert encoded(encoder, texts) == [[*tokenizer.encode(text, add_special_tokens=False).ids, 0] for text in texts]


def encoded(encoder, texts):
    return [ids.tolist() for ids in encoder.encode(texts, 0)]


def test_odd_texts_are_encoded_as_by_the_library(monkeypatch):
    file = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, encoder = Tokenizer.from_file(file), WordEncoder(file)
    monkeypatch.setattr("tidegate.llm.encoders.MOST_STRETCHES", 3000)
    chance = np.random.default_rng(8)
    pieces = [" ", " ", " ", "  ", "\n", "\t", "\x85", "\xa0", "　", "a", "it's", "won't", "é", "中文", "🙂", "12", "3.5", ",", "...", "<|endoftext|>", "x" * 30, "ﬁ", "e\u0301", "\u200b"]
    for _ in range(20):
        texts = ["".join(chance.choice(pieces, chance.integers(0, 12))) for _ in range(200)]
        assert encoded(encoder, texts) == [[*tokenizer.encode(text, add_special_tokens=False).ids, 0] for text in texts]


def test_an_encoder_that_is_sent_keeps_its_stretches():
    file = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(file)
    first, second = (pickle.loads(pickle.dumps(WordEncoder(file))) for _ in range(2))
    assert first is second
    for texts in (["one two, three", None, " one"], ["three, two one", "", "two\u00a0 three"], []):
        want = [[*tokenizer.encode(text or "", add_special_tokens=False).ids, 7] for text in texts]
        assert [ids.tolist() for ids in second.encode(texts, 7)] == want


def test_token_store_equals_the_library(spark, documents, empty, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_BYTES", 3000)
    file = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(file)
    path = token_store.write_tokens(documents, file)
    rows = token_store.document_spans(spark, path).collect()
    assert len(rows) == documents.count()
    texts = [None, "no id here"] if sum(r.doc_id is None for r in rows) == 2 else []
    assert len(texts) == 2
    start, ordered = 0, sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in ordered if r.doc_id is not None] == sorted(r.doc_id for r in rows if r.doc_id is not None)
    for r in ordered:
        assert r.start == start
        start += r.n_tokens
        if r.doc_id is not None:
            ids = tokenizer.encode(TEXTS[r.doc_id] or "", add_special_tokens=False).ids + [0]
            assert (r.n_tokens, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    single = token_store.read_documents(spark, path, [7, 14])
    assert single[7].tolist() == tokenizer.encode(TEXTS[7], add_special_tokens=False).ids + [0] and set(single) == {7, 14}
    assert token_store.document_spans(spark, token_store.write_tokens(empty, file)).count() == 0


def test_licences(spark, documents, empty):
    rows = [
        (1, "MIT License, mit  license; Apache License, Version 2.0"), (2, "SPDX-License-Identifier: GPL-3.0-or-later"),
        (3, "émit license mit licenseé xmit license"), (4, "Licensed under CC BY-NC-SA 4.0. All rights reserved."),
        (5, "the GNU General Public License v2, see LICENSE"), (6, "mit license " * 500), (7, "BSD 3-clause"),
    ]
    got = by_id(license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert tuple(got[1])[1:] == (9, 3, 0, 4, "apache,mit", "apache,apache-2.0,mit", 0.8)
    assert (got[2].labels, got[2].n_base, got[2].first_word, got[2].score) == ("gpl-3.0+", 0, None, 1.0)
    assert got[3].n_base == 0 and got[4].labels == "cc-by-nc-sa-4.0,proprietary"
    assert got[5].labels == "gpl,gpl-2.0" and got[5].first_word == 2
    assert (got[6].n_words, got[6].n_base, got[6].last_word) == (1000, 500, 998) and got[7].labels == "bsd-3-clause"
    rows = license_scan.scan(documents).collect()
    assert len(rows) == documents.count()
    assert tuple(by_id(rows)[0])[1:] == (0, 0, None, None, "", "", 0.0)
    assert license_scan.scan(empty).count() == 0
    assert len(license_scan.read_rules()) > 200
    plan = license_scan.scan(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan
