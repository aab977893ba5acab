"""Language models of large alphabets."""

import tracemalloc

import numpy as np
import pytest

from tidegate.llm import langid


def phrases_of(letters, train):
    n = at = 0
    while at < len(letters):
        end = at + 1
        while end < len(letters) and letters[at : end + 1] in train:
            end += 1
        n, at = n + 1, end
    return n


@pytest.mark.parametrize("few", [1, 100])
def test_samples_of_many_letters_equal_brute_force(monkeypatch, few):
    monkeypatch.setattr(langid, "FEW", few)
    chance = np.random.default_rng(8)
    han = "".join(chr(0x4E00 + int(x)) for x in chance.zipf(1.3, 6000) % 3000)
    hangul = "".join(chr(0xAC00 + int(x)) for x in chance.integers(0, 2000, 4000))
    sample = {"zh": han, "ko": hangul, "en": "the cat sat on the mat and the dog ran " * 3}
    model = langid.fit(sample)
    assert len(model.alphabet) > 2000
    assert model.to.nbytes + model.owner.nbytes < 16_000_000
    texts = [han[50:90] + han[700:740], hangul[5:60], "the dog sat", "猫 the cat", "Ж" + hangul[:9], "x", *[han[i : i + 20] for i in range(30)]]
    got, lengths = langid.count_phrases(texts, model)
    for k, lang in enumerate(model.languages):
        for i, text in enumerate(texts):
            assert lengths[i] == len(text) and got[k, i] == phrases_of(text, sample[lang])
    assert langid.classify(texts[:3], model)[0] == ["zh", "ko", "en"]


def test_long_labelled_documents_teach(spark):
    base = {"en": "the house and the garden of the old man ", "de": "das haus und der garten des alten mannes "}
    rows = [(k, ("7 " * 30_000 if k % 2 else "") + text * 900, lang) for k, (lang, text) in enumerate(list(base.items()) * 2)]
    rows += [(10 + k, "der hund und die katze des mannes " * 2, "nl") for k in range(5)]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en", "nl"]
    assert langid.classify(["the old garden", "der alte garten"], model)[0] == ["en", "de"]


def test_texts_with_a_letter_stay_where_no_language_was_learned(spark):
    rows = [(1, "the house", None), (2, "12 3", None), (3, None, None), (4, "猫", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in langid.known_language(docs, langid.learn(docs)).collect()) == [1, 4]


def test_automata_take_little_memory():
    """They are built in the driver; a dictionary for each state of all languages took 39 MB here."""
    chance = np.random.default_rng(2)
    sample = {lang: "".join(chance.choice(list("abcdefghij "), 8000)) for lang in "vwxyz"}
    langid.fit({"v": "ab"})
    tracemalloc.start()
    langid.fit(sample)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 20_000_000, most
