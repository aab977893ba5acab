"""Language identification by cross-parsing entropy.

For each language a suffix automaton of a bounded sample of labelled text is built. A document is parsed
against each of them: a phrase is the longest piece that occurs in the language's text, then the next phrase
begins. Few phrases mean that the text is like the language. The count is normalised as the cross-parsing
entropy c * log2(N) / n with N characters of labelled text and n of the document; the lowest wins, ties go
to the language first in order.

Defined results: a null text, or one without a letter, is `und` with score 0. Without any labelled text all
documents are `und`. A null language label or text teaches nothing; of a long one a piece does. Letters are compared in lower case; a
run of other characters counts as one space. Repeated rows and ids are predicted one by one; other columns
of the input are not read.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.blocks import give_back, text_blocks

UNKNOWN = "und"
DOCS_PER_LANGUAGE = 200  # bound of the labelled sample, documents
CHARS_PER_LANGUAGE = 25_000  # and its characters after normalisation
LONGEST_PIECE = 20_000  # of a labelled document so many characters from its first letter on are taken
BLOCK_BYTES = 10_000_000
FEW = 24  # below so many documents in step, plain loops are faster than numpy


class LanguageModel(NamedTuple):
    languages: list[str]
    alphabet: list[str]  # codes from 1; 0 is the space, the last code any other letter
    to: np.ndarray  # at state + code: the state that follows if `owner` there is the state; else no such piece goes on
    owner: np.ndarray
    roots: np.ndarray  # (language, code) -> state of a phrase that starts with the code; a dead end if none does
    chars: np.ndarray  # characters of labelled text of each language


@functools.cache
def _lower_letters() -> np.ndarray:
    """For each code point the lower-case letter, 0 for what isn't a letter."""
    table = np.zeros(sys.maxunicode + 1, np.int32)
    for point in range(sys.maxunicode + 1):
        char = chr(point)
        if char.isalpha():
            table[point] = ord(char.lower()[0])
    return table


def _letters(text: str) -> np.ndarray:
    """Lower-case letters as code points, any other run as one 0."""
    points = _lower_letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    space = points == 0
    space[1:] &= space[:-1].copy()
    space[:1] = False
    return points[~space]


def _suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts exactly the pieces of `codes`; state 0 is the root."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for code in codes:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and code not in moves[at]:
            moves[at][code] = new
            at = link[at]
        if at >= 0:
            to = moves[at][code]
            if length[at] + 1 == length[to]:
                link[new] = to
            else:
                copy = len(moves)
                moves.append(dict(moves[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                while at >= 0 and moves[at].get(code) == to:
                    moves[at][code] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return moves


class _Moves(NamedTuple):
    """The transitions of an automaton as arrays; a dictionary for each state takes some ten times as much."""

    edges: np.ndarray  # where the transitions of each state start, and the number of all
    codes: np.ndarray  # sorted in each state
    to: np.ndarray


def _arrays(moves: list[dict[int, int]]) -> _Moves:
    sizes = np.fromiter(map(len, moves), np.int64, len(moves))
    n = int(sizes.sum())
    codes = np.fromiter(chain.from_iterable(moves), np.int32, n)
    to = np.fromiter(chain.from_iterable(move.values() for move in moves), np.int32, n)
    order = np.lexsort((codes, np.repeat(np.arange(len(moves)), sizes)))
    return _Moves(np.concatenate([[0], np.cumsum(sizes)]), codes[order], to[order])


def _packed(automata: list[_Moves], width: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """All transitions in one array: `to` and `owner` at state + code, and the new number of each state.

    A state's number is a place of its own such that its codes fall on free entries, so the size follows the
    transitions and not states times letters. Number 0 has no transition.
    """
    counts = [np.diff(moves.edges) for moves in automata]
    first = np.concatenate([[0], np.cumsum([len(own) for own in counts], dtype=np.int64)])
    numbers = [np.zeros(len(own), np.int64) for own in counts]
    taken, used, low = bytearray(width), bytearray(width), 0
    used[0] = 1
    for state in np.argsort(-np.concatenate([*counts, np.zeros(0, np.int64)]), kind="stable"):
        k = int(np.searchsorted(first, state, side="right")) - 1
        state -= first[k]
        moves = automata[k]
        codes = moves.codes[moves.edges[state] : moves.edges[state + 1]].tolist()
        ends = not codes
        codes = codes or [0]
        at, tries = low, 0
        while True:
            at = used.find(0, at) if ends else taken.find(0, at)
            if at < 0 or at - codes[0] + width >= len(taken):
                size = len(taken)
                taken.extend(bytes(size + width))
                used.extend(bytes(size + width))
                at = max(low, 0) if at < 0 else at
                continue
            number = at - codes[0]
            if number > 0 and not used[number] and (ends or not any(taken[number + c] for c in codes)):
                break
            at, tries = at + 1, tries + 1
        if tries > 50 and not ends:
            low = at  # few entries below are free
        used[number] = 1
        numbers[k][state] = number
        if not ends:
            for c in codes:
                taken[number + c] = 1
    to, owner = np.full(len(taken), -1, np.int32), np.full(len(taken), -1, np.int32)
    for moves, number in zip(automata, numbers, strict=True):
        at = np.repeat(number, np.diff(moves.edges))
        to[at + moves.codes], owner[at + moves.codes] = number[moves.to], at
    return to, owner, numbers


def fit(sample: dict[str, str]) -> LanguageModel:
    """The model of some text per language."""
    languages = sorted(lang for lang, text in sample.items() if any(map(str.isalpha, text)))
    letters = {lang: _letters(sample[lang])[:CHARS_PER_LANGUAGE] for lang in languages}
    alphabet = sorted({chr(p) for points in letters.values() for p in np.unique(points) if p})
    width = len(alphabet) + 2
    code = {ord(char): i + 1 for i, char in enumerate(alphabet)} | {0: 0}
    automata = [_arrays(_suffix_automaton([code[int(p)] for p in letters[lang]])) for lang in languages]
    to, owner, numbers = _packed(automata, width)
    # State 0 is the dead end: a character that the language's text lacks is a phrase of its own.
    roots = np.zeros((len(languages), width), np.int32)
    for root, moves, number in zip(roots, automata, numbers, strict=True):
        root[moves.codes[: moves.edges[1]]] = number[moves.to[: moves.edges[1]]]
    give_back()
    return LanguageModel(languages, alphabet, to, owner, roots, np.array([len(letters[lang]) for lang in languages], float))


def learn(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Fit on a bounded sample: about DOCS_PER_LANGUAGE documents of each language, picked by a hash of id and text."""
    known = labelled.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.where(F.col("text").rlike(r"\p{L}"))
    # Places on a ring of ids: each language keeps the share of the ring that holds about as many as it needs.
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / float(1 << 20)
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    known = known.withColumn("place", place)
    share = known.join(F.broadcast(counts), "lang").where(F.col("place") * F.col("n") <= 2.0 * DOCS_PER_LANGUAGE)
    piece = F.substring(F.regexp_replace("text", r"^\P{L}+", ""), 1, LONGEST_PIECE)
    share = share.withColumn("text", F.when(F.length("text") > LONGEST_PIECE, piece).otherwise(F.col("text")))
    sample: dict[str, list[str]] = {}
    room: dict[str, list[int]] = {}
    for row in sorted(share.select("lang", "text", "place").collect(), key=lambda r: (r.lang, r.place, r.text)):
        left = room.setdefault(row.lang, [DOCS_PER_LANGUAGE, 2 * CHARS_PER_LANGUAGE])
        if min(left) > 0:
            sample.setdefault(row.lang, []).append(row.text)
            left[0] -= 1
            left[1] -= len(row.text)
    return fit({name: "\n".join(texts) for name, texts in sample.items()})


def _codes(texts: list[str], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts one after another, and where each starts (one more entry: the end)."""
    code = np.full(sys.maxunicode + 1, len(model.alphabet) + 1, np.int32)
    code[0] = 0
    code[[ord(char) for char in model.alphabet]] = np.arange(1, len(model.alphabet) + 1)
    parts = [code[_letters(text)] for text in texts]
    return np.concatenate([*parts, np.zeros(0, np.int32)]), np.cumsum([0, *map(len, parts)])


def count_phrases(texts: list[str], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """(languages x texts) phrases, and characters of each text after normalisation.

    All texts and languages advance in step, one character at a time; a text that ends drops out.
    """
    flat, starts = _codes(texts, model)
    lengths = np.diff(starts)
    order = np.argsort(-lengths, kind="stable")
    first, size = starts[:-1][order], lengths[order]
    table, owner, roots = model.to, model.owner, model.roots
    phrases = np.zeros((len(model.languages), len(texts)), np.int64)
    active = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right")
    state = np.zeros((len(model.languages), len(texts)), np.int64)
    if len(active):
        state[:, : active[0]] = roots[:, flat[first[: active[0]]]]
    step = 1
    while step < len(active) and active[step] >= FEW:
        k = active[step]
        char = flat[first[:k] + step].astype(np.int64)
        at = state[:, :k] + char
        ended = owner[at] != state[:, :k]
        phrases[:, :k] += ended
        state[:, :k] = np.where(ended, roots[:, char], table[at])
        step += 1
    if step < len(active):
        plain, owners = memoryview(table), memoryview(owner)
        for at in range(active[step]):
            chars = flat[first[at] + step : first[at] + size[at]].tolist()
            for lang in range(len(model.languages)):
                now, n, again = int(state[lang, at]), 0, roots[lang].tolist()
                for char in chars:
                    if owners[now + char] == now:
                        now = plain[now + char]
                    else:
                        n += 1
                        now = again[char]
                phrases[lang, at] += n
    out = np.empty_like(phrases)
    out[:, order] = phrases + (size > 0)
    return out, lengths


def classify(texts: list[str | None], model: LanguageModel) -> tuple[list[str], list[float]]:
    """The winning language of each text and its score: 1 - (its entropy / that of the second)."""
    known = [text if text is not None and any(map(str.isalpha, text)) else "" for text in texts]
    if not model.languages:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    phrases, lengths = count_phrases(known, model)
    entropy = phrases * np.log2(np.maximum(model.chars, 2))[:, None] / np.maximum(lengths, 1)
    best = entropy.argmin(axis=0)
    ranked = np.sort(entropy, axis=0)
    score = 1 - ranked[0] / np.maximum(ranked[1], 1e-12) if len(ranked) > 1 else np.ones(len(texts))
    names = [model.languages[b] if text else UNKNOWN for b, text in zip(best, known, strict=True)]
    return names, [float(s) if text else 0.0 for s, text in zip(score, known, strict=True)]


def label(documents: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """All rows and columns with lang_pred and score; columns of these names are replaced."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded by CHARS_PER_LANGUAGE a language
    rows = documents.drop("lang_pred", "score")
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, BLOCK_BYTES, text):
            names, scores = classify(block.column(text).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [*block.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema.fieldNames()
            )

    return rows.mapInArrow(run, schema)


def known_language(documents: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows, all columns, whose language is told; those that are UNKNOWN go.

    Where no language was learned, only rows without a letter go.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded by CHARS_PER_LANGUAGE a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, BLOCK_BYTES, text):
            texts = block.column(text).to_pylist()
            if shared.value.languages:
                known = [name != UNKNOWN for name in classify(texts, shared.value)[0]]
            else:
                known = [x is not None and any(map(str.isalpha, x)) for x in texts]
            yield block.filter(pa.array(known, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def predict(documents: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every document; only its text is looked at."""
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return label(rows, model).select("doc_id", "lang_pred", "score")


def held_out(doc_id: str = "doc_id"):
    """The rows that nothing is learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2
