"""Encoding with a tokenizer file, a stretch of text at a time."""

from __future__ import annotations

import functools
import os
import re
import string
import sys
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Before a space that follows a character other than white space, byte-level pre-tokenisation always cuts:
#: a space only begins a piece there, and no piece looks across it.
_CUT = re.compile(r"(?<=\S)(?= )")
_SPACES = [char for char in map(chr, range(sys.maxunicode + 1)) if char.isspace() and char != " "]
MOST_STRETCHES = 1_000_000
TOGETHER = 50  # stretches encoded as one string
_CHUNKS = 200  # strings encoded at once
_SPACE = "\u0120"  # fixed value: how byte-level vocabularies write the byte of a space


def _runs_of_spaces(text: str) -> bool:
    """Does a space stand beside other white space?"""
    return any(char in text and (char + " " in text or " " + char in text) for char in _SPACES) or "  " in text


def stretches(text: str | None) -> tuple[str, list[str]]:
    """The text cut where pre-tokenisation always cuts: the first stretch, and the others without the space
    that each begins with. An empty first stretch stands for none."""
    if not text:
        return "", []
    if _runs_of_spaces(text):
        first, *rest = _CUT.split(text)
        return (first, [part[1:] for part in rest]) if first[0] != " " else ("", [part[1:] for part in (first, *rest)])
    first, *rest = text.split(" ")
    return first, rest


class WordEncoder:
    """Encodes texts with the tokenizers library; each distinct stretch between cuts is encoded once.

    Arrow numbers the distinct stretches of a block, Python looks up only these, and the ids of all documents are
    one gather from a flat store. New stretches are encoded many to a string: a token begins with a space only
    where a stretch begins, so the ids fall apart again. A worker keeps its store for the tasks that follow; it is
    emptied when it holds MOST_STRETCHES, which costs time and changes no ids.
    """

    def __init__(self, path: str):
        self.path = path
        self._made = None

    def __reduce__(self):
        written = os.stat(self.path)
        return _of_worker, (self.path, written.st_mtime_ns, written.st_size)

    def _tokenizer(self):
        if self._made is None:
            from tokenizers import Tokenizer

            made = Tokenizer.from_file(self.path)
            made.no_padding()
            made.no_truncation()
            self._made = made
            self._added = [token.content for token in made.get_added_tokens_decoder().values()]
            self._spaced = np.zeros(made.get_vocab_size(with_added_tokens=True), bool)
            for token, i in made.get_vocab(with_added_tokens=False).items():
                self._spaced[i] = token.startswith(_SPACE)
            self._empty()
        return self._made

    def _empty(self) -> None:
        """Two tables of stretches, with and without a space before them; each stretch has its ids at an interval."""
        self._tables: tuple[dict[str, int], dict[str, int]] = {}, {}
        self._ids, self._edges = array("I"), array("q", [0])

    def vocabulary(self) -> int:
        return self._tokenizer().get_vocab_size(with_added_tokens=True)

    def encode(self, texts: list[str | None] | pa.Array, end_id: int) -> list[np.ndarray]:
        """Ids of each text with `end_id` behind them."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        tokenizer = self._tokenizer()
        if len(self._edges) > MOST_STRETCHES:
            self._empty()
        column = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")
        texts = column.to_pylist()
        # The library reads the string of an added token as that token; such a text is encoded whole.
        whole = [i for i, text in enumerate(texts) if any(own in text for own in self._added)]
        by_place = [i for i, text in enumerate(texts) if _runs_of_spaces(text)]
        odd = sorted({*whole, *by_place})
        plain = np.setdiff1d(np.arange(len(texts)), odd)
        split = pc.split_pattern(column.take(pa.array(plain)).cast(pa.large_string()), " ")
        parts, edges = split.flatten(), split.value_lengths().to_numpy().astype(np.int64).cumsum()
        lead = np.concatenate([[0], edges[:-1]]) if len(plain) else np.zeros(0, np.int64)
        rest = np.ones(len(parts), bool)
        rest[lead] = False
        codes = np.empty(len(parts), np.int64)
        codes[lead] = self._numbers(parts.take(pa.array(lead)), "")
        codes[rest] = self._numbers(parts.filter(pa.array(rest)), " ")
        out: list[np.ndarray] = [None] * len(texts)
        for i, ids in zip(plain.tolist(), self._gather(codes, edges, end_id), strict=True):
            out[i] = ids
        in_parts = sorted({*by_place} - {*whole})
        for i, (first, others) in zip(in_parts, map(stretches, [texts[i] for i in in_parts]), strict=True):
            numbers = [self._numbers(pa.array(x, pa.large_string()), a) for x, a in (([first], ""), (others, " "))]
            out[i] = self._gather(np.concatenate(numbers), np.array([1 + len(others)]), end_id)[0]
        made = tokenizer.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False)
        for i, found in zip(whole, made, strict=True):
            out[i] = np.array([*found.ids, end_id], "<u4")
        return out

    def _numbers(self, parts: pa.Array, before: str) -> np.ndarray:
        """The places of the stretches in the store; `before` is the space before each of them, or nothing."""
        table = self._tables[1 if before else 0]
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        places = list(map(table.get, distinct))
        if None in places:
            self._add(table, before, [part for part, place in zip(distinct, places, strict=True) if place is None])
            places = list(map(table.get, distinct))
        return np.array(places, np.int64)[coded.indices.to_numpy()]

    def _add(self, table: dict[str, int], before: str, new: list[str]) -> None:
        """Encode new stretches. Those with white space of their own, or none before them, are encoded alone."""
        if not before:
            return self._encode(table, before, new)
        # Letters and punctuation behind them are never one piece, so they are encoded apart.
        bodies = [part.rstrip(string.punctuation) for part in new]
        ended = [(part, body) for part, body in zip(new, bodies, strict=True) if body != part and body.isalpha()]
        apart = {part for part, _ in ended}
        missing = {part: None for part in new if part not in apart}
        missing.update((body, None) for _, body in ended if body not in table)
        self._together(table, [part for part in missing if part.split() == [part]])
        self._encode(table, before, [part for part in missing if part not in table])
        if ended:
            codes = np.empty(2 * len(ended), np.int64)
            codes[0::2] = [table[body] for _, body in ended]
            codes[1::2] = self._numbers(pa.array([part[len(body) :] for part, body in ended], pa.large_string()), "")
            ids, upto = self._join(codes)
            self._keep(table, [part for part, _ in ended], ids, upto[1::2])

    def _together(self, table: dict[str, int], parts: list[str]) -> None:
        """Stretches without white space, TOGETHER of them in one string; what does not fall apart is left out."""
        for start in range(0, len(parts), _CHUNKS * TOGETHER):
            some = parts[start : start + _CHUNKS * TOGETHER]
            chunks = [some[i : i + TOGETHER] for i in range(0, len(some), TOGETHER)]
            made = self._made.encode_batch_fast([" " + " ".join(chunk) for chunk in chunks], add_special_tokens=False)
            ids = np.concatenate([np.array(one.ids, np.uint32) for one in made])
            begins = np.flatnonzero(self._spaced[ids])
            if len(begins) == len(some) and begins[0] == 0:
                self._keep(table, some, ids, np.append(begins[1:], len(ids)))

    def _encode(self, table: dict[str, int], before: str, parts: list[str]) -> None:
        made = self._made.encode_batch_fast([before + part for part in parts], add_special_tokens=False)
        lists = [one.ids for one in made]
        ids = np.fromiter(chain.from_iterable(lists), np.uint32)
        self._keep(table, parts, ids, np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists))))

    def _keep(self, table: dict[str, int], parts: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        table.update(zip(parts, range(len(self._edges) - 1, len(self._edges) - 1 + len(parts)), strict=True))
        self._edges.frombytes((ends + len(self._ids)).astype(np.int64).tobytes())
        self._ids.frombytes(ids.astype(np.uint32).tobytes())

    def _join(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the stretches one after another, and where those of each end."""
        store, edges = np.frombuffer(self._ids, np.uint32), np.frombuffer(self._edges, np.int64)
        sizes = edges[codes + 1] - edges[codes]
        upto = sizes.cumsum()
        return store[np.repeat(edges[codes] - (upto - sizes), sizes) + np.arange(sizes.sum())], upto

    def _gather(self, codes: np.ndarray, ends: np.ndarray, end_id: int) -> list[np.ndarray]:
        """The ids of documents whose stretches end at `ends`, one after another in `codes`."""
        if not len(ends):
            return []
        ids, upto = self._join(codes)
        last = np.concatenate([[0], upto])[ends]
        return np.split(np.insert(ids, last, end_id).astype("<u4"), (last + np.arange(1, len(ends) + 1))[:-1])


@functools.lru_cache(maxsize=1)
def _of_worker(path: str, written: int, size: int) -> WordEncoder:
    """The encoder that a worker keeps, as long as the tokenizer file is the same."""
    return WordEncoder(path)
