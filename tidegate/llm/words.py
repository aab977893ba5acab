"""Words of many documents as one flat array of bytes, and hashes of any run of words."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence
from typing import NamedTuple

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_HASHED_AT_ONCE = 1 << 18  # bytes; what is made of them takes some 40 times as much


@functools.lru_cache(maxsize=2)  # for the letters of a word and for the words
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for 2**bits places."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.full(1 << bits, base, np.uint64)
        powers[0] = 1
        out.append(np.cumprod(powers, dtype=np.uint64))
    return out[0], out[1]


class Words(NamedTuple):
    data: np.ndarray  # the words of each text joined by one space, texts ended by a line feed
    begin: np.ndarray  # first byte of each word
    end: np.ndarray  # byte after each word
    text: np.ndarray  # number of the text of each word
    first: np.ndarray  # first word of each text, and the number of all words


def ascii_words(text: str | bytes | None) -> list[bytes]:
    """Maximal runs of characters other than U+0020 and U+0009 to U+000D, as UTF-8."""
    if text is None:
        return []
    return (text if isinstance(text, bytes) else text.encode()).split()


def flat_words(texts: Iterable[list[bytes]]) -> Words:
    """The words of texts that are already split; texts that come one by one need not be held as lists of words."""
    return joined_words([b" ".join(words) for words in texts])


def joined_words(texts: Sequence[bytes]) -> Words:
    """The words of texts that hold no other white space than one space between two words."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero((data == 32) | (data == 10))
    starts = np.concatenate([[0], ends[:-1] + 1])
    real = ends > starts  # a text without a word leaves only its line feed
    last = data[ends] == 10
    text = (np.cumsum(last) - last)[real]
    return Words(data, starts[real], ends[real], text, np.searchsorted(text, np.arange(len(texts) + 1)))


def _word_hashes(data: np.ndarray, begin: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the words that begin at `begin`, the first at 0."""
    separator = (data == 32) | (data == 10)
    place = np.arange(len(data))
    place -= np.maximum.accumulate(np.where(separator, place + 1, 0))
    value = (data.astype(np.uint64) + np.uint64(1)) * powers[np.maximum(place, 0)]
    value[separator] = 0
    return np.add.reduceat(value, begin)


def prefix_hashes(words: Words) -> np.ndarray:
    """Polynomial hashes of the first 0, 1, ... words."""
    powers, _ = _powers(max(int((words.end - words.begin).max(initial=0)), 1).bit_length())
    own = np.empty(len(words.begin), np.uint64)
    done = 0
    while done < len(own):
        low = words.begin[done]
        upto = max(int(np.searchsorted(words.end, low + _HASHED_AT_ONCE)), done + 1)
        own[done:upto] = _word_hashes(words.data[low : words.end[upto - 1]], words.begin[done:upto] - low, powers)
        done = upto
    own = (own ^ (own >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    powers, _ = _powers(max(len(own), 1).bit_length())
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * powers[: len(own)], dtype=np.uint64)])


def run_hashes(upto: np.ndarray, begin: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words from `begin`, mixed so that their order is as good as random."""
    _, inverse = _powers(max(len(upto) - 1, 1).bit_length())
    out = (upto[begin + n] - upto[begin]) * inverse[begin]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        out = (out ^ (out >> np.uint64(shift))) * np.uint64(factor)
    return out ^ (out >> np.uint64(31))
