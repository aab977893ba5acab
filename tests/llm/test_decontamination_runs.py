"""Counting of shared q-grams where characters repeat."""

import collections
import subprocess
import sys

import numpy as np
import pytest

from tidegate.llm import decontaminate

BIG = """
import resource
from tidegate.llm import decontaminate
index = decontaminate.index_items([(1, "-" * 1000), (2, "x" * 500 + "-" * 500), (3, "-=" * 400)])
got = decontaminate.search(["-" * 1_000_000, "-=" * 200_000], index)
assert [(d, i, e) for d, i, e, *_ in got] == [(0, 0, 0), (1, 2, 0)], got
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)
"""


def brute_bands(text, index):
    """Bands of every item that share enough q-grams, by all pairs of places."""
    grams = collections.defaultdict(list)
    for at in range(len(text) - decontaminate.Q + 1):
        grams[text[at : at + decontaminate.Q]].append(at)
    longest, out = int(index.sizes.max()), set()
    for i, item in enumerate(index.texts):
        width, shared = 2 * int(index.edits[i]) + 1, collections.Counter()
        for place in range(len(item) - decontaminate.Q + 1):
            for at in grams.get(item[place : place + decontaminate.Q], ()):
                band = (at - place + longest) // width
                shared.update([band, band - 1] if band else [band])
        for band, n in shared.items():
            if n >= index.bounds[i]:
                out.add((i, band * width - longest, (band + 2) * width - 1 - longest))
    return out


@pytest.mark.parametrize("piece", [7, 100, 500_000])
def test_counts_by_runs_equal_counts_by_places(monkeypatch, piece):
    monkeypatch.setattr(decontaminate, "PIECE", piece)
    chance = np.random.default_rng(3)
    parts = ["-" * 30, "-=" * 25, "abc" * 15, "| | | ", "a plain passage of words", "-", "=", "other words here", "-" * 12]
    items = ["".join(chance.choice(parts, 5)) for _ in range(12)] + ["-" * 60, "-=" * 40, "abc" * 30]
    index = decontaminate.index_items([(i, t) for i, t in enumerate(items)])
    for _ in range(4):
        text = decontaminate.normalise("".join(chance.choice(parts, 25)) + items[3] + "-" * 90 + items[7])
        got = [row for bands in decontaminate._bands(decontaminate._points(text), index) for row in zip(*(x.tolist() for x in bands), strict=True)]
        assert len(got) == len(set(got)) and set(got) == brute_bands(text, index) and got


def test_repeated_characters_stay_within_memory():
    done = subprocess.run([sys.executable, "-c", BIG], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 500 * 1024
