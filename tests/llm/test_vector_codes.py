"""Vector codes against plain comparison of all entries, and the bounds against what they promise."""

import math

import numpy as np
import pytest
from tidegate.llm import vector_codes as vc


def brute(rows, parts=16, entries=64, rounds=2):
    """rows: (id, vector, label); whole-number k-means without any bound."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    first = sorted((i, v) for i, v, _ in kept)[:entries]
    book = [[tuple(v[p * width : (p + 1) * width]) for _, v in first] for p in range(parts)]

    def nearest(x, own):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(own))

    for _ in range(rounds):
        groups = {}
        for own in cut:
            for p, x in enumerate(own):
                groups.setdefault((p, nearest(x, book[p])[1]), []).append(x)
        for (p, k), members in groups.items():
            book[p][k] = tuple(sum(c) // len(members) for c in zip(*members, strict=True))
    out = []
    for (i, _, label), own in zip(kept, cut, strict=True):
        found = [nearest(x, book[p]) for p, x in enumerate(own)]
        out.append([i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label])
    totals = {}
    for _, _, error, label in out:
        totals[label] = totals.get(label, 0) + error
    return sorted((i, code, error, totals[label]) for i, code, error, label in out), book


def vectors(n, width, spread, seed=3):
    chance = np.random.default_rng(seed)
    centres = chance.normal(0, 1, (20, width))
    near = centres[chance.integers(0, 20, n)] + chance.normal(0, spread, (n, width))
    return near.astype(np.float32).tolist()


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, id string").repartition(3)


@pytest.mark.parametrize("width, spread", [(32, 0.1), (64, 0.6), (16, 0.01)])
def test_equals_brute_force(spark, width, spread):
    rows = [(7 * k, v, None if k % 5 == 0 else k % 3) for k, v in enumerate(vectors(500, width, spread))]
    rows += [(9000 + k, rows[3][1], 1) for k in range(100)]  # copies, and ties between equal entries
    rows += [(1, None, 1), (2, [None] * width, 1), (3, [float("nan")] * width, 1), (4, [float("inf")] * width, 1), (5, [0.5] * (width - 1), 1), (6, [], 2)]
    want, book = brute([r for r in rows if r[1] and len(r[1]) == width])
    got = vc.coded(frame(spark, rows)).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == want
    assert {r.codebooks_sha256 for r in got} == {vc.book_digest(np.array(book))}


def test_few_rows_repeated_ids_null_ids_and_whole_numbers(spark):
    rows = [(3, [1.0] * 16, 1), (3, [1.0] * 16, 1), (None, [2.0] * 16, None), (None, [-5000.25] * 16, None), (9, [-0.001] * 16, 2)]
    got = sorted(((r.vec_id or -1), r.code[:2], r.error) for r in vc.coded(frame(spark, rows)).collect())
    assert len(got) == 5
    assert {x[1] for x in got} <= {"00", "01", "02"}
    kept, book = vc.vector_codes(frame(spark, rows))
    assert book.shape == (16, 3, 1)


def test_empty_table_and_sizes_beyond_the_bound(spark):
    assert vc.coded(frame(spark, [])).collect() == []
    assert vc.coded(frame(spark, [(1, None, 1), (2, [], 1)])).collect() == []
    rows = [(1, [1e30] * 16, 1), (2, [1e5] * 16, 1), (3, [-1e5] * 16, 1)]
    assert sorted((r.vec_id, r.error) for r in vc.coded(frame(spark, rows)).collect()) == [(2, 0), (3, 0)]


@pytest.mark.parametrize("seed", range(6))
def test_bounds_never_change_a_code(seed):
    """Entries that move at will: codes by bounds equal codes by all distances, and bounds stay below distances."""
    chance = np.random.default_rng(seed)
    parts, entries, width, n = 4, 24, 3, 400
    x = chance.integers(-40, 40, (n * parts, width))
    part = np.tile(np.arange(parts), n)
    book = chance.integers(-40, 40, (parts, entries, width))
    bounds = vc.Bounds.compared(x, book, part, 6)
    skipped = 0
    for turn in range(6):
        before, book = book, book + chance.integers(-6, 7, book.shape) // (turn + 1)
        step = vc._up_root(((book - before) ** 2).sum(axis=2))
        bounds, needed, far = bounds.moved(x, book, part, step)
        exact = ((x[:, None, :] - book[part]) ** 2).sum(axis=2)
        assert (bounds.code == exact.argmin(axis=1)).all()
        assert (far == exact.min(axis=1)).all()
        roots = np.sqrt(exact)
        assert (bounds.low <= np.take_along_axis(roots, bounds.near, axis=1)).all()
        listed = np.zeros_like(roots, bool)
        np.put_along_axis(listed, bounds.near, True, axis=1)
        listed[np.arange(len(x)), bounds.code] = True
        assert (np.where(listed, np.inf, roots).min(axis=1) >= bounds.outer).all()
        bounds = bounds.kept(max(3, needed))
        skipped += needed < entries - 1
    assert skipped


def test_b_follows_what_was_needed(spark):
    rows = [(k, v, 0) for k, v in enumerate(vectors(600, 16, 0.02))]
    kept = vc.whole_vectors(frame(spark, rows).selectExpr("vec_id AS id", "cast(label AS string) AS label", "embedding AS vector"))
    book = vc.first_entries(kept)
    state = vc.assign_all(kept, book)
    assert {len(r.near) for r in state.select("near").collect()} == {16 * 16 * 2}
    again = vc.reassign(state, book, book)
    assert {len(r.near) for r in again.select("near").collect()} <= {16 * b * 2 for b in range(8, 17)}
    assert max(len(r.near) for r in again.select("near").collect()) < 16 * 16 * 2
