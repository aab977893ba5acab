"""Vector codes: each part of a vector becomes the index of its nearest codebook entry, assigned with adaptive bounds.

Components are whole numbers, floor(256 * x), so distances are exact. Codebooks are trained by rounds of
assigning every part and moving every entry to the mean of its parts. The first pass compares a part with all
entries. It persists, besides the assigned entry, the part's b next closest entries with a lower bound of the
distance to each, and one outer bound for all entries that are not listed. In later passes the bounds
shrink by what the entries have moved. A part whose distance to its own entry is below all of them keeps the entry;
else only the entries before the first bound that is large enough are compared, by their whole-number
distances, and all entries only if the outer bound is reached. b starts at a quarter of the entries and follows, per
block, the largest number of bounds that the block has needed, an eighth of the entries at least. Bounds are rounded
down and distances up, so neither rounding nor a tie can change a code.

Means are sums over tasks: a task sends one row of sums and counts per part and entry, whatever its vectors.
Each pass writes its table to the shared folder, and the next one reads it.

Defined results: a vector that is null or holds a null or non-finite component is dropped; so is one whose
length differs from the most frequent length that is a positive multiple of the parts (ties: the longer), and one
with a component of such a size that an error could leave 64 bits (about 700,000 at 64 dimensions). Repeated rows and
ids stay and are coded each; entries start from the rows smallest by id and then by components, never from a row
without an id. With fewer rows than entries there are as many entries. A null label is a label of its own. Columns that
are not named are not read. No row kept: no row, no codebook.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.stages import stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
BLOCK_ROWS = 2048
_ROWS = "id long, label string, parts array<long>"
_STATE = f"{_ROWS}, code binary, near binary, low binary, outer binary"


def whole_vectors(rows: DataFrame, parts: int = PARTS) -> DataFrame:
    """(id, label, parts) of the vectors (id, label, vector) that can be coded, with whole components."""
    finite = rows.where(F.col("vector").isNotNull()).withColumn("vector", F.col("vector").cast("array<double>"))
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    finite = finite.where(F.forall("vector", good)).where((F.size("vector") > 0) & (F.size("vector") % parts == 0))
    lengths = finite.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"))
    chosen = lengths.orderBy(F.desc("n"), F.desc("length")).limit(1).first()
    length = chosen.length if chosen else parts
    most = isqrt((2**63 - 1) // (4 * length)) - 1
    fits = finite.where(F.size("vector") == length).where(F.forall("vector", lambda x: F.abs(x * SCALE) < float(most)))
    return fits.select("id", "label", F.transform("vector", lambda x: F.floor(x * SCALE).cast("long")).alias("parts"))


def first_entries(rows: DataFrame, entries: int = ENTRIES, parts: int = PARTS) -> np.ndarray:
    """The codebooks before the first round, (parts, entries, components); `entries` rows at most reach the driver."""
    first = rows.where("id IS NOT NULL").orderBy("id", "parts").limit(entries).select("parts").collect()
    if not first:
        return np.zeros((parts, 0, 0), np.int64)
    own = np.array([r.parts for r in first], np.int64).reshape(len(first), parts, -1)
    return np.ascontiguousarray(own.transpose(1, 0, 2))


def squares(x: np.ndarray, book: np.ndarray, part: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Exact squared distance of each part to one entry of its position's codebook."""
    differ = x - book[part, entry]
    return np.einsum("ij,ij->i", differ, differ)


def _down(x: np.ndarray) -> np.ndarray:
    """As a float32 that is not larger."""
    near = x.astype(np.float32)
    return np.where(near > x, np.nextafter(near, np.float32(-np.inf)), near).astype(np.float32)


def _up_root(x: np.ndarray) -> np.ndarray:
    """A number that is not below the root."""
    return np.sqrt(x.astype(np.float64)) * (1 + 1e-12)


def _down_root(x: np.ndarray) -> np.ndarray:
    return _down(np.sqrt(x.astype(np.float64)) * (1 - 1e-12))


class Bounds:
    """What is known of each part: its entry, its near entries with lower bounds in ascending order, the outer bound."""

    def __init__(self, code: np.ndarray, near: np.ndarray, low: np.ndarray, outer: np.ndarray):
        self.code, self.near, self.low, self.outer = code, near, low, outer

    @classmethod
    def compared(cls, x: np.ndarray, book: np.ndarray, part: np.ndarray, b: int) -> Bounds:
        """By the distances to all entries."""
        k = book.shape[1]
        far = np.empty((len(x), k), np.int64)
        for p in np.unique(part).tolist():
            own = part == p
            differ = x[own][:, None, :] - book[p][None]
            far[own] = np.einsum("ijk,ijk->ij", differ, differ)
        code = far.argmin(axis=1)  # the first of equal ones
        near = np.zeros((len(x), 0), np.int64)
        outer = np.full(len(x), np.inf, np.float32)
        b = min(b, k - 1)
        order = np.argsort(far, axis=1, kind="stable")  # the assigned entry comes first
        near = order[:, 1 : b + 1]
        low = _down_root(np.take_along_axis(far, near, axis=1))
        if k > b + 1:
            outer = _down_root(far[np.arange(len(x)), order[:, b + 1]])
        return cls(code, near, low, outer)

    def moved(self, x: np.ndarray, book: np.ndarray, part: np.ndarray, step: np.ndarray) -> tuple[Bounds, int, np.ndarray]:
        """After the entries moved by `step` (parts, entries): new bounds, the most bounds that a part needed, and
        the exact squared distances."""
        rows, b = np.arange(len(x)), self.near.shape[1]
        own = squares(x, book, part, self.code)
        reach = _up_root(own)
        low = _down(self.low - step[part[:, None], self.near])
        outer = _down(self.outer - step.max(axis=1, initial=0)[part])
        # A part of the list is safe from where on no bound, the outer one included, is within reach.
        least = np.minimum.accumulate(np.concatenate([low, outer[:, None]], axis=1)[:, ::-1], axis=1)[:, ::-1]
        needed = (least <= reach[:, None]).sum(axis=1)
        whole = needed > b
        code, near, best = self.code.copy(), self.near.copy(), own.copy()
        for j in range(min(int(needed[~whole].max(initial=0)), b)):
            some = rows[~whole & (needed > j)]
            entry = near[some, j]
            far = squares(x[some], book, part[some], entry)
            better = (far < best[some]) | ((far == best[some]) & (entry < code[some]))
            low[some, j] = _down_root(far)
            swap = some[better]
            near[swap, j], low[swap, j] = code[swap], _down_root(best[swap])
            code[swap], best[swap] = entry[better], far[better]
        some = rows[~whole & (needed > 0)]
        order = np.argsort(low[some], axis=1, kind="stable")
        near[some], low[some] = np.take_along_axis(near[some], order, axis=1), np.take_along_axis(low[some], order, axis=1)
        if whole.any():
            fresh = Bounds.compared(x[whole], book, part[whole], b)
            code[whole], near[whole], low[whole], outer[whole] = fresh.code, fresh.near, fresh.low, fresh.outer
            best[whole] = squares(x[whole], book, part[whole], fresh.code)
        return Bounds(code, near, low, outer), int(needed[~whole].max(initial=0)), best

    def kept(self, b: int) -> Bounds:
        """With b near entries; what is no longer listed counts for the outer bound."""
        if b >= self.near.shape[1]:
            return self
        outer = np.minimum(self.outer, self.low[:, b:].min(axis=1))
        return Bounds(self.code, self.near[:, :b], self.low[:, :b], outer)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(at, BLOCK_ROWS)


def _components(block: pa.RecordBatch, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Every part of every vector, and its position."""
    flat = block.column("parts").flatten().to_numpy().astype(np.int64)
    x = flat.reshape(block.num_rows * parts, -1)
    return x, np.tile(np.arange(parts), block.num_rows)


def _bytes(values: np.ndarray, rows: int) -> pa.Array:
    return pa.array([v.tobytes() for v in np.ascontiguousarray(values).reshape(rows, -1)], pa.binary())


def _state(block: pa.RecordBatch, bounds: Bounds) -> pa.RecordBatch:
    n = block.num_rows
    return pa.RecordBatch.from_arrays(
        [
            *[block.column(c) for c in ("id", "label", "parts")],
            _bytes(bounds.code.astype(np.uint16), n),
            _bytes(bounds.near.astype(np.uint16), n),
            _bytes(bounds.low, n),
            _bytes(bounds.outer, n),
        ],
        ["id", "label", "parts", "code", "near", "low", "outer"],
    )


def _held(block: pa.RecordBatch, parts: int) -> Iterator[tuple[pa.RecordBatch, Bounds]]:
    """The persisted bounds, cut where the number of near entries changes."""
    sizes = np.array([len(x) for x in block.column("near").to_pylist()])
    edges = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(sizes)]
    for a, z in zip(edges[:-1], edges[1:], strict=True):
        own = block.slice(a, z - a)
        read = lambda name, kind: np.frombuffer(b"".join(own.column(name).to_pylist()), kind)  # noqa: B023, E731
        n = own.num_rows * parts
        yield own, Bounds(
            read("code", np.uint16).astype(np.int64), read("near", np.uint16).astype(np.int64).reshape(n, -1),
            read("low", np.float32).reshape(n, -1), read("outer", np.float32),
        )


def assign_all(rows: DataFrame, book: np.ndarray, parts: int = PARTS) -> DataFrame:
    """The first pass: codes and bounds by the distances to all entries."""
    b = max(1, book.shape[1] // 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            x, part = _components(block, parts)
            yield _state(block, Bounds.compared(x, book, part, b))

    return rows.select("id", "label", "parts").mapInArrow(run, _STATE)


def reassign(state: DataFrame, book: np.ndarray, before: np.ndarray, parts: int = PARTS) -> DataFrame:
    """A later pass: codes by the bounds, after the entries moved from `before` to `book`."""
    differ = book - before
    step = _up_root(np.einsum("ijk,ijk->ij", differ, differ))
    least = max(1, book.shape[1] // 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            for own, bounds in _held(block, parts):
                x, part = _components(own, parts)
                bounds, needed, _ = bounds.moved(x, book, part, step)
                yield _state(own, bounds.kept(max(least, needed)))

    return state.mapInArrow(run, _STATE)


def moved_entries(state: DataFrame, book: np.ndarray, parts: int = PARTS) -> np.ndarray:
    """Each entry at the floor of the mean of its parts; an unused one where it was."""
    entries, width = book.shape[1], book.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for block in batches:
            x, part = _components(block, parts)
            slot = part * entries + np.frombuffer(b"".join(block.column("code").to_pylist()), np.uint16)
            counts += np.bincount(slot, minlength=parts * entries)
            np.add.at(sums, slot, x)
        used = np.flatnonzero(counts)
        flat = pa.array(sums[used].reshape(-1))
        listed = pa.FixedSizeListArray.from_arrays(flat, width).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used]), listed], ["slot", "n", "sums"])

    partial = state.select("parts", "code").mapInArrow(run, "slot long, n long, sums array<long>")
    total = partial.select("slot", "n", F.posexplode("sums").alias("at", "x")).groupBy("slot", "at").agg(
        F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("total")
    )  # a row per part, entry and component
    new = book.copy()
    for row in total.toLocalIterator():
        new[row.slot // entries, row.slot % entries, row.at] = int(row.total) // int(row.n)
    return new


def vector_codes(
    rows: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """(id, label, code, error) of every vector that is kept, and the codebooks (parts, entries, components).

    `code` is an array of entry numbers, one per part; `error` the sum of the squared distances.
    """
    named = rows.select(
        F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("string").alias("label"), F.col(f"`{vector}`").alias("vector")
    )
    kept = whole_vectors(named, parts)
    book = first_entries(kept, entries, parts)
    if not book.size:
        return kept.select("id", "label", F.array().cast("array<int>").alias("code"), F.lit(0).cast("long").alias("error")).limit(0), book
    state, before = stored(assign_all(kept, book, parts), "codes"), book
    for number in range(rounds):
        before, book = book, moved_entries(state, book, parts)
        if number < rounds - 1:
            state = stored(reassign(state, book, before, parts), "codes")
    return stored(_final(state, book, before, parts), "codes"), book


def _final(state: DataFrame, book: np.ndarray, before: np.ndarray, parts: int) -> DataFrame:
    differ = book - before
    step = _up_root(np.einsum("ijk,ijk->ij", differ, differ))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            for own, bounds in _held(block, parts):
                x, part = _components(own, parts)
                bounds, _, far = bounds.moved(x, book, part, step)
                n = own.num_rows
                codes = pa.FixedSizeListArray.from_arrays(pa.array(bounds.code.astype(np.int32)), parts).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [own.column("id"), own.column("label"), codes, pa.array(far.reshape(n, parts).sum(axis=1))], ["id", "label", "code", "error"]
                )

    return state.mapInArrow(run, "id long, label string, code array<int>, error long")


def book_digest(book: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, book.reshape(-1).tolist())).encode()).hexdigest()


def coded(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): codes as two hex digits per part."""
    codes, book = vector_codes(rows, vec_id, vector, label)
    errors = codes.groupBy(F.col("label").alias("_label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    digits = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return codes.join(errors, codes["label"].eqNullSafe(errors["_label"])).select(
        F.col("id").alias("vec_id"), digits.alias("code"), "error", "label_error", F.lit(book_digest(book)).alias("codebooks_sha256")
    )


_ASSIGNED = """assigned{n} AS (
  SELECT vec_id, p, e, d FROM (
    SELECT x.vec_id, x.p, b.e,
           list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i])))::BIGINT AS d
    FROM part x JOIN book{n} b USING (p))
  QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) = 1),
"""
_MOVED = """book{m} AS (
  SELECT b.p, b.e, coalesce(n.v, b.v) AS v FROM book{n} b LEFT JOIN (
    SELECT p, e, list(m ORDER BY i) AS v FROM (
      SELECT a.p, a.e, i, CAST(floor(sum(x.v[i]) / count(*)) AS BIGINT) AS m
      FROM assigned{n} a JOIN part x USING (vec_id, p), (SELECT unnest(range(1, 1 + (SELECT max(len(v)) FROM part))) AS i)
      GROUP BY a.p, a.e, i) GROUP BY p, e) n USING (p, e)),
"""
CODES_SQL = (
    f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS (
  SELECT vec_id, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS v
  FROM kept, (SELECT unnest(range({PARTS})) AS p)),
book0 AS (
  SELECT p, e, v FROM part JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept) USING (vec_id) WHERE e < {ENTRIES}),
"""
    + "".join(_ASSIGNED.format(n=n) + _MOVED.format(n=n, m=n + 1) for n in range(ROUNDS))
    + _ASSIGNED.format(n=ROUNDS)
    + f"""whole AS (
  SELECT vec_id, label, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM assigned{ROUNDS} JOIN kept USING (vec_id) GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM book{ROUNDS}) AS codebooks_sha256
FROM whole"""
)
