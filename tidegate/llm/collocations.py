"""Collocations: phrases whose words stand together more often than apart, by the stripes pattern.

Per language, every prefix of 0 to 3 words keys a stripe: an associative counter of the words that follow it. A
block of documents makes its stripes, stripes of a prefix are merged by adding them up element by element, and all
figures come from the merged stripes: an element is the count of an extension, the sum of a stripe is the count of
its prefix (the stripe of the empty prefix: of all words), and the largest element is the longer phrase that may
subsume the prefix. The orders are made one after another. Only frequent phrases become prefixes and elements of
the next order; other words behind a prefix are added up in one element without a name, so sums stay whole. Blocks
learn the frequent phrases from a Bloom filter of bounded size; what it lets through in error is counted like the
others and falls below the threshold afterwards, so counts are exact.

Stripes of phrases that hold more than a thousandth of all words, and those of the empty prefix, are split by
the next word into SPLITS pieces, so no task gathers a whole one.

Defined results: a null or empty text has no word; a null language is `und`. Each row counts, also one that
repeats another. Ties are broken as in `collocations`. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.blocks import text_blocks
from tidegate.llm.bloom import Filter, filter_of
from tidegate.llm.stages import stored

LONGEST = 4
MIN_COUNT = 30
SUBSUMED = 80  # per cent of a phrase's count that a longer one must have
TOP = 2000
SPLITS = 64
HOT_SHARE = 1000
BLOCK_BYTES = 8_000_000
SHARD_BYTES = 8_000_000
MOST_HELD = 500_000  # entries of a merging task before it adds them up
_MAP = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 9)
_STRIPES = "lang string, shard int, prefixes array<binary>, pieces array<int>, sizes array<int>, nexts array<binary>, counts array<long>"
_MERGED = "lang string, prefix binary, piece int, total long, nexts array<binary>, counts array<long>, hashes array<long>"


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def joined_hash(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase and the word behind it, from their hashes."""
    return _mixed(left * np.uint64(0x9E3779B97F4A7C15) + word)


def word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def phrase_hashes(phrases: list[bytes], lang: str) -> np.ndarray:
    """As `joined_hash` builds them up."""
    split = [p.split(b" ") for p in phrases]
    out = word_hashes([words[0] for words in split], lang)
    for k in range(1, max(map(len, split), default=1)):
        some = np.flatnonzero([len(words) > k for words in split])
        out[some] = joined_hash(out[some], word_hashes([split[i][k] for i in some.tolist()], lang))
    return out


class Tokens:
    """The words of one language's texts in a block."""

    def __init__(self, texts: list[bytes], lang: str):
        data = np.frombuffer(b"\n".join(texts).translate(_MAP) + b"\n", np.uint8)
        apart = (data == 32) | (data == 10)
        edge = np.flatnonzero(np.diff(apart, prepend=True))
        begin, end = edge[::2], edge[1::2]
        piece = np.searchsorted(np.flatnonzero(data == 10), begin)
        self.same = np.append(piece[1:] == piece[:-1], False) if len(begin) else np.zeros(0, bool)
        offsets = np.concatenate([[0], np.cumsum(end - begin)])
        whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[~apart].tobytes())])
        coded = whole.dictionary_encode()
        self.word = coded.indices.to_numpy().astype(np.int64)
        self.words = coded.dictionary
        self.hashes = word_hashes(self.words.to_pylist(), lang)

    def phrases(self, at: np.ndarray, n: int) -> pa.Array:
        columns = [self.words.take(pa.array(self.word[at + k])) for k in range(n)]
        return pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary())) if n > 1 else columns[0]


class Stripes(NamedTuple):
    """The stripes of a block: per stripe its prefix, piece and hash; per element, ordered by stripe, its
    stripe, count and next word, null for all that have no name of their own."""

    prefixes: pa.Array
    pieces: np.ndarray
    hashes: np.ndarray
    stripe: np.ndarray
    counts: np.ndarray
    nexts: pa.Array


def block_stripes(texts: list[bytes], lang: str, frequent: list[Filter], hot: set[int]) -> Stripes | None:
    """The stripes of prefixes with len(frequent) words.

    `frequent` are the filters of phrases with 1, 2, ... words, `hot` the hashes of prefixes whose stripes are split.
    """
    tokens, n = Tokens(texts, lang), len(frequent)
    if not len(tokens.word):
        return None
    size = len(tokens.words) + 1
    piece_of = (tokens.hashes % np.uint64(SPLITS)).astype(np.int64)
    if not n:
        word, counts = np.unique(tokens.word, return_counts=True)
        pieces, stripe = np.unique(piece_of[word], return_inverse=True)
        order = np.argsort(stripe, kind="stable")
        empty = pa.array([b""] * len(pieces), pa.large_binary())
        return Stripes(empty, pieces, np.zeros(len(pieces), np.uint64), stripe[order], counts[order], tokens.words.take(pa.array(word[order])))

    hashes = tokens.hashes[tokens.word]
    good = frequent[0].holds(tokens.hashes)[tokens.word]  # whether the phrase of k words from here is frequent, k = 1
    code = tokens.word
    same = tokens.same  # whether the word behind that phrase is of its piece
    for k in range(1, n):
        both = np.flatnonzero(good[:-1] & good[1:] & same[:-1])
        longer = joined_hash(hashes[both], tokens.hashes[tokens.word[both + k]])
        _, first, inverse = np.unique(code[both] * size + tokens.word[both + k], return_index=True, return_inverse=True)
        good, code, hashes = np.zeros(len(good), bool), np.zeros(len(good), np.int64), np.zeros(len(good), np.uint64)
        good[both], code[both], hashes[both] = frequent[k].holds(longer[first])[inverse], inverse, longer
        same = np.append(same[1:], False)
    at = np.flatnonzero(good)
    if not len(at):
        return None
    # The next word has its name if the phrase that leaves out the first word is frequent, too.
    named = same[at] & good[np.minimum(at + 1, len(good) - 1)]
    nexts = np.where(named, tokens.word[np.minimum(at + n, len(good) - 1)], size - 1)
    apart = np.isin(hashes[at], np.fromiter(hot, np.uint64, len(hot)))
    piece = np.where(apart & named, np.append(piece_of, 0)[nexts], 0)
    key, first, counts = np.unique((code[at] * SPLITS + piece) * size + nexts, return_index=True, return_counts=True)
    stripe, begin, number = np.unique(key // size, return_index=True, return_inverse=True)
    lead, word = at[first[begin]], key % size
    names = tokens.words.take(pa.array(word, mask=word == size - 1))
    return Stripes(tokens.phrases(lead, n), stripe % SPLITS, hashes[lead], number, counts, names)


def packed(lang: str, made: Stripes, shards: int) -> pa.RecordBatch:
    """One row per shard with all its stripes."""
    salted = _mixed(made.hashes + made.pieces.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    shard = (salted % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    moved = np.argsort(place[made.stripe], kind="stable")
    sizes = np.bincount(made.stripe, minlength=len(order))[order]
    kept, first = np.unique(shard[order], return_index=True)
    ends = np.append(first, len(order)).astype(np.int32)
    element_ends = np.concatenate([[0], np.cumsum(sizes)])[ends].astype(np.int32)
    listed = lambda ends, values: pa.ListArray.from_arrays(pa.array(ends), values)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(kept)), pa.array(kept, pa.int32()), listed(ends, made.prefixes.take(pa.array(order)).cast(pa.binary())),
            listed(ends, pa.array(made.pieces[order], pa.int32())), listed(ends, pa.array(sizes, pa.int32())),
            listed(element_ends, made.nexts.take(pa.array(moved)).cast(pa.binary())), listed(element_ends, pa.array(made.counts[moved], pa.int64())),
        ],
        ["lang", "shard", "prefixes", "pieces", "sizes", "nexts", "counts"],
    )


def stripes(rows: DataFrame, frequent, hot: dict[str, set[int]], shards: int) -> DataFrame:
    """The blocks' stripes, packed by language and shard. `frequent` is a broadcast list of filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = frequent.value
        for block in text_blocks(batches, BLOCK_BYTES):
            langs = block.column("lang").dictionary_encode()
            texts, number = block.column("text").to_pylist(), langs.indices.to_numpy()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                own = [texts[i] for i in np.flatnonzero(number == k).tolist()]
                made = block_stripes(own, lang, filters, hot.get(lang, set()))
                if made is not None:
                    yield packed(lang, made, shards)

    return rows.select("lang", "text").mapInArrow(run, _STRIPES)


def _elements(batch: pa.RecordBatch) -> pa.Table:
    """One row per element of the packed stripes."""
    lists = {c: batch.column(c) for c in ("prefixes", "pieces", "sizes", "nexts", "counts")}
    sizes = lists["sizes"].flatten().to_numpy()
    number = pa.array(np.repeat(np.arange(len(sizes)), sizes))
    lang = batch.column("lang").take(pa.array(np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists["nexts"]).to_numpy())))
    return pa.table(
        [lang, lists["prefixes"].flatten().take(number), lists["pieces"].flatten().take(number), lists["nexts"].flatten(), lists["counts"].flatten()],
        ["lang", "prefix", "piece", "next", "n"],
    )


_KEYS = ["lang", "prefix", "piece", "next"]


def merged(blocks: DataFrame, shards: int, min_count: int) -> DataFrame:
    """Whole stripes: the sum of all elements, and the elements that reach the threshold, with the hashes of their phrases.

    A task holds its shards' distinct elements; the number of shards follows the size of the texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = limit = 0

        def added() -> pa.Table:
            return pa.concat_tables(held).group_by(_KEYS, use_threads=False).aggregate([("n", "sum")]).rename_columns([*_KEYS, "n"])

        for batch in batches:
            held.append(_elements(batch))
            size += held[-1].num_rows
            if size > max(MOST_HELD, limit):
                held = [added()]
                size = held[0].num_rows
                limit = 2 * size
        if size:
            yield from _whole_stripes(added(), min_count)

    return blocks.repartition(shards, "lang", "shard").mapInArrow(run, _MERGED)


def _whole_stripes(elements: pa.Table, min_count: int) -> Iterator[pa.RecordBatch]:
    totals = elements.group_by(["lang", "prefix", "piece"], use_threads=False).aggregate([("n", "sum")])
    totals = totals.rename_columns(["lang", "prefix", "piece", "total"])
    large = elements.filter(pc.and_(pc.greater_equal(elements["n"], min_count), pc.is_valid(elements["next"])))
    large = large.sort_by([("lang", "ascending"), ("prefix", "ascending"), ("piece", "ascending")])
    found: dict[tuple, tuple[list[bytes], list[int]]] = {}
    for lang, prefix, piece, word, n in zip(*[large[c].to_pylist() for c in (*_KEYS, "n")], strict=True):
        own = found.setdefault((lang, prefix, piece), ([], []))
        own[0].append(word)
        own[1].append(n)
    for part in totals.to_batches(max_chunksize=10_000):
        out = []
        for row in part.to_pylist():
            words, counts = found.get((row["lang"], row["prefix"], row["piece"]), ([], []))
            lead = row["prefix"] + b" " if row["prefix"] else b""
            hashes = phrase_hashes([lead + w for w in words], row["lang"]).view(np.int64) if words else []
            out.append({**row, "nexts": words, "counts": counts, "hashes": hashes})
        yield pa.RecordBatch.from_pylist(out, _WHOLE)


_WHOLE = pa.schema(
    [
        ("lang", pa.string()), ("prefix", pa.binary()), ("piece", pa.int32()), ("total", pa.int64()), ("nexts", pa.list_(pa.binary())),
        ("counts", pa.list_(pa.int64())), ("hashes", pa.list_(pa.int64())),
    ]
)


def all_stripes(rows: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT) -> list[DataFrame]:
    """The merged stripes of prefixes with 0, 1, ... words, as written tables."""
    spark = rows.sparkSession
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    shards = max(16, -(-size // SHARD_BYTES))
    filters: list[Filter] = []
    hot: dict[str, set[int]] = {}
    orders: list[DataFrame] = []
    words = 0
    for _ in range(longest):
        shared = spark.sparkContext.broadcast(filters)
        whole = stored(merged(stripes(rows, shared, hot, shards), shards, min_count), "stripes")
        shared.unpersist()
        orders.append(whole)
        if len(orders) == 1:
            words = whole.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n")).first()["n"]
        elements = whole.select("lang", F.explode(F.arrays_zip("counts", "hashes")).alias("e")).select("lang", "e.counts", F.col("e.hashes").alias("hash"))
        count = elements.count()
        filters = [*filters, Filter(filter_of(elements.select("hash"), count), count)]
        # At most HOT_SHARE phrases can hold a thousandth of all words.
        hot = {}
        for row in elements.where(F.col("counts") * HOT_SHARE >= words).select("lang", "hash").collect():
            hot.setdefault(row.lang, set()).add(row.hash % (1 << 64))
    return orders


def phrase_counts(orders: list[DataFrame], min_count: int = MIN_COUNT) -> DataFrame:
    """(lang, phrase, words, f, best) of all frequent phrases: the sum of a phrase's own stripe and its largest
    element; the longest phrases have no stripe and are elements."""
    known = []
    for n, whole in enumerate(orders):
        if n:
            own = whole.groupBy("lang", "prefix").agg(F.sum("total").alias("f"), F.max(F.array_max("counts")).alias("best"))
            known.append(own.select("lang", F.col("prefix").alias("phrase"), F.lit(n).alias("words"), "f", F.coalesce("best", F.lit(0)).alias("best")))
    ends = orders[-1].select("lang", "prefix", F.explode(F.arrays_zip("nexts", "counts")).alias("e"))
    lead = F.when(F.octet_length("prefix") > 0, F.concat("prefix", F.lit(b" "))).otherwise(F.lit(b""))
    known.append(ends.select("lang", F.concat(lead, "e.nexts").alias("phrase"), F.lit(len(orders)).alias("words"), F.col("e.counts").alias("f"), F.lit(0).cast("long").alias("best")))
    whole = reduce(DataFrame.unionByName, known).where(F.col("f") >= min_count)
    return whole.withColumn("phrase", F.col("phrase").cast("string"))


def collocations(
    documents: DataFrame,
    lang: str = "lang",
    text: str = "text",
    longest: int = LONGEST,
    min_count: int = MIN_COUNT,
    subsumed: int = SUBSUMED,
    top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` phrases of 2 to `longest` words.

    A phrase that is cut after k words has a score of 2,000,000 a / (l + r), rounded down; the lowest-scoring
    cut counts, of equal ones that with the smallest k. A phrase goes if a longer one that holds it has
    `subsumed` per cent of its count: as counts never grow with a phrase, one word more decides. Order: score and
    a descending, phrase in the order of its bytes.
    """
    rows = documents.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))
    rows = rows.where(F.octet_length("text") > 0)
    orders = all_stripes(rows, longest, min_count)
    known = stored(phrase_counts(orders, min_count), "phrases")
    words = orders[0].groupBy("lang").agg(F.sum("total").alias("n"))

    counts = known.select("lang", "phrase", "f")
    split = F.split("phrase", " ")
    behind = known.where("words > 2").select("lang", F.array_join(F.slice(split, F.lit(2), F.col("words") - 1), " ").alias("phrase"), "f")
    left = behind.groupBy("lang", "phrase").agg(F.max("f").alias("left"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    longer = F.greatest(F.col("best"), F.coalesce(F.col("left"), F.lit(0)))
    found = known.where("words > 1").join(left, ["lang", "phrase"], "left").withColumn("longer", longer)
    gone = (F.col("longer") >= min_count) & (wide("longer") * 100 >= wide("f") * subsumed)
    found = found.where(~gone).select("lang", "phrase", "words", F.col("f").alias("a"))

    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    head = F.array_join(F.slice(split, F.lit(1), F.col("k")), " ")
    tail = F.array_join(F.slice(split, F.col("k") + 1, F.col("words") - F.col("k")), " ")
    cuts = cuts.withColumns({"head": head, "tail": tail})
    cuts = cuts.join(counts.toDF("lang", "head", "l"), ["lang", "head"]).join(counts.toDF("lang", "tail", "r"), ["lang", "tail"])
    score = F.expr("(cast(a AS decimal(20,0)) * 2000000) div (cast(l AS decimal(20,0)) + r)")
    worst = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    scored = worst.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First among parts of a language, then among what they leave, so no task sorts a whole language.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SPLITS))).orderBy(*order)
    first = scored.withColumn("_place", F.row_number().over(part)).where(F.col("_place") <= top).drop("_place")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _phrases_sql(n: int) -> str:
    names = [f"w{k}" for k in range(1, n + 1)]
    # The pieces' words as one list: the n-th follower must be of the same piece.
    cells = ", ".join([f"words[i + {k}] AS w{k + 1}" for k in range(n)])
    text = " || ' ' || ".join(names)
    return f"""f{n} AS (
  SELECT lang, {text} AS phrase, count(*) AS f FROM (
    SELECT lang, {cells} FROM (SELECT lang, words, unnest(range(1, len(words) - {n - 2})) AS i FROM pieces WHERE len(words) >= {n}))
  GROUP BY lang, phrase HAVING count(*) >= {MIN_COUNT}),
"""


COLLOCATIONS_SQL = (
    r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words
  FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts)),
totals AS (SELECT lang, sum(len(words)) AS n FROM pieces GROUP BY lang),
"""
    + "".join(map(_phrases_sql, range(1, LONGEST + 1)))
    + f"""known AS ({" UNION ALL ".join(f"SELECT lang, phrase, f, {n} AS words FROM f{n}" for n in range(1, LONGEST + 1))}),
longer AS (
  SELECT lang, part, max(f) AS f FROM (
    SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[2:], ' '),
                            array_to_string(string_split(phrase, ' ')[:words - 1], ' ')]) AS part
    FROM known WHERE words > 2) GROUP BY lang, part),
found AS (
  SELECT k.lang, k.phrase, k.words, k.f AS a FROM known k LEFT JOIN longer x ON x.lang = k.lang AND x.part = k.phrase
  WHERE k.words > 1 AND (x.f IS NULL OR CAST(x.f AS HUGEINT) * 100 < CAST(k.f AS HUGEINT) * {SUBSUMED})),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, words)) AS k FROM found)),
scored AS (
  SELECT c.lang, c.phrase, c.a, h.f AS l, t.f AS r, CAST(CAST(c.a AS HUGEINT) * 2000000 // (h.f + t.f) AS BIGINT) AS score
  FROM cuts c JOIN known h ON h.lang = c.lang AND h.phrase = c.head JOIN known t ON t.lang = c.lang AND t.phrase = c.tail
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       CAST(n AS BIGINT) AS n, score
FROM scored JOIN totals USING (lang) QUALIFY rank <= {TOP}"""
)
