"""Byte-level BPE encoding and decoding.

Text is cut by a pre-tokenisation pattern; each distinct word of a block of documents is encoded once, by a
Spark higher-order function: a fold over the word's byte array that merges the pair of lowest rank until none
is left. The ranks are a literal map in the expression, from a pair of ids to the rank of their merge, which
is also its id. It is laid out as a hash table in an array, because Spark searches a map from its start:
each pair stands at one of its two places. The ids of a document are those of its words one after another;
decoding concatenates the binary pieces of the ids.

Words that are frequent in a bounded sample of documents are folded first and handed to all tasks, so a block
folds only what they leave. This saves time and never changes a result. Nothing is shuffled.

Defined results: a null or empty text has no ids and decodes to no bytes. A word of more than LONGEST_FOLD
bytes is merged by a heap instead, since a fold takes time in the square of its length. Repeated rows and ids
are encoded one by one, and other columns are not read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import string
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm.blocks import flat_bytes, give_back, text_blocks
from tidegate.llm.encoders import stretches
from tidegate.llm.stages import stored

LONGEST_FOLD = 256
HOT_DOCS = 20_000  # bound of the sample in which frequent words are looked for, documents
HOT_WORDS = 200_000  # and of the words kept
LONGEST_HOT = 64  # bytes of such a word
BLOCK_BYTES = 2_000_000
#: A pair of ids in the table: rank of their merge, left id, right id.
_ID, _RANK = 17, 42
_END = 1 << 16  # right id of the last pair
#: A pair while it is folded: rank, place, base of the left id, slot of the pair; base and slot tell both ids.
_BASE, _FOLD_PLACE, _FOLD_RANK = 19, 38, 46
_NO_MERGE = 1 << 62  # above every pair that can be merged
_REST = 1 << 30


class Vocabulary:
    """Ranks of byte strings, and what the fold and the decoder need of them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = [ranks[bytes([i])] for i in range(256)]
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece

    @functools.cached_property
    def pairs(self) -> dict[int, int]:
        """left * 65536 + right -> rank, for all pairs of ids whose bytes together are in the vocabulary."""
        if len(self.pieces) > 65536:
            raise ValueError("ids of more than 16 bits are not supported")
        out = {}
        for piece, rank in self.ranks.items():
            for cut in range(1, len(piece)):
                left, right = self.ranks.get(piece[:cut]), self.ranks.get(piece[cut:])
                if left is not None and right is not None:
                    out[left * 65536 + right] = rank
        return out

    @functools.cached_property
    def piece_texts(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all pieces one after another, and where each starts (one more entry: the end)."""
        return _flat(self.pieces)

    @functools.cached_property
    def decimal_texts(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids as decimals with a comma before each, and where each starts (one more entry: the end)."""
        return _flat([b",%d" % i for i in range(len(self.pieces))])

    @functools.cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """(slots, bases): at bases[left] + right stands the pair, if it has a merge, else another pair or -1.

        No two ids have the same base.
        """
        keys = np.fromiter(self.pairs, np.int64, len(self.pairs))
        left, right, ranks = keys >> 16, keys & 65535, np.fromiter(self.pairs.values(), np.int64, len(keys))
        order = np.argsort(left, kind="stable")
        own, begin, sizes = np.unique(left[order], return_index=True, return_counts=True)
        room = min(max(4 * len(keys), 1 << 17), (1 << _BASE) - _END - 1)
        if 2 * len(keys) > room:
            raise ValueError("more than 229,000 pairs are not supported")
        bases, taken, slots = np.zeros(len(self.pieces), np.int64), np.zeros(room, bool), np.full(room + _END + 1, -1, np.int64)
        chance = np.random.default_rng(1)
        for k in np.argsort(-sizes, kind="stable").tolist():
            some = order[begin[k] : begin[k] + sizes[k]]
            while True:
                tried = chance.integers(0, room, 64)
                free = (slots[tried[:, None] + right[some]] < 0).all(axis=1) & ~taken[tried]
                if free.any():
                    break
            base = bases[own[k]] = tried[free.argmax()]
            taken[base] = True
            slots[base + right[some]] = (ranks[some] << _RANK) + (own[k] << _ID) + right[some]
        others = np.setdiff1d(np.arange(len(self.pieces)), own)
        bases[others] = np.flatnonzero(~taken)[: len(others)]
        return slots, bases

    @functools.cached_property
    def fold_slots(self) -> np.ndarray:
        """The slots with their pairs as the fold has them."""
        slots, bases = self.table
        own = bases[np.maximum(slots, 0) >> _ID & ((1 << _ID) - 1)]
        return np.where(slots < 0, -1, (slots >> _RANK << _FOLD_RANK) + (own << _BASE) + np.arange(len(slots)))

    @functools.cached_property
    def id_of_base(self) -> np.ndarray:
        """The id that has the base."""
        bases = self.table[1]
        out = np.zeros(bases.max() + 1, np.int32)
        out[bases] = np.arange(len(bases))
        return out

    @functools.cached_property
    def first(self) -> np.ndarray:
        """The pair of two bytes at left * 256 + right, and behind these the pair of a last byte."""
        left, right = (x.ravel() for x in np.meshgrid(self.single, self.single, indexing="ij"))
        ranks = [self.pairs.get(pair) for pair in (left * 65536 + right).tolist()]
        high = np.array([_NO_MERGE if rank is None else rank << _FOLD_RANK for rank in ranks])
        base, last = self.table[1][left], self.table[1][self.single]
        return np.concatenate([high + (base << _BASE) + base + right, _NO_MERGE + (last << _BASE) + last + _END])


def _flat(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def _joined(store: np.ndarray, edges: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The intervals `codes` of the store one after another, and where each starts (one more entry: the end)."""
    begin = edges[codes]
    upto = np.concatenate([[0], np.cumsum(edges[codes + 1] - begin)])
    return store[np.repeat(begin - upto[:-1], np.diff(upto)) + np.arange(upto[-1])], upto


@functools.lru_cache(maxsize=4)
def read_ranks(path: str) -> Vocabulary:
    """A rank file: a line for each piece, in Base64, with its rank."""
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)})


_TABLES = ["_slots", "_bases", "_first", "_ids"]


def fold_tables(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    """What the fold looks up, as one row. As literals the tables would stand in every text of a plan, which the driver keeps."""
    bases = vocabulary.table[1]
    longs = [pa.array([x], pa.list_(pa.int64())) for x in (vocabulary.fold_slots, (bases << _BASE) + bases, vocabulary.first)]
    return spark.createDataFrame(pa.table([*longs, pa.array([vocabulary.id_of_base], pa.list_(pa.int32()))], _TABLES))


def byte_pairs(words: list[bytes], first: np.ndarray) -> pa.ListArray:
    """The pairs of neighbouring bytes of each word, with which its fold begins."""
    data, edges = _flat(words)
    data = data.astype(np.int64)
    code = data * 256
    code[:-1] += data[1:]
    last = edges[1:] - 1  # no word is empty
    code[last] = 65536 + data[last]
    place = np.arange(len(data)) - np.repeat(edges[:-1], np.diff(edges))
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(first[code] + (place << _FOLD_PLACE)))


def left_ids(pairs: np.ndarray, id_of_base: np.ndarray) -> np.ndarray:
    """The ids of words from the pairs that their folds leave."""
    return id_of_base[pairs >> _BASE & ((1 << _FOLD_PLACE - _BASE) - 1)]


def fold_pairs(rows: DataFrame, tables: DataFrame) -> DataFrame:
    """The rows with `left`, the pairs that the fold of each word leaves, in place of `pairs` (array<array<long>>), those of its bytes."""
    looked_up = {name: tables.select(name).scalar() for name in _TABLES[:2]}
    merged = F.transform(F.col("pairs"), _merge_all)
    return rows.withColumns(looked_up).withColumn("left", merged).drop("pairs", *_TABLES[:2])


def fold_words(rows: DataFrame, tables: DataFrame) -> DataFrame:
    """The rows with `ids`, the ids of each word (array<array<int>>), in place of `words`, an array of byte arrays."""
    first = F.col("_first")

    def pairs_of(word: Column) -> Column:
        def byte_pair(byte: Column, i: Column) -> Column:
            pair = F.coalesce(F.get(first, byte * 256 + F.get(word, i + 1)), F.get(first, byte + 65536))
            return pair + F.shiftleft(i.cast("long"), _FOLD_PLACE)

        return F.transform(word, byte_pair)

    begun = rows.withColumn("_first", tables.select("_first").scalar()).withColumn("pairs", F.transform("words", pairs_of))
    folded = fold_pairs(begun.drop("words", "_first"), tables).withColumn("_ids", tables.select("_ids").scalar())
    left_id = lambda pair: F.get("_ids", _base(pair).cast("int"))
    return folded.withColumn("ids", F.transform("left", lambda pairs: F.transform(pairs, left_id))).drop("left", "_ids")


def _base(pair: Column) -> Column:
    """The base of the left id."""
    return F.shiftright(pair, _BASE).bitwiseAND(F.lit((1 << _FOLD_PLACE - _BASE) - 1))


def _merge_all(word: Column) -> Column:
    """The pairs of a word when none of them can be merged any more.

    The state is an array of pairs of neighbours, one for each id, the last with nothing to its right. The least
    pair is the one of lowest rank, of equal ones the first.
    """
    slot_bits, pair_bits = F.lit((1 << _BASE) - 1), F.lit((1 << _FOLD_PLACE) - 1)
    place_bits = F.lit(((1 << _FOLD_RANK) - 1) ^ ((1 << _FOLD_PLACE) - 1))
    left_bits = F.lit(((1 << _FOLD_RANK) - 1) ^ ((1 << _BASE) - 1))  # place and base
    none, no_merge, one_place = F.lit(0).cast("long"), F.lit(_NO_MERGE), F.lit(1 << _FOLD_PLACE)
    slots, bases = (F.col(name) for name in _TABLES[:2])

    def ranked(pair: Column) -> Column:
        """The pair, which so far has no rank, with the rank of its merge."""
        slot = F.get(slots, pair.bitwiseAND(slot_bits).cast("int"))
        return F.when(slot.bitwiseXOR(pair).bitwiseAND(pair_bits) == none, slot.bitwiseOR(pair)).otherwise(pair.bitwiseOR(no_merge))

    def merge(pairs: Column, at: Column) -> Column:
        """The pair at the place `at` merged."""
        low = F.get(pairs, at)
        rank = F.shiftright(low, _FOLD_RANK)
        before, following = F.get(pairs, at - 1), F.get(pairs, at + 1)
        left = before.bitwiseAND(left_bits) + _base(before) + rank
        right = low.bitwiseAND(place_bits) + F.get(bases, rank.cast("int")) + following.bitwiseAND(slot_bits) - _base(following)
        after = F.transform(F.slice(pairs, at + 3, _REST), lambda pair: pair - one_place)
        return F.when(at > 0, F.flatten(F.array(F.slice(pairs, 1, at - 1), F.transform(F.array(left, right), ranked), after))).otherwise(
            F.flatten(F.array(F.transform(F.array(right), ranked), after))
        )

    def merge_lowest(pairs: Column, _: Column) -> Column:
        # The inner aggregate looks for the least pair once.
        at = F.shiftright(F.array_min(pairs), _FOLD_PLACE).bitwiseAND(F.lit((1 << _FOLD_RANK - _FOLD_PLACE) - 1)).cast("int")
        return F.aggregate(F.array(at), pairs, lambda now, at: F.when(F.get(now, at) < no_merge, merge(now, at)).otherwise(now))

    return F.aggregate(F.slice(word, 2, _REST), word, merge_lowest)


def merge_by_heap(word: bytes, vocabulary: Vocabulary) -> list[int]:
    """Ids of one word; the same merges in time that hardly grows faster than the word."""
    ids: list[int | None] = [vocabulary.single[b] for b in word]
    after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    rank_of = vocabulary.pairs.get
    heap = [(r, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (r := rank_of(ids[i] * 65536 + ids[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i, left, right = heapq.heappop(heap)
        j = after[i]
        if ids[i] != left or j >= len(ids) or ids[j] != right:
            continue
        ids[i], ids[j] = rank, None
        after[i] = after[j]
        if after[i] < len(ids):
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < len(ids):
                r = rank_of(ids[k] * 65536 + ids[after[k]])
                if r is not None:
                    heapq.heappush(heap, (r, k, ids[k], ids[after[k]]))
    return [i for i in ids if i is not None]


def decode(ids: list[int], vocabulary: Vocabulary) -> bytes:
    """The pieces of the ids one after another."""
    return b"".join(map(vocabulary.pieces.__getitem__, ids))


class HotWords(NamedTuple):
    """Frequent words and their ids; `ids` is flat, `edges` bounds the ids of each word."""

    words: pa.Array
    ids: np.ndarray
    edges: np.ndarray


_BLOCK = (
    "doc_ids array<bigint>, first binary, sizes binary, rest binary, word_counts binary, word_stream binary, "
    "pairs array<array<bigint>>, long_words array<binary>"
)


def _pretokeniser(pattern: str):
    # White space as the Unicode property, as other engines read it.
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def _to_block(block: pa.RecordBatch, pattern, hot: dict[str, int], pairs: np.ndarray | None = None) -> pa.RecordBatch:
    """The documents as numbers of distinct stretches, those as numbers of words, and the words not yet known.

    A word's number is its place among the hot words, or -1 - its place in `words`, or _REST + its place in
    `long_words`. Stretches are numbered as they come: those that begin with a space, then those that don't.
    With `pairs`, those of two bytes, the column `pairs` holds the byte pairs of the words instead of `words`.
    """
    spaced: dict[str, int] = defaultdict(lambda: len(spaced))
    leading: dict[str, int] = defaultdict(lambda: len(leading))
    firsts, rests = [], []
    for text in block.column("text").to_pylist():
        lead, others = stretches(text)
        firsts.append(leading[lead])
        rests.append(np.fromiter(map(spaced.__getitem__, others), np.int32, len(others)))
    spaced.default_factory = leading.default_factory = None  # each refers to its dictionary, which then stays after the block
    first, sizes = np.array(firsts, np.int32), np.array([len(r) for r in rests], np.int32)
    rest = np.concatenate([*rests, np.zeros(0, np.int32)])
    cold: dict[str, int] = {}
    long_words: list[bytes] = []
    words: list[bytes] = []
    counts, flat = [], []
    for stretch in chain((" " + part for part in spaced), leading):
        at = hot.get(stretch)
        if at is not None:  # a word by itself
            counts.append(1)
            flat.append(at)
            continue
        body = stretch.rstrip(string.punctuation)
        if body[1:].isalpha() and body[0] == " ":  # a word, and the punctuation behind it
            found = [body, stretch[len(body) :]] if len(body) < len(stretch) else [stretch]
        else:
            found = pattern.findall(stretch)
        counts.append(len(found))
        for word in found:
            at = hot.get(word)
            if at is None:
                at = cold.get(word)
            if at is None:
                data = word.encode()
                if len(data) > LONGEST_FOLD:
                    at = _REST + len(long_words)
                    long_words.append(data)
                else:
                    at = -1 - len(words)
                    words.append(data)
                cold[word] = at
            flat.append(at)
    if pairs is None:
        data, edges = _flat(words)
        lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(data, pa.int32()))
    else:
        lists = byte_pairs(words, pairs)
    numbers = [first + np.int32(len(spaced)), sizes, rest, np.array(counts, np.int32), np.array(flat, np.int32)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block.column("doc_id").to_pylist()], pa.list_(pa.int64())),
            *[pa.array([x.astype(np.int32).tobytes()], pa.binary()) for x in numbers],
            pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), lists),
            pa.array([long_words], pa.list_(pa.binary())),
        ],
        ["doc_ids", "first", "sizes", "rest", "word_counts", "word_stream", "words" if pairs is None else "pairs", "long_words"],
    )


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list of lists one after another, and where each inner list starts (one more entry: the end)."""
    inner = column.flatten()
    edges = inner.offsets.to_numpy().astype(np.int64)
    return inner.flatten().to_numpy(zero_copy_only=False), edges - edges[0]


def _numbers(row: pa.RecordBatch, name: str) -> np.ndarray:
    return np.frombuffer(row.column(name)[0].as_py(), np.int32)


def _blocks(documents: DataFrame, pattern: str, hot, first) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = _pretokeniser(pattern)
        index = {word: i for i, word in enumerate(hot.value.to_pylist())}
        for block in text_blocks(batches, BLOCK_BYTES):
            yield _to_block(block, compiled, index, first.value)
            give_back()
        del index
        give_back()

    return documents.mapInArrow(run, _BLOCK)


def learn_hot_words(documents: DataFrame, tables: DataFrame, pattern: str) -> HotWords:
    """The most frequent words of about HOT_DOCS documents (doc_id, text), folded; at most HOT_WORDS of them."""
    total = max(documents.select("doc_id").count(), 1)
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / float(1 << 20)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = _pretokeniser(pattern)
        for block in text_blocks(batches, BLOCK_BYTES):
            parts: Counter = Counter()
            for first, rest in map(stretches, block.column("text").to_pylist()):
                parts[first] += 1
                parts.update([" " + part for part in rest])
            words: Counter = Counter()
            for part, n in parts.items():
                for word in compiled.findall(part):
                    words[word] += n
            kept = [(w, n) for w, n in words.items() if len(w.encode()) <= LONGEST_HOT]
            if kept:
                word, n = zip(*kept, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n, pa.int64())], ["word", "n"])

    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = flat_bytes(batch.column("word"))
            each = pa.ListArray.from_arrays(starts.astype(np.int32), pa.array(data.astype(np.int32)))
            whole = pa.array([0, batch.num_rows], pa.int32())
            lists = [pa.ListArray.from_arrays(whole, x) for x in (batch.column("word").cast(pa.string()), each)]
            yield pa.RecordBatch.from_arrays(lists, ["word", "words"])

    sample = documents.where(place <= HOT_DOCS / total).mapInArrow(count, "word string, n long")
    counted = stored(sample.groupBy("word").agg(F.sum("n").alias("n")), "words")
    # One row per frequency, to find the least frequency of which all words have room.
    room, least = HOT_WORDS, 1 << 62
    for row in counted.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).toLocalIterator():
        room -= row.words
        if room < 0:
            break
        least = row.n
    rows = counted.where(F.col("n") >= least).select("word").mapInArrow(bytes_of, "word array<string>, words array<array<int>>")
    folded = fold_words(rows, tables).toArrow().combine_chunks()
    if not folded.num_rows:
        return HotWords(pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(1, np.int64))
    word, ids = (folded.column(name).combine_chunks() for name in ("word", "ids"))
    return HotWords(word.flatten(), *_lists(ids))


def round_trip(documents: DataFrame, ranks: str, pattern: str, doc_id: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document, and with `ids` also the ids.

    The digests are those of the decimal ids joined by commas, and of the bytes decoded from the ids.
    """
    vocabulary = read_ranks(ranks)
    context = documents.sparkSession.sparkContext
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    tables = fold_tables(documents.sparkSession, vocabulary)
    learned = learn_hot_words(rows, tables, pattern)  # bounded by HOT_WORDS
    parts = learned.words, learned._replace(words=None), (vocabulary.ranks, vocabulary.id_of_base), vocabulary.first
    words, hot, shared, first = map(context.broadcast, parts)
    del learned, parts
    give_back()
    encoded = fold_pairs(_blocks(rows, pattern, words, first), tables)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, id_of_base = shared.value
        own = Vocabulary(ranks)
        for batch in batches:
            for k in range(batch.num_rows):
                yield _digests(batch.slice(k, 1), hot.value, own, names, id_of_base)
                give_back()
        del own
        give_back()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")
    return encoded.mapInArrow(run, schema)


def _digests(
    row: pa.RecordBatch, hot: HotWords, vocabulary: Vocabulary, names: list[str], id_of_base: np.ndarray | None = None
) -> pa.RecordBatch:
    """The documents of a block of one row, put together from their stretches, those from their words (`ids`, or `left` with bases)."""
    if "left" in row.schema.names:
        pairs, folded_edges = _lists(row.column("left"))
        folded = left_ids(pairs, id_of_base)
    else:
        folded, folded_edges = _lists(row.column("ids"))
    merged = [merge_by_heap(word, vocabulary) for word in row.column("long_words")[0].as_py()]
    store = np.concatenate([hot.ids, folded, np.fromiter(chain.from_iterable(merged), np.int32)])
    sizes = [np.diff(hot.edges), np.diff(folded_edges), np.fromiter(map(len, merged), np.int64, len(merged))]
    n_hot, n_folded = len(sizes[0]), len(sizes[1])
    codes = _numbers(row, "word_stream").astype(np.int64)
    codes = np.where(codes < 0, n_hot - 1 - codes, np.where(codes < _REST, codes, n_hot + n_folded + codes - _REST))
    ids, upto = _joined(store, np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), codes)
    edges = upto[np.concatenate([[0], np.cumsum(_numbers(row, "word_counts"))])]  # of the ids of each stretch

    def by_stretch(texts: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
        data, starts = _joined(*texts, ids)
        data, cuts = data.tobytes(), starts[edges].tolist()
        return [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    decimals, decoded = by_stretch(vocabulary.decimal_texts), by_stretch(vocabulary.piece_texts)
    first, rest, others = _numbers(row, "first"), _numbers(row, "rest"), _numbers(row, "sizes").astype(np.int64)
    ends = np.cumsum(others + 1)
    at = np.insert(rest, np.cumsum(others) - others, first).astype(np.int64)  # the stretches of all documents
    per_stretch = np.concatenate([[0], np.cumsum(np.diff(edges)[at])])
    bounds = np.concatenate([[0], per_stretch[ends]])
    stretches_of, cuts = at.tolist(), [0, *ends.tolist()]
    ids_sha, text_sha = [], []
    for a, b in zip(cuts, cuts[1:], strict=False):
        own = stretches_of[a:b]
        ids_sha.append(hashlib.sha256(memoryview(b"".join(map(decimals.__getitem__, own)))[1:]).hexdigest())
        text_sha.append(hashlib.sha256(b"".join(map(decoded.__getitem__, own))).hexdigest())
    columns = [
        pa.array(row.column("doc_ids")[0].as_py(), pa.int64()),
        pa.array(np.diff(bounds), pa.int64()),
        pa.array(ids_sha, pa.string()),
        pa.array(text_sha, pa.string()),
    ]
    if len(names) > 4:
        whole, _ = _joined(ids, edges, at)
        columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(whole, pa.int32())))
    return pa.RecordBatch.from_arrays(columns, names)
