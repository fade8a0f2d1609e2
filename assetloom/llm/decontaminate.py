"""Documents that hold passages of a benchmark."""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assetloom.llm.text import GOLDEN, WordHashes, like, mixed, shingles

SHINGLE_WORDS = 5
LEAST_SIMILARITY = 0.8
BITS, BLOCKS = 64, 4
BLOCK_BITS = BITS // BLOCKS
#: Hamming distance searched. Sets at a similarity of 0.8 differ in 10 of 64 bits on average
#: with a deviation of 3, so beyond 24 bits lies about one pair in a million.
RADIUS = 24
#: Items one pass over the documents takes; more items are done in further passes. An index holds 32 kB for each
#: item, so a task needs about 400 MB for both at most.
ITEMS_PER_PASS = 6_000
#: Eighths of the items whose bits are worked out at a time.
CHUNK = 64
#: (window, item) marks held at once.
MARKS_PER_BLOCK = 1 << 22

HITS = "doc_id bigint, item_id bigint, first_word bigint, n_words bigint, similarity double"

# Signs at the edges of words that are no part of the wording.
_EDGES = string.punctuation.encode()


class _Words(WordHashes):
    """Hashes of words without case and outer punctuation."""

    def __missing__(self, word: bytes) -> int:
        plain = word.decode().lower().encode()
        plain = plain.strip(_EDGES) or plain
        value = WordHashes.__missing__(self, plain) if plain == word else self[plain]
        self[word] = value
        return value


def _signs(values: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each shingle's hash."""
    bits = np.unpackbits(mixed(values).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int8) * 2 - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    """Fingerprints: bit i is set where the sum of signs i is above zero."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64).ravel()


class ItemIndex:
    """Multi-index over the fingerprints of benchmark items of one number of shingles.

    Two fingerprints within ``RADIUS`` agree up to RADIUS / BLOCKS bits in at least one of
    the ``BLOCKS`` blocks. Per block, each value has a bit for every item whose own value is within
    that distance, so the union over blocks misses no item within the radius.
    """

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        values = np.arange(1 << BLOCK_BITS, dtype=np.uint16)
        #: for each block and value one bit per item
        self._near = []
        for b in range(BLOCKS):
            own = self._block(prints, b)
            parts = [np.packbits(np.bitwise_count(values[:, None] ^ own[None, i:i + 8 * CHUNK]) <= RADIUS // BLOCKS, axis=1)
                     for i in range(0, len(own), 8 * CHUNK)]
            self._near.append(np.concatenate(parts, axis=1))

    @staticmethod
    def _block(prints: np.ndarray, b: int) -> np.ndarray:
        return ((prints >> np.uint64(BLOCK_BITS * b)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.uint16)

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the radius, in that order; windows are looked up in blocks."""
        some = max(1, MARKS_PER_BLOCK // len(self.prints))
        found = [self._candidates(prints[i:i + some], i) for i in range(0, len(prints), some)]
        return np.concatenate([w for w, _ in found]), np.concatenate([i for _, i in found])

    def _candidates(self, prints: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
        bits = reduce(np.bitwise_or, (near[self._block(prints, b)] for b, near in enumerate(self._near)))
        marked = np.unpackbits(bits, axis=1, count=len(self.prints))
        window, item = np.nonzero(marked)
        near = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
        return window[near] + first, item[near]


class Benchmark:
    """Items prepared for scanning: shingle weights, and an index per item length."""

    def __init__(self, items: list[tuple[int, str]], shared: dict[int, int] | None = None):
        """``shared``: shingles of several items of the whole benchmark and of how many, by default of ``items``."""
        self._hashes = _Words()
        by_length: dict[int, list] = defaultdict(list)
        counts: dict[int, int] = defaultdict(int)
        for item_id, text in sorted(items):
            values = item_shingles(text, self._hashes)
            if len(values):
                by_length[len((text or "").encode().split())].append((item_id, values))
                for v in set(values.tolist()):
                    counts[v] += 1
        self.known = np.array(sorted(counts), np.uint64)
        shared = {v: n for v, n in counts.items() if n > 1} if shared is None else shared
        self.shared = np.array(sorted(shared), np.uint64)
        # a shingle of many items says less about each of them
        self.weight = np.array([1 / np.log2(1 + shared[int(v)]) for v in self.shared])
        self._lengths = {}
        for n, group in by_length.items():
            indexes = [ItemIndex(np.concatenate([_packed(signs(v).sum(0, keepdims=True)) for _, v in group]))
                       for signs in (self._weighed, _signs)]
            bags = [self._bag(v) for _, v in group]
            self._lengths[n] = ([i for i, _ in group], bags, *indexes, all((b[2] == 1).all() for b in bags))

    def _weights(self, values: np.ndarray) -> np.ndarray:
        """Weight of each shingle; those of one item or none count fully."""
        if not len(self.shared):
            return np.ones(len(values))
        at = np.minimum(np.searchsorted(self.shared, values), len(self.shared) - 1)
        return np.where(self.shared[at] == values, self.weight[at], 1.0)

    def _weighed(self, values: np.ndarray) -> np.ndarray:
        return _signs(values) * self._weights(values)[:, None]

    def _bag(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Distinct shingles, how often each, their weights, and the weight of all."""
        distinct, counts = np.unique(values, return_counts=True)
        weights = self._weights(distinct)
        return distinct, counts, weights, float((weights * counts).sum())

    @staticmethod
    def similarity(window: np.ndarray, weight: float, bag: tuple[np.ndarray, np.ndarray, np.ndarray, float]) -> float:
        """The larger of the weighted and the plain Jaccard similarity of a window's shingles, of a known weight,
        and an item's bag."""
        distinct, counts, weights, total = bag
        at = np.minimum(np.searchsorted(distinct, window), len(distinct) - 1)
        there = np.bincount(at[distinct[at] == window], minlength=len(distinct))
        same = np.minimum(there, counts)
        both, plain = float((weights * same).sum()), int(same.sum())
        # rounded, so that equal windows stay equal whatever the order of the sums
        return round(max(both / (weight + total - both), plain / (len(window) + int(counts.sum()) - plain)), 9)

    def scan(self, text: str) -> list[tuple[int, int, int, float]]:
        """(item, first word, words, similarity): the best window of each item found.

        For each item length, windows of that many words are fingerprinted at every word; a shorter text is
        one window. Windows whose
        shingles of any item weigh less and are fewer than the least similarity asks for are passed over.
        """
        words = self._hashes.of(text.encode().split())
        best: dict[int, tuple] = {}
        for n_shingle in {min(n, SHINGLE_WORDS) for n in self._lengths}:
            if len(words) < n_shingle:
                continue
            values = shingles(words, n_shingle)
            at = np.minimum(np.searchsorted(self.known, values), len(self.known) - 1)
            hits = np.flatnonzero(self.known[at] == values)
            if not len(hits):
                continue
            lengths = [n for n in self._lengths if min(n, SHINGLE_WORDS) == n_shingle]
            reach = max(lengths)
            # stretches of text around the hits
            cuts = np.flatnonzero(np.diff(hits) > 2 * reach) + 1
            for group in np.split(hits, cuts):
                low, high = max(0, int(group[0]) - reach), min(len(values), int(group[-1]) + reach)
                part = values[low:high]
                weights = self._weights(part)
                sums = np.zeros((len(part) + 1, 2 * BITS + 3))
                signs, known = _signs(part), self.known[at[low:high]] == part
                sums[1:, :BITS] = signs * weights[:, None]
                sums[1:, BITS:2 * BITS] = signs
                sums[1:, 2 * BITS] = weights
                sums[1:, 2 * BITS + 1] = weights * known
                sums[1:, 2 * BITS + 2] = known
                sums = np.cumsum(sums, axis=0)
                for n in lengths:
                    self._windows(n, n - n_shingle + 1, low, part, sums, best)
        return [(item, *found) for item, found in sorted(best.items())]

    def _windows(self, n: int, size: int, low: int, part: np.ndarray, sums: np.ndarray, best: dict) -> None:
        # only the part of a text shorter than the item is shorter than the window, and it is the whole text then
        n, size, (ids, bags, weighed, plain, full) = (
            n - max(0, size - len(part)), min(size, len(part)), self._lengths[n])
        total, known, n_known = (sums[size:, 2 * BITS + i] - sums[:-size, 2 * BITS + i] for i in range(3))
        near = set()
        for index, first, enough in ((weighed, 0, known >= LEAST_SIMILARITY * total - 1e-6),
                                     (plain, BITS, n_known >= LEAST_SIMILARITY * size)):
            if index is plain and full:  # where all weights are 1, both prints are the same
                enough &= total < size - 1e-6
            starts = np.flatnonzero(enough)
            if len(starts):
                prints = _packed(np.round(sums[starts + size, first:first + BITS] - sums[starts, first:first + BITS], 6))
                w, i = index.candidates(prints)
                near.update(zip(starts[w].tolist(), i.tolist(), strict=True))
        for start, i in sorted(near):
            alike = self.similarity(part[start:start + size], float(total[start]), bags[i])
            if alike >= LEAST_SIMILARITY and alike > best.get(ids[i], (0, 0, 0.0))[2]:
                best[ids[i]] = (low + start, n, alike)


def item_shingles(text: str | None, hashes: WordHashes) -> np.ndarray:
    return shingles(hashes.of((text or "").encode().split()), SHINGLE_WORDS)


def shared_shingles(items: DataFrame) -> dict[int, int]:
    """Shingles that several items hold, and how many do."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Words()
        for batch in batches:
            own = [np.unique(item_shingles(t, hashes)) for t in batch.column("text").to_pylist()]
            values = np.concatenate([np.empty(0, np.uint64), *own]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(values)], ["shingle"])

    rows = (items.select("text").mapInArrow(count, "shingle bigint").groupBy("shingle").count()
                 .where("count > 1").collect())
    return {r[0] % (1 << 64): r[1] for r in rows}


@lru_cache(maxsize=1)
def _prepared(items: tuple[tuple[int, str], ...], shared: tuple[tuple[int, int], ...]) -> Benchmark:
    """The benchmark block a Python worker looked at last, kept for its next task."""
    return Benchmark(list(items), dict(shared))


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, items_per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, similarity) for each document that holds an item.

    An item is held where a window of as many words, or the whole of a shorter text, has a weighted or plain similarity of
    ``LEAST_SIMILARITY`` or more over five-word shingles, the larger of which is told; a shingle weighs less
    the more items of the whole benchmark hold it; case and outer punctuation of words do not count.
    The best window of an item is told, the first among equals. Windows are found by fingerprint
    (see ``ItemIndex``) and confirmed on their whole bags of shingles.

    ``benchmark`` is a stated set of queries. It reaches the executors in blocks of
    ``items_per_pass`` items, one scan of the documents per block, so of items
    a task holds no more at once; shingles of several items go to all blocks. Documents are neither shuffled nor joined.

    Null and empty documents and items match nothing. An item shorter than five words
    is one shingle and matches only in full. Repeated document rows give repeated hits; items
    with one item_id are read as one item with the smallest text. An empty benchmark or table gives no rows.
    """
    items = (benchmark.where("item_id IS NOT NULL AND text IS NOT NULL")
                      .groupBy(F.col("item_id").cast("bigint").alias("item_id")).agg(F.min("text").alias("text")))
    n = items.count()
    blocks = max(1, -(-n // items_per_pass))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = like(HITS)
    shared = tuple(sorted(shared_shingles(items).items()))
    found = None
    for b in range(blocks):
        own = tuple(sorted((r["item_id"], r["text"]) for r in items.where(block == b).collect()))

        def scan(batches: Iterator[pa.RecordBatch], own=own) -> Iterator[pa.RecordBatch]:
            prepared = _prepared(own, shared)
            for batch in batches:
                rows = [(doc_id, *hit)
                        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True)
                        if text.is_valid for hit in prepared.scan(text.as_py())]
                columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(v), f.type) for v, f in zip(columns, schema, strict=True)], schema=schema)

        part = texts.mapInArrow(scan, HITS)
        found = part if found is None else found.unionByName(part)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold no item, with all columns; rows without doc_id are kept."""
    lost = benchmark_hits(docs, benchmark).select("doc_id").distinct()
    return docs.join(lost, "doc_id", "left_anti").select(*docs.columns)


def leak_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return benchmark_hits(docs, benchmark).withColumn("similarity", F.round("similarity", 6))
