"""Collocations: frequent phrases mined shard by shard, then counted and scored exactly.

The mining is the partition scheme for frequent sets (SON): each shard is mined on its own at a
support lowered to its share of the corpus, the locally frequent phrases are united, and those
that can still be frequent are counted over the whole corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from assetloom.llm.salting import salt_of, salted_lookup
from assetloom.llm.text import GOLDEN, WordHashes, like, mixed, whole
from assetloom.operators.ordering import top_per_group
from assetloom.session import materialize

# The phrases told, their support, the shares and the scale of the score.
LONGEST = 4
SUPPORT = 30
COVERED = 80  # per cent
SCALE = 2_000_000
FIRST = 2000

#: Least bytes of text a shard holds; a shard ends with the row that reaches them.
SHARD_BYTES = 4 << 20
#: Bytes of text for each bucket of phrase hashes.
BUCKET_BYTES = 8 << 20
#: Bytes of text that are cut into words at a time.
CHUNK = 4 << 20

#: Lower-cases A-Z, makes every separator a line break and a tab a space.
_PLAIN = bytearray(range(256))
_PLAIN[65:91] = range(97, 123)
for _mark in b".,;:!?\n\x0b\x0c\r":
    _PLAIN[_mark] = 10
_PLAIN[9] = 32
_PLAIN = bytes(_PLAIN)
#: Stands between pieces; no byte of UTF-8.
BREAK = b"\xff"

DEALT = "lang string, text binary, shard bigint"
MINED = "bucket bigint, shard bigint, support bigint, keys binary, counts binary"
CANDIDATES = "shard bigint, bucket bigint, keys binary"
COUNTED = "lang string, words int, phrase string, n bigint"


def words_of_texts(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The words of all texts in order, some megabytes at a time, with ``BREAK`` after each piece."""
    data = b"\n".join(texts).translate(_PLAIN)
    at = 0
    while at < len(data):
        end = data.find(b"\n", at + CHUNK) + 1 or len(data)
        yield data[at:end].replace(b"\n", b" \xff ").split() + [BREAK]
        at = end


def _sizes(total: int) -> tuple[int, int]:
    """Least bytes of a shard, and the number of hash buckets, a power of two. Shards grow with the root of
    the corpus, so that shards times buckets, the blocks that are sent, grow only as it does."""
    least = max(SHARD_BYTES, 16 * math.isqrt(total))
    return least, 1 << max(0, math.ceil(total * SHARD_BYTES / (BUCKET_BYTES * least)) - 1).bit_length()


def _deal(least: int):
    """Adds ``shard``: consecutive rows of an input partition, up to ``least`` bytes and a row."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            own = []
            for length in pc.binary_length(batch.column("text")).to_pylist():
                if size >= least:
                    shard, size = shard + 1, 0
                size += length
                own.append(shard)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int64())], schema=like(DEALT))
    return deal


def _texts_by_lang(table: pa.Table) -> dict[str, list[bytes]]:
    out: dict[str, list[bytes]] = {}
    for lang, text in zip(table.column("lang").to_pylist(), table.column("text").to_pylist(), strict=True):
        out.setdefault(lang, []).append(text)
    return out


def _levels(lang: str, hashes: np.ndarray, stop: np.uint64, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each phrase length: which positions start such a phrase, and its key there. The high half of a
    key is the bucket; equal phrases of a language have equal keys, others seldom."""
    plain = hashes != stop
    mix = mixed(hashes ^ np.uint64(xxhash.xxh3_64_intdigest(lang)))
    starts = plain
    for length in range(1, LONGEST + 1):
        if length > 1:
            if len(hashes) < length:
                return
            starts = starts[:-1] & plain[length - 1:]
            mix = mixed(mix[:-1] * GOLDEN + hashes[length - 1:])
        high = mix >> np.uint64(64 - bits) if bits else np.zeros_like(mix)
        yield starts, (high << np.uint64(32)) | (mix & np.uint64(0xFFFFFFFF))


def _packed(values: np.ndarray, rising: bool = True) -> bytes:
    """32-bit values, rising ones as steps, by planes of bytes: the high bytes are mostly 0 and compress well."""
    steps = np.diff(values.astype("<u4"), prepend=np.uint32(0)) if rising else values.astype("<u4")
    return np.ascontiguousarray(steps, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(data: bytes, rising: bool = True) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, len(data) // 4)
    values = np.ascontiguousarray(planes.T).view("<u4").ravel()
    return np.cumsum(values, dtype=np.uint32) if rising else values


def _mine(total: int, support: int, bits: int):
    """Locally frequent phrases of each shard: for each bucket one row of sorted keys and their counts."""
    stop = np.uint64(WordHashes()[BREAK])

    def blocks(shard: int, texts: dict[str, list[bytes]]) -> Iterator[dict]:
        size = sum(len(x) for own in texts.values() for x in own)
        # a phrase that reaches its share of the support in no shard does not reach the support
        least = max(1, -(-support * size // total))
        hashes, every = WordHashes(), []
        for lang, own in texts.items():
            ids = [hashes.of(words) for words in words_of_texts(own)]
            if ids:
                every += [keys[starts] for starts, keys in _levels(lang, np.concatenate(ids), stop, bits)]
        keys, counts = np.unique(np.concatenate(every) if every else np.empty(0, np.uint64), return_counts=True)
        frequent = counts >= least
        keys, counts = keys[frequent], counts[frequent]
        cuts = np.searchsorted(keys, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32))
        for bucket in range(1 << bits):  # empty ones too: they tell what the shard may hold unseen
            here = slice(cuts[bucket], cuts[bucket + 1])
            yield {"bucket": bucket, "shard": shard, "support": least,
                   "keys": _packed(keys[here] & np.uint64(0xFFFFFFFF)), "counts": _packed(counts[here], rising=False)}

    def mine(key: tuple, rows: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(list(blocks(key[0].as_py(), _texts_by_lang(rows))), like(MINED))
    return mine


def _unite(support: int):
    """Of the phrases of a bucket those that may be frequent, told to each shard that may hold them.

    A shard that does not tell a phrase has it at most once less than its own support. A shard with support 1 tells
    all it has, so it hears of its own phrases only; the others, fewer than ``support``, hear of all.
    """
    def unite(key: tuple, rows: pa.Table) -> pa.Table:
        keys = [_unpacked(x) for x in rows.column("keys").to_pylist()]
        counts = np.concatenate([_unpacked(x, rising=False) for x in rows.column("counts").to_pylist()]).astype(np.int64)
        unseen = rows.column("support").to_numpy() - 1
        distinct, of = np.unique(np.concatenate(keys), return_inverse=True)
        most = np.zeros(len(distinct), np.int64)
        np.add.at(most, of, counts - np.repeat(unseen, [len(x) for x in keys]))
        wanted = most + unseen.sum() >= support
        ends = np.cumsum([len(x) for x in keys])
        out = []
        for shard, own, end, less in zip(rows.column("shard").to_pylist(), keys, ends, unseen, strict=True):
            told = distinct[wanted] if less else own[wanted[of[end - len(own):end]]]
            if len(told):
                out.append({"shard": shard, "bucket": key[0].as_py(), "keys": _packed(told)})
        return pa.Table.from_pylist(out, like(CANDIDATES))
    return unite


def _rows(lang: str, length: int, phrases: list[bytes], counts: np.ndarray) -> pa.Table:
    n = len(phrases)
    return pa.Table.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), n), pa.array(np.full(n, length, np.int32)),
                                 pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())],
                                schema=like(COUNTED))


def _count(bits: int):
    """The exact counts of a shard's candidates, by their words; ``words`` 0 counts all words of a language."""
    stop = np.uint64(WordHashes()[BREAK])

    def counted(lang: str, texts: list[bytes], wanted: np.ndarray) -> Iterator[pa.Table]:
        hashes, ids, names = WordHashes(), {}, []
        codes, keys = [], []
        for words in words_of_texts(texts):
            keys.append(hashes.of(words))
            for word in set(words).difference(ids):
                ids[word] = len(names)
                names.append(word)
            codes.append(np.fromiter(map(ids.__getitem__, words), np.int64, len(words)))
        if not codes:
            return
        codes, keys = np.concatenate(codes), np.concatenate(keys)
        yield _rows(lang, 0, [b""], np.array([np.count_nonzero(keys != stop)]))
        marked = np.zeros(1 << 20, bool)
        marked[wanted & np.uint64((1 << 20) - 1)] = True
        phrases, ones = [], np.full(len(codes), -1, np.int64)  # of the last length: its phrase at each position
        for length, (starts, key) in enumerate(_levels(lang, keys, stop, bits), 1):
            at = np.flatnonzero(starts & marked[key & np.uint64((1 << 20) - 1)])
            found = wanted[np.minimum(np.searchsorted(wanted, key[at]), len(wanted) - 1)] == key[at]
            at = at[found]
            if length > 1:  # the first words of a frequent phrase are one
                at = at[ones[at] >= 0]
                pair = (ones[at] << 32) | codes[at + length - 1]
            else:
                pair = codes[at]
            distinct, of, n = np.unique(pair, return_inverse=True, return_counts=True)
            phrases = ([names[p] for p in distinct.tolist()] if length == 1 else
                       [phrases[p >> 32] + b" " + names[p & 0xFFFFFFFF] for p in distinct.tolist()])
            ones = np.full(len(codes), -1, np.int64)
            ones[at] = of
            yield _rows(lang, length, phrases, n)

    def count(key: tuple, rows: pa.Table, candidates: pa.Table) -> pa.Table:
        out = [_rows("", 0, [], np.empty(0, np.int64))]
        wanted = [_unpacked(x).astype(np.uint64) | np.uint64(bucket << 32) for bucket, x in zip(
            candidates.column("bucket").to_pylist(), candidates.column("keys").to_pylist(), strict=True)]
        wanted = np.sort(np.concatenate(wanted)) if wanted else np.array([1 << 63], np.uint64)
        for lang, texts in _texts_by_lang(rows).items():
            out += counted(lang, texts, wanted)
        return pa.concat_tables(out)
    return count


def phrase_counts(docs: DataFrame, support: int = SUPPORT) -> DataFrame:
    """lang, words, phrase, n: every phrase of 1 to ``LONGEST`` words with ``support`` occurrences, exactly;
    with ``words`` 0 all word occurrences of a language.

    ``docs`` (lang, text). A-Z count as a-z; phrases do not cross ``.,;:!?`` or line breaks; a null text is
    empty and a null lang is ``und``. The result depends on neither shards nor buckets.
    """
    plain = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), whole("text").cast("binary").alias("text"))
    total = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 1
    least, buckets = _sizes(total)
    bits = buckets.bit_length() - 1
    dealt = materialize(plain.mapInArrow(_deal(least), DEALT), "shards")
    mined = dealt.groupBy("shard").applyInArrow(_mine(total, support, bits), MINED)
    candidates = mined.groupBy("bucket").applyInArrow(_unite(support), CANDIDATES)
    counted = dealt.groupBy("shard").cogroup(candidates.groupBy("shard")).applyInArrow(_count(bits), COUNTED)
    return (counted.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
                   .where((F.col("n") >= support) | (F.col("words") == 0)))


def _wide(count: Column) -> Column:
    """A count whose products do not overflow."""
    return count.cast("decimal(19,0)")


def score_of(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a / (left + right)), exact for counts of any size."""
    return F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * _wide(a), _wide(left) + _wide(right))


def collocations(docs: DataFrame, support: int = SUPPORT, first: int = FIRST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of 2 to 4 words of each language.

    ``a`` are a phrase's occurrences, ``n`` those of all words. Cut after its first k words, its parts have
    ``l`` and ``r`` occurrences and score floor(SCALE * a / (l + r)); the least cut counts, among equals that
    of the smallest k. A phrase goes if a longer one of the counted phrases holds it and has ``COVERED`` per
    cent of its occurrences. The first ``first`` are told, by score, a (both descending) and phrase (bytes
    ascending). Without frequent phrases, as in an empty table, the result is empty.
    """
    counts = materialize(phrase_counts(docs, support), "phrase_counts")
    phrases = counts.where("words > 0").select("lang", "phrase", "n")
    long = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"),
                                           F.split("phrase", " ").alias("own"))
    part = lambda start, length: F.array_join(F.slice("own", start, length), " ")
    cuts = long.select("lang", "phrase", "a", "own", "words",
                       F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
        part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    # a common word begins or ends a large share of all phrases
    side = lambda name, n: phrases.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    half = materialize(salted_lookup(cuts, side("left", "l"), ["lang", "left"], salt_of("phrase")), "cuts")
    sides = salted_lookup(half, side("right", "r"), ["lang", "right"], salt_of("phrase"))
    scored = (sides.withColumn("score", score_of(F.col("a"), F.col("l"), F.col("r"))).groupBy("lang", "phrase")
                   .agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut")).select("lang", "phrase", "cut.*"))
    inner = (long.where("words > 2").select("lang", "a", "own", "words",
                                           F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("length"))
                 .select("lang", "a", "own", "length",
                         F.explode(F.sequence(F.lit(1), F.col("words") - F.col("length") + 1)).alias("start"))
                 .groupBy("lang", part(F.col("start"), F.col("length")).alias("phrase")).agg(F.max("a").alias("longer")))
    kept = (scored.join(inner, ["lang", "phrase"], "left")
                  .where(F.col("longer").isNull() | (_wide(F.col("longer")) * 100 < _wide(F.col("a")) * COVERED)))
    top = top_per_group(kept, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], first)
    words = counts.where("words = 0").select("lang", "n")
    return top.join(words, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r",
                                          "n", "score")
