"""Removal of lines that several documents share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from assetloom.llm.text import SPACE_CHARS, like, mixed
from assetloom.session import materialize

LEAST_CHARS = 10
#: Lines of all documents that one shard of the index answers, or one copy of it where some are very frequent.
TASK_PROBES = 200_000
#: Bits per key on each level of the perfect hash.
SPREAD = 1.5

_EDGE = SPACE_CHARS.encode()


def line_key(line: bytes) -> bytes:
    """The line without white space at both ends, A-Z in lower case, as UTF-8."""
    return line.strip(_EDGE).lower()


def _hashes(text: bytes) -> list[tuple[int, int] | None]:
    """Per line two independent hashes of its key, None for short keys."""
    out = []
    for line in text.split(b"\n"):
        key = line_key(line)
        long_enough = len(key) >= LEAST_CHARS and (len(key) >= 4 * LEAST_CHARS or len(key.decode()) >= LEAST_CHARS)
        whole = xxhash.xxh3_128_intdigest(key) if long_enough else 0
        out.append((_signed(whole >> 64), _signed(whole & 0xFFFFFFFFFFFFFFFF)) if long_enough else None)
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


class PerfectHash:
    """Minimal perfect hash over distinct pairs of 64-bit hashes, built level by level.

    On each level the keys without a rival take their bit; the others go on to
    the next. A key's number is the count of set bits before its own.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # of booleans
        sizes = [int(x.sum()) for x in levels]
        self._before = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self._ranks = [np.cumsum(x) - 1 for x in levels]

    @staticmethod
    def _places(keys: np.ndarray, prints: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((level * 0x9E3779B97F4A7C15 + 1) & 0xFFFFFFFFFFFFFFFF)
        both = mixed(mixed(keys.view(np.uint64) ^ salt) + prints.view(np.uint64))
        return (both % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray, prints: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = max(8, int(len(keys) * SPREAD))
            at = cls._places(keys, prints, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            keys, prints = keys[~alone[at]], prints[~alone[at]]
        return cls(levels)

    def find(self, keys: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Numbers of pairs; one that was not built in gets any number, or -1."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for i, bits in enumerate(self.levels):
            if not len(open_):
                break
            at = self._places(keys[open_], prints[open_], i, len(bits))
            hit = bits[at]
            out[open_[hit]] = self._before[i] + self._ranks[i][at[hit]]
            open_ = open_[~hit]
        return out


class ShardIndex:
    """Arrays of one shard in the order of its perfect hash: second hash as fingerprint,
    number of documents, smallest document."""

    def __init__(self, hash_: PerfectHash, prints: np.ndarray, counts: np.ndarray, firsts: np.ndarray):
        self.hash, self.prints, self.counts, self.firsts = hash_, prints, counts, firsts

    @classmethod
    def build(cls, keys: np.ndarray, prints: np.ndarray, counts: np.ndarray, firsts: np.ndarray) -> ShardIndex:
        hash_ = PerfectHash.build(keys, prints)
        at = hash_.find(keys, prints)
        place = np.empty(len(at), np.int64)
        place[at] = np.arange(len(at))
        return cls(hash_, prints[place], np.minimum(counts[place], 0xFFFFFFFF).astype(np.uint32), firsts[place])

    def to_bytes(self) -> bytes:
        sizes = [len(x) for x in self.hash.levels]
        head = np.array([len(sizes), len(self.prints), *sizes], "<i8").tobytes()
        bits = b"".join(np.packbits(x).tobytes() for x in self.hash.levels)
        return head + self.prints.tobytes() + self.firsts.tobytes() + self.counts.tobytes() + bits

    @classmethod
    def from_bytes(cls, data: bytes) -> ShardIndex:
        n_levels, n = np.frombuffer(data, "<i8", 2)
        sizes = np.frombuffer(data, "<i8", n_levels, 16)
        at = 16 + 8 * int(n_levels)
        prints = np.frombuffer(data, "<i8", n, at)
        firsts = np.frombuffer(data, "<i8", n, at + 8 * n)
        counts = np.frombuffer(data, "<u4", n, at + 16 * n)
        at += 20 * int(n)
        levels = []
        for size in sizes:
            taken = -(-int(size) // 8)
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, taken, at), count=int(size)).astype(bool))
            at += taken
        return cls(PerfectHash(levels), prints, counts, firsts)

    def lose(self, keys: np.ndarray, prints: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Which (line, document) pairs are repeats: the line is in the index and first stands elsewhere."""
        at = self.hash.find(keys, prints)
        known = at >= 0
        at = np.where(known, at, 0)
        if not len(self.prints):
            return np.zeros(len(keys), bool)
        return known & (self.prints[at] == prints) & (self.counts[at] >= 2) & (self.firsts[at] != docs)


LINES = "key bigint, print bigint, doc_id bigint"


def _line_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = like(LINES)
    for batch in batches:
        out: list[list] = [[], [], []]
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            if doc_id is None or not text.is_valid:
                continue
            for key, print_ in {h for h in _hashes(text.as_py().encode()) if h}:
                out[0].append(key)
                out[1].append(print_)
                out[2].append(doc_id)
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out], schema=schema)


PROBES = "shard int, copy int, kind int, key bigint, print bigint, doc_id bigint, index binary"


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard and copy, the index of a shard before its probes."""
    schema = like("doc_id bigint, key bigint")
    index, of = None, None
    for batch in batches:
        shard, kind = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
        cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(kind) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(shard)], strict=True):
            if a == b:
                continue
            if kind[a] == 0:
                index, of = ShardIndex.from_bytes(batch.column("index")[int(a)].as_py()), shard[a]
            elif of == shard[a]:
                part = batch.slice(int(a), int(b - a))
                keys, prints, docs = (part.column(c).to_numpy() for c in ("key", "print", "doc_id"))
                gone = index.lose(keys, prints, docs)
                yield pa.RecordBatch.from_arrays([pa.array(docs[gone]), pa.array(keys[gone])], schema=schema)


def _dealt(docs: DataFrame, shards: int | None) -> tuple[DataFrame, int]:
    """Rows for ``_answer``: the index of each shard, for each of its copies, and the probes; and the shards.

    The shards follow the lines of all documents, as all of them are probes, not only those that are repeated. A shard with
    more than its share of them is copied, and its probes are dealt over the copies.
    """
    lines = materialize(docs.select("doc_id", "text").mapInArrow(_line_hashes, LINES), "lines")
    n_shards = shards or 1 + lines.count() // TASK_PROBES
    shard = F.pmod(F.col("key"), F.lit(n_shards)).cast("int").alias("shard")
    counts = (lines.groupBy("key", "print").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
        .where("first < last").select(shard, "key", "print", "n", "first"))

    def build(key, pdf):
        index = ShardIndex.build(*(pdf[c].to_numpy(np.int64) for c in ("key", "print", "n", "first")))
        return pdf.iloc[:1].assign(shard=np.int32(key[0]), index=index.to_bytes())[["shard", "index"]]

    indexes = materialize(counts.groupBy("shard").applyInPandas(build, "shard int, index binary"), "line-index")
    sized = materialize(lines.groupBy(shard).agg((1 + F.floor(F.count(F.lit(1)) / TASK_PROBES)).cast("int").alias("copies")),
                        "line-shards")
    none = lambda kind: F.lit(None).cast(kind)
    served = indexes.join(sized, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("kind"),
        none("bigint").alias("key"), none("bigint").alias("print"), none("bigint").alias("doc_id"), "index")
    asked = lines.select(shard, "key", "print", "doc_id").join(sized.where("copies > 1"), "shard", "left").select(
        "shard", F.pmod(F.xxhash64("doc_id"), F.coalesce("copies", F.lit(1))).cast("int").alias("copy"),
        F.lit(1).alias("kind"), "key", "print", "doc_id", none("binary").alias("index"))
    return served.unionByName(asked), n_shards


def _by_task(dealt: DataFrame, n_shards: int) -> DataFrame:
    parts = max(n_shards, int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # by ranges: hashing would put several shards into one task and none into others
    return dealt.repartitionByRange(parts, "shard", "copy")


def probes_by_task(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """How many lines each task that answers probes looks up: one row with ``count`` per task that has any."""
    return _by_task(*_dealt(docs, shards)).where("kind = 1").groupBy(F.spark_partition_id().alias("task")).count()


def repeated_lines(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """(doc_id, key): lines each document loses, by the first hash of their keys.

    Lines are counted with a partial aggregate before the shuffle. Those of two or more
    documents make the index: one row of arrays per shard, built in its own task. Probes
    (hashes, not lines) go to the shard that can answer them.
    """
    return (_by_task(*_dealt(docs, shards)).sortWithinPartitions("shard", "copy", "kind")
            .mapInArrow(_answer, "doc_id bigint, key bigint"))


def drop_repeated_lines(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """Documents with ``text`` without its repeated lines, and ``n_lines``, ``n_dropped``.

    A line's key is the line without ASCII white space at both ends and with A-Z in
    lower case. Keys of ten or more code points that two or more documents hold are kept
    only in the smallest ``doc_id``, where all their lines stay. Lines are judged by
    128 bits of hash.

    Null and empty texts are one empty line (a null text becomes empty). Rows with one
    doc_id count as one document; rows without are neither counted nor changed. Other
    columns pass through, whatever their names; ``n_lines`` and ``n_dropped`` of the input are replaced.
    """
    cut = _cut(docs, shards)
    own = [F.col("text") if c == "text" else F.col("row").getField(c).alias(c)
           for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return cut.select(*own, "n_lines", "n_dropped")


def _cut(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """row (the columns of a document without its text), text, n_lines, n_dropped."""
    gone = repeated_lines(docs, shards).groupBy("doc_id").agg(F.collect_set("key").alias("gone"))
    others = F.struct("doc_id", *(F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")))
    packed = docs.select("doc_id", "text", others.alias("row")).join(gone, "doc_id", "left").select("row", "text", "gone")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, lost in zip(batch.column("text"), batch.column("gone"), strict=True):
                data = (text.as_py() or "").encode()
                lines = data.split(b"\n")
                n_lines.append(len(lines))
                if lost.is_valid:
                    keys = set(lost.as_py())
                    lines = [x for x, h in zip(lines, _hashes(data), strict=True) if not h or h[0] not in keys]
                    data = b"\n".join(lines)
                n_dropped.append(n_lines[-1] - len(lines))
                texts.append(data.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=["row", "text", "n_lines", "n_dropped"])

    kind = packed.schema["row"].dataType.simpleString()
    return packed.mapInArrow(rebuild, f"row {kind}, text string, n_lines bigint, n_dropped bigint")


def drop_and_count(docs: DataFrame) -> DataFrame:
    """Documents without their repeated lines, with their columns; ``n_chars``, if there is one, is counted anew."""
    own = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return _cut(docs).select(*(own.get(c, F.col("row").getField(c).alias(c)) for c in docs.columns))


def line_report(docs: DataFrame) -> DataFrame:
    cut = drop_repeated_lines(docs.select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
