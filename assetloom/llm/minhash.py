"""Near duplicates by one-permutation hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from assetloom.llm.components import components
from assetloom.llm.salting import salt_of, salted_lookup
from assetloom.llm.text import GOLDEN, WordHashes, like, mixed, shingles
from assetloom.session import materialize

BANDS, ROWS = 32, 5
BINS = BANDS * ROWS
#: Star centres per bucket in the first round, and how much more in each further one.
CENTERS, FASTER = 1, 16
#: Marks of three bits, any two of which differ in two bits, so differing bits count differing bins.
MARKS = np.array([0b000, 0b011, 0b101, 0b110], np.uint64)
MARKS_PER_LONG, LONGS = 21, -(-BINS // 21)
#: Longs of a parity sketch; sets of more than 2048 shingles have half a bit to one bit a shingle.
PARITY_LONGS = 16

SIGNED = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, sketch array<bigint>, parity array<bigint>"
SPACED = "node bigint, set_a bigint, set_b bigint, n_shingles bigint, apart bigint, size bigint, end bigint, items array<bigint>"


def shingle_set(text: bytes, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``n`` words, A-Z in lower case."""
    return np.unique(shingles(hashes.of(text.lower().split()), n))


_EDGES = (np.arange(BINS + 1, dtype=object) * (1 << 64) // BINS)
_STARTS = np.array(_EDGES[:-1], dtype=np.uint64)


def smallest(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest value of each bin of a sorted set, and which bins have one."""
    at = np.searchsorted(values, _STARTS)
    filled = np.append(at[1:], len(values)) > at
    out = np.zeros(BINS, np.uint64)
    out[filled] = values[at[filled]]
    return out, filled


def sketch(values: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """A mark per bin, packed: one for an empty bin, else one of three by its smallest value.

    Where two sets' marks differ, the smaller of the two smallest values is in one set only,
    so the number of such bins is a lower bound of the size of their symmetric difference.
    """
    marks = np.zeros(LONGS * MARKS_PER_LONG, np.uint64)
    marks[:BINS] = MARKS[np.where(filled, mixed(values) % np.uint64(3) + np.uint64(1), np.uint64(0))]
    shifts = np.arange(MARKS_PER_LONG, dtype=np.uint64) * np.uint64(3)
    return (marks.reshape(LONGS, -1) << shifts).sum(1, dtype=np.uint64).view(np.int64)


def differing_bits(a: str, b: str) -> Column:
    """Two for each bin with different marks in two sketch columns."""
    total = F.lit(0)
    for i in range(LONGS):
        total = total + F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))))
    return total


def may_link(percent: int) -> Column:
    """Whether sizes and sketches of a node and a centre allow a similarity of ``percent``; never false for a link."""
    low, high = F.least("n_shingles", "center_n"), F.greatest("n_shingles", "center_n")
    return (100 * low >= percent * high) & (
        (100 + percent) * differing_bits("sketch", "center_sketch") <= 2 * (100 - percent) * (low + high))


def parity(values: np.ndarray) -> np.ndarray:
    """Whether the number of hashes that fall on a bit is odd, for each of 1024 bits, or of a larger power of two.

    A hash that is in one of two sets only turns one bit, so the number of bits in which two sketches differ is a lower
    bound of the size of the symmetric difference. Both halves put together are the sketch of half the length.
    """
    bits = max(64 * PARITY_LONGS, 1 << max(0, len(values) // 2 - 1).bit_length())
    odd = np.bincount((mixed(values) % np.uint64(bits)).astype(np.int64), minlength=bits) % 2
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def turned_bits(a: str, b: str) -> Column:
    """The number of different bits of two parity columns, the longer one folded to the length of the other."""
    written_out = F.lit(0)
    for i in range(PARITY_LONGS):
        written_out = written_out + F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))))
    longs = F.least(F.size(a), F.size(b))

    def folded(column: str, i: Column) -> Column:
        return F.aggregate(F.sequence(i, F.size(column) - 1, longs), F.lit(0).cast("bigint"),
                           lambda bits, j: bits.bitwiseXOR(F.get(column, j)))

    any_length = F.aggregate(F.sequence(F.lit(0), longs - 1), F.lit(0),
                             lambda total, i: total + F.bit_count(folded(a, i).bitwiseXOR(folded(b, i))))
    return F.when(F.greatest(F.size(a), F.size(b)) == PARITY_LONGS, written_out).otherwise(any_length)


def near_enough(percent: int) -> Column:
    """As ``may_link``, by the parity sketches, which tell more of sets that differ in many shingles."""
    return ((100 + percent) * turned_bits("parity", "center_parity")
            <= (100 - percent) * (F.col("n_shingles") + F.col("center_n")))


def signature(out: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """One-permutation signature: the smallest value of each bin; at least one bin is filled.

    An empty bin takes the value of a filled bin drawn by a hash of the bin and the
    number of the draw (optimal densification), the same draw for every document.
    """
    out = out.copy()
    empty = np.flatnonzero(~filled)
    draw = np.uint64(1)
    while len(empty):
        drawn = (mixed(empty.astype(np.uint64) * GOLDEN + draw) % np.uint64(BINS)).astype(np.int64)
        good = filled[drawn]
        out[empty[good]] = out[drawn[good]]
        empty = empty[~good]
        draw += np.uint64(1)
    return out


def band_hashes(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        out = mixed(out * GOLDEN + rows[:, i])
    return out.view(np.int64)


def name_of(values: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    name = np.frombuffer(xxhash.xxh3_128_digest(values.tobytes()), ">i8")
    return int(name[0]), int(name[1])


def signed_documents(docs: DataFrame, n: int) -> DataFrame:
    """Per document: set size, 128 bits that name the set, band hashes (none for an empty set)."""
    schema = like(SIGNED)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for text in batch.column("text"):
                values = shingle_set((text.as_py() or "").encode(), n, hashes)
                bands = marks = odd = np.zeros(0, np.int64)
                if len(values):
                    bins = smallest(values)
                    bands, marks, odd = band_hashes(signature(*bins)), sketch(*bins), parity(values)
                row = (len(values), *name_of(values), bands, marks, odd)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()),
                 *(pa.array(v, f.type) for v, f in zip(out, list(schema)[1:], strict=True))], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(sign, SIGNED)


def confirmed(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    def texts_of(side: str) -> DataFrame:
        """Texts that a pair needs; the others are not shuffled where the pairs are few."""
        texts = docs.select(F.col("doc_id").alias(side), F.col("text").alias(f"text_{side}"))
        return texts.join(pairs.select(side).distinct(), side, "left_semi")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        recent: dict[int, np.ndarray] = {}

        def values(doc: int, text: pa.Scalar) -> np.ndarray:
            if doc not in recent:
                if len(recent) > 256:
                    recent.clear()
                recent[doc] = shingle_set((text.as_py() or "").encode(), n, hashes)
            return recent[doc]

        for batch in batches:
            kept = []
            rows = zip(batch.column("a").to_pylist(), batch.column("text_a"),
                       batch.column("b").to_pylist(), batch.column("text_b"), strict=True)
            for i, (a, text_a, b, text_b) in enumerate(rows):
                x, y = values(a, text_a), values(b, text_b)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    continue
                same = len(np.intersect1d(x, y, assume_unique=True))
                if same and 100 * same >= percent * (len(x) + len(y) - same):
                    kept.append(i)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return pairs.join(texts_of("a"), "a").join(texts_of("b"), "b").select("a", "text_a", "b", "text_b").mapInArrow(
        check, "a bigint, b bigint")


def spaced(texts: DataFrame, references: DataFrame, n: int) -> DataFrame:
    """Per set of the nodes of ``references`` (node, reference): its shingles, and what it and its reference's set differ in.

    Two sets differ in as many shingles as their differences from a third set do, so sets of one reference can be held against
    each other by those alone, and need not be (they have the same ``apart``) by their shingles. A set that
    shares less than three quarters with its reference has no such row. Items of a reference are hashed with it, as is ``end``.
    """
    def space(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, schema = WordHashes(), like(SPACED)
        last: tuple[int | None, np.ndarray] = None, np.zeros(0, np.uint64)
        for batch in batches:
            columns = (batch.column(c) for c in ("node", "text", "reference", "reference_text"))
            for node, text, reference, reference_text in zip(*columns, strict=True):
                if reference.as_py() != last[0]:
                    last = reference.as_py(), shingle_set((reference_text.as_py() or "").encode(), n, hashes)
                own = shingle_set((text.as_py() or "").encode(), n, hashes)
                other = np.setxor1d(own, last[1], assume_unique=True)
                by = mixed(np.array([last[0]], np.int64).view(np.uint64))
                near = 2 * len(other) <= len(own)
                spaces = [(last[0] if near else None, None, own)]
                if near:
                    spaces.append((None, int(by.view(np.int64)[0]), mixed(other * GOLDEN + by)))
                rows = [(node.as_py(), *name_of(own), len(own), apart, len(items), end, items.view(np.int64))
                        for apart, end, items in spaces]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    own = texts.withColumnRenamed("doc_id", "node").join(references, "node")
    third = (texts.withColumnRenamed("doc_id", "reference").join(references.select("reference").distinct(), "reference", "left_semi")
                  .groupBy("reference").agg(F.min("text").alias("reference_text")))
    # one text may be the reference of a large share of all nodes
    beside = salted_lookup(own, third, ["reference"], salt_of("node"))
    return (beside.select("node", "text", "reference", "reference_text").mapInArrow(space, SPACED)
               .dropDuplicates(["node", "set_a", "set_b", "end"]))


def prefixes(texts: DataFrame, references: DataFrame, n: int, percent: int) -> DataFrame:
    """(bucket, node, set_a, set_b, apart, slack) for the first items of each set of ``spaced``, in order of how few sets have them.

    A bucket is an item of several sets. Of two sets, all that comes before their first common item is in one set only, so
    ``slack``, (100 - percent) * shingles - (100 + percent) * items before it, adds up to 0 or more in that bucket if they
    are similar by ``percent``. Differences also end in an item that all of their reference have, for sets that
    differ from it in nothing common. Items that come too late for any other set end the list.
    """
    sets = materialize(spaced(texts, references, n), "spaced")
    key = ["node", "set_a", "set_b", "apart", "n_shingles", "size", "end"]
    rows = sets.select(*key, F.explode("items").alias("bucket"))
    held = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    of_set = W.partitionBy("node", "set_a", "set_b", "end")
    alone = F.col("size") - F.count(F.lit(1)).over(of_set)
    placed = rows.join(held, "bucket").select(
        *key, "bucket", (alone + F.row_number().over(of_set.orderBy("n", "bucket")) - 1).alias("before"))
    ends = sets.where("end IS NOT NULL").select(*key, F.col("end").alias("bucket"), F.col("size").alias("before"))
    # more than this before it, in one of two similar sets only: of their shingles, or of both their shingles
    late = (F.when(F.col("end").isNull(), 100 * F.col("before") > (100 - percent) * F.col("n_shingles"))
             .otherwise(percent * F.col("before") > (100 - percent) * F.col("n_shingles")))
    return placed.unionByName(ends).where(~late).select(
        "bucket", "node", "set_a", "set_b", F.coalesce("apart", F.xxhash64(F.lit("own"), "node")).alias("apart"),
        ((100 - percent) * F.col("n_shingles") - (100 + percent) * F.col("before")).alias("slack"))


def within_reach(buckets: DataFrame, part: str = "component") -> DataFrame:
    """Rows whose bucket has a row of another ``part``, with slacks that add up to 0 or more."""
    first = buckets.groupBy("bucket").agg(F.max(F.struct("slack", part)).alias("first"))
    other = (buckets.join(first, "bucket").where(F.col(part) != F.col(f"first.{part}"))
                    .groupBy("bucket").agg(F.first("first").alias("first"), F.max("slack").alias("other")))
    best = F.when(F.col(part) == F.col(f"first.{part}"), F.col("other")).otherwise(F.col("first.slack"))
    return buckets.join(other, "bucket").where(F.col("slack") + best >= 0).select(*buckets.columns)


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, n_copies (documents with its very set).

    Documents whose sets of ``n``-word shingles have a Jaccard similarity of ``percent`` per
    cent or more are linked; ``component_id`` is the smallest doc_id reachable, and the
    document that bears it is kept.

    Documents with one and the same set are one node. Nodes that share a band of the
    signature share a bucket (``BANDS`` of ``ROWS`` values: a pair at 85 per cent shares none with
    a chance of 10^-8, at 80 per cent of 4 * 10^-6). A bucket gives star-shaped edges from its
    most shared node, not all pairs. Edges are confirmed on whole sets. Nodes of
    buckets that still have several components are dealt anew, by their rarest shingles (see ``prefixes``), which
    keeps texts that are all a little less alike than ``percent`` apart. There the nodes with the fewest
    rarer shingles are centres, 16 times as many in each round, until no node has one of another
    component within its reach that it was not compared with. A node and a centre whose set sizes, places or sketches rule the
    similarity out make no edge (exact bounds, see ``sketch`` and ``parity``); no other pair of a bucket goes untested.

    Null and empty texts and texts of white space have no shingles and are linked
    with nothing; fewer than ``n`` words make one shingle. Rows with one doc_id are one
    document; rows without doc_id have no component and are kept. An empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = materialize(signed_documents(texts, n), "signatures")
    full = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    sets = full.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("n_copies"))
    sets = materialize(sets, "sets")
    nodes = full.join(sets.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    nodes = nodes.withColumnRenamed("doc_id", "node")
    marks = nodes.select("node", "set_a", "set_b", "n_shingles", "sketch", "parity").distinct()
    placed = nodes.select("node", F.posexplode("bands").alias("band", "hash")).select(
        F.xxhash64("band", "hash").alias("bucket"), "node")
    sizes = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = materialize(placed.join(sizes, "bucket"), "buckets")
    weights = shared.groupBy("node").agg(F.sum("n").alias("weight"))
    open_ = materialize(shared.join(weights, "node").join(marks, "node")
                        .select("bucket", "node", "weight", F.lit(0).cast("bigint").alias("slack"), F.col("node").alias("apart"),
                                "n_shingles", "sketch", "parity", F.col("node").alias("component")), "weighed")

    tested = None
    labels = open_.select("node", "component").where("1 = 0")
    banded, centers = True, CENTERS
    by_weight = W.partitionBy("bucket").orderBy(F.desc("weight"), "node")
    while not open_.isEmpty():
        ranked = open_.withColumn("rank", F.row_number().over(by_weight))
        tops = (ranked.where(F.col("rank") <= centers)
                      .select("bucket", F.col("node").alias("center"), F.col("component").alias("of"),
                              F.col("slack").alias("center_slack"), F.col("apart").alias("center_apart"),
                              F.col("weight").alias("center_weight"), F.col("n_shingles").alias("center_n"),
                              F.col("sketch").alias("center_sketch"), F.col("parity").alias("center_parity")))
        linkable = ((F.col("component") != F.col("of")) & (F.col("apart") != F.col("center_apart"))
                    & (F.col("slack") + F.col("center_slack") >= 0) & may_link(percent) & near_enough(percent))
        pairs = (open_.join(tops, "bucket").where(linkable)
                      .select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b")).distinct())
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = materialize(confirmed(pairs, texts, n, percent), "links")
        if not found.isEmpty():  # else the components stay as they are
            known = labels.select(F.col("component").alias("a"), F.col("node").alias("b"))
            labels = components(known.unionByName(found))

        def labelled(rows: DataFrame, labels: DataFrame = labels) -> DataFrame:
            return rows.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))

        # nodes that have been centres are done in their bucket
        left = within_reach(labelled(ranked.where(F.col("rank") > centers).drop("rank", "component")))
        if banded:
            left = materialize(left.select("bucket", "node"), "left")
            references = left.join(tops, "bucket").groupBy("node").agg(
                F.max(F.struct("center_weight", "center")).getField("center").alias("reference"))
            rare = materialize(prefixes(texts, materialize(references, "references"), n, percent), "prefixes")
            left = (within_reach(within_reach(labelled(rare)), "apart").withColumn("weight", F.col("slack"))
                    .join(marks, ["node", "set_a", "set_b"]).select(*open_.columns))
            banded = False
        else:
            left, centers = within_reach(left, "apart"), centers * FASTER
        open_ = materialize(left, "open")

    name = sets.join(labels.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select(
        "set_a", "set_b", F.coalesce("component", "node").alias("component_id"), "n_copies")
    linked = signed.join(name, ["set_a", "set_b"], "left").withColumn(
        "component_id", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id"))
                         .otherwise(F.col("doc_id")))
    return linked.select("doc_id", "n_shingles", "component_id",
                         F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
                         F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("n_copies")), F.lit(1)).cast("bigint")
                          .alias("n_copies"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Documents without the near duplicates of a smaller doc_id, with all columns."""
    lost = near_duplicates(docs, n, percent).where("NOT kept").select("doc_id").distinct()
    return docs.join(lost, "doc_id", "left_anti").select(*docs.columns)


def near_report(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, 3, 85).select("doc_id", "n_shingles", "component_id", "kept", "n_copies")
