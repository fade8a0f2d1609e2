"""Product quantisation of vectors in whole numbers, with pivots that spare exact distances (LAESA)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assetloom.llm.salting import salt_of, salted_lookup
from assetloom.llm.text import like
from assetloom.session import materialize

# The parts of a vector, the entries of a codebook, the rounds and the scale.
PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256

#: Fixed points of each part position whose distances to all parts are written once.
PIVOTS = 6
#: Distances to pivots are kept as whole numbers of this share of one.
FINENESS = 16
#: Vectors that a task codes at a time.
BLOCK = 2048
#: Largest component, scaled: squared distances of parts must fit into 64 bits.
LARGEST = 1 << 26

SUMS = "part int, entry int, at int, n bigint, sum bigint"


def _floor_root(x: np.ndarray) -> np.ndarray:
    root = np.sqrt(x.astype(np.float64)).astype(np.int64)
    root -= root * root > x
    return root + ((root + 1) * (root + 1) <= x)


def _distances(parts: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of ``parts`` (n, width) to ``points`` (k, width), exact."""
    out = np.zeros((len(parts), len(points)), np.int64)
    for at in range(parts.shape[1]):
        out += (parts[:, at, None] - points[None, :, at]) ** 2
    return out


def _fine(squared: np.ndarray) -> np.ndarray:
    """floor(FINENESS * distance)."""
    return _floor_root(squared * FINENESS ** 2)


def choose_pivots(entries: np.ndarray) -> np.ndarray:
    """Up to ``PIVOTS`` of the first codebook's entries, each the farthest from those before."""
    chosen = [0]
    nearest = _distances(entries, entries[:1])[:, 0]
    while len(chosen) < min(PIVOTS, len(entries)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(entries, entries[chosen[-1]][None])[:, 0])
    return entries[chosen]


@dataclass
class Search:
    """Nearest entries of one part position's codebook."""

    entries: np.ndarray
    pivots: np.ndarray
    to_pivots: np.ndarray = field(init=False)

    def __post_init__(self):
        self.to_pivots = _fine(_distances(self.entries, self.pivots))

    def nearest(self, parts: np.ndarray, part_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """For each part its nearest entry (ties to the lower one), the squared distance, and how many
        exact distances all of them took.

        Two distances to a pivot differ by no more than the two points are apart; kept as floors, by
        less than one more. Entries are tried by that bound, least first, until it exceeds the best
        distance found; an entry whose bound only equals it is still tried, for ties.
        """
        bound = np.zeros((len(parts), len(self.entries)), np.int64)
        for at in range(len(self.pivots)):
            np.maximum(bound, np.abs(part_pivots[:, at, None] - self.to_pivots[None, :, at]) - 1, out=bound)
        order = np.argsort(bound, axis=1, kind="stable")
        bound = np.take_along_axis(bound, order, axis=1) ** 2
        best = np.full(len(parts), np.iinfo(np.int64).max)
        code = np.full(len(parts), len(self.entries))
        active, evaluated = np.arange(len(parts)), 0
        for step in range(len(self.entries)):
            if step:
                active = active[bound[active, step] <= best[active] * FINENESS ** 2]
            if not len(active):
                break
            entry = order[active, step]
            squared = ((parts[active] - self.entries[entry]) ** 2).sum(axis=1)
            evaluated += len(active)
            better = (squared < best[active]) | ((squared == best[active]) & (entry < code[active]))
            at = active[better]
            best[at], code[at] = squared[better], entry[better]
        return code, best, evaluated


def _blocks(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Blocks of rows with their components (n, part, width) and distances to pivots (n, part, pivot)."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            block = batch.slice(at, BLOCK)
            shaped = lambda name: np.frombuffer(
                b"".join(block.column(name).to_pylist()), "<i8").reshape(block.num_rows, parts, -1)
            yield block, shaped("ints"), shaped("to_pivots")


def _pivot_distances(pivots: list[np.ndarray]):
    """Adds the components as bytes and their distances to the pivots, which are written once."""
    most = max(len(p) for p in pivots)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ints = np.array(batch.column("ints").to_pylist(), np.int64).reshape(batch.num_rows, len(pivots), -1)
            if ((ints > LARGEST) | (ints < -LARGEST)).any():
                raise ValueError(f"a component times {SCALE} exceeds {LARGEST}")
            far = np.zeros((*ints.shape[:2], most), np.int64)
            for part, own in enumerate(pivots):
                far[:, part, :len(own)] = _fine(_distances(ints[:, part], own))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([x.tobytes() for x in ints], pa.binary()),
                 pa.array([x.tobytes() for x in far], pa.binary())], names=["vec_id", "label", "ints", "to_pivots"])
    return add


def _searches(books: list[np.ndarray], pivots: list[np.ndarray]) -> list[Search]:
    return [Search(entries, own) for entries, own in zip(books, pivots, strict=True)]


def _sum_up(books: list[np.ndarray], pivots: list[np.ndarray]):
    """A task's sums for each part, entry and position; as many rows as the codebooks have components."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = _searches(books, pivots)
        sums = [np.zeros(b.shape, np.int64) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for _, ints, far in _blocks(batches, len(books)):
            for part, search in enumerate(searches):
                own = ints[:, part]
                code, _, _ = search.nearest(own, far[:, part, :len(pivots[part])])
                np.add.at(sums[part], code, own)
                counts[part] += np.bincount(code, minlength=len(counts[part]))
        rows = [(part, entry, at, int(counts[part][entry]), int(sums[part][entry, at]))
                for part in range(len(books)) for entry in np.flatnonzero(counts[part]).tolist()
                for at in range(sums[part].shape[1])]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t.type) for x, t in zip(
                zip(*rows, strict=True), like(SUMS), strict=True)], schema=like(SUMS))
    return add


def _code(books: list[np.ndarray], pivots: list[np.ndarray]):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = _searches(books, pivots)
        for block, ints, far in _blocks(batches, len(books)):
            found = [s.nearest(ints[:, part], far[:, part, :len(pivots[part])]) for part, s in enumerate(searches)]
            codes = np.stack([code for code, _, _ in found], axis=1).astype(np.uint8)
            error = sum(squared for _, squared, _ in found)
            yield pa.RecordBatch.from_arrays(
                [block.column("vec_id"), block.column("label"), pa.array([x.tobytes() for x in codes], pa.binary()),
                 pa.array(error, pa.int64())], names=["vec_id", "label", "codes", "error"])
    return add


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """vec_id, label and ``ints``, the components as floor(SCALE * x), of the vectors that are not null
    and hold neither null nor non-finite components."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
                   .where(F.col("embedding").isNotNull() & finite)
                   .select("vec_id", "label", F.transform("embedding", lambda x: F.floor(x * SCALE).cast("bigint"))
                           .alias("ints")))


@dataclass
class Codebooks:
    """Entries by part position, and the pivots they were found with."""

    books: list[np.ndarray]
    pivots: list[np.ndarray]

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(x) for book in self.books for x in book.ravel().tolist())
                              .encode()).hexdigest()


def _first_codebooks(kept: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The parts of the ``entries`` smallest vec_ids, which also fix the length of a vector."""
    rows = kept.orderBy(F.asc_nulls_last("vec_id"), "ints").limit(entries).select("ints").collect()
    lengths = [len(r["ints"]) for r in rows]
    if not rows or lengths[0] == 0 or lengths[0] % parts:
        return None
    cut = np.array([r["ints"] for r in rows if len(r["ints"]) == lengths[0]], np.int64)
    books = list(cut.reshape(len(cut), parts, -1).transpose(1, 0, 2).copy())
    return Codebooks(books, [choose_pivots(book) for book in books])


def _next_codebooks(measured: DataFrame, old: Codebooks) -> Codebooks:
    """Each entry replaced by the floored mean of its parts; one row for each component reaches the driver."""
    sums = (measured.mapInArrow(_sum_up(old.books, old.pivots), SUMS).groupBy("part", "entry", "at")
                    .agg(F.sum("n").alias("n"), F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")))
    books = [book.copy() for book in old.books]
    for r in sums.collect():
        books[r["part"]][r["entry"], r["at"]] = int(r["sum"]) // r["n"]
    return Codebooks(books, old.pivots)


def code_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, label, code, error, codebooks_sha256 of every vector that can be coded.

    Vectors that are null or hold null or non-finite components go. A component x counts as
    floor(SCALE * x); a vector is cut into ``parts`` equal consecutive parts. The codebook of a part
    position starts as that part of the ``entries`` smallest vec_ids (of equal ids the lesser vector, a
    null id last). In each of ``rounds`` rounds every part goes to its nearest entry
    (squared distance, ties to the lower one) and every used entry becomes the floored mean of its
    parts; then they are assigned once more. ``code`` has two hex digits for each part, ``error`` is
    the sum of the squared distances; rows that repeat are coded alike, each for itself.

    The length of a vector is that of the smallest vec_id. Vectors of another length, and all if that length
    is 0 or no multiple of ``parts``, take no part: their code and error are null. A
    component of more than ``LARGEST`` / SCALE raises. An empty table gives an empty result.

    Each part's distances to the pivots are written once, with the parts. A codebook, ``entries`` times
    the length of a vector, is all that is sent to the tasks and back in a round.
    """
    kept = whole_numbers(vectors)
    start = _first_codebooks(kept, parts, entries)
    if start is None:
        return kept.select("vec_id", "label", F.lit(None).cast("string").alias("code"),
                           F.lit(None).cast("bigint").alias("error"), F.sha2(F.lit(""), 256).alias("codebooks_sha256"))
    length = parts * start.books[0].shape[1]
    usual = F.size("ints") == length
    named = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema if f.name != "ints")
    measured = materialize(kept.where(usual).mapInArrow(
        _pivot_distances(start.pivots), f"{named}, ints binary, to_pivots binary"), "pivot_distances")
    books = start
    for _ in range(rounds):
        books = _next_codebooks(measured, books)
    coded = measured.mapInArrow(_code(books.books, books.pivots), f"{named}, codes binary, error bigint").select(
        "vec_id", "label", F.lower(F.hex("codes")).alias("code"), "error")
    other = kept.where(~usual).select("vec_id", "label", F.lit(None).cast("string").alias("code"),
                                      F.lit(None).cast("bigint").alias("error"))
    return coded.unionByName(other).withColumn("codebooks_sha256", F.lit(books.digest()))


def code_report(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256: ``code_vectors`` with the errors
    of equal labels summed, nulls together."""
    coded = materialize(code_vectors(vectors), "vector_codes")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    return salted_lookup(coded, by_label, ["label"], salt_of("vec_id")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")
