"""Packing of tokenised documents into sequences of fixed length."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assetloom.llm.text import like, texts_of
from assetloom.operators.ordering import number_rows
from assetloom.session import materialize

CAPACITY = 2048
#: Chunks of text whose ids a worker remembers.
CACHE_CHUNKS = 300_000
# The vocabulary's special token, and the id that ends a document.
SPECIAL, END_ID = "<|endoftext|>", 0

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class _Chunks(dict):
    """Text between single spaces -> its ids as little-endian bytes.

    The vocabulary's pattern starts a new token at a space between two other
    signs, so ids of such chunks can be joined. A chunk that is empty or has white
    space at an edge is not one of those and is None.
    """

    def __init__(self, encode, lead: str):
        super().__init__()
        self._encode, self._lead = encode, lead

    def __missing__(self, chunk: str) -> bytes | None:
        if len(self) > CACHE_CHUNKS:
            self.clear()
        odd = not chunk or chunk[0].isspace() or chunk[-1].isspace()
        self[chunk] = ids = None if odd else np.array(self._encode(self._lead + chunk), "<u4").tobytes()
        return ids


class Encoder:
    """Ids of whole texts: those of the tokenizer file, computed faster.

    Words are encoded with the same vocabulary in its rank form and remembered. Texts that
    contain the special token go to the tokenizer itself.
    """

    def __init__(self, tokenizer_file: str, ranks_file: str, pattern: str):
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._plain = fast.encode_ordinary
        self._full = Tokenizer.from_file(tokenizer_file)
        self._first, self._next = _Chunks(self._plain, ""), _Chunks(self._plain, " ")

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit bytes."""
        if not text:
            return b""
        if SPECIAL in text:
            return np.array(self._full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, *rest = text.split(" ")
        try:
            return self._first[first] + b"".join(map(self._next.__getitem__, rest))
        except TypeError:  # an odd chunk: white space of other kinds or several spaces
            return np.array(self._plain(text), "<u4").tobytes()


def token_pieces(docs: DataFrame, files: tuple[str, str, str], capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` tokens, one row each, without the ids themselves.

    A document is its ids and one end id; only the first piece of a longer one is shorter.
    """
    schema = like(PIECES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*files)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                ids = encoder.encode(text) + end
                n = len(ids) // 4
                edges = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    for column, value in zip(out, (doc_id, piece, a, b - a, zlib.crc32(ids[4 * a:4 * b])),
                                             strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(out, schema, strict=True)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list, int]:
    """Bins for ``counts`` items of each length: slots (length, first rank, per bin, bins,
    first bin, offset), and the number of bins.

    Items over a third of the capacity go first, longest first: each is paired with the longest
    other such item that still fits, so at most two share a bin. Smaller items, longest first,
    go to the bins with the tightest gap that takes them. Equal bins are handled as one group, so
    the work follows the number of different lengths, not of items.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    used: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # gap -> (first bin, bins, offset)
    slots: list[tuple[int, int, int, int, int, int]] = []
    bins = 0

    def put(length: int, per_bin: int, n_bins: int, first_bin: int, offset: int) -> None:
        slots.append((length, used[length], per_bin, n_bins, first_bin, offset))
        used[length] += per_bin * n_bins
        left[length] -= per_bin * n_bins

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        for partner in large:
            if partner > n or partner + n > capacity or not left[partner] or not left[n]:
                continue
            pairs = left[n] // 2 if partner == n else min(left[n], left[partner])
            if pairs:
                if partner == n:
                    put(n, 2, pairs, bins, 0)
                else:
                    put(n, 1, pairs, bins, 0)
                    put(partner, 1, pairs, bins, n)
                gaps[capacity - n - partner].append((bins, pairs, n + partner))
                bins += pairs
        if left[n]:
            gaps[capacity - n].append((bins, left[n], n))
            alone = left[n]
            put(n, 1, alone, bins, 0)
            bins += alone
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            fitting = min((g for g in gaps if g >= n and gaps[g]), default=None)
            if fitting is None:
                per_bin = capacity // n
                new = -(-left[n] // per_bin)
                gaps[capacity].append((bins, new, 0))
                bins += new
                fitting = capacity
            first_bin, n_bins, offset = gaps[fitting].pop()
            per_bin = fitting // n
            full = min(n_bins, left[n] // per_bin)
            if full:
                put(n, per_bin, full, first_bin, offset)
                gaps[fitting - per_bin * n].append((first_bin, full, offset + per_bin * n))
            rest = left[n]
            if full < n_bins:
                first_bin, n_bins = first_bin + full, n_bins - full
                if rest and rest < per_bin:
                    put(n, rest, 1, first_bin, offset)
                    gaps[fitting - rest * n].append((first_bin, 1, offset + rest * n))
                    first_bin, n_bins = first_bin + 1, n_bins - 1
                if n_bins:
                    gaps[fitting].append((first_bin, n_bins, offset))
    return slots, bins


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with doc_id, piece and length.

    Only the histogram of lengths (at most ``capacity`` rows) reaches the driver. Its
    plan says which ranks among the pieces of a length go where; the pieces are numbered
    in order of length in parallel, so a length shared by a third of them is no hot key.
    """
    counted = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots, _ = plan_bins(counted, capacity)
    slots.sort()
    starts, total = {}, 0
    for n in sorted(counted):
        starts[n] = total
        total += counted[n]
    # global number of a piece in order of length -> its slot
    first = np.array([starts[s[0]] + s[1] for s in slots], np.int64)
    length, _, per_bin, _, first_bin, offset = (np.array(x, np.int64) for x in zip(*slots, strict=True)) if slots \
        else (np.zeros(0, np.int64),) * 6
    numbered = number_rows(pieces, ["length", *(c for c in pieces.columns if c != "length")], start=0, name="_n")
    columns = [f"{n} {t}" for n, t in pieces.dtypes]
    schema = ", ".join([*columns, "sequence_id bigint", "offset bigint"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("_n").to_numpy()
            at = np.searchsorted(first, n, "right") - 1
            rank = n - first[at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c.split()[0]) for c in columns),
                 pa.array(first_bin[at] + rank // per_bin[at]),
                 pa.array(offset[at] + rank % per_bin[at] * length[at])],
                names=[*(c.split()[0] for c in columns), "sequence_id", "offset"])

    return numbered.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, files: tuple[str, str, str] | None = None,
                   capacity: int = CAPACITY) -> DataFrame:
    """Pack all documents: one row per piece, its place, and a checksum of its ids.

    ``files``: tokenizer file, the same vocabulary as ranks, and the pattern that splits
    words; by default those of the public byte-level vocabulary, which every executor must have.
    A null or empty text is one end id. Very long texts are cut into pieces; repeated rows
    are packed each; an empty table gives no rows. Other columns are not read.
    """
    pieces = materialize(token_pieces(docs, files or public_files(), capacity), "pieces")
    return place_pieces(pieces, capacity)


def public_files() -> tuple[str, str, str]:
    import public_tokenizers

    return (str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("byte_bpe_50k.tiktoken")),
            public_tokenizers.PATTERN)
