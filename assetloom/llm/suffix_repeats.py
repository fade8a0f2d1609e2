"""Removal of repeated byte strings with enhanced suffix arrays.

A repeat of ``LENGTH`` bytes cannot be found by looking at one document, and sorting every
suffix of the corpus would move each byte a hundred times. So the suffixes are first dealt to
groups that can be judged alone:

* Each window of ``LENGTH`` bytes belongs to the 32-byte gram in it with the smallest hash. Equal
  windows choose equal grams, so a repeat never crosses groups. Neighbouring windows mostly share
  their gram and form a region (about 35 windows); one row per region is all that is shuffled.
* Regions that are equal as a whole need no text: all but the first are repeats.
* Regions that share a gram but differ get an enhanced suffix array over their bytes. A scan with a stack
  yields its common-prefix intervals; those of at least ``LENGTH`` bytes whose occurrences
  differ in the byte before them are the maximal repeats, with all their occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assetloom.llm.text import like, mixed
from assetloom.session import materialize

LENGTH, GRAM = 100, 32
#: Bytes that are hashed at once; a longer document is hashed in overlapping parts.
CHUNK = 1 << 18
PART = 1 << 22
#: Regions a map task compares among themselves before they are shuffled.
BLOCK_REGIONS = 1_000_000
#: Regions of one gram that one suffix array takes; groups beyond it are split by window.
GROUP_REGIONS = 4_096

_TABLE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = mixed(np.arange(1, 16, dtype=np.uint64)) | np.uint64(1)
_PLACE = np.uint64((1 << 24) - 1)

REGIONS = "gram bigint, body bigint, doc_id bigint, start bigint, windows int"


def _doubled(h: np.ndarray, width: int, step: int) -> np.ndarray:
    """Hashes of runs of twice the width."""
    return h[:-width] * _FACTORS[step] + h[width:]


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each run of ``n`` values."""
    width = 1
    while 2 * width <= n:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = n - width
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def regions(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Regions of the texts ``data[begins[i]:ends[i]]``: gram, body hash, start in ``data``, windows."""
    none = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    if len(data) < LENGTH or not (ends - begins >= LENGTH).any():
        return none
    h = _TABLE[data]
    for step in range(5):
        h = _doubled(h, 1 << step, step)
    wide = _doubled(h, GRAM, 5)
    grams = mixed(h)
    keys = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    own = (_least(keys, LENGTH - GRAM + 1) & _PLACE).astype(np.int64)
    # a window is valid if it ends inside its text
    change = np.zeros(len(own) + 1, np.int8)
    long_enough = ends - begins >= LENGTH
    np.add.at(change, begins[long_enough], 1)
    np.add.at(change, ends[long_enough] - LENGTH + 1, -1)
    valid = np.flatnonzero(np.cumsum(change[:-1]))
    own = own[valid]
    first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (valid[1:] != valid[:-1] + 1)]))
    start = valid[first]
    windows = np.diff(np.append(first, len(valid)))
    gram_at = own[first]
    size = windows + LENGTH - 1
    body = windows.astype(np.uint64) * _FACTORS[6] + (gram_at - start).astype(np.uint64) * _FACTORS[7]
    for at in (start, start + (size - 2 * GRAM) // 2, start + size - 2 * GRAM):
        body = mixed(body + wide[at])
    return grams[gram_at], body, start, windows


def _chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``CHUNK`` bytes."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the edges of its texts; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8)), edges


def _first_of(*columns: np.ndarray) -> np.ndarray:
    """Of sorted columns: where a new combination starts."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _later(first: np.ndarray, docs: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rows that truly stand after the first row of their class (a repeated table row does not)."""
    head = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
    return ~first & ((docs != docs[head]) | (starts != starts[head]))


def _joined(docs: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Union of intervals per document."""
    if not len(docs):
        return docs, low, high
    order = np.lexsort((low, docs))
    docs, low, high = docs[order], low[order], high[order]
    reach = high.copy()
    head = _first_of(docs)
    if not head.all():  # running maximum within a document
        shift = np.cumsum(head) * (int(high.max()) + 1)
        reach = np.maximum.accumulate(high + shift) - shift
    new = head.copy()
    new[1:] |= low[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return docs[at], low[at], reach[np.append(at[1:], len(docs)) - 1]


def _region_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Regions of the documents; of equal ones in a block the first. The others are repeats, told
    as joined stretches with a negative number of windows and keys that spread evenly."""
    schema = like(REGIONS)
    held: list[tuple] = []
    n_held = 0

    def flush() -> pa.RecordBatch:
        gram, body, doc, start, windows = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((start, doc, body, gram))
        gram, body, doc, start, windows = (x[order] for x in (gram, body, doc, start, windows))
        first = _first_of(gram, body)
        gone = _later(first, doc, start)
        cover = _joined(doc[gone], start[gone], start[gone] + windows[gone] + LENGTH - 1)
        spread = mixed(mixed(cover[0].view(np.uint64)) + cover[1].view(np.uint64))
        columns = (np.concatenate([gram[first], spread]).view(np.int64),
                   np.concatenate([body[first], spread]).view(np.int64),
                   np.concatenate([doc[first], cover[0]]), np.concatenate([start[first], cover[1]]),
                   np.concatenate([windows[first], cover[1] - cover[2]]).astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    for batch in batches:
        docs = batch.column("doc_id")
        usable = docs.is_valid().to_numpy(zero_copy_only=False)
        ids = docs.fill_null(0).to_numpy()
        data, edges = _bytes_of(batch.column("text"))
        for a, b in _chunks(edges):
            parts = [(int(edges[a]), int(edges[b]))]
            if edges[b] - edges[a] > PART:  # one long text: its windows in parts
                parts = [(at, min(at + PART + LENGTH - 1, int(edges[b])))
                         for at in range(int(edges[a]), max(int(edges[a]) + 1, int(edges[b]) - LENGTH + 1), PART)]
            for low, high in parts:
                begins = np.maximum(edges[a:b], low) - low
                ends = np.minimum(edges[a + 1:b + 1], high) - low
                gram, body, start, windows = regions(data[low:high], begins, ends)
                doc = a + np.searchsorted(edges[a + 1:b + 1] - low, start, "right")
                keep = usable[doc]
                held.append((gram[keep], body[keep], ids[doc[keep]], (start + low - edges[doc])[keep], windows[keep]))
                n_held += int(keep.sum())
        if n_held >= BLOCK_REGIONS:
            yield flush()
            held, n_held = [], 0
    if n_held:
        yield flush()


FOUND = "kind int, gram bigint, doc_id bigint, low bigint, high bigint"
COVER, OPEN, WINDOW = 0, 1, 2


def _by_gram(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[list, bool, bool]]:
    """Rows sorted by gram as numpy columns, whole grams together; whether they are the first and the last."""
    held: list[list] = []
    first = True
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
        changes = np.flatnonzero(now[0][1:] != now[0][:-1])
        new = not held or held[-1][0][-1] != now[0][0]
        cut = int(changes[-1]) + 1 if len(changes) else 0
        if held and (new or cut):
            ready = held if not cut else [*held, [c[:cut] for c in now]]
            yield [np.concatenate(x) for x in zip(*ready, strict=True)], first, False
            held, first = [], False
        elif cut:
            yield [c[:cut] for c in now], first, False
            first = False
        held.append([c[cut:] for c in now])
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)], first, True


def _compare_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by gram, body, document and start: equal regions after the first are covers;
    grams with several bodies stay open. So do grams at the edges of a partition, as others may hold more of them."""
    schema = like(FOUND)
    for (gram, body, doc, start, windows), at_start, at_end in _by_gram(
            batches, ["gram", "body", "doc_id", "start", "windows"]):
        told = windows < 0
        out = [(np.full(told.sum(), COVER), gram[told], doc[told], start[told], start[told] - windows[told])]
        gram, body, doc, start, windows = (x[~told] for x in (gram, body, doc, start, windows))
        if len(gram):
            first = _first_of(gram, body)
            gone = _later(first, doc, start)
            cover = _joined(doc[gone], start[gone], start[gone] + windows[gone] + LENGTH - 1)
            out.append((np.full(len(cover[0]), COVER), np.zeros(len(cover[0]), np.int64), *cover))
            group = np.cumsum(_first_of(gram)) - 1
            bodies = np.bincount(group, weights=first)
            open_ = bodies[group] > 1
            if at_start:
                open_ |= group == 0
            if at_end:
                open_ |= group == group[-1]
            left = first & open_
            out.append((np.full(left.sum(), OPEN), gram[left], doc[left], start[left],
                        start[left] + windows[left] + LENGTH - 1))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _window_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of each run of ``LENGTH`` bytes."""
    h = [_TABLE[data]]
    for step in range(6):
        h.append(_doubled(h[-1], 1 << step, step))
    n = len(data) - LENGTH + 1
    out = np.full(n, LENGTH, np.uint64)
    at = 0
    for step in (6, 5, 2):  # 64 + 32 + 4
        out = mixed(out + h[step][at:at + n])
        at += 1 << step
    return out


def suffix_array(groups: np.ndarray, data: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes ``data[at:at+size]``, by group and bytes, and the common prefix of each with
    the one before it (0 across groups)."""
    width = int(size.max())
    padded = np.concatenate([data, np.zeros(width, np.uint8)])
    matrix = np.empty((len(at), 8 + width), np.uint8)
    matrix[:, :8] = groups.astype(">u8").view(np.uint8).reshape(-1, 8)
    matrix[:, 8:] = np.lib.stride_tricks.sliding_window_view(padded, width)[at]
    matrix[:, 8:][np.arange(width)[None, :] >= size[:, None]] = 0
    order = np.argsort(matrix.view(f"S{8 + width}").ravel(), kind="stable")
    matrix, sizes = matrix[order], size[order]
    common = np.zeros(len(at), np.int64)
    if len(at) > 1:
        differ = matrix[1:] != matrix[:-1]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), 8 + width) - 8
        common[1:] = np.maximum(0, np.minimum(first, np.minimum(sizes[1:], sizes[:-1])))
    return order, common


def common_prefix_intervals(common: list[int], before: list[int], least: int) -> Iterator[tuple[int, int, int, bool]]:
    """(first, last, length, diverse) of each interval of suffixes with a common prefix of ``least``
    or more, inner ones before outer ones. ``diverse``: their bytes before differ, or are unknown (-1)
    for one of them, so the repeat cannot be extended to the left."""
    stack: list[list] = []  # length, first, byte before (None: several)
    n = len(common)
    for i in range(1, n + 1):
        length = common[i] if i < n else 0
        first = i - 1
        left = before[first] if before[first] >= 0 else None
        while stack and stack[-1][0] > length:
            own, first, seen = stack.pop()
            if seen is None or left is None or seen != left:
                left = None
            yield first, i - 1, own, left is None
        if length >= least:
            if stack and stack[-1][0] == length:
                if stack[-1][2] is not None and stack[-1][2] != left:
                    stack[-1][2] = None
            else:
                stack.append([length, first, left])


def maximal_repeats(grams: np.ndarray, docs: np.ndarray, starts: np.ndarray, texts: list[bytes],
                    ) -> Iterator[tuple[int, list[tuple[int, int]], list[tuple[int, int]]]]:
    """Maximal repeats among regions of equal gram: (length, occurrences, repeats).

    Occurrences are all places (document, start) of the repeat. The last list has those after the
    first one, without the ones that a longer repeat at the same place has told already.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.cumsum(sizes) - sizes
    n = sizes - LENGTH + 1
    region = np.repeat(np.arange(len(texts)), n)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = begin[region] + inner
    # a suffix whose first bytes occur once in its group is in no interval
    prints = mixed(_window_hashes(data)[at] + grams[region].view(np.uint64))
    _, which, counts = np.unique(prints, return_inverse=True, return_counts=True)
    keep = counts[which] > 1
    if not keep.any():
        return
    region, inner, at = region[keep], inner[keep], at[keep]
    order, common = suffix_array(grams[region].view(np.uint64), data, at, sizes[region] - inner)
    region, inner, at = region[order], inner[order], at[order]
    before = np.where(inner > 0, data[at - 1].astype(np.int64), -1).tolist()
    places = list(zip(docs[region].tolist(), (starts[region] + inner).tolist(), strict=True))
    held = list(range(len(places)))  # the first occurrence of an inner interval stands for it
    follow = list(range(1, len(places) + 1))
    for first, last, length, diverse in common_prefix_intervals(common.tolist(), before, LENGTH):
        suffixes, i = [], first
        while i <= last:
            suffixes.append(held[i])
            i = follow[i]
        original = min(suffixes, key=places.__getitem__)
        follow[first], held[first] = i, original
        if diverse:
            yield (length, places[first:last + 1],
                   [places[k] for k in suffixes if places[k] != places[original]])


def _compare_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open regions with their bytes, sorted by gram: covers, or the windows of groups marked as large."""
    schema = like(FOUND)
    columns = ["key", "gram", "doc_id", "low", "large", "bytes"]
    for (_, gram, doc, low, large, texts), _, _ in _by_gram(batches, columns):
        out = []
        for i in np.flatnonzero(large):
            prints = _window_hashes(np.frombuffer(texts[i], np.uint8)).view(np.int64)
            # the gram takes the place of a second hash: equal windows have equal grams
            out.append((np.full(len(prints), WINDOW), mixed(prints.view(np.uint64) + gram[i].view(np.uint64)).view(np.int64),
                        np.full(len(prints), doc[i]), low[i] + np.arange(len(prints)), prints))
        small = ~large
        gram, doc, low, texts = gram[small], doc[small], low[small], texts[small]
        cuts = [0]
        for edge in [*np.flatnonzero(_first_of(gram)), len(gram)]:  # whole grams, a bounded number of regions
            if edge - cuts[-1] > GROUP_REGIONS and last > cuts[-1]:
                cuts.append(last)
            last = int(edge)
        for a, b in zip(cuts, [*cuts[1:], len(gram)], strict=True):
            if b <= a:
                continue
            covers = [(d, s, s + length) for length, _, gone in
                      maximal_repeats(gram[a:b], doc[a:b], low[a:b], list(texts[a:b])) for d, s in gone]
            if covers:
                cover = _joined(*(np.array(x, np.int64) for x in zip(*covers, strict=True)))
                out.append((np.full(len(cover[0]), COVER), np.zeros(len(cover[0]), np.int64), *cover))
        if out:
            joined = [np.concatenate(x) for x in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(joined, schema, strict=True)], schema=schema)


def repeated_stretches(docs: DataFrame) -> DataFrame:
    """(doc_id, low, high): stretches of bytes covered by a string of ``LENGTH`` bytes that also starts
    earlier. One document's stretches may overlap."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # places are told by doc_id, so ids of several texts take no part
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    unclear = materialize(texts.groupBy("doc_id").agg(F.min(mark).alias("low"), F.max(mark).alias("high"))
                          .where("low <> high AND doc_id IS NOT NULL").select("doc_id"), "unclear")
    if not unclear.isEmpty():
        texts = texts.join(unclear, "doc_id", "left_anti")
    # ranges of (gram, body) split a gram that very many documents share
    compared = materialize(
        texts.mapInArrow(_region_rows, REGIONS).repartitionByRange(parts, "gram", "body")
        .sortWithinPartitions("gram", "body", "doc_id", "start").mapInArrow(_compare_regions, FOUND), "regions")
    open_ = compared.where(F.col("kind") == OPEN)
    large = (open_.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP_REGIONS)
                  .select("gram", F.lit(True).alias("large")))
    per_doc = (open_.join(large, "gram", "left")
                    .groupBy("doc_id").agg(F.collect_list(F.struct(
                        "gram", "low", "high", F.coalesce("large", F.lit(False)).alias("large"))).alias("open")))
    with_bytes = (per_doc.join(texts.withColumn("data", F.col("text").cast("binary")), "doc_id")
                  .select("doc_id", F.inline(F.transform("open", lambda o: F.struct(
                      o["gram"].alias("gram"), o["low"].alias("low"), o["large"].alias("large"),
                      F.substring(F.col("data"), (o["low"] + 1).cast("int"), (o["high"] - o["low"]).cast("int"))
                      .alias("bytes"))))))
    keyed = with_bytes.withColumn("key", F.when(F.col("large"), F.xxhash64("doc_id", "low")).otherwise(F.col("gram")))
    judged = materialize(
        keyed.select("key", "gram", "doc_id", "low", "large", "bytes").repartition(parts, "key")
        .sortWithinPartitions("key", "gram", "doc_id", "low").mapInArrow(_compare_texts, FOUND), "judged")
    # windows of large groups: the first of equal ones is found by a partial minimum
    windows = judged.where(F.col("kind") == WINDOW).select("gram", F.col("high").alias("print"), "doc_id", "low")
    firsts = (windows.groupBy("gram", "print").agg(
        F.min(F.struct("doc_id", "low")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    again = (windows.join(firsts, ["gram", "print"])
                    .where((F.col("doc_id") != F.col("first.doc_id")) | (F.col("low") != F.col("first.low")))
                    .select("doc_id", "low", (F.col("low") + LENGTH).alias("high")))
    covers = lambda rows: rows.where(F.col("kind") == COVER).select("doc_id", "low", "high")
    return covers(compared).unionByName(covers(judged)).unionByName(again)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, ``kept`` (bytes), n_bytes, n_removed, ``spans`` (removed runs: start, length).

    Each byte covered by a string of ``LENGTH`` bytes that also starts earlier (in a smaller doc_id,
    or before it in the same document) goes. Strings are judged on the input.

    Null and empty texts have no bytes. Rows repeated whole are one document and get the same
    result. Rows without doc_id, and those whose doc_id has several different texts, are left as they are and make no
    other text a repeat. An
    empty table gives no rows; other columns are not read. Hashes decide only which
    regions are compared, but for regions equal as a whole (128 bits).
    """
    stretches = (repeated_stretches(docs).groupBy("doc_id")
                 .agg(F.sort_array(F.collect_set(F.struct("low", "high"))).alias("gone")))
    kept_schema = "doc_id bigint, kept binary, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,length:bigint>>"
    span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_bytes, n_removed, spans = [], [], [], []
            for text, gone in zip(batch.column("text"), batch.column("gone"), strict=True):
                data = (text.as_py() or "").encode()
                runs: list[list[int]] = []
                for low, high in ((g["low"], g["high"]) for g in gone.as_py() or ()):
                    if runs and low <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], high)
                    else:
                        runs.append([low, high])
                edges = [0, *(x for run in runs for x in run), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                n_bytes.append(len(data))
                n_removed.append(len(data) - len(kept[-1]))
                spans.append([{"start": a, "length": b - a} for a, b in runs])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(kept, pa.binary()), pa.array(n_bytes, pa.int64()),
                 pa.array(n_removed, pa.int64()), pa.array(spans, span)],
                names=["doc_id", "kept", "n_bytes", "n_removed", "spans"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return texts.join(stretches, "doc_id", "left").select("doc_id", "text", "gone").mapInArrow(cut, kept_schema)


def repeat_report(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
