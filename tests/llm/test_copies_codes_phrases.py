"""Exact dedup, collocations and vector codes against their plain forms."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from conftest_llm import SMALL, pairs
from assetloom.llm import collocations, exact_dedup, queries, salting, vector_codes


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# --- exact dedup -------------------------------------------------------------------

def plain_copies(rows):
    groups, repeats = defaultdict(list), Counter()
    for i, text in rows:
        groups[lower(text)].append(i)
        repeats[i, lower(text)] += 1
    least = lambda i: (i is not None, i or 0)
    return {(i, max(groups[t], key=least), len(groups[t]), i == max(groups[t], key=least), brute.sha(t), n)
            for (i, t), n in repeats.items()}


def told(frame):
    assert frame.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "n_rows"]
    rows = [tuple(r) for r in frame.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def test_exact_groups(docs):
    assert told(exact_dedup.exact_groups(docs)) == plain_copies(pairs(docs))


@pytest.mark.parametrize("digest_bytes", [0, 1])
def test_contents_of_one_digest_are_compared(odd, digest_bytes):
    assert told(exact_dedup.exact_groups(odd, digest_bytes)) == plain_copies(pairs(odd))


def test_repeated_rows_and_ids(spark):
    rows = [(1, "a"), (1, "A"), (1, "b"), (2, "b"), (2, "b"), (None, "b"), (None, "c"), (None, "C"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    assert told(exact_dedup.exact_groups(docs)) == plain_copies(rows)
    left = exact_dedup.drop_copies(docs).collect()
    assert sorted((r["doc_id"] or 0, lower(r["text"])) for r in left) == [(0, "c"), (1, "a"), (2, "b"), (4, "")]


def test_a_hot_text_is_merged_locally_and_salted(spark):
    rows = spark.range(40_000).repartition(8).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "The Same").otherwise(F.col("id").cast("string")).alias("text"))
    row = exact_dedup.exact_groups(rows).where("group_size > 1").agg(
        F.count("*"), F.min("keep_id"), F.max("keep_id"), F.count_if("kept"), F.min("group_size")).first()
    assert tuple(row) == (13_334, 39_999, 39_999, 1, 13_334)
    plan = exact_dedup._combined(exact_dedup._hashed(rows), F.col("sha"))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.rindex("hashpartitioning(digest")  # the map side comes first
    dealt = rows.where("doc_id % 3 = 0").groupBy(salting.salt_of("doc_id")).count().agg(F.max("count")).first()[0]
    assert dealt < 2 * 13_334 / salting.SALTS


def test_copies_keep_clashing_columns(odd):
    clashing = odd.withColumns({c: F.lit("own") for c in ("keep_id", "digest", "sha", "content", "_key", "_salt", "kept")})
    assert told(exact_dedup.exact_groups(clashing)) == plain_copies(pairs(odd))
    left = exact_dedup.drop_copies(clashing)
    assert left.columns == clashing.columns
    assert left.where("sha = 'own'").count() == len({lower(t) for _, t in pairs(odd)})


def test_empty_tables(empty, spark):
    assert exact_dedup.exact_groups(empty).count() == 0 and exact_dedup.drop_copies(empty).count() == 0
    assert collocations.collocations(empty.withColumn("lang", F.lit("en"))).count() == 0
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert vector_codes.code_report(vectors).count() == 0


# --- collocations ------------------------------------------------------------------

def plain_phrases(rows, support, first):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lower(text)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for n in range(1, 5):
                counts[lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        own = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        gone = {p[i:j] for p, a in own.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and p[i:j] in own and 100 * a >= 80 * own[p[i:j]]}
        scored = []
        for p, a in own.items():
            if p not in gone:
                cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def phrases_of(docs, **options):
    frame = collocations.collocations(docs, **options)
    assert frame.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in frame.collect())


@pytest.fixture(scope="module")
def tongues(odd):
    """The odd documents in several languages, none and a null, with punctuation and odd spaces."""
    lang = F.when(F.col("doc_id") % 5 == 0, None).otherwise(F.element_at(F.array(F.lit("en"), F.lit("und"), F.lit("é")), (
        F.col("doc_id") % 3 + 1).cast("int")))
    more = F.concat("text", F.lit("  Red,green blue. red\tgreen\x0bRED GREEN x! red green\x1cblue red green  blue\r"))
    return odd.withColumns({"lang": lang, "text": F.when(F.col("doc_id") % 2 == 0, more).otherwise(F.col("text")),
                            "words": F.lit(3), "shard": F.lit("own"), "phrase": F.lit("own")})


@pytest.mark.parametrize("shard_bytes, bucket_bytes", [(1 << 22, 1 << 23), (2000, 3000)])
@pytest.mark.parametrize("support, first", [(2, 40), (7, 2000)])
def test_collocations(tongues, monkeypatch, shard_bytes, bucket_bytes, support, first):
    monkeypatch.setattr(collocations, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(collocations, "BUCKET_BYTES", bucket_bytes)
    rows = [(r["lang"], r["text"]) for r in tongues.select("lang", "text").collect()]
    expected = plain_phrases(rows, support, first)
    assert expected and phrases_of(tongues, support=support, first=first) == expected


def test_collocations_of_driver_table(small):
    rows = [(r["lang"], r["text"]) for r in small.select("lang", "text").collect()]
    assert phrases_of(small) == plain_phrases(rows, 30, 2000)


def test_local_support_follows_the_share_of_a_shard(spark):
    import pyarrow as pa
    rows = pa.table({"lang": ["x"] * 2, "text": [b"a b", b"a b c"], "shard": [7, 7]},
                    pa.schema([("lang", pa.string()), ("text", pa.binary()), ("shard", pa.int64())]))
    mined = lambda total: collocations._mine(total, 4, 0)((pa.scalar(7),), rows).to_pylist()[0]
    share = lambda row: (row["support"], sorted(collocations._unpacked(row["counts"], rising=False).tolist()))
    assert share(mined(16)) == (2, [2, 2, 2])       # half of the corpus: a, b and a b twice each
    assert share(mined(32)) == (1, [1, 1, 1, 2, 2, 2])
    # what the shard does not tell it may hold once less than its support
    keep = collocations._unite(4)
    block = lambda shard, support, keys, counts: {"bucket": 0, "shard": shard, "support": support,
                                                  "keys": collocations._packed(np.array(keys)),
                                                  "counts": collocations._packed(np.array(counts), rising=False)}
    table = pa.Table.from_pylist([block(1, 2, [5, 6], [2, 3]), block(2, 2, [8, 9], [2, 2]), block(3, 1, [5, 6, 7], [1, 1, 9])],
                                 collocations.like(collocations.MINED))
    kept = {r["shard"]: collocations._unpacked(r["keys"]).tolist() for r in keep((pa.scalar(0),), table).to_pylist()}
    # 8 and 9 occur 2 + 1 times at most; the third shard tells all it has
    assert kept == {1: [5, 6, 7], 2: [5, 6, 7], 3: [5, 6, 7]}


def test_packed_arrays_come_back():
    draw = np.random.default_rng(1)
    for n in (0, 1, 2, 999):
        values = np.unique(draw.integers(0, 1 << 32, n, dtype=np.uint64))
        assert collocations._unpacked(collocations._packed(values)).tolist() == values.tolist()
        counts = draw.integers(1, 1 << 32, n)
        assert collocations._unpacked(collocations._packed(counts, rising=False), rising=False).tolist() == counts.tolist()


def test_scores_beyond_64_bits(spark):
    a = 9 * 10 ** 17
    row = spark.range(1).select(F.lit(a).cast("bigint").alias("a"), F.lit(a + 7).alias("l"), F.lit(a + 9).alias("r"))
    got = row.select(collocations.score_of(F.col("a"), F.col("l"), F.col("r"))).first()[0]
    assert got == 2_000_000 * a // (2 * a + 16)


# --- vector codes ------------------------------------------------------------------

def plain_codes(rows, entries=64):
    kept = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    width = len(order[0][2]) // 16
    kept = [r for r in kept if len(r[2]) == 16 * width]
    part = lambda v, p: v[p * width:(p + 1) * width]
    books = [[part(v, p) for _, _, v in order if len(v) == 16 * width] for p in range(16)]

    def nearest(x, book):
        return min((sum((s - t) ** 2 for s, t in zip(x, b, strict=True)), e) for e, b in enumerate(book))
    for _ in range(2):
        for p in range(16):
            own = defaultdict(list)
            for *_, v in kept:
                own[nearest(part(v, p), books[p])[1]].append(part(v, p))
            for e, xs in own.items():
                books[p][e] = [sum(c) // len(c) for c in zip(*xs, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, sums = [], Counter()
    for i, label, v in kept:
        found = [nearest(part(v, p), books[p]) for p in range(16)]
        error = sum(d for d, _ in found)
        sums[label] += error
        out.append((i, label, "".join(f"{e:02x}" for _, e in found), error))
    return sorted(((i, code, error, sums[label], digest) for i, label, code, error in out), key=str)


def codes_of(frame):
    assert frame.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in frame.collect()), key=str)


SCHEMA = "vec_id bigint, embedding array<float>, label int"


@pytest.mark.parametrize("n, width", [(300, 2), (20, 1), (64, 3)])
def test_codes(spark, n, width):
    draw = random.Random(n)
    vector = lambda: [draw.randint(-6, 6) / 64 for _ in range(16 * width)]  # noqa: E731 (many ties)
    rows = [(i * 7 % 1000, vector(), draw.choice([None, 1, 2])) for i in range(n)]
    rows += [rows[3], (rows[4][0], vector(), 1), (None, vector(), 2), (-5, None, 1), (-4, [None] * 16 * width, 1),
             (-3, [float("nan")] + vector()[1:], 2), (-2, vector()[1:] + [float("inf")], None)]
    table = spark.createDataFrame(rows, SCHEMA).withColumns({"ints": F.lit(1), "code": F.lit("x"), "codes": F.lit(2)})
    assert codes_of(vector_codes.code_report(table)) == plain_codes(rows)


def test_codes_of_driver_table(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]
    assert codes_of(vector_codes.code_report(table)) == plain_codes(rows)


def test_vectors_of_other_lengths_have_no_code(spark):
    rows = [(1, [0.5] * 16, 1), (2, [], 1), (3, [0.25] * 32, None), (4, [0.5] * 15 + [0.75], 1)]
    got = {r["vec_id"]: (r["code"], r["error"]) for r in vector_codes.code_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[2] == got[3] == (None, None) and got[1] == ("00" * 16, 0) and got[4][1] is not None
    only = vector_codes.code_report(spark.createDataFrame([(1, [], 1), (2, [0.5] * 16, 2)], SCHEMA)).collect()
    assert [(r["code"], r["error"], r["label_error"]) for r in only] == [(None, None, None)] * 2


def test_pivots_spare_exact_distances():
    draw = np.random.default_rng(3)
    entries, parts = draw.integers(-60, 60, (64, 4)), draw.integers(-60, 60, (3000, 4))
    entries[40] = entries[7]  # a tie that the lower one wins
    pivots = vector_codes.choose_pivots(entries)
    far = vector_codes._fine(vector_codes._distances(parts, pivots))
    search = vector_codes.Search(entries, pivots)
    code, squared, evaluated = search.nearest(parts, far)
    every = vector_codes._distances(parts, entries)
    assert (code == every.argmin(axis=1)).all() and (squared == every.min(axis=1)).all()
    assert evaluated < 0.25 * every.size
    bound = np.abs(far[:, None, :] - search.to_pivots[None]).max(axis=2) - 1
    assert (np.maximum(bound, 0) ** 2 <= every * vector_codes.FINENESS ** 2).all()


def test_roots_are_floored():
    x = np.array([0, 1, 2, 3, 4, 8, 9, 10 ** 12 - 1, 10 ** 12, (1 << 31) ** 2 - 1, (1 << 31) ** 2])
    assert vector_codes._floor_root(x).tolist() == [math.isqrt(int(v)) for v in x]


def test_queries_equal_their_sql(spark):
    from compare import connect, difference
    con = connect(SMALL)
    for name in ("op11_vector_codes", "op12_exact_dedup", "op13_collocations"):
        query = lambda s, d, f=queries.QUERIES[name]: f(s, d)
        query.sql = queries.SQL[name]
        assert difference(spark, con, query, SMALL) is None, name
