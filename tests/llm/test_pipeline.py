"""Every stage of the corpus pipeline and what it hands on, against plain forms."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from assetloom.llm import packing
from assetloom.llm.text import table
from conftest_llm import SMALL, pairs


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage returns, each reading what the one before wrote."""
    docs, out = table(spark, SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SMALL), name)
        out.append(docs)
    return out


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "decontamination", "best_fit_packing"]


def test_hand_over(spark, steps):
    columns = table(spark, SMALL, "documents").columns
    assert all(s.columns == columns for s in steps[:-1])
    sizes = [s.count() for s in steps[:-1]]
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    rows = sorted(map(tuple, corpus_pipeline.run(spark, SMALL).select("doc_id", "piece", "start", "length", "ids_crc32").collect()))
    assert rows == sorted(map(tuple, steps[-1].select("doc_id", "piece", "start", "length", "ids_crc32").collect()))


def test_quality_stage(spark, steps):
    docs = table(spark, SMALL, "documents")
    labels = [tuple(r) for r in table(spark, SMALL, "labels").select("doc_id", "quality").where("quality IS NOT NULL").collect()]
    want, least = brute.quality_scores(pairs(docs), labels)
    kept = {i for i, (_, k) in want.items() if k}
    close = {i for i, (score, _) in want.items() if abs(score - least) < 1e-6}
    got = {r["doc_id"]: r for r in steps[0].collect()}
    assert set(got) ^ kept <= close
    assert all(got[r["doc_id"]] == r for r in docs.collect() if r["doc_id"] in got)


def test_line_stage(steps):
    want = brute.lines(pairs(steps[0]))
    rows = steps[1].collect()
    assert {r["doc_id"]: brute.sha(r["text"]) for r in rows} == {i: w[2] for i, w in want.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert any(w[1] for w in want.values())


def test_near_stage(steps):
    want = brute.near(pairs(steps[1]), 5, 80)
    assert {i for i, _ in pairs(steps[2])} == {i for i, (_, root) in want.items() if i == root}


def test_benchmark_stage(spark, steps):
    items = [(r["item_id"], r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    lost = {d for d, _ in brute.leaks(pairs(steps[2]), items)}
    assert {i for i, _ in pairs(steps[3])} == {i for i, _ in pairs(steps[2])} - lost


def test_packing_stage(steps):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.public_files()[0])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in steps[4].collect():
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    texts = dict(pairs(steps[3]))
    assert set(by_doc) == set(texts)
    for i, rows in by_doc.items():
        ids = np.array([*tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, 0], "<u4")
        assert sum(r["length"] for r in rows) == len(ids)
        for r in rows:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
    total = 0
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
        total += at
    assert len(by_sequence) <= 1.25 * total / 2048 + 2


def test_stages_keep_columns_of_any_name(spark):
    """Each stage gets a column that has the name of one of its own."""
    docs = table(spark, SMALL, "documents").withColumns({n: F.lit("own") for n in ("kept", "score", "words", "key", "_id", "row", "gone")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, SMALL)
        assert left.columns == docs.columns and left.where("kept <> 'own' OR key <> 'own' OR row <> 'own'").count() == 0


def test_empty_and_odd_documents(spark):
    nothing = table(spark, SMALL, "documents").where("1 = 0")
    odd = spark.createDataFrame([(1, None), (None, "x"), (2, ""), (2, ""), (3, "a " * 500)], "doc_id bigint, text string")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SMALL).count() == 0
        stage(spark, odd, SMALL).collect()
