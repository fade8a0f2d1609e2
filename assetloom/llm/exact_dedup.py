"""Exact duplicates, combined by salted digest groups with full comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assetloom.llm.salting import SALTS, salt_of, salted_lookup
from assetloom.llm.text import whole
from assetloom.session import materialize

# The letters that are lower-cased.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of the SHA-256 that group texts; fewer only make more texts meet that differ.
DIGEST_BYTES = 32


def normalised(text: str | Column = "text") -> Column:
    """The text with A-Z lower-cased, null as the empty text."""
    return F.translate(whole(text), UPPER, LOWER)


def _hashed(docs: DataFrame) -> DataFrame:
    """doc_id, content and the SHA-256 of the content."""
    return docs.select("doc_id", normalised().alias("content")).withColumn("sha", F.unhex(F.sha2("content", 256)))


def _combined(rows: DataFrame, digest: Column) -> DataFrame:
    """digest, content, keep_id, group_size: one row for each content.

    A map task first merges its own equal contents (partial aggregation), so it sends one row for a
    content however many copies it holds. Rows of a digest meet in ``SALTS`` groups, and only the winner of
    each goes on to the last merge. Contents are keys throughout, so they are compared
    in full each time.
    """
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    salted = (rows.withColumns({"digest": digest, "salt": salt}).groupBy("digest", "salt", "content")
                  .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    return (salted.groupBy("digest", "content")
                  .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")))


def exact_groups(docs: DataFrame, digest_bytes: int = DIGEST_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, n_rows for every document.

    Texts are equal when identical after lower-casing A-Z; null is the empty text. Of equal texts the
    row with the largest doc_id stays, a null doc_id counting as the least. Rows that agree in
    doc_id and text are one document: one row tells them, ``n_rows`` how many they are, and
    ``group_size`` counts them all. Different texts under one doc_id are
    different documents. An empty table gives an empty result; other columns are ignored.

    Only digests travel back to the documents, by a salted join. Where a digest
    has several contents, its documents are matched by content instead.
    """
    digest = F.substring("sha", 1, digest_bytes) if digest_bytes < DIGEST_BYTES else F.col("sha")
    groups = materialize(_combined(_hashed(docs), digest).drop("content"), "exact_groups")
    by_digest = groups.groupBy("digest").agg(
        F.count(F.lit(1)).alias("contents"), F.max("keep_id").alias("keep_id"),
        F.max("group_size").alias("group_size"))
    members = materialize(_hashed(docs).groupBy("doc_id", "sha").agg(F.count(F.lit(1)).alias("n_rows"))
                          .withColumn("digest", digest), "exact_members")
    found = salted_lookup(members, by_digest, ["digest"], salt_of("doc_id")).where("contents = 1")
    crowded = by_digest.where("contents > 1").select("digest")
    if not crowded.isEmpty():
        found = found.select(*_COLUMNS).unionByName(_by_content(docs, digest, crowded))
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), "n_rows")


_COLUMNS = ("doc_id", "sha", "n_rows", "keep_id", "group_size")


def _by_content(docs: DataFrame, digest: Column, crowded: DataFrame) -> DataFrame:
    """The documents of the ``crowded`` digests, matched by their contents."""
    texts = materialize(_hashed(docs).withColumn("digest", digest).join(crowded, "digest", "left_semi"),
                        "exact_crowded")
    winners = _combined(texts, F.col("digest"))
    members = materialize(texts.groupBy("doc_id", "sha", "digest", "content")
                          .agg(F.count(F.lit(1)).alias("n_rows")), "exact_contents")
    return salted_lookup(members, winners, ["digest", "content"], salt_of("doc_id")).select(*_COLUMNS)


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that ``exact_groups`` keeps, with all their columns. Of rows that agree in doc_id
    and text one stays; which one is open."""
    stays = exact_groups(docs).where("kept").select(
        F.struct("doc_id", F.unhex("text_sha256").alias("sha")).alias("_key"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"),
                       F.struct("doc_id", F.unhex(F.sha2(normalised(), 256)).alias("sha")).alias("_key"))
    return rows.join(stays, "_key", "left_semi").dropDuplicates(["_key"]).select("_row.*")
