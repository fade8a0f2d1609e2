"""Quality rules and a log-likelihood ratio of hashed n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from assetloom.llm.text import whole, words_of
from assetloom.session import materialize

# The base rules.
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of the words

#: Buckets of hashed n-grams for each unit of the cube root of the corpus's bytes. The table grows with the
#: corpus, slowly enough to be sent to every task: 0.2 million buckets at 0.5 GB, 12 million at 100 TB.
BUCKETS = 256
#: Buckets that are put into one row before the whole table is.
CHUNK = 1 << 12
#: Pseudo-count of every bucket.
SMOOTHING = 1.0
#: One trusted document in so many does not make the model but helps to choose the threshold.
FOLDS = 5
#: Trusted documents up to which their ids are broadcast (about 100 MB in a task); more are joined by shuffling.
BROADCAST_IDS = 4_000_000
#: Mean log ratio per n-gram below which a document is rejected where the labels name no
#: held-out trusted or no bad document to choose it by.
LEAST_SCORE = -0.1
#: Steps between which a threshold is chosen.
STEP = 0.001


def base_counts(docs: DataFrame) -> DataFrame:
    """Add ``words`` and the base counts to rows of ``text``; a null text has no words."""
    text = whole("text")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = docs.withColumns({"words": words_of(text), "lines": lines}).withColumn(
        "n_words", F.size("words").cast("bigint"))
    # hashes of 1, 2, 4 and then 8 words in a row; those that would run over the end are cut off
    counted = counted.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    for width in (1, 2, 4):
        counted = counted.withColumn("hashes", F.zip_with("hashes", F.slice("hashes", width + 1, 1 << 30),
                                                          lambda one, next_: F.xxhash64(one, next_)))
    grams = F.when(F.col("n_words") >= WINDOW, F.slice("hashes", F.lit(1), (F.col("n_words") - (WINDOW - 1)).cast("int"))
                   ).otherwise(F.array().cast("array<bigint>"))
    counted = counted.withColumn("grams", grams).withColumn(
        "placed", F.when(F.size(F.array_distinct("grams")) < F.size("grams"), F.sort_array(F.transform(
            "grams", lambda g, i: F.struct(g.alias("gram"), i.alias("at"))))))
    same = lambda a, b: F.coalesce(a["gram"] == b["gram"], F.lit(False))
    twice = F.sort_array(F.transform(F.filter(
        "placed", lambda x, i: same(x, F.get(F.col("placed"), i - 1)) | same(x, F.get(F.col("placed"), i + 1))),
        lambda x: x["at"]))
    covered = F.aggregate(
        twice, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda s, at: F.struct((at + WINDOW).alias("end"),
                               (s["n"] + at + WINDOW - F.greatest(s["end"], at)).alias("n")), lambda s: s["n"])
    return counted.withColumns({
        "word_chars": F.length(F.array_join("words", "")).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("bigint"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("bigint"),
    }).withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                  | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))).drop("lines", "hashes", "grams", "placed")


def _pairs(rows: DataFrame, *kept: str) -> DataFrame:
    """A row for each word ``a`` of ``text``, with the word ``b`` after it, and the ``kept`` columns."""
    words = rows.select(words_of(whole("text")).alias("words"), *kept)
    return words.select(F.inline(F.arrays_zip(F.col("words").alias("a"), F.slice("words", 2, 1 << 30).alias("b"))), *kept)


def _bucket(buckets: int, *words: str) -> Column:
    return F.pmod(F.xxhash64(*words), F.lit(buckets)).cast("int")


def count_buckets(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(BUCKETS, BUCKETS * round(size ** (1 / 3)))


def _held_out(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(FOLDS)) == 0


def ngram_counts(docs: DataFrame, labels: DataFrame, buckets: int) -> DataFrame:
    """bucket, n_raw, n_target: word unigrams and bigrams of all documents and of the trusted ones that are not
    held out; empty buckets have no row. No text is shuffled: a task sends one row for each
    bucket at most, and the ids of the trusted documents come to it as long as they are few enough."""
    trusted = materialize(labels.where("quality = 1").select(F.col("doc_id").alias("_id"))
                          .where(F.col("_id").isNotNull() & ~_held_out(F.col("_id"))).distinct(), "trusted")
    small = trusted.count() <= BROADCAST_IDS
    flagged = docs.join(F.broadcast(trusted) if small else trusted, docs["doc_id"] == F.col("_id"), "left")
    grams = F.array(_bucket(buckets, "a"), F.when(F.col("b").isNotNull(), _bucket(buckets, "a", "b")))
    return (_pairs(flagged.withColumn("trusted", F.col("_id").isNotNull().cast("int")), "trusted")
            .select(F.explode(grams).alias("bucket"), "trusted").where("bucket IS NOT NULL")
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("n_raw"), F.sum("trusted").alias("n_target")))


def ngram_ratios(counts: DataFrame, buckets: int) -> DataFrame:
    """One row, ``ratios``: for each bucket the log of its share in the trusted documents over its share in all."""
    raw, target = (x or 0 for x in counts.agg(F.sum("n_raw"), F.sum("n_target")).first())
    own = counts.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(counts, "bucket", "left").na.fill(0)
    share = lambda n, total: (F.col(n) + SMOOTHING) / (total + SMOOTHING * buckets)
    ratio = (F.log(share("n_target", target) / share("n_raw", raw)) if target else F.lit(0.0)).cast("float").alias("ratio")
    chunks = own.groupBy(F.expr(f"bucket div {CHUNK}").alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct("bucket", ratio))).alias("own"))
    return chunks.agg(F.array_sort(F.collect_list(F.struct("chunk", F.col("own.ratio").alias("own")))).alias("all")).select(
        F.flatten(F.col("all.own")).alias("ratios"))


def _keyed(docs: DataFrame) -> DataFrame:
    """Add ``key``, by which rows of one document are told apart from others: its doc_id and two hashes of its text."""
    return docs.withColumn("key", F.struct("doc_id", F.xxhash64(whole("text")).alias("h"),
                                           F.xxhash64(whole("text"), F.lit(1)).alias("i")))


def _scores(keyed: DataFrame, ratios: DataFrame, buckets: int) -> DataFrame:
    """key, score: the mean ratio of the word unigrams and bigrams of a document. A document is summed up
    in the task that reads it; one row of it is shuffled. Documents without words have no row."""
    of = lambda *w: F.get(ratios.scalar(), _bucket(buckets, *w)).cast("double")
    told = _pairs(keyed, "key").select("key", (of("a") + F.when(F.col("b").isNotNull(), of("a", "b")).otherwise(0.0)).alias("r"),
                                       F.col("b").isNotNull().cast("int").alias("second"))
    return told.groupBy("key").agg((F.sum("r") / (F.count(F.lit(1)) + F.sum("second"))).alias("score"))


def choose_least(scored: DataFrame, labels: DataFrame) -> float:
    """The threshold that parts held-out trusted from bad documents best, of those that pass the base rules.

    It maximises the kept share of the trusted plus the lost share of the bad ones; among equals it is
    the middle of the lowest stretch. A document with both labels counts as trusted. One row for each ``STEP`` of the
    scores reaches the driver.
    """
    known = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("_quality")).where(
        (F.col("_quality") == 0) | ((F.col("_quality") == 1) & _held_out(F.col("doc_id"))))
    rows = (scored.where(~F.col("base_failed")).select("doc_id", "score").join(known, "doc_id")
                  .groupBy(F.floor(F.col("score") / STEP).alias("level"))
                  .agg(F.count_if(F.col("_quality") == 1), F.count_if(F.col("_quality") == 0)).collect())
    good, bad = (sum(r[k] for r in rows) for k in (1, 2))
    if not good or not bad:
        return LEAST_SCORE
    at = {r[0]: (r[1], r[2]) for r in rows}
    kept, lost, best, stretch = good, 0, -1, []
    for level in range(min(at), max(at) + 2):
        value = kept * bad + lost * good
        if value > best:
            best, stretch = value, [level]
        elif value == best and stretch[-1] == level - 1:
            stretch.append(level)
        more = at.get(level, (0, 0))
        kept, lost = kept - more[0], lost + more[1]
    return stretch[len(stretch) // 2] * STEP


def score_quality(docs: DataFrame, labels: DataFrame, least: float | None = None) -> DataFrame:
    """doc_id, key, the base counts, ``score`` and ``kept`` of every document; ``key`` is that of ``_keyed``.

    ``score`` is the mean log ratio of the document's hashed word unigrams and bigrams
    between a multinomial over trusted documents (``labels`` with quality 1) and one over
    all documents. ``kept`` is false where a base rule fails and else says whether the
    score is at least ``least``, by default ``choose_least``; nothing is drawn at random. One in ``FOLDS`` trusted
    documents, by a hash of doc_id, is held out of the model and helps to choose the threshold. Without
    trusted documents every ratio is 0, so only the base rules decide.

    Null texts have no words and fail; repeated rows are judged alike, each for itself; labels may
    repeat, be null or name unknown documents. Other columns of ``docs`` are ignored.
    """
    plain, labels = docs.select("doc_id", "text"), labels.select("doc_id", "quality")
    buckets = count_buckets(plain)
    counts = materialize(ngram_counts(plain, labels, buckets), "ngram_counts")
    ratios = materialize(ngram_ratios(counts, buckets), "ngram_ratios")
    keyed = _keyed(plain)
    scored = (base_counts(keyed).drop("words", "text").join(_scores(keyed, ratios, buckets), "key", "left")
              .withColumn("score", F.coalesce("score", F.lit(0.0))))
    if least is None:
        scored = materialize(scored, "scored")
        least = choose_least(scored, labels)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= least))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_quality(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("score", 6).alias("score"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that pass, with their columns, which may have any names besides doc_id and text."""
    good = score_quality(docs, labels).where("kept").select("key").distinct()
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    return _keyed(docs.select("doc_id", "text", row)).join(good, "key", "left_semi").select("row.*")
