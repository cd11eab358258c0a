"""Operator 1, quality rules: hashed n-gram log-likelihood ratio, native DataFrame code.

Two multinomials over hashed word unigrams and bigrams are counted: one over the trusted
documents (label quality = 1, toxic = 0), one over the whole raw corpus. A document's score is
the mean over its n-grams of ``log p_trusted(bucket) - log p_raw(bucket)`` (length-normalised).
Every document whose score is below a fixed threshold is rejected; so is one that fails the
base rules. The log ratios are rounded to 1e-6 and summed as integers, so a score does not
depend on how rows are partitioned.

Defined results: NULL or blank text has no words, fails the base rules and scores 0;
repeated rows each get their own result row; extra columns are ignored; an empty corpus gives
no rows; without any trusted document all ratios are 0, so the likelihood rule rejects nothing. A label row pair that disagrees is not trusted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolens.llm.common import bind, words, write_scratch

BUCKETS = 65_536        # hashed n-gram buckets: bounds the broadcast table of log ratios
MIN_SCORE = -0.10       # nats per n-gram; documents below it are rejected
MAX_TRUSTED = 100_000   # bound on the labelled rows that fit the trusted multinomial
SMOOTHING = 30.0        # pseudo-count of every bucket, in both multinomials
SCALE = 1_000_000       # log ratios are kept as integers of 1e-6
WINDOW = 5              # words in a window of the repetition rule
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# The characters that count as symbols, and the word-separating white space.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


def _count_chars(text: Column, chars: str) -> Column:
    kept = F.translate(text, chars, "")
    return (F.length(text) - F.length(kept)).cast("long")


def _dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the text."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    return bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def _pairs(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))


def _hashes(w: Column) -> Column:
    """struct(one, two): 64-bit hashes of the words and of the word bigrams."""
    def both(h):
        n = F.greatest(F.size(h) - 1, F.lit(0))
        return F.struct(h.alias("one"), _pairs(F.slice(h, 1, n), F.slice(h, 2, n)).alias("two"))
    return bind(F.transform(w, lambda x: F.xxhash64(x)), both)


def _repeat_words(one: Column, two: Column) -> Column:
    """Words inside a WINDOW-word window that occurs twice or more in the text.

    A window's hash is made of two bigram hashes and its last word's. The hashes are sorted with
    their positions; a window repeats iff a neighbour in that order has its hash. Covered words
    are then counted from the sorted positions.
    """
    n4, n5 = (F.greatest(F.size(one) - k, F.lit(0)) for k in (WINDOW - 2, WINDOW - 1))
    four = _pairs(F.slice(two, 1, n4), F.slice(two, 3, n4))
    windows = _pairs(F.slice(four, 1, n5), F.slice(one, WINDOW, n5))

    def positions(h):
        pairs = F.array_sort(F.transform(h, lambda v, i: F.struct(v.alias("h"), i.alias("p"))))
        same = bind(pairs, lambda s: F.transform(s, lambda v, i: F.when(
            F.coalesce(F.get(s, i - 1)["h"] == v["h"], F.lit(False))
            | F.coalesce(F.get(s, i + 1)["h"] == v["h"], F.lit(False)), v["p"])))
        return F.array_sort(F.filter(same, lambda p: p.isNotNull()))

    def covered(p):
        spans = F.transform(p, lambda v, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - v, F.lit(WINDOW))))
        return F.aggregate(spans, F.lit(0).cast("long"), lambda a, v: a + v)

    return bind(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
                .otherwise(bind(positions(h), covered)))


def base_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the base counts and ``base_failed``; ``__h`` holds the n-gram hashes for later use."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("__h", _hashes(words(F.col(text)))).select(
        "*", F.size("__h.one").cast("long").alias("n_words"),
        F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        _count_chars(t, SYMBOLS).alias("n_symbols"),
        _dup_lines(t).alias("n_dup_lines"),
        _repeat_words(F.col("__h.one"), F.col("__h.two")).alias("n_repeat_words"))
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _bucket(h: Column) -> Column:
    return F.pmod(h, F.lit(BUCKETS)).cast("int")


def trusted_ids(labels: DataFrame, limit: int = MAX_TRUSTED) -> DataFrame:
    """Ids of trusted documents; above ``limit`` those with the smallest seeded hashes."""
    ok = (labels.where("doc_id is not null").groupBy("doc_id")
          .agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
          .where((F.col("q") == 1) & (F.coalesce(F.col("t"), F.lit(0)) == 0)))
    return ok.select("doc_id").orderBy(F.xxhash64(F.lit("trusted"), "doc_id"), "doc_id").limit(limit)


def fit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The written model table: (bucket, ratio), the log ratio in integer 1e-6 nats."""
    ids = trusted_ids(labels).select(F.col("doc_id").alias("__id"), F.lit(1).alias("__trusted"))
    counts = (docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("__id"), "left")
              .withColumn("__h", _hashes(words(F.col("text"))))
              .select(F.coalesce("__trusted", F.lit(0)).alias("t"), F.explode(F.concat("__h.one", "__h.two")).alias("h"))
              .groupBy(_bucket(F.col("h")).alias("bucket")).agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("trusted")))
    counts = write_scratch(counts, "quality-counts")
    total = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("n_raw"),
                       F.coalesce(F.sum("trusted"), F.lit(0)).alias("n_trusted"))
    # Raw counts are scaled to the trusted total, so the smoothing weighs alike in both and the
    # totals cancel: a bucket seen too seldom to tell has a ratio near 0.
    expected = F.when(F.col("n_raw") > 0, F.col("raw") * (F.col("n_trusted") / F.col("n_raw"))).otherwise(F.lit(0.0))
    ratio = F.log((F.col("trusted") + SMOOTHING) / (expected + SMOOTHING))
    return (counts.crossJoin(F.broadcast(total))  # one row
            .select("bucket", F.round(ratio * SCALE).cast("long").alias("ratio")))


def quality_rules(docs: DataFrame, labels: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """One row per input row: doc_id, row_key (hash of id and text), the base counts, score (nats
    per n-gram) and verdicts."""
    ratios = F.broadcast(fit(docs, labels).withColumnRenamed("bucket", "__b"))  # at most BUCKETS rows
    keys = ["doc_id", "row_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")
    rows = base_rules(keyed).withColumn("__row", F.monotonically_increasing_id())
    grams = (rows.select("__row", *keys, F.explode_outer(F.concat("__h.one", "__h.two")).alias("__gram"))
             .withColumn("__bucket", _bucket(F.col("__gram"))))
    scored = (grams.join(ratios, F.col("__bucket") == F.col("__b"), "left")
              .groupBy("__row", *keys)
              .agg(F.coalesce(F.sum("ratio"), F.lit(0)).alias("s"), F.count("__bucket").alias("n")))
    score = F.when(F.col("n") > 0, F.col("s") / F.col("n") / SCALE).otherwise(F.lit(0.0))
    return scored.select(*keys, score.alias("score")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= min_score))


def drop_rejected(docs: DataFrame, labels: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` that the rules keep."""
    bad = quality_rules(docs, labels, min_score).where(~F.col("kept")).select(F.col("row_key").alias("__bad")).distinct()
    return (docs.withColumn("__key", F.xxhash64("doc_id", "text"))
            .join(bad, F.col("__key") == F.col("__bad"), "left_anti").drop("__key"))
