"""Quality rules: base counts, and a hashed n-gram likelihood ratio of trusted against raw text.

The n-grams are whole words and whole pairs of neighbouring words, hashed to `BUCKETS` buckets. The raw
multinomial counts every n-gram of every document; the trusted one those of at most `TRUSTED`
documents labelled good (a bounded sample; the smallest hashes of the ids). The trusted counts are
shrunk towards the raw ones with the weight of `PRIOR` n-grams a bucket, so little trusted text gives
ratios near 0 and a bucket that it never had by chance weighs little. A document's ratio is the mean of
log(trusted / raw) over its n-grams, so its length does not matter, and every document with a ratio
of at least `THRESHOLD` passes: there is no draw.

All is built-in Spark expressions. The counts come back as one array of `BUCKETS` numbers, whatever
the input's size. A null or empty text has no words, ratio 0, and fails the base rule. Without trusted text every ratio is 0 and the base rule alone decides. Rows are judged one by
one, and stay whole with all their columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, labelled_sample

BUCKETS = 1 << 16
TRUSTED = 4_000
#: Weight of the raw multinomial in the trusted one, in n-grams a bucket.
PRIOR = 4.0
#: Nats for each n-gram, below which a document goes.
THRESHOLD = -0.1
#: Fixed value: the characters counted as symbols.
SYMBOLS = "#*$%&|<>"
REPEAT = 8
MIN_WORDS = 20


def words(text: str | Column) -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(WORD), F.lit(0))


def neighbours(a: Column, n: Column, step: int, f) -> Column:
    """f of every element of an array of n and the one `step` after it; empty if there is none."""
    return F.zip_with(F.slice(a, 1, F.greatest(n - step, F.lit(0))), F.slice(a, step + 1, F.greatest(n - step, F.lit(0))), f)


def hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def pairs(h: Column, n: Column, step: int = 1) -> Column:
    """One hash for each element of an array of n hashes and the one `step` after it."""
    return neighbours(h, n, step, lambda a, b: F.xxhash64(a, b))


def buckets(words: Column, two: Column) -> Column:
    """The bucket of every word and every pair, from their hashes."""
    return F.transform(F.concat(words, two), lambda x: F.pmod(x, F.lit(BUCKETS)).cast("int"))


def bucket_counts(texts: DataFrame, text: str) -> list[int]:
    """How often each bucket occurs over all rows."""
    h = texts.select(hashes(words(text)).alias("h"))
    rows = h.select(F.explode(buckets(F.col("h"), pairs(F.col("h"), F.size("h")))).alias("b")).groupBy("b").count().collect()
    counts = [0] * BUCKETS
    for r in rows:
        counts[r.b] = r["count"]
    return counts


def log_ratios(trusted: list[int], raw: list[int]) -> list[float]:
    """log(trusted share / raw share) of each bucket; the raw counts are raised by 1, the trusted ones shrunk towards them."""
    n, m, prior = sum(trusted), sum(raw), PRIOR * BUCKETS
    if not n or not m:
        return [0.0] * BUCKETS
    share = [(r + 1) / (m + BUCKETS) for r in raw]
    return [math.log((t + prior * p) / ((n + prior) * p)) for t, p in zip(trusted, share)]


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> list[float]:
    """Log ratios of all buckets: trusted text is what `labels` calls good, raw text is all of `docs`."""
    trusted = labelled_sample(docs, labels, "quality", TRUSTED, text=text, key=key)
    return log_ratios(bucket_counts(trusted.where("y = 1"), "x"), bucket_counts(docs, text))


def measured(docs: DataFrame, ratios: list[float], text: str = "text") -> tuple[DataFrame, str]:
    """All columns of `docs` and a struct of the counts, the ratio and the verdicts; with its name."""
    name = "rules"
    while any(c.lower().startswith(name) for c in docs.columns):
        name += "_"
    w, h, s, b, ls = (f"{name}_{x}" for x in ("words", "windows", "sorted", "buckets", "lines"))
    t = F.coalesce(F.col(text), F.lit(""))
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")  # folded to one constant
    df = docs.withColumn(w, words(text)).withColumn(ls, F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)))
    df = df.withColumn(b, hashes(F.col(w))).withColumn(h, pairs(F.col(b), F.size(b)))
    df = df.withColumn(b, buckets(F.col(b), F.col(h)))
    size = 2
    while size < REPEAT:  # hashes of 4 and 8 neighbours
        df = df.withColumn(h, pairs(F.col(h), F.size(h), size))
        size *= 2
    total = F.aggregate(F.col(b), F.lit(0.0), lambda acc, x: acc + F.get(table, x))
    # Windows in order of their hash, each with its place; equal neighbours are repeats.
    placed = F.array_sort(F.transform(F.col(h), lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
    df = df.withColumn(s, F.when(F.size(F.array_distinct(h)) < F.size(h), placed))
    hits = F.array_sort(F.transform(F.filter(
        F.transform(F.col(s), lambda x, i: F.struct(
            x["at"].alias("at"),
            ((F.get(F.col(s), i - 1)["h"] == x["h"]) | (F.get(F.col(s), i + 1)["h"] == x["h"])).alias("hit"))),
        lambda x: x["hit"]), lambda x: x["at"]))
    covered = F.aggregate(
        hits, F.struct(F.lit(0).alias("n"), F.lit(-REPEAT).alias("last")),
        lambda acc, at: F.struct((acc["n"] + F.least(F.lit(REPEAT), at - acc["last"])).alias("n"), at.alias("last")),
        lambda acc: acc["n"])
    n_words = F.size(w).cast("long")
    repeats = F.coalesce(covered, F.lit(0)).cast("long")
    llr = F.when(F.size(w) < 1, F.lit(0.0)).otherwise(total / F.size(b))
    facts = F.struct(
        n_words.alias("n_words"),
        F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        repeats.alias("n_repeat_words"), llr.alias("ratio"))
    # As a generated row the facts are a border for the optimizer: a later filter on them is not
    # rewritten to compute them anew.
    df = df.select("*", F.explode(F.array(facts)).alias(name))
    got = F.col(name)
    failed = (got["n_words"] < MIN_WORDS) | (100 * got["n_repeat_words"] > 30 * got["n_words"])
    df = df.withColumn(name, got.withField("base_failed", failed).withField("kept", ~failed & (got["ratio"] >= THRESHOLD)))
    return df.select(*docs.columns, name), name


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    found, name = measured(docs, fit(docs, labels))
    return found.where(F.col(name)["kept"]).select(*docs.columns)
