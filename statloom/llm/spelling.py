"""Spelling variants by PartEnum signatures: words that differ by one letter, found without comparing all pairs.

A word is taken as the multiset of its letters, a binary vector with a place for each letter and occurrence. One replaced letter
moves the vector by a Hamming distance of 2, one inserted or deleted letter by 1. Letters are dealt to parts; a distance of 2
touches two parts at most, so of all ways to leave out two of `PARTS_2` parts one leaves nothing but equal letters, and
for a distance of 1 of all ways to leave out one of `PARTS_1`. Each such way gives a word a signature: its length and the letters
that are left. As the words of one multiset can be many, a signature is split by one half of the word, since an edit
leaves the other half as it is: each word has it with its first and with its second half. Words
of equal signatures meet in an equi-join and are verified by edit distance. No near pair is missed, and equal hashes decide nothing.

All is built-in Spark expressions. Words are rows (word, n); null words are left, rows of one word are summed. Words of any length
and any letters go. A table without words gives no rows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import stage

PARTS_2 = 4
PARTS_1 = 3
#: Letters that are dealt to parts, the most frequent ones; signatures leave out all others, which only makes them wider.
LETTERS = 500
#: A form stands at least this many times as often as its variant.
TIMES = 10


def letters(word: str = "word") -> Column:
    return F.regexp_extract_all(word, F.lit("(?s)."), F.lit(0))


def deal(words: DataFrame, parts: int) -> list[str]:
    """The letters of each part: in order of frequency to and fro over the parts, so that they weigh about the same."""
    found = words.select(F.explode(letters()).alias("c")).groupBy("c").count()
    ordered = [r.c for r in found.orderBy(F.desc("count"), "c").limit(LETTERS).collect()]
    out = [""] * parts
    for i, c in enumerate(ordered):
        at = i % (2 * parts)
        out[at if at < parts else 2 * parts - 1 - at] += c
    return out


def signatures(words: DataFrame) -> DataFrame:
    """word, n, key: in one key meet the words that may differ by one replaced letter, or by one letter more in the longer one."""
    by_2, by_1 = deal(words, PARTS_2), deal(words, PARTS_1)
    # In one order of letters, words of one multiset are one text; letters outside the parts go.
    listed = sorted("".join(by_2))
    bag = F.array_join(F.filter(F.array_sort(letters()), lambda c: c.isin(*listed)), "")
    rows = words.select("word", "n", F.length("word").alias("size"), bag.alias("bag"))

    def keys(kind: str, gone: str, less: int) -> list[Column]:
        """Keys of a signature; `less` is 1 for the longer word of a pair, whose halves are those of the shorter."""
        size = f"(size - {less})"
        left = [F.lit(kind), F.lit(gone), F.expr(size), F.translate("bag", gone, "")]
        return [
            F.xxhash64(*left, F.lit("first"), F.expr(f"left(word, cast({size} / 2 as int))")),
            F.xxhash64(*left, F.lit("second"), F.expr(f"right(word, {size} - cast({size} / 2 as int))"))]

    own = [k for a, b in combinations(by_2, 2) for k in keys("replace", a + b, 0)]
    own += [k for a in by_1 for less in (0, 1) for k in keys("insert", a, less)]
    return rows.select("word", "n", F.explode(F.array(*own)).alias("key"))


def near_pairs(words: DataFrame) -> DataFrame:
    """a, b, a_n, b_n: the pairs of words with an edit distance of exactly one, each once."""
    rows = signatures(words)
    one = rows.select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    two = rows.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))  # the same shuffle as the other side
    more = F.length("b") - F.length("a")
    # Rows are many for each word, which Spark's estimate of sizes does not know: never broadcast them.
    both = one.join(two.hint("merge"), "key").where((more == 1) | ((more == 0) & (F.col("a") < F.col("b")))).where(F.levenshtein("a", "b", 1) == 1)
    return both.groupBy("a", "b").agg(F.first("a_n").alias("a_n"), F.first("b_n").alias("b_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where the forms (word, form) lead in the end. Each is much more frequent than the one before, so no way is a circle.

    Each round doubles the steps that a row has gone.
    """
    at = stage(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while not at.where("moved").isEmpty():
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = stage(at.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
    return at.select("word", "root")


def variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word in (word, n).

    A word's form is its near word of largest n (of equal ones the first in code-point order), if that n is at least
    `TIMES` times the word's own. `n_near` counts its near words.
    """
    words = stage(words.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")), "spelling-words")
    pairs = near_pairs(words)
    ways = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))).alias("w")).select("w.*")
    best = ways.groupBy("word", "n").agg(F.count("other").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("best"))
    is_form = -F.col("best.m") >= TIMES * F.col("n")
    best = stage(best.select("word", "n_near", F.when(is_form, F.col("best.other")).alias("form"),
                             F.when(is_form, -F.col("best.m")).alias("form_n")), "spelling-near")
    root = roots(best.where("form IS NOT NULL"))
    return words.join(best, "word", "left").join(root, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
