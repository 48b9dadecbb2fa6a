"""Phrase collocations by Toivonen's mining, with exact counts.

Texts are lower-cased (A-Z), cut into pieces at `[.,;:!?\\x0A-\\x0D]` and these into words `[^\\x20\\x09]+`. All is per language.
A phrase of up to `max_words` words is frequent if it stands `min_count` times or more in the pieces of all documents.

1. A sample of the documents (one in `SAMPLE_ONE_IN`) proposes the phrases that reach `PROPOSE` of their share of `min_count` in it.
2. A pass over all documents counts, exactly, all words, the proposed phrases and their negative border: the phrases that are not
   proposed but whose two parts (all words but the last, all but the first) are. A frequent phrase that was not
   proposed shows itself there, or has a part that does.
3. If some frequent phrase had not been proposed, longer phrases may be missing. A further pass counts the phrases that were not
   counted yet and whose two parts are each frequent or themselves not counted yet. As a part of a frequent phrase is
   frequent, that closes the mining: no frequent phrase is left out.

So the sample decides what a run costs and never what it finds. Tasks know the proposed or frequent phrases by a bit map of fixed
size (`BITS`): phrases that share a bit with a known one are counted too, which adds rows and changes no count. Phrases
themselves are the keys of all sums, so equal hashes cannot mix counts.

Null and empty texts have no words; a null language is `und`. Repeated rows count as often as they stand. Texts of any length are
whole; a task holds `FLUSH_WORDS` words, or those of one longer text. Other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.workspace import stage

SAMPLE_ONE_IN = 8
BITS = 1 << 26
PROPOSE = 0.8
FLUSH_WORDS = 1_800_000
#: The top phrases of a language are first taken in this many shares, so that a large language is not one task's.
SHARES = 64
ROWS_OUT = 50_000

#: Bytes of a text after lower case: blanks between words, and 0xFF, which no text holds, between pieces.
LOWERED = bytes.maketrans(bytes(range(65, 91)) + b"\t.,;:!?\x0a\x0b\x0c\x0d", bytes(range(97, 123)) + b" " + b"\xff" * 10)

COUNTS = "lang string, k int, phrase string, f long"
_SCHEMA = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])


class Known:
    """Membership in a set of phrases, by a bit map; every phrase is a member of the set without one."""

    def __init__(self, bits: np.ndarray | None, seed: int):
        self.bits, self.seed = bits, seed

    def __call__(self, names: list[bytes]) -> np.ndarray:
        if self.bits is None:
            return np.ones(len(names), bool)
        seed, crc = self.seed, zlib.crc32
        at = np.fromiter((crc(x, seed) for x in names), np.int64, len(names)) % (8 * len(self.bits))
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


class Words:
    """The words of one language that a task holds, as numbers; 0 stands between pieces."""

    def __init__(self):
        self.numbers = defaultdict(count(1).__next__)
        self.numbers[b"\xff"] = 0
        self.parts: list[np.ndarray] = []

    def add(self, text: bytes) -> int:
        words = text.translate(LOWERED).replace(b"\xff", b" \xff ").split()
        words.append(b"\xff")
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        return len(words)


def count_phrases(words: Words, max_words: int, now: Known, before: Known | None):
    """(k, phrases, counts) of each length: the phrases that a pass has to count.

    A first pass counts all words and the phrases whose parts are both known now. A further one counts the phrases whose parts
    were not both known before, and each are known now or counted by this pass. A part that only this pass counts was not known
    before, even if it shares its bit with a known one: the first pass never got to it.
    """
    names = [b"", *list(words.numbers)[1:]]
    at = np.concatenate(words.parts)
    words.parts.clear()
    last, fresh = names, np.zeros(len(names), bool)
    if before is None:
        yield 1, names[1:], np.bincount(at, minlength=len(names))[1:]
    for k in range(2, max_words + 1):
        # A place goes on if its phrase of k - 1 words is known; 0 is no phrase.
        known = now(names) | fresh
        known[0] = False
        held = np.flatnonzero(known[at])
        pairs = held[:-1][np.diff(held) == 1]  # places whose two parts are known
        if not len(pairs):
            return
        keys, inverse, f = np.unique(at[pairs].astype(np.int64) * len(names) + at[pairs + 1], return_inverse=True, return_counts=True)
        left, right = np.divmod(keys, len(names))
        rights = right.tolist()
        longer = [names[a] + b" " + last[b] for a, b in zip(left.tolist(), rights)]
        if before is None:
            yield k, longer, f
        else:
            was = before(names) & ~fresh
            new = ~(was[left] & was[right])
            some = np.flatnonzero(new)
            yield k, [longer[i] for i in some.tolist()], f[some]
        del keys, left, right, held
        at[:] = 0
        at[pairs] = inverse + 1
        last = [b"", *(last[b] for b in rights)]
        names = [b"", *longer]
        fresh = np.zeros(len(names), bool)
        if before is not None:
            fresh[1:] = new


def counted(docs: DataFrame, max_words: int, now: np.ndarray | None, before: np.ndarray | None, text: str, lang: str) -> DataFrame:
    """lang, k, phrase, f: exact counts of what one pass counts, and in a first one the number of words of each language (k 0)."""
    sc = docs.sparkSession.sparkContext
    bits_now, bits_before = (None if b is None else sc.broadcast(b) for b in (now, before))

    def rows(name: str, words: Words):
        seed = zlib.crc32(name.encode() + b"\xff")
        here = Known(None if bits_now is None else bits_now.value, seed)
        if bits_before is None:
            n = sum(int(np.count_nonzero(p)) for p in words.parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([0], pa.int32()), pa.array([""]), pa.array([n], pa.int64())], schema=_SCHEMA)
        for k, phrases, f in count_phrases(words, max_words, here, None if bits_before is None else Known(bits_before.value, seed)):
            for a in range(0, len(phrases), ROWS_OUT):
                some = pa.array(phrases[a:a + ROWS_OUT], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([
                    pa.repeat(pa.scalar(name), len(some)), pa.repeat(pa.scalar(k, pa.int32()), len(some)), some,
                    pa.array(f[a:a + ROWS_OUT], pa.int64())], schema=_SCHEMA)

    def run(batches):
        held: dict[str, Words] = defaultdict(Words)
        size = 0
        for batch in batches:
            for name, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                size += held[name].add(x.as_buffer().to_pybytes())
                if size >= FLUSH_WORDS:
                    while held:
                        yield from rows(*held.popitem())
                    size = 0
        while held:
            yield from rows(*held.popitem())

    given = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("x")).where("x IS NOT NULL")
    return given.mapInArrow(run, COUNTS).groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f"))


def bit_map(phrases: DataFrame) -> np.ndarray:
    """The bit map of a set of (lang, phrase); the driver gets at most `BITS` / 64 numbers, whatever the set's size."""
    bit = F.crc32(F.concat(F.encode("lang", "UTF-8"), F.lit(b"\xff"), F.encode("phrase", "UTF-8"))) % BITS
    words = phrases.select(bit.alias("bit")).groupBy(F.expr("bit div 64").alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("bits")).toArrow()
    out = np.zeros(BITS // 64, "<i8")
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint8)


def frequent_phrases(docs: DataFrame, min_count: int = 30, max_words: int = 4, text: str = "text", lang: str = "lang",
                     key: str = "doc_id") -> DataFrame:
    """lang, k, phrase, f: every phrase that stands `min_count` times or more in its language, and with k 0 the number of words."""
    sample = docs.where(F.pmod(F.xxhash64(key, text), F.lit(SAMPLE_ONE_IN)) == 0)
    least = max(2, round(PROPOSE * min_count / SAMPLE_ONE_IN))
    proposed = stage(counted(sample, max_words - 1, None, None, text, lang).where(
        (F.col("k") > 0) & (F.col("f") >= least)).select("lang", "phrase"), "phrases-proposed")
    first = bit_map(proposed)
    found = stage(counted(docs, max_words, first, None, text, lang).where(
        (F.col("k") == 0) | (F.col("f") >= min_count)), "phrases-counted")
    short = found.where(F.col("k").between(1, max_words - 1))
    if not short.join(proposed, ["lang", "phrase"], "left_anti").isEmpty():  # the border failed
        more = counted(docs, max_words, bit_map(short), first, text, lang).where(F.col("f") >= min_count)
        found = found.unionByName(stage(more, "phrases-counted"))
    return found


def whole(c: Column, digits: int) -> Column:
    return c.cast(f"decimal({digits},0)")


def collocations(docs: DataFrame, min_count: int = 30, max_words: int = 4, top: int = 2000, text: str = "text", lang: str = "lang",
                 key: str = "doc_id") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of two or more words of each language.

    A cut of a phrase has l and r, the counts of its two parts, and the score floor(2000000 a / (l + r)); the lowest of a phrase
    counts (of equal ones the first). Phrases that stand inside a longer frequent one with at least 80 hundredths of their
    count are left out. Order: score, then a, both falling, then the phrase's bytes. Products are whole decimals.
    """
    found = stage(frequent_phrases(docs, min_count, max_words, text, lang, key), "phrases-frequent")
    size = found.where("k = 0").select("lang", F.col("f").alias("n"))  # one row for each language
    of = found.where("k > 0").select("lang", "phrase", "f")
    words = F.split("phrase", " ", -1)
    several = found.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), words.alias("w"))

    def part(first: Column, length: Column) -> Column:
        return F.array_join(F.slice("w", first, length), " ")

    cuts = several.select("lang", "phrase", "k", "a", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("left"),
                       part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    cuts = cuts.join(of.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(
        of.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.withColumn("a2", whole(F.col("a"), 19) * whole(F.lit(2000000), 7)).withColumn("lr", whole(F.col("l"), 19) + whole(F.col("r"), 19))
    scored = cuts.withColumn("score", F.expr("a2 div lr")).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("s"))
    # What a longer phrase holds: its parts of two words up to one less than all of it.
    held = several.where("k > 2").select("lang", "w", "k", "a", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("m"))
    held = held.select("lang", "w", "a", "m", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("m") + 1)).alias("at"))
    held = held.select("lang", part(F.col("at"), F.col("m")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(held, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (whole(F.col("longer"), 19) * 100 < whole(F.col("a"), 19) * 80))
    order = [F.desc("s.score"), F.desc("a"), "phrase"]
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    some = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", share).orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(size, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("s.l").alias("l"), F.col("s.r").alias("r"), "n",
        F.col("s.score").cast("long").alias("score"))


def lowered(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def oracle_sql(min_count: int = 30, max_words: int = 4, top: int = 2000) -> str:
    """The same by counting every phrase of every document, in DuckDB."""
    sizes = ", ".join(map(str, range(1, max_words + 1)))
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({lowered('text')}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
worded AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM worded, (SELECT unnest([{sizes}]) AS k) WHERE len(w) >= k),
counted AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang),
frequent AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM counted WHERE f >= {min_count}),
cuts AS (SELECT lang, phrase, f AS a, w, k, unnest(range(1, k)) AS cut FROM frequent WHERE k > 1),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r,
    ((2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
held AS (
  SELECT lang, array_to_string(w[pos:pos + m - 1], ' ') AS phrase, max(f) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS pos FROM (SELECT *, unnest(range(2, k)) AS m FROM frequent WHERE k > 2)) GROUP BY ALL),
kept AS (
  SELECT o.* FROM lowest o LEFT JOIN held h ON h.lang = o.lang AND h.phrase = o.phrase
  WHERE h.longer IS NULL OR 100::HUGEINT * h.longer < 80::HUGEINT * o.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, s.n, r.score FROM ranked r JOIN sizes s ON s.lang = r.lang WHERE r.rank <= {top}
"""
