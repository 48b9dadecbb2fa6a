"""Fuzzy line dedup: MinHash of character shingles, banding, exact Jaccard, union-find.

A line's shingles are `CHARS` characters from every place of it, with a single blank between words, in lower case; a shorter line is
one shingle. With `WORD_STARTS` they are those from every word start (of a shorter word, as much of the next one as fits) and from
every place inside a longer word: fewer, but every character is in one. Equal lines (128-bit hash) are one node. Links are pairs of nodes that share a band and whose
exact Jaccard similarity of shingle sets is at least `SIMILARITY`. Each node's signature has `BANDS` x `BAND_ROWS`
minima: a pair of similarity 0.8 shares a band with a chance of 1 - (1 - 0.8^2)^8 = 0.9997. Pairs are compared in two rounds.

1. In a bucket every member is compared with up to `2 * PIVOTS` pivots, members of smallest and largest hash in that band.
   This joins copies at a few pairs each, and gives components.
2. Buckets of four or more members that still hold different components may hide pairs that were not compared. In
   buckets of up to `DIRECT` members all pairs that lie in different components are compared. Those of larger
   buckets are looked for by exact prefixes: in one order of all shingles, two sets of enough similarity share one of their first shingles (`prefixes`). So no
   link inside a bucket is missed, and no larger bucket is compared all with all. The order is rarest first, so lines of one
   template, which differ by more than a link may, meet only where they share a rare shingle. Shingles' counts are from a part of
   the lines: the order decides what it costs, never what is found.

A pair is verified only if bit maps of its sets (`differ_little`) leave a link open: each differing bit is a shingle that only one
set has. This rules out no link, and most of what is none. Maps are made of the lines that are in pairs, once each.

Of each component the first line (smallest id, then place) stays and the others go.

All is built-in Spark expressions. Shingles are summed to minima before any shuffle, so a line that a third of all documents share is one row of each task. Lines without a word always stay, and so do
all lines of null and empty texts. A row is known by its id and text, so rows that share an id are
treated apart unless their texts are equal too: those are one document and lose the same lines. A
missing id comes before all others. Columns keep their names and order.
"""

from __future__ import annotations

import math
import random
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import stage
from .common import WORD
from .components import connected_components

CHARS = 12
BANDS = 8
BAND_ROWS = 2
PIVOTS = 3
#: Where shingles start: at every place of a line, or at its words.
EVERY_PLACE, WORD_STARTS = "every place", "word starts"
#: Buckets of more members are searched by prefixes.
DIRECT = 512
#: Shingles of one line that a row holds while minima and bit maps are made of them.
STRIDE, MAP_STRIDE = 8, 4
#: Words of 64 bits in the bit maps of pairs, and of sets that are searched by prefixes.
WORDS, MORE_WORDS = 16, 8
SIMILARITY = 0.8
#: Classes of shingles that are counted for their order, and which part of the lines (one in so many) counts.
CLASSES = 1 << 16
COUNTED = 16

#: One match at every word, the word and as much of the next one as a shingle can hold, and at every further
#: place of a word from which it holds a whole shingle.
SHINGLE = rf"(?=([^ ]{{{CHARS}}}|(?<![^ ])[^ ]+(?: [^ ]{{1,{CHARS - 2}}})?))(?:[^ ](?=[^ ]{{{CHARS - 1}}})|[^ ]+)"


def single_blanks(line: str) -> Column:
    """A line in lower case with a blank for each run of ASCII white space; most lines have no other and skip the regular expression."""
    others = [F.contains(F.col(line), F.lit(x)) for x in ("  ", "\t", "\n", "\x0b", "\x0c", "\r")]
    single = F.regexp_replace(line, r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")
    return F.lower(F.when(reduce(lambda a, b: a | b, others), single).otherwise(F.col(line)))


def code_points(line: str) -> Column:
    """A line as four bytes for each character, so that any stretch of it is found at once."""
    return F.encode(F.trim(single_blanks(line)), "UTF-32")


def places(points: Column) -> Column:
    """The first bytes of all shingles, counted from 1."""
    return F.sequence(F.lit(1), F.greatest(F.octet_length(points) - (4 * CHARS - 1), F.lit(1)), F.lit(4))


def shingle_list(line: str, at: str) -> Column:
    """Hashes of the character shingles of a line, equal ones too."""
    if at == EVERY_PLACE:
        # An array of one element names the code points, so that they are not worked out for every shingle.
        found = F.transform(F.array(code_points(line)), lambda p: F.transform(
            places(p), lambda x: F.xxhash64(F.substring(p, x, F.lit(4 * CHARS)))))
        return F.get(found, F.lit(0))
    found = F.regexp_extract_all(single_blanks(line), F.lit(SHINGLE), F.lit(1))
    return F.transform(found, lambda x: F.xxhash64(F.substring(x, 1, CHARS)))


def shingles(line: str, at: str) -> Column:
    """Hashes of the set of character shingles of a line."""
    return F.array_distinct(shingle_list(line, at))


def lines_of(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(id, text_hash, pos, line): the lines with a word, by the row they are in."""
    rows = docs.select(
        F.col(key).alias("id"), F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    return rows.where(F.col("line").rlike(WORD))


def line_shingles(lines: DataFrame, at: str, *more: str) -> DataFrame:
    """(node, first, s, *more): the shingles of each line as rows, those of `shingles`; `first` is true in one row of each line.

    Rows and not arrays, so that all of it is compiled into one loop with the sums over it.
    """
    if at == EVERY_PLACE:
        of = lines.select(F.xxhash64("line").alias("node"), code_points("line").alias("points"), *more)
        rows = of.select("*", F.explode(places(F.col("points"))).alias("place"))
        return rows.select("node", (F.col("place") == 1).alias("first"), F.xxhash64(F.substring("points", F.col("place"), F.lit(4 * CHARS))).alias("s"), *more)
    words = F.split(F.trim(single_blanks("line")), " ", -1)
    of = lines.select(F.xxhash64("line").alias("node"), words.alias("w"), *more)
    two = of.select("node", *more, F.posexplode(F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, F.size("w")).alias("b"))).alias("at", "z"))
    starts = F.when(F.length("z.a") > CHARS, F.sequence(F.lit(1), F.length("z.a") - (CHARS - 1))).otherwise(F.array(F.lit(1)))
    both = F.concat("z.a", F.coalesce(F.concat(F.lit(" "), "z.b"), F.lit("")))
    rows = two.select("node", *more, "at", both.alias("both"), F.explode(starts).alias("place"))
    return rows.select(
        "node", ((F.col("at") == 0) & (F.col("place") == 1)).alias("first"),
        F.xxhash64(F.substring("both", F.col("place"), F.lit(CHARS))).alias("s"), *more)


def strides(lines: DataFrame, at: str, n: int, *more: str) -> tuple[DataFrame, list[str]]:
    """(node, first, s0 .., *more) and the names s0 ..: shingles of each line, up to `n` in a row; `first` is true in one row of each line.

    At its end a line's last shingle stands more than once, which changes neither minima nor bit maps. One row for several
    shingles spares most of the work of sums over them. Shingles from word starts come one in a row.
    """
    if at != EVERY_PLACE:
        return line_shingles(lines, at, *more), ["s"]
    of = lines.select(F.xxhash64("line").alias("node"), code_points("line").alias("points"), *more)
    of = of.withColumn("last", F.greatest(F.octet_length("points") - (4 * CHARS - 1), F.lit(1)))
    rows = of.select("*", F.explode(F.sequence(F.lit(1), F.col("last"), F.lit(4 * n))).alias("place"))
    names = [f"s{i}" for i in range(n)]
    return rows.select("node", (F.col("place") == 1).alias("first"), *(
        F.xxhash64(F.substring("points", F.least(F.col("place") + 4 * i, F.col("last")), F.lit(4 * CHARS))).alias(s)
        for i, s in enumerate(names)), *more), names


def least_of(cols: list[Column]) -> Column:
    return F.least(*cols) if len(cols) > 1 else cols[0]


def place_of(s: Column, words: int) -> tuple[Column, Column]:
    """Which word of a bit map a shingle has, and its bit there."""
    return F.pmod(F.shiftright(s, 6), F.lit(words)).cast("int"), F.call_function("shiftleft", F.lit(1).cast("bigint"), s.bitwiseAND(F.lit(63)).cast("int"))


def bit_in(k: int, word: str, bit: str) -> Column:
    """The bit of a shingle in word k of its bit map."""
    return F.when(F.col(word) == k, F.col(bit)).otherwise(F.lit(0).cast("bigint"))


def map_names(words: int) -> list[str]:
    return ["size", *(f"bits{k}" for k in range(words))]


def differ_little(a: str, b: str, words: int) -> Column:
    """Whether sets with these bit maps and `size` shingles can have a similarity of `SIMILARITY`.

    Sets x and y of that similarity differ in at most (1 - t) / (1 + t) * (|x| + |y|) shingles.
    """
    bits = sum((F.bit_count(F.col(f"{a}bits{k}").bitwiseXOR(F.col(f"{b}bits{k}"))) for k in range(words)), F.lit(0))
    return bits * (1 + SIMILARITY) <= (F.col(f"{a}size") + F.col(f"{b}size")) * (1 - SIMILARITY) + 1e-6


def similar_sizes(a: str, b: str) -> Column:
    """Whether sets of these sizes can have a similarity of `SIMILARITY`."""
    return F.least(a, b) >= SIMILARITY * F.greatest(a, b)


def masks() -> list[int]:
    """One number for each minimum; each begins with other four bits."""
    rng = random.Random(1)
    return [((k << 60) | rng.getrandbits(60)) - (1 << 63) for k in range(BANDS * BAND_ROWS)]


def line_buckets(lines: DataFrame, at: str) -> DataFrame:
    """(node, key): the bands of each node (64-bit hash of a line) that another node has too.

    A minimum is that of the shingles' hashes after an exclusive or with its mask: as hashes are evenly spread, each shingle of
    two sets is the least with the same chance. A row with key null says that the line itself stands in more than one place.
    """
    rows, names = strides(lines, at, STRIDE)
    least = [F.min(least_of([F.col(s).bitwiseXOR(F.lit(m)) for s in names])).alias(f"m{k}") for k, m in enumerate(masks())]
    nodes = rows.groupBy("node").agg(F.count(F.when(F.col("first"), 1)).alias("n"), *least)
    bands = [F.xxhash64(F.lit(b), *(f"m{b * BAND_ROWS + r}" for r in range(BAND_ROWS))) for b in range(BANDS)]
    signed = stage(nodes.select("node", (F.col("n") > 1).alias("again"), F.array(*bands).alias("keys")), "line-keys")
    keyed = signed.select("node", F.explode("keys").alias("key"))
    again = signed.where("again").select("node", F.lit(None).cast("bigint").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("key").alias("members")).where("members > 1").select("key")
    return keyed.join(shared, "key").select("node", "key").unionByName(again)


def line_maps(texts: DataFrame, at: str) -> DataFrame:
    """(node, size, bits0 ..): the bit map of each distinct line and the size of its set."""
    rows, names = strides(texts, at, MAP_STRIDE, "size")
    rows = rows.select("node", "size", *(c.alias(f"{n}_{s}") for s in names for n, c in zip(("word", "bit"), place_of(F.col(s), WORDS))))
    return rows.groupBy("node").agg(F.max("size").alias("size"), *(
        F.bit_or(reduce(Column.bitwiseOR, [bit_in(k, f"word_{s}", f"bit_{s}") for s in names])).alias(f"bits{k}") for k in range(WORDS)))


def texts_of(lines: DataFrame, nodes: DataFrame, at: str) -> DataFrame:
    """(node, line, size): the lines of these nodes, once each, and how many shingles their sets have."""
    found = lines.select(F.xxhash64("line").alias("node"), "line").join(nodes, "node", "left_semi")
    found = found.groupBy("node").agg(F.first("line").alias("line"))
    return stage(found.withColumn("size", F.size(shingles("line", at))), "line-texts")


def candidate_pairs(buckets: DataFrame) -> DataFrame:
    """(a, b): nodes that share a band, one of them a pivot of the bucket."""
    # Pivots are the smallest and the largest of hashes that differ from band to band.
    orders = [F.xxhash64(F.lit(k), "key", "node") for k in range(PIVOTS)]
    members = buckets.where("key IS NOT NULL")
    pivots = members.groupBy("key").agg(*(f(o).alias(f"{n}{k}") for k, o in enumerate(orders) for n, f in (("low", F.min), ("high", F.max))))
    # A bucket's pivots are found again by their hashes and meet its members.
    is_pivot = F.lit(False)
    for k, o in enumerate(orders):
        is_pivot = is_pivot | (o == F.col(f"low{k}")) | (o == F.col(f"high{k}"))
    own = members.join(pivots, "key").where(is_pivot).select("key", F.col("node").alias("pivot"))
    pairs = members.join(own, "key").where(F.col("node") != F.col("pivot"))
    return pairs.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()


def unsettled(buckets: DataFrame, comps: DataFrame) -> DataFrame:
    """(node, key, comp, k): members of buckets of k with pairs that were not compared and lie in different components.

    Of three members every pair has a pivot.
    """
    members = buckets.where("key IS NOT NULL").join(comps.select(F.col("id").alias("node"), "component"), "node", "left")
    members = members.select("node", "key", F.coalesce("component", "node").alias("comp"))
    mixed = members.groupBy("key").agg(F.count("node").alias("k"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    return members.join(mixed.where("k > 3 AND low <> high").select("key", "k"), "key").select("node", "key", "comp", "k")


def direct_pairs(members: DataFrame, maps: DataFrame) -> DataFrame:
    """(a, b): all pairs of a bucket that lie in different components and may be links."""
    rows = members.select("key", "node", "comp").join(maps, "node")
    other = rows.select("key", *(F.col(c).alias(f"q_{c}") for c in ("node", "comp", *map_names(WORDS))))
    both = rows.join(other, "key").where(
        (F.col("node") < F.col("q_node")) & (F.col("comp") != F.col("q_comp")) & similar_sizes("size", "q_size")
        & differ_little("", "q_", WORDS))
    return both.select(F.col("node").alias("a"), F.col("q_node").alias("b")).distinct()


def class_levels(lines: DataFrame, at: str) -> Column:
    """How frequent the shingles of each class are, in quarters of powers of two: one constant of fixed size."""
    some = lines.where(F.pmod(F.xxhash64("line"), F.lit(COUNTED)) == 0)
    rows = some.select(F.explode(shingles("line", at)).alias("s")).groupBy(F.pmod("s", F.lit(CLASSES)).alias("c")).count().collect()
    levels = [0] * CLASSES
    for r in rows:
        levels[r.c] = round(4 * math.log2(1 + r["count"]))
    return F.split(F.lit(",".join(map(str, levels))), ",").cast("array<bigint>")  # folded to one constant


def prefixes(lines: DataFrame, at: str) -> DataFrame:
    """(node, size, bits, prefix): of each distinct line its bit map and the first shingles, in one order for all, by which links are found.

    A bit of this map is the parity of the shingles that fall on it, so it tells large sets apart as well.

    Of sets x and y, y not larger, with a similarity t or more, at least t * |x| and at least 2 t / (1 + t) * |y| shingles
    are shared. So the first |x| - t |x| + 1 of x and the first |y| - 2 t / (1 + t) |y| + 1 of y share one.
    """
    levels = class_levels(lines, at)
    sets = stage(lines.select(F.xxhash64("line").alias("node"), shingles("line", at).alias("s")), "line-sets")
    # The level is above the hash, so that the order is that of whole numbers.
    ordered = F.sort_array(F.transform("s", lambda x: F.shiftleft(F.get(levels, F.pmod(x, F.lit(CLASSES)).cast("int")), 55).bitwiseOR(
        F.shiftrightunsigned(x, 9))))
    size = F.size("s")
    first = sets.select("node", size.alias("size"), F.slice(ordered, 1, (size - F.ceil(size * SIMILARITY - 1e-6) + 1).cast("int")).alias("prefix"))
    word, bit = place_of(F.col("s"), MORE_WORDS)
    maps = sets.select("node", F.explode("s").alias("s")).select("node", word.alias("word"), bit.alias("bit")).groupBy("node").agg(
        *(F.bit_xor(bit_in(k, "word", "bit")).alias(f"bits{k}") for k in range(MORE_WORDS)))
    return first.join(maps, "node")


def other_pairs(lines: DataFrame, comps: DataFrame, at: str) -> DataFrame:
    """(a, b): all pairs of distinct lines in different components that may be links."""
    of = prefixes(lines, at).join(comps.select(F.col("id").alias("node"), "component"), "node", "left")
    of = stage(of.withColumn("comp", F.coalesce("component", "node")).drop("component"), "line-prefixes")
    rows = of.select("node", *map_names(MORE_WORDS), "comp", F.posexplode("prefix").alias("at", "s"))
    # Members outside a shingle's largest component meet all of the other components: copies never meet each other again.
    sizes = rows.groupBy("s", "comp").agg(F.count("node").alias("k"))
    mixed = sizes.groupBy("s").agg(F.max(F.struct("k", "comp")).alias("x"), F.count("comp").alias("n")).where("n > 1")
    rows = stage(rows.join(mixed.select("s", F.col("x.comp").alias("main")), "s"), "line-shared")
    q = rows.where("comp <> main").select("s", *(F.col(c).alias(f"q_{c}") for c in ("node", *map_names(MORE_WORDS), "comp", "at")))
    both = q.join(rows, "s").where((F.col("q_comp") != F.col("comp")) & ((F.col("comp") == F.col("main")) | (F.col("q_node") < F.col("node"))))
    small, large = F.least("size", "q_size"), F.greatest("size", "q_size")
    smaller = F.struct("size", "node", "at") < F.struct("q_size", "q_node", "q_at")
    place = F.when(smaller, F.col("at")).otherwise(F.col("q_at"))
    both = both.where(differ_little("", "q_", MORE_WORDS) & (small >= SIMILARITY * large) & (place <= small - F.ceil(small * (2 * SIMILARITY / (1 + SIMILARITY)) - 1e-6)))
    return both.select(F.least("node", "q_node").alias("a"), F.greatest("node", "q_node").alias("b")).distinct()


def may_link(pairs: DataFrame, maps: DataFrame) -> DataFrame:
    """The pairs that their bit maps do not rule out."""
    of = [maps.select(F.col("node").alias(n), *(F.col(c).alias(f"{n}_{c}") for c in map_names(WORDS))) for n in "ab"]
    both = pairs.join(of[0], "a").join(of[1], "b")
    return both.where(similar_sizes("a_size", "b_size") & differ_little("a_", "b_", WORDS)).select("a", "b")


def links(pairs: DataFrame, texts: DataFrame, at: str) -> DataFrame:
    """The pairs whose shingle sets have a Jaccard similarity of `SIMILARITY` or more."""
    # Texts are joined and not their sets, which are several times as large.
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("line").alias("x"), F.col("size").alias("x_size")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("line").alias("y"), F.col("size").alias("y_size")), "b")
    # What x has alone tells the rest from the sizes, in one pass over each. A generated row is a border for the
    # optimizer: the filter does not work it out anew.
    both = both.select("a", "b", "x_size", "y_size", F.explode(F.array(
        F.size(F.array_except(shingle_list("x", at), shingle_list("y", at))))).alias("alone"))
    shared = F.col("x_size") - F.col("alone")
    return both.where(shared >= SIMILARITY * (F.col("y_size") + F.col("alone"))).select("a", "b")


def repeated_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", at: str = WORD_STARTS) -> DataFrame:
    """(id, text_hash, pos, component): the lines that go, of every row. `at` says where shingles start."""
    lines = lines_of(docs, text, key)
    buckets = stage(line_buckets(lines, at), "line-buckets")
    pairs = stage(candidate_pairs(buckets), "line-pairs")
    texts = texts_of(lines, pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), at)
    maps = stage(line_maps(texts, at), "line-maps")
    found = stage(links(stage(may_link(pairs, maps), "line-pairs"), texts, at), "line-links")
    comps = stage(connected_components(found), "line-components")
    members = stage(unsettled(buckets, comps), "line-open")
    more = stage(links(stage(direct_pairs(members.where(F.col("k") <= DIRECT), maps), "line-pairs"), texts, at), "line-links")
    large = members.where(F.col("k") > DIRECT)
    if not large.isEmpty():
        some = stage(texts.join(large.select("node"), "node", "left_semi").select("line"), "line-texts")
        more = more.union(stage(links(stage(other_pairs(some, comps, at), "line-pairs"), texts, at), "line-links"))
    if not more.isEmpty():
        comps = stage(connected_components(found.unionByName(more)), "line-components")
    # From here on only lines that stand twice or have a link are looked at: no other can repeat.
    nodes = comps.select(F.col("id").alias("node")).union(buckets.where("key IS NULL").select("node")).distinct()
    places = lines.withColumn("node", F.xxhash64("line")).join(nodes, "node", "left_semi")
    # Lines of one component, or equal in all 128 bits, share (component, second hash or none).
    found = places.select("id", "text_hash", "pos", "node", F.xxhash64(F.lit(1), "line").alias("second"))
    named = comps.select(F.col("id").alias("node"), "component")
    found = found.join(named, "node", "left").select(
        "id", "text_hash", "pos", F.coalesce("component", "node").alias("component"),
        F.when(F.col("component").isNull(), F.col("second")).alias("second"))
    found = stage(found, "lines").withColumn("place", F.struct("id", "pos", "text_hash"))
    first = found.groupBy("component", "second").agg(F.min("place").alias("first"), F.count("pos").alias("n")).where("n > 1")
    first = first.select(F.col("component").alias("of"), F.coalesce("second", F.lit(0)).alias("of_second"), "first")
    both = found.join(first, (F.col("component") == F.col("of")) & (F.coalesce("second", F.lit(0)) == F.col("of_second")))
    return both.where(~F.col("place").eqNullSafe(F.col("first"))).select("id", "text_hash", "pos", "component").distinct()


def drop_repeated_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", at: str = WORD_STARTS) -> DataFrame:
    """All rows with all their columns, their texts without the lines that go."""
    gone = repeated_lines(docs, text, key, at).groupBy("id", "text_hash").agg(F.collect_set("pos").alias("gone"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("row_id"), F.xxhash64(text).alias("row_hash"))
    both = rows.join(gone, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_hash") == F.col("text_hash")), "left")
    own = F.col("row").getField(text)
    kept = F.filter(F.split(own, "\n"), lambda x, i: ~F.array_contains("gone", i))
    new = F.when(F.col("gone").isNull(), own).otherwise(F.array_join(kept, "\n"))
    return both.select(*(new.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns))
