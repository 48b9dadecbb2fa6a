"""Benchmark decontamination by suffix arrays of the training text.

Every batch of documents is one shard. Its words become numbers of the benchmark's vocabulary; any
other word is 0, where no match can pass, so only stretches of known words as long as the shortest
window are kept, and the suffix array is made of those by prefix doubling. Every suffix of every
benchmark item is looked up in it by binary search: those that find a window (13 words, or a shorter
item whole) give all places where it stands in the shard, and windows that follow each other both
in item and document join into the longest verbatim match.

The benchmark is read in blocks of about `block_bytes`; each block is broadcast to one pass over the
documents, which adds to the marks of the pass before, so no benchmark is too large and none is cut. The
documents with their marks are written between passes, so one block at a time is in memory; that takes their size in disk for
each block but the last.

Null and empty texts have no words and are never contaminated; null and empty items have no window.
Rows are judged one by one (repeated rows alike). Repeated items and items of one id count once; an
item without an id counts under the empty id. Other columns of the documents are passed on or left
out as asked, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.workspace import stage

#: Fixed value: words of the contract, over bytes of UTF-8 text with A-Z in lower case.
WORD_BYTES = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 13
BLOCK_BYTES = 8 << 20

RESULT = "struct<n_words bigint, n_hit bigint, items array<string>, longest_words bigint, longest_start bigint, marks binary>"
_RESULT_ARROW = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
    ("longest_words", pa.int64()), ("longest_start", pa.int64()), ("marks", pa.binary())])


def words(text: str | None) -> list[bytes]:
    return WORD_BYTES.findall((text or "").encode("utf-8").lower())


class Vocabulary(dict):
    """Numbers of the benchmark's words from 1; 0 for any other."""

    def __missing__(self, word: bytes) -> int:
        return 0


class TestItems:
    """Windows of a block of benchmark items, grouped by their length."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.vocabulary, self.ids = Vocabulary(), []
        starts: dict[int, dict[tuple[int, ...], list[tuple[int, int]]]] = {}
        for item_id, text in items:
            tokens = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            size = min(window, len(tokens))
            for at in range(len(tokens) - size + 1 if size else 0):
                starts.setdefault(size, {}).setdefault(tuple(tokens[at:at + size]), []).append((len(self.ids), at))
            self.ids.append(item_id)
        self.sizes = sorted(starts)
        self.windows = {n: np.array(list(found), np.int32).reshape(-1, n) for n, found in starts.items()}
        self.places = {n: list(found.values()) for n, found in starts.items()}


def suffix_array(a: np.ndarray) -> np.ndarray:
    """Places of `a` in the order of the suffixes that begin there, by prefix doubling."""
    n, rank, step = len(a), a.astype(np.int64), 1
    while True:
        second = np.zeros(n, np.int64)
        second[:-step or None] = rank[step:] + 1 if step < n else 0
        key = rank * (max(int(rank.max()), int(second.max())) + 2) + second
        order = np.argsort(key, kind="stable")
        changed = np.empty(n, np.int64)
        changed[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank, step = changed, step * 2
        if step >= n or rank.max() == n - 1:
            return order


def bounds(a: np.ndarray, order: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every query the range of the suffix array whose suffixes begin with it, by binary search."""
    size = queries.shape[1]
    padded = np.concatenate([a, np.full(size, -1, a.dtype)])
    offsets = np.arange(size)

    def search(right: bool) -> np.ndarray:
        low, high = np.zeros(len(queries), np.int64), np.full(len(queries), len(order), np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            mid = (low[open_] + high[open_]) // 2
            diff = padded[order[mid][:, None] + offsets] - queries[open_]
            first = (diff != 0).argmax(1)
            sign = diff[np.arange(len(open_)), first]
            before = sign <= 0 if right else sign < 0
            low[open_[before]] = mid[before] + 1
            high[open_[~before]] = mid[~before]

    return search(False), search(True)


def find(items: TestItems, docs: list[list[bytes]]):
    """(document, place, window size, item, place in item) arrays of all window occurrences in a shard."""
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    if not items.sizes or not docs:
        return none
    number = items.vocabulary.__getitem__
    length = np.array([len(d) for d in docs], np.int64)
    total = int(length.sum()) + len(docs)
    a = np.zeros(total, np.int32)  # one 0 ends each document
    begin = np.concatenate([[0], np.cumsum(length + 1)])[:-1]
    for d, at in zip(docs, begin):
        a[at:at + len(d)] = np.fromiter(map(number, d), np.int32, len(d))
    # Stretches of known words, at least as long as the shortest window.
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (a != 0).view(np.int8), [0]])))
    left, right = edge[::2], edge[1::2]
    long = right - left >= items.sizes[0]
    left, right = left[long], right[long]
    if not len(left):
        return none
    sizes = right - left + 1  # with the 0 that ends it
    at = np.repeat(left - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    b = a[at]
    order = suffix_array(b)
    out = []
    for size in items.sizes:
        low, high = bounds(b, order, items.windows[size])
        for w in np.flatnonzero(high > low):
            place = at[order[low[w]:high[w]]]
            for item, in_item in items.places[size][w]:
                out.append((place, size, item, in_item))
    if not out:
        return none
    place = np.concatenate([o[0] for o in out])
    count = [len(o[0]) for o in out]
    doc = np.searchsorted(begin, place, "right") - 1
    return doc, place - begin[doc], *(np.repeat([o[k] for o in out], count) for k in (1, 2, 3))


def judge(items: TestItems, docs: list[list[bytes]], before: list[dict] | None) -> list[dict]:
    """A result for every document, added to those of the blocks before."""
    doc, place, size, item, in_item = find(items, docs)
    by_doc = np.argsort(doc, kind="stable")
    cuts = np.searchsorted(doc[by_doc], np.arange(len(docs) + 1))
    out = []
    for i, d in enumerate(docs):
        old = before[i] if before else {"items": [], "longest_words": 0, "longest_start": None, "marks": b""}
        mine = by_doc[cuts[i]:cuts[i + 1]]
        if not len(mine):
            out.append({**old, "n_words": len(d), "n_hit": old.get("n_hit", 0)})
            continue
        edge = np.zeros(len(d) + 1, np.int32)
        np.add.at(edge, place[mine], 1)
        np.add.at(edge, place[mine] + size[mine], -1)
        hit = np.cumsum(edge[:-1]) > 0
        if old["marks"]:
            hit |= np.unpackbits(np.frombuffer(old["marks"], np.uint8), count=len(d)).astype(bool)
        longest, start = chain(place[mine], size[mine], item[mine], in_item[mine])
        if (old["longest_words"], -(old["longest_start"] or 0)) >= (longest, -start):
            longest, start = old["longest_words"], old["longest_start"]
        out.append({
            "n_words": len(d), "n_hit": int(hit.sum()), "items": sorted({*old["items"], *(items.ids[k] for k in item[mine])}),
            "longest_words": longest, "longest_start": start, "marks": np.packbits(hit).tobytes()})
    return out


def chain(place, size, item, in_item) -> tuple[int, int]:
    """Words and place of the longest match that windows following each other make; the first of equal ones."""
    line = place - in_item
    order = np.lexsort((place, line, item))
    place, size, item, line = place[order], size[order], item[order], line[order]
    new = np.concatenate([[True], (np.diff(item) != 0) | (np.diff(line) != 0) | (np.diff(place) > 1)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    n = place[last] + size[last] - place[first]
    best = np.lexsort((place[first], -n))[0]
    return int(n[best]), int(place[first][best])


def test_blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int):
    """(last, items) for blocks of about `block_bytes` of the distinct items, each fetched when its turn comes."""
    rows = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t")).where("t IS NOT NULL").distinct()
    total = rows.select(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        yield k == n - 1, [(r.i, r.t) for r in rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", item: str = "item_id",
                  item_text: str = "text", block_bytes: int = BLOCK_BYTES, window: int = WINDOW) -> tuple[DataFrame, str]:
    """The columns `keep` of every document and a struct of what was found; with that struct's name.

    The struct has n_words, n_hit (words inside any occurrence of a window), items (ids with occurring
    windows, sorted as text), longest_words and longest_start (the longest verbatim match).
    """
    spark = docs.sparkSession
    name = "contamination"
    while name in [c.lower() for c in docs.columns]:
        name += "_"
    out = docs.select(*dict.fromkeys([*keep, text]))
    for k, (last, block) in enumerate(test_blocks(benchmark, item, item_text, block_bytes)):
        sent = spark.sparkContext.broadcast(TestItems(block, window))  # of one block, whose size is bounded
        own = list(keep) if last else out.columns[:len(dict.fromkeys([*keep, text]))]
        schema = T.StructType([out.schema[c] for c in own] + [T.StructField(name, T.StructType.fromDDL(f"r {RESULT}")["r"].dataType)])

        def run(batches, sent=sent, own=own, first=k == 0):
            for b in batches:
                before = None if first else b.column(name).to_pylist()
                found = judge(sent.value, [words(x.as_py()) for x in b.column(text)], before)
                yield pa.RecordBatch.from_arrays([b.column(c) for c in own] + [pa.array(found, _RESULT_ARROW)], names=[*own, name])

        out = out.mapInArrow(run, schema)
        if not last:
            out = stage(out, "contamination")
            sent.destroy()  # the marks are written
    return out, name


def contaminated(result: str):
    """The contract's rule on a result column: at least a twentieth of the words are hit."""
    hit, n = F.col(result)["n_hit"], F.col(result)["n_words"]
    return (hit > 0) & (20 * hit >= n)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without those that the benchmark contaminates, with all their columns."""
    found, name = contamination(docs, benchmark, docs.columns)
    return found.where(~contaminated(name)).select(*docs.columns)
