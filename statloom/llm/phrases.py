"""Removal of passages that an earlier document has, located by Aho-Corasick automata.

A window is `WINDOW` consecutive words; its owner is the smallest id of the documents that have it.
A document loses every word of its windows whose owner is another, smaller id.

1. Documents are dealt into parts by the hash of their id. Each window has an anchor, the smallest
   hash of the shorter word groups in it, so equal windows have equal anchors. Each part sends its
   distinct anchors, packed, to buckets of the anchor; a bucket sends back those of two ids or more.
2. Each part sends its distinct windows with such an anchor to buckets of the window, with their
   smallest and largest id. These confirm recurring windows and send back their owners.
3. Each part joins confirmed windows that follow each other to passages, compiles automata of the
   distinct passages over word numbers (each of at most `SHARD_WORDS` words) and streams its
   documents through them. Every occurrence of a passage with an owner below the document is removed.

A part is `PART_BYTES` of text, and sends a window or an anchor once, so a passage that a third of
all documents share is one entry of each part, and no task sees more than a part or a bucket of even
size. Windows are compared by 64-bit hashes between parts and word by word inside one.

Null and empty texts have no words. Ids are whole numbers; rows of the same id are one document to
each other (they remove nothing from one another). A missing id counts as larger than all others.
Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts_for

WINDOW = 13
#: Words of the groups that anchors are chosen from.
GROUP = 5
PART_BYTES = 8 << 20
#: Words in the passages of one automaton, at most (one passage is never split).
SHARD_WORDS = 2_000_000
NO_ID = np.iinfo(np.int64).max

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_hashes = WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= _MIX2
    return x ^ (x >> np.uint64(29))


def rolling(a: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n neighbours."""
    if len(a) < n:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(a) - n + 1, np.uint64)
    for k in range(n):
        h *= _MIX
        h += a[k:k + len(h)]
    return _mixed(h)


def sliding_min(a: np.ndarray, n: int) -> np.ndarray:
    done, have = a, 1
    while have < n:
        step = min(have, n - have)
        done, have = np.minimum(done[:-step], done[step:]), have + step
    return done


class Texts:
    """Words of some documents one after the other, and their windows.

    `flat` has the words, `number` says for each which distinct word it is; those of document i are from `begin[i]` to `begin[i + 1]`.
    """

    def __init__(self, ids, texts):
        import xxhash

        self.ids = np.array([NO_ID if i is None else i for i in ids], np.int64)
        column = texts if isinstance(texts, pa.ChunkedArray) else pa.chunked_array([pa.array(texts, pa.string())])
        # Splits at runs of the ASCII white space of the contract; texts that begin or end with it have empty words there.
        split = pc.ascii_split_whitespace(column.cast(pa.large_string()).combine_chunks())
        found = split.flatten()
        filled = pc.greater(pc.binary_length(found), 0)
        ends = np.cumsum(pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        before = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False), dtype=np.int64)])
        self.begin = before[np.concatenate([[0], ends])]
        self.flat = found.filter(filled).cast(pa.large_binary())
        coded = self.flat.dictionary_encode()
        self.number = coded.indices.to_numpy()
        words = coded.dictionary.to_numpy(zero_copy_only=False)
        hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))[self.number]
        self.hashed = hashed
        length = np.diff(self.begin)
        doc = np.repeat(np.arange(len(length)), length)
        n = max(0, len(hashed) - WINDOW + 1)
        self.starts = np.flatnonzero(doc[:n] == doc[WINDOW - 1:][:n])  # windows inside one document
        self.doc = doc[self.starts]

    def __len__(self) -> int:
        return len(self.ids)

    def windows(self) -> np.ndarray:
        return rolling(self.hashed, WINDOW)[self.starts]

    def anchors(self) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        return sliding_min(rolling(self.hashed, GROUP), WINDOW - GROUP + 1)[self.starts]


def distinct(h: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, with their smallest and largest id."""
    if len(h):  # neighbours often have the same anchor
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (ids[1:] != ids[:-1])])
        h, ids = h[new], ids[new]
    order = np.lexsort((ids, h))
    h, ids = h[order], ids[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[first], ids[first], ids[np.append(first[1:], len(h)) - 1] if len(h) else ids


def pack(*columns: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(b"".join(c.tobytes() for c in columns))


def unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = len(raw) // (8 * len(kinds))
    return [np.frombuffer(raw, k, n, 8 * n * i) for i, k in enumerate(kinds)]


SENT = "bucket bigint, part bigint, entries binary"
BACK = "part bigint, found binary"


def _sent(part: int, h: np.ndarray, ids: np.ndarray, buckets: int) -> pa.Table:
    """Distinct hashes of a part, packed for each bucket."""
    h, low, high = distinct(h, ids)
    bucket = (h % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    to, first = np.unique(bucket[order], return_index=True)
    blobs = [pack(h[o], low[o], high[o] - low[o]) for o in np.split(order, first[1:])] if len(to) else []
    return pa.table({"bucket": pa.array(to, pa.int64()), "part": pa.array([part] * len(to), pa.int64()), "entries": pa.array(blobs, pa.binary())})


def _answer(table: pa.Table, with_owner: bool) -> pa.Table:
    """For each part of a bucket the hashes that two ids or more have, with their smallest id if asked."""
    got = [unpack(b, np.uint64, np.int64, np.int64) for b in table["entries"].to_pylist()]
    h = np.concatenate([g[0] for g in got])
    low, high = np.concatenate([g[1] for g in got]), np.concatenate([g[1] + g[2] for g in got])
    order = np.argsort(h, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(h[order]) != 0]))
    group = np.empty(len(h), np.int64)
    group[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(h))))
    least, most = np.minimum.reduceat(low[order], first)[group], np.maximum.reduceat(high[order], first)[group]
    shared = (least < most) & ((high > least) | (not with_owner))
    parts, blobs, at = [], [], 0
    for part, g in zip(table["part"].to_pylist(), got):
        mine = np.flatnonzero(shared[at:at + len(g[0])]) + at
        at += len(g[0])
        if len(mine):
            parts.append(part)
            blobs.append(pack(h[mine], least[mine]) if with_owner else pack(h[mine]))
    return pa.table({"part": pa.array(parts, pa.int64()), "found": pa.array(blobs, pa.binary())})


def _found(table: pa.Table, *kinds) -> list[np.ndarray]:
    got = [unpack(b, *kinds) for b in table["found"].to_pylist()]
    if not got:
        return [np.zeros(0, k) for k in kinds]
    columns = [np.concatenate(c) for c in zip(*got)]
    order = np.argsort(columns[0], kind="stable")
    return [c[order] for c in columns]


def _looked_up(keys: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is among the sorted hashes, and where."""
    if not len(among):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return among[at] == keys, at


def passages(texts: Texts, h: np.ndarray, owner: np.ndarray):
    """(document, first word, words, owner): runs of windows with smaller owners; the owner is the largest of a run."""
    known, at = _looked_up(texts.windows(), h)
    hit = known.copy()
    hit[known] = owner[at[known]] < texts.ids[texts.doc[known]]
    s = texts.starts[hit]
    if not len(s):
        return []
    doc, own = texts.doc[hit], owner[at[hit]]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(s) != 1) | (np.diff(doc) != 0)]))
    last = np.append(new[1:], len(s)) - 1
    return list(zip(doc[new].tolist(), (s[new] - texts.begin[doc[new]]).tolist(), (s[last] - s[new] + WINDOW).tolist(), np.maximum.reduceat(own, new).tolist()))


def _stretches(texts: Texts, phrases) -> list[tuple[int, int, tuple[int, ...]]]:
    """(document, first word, word numbers): runs of `WINDOW` words or more that all stand in passages; no other run holds one."""
    known = np.zeros(len(texts.flat) + 1, bool)
    for key in phrases:
        known[list(key)] = True
    inside = known[texts.number]
    found = []
    for doc, (a, b) in enumerate(zip(texts.begin.tolist(), texts.begin[1:].tolist())):
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside[a:b], [False]]).view(np.int8)))
        first, last = edge[::2], edge[1::2]
        long = last - first >= WINDOW
        found += [(doc, x, tuple(texts.number[a + x:a + y].tolist())) for x, y in zip(first[long].tolist(), last[long].tolist())]
    return found


def remove(texts: Texts, h: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """For each document which words go, found by streaming all documents through the automata, but for words that no passage has."""
    import ahocorasick

    gone = [np.zeros(n + 1, np.int32) for n in np.diff(texts.begin).tolist()]
    ids = texts.ids.tolist()
    phrases: dict[tuple[int, ...], int] = {}
    for doc, at, n, own in passages(texts, h, owner):
        key = tuple(texts.number[texts.begin[doc] + at:texts.begin[doc] + at + n].tolist())
        phrases[key] = min(own, phrases.get(key, own))
    rows = _stretches(texts, phrases)
    shard, size = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE), 0
    left = len(phrases)
    for key, own in phrases.items():
        shard.add_word(key, (len(key), own))
        size, left = size + len(key), left - 1
        if size < SHARD_WORDS and left:
            continue
        shard.make_automaton()
        for doc, at, row in rows:
            edge, doc_id = gone[doc], ids[doc]
            for end, (n, own_of) in shard.iter(row):
                if own_of < doc_id:
                    edge[at + end + 1 - n] += 1
                    edge[at + end + 1] -= 1
        shard, size = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE), 0
    return [np.cumsum(e[:-1]) > 0 for e in gone]


RESULT = "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<first bigint, words bigint>>, kept binary"


def _results(texts: Texts, ids, h: np.ndarray, owner: np.ndarray):
    gone = remove(texts, h, owner)
    for at in range(0, len(gone), 500):
        part = range(at, min(at + 500, len(gone)))
        spans = []
        for i in part:
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[i].view(np.int8), [0]]))) if gone[i].any() else ()
            spans.append([{"first": int(a), "words": int(b - a)} for a, b in zip(edge[::2], edge[1::2])])
        stays = ~np.concatenate([gone[i] for i in part])
        first, last = texts.begin[part.start], texts.begin[part.stop]
        kept = texts.flat[first:last].filter(pa.array(stays))
        ends = np.concatenate([[0], np.cumsum(stays)])[texts.begin[part.start:part.stop + 1] - first]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), kept)
        yield pa.table({
            "doc_id": pa.array([ids[i] for i in part], pa.int64()), "n_words": pa.array(np.diff(texts.begin)[at:part.stop], pa.int64()),
            "n_removed": pa.array([int(gone[i].sum()) for i in part], pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))),
            "kept": pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).cast(pa.binary())})


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, spans (removed stretches of words) and kept (the other words, UTF-8) of every row."""
    parts = parts_for(docs, text, part_bytes)
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    # One shuffle of the texts serves all three passes.
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts))).repartition("part")

    def send_anchors(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            of = t["part"].to_numpy()
            for part in np.unique(of):
                mine = t.filter(pa.array(of == part))
                texts = Texts(mine["id"].to_pylist(), mine["text"])
                yield from _sent(int(part), texts.anchors(), texts.ids[texts.doc], parts).to_batches()

    def send_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"bucket": pa.array([], pa.int64()), "part": pa.array([], pa.int64()), "entries": pa.array([], pa.binary())})
        texts = Texts(left["id"].to_pylist(), left["text"])
        shared, _ = _looked_up(texts.anchors(), _found(right, np.uint64)[0])
        return _sent(left["part"][0].as_py(), texts.windows()[shared], texts.ids[texts.doc[shared]], parts)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left["id"].to_pylist()
        texts = Texts(ids, left["text"])
        done = list(_results(texts, ids, *_found(right, np.uint64, np.int64)))
        return pa.concat_tables(done) if done else pa.table({
            "doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()),
            "spans": pa.array([], pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))), "kept": pa.array([], pa.binary())})

    anchors = dealt.mapInArrow(send_anchors, SENT)
    shared = anchors.groupBy("bucket").applyInArrow(lambda t: _answer(t, False), BACK)
    windows = dealt.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(send_windows, SENT)
    owners = windows.groupBy("bucket").applyInArrow(lambda t: _answer(t, True), BACK)
    return dealt.groupBy("part").cogroup(owners.groupBy("part")).applyInArrow(finish, RESULT)
