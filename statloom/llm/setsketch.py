"""Near duplicates by SetSketch: exponentially spaced truncated minima, banded, estimated and verified.

1. A document's set are the distinct hashes of its five-word shingles. Every shingle starts a Poisson
   process of points that fall on the registers at random; a register keeps the smallest point, stored
   as floor(1 - log_b(point / a)), cut to 0..q + 1. Sketches of two sets merge by the larger register.
   Points come in ascending order, so a shingle stops as soon as it passes the largest register.
2. Equal sets are one node. Bands of registers deal nodes to buckets; buckets of equal members are one.
3. First round: in each bucket (split into blocks if large) a spanning tree of the likeliest pairs is
   verified on the full sets and gives components. Second round: all pairs of a bucket that lie in
   different components are estimated, those outside its largest component against all; the ones whose
   likelihood allows a link are verified. Verified links give the final components.

The similarity of a pair is estimated by maximum likelihood from how many registers are larger,
smaller and equal, given both set sizes; a pair is verified if the estimate is `MARGIN` below the
threshold or more. No pair inside a component is looked at again, so copies and near copies of one text
cost about one pair each. Whatever shares a band is compared: there is no cap on a bucket. A pair of
similarity 0.85 shares a band with probability above 0.9999.

Null and empty texts have an empty set, stay alone and are kept. A missing id stays alone too, with
component null, and is kept. Rows of the same id are one document. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import stage
from .common import map_batches
from .components import connected_components
from .phrases import _hashes, rolling

SHINGLE = 5
REGISTERS = 256
BANDS = 32
ROWS = REGISTERS // BANDS
BASE, RATE, TOP = 1.001, 20.0, 65535
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Below the threshold by this much (over three deviations of the estimate), a pair is still verified.
MARGIN = 0.075
#: Members of a bucket that are compared in one task at once.
BLOCK = 1000

WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
_KEPT_WORDS = 1_000_000


def shingle_sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts in order, and where each text's begin (one more at the end)."""
    if len(_hashes) > _KEPT_WORDS:
        _hashes.clear()
    rows = [WORD_BYTES.findall(t.encode("utf-8").lower()) if t else [] for t in texts]
    length = np.array([len(w) for w in rows], np.int64)
    begin = np.concatenate([[0], np.cumsum(length)])
    hashed = np.empty(begin[-1], np.uint64)
    for w, at in zip(rows, begin):
        hashed[at:at + len(w)] = np.fromiter(map(_hashes.__getitem__, w), np.uint64, len(w))
    doc = np.repeat(np.arange(len(rows)), length)
    n = max(0, len(hashed) - SHINGLE + 1)
    inside = np.flatnonzero(doc[:n] == doc[SHINGLE - 1:][:n])
    h, doc = rolling(hashed, SHINGLE)[inside], doc[inside]
    short = np.flatnonzero((length > 0) & (length < SHINGLE))
    if len(short):  # the whole sequence is the one shingle
        h = np.concatenate([h, [rolling(hashed[begin[i]:begin[i + 1]], length[i])[0] + np.uint64(length[i]) for i in short]]).astype(np.uint64)
        doc = np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    if len(h):
        new = np.concatenate([[True], (np.diff(doc) != 0) | (h[1:] != h[:-1])])
        h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(rows) + 1))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def sketches(h: np.ndarray, begin: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """Registers (sets, m) of sets given as in shingle_sets; zeros for an empty set."""
    sets = len(begin) - 1
    least = np.full(sets * m, np.inf)
    doc = np.repeat(np.arange(sets), np.diff(begin))
    point, step = np.zeros(len(h)), 0
    while len(h):
        step += 1
        r = _mix(h + np.uint64(step * 0x9E3779B97F4A7C15 % 2**64))
        point = point - np.log1p(-(r >> np.uint64(11)).astype(np.float64) * 2.0**-53) / m
        np.minimum.at(least, doc * m + (_mix(r) % np.uint64(m)).astype(np.int64), point)
        active = doc[np.flatnonzero(np.concatenate([[True], np.diff(doc) != 0]))]
        bound = np.zeros(sets)
        bound[active] = least.reshape(sets, m)[active].max(1)
        on = point < bound[doc]
        h, doc, point = h[on], doc[on], point[on]
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(least / RATE) / np.log(BASE))
    return np.clip(np.nan_to_num(k, neginf=0), 0, TOP).astype(np.uint16).reshape(sets, m)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def similarity(larger, smaller, equal, n_a, n_b) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from register counts (of a against b) and set sizes."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):  # the slope of the likelihood falls with the similarity
        j = (low + high) / 2
        rise = equal / np.maximum(j, 1e-12) - v * larger / np.maximum(u - v * j, 1e-12) - u * smaller / np.maximum(v - u * j, 1e-12)
        low, high = np.where(rise > 0, j, low), np.where(rise > 0, high, j)
    return (low + high) / 2


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A signed 64-bit key (sets, bands) of each band's registers, different between bands."""
    wide = np.ascontiguousarray(registers).view(np.uint64).reshape(len(registers), BANDS, -1)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for k in range(wide.shape[2]):
        key = _mix(key ^ wide[:, :, k]) + np.uint64(k)
    return key.view(np.int64)


SKETCH = "id bigint, n_shingles bigint, set_key binary, registers binary"


def _sketch_batch(batch: pa.RecordBatch):
    for at in range(0, batch.num_rows, 2000):
        part = batch.slice(at, 2000)
        h, begin = shingle_sets(part.column(1).to_pylist())
        n = np.diff(begin)
        reg = sketches(h, begin)
        alone = [not k or not i.is_valid for k, i in zip(n, part.column(0))]
        keys = [None if a else hashlib.blake2b(h[begin[i]:begin[i + 1]].tobytes(), digest_size=16).digest() for i, a in enumerate(alone)]
        regs = [None if a else reg[i].tobytes() for i, a in enumerate(alone)]
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(regs, pa.binary())],
            names=["id", "n_shingles", "set_key", "registers"])


def _bands_batch(batch: pa.RecordBatch):
    if batch.num_rows:
        reg = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, REGISTERS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column(0).to_numpy(), BANDS)), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(reg))),
             pa.array(band_keys(reg).ravel())], names=["id", "band", "key"])


def _sets_batch(batch: pa.RecordBatch):
    for at in range(0, batch.num_rows, 1000):
        part = batch.slice(at, 1000)
        h, begin = shingle_sets(part.column(1).to_pylist())
        sets = [h[a:b].tobytes() for a, b in zip(begin, begin[1:])]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["id", "items"])


def _verified_batch(batch: pa.RecordBatch):
    keep = []
    for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = len(np.intersect1d(x, y, assume_unique=True))
        keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
    part = batch.filter(pa.array(keep, pa.bool_()))
    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"])


def _estimated(q: dict, t: dict, band: int, other) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, target, similarity) of pairs that share no band before this one and may be links."""
    found = []
    for at in range(0, len(q["id"]), 32):
        rq = q["reg"][at:at + 32, None, :]
        equal = (rq == t["reg"][None]).sum(2)
        i, j = np.nonzero((equal >= REGISTERS * (PERCENT / 100 - 2 * MARGIN)) & other(slice(at, at + 32)))
        i += at
        if band and len(i):
            first = (q["reg"][i, :band * ROWS] == t["reg"][j, :band * ROWS]).reshape(len(i), band, ROWS).all(2).any(1)
            i, j = i[~first], j[~first]
        if len(i):
            more, less = (q["reg"][i] > t["reg"][j]).sum(1), (q["reg"][i] < t["reg"][j]).sum(1)
            s = similarity(more, less, REGISTERS - more - less, q["n"][i], t["n"][j])
            ok = s >= PERCENT / 100 - MARGIN
            found.append((i[ok], j[ok], s[ok]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*found))


def _columns(table: pa.Table) -> dict:
    return {
        "id": table["id"].to_numpy(), "n": table["n"].to_numpy().astype(float), "comp": table["comp"].to_numpy(),
        "query": table["query"].to_numpy(zero_copy_only=False).astype(bool),
        "reg": np.frombuffer(b"".join(table["registers"].to_pylist()), np.uint16).reshape(-1, REGISTERS)}


def _grouped(pairs_of):
    """A function of one slot's table from a function of one group's members and band."""

    def run(table: pa.Table) -> pa.Table:
        order = table.sort_by([("key", "ascending"), ("block", "ascending")])
        key, block = order["key"].to_numpy(), order["block"].to_numpy()
        band = order["band"].to_numpy()
        cut = np.flatnonzero(np.concatenate([[True], (np.diff(key) != 0) | (np.diff(block) != 0), [True]])) if len(key) else [0]
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lo, hi in zip(cut, cut[1:]):
            if hi - lo > 1:
                x, y = pairs_of(_columns(order.slice(lo, hi - lo)), int(band[lo]))
                a.append(np.minimum(x, y))
                b.append(np.maximum(x, y))
        both = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
        return pa.table({"a": pa.array(both[:, 0], pa.int64()), "b": pa.array(both[:, 1], pa.int64())})

    return run


def _tree(x: dict, band: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the likeliest pairs of a group: each pair joins two of its trees."""
    index = np.arange(len(x["id"]))
    i, j, s = _estimated(x, x, band, lambda at: index[at, None] < index[None])
    root = list(range(len(index)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    kept = []
    for k in np.argsort(-s, kind="stable").tolist():
        a, b = find(int(i[k])), find(int(j[k]))
        if a != b:
            root[a] = b
            kept.append(k)
    return x["id"][i[kept]], x["id"][j[kept]]


def _across(x: dict, band: int) -> tuple[np.ndarray, np.ndarray]:
    """All possible links between queries and members of other components."""
    q = {k: v[x["query"]] for k, v in x.items()}
    t = {k: v[~x["query"]] for k, v in x.items()}
    i, j, _ = _estimated(q, t, band, lambda at: q["comp"][at, None] != t["comp"][None])
    return q["id"][i], t["id"][j]


PAIR = "a bigint, b bigint"


def _slots(rows: DataFrame, count: int) -> DataFrame:
    return rows.withColumn("slot", F.pmod(F.xxhash64("key", "block"), F.lit(count)))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) and kept, for every row."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    sketch = stage(map_batches(rows, _sketch_batch, SKETCH), "sketch")
    nodes = sketch.where("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min("id").alias("node"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers"))
    nodes = stage(nodes, "nodes")
    banded = map_batches(nodes.select("node", "registers"), _bands_batch, "id bigint, band int, key bigint")
    buckets = banded.groupBy("band", "key").agg(
        F.count("id").alias("c"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("s"), F.min("id").alias("m")).where("c > 1")
    # Buckets of the same members count once, as that of the first band.
    unique = buckets.groupBy("c", "s", "m").agg(F.min(F.struct("band", "key")).alias("x")).select("x.band", "x.key", "c", "m")
    members = banded.join(unique, ["band", "key"])
    members = stage(
        members.join(nodes.select(F.col("node").alias("id"), "n", "registers"), "id"), "members")
    slots = max(1, -(-members.count() // 20_000))
    # Full sets of the nodes that are in any bucket.
    needed = rows.join(members.select("id").distinct(), "id", "left_semi")
    sets = stage(map_batches(needed, _sets_batch, "id bigint, items binary").dropDuplicates(["id"]), "sets")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        own = pairs.distinct().join(sets.select(F.col("id").alias("a"), F.col("items").alias("x")), "a")
        full = own.join(sets.select(F.col("id").alias("b"), F.col("items").alias("y")), "b").select("a", "b", "x", "y")
        return stage(map_batches(full, _verified_batch, PAIR), name)

    blocks = F.ceil(F.col("c") / BLOCK).cast("int")
    own_block = F.pmod(F.xxhash64("id"), blocks).cast("int")
    # Every block of a bucket also has the bucket's smallest member.
    in_blocks = members.withColumn("block", F.explode(F.when(F.col("id") == F.col("m"), F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(own_block))))
    first = in_blocks.select("key", "band", "block", "id", "n", "registers", F.col("id").alias("comp"), F.lit(True).alias("query"))
    links = verified(_slots(first, slots).groupBy("slot").applyInArrow(_grouped(_tree), PAIR), "links")
    comps = stage(connected_components(links), "comps")

    of = members.join(comps, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")
    sizes = of.groupBy("band", "key", "comp").agg(F.count("id").alias("k"))
    largest = sizes.groupBy("band", "key").agg(F.max(F.struct("k", "comp")).alias("x"), F.sum("k").alias("all")).where("x.k < all")
    split = of.join(largest.select("band", "key", F.col("x.comp").alias("main"), (F.col("all") - F.col("x.k")).alias("u")), ["band", "key"])
    outer = F.ceil(F.col("u") / BLOCK).cast("int")
    own_outer = F.pmod(F.xxhash64("id", F.lit(1)), outer).cast("int")
    base = ["key", "band", "id", "n", "registers", "comp"]
    queries = split.where("comp <> main").withColumn("j", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        *base, (own_outer * blocks + F.col("j")).alias("block"), F.lit(True).alias("query"))
    targets = split.withColumn("i", F.explode(F.sequence(F.lit(0), outer - 1))).select(
        *base, (F.col("i") * blocks + own_block).alias("block"), F.lit(False).alias("query"))
    across = _slots(queries.unionByName(targets), slots).groupBy("slot").applyInArrow(_grouped(_across), PAIR)
    more = verified(across, "links")
    if not more.isEmpty():
        comps = stage(connected_components(links.unionByName(more)), "comps")
    named = nodes.select("set_key", "node").join(comps.select(F.col("id").alias("node"), "component"), "node", "left").select(
        "set_key", F.coalesce("component", "node").alias("component"))
    out = sketch.join(named, "set_key", "left").select(
        F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents that are the first of their component, with all their columns; rows without an id stay."""
    gone = near_duplicates(docs, text, key).where("NOT kept").select(F.col("doc_id").alias(key)).distinct()
    return docs.join(gone, key, "left_anti").select(*docs.columns)
