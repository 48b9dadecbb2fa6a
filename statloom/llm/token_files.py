"""Token-id files: documents as ids, compressed by the mixing range coder, in files that can be read anywhere.

Documents are dealt to files by ranges of their key, so files in the order of their numbers, and documents in the order
of a file, are in ascending order of the key (missing keys first, then by hash and text where keys are equal).

A file is a header, segments and an end. A segment holds whole documents: a table of keys and lengths with a
checksum, then the codes of its blocks (`mixcoder`), each from a fresh model and with the checksum of its ids. All numbers are little-endian.

    header   "TOKMIX1\\n", vocabulary u32, id that ends a document u32
    segment  "SEGM", bytes of the table u32, crc32 of the table u32, table, codes
    table    documents u64, ids u64, blocks u32; keys i64 each; missing keys, a bit each; lengths i64 each;
             bytes of codes u32 each; crc32 of each block's ids u32 each
    end      "DONE", documents u64, ids u64

Tasks write files under names of their own. The manifest, a table with one row for each file of a task that
ended well, says which files count, so lost executors and repeated tasks leave none behind that is read.

Null and empty texts are documents of the end id alone. Rows that share a key are documents of their own, repeated rows too.
Other columns are not looked at. Texts of any length are whole; a task holds one segment and its longest document. A table
without rows has no files. Keys are whole numbers.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.workspace import fresh_dir
from .common import parts_for
from .mixcoder import BLOCK_IDS, LANES, block_lengths, blocks_for, decode_blocks, encode_blocks

MAGIC, SEGMENT, END = b"TOKMIX1\n", b"SEGM", b"DONE"
#: A segment is closed behind the document that fills it.
SEGMENT_IDS = BLOCK_IDS * LANES
#: Text of one file, about a segment's.
FILE_BYTES = 20 << 20
#: Rows whose texts are encoded, or whose ids are returned, at once.
ROWS = 500
#: Characters of the chunks a worker remembers; a full store is emptied. Changes no result.
CACHE_CHARS = 12_000_000
MAX_READERS = 20_000

#: A blank that a new piece does not begin with for certain.
NOT_ALONE = re.compile(r" (?:\s|\Z)")
NEXT_CHUNK = re.compile(r"(?= \S)")

_encoders: dict[tuple[str, int], ChunkEncoder] = {}

MANIFEST = "shard int, file string, n_docs long, n_ids long, n_bytes long"


class Remembered(dict):
    """Chunk to its number; a new one is noted to be encoded."""

    def __init__(self, owner: ChunkEncoder, before: str):
        self.owner, self.before = owner, before

    def __missing__(self, chunk: str) -> int:
        own = self.owner
        number = self[chunk] = own.n_chunks
        own.n_chunks += 1
        own.chars += len(chunk) + 20
        own.pending.append(self.before + chunk)
        return number


class ChunkEncoder:
    """Encodes texts with the tokenizers library, each distinct chunk of them once.

    With a byte-level pre-tokenizer a piece begins at every blank that a non-blank follows. So texts are cut there, and the
    ids of the chunks in a row are those of the text. With any other tokenizer a text is one chunk.
    """

    def __init__(self, spec: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True  # their names in a text are text
        self.end_id = end_id
        self.cut = cuts_at_blanks(json.loads(spec))
        self.forget()

    def forget(self) -> None:
        """Start anew; chunk 0 is the id that ends a document."""
        self.first, self.others = Remembered(self, ""), Remembered(self, " ")
        self.pending: list[str] = []
        self.n_chunks, self.chars = 1, 0
        self.ids = np.array([self.end_id], np.uint32)
        self.starts, self.lengths = np.array([0]), np.array([1])

    def numbers(self, text: str) -> list[int]:
        if not text:
            return [0]
        if not self.cut:
            return [self.first[text], 0]
        if NOT_ALONE.search(text) is None:
            first, *rest = text.split(" ")
        else:
            first, *rest = NEXT_CHUNK.split(text)
            rest = [x[1:] for x in rest]
        found = [self.first[first]] if first else []
        found.extend(map(self.others.__getitem__, rest))
        found.append(0)
        return found

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the number of each text's, both with the ends."""
        if self.chars > CACHE_CHARS:
            self.forget()
        chunks: list[int] = []
        ends = []
        for text in texts:
            chunks += self.numbers(text)
            ends.append(len(chunks))
        if self.pending:
            new = [x.ids for x in self.tokenizer.encode_batch_fast(self.pending, add_special_tokens=False)]
            self.pending.clear()
            lengths = np.fromiter(map(len, new), np.int64, len(new))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(new), np.uint32, int(lengths.sum()))])
        at = np.asarray(chunks, np.int64)
        lengths = self.lengths[at]
        upto = np.cumsum(lengths)
        place = np.repeat(self.starts[at] - upto + lengths, lengths)
        place += np.arange(len(place))
        done = upto[np.asarray(ends, np.int64) - 1] if ends else np.empty(0, np.int64)
        return self.ids[place], np.diff(done, prepend=0)


def encoder_of(spec: str, end_id: int) -> ChunkEncoder:
    """The encoder of this worker, built once."""
    if (spec, end_id) not in _encoders:
        _encoders.clear()
        _encoders[spec, end_id] = ChunkEncoder(spec, end_id)
    return _encoders[spec, end_id]


def cuts_at_blanks(spec: dict) -> bool:
    """Whether a piece of this tokenizer begins at every blank that a non-blank follows."""
    before = spec.get("pre_tokenizer") or {}
    return (
        spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
        and not before.get("add_prefix_space", True) and not any(" " in t["content"] for t in spec.get("added_tokens", [])))


def filesystem(path: str):
    """The file system of a path and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def write_segment(out, keys: list, lengths: np.ndarray, ids: np.ndarray, vocabulary: int) -> None:
    n_blocks = blocks_for(len(ids))
    codes = encode_blocks(ids, n_blocks, vocabulary)
    ends = np.cumsum(block_lengths(len(ids), n_blocks))
    sums = [zlib.crc32(x.astype("<u4").tobytes()) for x in np.split(ids, ends[:-1])]
    missing = np.array([k is None for k in keys], bool)
    table = b"".join((
        struct.pack("<QQI", len(keys), len(ids), n_blocks),
        np.array([0 if k is None else k for k in keys], "<i8").tobytes(), np.packbits(missing).tobytes(),
        lengths.astype("<i8").tobytes(), np.array([len(c) for c in codes], "<u4").tobytes(), np.array(sums, "<u4").tobytes()))
    out.write(SEGMENT + struct.pack("<II", len(table), zlib.crc32(table)) + table)
    for code in codes:
        out.write(code)


def read_segments(source) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(keys, lengths, ids) of each segment of an open file; raises ValueError on damage."""

    def take(n: int) -> bytes:
        data = source.read(n)
        if len(data) != n:
            raise ValueError("the file ends too early")
        return data

    if take(len(MAGIC)) != MAGIC:
        raise ValueError("not a token file")
    vocabulary, _ = struct.unpack("<II", take(8))
    docs = total = 0
    while (kind := take(4)) == SEGMENT:
        size, crc = struct.unpack("<II", take(8))
        table = take(size)
        if zlib.crc32(table) != crc:
            raise ValueError("a segment's table is damaged")
        n_docs, n_ids, n_blocks = struct.unpack_from("<QQI", table)
        at = 20
        keys = np.frombuffer(table, "<i8", n_docs, at)
        at += 8 * n_docs
        bits = -(-n_docs // 8)
        missing = np.unpackbits(np.frombuffer(table, np.uint8, bits, at), count=n_docs).astype(bool)
        at += bits
        lengths = np.frombuffer(table, "<i8", n_docs, at)
        sizes = np.frombuffer(table, "<u4", n_blocks, at + 8 * n_docs)
        sums = np.frombuffer(table, "<u4", n_blocks, at + 8 * n_docs + 4 * n_blocks)
        ids = decode_blocks([take(int(s)) for s in sizes], n_ids, vocabulary)
        ends = np.cumsum(block_lengths(n_ids, n_blocks))
        for k, (part, crc) in enumerate(zip(np.split(ids, ends[:-1]), sums)):
            if zlib.crc32(part.astype("<u4").tobytes()) != crc:
                raise ValueError(f"block {k} of a segment is damaged")
        docs, total = docs + n_docs, total + n_ids
        yield [None if m else int(k) for k, m in zip(keys, missing)], lengths, ids
    if kind != END or struct.unpack("<QQ", take(16)) != (docs, total):
        raise ValueError("the file's end does not agree with its segments")


def write_token_files(docs: DataFrame, spec_path: str, end_id: int, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode every whole text, write the files below `path` and return their manifest (also written there)."""
    spark = docs.sparkSession
    with open(spec_path, encoding="utf-8") as f:
        spec = f.read()
    # The rest of the job needs one vocabulary, so this has the size of one.
    shared = spark.sparkContext.broadcast(spec)
    known = json.loads(spec)
    ids = [*known["model"]["vocab"].values(), *(t["id"] for t in known.get("added_tokens", [])), end_id]
    vocabulary, folder = max(ids) + 1, f"{path.rstrip('/')}/files"
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    rows = rows.repartitionByRange(parts_for(docs, text, FILE_BYTES), "key", "hash").sortWithinPartitions("key", "hash", "text")

    def write(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        encoder, out = None, None
        keys: list = []
        parts, lengths, held, docs_done, ids_done = [], [], 0, 0, 0

        def flush():
            nonlocal keys, parts, lengths, held, docs_done, ids_done
            write_segment(out, keys, np.concatenate(lengths), np.concatenate(parts), vocabulary)
            docs_done, ids_done = docs_done + len(keys), ids_done + held
            keys, parts, lengths, held = [], [], [], 0

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                if out is None:
                    shard = TaskContext.get().partitionId()
                    system, base = filesystem(folder)
                    system.create_dir(base)
                    name = f"{shard:07d}-{uuid.uuid4().hex}.tokens"
                    out = system.open_output_stream(f"{base}/{name}")
                    out.write(MAGIC + struct.pack("<II", vocabulary, end_id))
                    encoder = encoder_of(shared.value, end_id)
                part = batch.slice(at, ROWS)
                ids, sizes = encoder.encode(part.column(1).to_pylist())
                keys += part.column(0).to_pylist()
                parts.append(ids)
                lengths.append(sizes)
                held += len(ids)
                if held >= SEGMENT_IDS:
                    flush()
        if out is not None:
            if keys:
                flush()
            out.write(END + struct.pack("<QQ", docs_done, ids_done))
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_pylist(
                [{"shard": shard, "file": name, "n_docs": docs_done, "n_ids": ids_done, "n_bytes": size}],
                pa.schema([("shard", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())]))

    rows.select("key", "text").mapInArrow(write, MANIFEST).write.parquet(f"{path.rstrip('/')}/manifest")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/manifest")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """key, start, n_tokens, ids (little-endian unsigned 32-bit) of every document in the files of the manifest.

    `start` is the number of ids of all documents before it.
    """
    manifest = read_manifest(spark, path)
    folder = f"{path.rstrip('/')}/files"
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.select("file", before.alias("start"))  # one row for each file
    spread = files.repartition(max(1, min(MAX_READERS, manifest.count())))
    schema = "key long, start long, n_tokens long, ids binary"

    def read(batches):
        arrow = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, base = filesystem(folder)
                with system.open_input_stream(f"{base}/{name}") as source:
                    for keys, lengths, ids in read_segments(source):
                        ends = np.cumsum(lengths)
                        data = ids.astype("<u4").tobytes()
                        for at in range(0, len(keys), ROWS):
                            some = slice(at, at + ROWS)
                            first = ends[some] - lengths[some]
                            own = [data[4 * a:4 * b] for a, b in zip(first.tolist(), ends[some].tolist())]
                            yield pa.RecordBatch.from_arrays([
                                pa.array(keys[some], pa.int64()), pa.array(start + first, pa.int64()),
                                pa.array(lengths[some], pa.int64()), pa.array(own, pa.binary())], schema=arrow)
                        start += len(ids)

    return spread.mapInArrow(read, schema)


def through_files(docs: DataFrame, spec_path: str, end_id: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Documents as they come back from files written for them in the shared folder (`read_token_files`)."""
    path = fresh_dir(docs.sparkSession, "token-files")
    write_token_files(docs, spec_path, end_id, path, text, key)
    return read_token_files(docs.sparkSession, path)
