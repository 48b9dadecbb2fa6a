"""Byte-level BPE: exact merges by longest matches and backtracking, and decoding.

Each match of the pattern is encoded alone. Its bytes are read as Latin-1 text, so that an
Aho-Corasick automaton over the vocabulary lists the tokens at each place. The encoder takes the
longest from left to right and goes back to the next shorter one when a pair of neighbours could not
stand side by side in a merged text. Whether two tokens can is decided from the merges that made
them, and remembered. A place that leads nowhere is closed for good, so the time is linear.

Null and empty texts give no ids. A text whose bytes are no valid UTF-8 cannot reach this operator:
Spark strings arrive as Unicode. Rows are treated one by one, so repeated rows and ids give repeated
rows, and other columns are not looked at.
"""

from __future__ import annotations

import base64
import struct

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches

#: Pieces and pairs that a task remembers at most, of each so many; a full store is emptied before the next text, and all
#: of it when the task ends: a worker outlives its tasks, and waits beside others. Changes no result.
CACHE_PIECES = 500_000
#: Rows of one returned batch, so that ids and texts of few rows are held at once.
ROWS_OUT = 500

_codecs: dict[tuple[bytes, str], BytePairCodec] = {}


class Pieces(dict):
    """Packed ids of pieces; a missing one is encoded, and remembered unless it is long."""

    def __init__(self, encode_piece):
        self.encode_piece = encode_piece

    def __missing__(self, piece: str) -> bytes:
        found = packed(self.encode_piece(piece.encode("utf-8")))
        if len(piece) <= 64:
            self[piece] = found
        return found


class BytePairCodec:
    """Encoder and decoder of one vocabulary of ranks."""

    def __init__(self, rank_file: bytes, pattern: str):
        import ahocorasick
        import regex

        self.ranks: dict[bytes, int] = {}
        for line in rank_file.splitlines():
            if line.strip():
                token, rank = line.split()
                self.ranks[base64.b64decode(token)] = int(rank)
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.length = {r: len(t) for t, r in self.ranks.items()}
        self.find_pieces = regex.compile(pattern).findall
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.fits: dict[int, bool] = {}  # by left << 32 | right
        self.shorter: dict[int, int | None] = {}
        self.pieces = Pieces(self.encode_piece)

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge is this one; itself twice for a byte; None if no merge makes it."""
        if token in self.halves:
            return self.halves[token]
        whole = self.bytes_of[token]
        parts = [whole[i:i + 1] for i in range(len(whole))]
        while len(parts) > 2:
            ranked = [(self.ranks.get(a + b, token), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, i = min(ranked)
            if rank >= token:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        made = None
        if len(parts) == 1:
            made = (token, token)
        elif len(parts) == 2:
            made = (self.ranks[parts[0]], self.ranks[parts[1]])
        self.halves[token] = made
        return made

    def adjacent(self, left: int, right: int) -> bool:
        """Whether the merges of both tokens' bytes end in exactly these two tokens; remembered."""
        a, b, limit, fits = left, right, len(self.ranks) + 1, None
        if self.split(right) is None:
            fits = False
        while fits is None:
            joined = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
            if joined is not None and joined < limit:
                fits = False  # a merge across the border comes before the last one undone
                break
            # Undo the later merge of the two tokens at the border; of equal ones the right was later.
            for side in ("left", "right") if a > b else ("right", "left"):
                if side == "left" and self.length[a] > 1:
                    limit, a = a, self.split(a)[1]
                    break
                if side == "right" and self.length[b] > 1:
                    limit, b = b + 1, self.split(b)[0]
                    break
            else:
                fits = True
        if len(self.fits) > CACHE_PIECES:
            self.fits.clear()
        self.fits[left << 32 | right] = fits
        return fits

    def prefix_of(self, token: int) -> int | None:
        """The longest token that is a proper beginning of this one; remembered."""
        if token not in self.shorter:
            whole = self.bytes_of[token]
            found = (self.ranks.get(whole[:k]) for k in range(len(whole) - 1, 0, -1))
            self.shorter[token] = next((r for r in found if r is not None), None)
        return self.shorter[token]

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        n, length, fits, longest = len(piece), self.length, self.fits, self.automaton.iter_long
        text = piece.decode("latin-1")
        is_open = bytearray(b"\1") * (n + 1)
        tokens: list[int] = []
        at, ahead = 0, longest(text)  # yields longest tokens in turn, as long as each is taken
        token = next(ahead)[1]
        while True:
            end = at + length[token]
            if is_open[end]:
                if at == 0:
                    ok = self.split(token) is not None
                else:
                    ok = fits.get(tokens[-1] << 32 | token)
                    if ok is None:
                        ok = self.adjacent(tokens[-1], token)
                if ok:
                    tokens.append(token)
                    if end == n:
                        return tuple(tokens)
                    at = end
                    if ahead is None:
                        ahead = longest(text, at)
                    token = next(ahead)[1]
                    continue
            ahead = None
            token = self.prefix_of(token)
            while token is None:
                is_open[at] = 0
                last = tokens.pop()
                at -= length[last]
                token = self.prefix_of(last)

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text; none for a missing one."""
        ids = self.encode_packed(text)
        return list(struct.unpack(f"<{len(ids) // 4}I", ids))

    def encode_packed(self, text: str | None) -> bytes:
        """The same as little-endian unsigned 32-bit integers."""
        if len(self.pieces) > CACHE_PIECES:
            self.pieces.clear()
        return b"".join(map(self.pieces.__getitem__, self.find_pieces(text or "")))

    def forget(self) -> None:
        """Empty what was remembered of texts."""
        self.pieces.clear()
        self.fits.clear()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def codec(rank_file: bytes, pattern: str) -> BytePairCodec:
    """The codec of this worker, built once."""
    if (rank_file, pattern) not in _codecs:
        _codecs.clear()
        _codecs[rank_file, pattern] = BytePairCodec(rank_file, pattern)
    return _codecs[rank_file, pattern]


def packed(ids: tuple[int, ...]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def encoded(own: BytePairCodec, batches, key: str):
    """(key, ids) of all batches of a task; nothing of its texts is kept after it."""
    try:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                ids = [own.encode_packed(x.as_py()) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=[key, "ids"])
    finally:
        own.forget()


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, ids (binary, little-endian unsigned 32-bit) for every row.

    The rank file is read by the driver and broadcast; its size is that of one vocabulary.
    """
    with open(rank_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        return encoded(codec(ranks.value, pattern), batches, key)

    kind = docs.select(key).schema[0].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"{key} {kind}, ids binary")


def decode_documents(tokens: DataFrame, rank_path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """key, ids, decoded (binary): the bytes that the ids stand for."""
    import numpy as np

    with open(rank_path, "rb") as f:
        ranks = tokens.sparkSession.sparkContext.broadcast(f.read())

    def run(batch: pa.RecordBatch):
        own = codec(ranks.value, pattern)
        for at in range(0, batch.num_rows, ROWS_OUT):
            part = batch.slice(at, ROWS_OUT)
            texts = [own.decode(np.frombuffer(x.as_py() or b"", "<u4").tolist()) for x in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.binary())], names=[key, "ids", "decoded"])

    kind = tokens.select(key).schema[0].dataType.simpleString()
    return map_batches(tokens.select(key, "ids"), run, f"{key} {kind}, ids binary, decoded binary")
