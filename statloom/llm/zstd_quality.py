"""Quality score by compression with two zstandard dictionaries.

One dictionary is built from text labelled good, one from text labelled bad. A document is cut into
pieces of `PIECE` bytes, each is compressed with both, and the score comes from
(bytes with the bad dictionary - bytes with the good one) / bytes of the text, over the whole text,
by a logistic curve fitted to labelled texts that neither dictionary has seen. The texts of fitting
are a bounded sample: `PER_LABEL` of each label, and of a long text `TEXT_CHARS` characters from all over it.

Null and empty texts have the difference 0 and so the score of the curve at 0. Without good or
without bad labelled texts, the score is the share of good labels, one added to either count. Rows are treated
one by one, repeated rows alike; other columns are not looked at.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches

PIECE = 1024
DICTIONARY_BYTES = 112_640
LEVEL = 3
#: Labelled texts of each label that are fitted on, at most.
PER_LABEL = 6_000
TEXT_CHARS = 8_000

_compressors: dict[bytes, object] = {}


def pieces(text: bytes) -> list[bytes]:
    return [text[i:i + PIECE] for i in range(0, len(text), PIECE)]


def compressor(dictionary: bytes):
    """This worker's compressor for a dictionary, prepared once."""
    import zstandard

    if dictionary not in _compressors:
        if len(_compressors) >= 8:
            _compressors.clear()
        prepared = zstandard.ZstdCompressionDict(dictionary)
        prepared.precompute_compress(level=LEVEL)
        _compressors[dictionary] = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=prepared, write_content_size=False, write_checksum=False, write_dict_id=False)
    return _compressors[dictionary]


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    slope: float
    offset: float

    def difference(self, text: bytes) -> float:
        """Bytes that the good dictionary saves against the bad one, for each byte of the text."""
        if not text or not self.good:
            return 0.0
        good, bad = compressor(self.good).compress, compressor(self.bad).compress
        return sum(len(bad(p)) - len(good(p)) for p in pieces(text)) / len(text)

    def score(self, text: bytes) -> float:
        x = self.slope * self.difference(text) + self.offset
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))


def logistic(x, y, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of P(y = 1), by Newton's method with a small ridge on the slope."""
    import numpy as np

    scale = float(np.std(x)) or 1.0
    a = np.stack([np.asarray(x) / scale, np.ones(len(x))], 1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + np.array([1e-2, 1e-6]) * w
        h = (a * (p * (1 - p))[:, None]).T @ a + np.diag([1e-2, 1e-6])
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]) / scale, float(w[1])


def fit(sample: DataFrame) -> CompressionModel:
    """The model of a bounded sample with columns y (0 or 1) and x (text)."""
    import zstandard

    rows = [(r.y, r.x.encode("utf-8")) for r in sample.collect()]
    good = sum(y for y, _ in rows)
    seen: dict[int, list[bytes]] = {0: [], 1: []}
    unseen = []
    for y, x in rows:
        if zlib.crc32(x) % 3:
            seen[y] += pieces(x)
        else:
            unseen.append((y, x))
    prior = math.log((good + 1) / (len(rows) - good + 1))
    try:
        made = [zstandard.train_dictionary(DICTIONARY_BYTES, seen[y]).as_bytes() for y in (1, 0)]
    except zstandard.ZstdError:  # too few samples for a trained one: the texts themselves serve
        made = [b"".join(seen[y])[-DICTIONARY_BYTES:] for y in (1, 0)]
    if not all(len(m) >= 8 for m in made) or len({y for y, _ in unseen}) < 2:
        return CompressionModel(b"", b"", 0.0, prior)
    model = CompressionModel(*made, 0.0, 0.0)
    slope, offset = logistic([model.difference(x) for _, x in unseen], [y for y, _ in unseen])
    return CompressionModel(*made, slope, offset)


def score_quality(docs: DataFrame, model: CompressionModel, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, score (0 to 1, higher is better) for every row, from its whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of a fixed size

    def run(batch: pa.RecordBatch):
        own = sent.value
        score = [own.score((x.as_py() or "").encode("utf-8")) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], names=[key, "score"])

    kind = docs.select(key).schema[0].dataType.simpleString()
    return map_batches(docs.select(key, text), run, f"{key} {kind}, score double")
