"""Small helpers that several operators share."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: words of the contracts are runs of other characters than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)

PART_BYTES = 16 << 20


def crc_mod(key: str | Column, k: int) -> Column:
    """crc32 of the key as text, modulo k; a missing key counts as the empty text."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")) % F.lit(k)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with a function of one record batch."""

    def run(batches):
        for b in batches:
            yield from fn(b)

    return df.mapInArrow(run, schema)


def parts_for(df: DataFrame, text: str, part_bytes: int = PART_BYTES) -> int:
    """How many parts of about `part_bytes` the texts make, from one pass over their lengths."""
    total = df.select(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, math.ceil(total / part_bytes))


def spread(text: Column, chars: int, parts: int = 8) -> Column:
    """A text of at most `chars` characters whole; of a longer one `parts` stretches, `chars` in all, spread from its start to its end."""
    piece = chars // parts
    free = F.length(text) - piece
    starts = [(F.floor(free * F.lit(i) / F.lit(parts - 1)) + 1).cast("int") for i in range(parts)]
    return F.when(F.length(text) <= chars, text).otherwise(F.concat(*[F.substring(text, at, F.lit(piece)) for at in starts]))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_value: int, usable: Column | None = None,
                    text: str = "text", key: str = "doc_id", chars: int | None = None) -> DataFrame:
    """(y, x): at most `per_value` labelled texts of each label 0 and 1; with `chars`, that much of each, from all over it.

    Labelled rows are taken by the smallest hash of their key, so the choice does not depend on
    their order; the bound does not depend on the table. Only this bounded list is broadcast.
    """
    rows = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where("k IS NOT NULL")
    if usable is not None:
        rows = rows.where(usable)
    picked = None
    for y in (0, 1):
        top = rows.where(F.col("y") == y).distinct().orderBy(F.xxhash64("k"), "k").limit(per_value)
        picked = top if picked is None else picked.unionByName(top)
    own = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.col(key).alias("k"), (own if chars is None else spread(own, chars)).alias("x"))
    return texts.join(F.broadcast(picked), "k").orderBy(F.xxhash64("k"), "k", "x").limit(4 * per_value).select("y", "x")
