"""What models are fitted on: texts from all over, every language, no copies."""

import random

import numpy as np
from pyspark.sql import functions as F

from statloom.llm import langid, zstd_quality
from statloom.llm.common import labelled_sample, spread


def test_spread_reaches_the_end(spark):
    text = "".join(chr(0x4E00 + k) for k in range(20_000))
    df = spark.createDataFrame([(text,), ("short",), ("",)], "x string")
    got = [r.s for r in df.select(spread(F.col("x"), 8000).alias("s")).collect()]
    assert len(got[0]) == 8000 and got[0][0] == text[0] and got[0][-1] == text[-1] and got[1:] == ["short", ""]
    assert max(b - a for a, b in zip(map(ord, got[0]), map(ord, got[0][1:]))) < 2000


def test_quality_is_learned_from_behind_the_first_characters(spark):
    """All texts begin alike for 8,000 characters; only what follows tells good from bad."""
    rng = random.Random(5)
    head = "neutral words at the start of every text, " * 200
    tails = {1: ["measured", "careful", "prose", "about", "rivers"], 0: ["buy", "now", "cheap", "click", "winner"]}
    rows = [(i, i % 2, head[:8200] + " ".join(rng.choice(tails[i % 2]) for _ in range(4000))) for i in range(120)]
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id int, text string")
    labels = spark.createDataFrame([(i, y) for i, y, _ in rows], "doc_id int, quality int")
    model = zstd_quality.fit(labelled_sample(docs, labels, "quality", 100, chars=zstd_quality.TEXT_CHARS))
    good, bad = (" ".join(rng.choice(tails[y]) for _ in range(500)).encode() for y in (1, 0))
    assert model.score(good) > 0.5 > model.score(bad)


def test_three_hundred_languages(spark):
    """Each language has letters of its own; the rarest are learned like the others."""
    rng = random.Random(6)

    def text(k):
        a, b = chr(0x4E00 + 2 * k), chr(0x4E01 + 2 * k)
        return "".join(rng.choice([a, b, a + b, " "]) for _ in range(200))

    rows = [(i, f"l{k:03d}", text(k)) for i, k in enumerate(k for k in range(300) for _ in range(4 if k < 200 else 2))]
    docs = spark.createDataFrame(rows, "doc_id int, lang string, text string")
    model = langid.train(docs, steps=250)  # few, for a quick test
    assert len(model.labels) == 300 and model.hidden > langid.HIDDEN
    fresh = [(k, text(k)) for k in range(0, 300, 3)]
    p = model.predict([t.encode() for _, t in fresh])
    right = [model.labels[i] == f"l{k:03d}" for (k, _), i in zip(fresh, p.argmax(1))]
    assert np.mean(right) > 0.1 and np.mean(right[67:]) > 0.1  # by chance one in 300


def test_copies_do_not_fill_the_sample(spark):
    rows = [(i, "xx", "one copied text, again and again") for i in range(400)] + [(1000 + i, "xx", f"text number {i} of many") for i in range(100)]
    rows += [(2000 + i, "yy", f"{i} другой язык {i}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id int, lang string, text string")
    seen = {}
    fit = langid.ByteGru.fit
    try:
        langid.ByteGru.fit = lambda self, x, y, steps: seen.update(x=x, y=y) or self
        langid.train(docs, per_language=50)
    finally:
        langid.ByteGru.fit = fit
    assert (seen["y"] == 0).sum() == 50 and len({bytes(w) for w in seen["x"][seen["y"] == 0]}) == 50


def test_training_windows_cover_the_end():
    text = bytes(range(65, 91)) * 6
    w = langid.training_windows(text)
    assert bytes(w[-1]) == text[-64:] and bytes(w[0]) == text[:64] and len(w) == 3
    assert len(langid.training_windows(b"short")) == 1
