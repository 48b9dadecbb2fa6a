"""Token files, collocations and spelling variants against brute force and round trips, and their edge cases."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.llm import collocations, mixcoder, queries, spelling, token_files
from statloom.sources.workspace import fresh_dir

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]


@pytest.fixture(scope="module")
def edge(spark):
    """Null, empty, blank, one-word, very long, repeated and null-id rows, with columns that clash."""
    rng = random.Random(5)
    long = " ".join(rng.choice(["alpha", "beta", "gammaray", "deltawing"]) for _ in range(40_000))
    same = "Über alles, über alles! a b\tc a b c"
    rows = [(1, None, "en"), (2, "", "en"), (3, " \n\t", None), (4, "word", "und"), (5, long, "en"), (6, long, "fr"), (7, same, None),
            (7, same, None), (None, same, "en"), (8, "<|endoftext|> x  y", "en")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string").select(
        "*", *(F.lit("x").alias(c) for c in ("key", "hash", "start", "ids", "phrase", "f", "k", "n", "word", "run", "h")))


# --- token files ---------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("n, kind", [(1, "one"), (5, "few"), (9000, "text"), (20_000, "same"), (20_000, "random"), (70_001, "text")])
def test_coder_gives_back_what_it_took(n, kind):
    rng = np.random.default_rng(n)
    ids = {
        "one": np.zeros(n), "few": rng.integers(0, 50_257, n), "same": np.full(n, 50_256), "random": rng.integers(0, 50_257, n),
        "text": np.minimum(rng.zipf(1.3, n), 50_256)}[kind].astype(np.uint32)
    blocks = mixcoder.blocks_for(n)
    codes = mixcoder.encode_blocks(ids, blocks, 50_257)
    assert len(codes) == blocks
    assert (mixcoder.decode_blocks(codes, n, 50_257) == ids).all()
    # Each block stands alone: it is the code of its ids.
    lengths = mixcoder.block_lengths(n, blocks)
    assert codes[-1] == mixcoder.encode_blocks(ids[n - lengths[-1]:], 1, 50_257)[0]


def test_coder_learns():
    """Text that repeats costs next to nothing; ids without order, which no model can learn, three bits more than they have."""
    rng = np.random.default_rng(1)
    phrase = rng.integers(0, 50_257, 40).astype(np.uint32)
    size = lambda ids: 8 * sum(map(len, mixcoder.encode_blocks(ids, 1, 50_257))) / len(ids)
    assert size(np.tile(phrase, 400)) < 1
    assert size(rng.integers(0, 50_257, 16_000).astype(np.uint32)) < 15.7 + 3


@pytest.mark.parametrize("vocabulary", [1, 2, 300, 4094, 4095, 4096, 70_000])
def test_coder_of_any_vocabulary(vocabulary):
    ids = np.random.default_rng(vocabulary).integers(0, vocabulary, 700).astype(np.uint32)
    assert (mixcoder.decode_blocks(mixcoder.encode_blocks(ids, 3, vocabulary), 700, vocabulary) == ids).all()
    with pytest.raises(ValueError):
        mixcoder.Orders(mixcoder.MAX_VOCABULARY + 1)


def library_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    return [own.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def test_chunks_are_those_of_whole_texts():
    tokenizers = pytest.importorskip("public_tokenizers")
    with open(tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        own = token_files.ChunkEncoder(f.read(), 2)
    assert own.cut
    hard = [None, "", " ", "  ", "a ", " a", "a  b", "a   b\n c", "\n\n x", "a\x1c b", "a \x1cb", "a\xa0b \xa0c", "it's  'tis <|endoftext|> x",
            "x" * 50_000, "   b", "a　b c  ", "\t a\t b", "é ́e", "\U0001f600 \U0001f600"]
    rng = random.Random(2)
    hard += ["".join(rng.choice(" \n\tab1'é中.") for _ in range(60)) for _ in range(300)]
    for again in range(2):  # the second time from the store
        ids, sizes = own.encode(hard)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == library_ids(hard)


def test_token_files(spark, documents):
    pytest.importorskip("public_tokenizers")
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op11_token_files(spark, SF).collect()}
    at, rows = 0, sorted(documents)
    for (i, _, _), ids in zip(rows, library_ids(t for _, t, _ in rows)):
        assert got[i] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert len(got) == len(rows)


def test_token_files_edges(spark, edge, monkeypatch):
    tokenizers = pytest.importorskip("public_tokenizers")
    monkeypatch.setattr(token_files, "FILE_BYTES", 100_000)
    back = token_files.through_files(edge, tokenizers.path("byte_bpe_50k.json"), 2).orderBy("start").collect()
    rows = edge.select("doc_id", "text").collect()
    assert [r.key for r in back] == sorted((r.doc_id for r in rows), key=lambda k: (k is not None, k))
    assert [r.start for r in back] == np.cumsum([0, *(r.n_tokens for r in back)])[:-1].tolist()
    want = sorted((r.doc_id or 0, ids) for r, ids in zip(rows, library_ids(r.text for r in rows)))
    assert sorted((r.key or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in back) == want
    assert token_files.through_files(edge.limit(0), tokenizers.path("byte_bpe_50k.json"), 2).collect() == []


def test_damage_is_noticed(spark, edge):
    tokenizers = pytest.importorskip("public_tokenizers")
    path = fresh_dir(spark, "damage")
    token_files.write_token_files(edge.where("doc_id = 5"), tokenizers.path("byte_bpe_50k.json"), 2, path)
    system, base = token_files.filesystem(f"{path}/files")
    name = token_files.read_manifest(spark, path).first().file
    with system.open_input_stream(f"{base}/{name}") as f:
        whole = f.read()
    import io

    assert len(list(token_files.read_segments(io.BytesIO(whole)))) == 1
    for at in (0, 30, len(whole) // 2, len(whole) - 1):
        bad = bytearray(whole)
        bad[at] ^= 64
        with pytest.raises(ValueError):
            list(token_files.read_segments(io.BytesIO(bytes(bad))))
    with pytest.raises(ValueError):
        list(token_files.read_segments(io.BytesIO(whole[:-5])))


def test_files_of_lost_tasks_are_not_read(spark, edge):
    tokenizers = pytest.importorskip("public_tokenizers")
    path = fresh_dir(spark, "lost")
    token_files.write_token_files(edge, tokenizers.path("byte_bpe_50k.json"), 2, path)
    n = token_files.read_token_files(spark, path).count()
    system, base = token_files.filesystem(f"{path}/files")
    with system.open_output_stream(f"{base}/0000000-of-a-lost-task.tokens") as out:
        out.write(b"half a file")
    assert token_files.read_token_files(spark, path).count() == n == 10


# --- collocations --------------------------------------------------------------------------------------------------

def brute_frequent(rows, least, max_words):
    found = Counter()
    for text, lang in rows:
        low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, max_words + 1):
                found.update((lang or "und", k, " ".join(w[i:i + k])) for i in range(len(w) - k + 1))
    sizes = Counter()
    for (lang, k, _), f in found.items():
        if k == 1:
            sizes[lang] += f
    return {key: f for key, f in found.items() if f >= least}, sizes


def test_collocations_are_those_of_the_sql(spark):
    got = sorted(map(tuple, queries.op12_toivonen_collocations(spark, SF).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert got == sorted(con.execute(queries.ORACLE_SQL["op12_toivonen_collocations"]).fetchall())
    assert len(got) > 200


@pytest.mark.parametrize("one_in, propose", [(8, 0.8), (3, 5.0), (1000, 0.8)])
def test_mining_is_exact_whatever_the_sample(spark, documents, monkeypatch, one_in, propose):
    """Few and many misses of the sample, and a sample without rows: the closing pass finds all the same."""
    monkeypatch.setattr(collocations, "SAMPLE_ONE_IN", one_in)
    monkeypatch.setattr(collocations, "PROPOSE", propose)
    monkeypatch.setattr(collocations, "FLUSH_WORDS", 5000)
    some = documents[:250]
    docs = spark.createDataFrame(some, "doc_id bigint, text string, lang string")
    want, sizes = brute_frequent([(t, l) for _, t, l in some], 12, 4)
    got = {(r.lang, r.k, r.phrase): r.f for r in collocations.frequent_phrases(docs, 12, 4).collect()}
    assert {k: f for k, f in got.items() if k[1]} == want
    assert {k[0]: f for k, f in got.items() if not k[1] and f} == dict(sizes)


def test_bits_in_common_add_rows_and_change_no_count(spark, documents, monkeypatch):
    monkeypatch.setattr(collocations, "BITS", 128)
    some = documents[:120]
    docs = spark.createDataFrame(some, "doc_id bigint, text string, lang string")
    want, _ = brute_frequent([(t, l) for _, t, l in some], 8, 3)
    got = {(r.lang, r.k, r.phrase): r.f for r in collocations.frequent_phrases(docs, 8, 3).where("k > 0").collect()}
    assert got == want


@pytest.mark.parametrize("bits", [64, 256, 1024])
def test_bits_in_common_hide_no_phrase_of_the_closing_pass(spark, monkeypatch, bits):
    """Phrases of words that the sample never saw, while other phrases' bits make the first pass seem to have counted their parts."""
    monkeypatch.setattr(collocations, "BITS", bits)
    rng = random.Random(bits)
    rows = [(i, " ".join(f"w{rng.randrange(30)}" for _ in range(30)), rng.choice(["en", None])) for i in range(300)]
    rows += [(900 + j, (" ".join(f"r{rng.randrange(40)}" for _ in range(5)) + ". ") * 31, "en") for j in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    want, _ = brute_frequent([(t, l) for _, t, l in rows], 30, 4)
    got = {(r.lang, r.k, r.phrase): r.f for r in collocations.frequent_phrases(docs).where("k > 0").collect()}
    assert got == want


def test_collocations_edges(spark, edge):
    want, sizes = brute_frequent([(r.text, r.lang) for r in edge.collect()], 2, 4)
    got = {(r.lang, r.k, r.phrase): r.f for r in collocations.frequent_phrases(edge, 2, 4).collect()}
    assert {k: f for k, f in got.items() if k[1]} == want
    assert {k[0]: f for k, f in got.items() if not k[1] and f} == dict(sizes)
    top = collocations.collocations(edge, 2, 4, top=3).collect()
    assert {(r.lang, r["rank"]) for r in top if r.lang == "en"} == {("en", 1), ("en", 2), ("en", 3)}
    assert {r.n for r in top if r.lang == "und"} == {sizes["und"]}
    assert collocations.collocations(edge.limit(0)).collect() == []


def test_scores_beyond_64_bits(spark, monkeypatch):
    """Counts whose products pass 64 bits, as exact whole numbers; ties go to the first cut and the first phrase."""
    big = 6 * 10**12
    rows = [("x", 0, "", 4 * big), ("x", 1, "a", 3 * big), ("x", 1, "b", 3 * big + 1), ("x", 1, "c", 3 * big),
            ("x", 2, "a b", big), ("x", 2, "b c", big), ("x", 3, "a b c", big // 2)]
    found = spark.createDataFrame(rows, "lang string, k int, phrase string, f long")
    monkeypatch.setattr(collocations, "frequent_phrases", lambda *a: found)
    got = [tuple(r) for r in collocations.collocations(found).orderBy("rank").collect()]
    score = 2000000 * big // (6 * big + 1)
    three = 2000000 * (big // 2) // (4 * big)  # both cuts: the first counts
    assert got == [("x", 1, "a b", big, 3 * big, 3 * big + 1, 4 * big, score), ("x", 2, "b c", big, 3 * big + 1, 3 * big, 4 * big, score),
                   ("x", 3, "a b c", big // 2, 3 * big, big, 4 * big, three)]


# --- spelling ------------------------------------------------------------------------------------------------------

def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(words, near):
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda z: (-words[z], z))
        if words[best] >= 10 * words[w]:
            form[w] = best
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near.get(w, ())), words[form[w]] if w in form else None)
    return out


def near_words(words):
    """Near words by taking each letter out in turn."""
    near, holes = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1:], True].add(w)
            if w[:i] + w[i + 1:] in words:
                near[w].add(w[:i] + w[i + 1:])
                near[w[:i] + w[i + 1:]].add(w)
    for found in holes.values():
        for a in found:
            near[a] |= found - {a}
    return {w: x for w, x in near.items() if x}


def test_spelling_of_the_documents(spark, documents):
    lower = {i: i + 32 for i in range(65, 91)}
    words = Counter()
    for i, text, _ in documents:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{i}:{run}".encode())
            words[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in queries.op13_partenum_spelling(spark, SF).collect()}
    assert got == brute_variants(words, near_words(words))
    assert sum(1 for x in got.values() if x[0]) > 50


def test_spelling_of_made_up_words(spark):
    """Few letters, so that signatures are crowded and words near many others; chains of forms; ties; all pairs compared."""
    rng = random.Random(11)
    words = {"".join(rng.choice("abé\U0001f600") for _ in range(rng.randrange(1, 8))): 10 ** rng.randrange(0, 6) for _ in range(700)}
    words |= {"chain" + "x" * k: 10 ** (k + 1) for k in range(6)}
    near = {a: {b for b in words if one_apart(a, b)} for a in words}
    rows = [*words.items(), (None, 5)]
    got = spelling.variants(spark.createDataFrame(rows, "word string, n bigint"))
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got.collect()} == brute_variants(words, {a: x for a, x in near.items() if x})
    assert {r.root for r in got.where("word LIKE 'chain%'").collect()} == {"chainxxxxx"}


def test_letters_beyond_the_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "LETTERS", 2)
    words = {"abcdef": 1, "abcxef": 20, "zbcxef": 300, "abcdefg": 4, "qqqqqq": 5}
    near = {a: {b for b in words if one_apart(a, b)} for a in words}
    got = spelling.variants(spark.createDataFrame(list(words.items()), "word string, n bigint")).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == brute_variants(words, {a: x for a, x in near.items() if x})


def test_spelling_edges(spark, edge):
    words = queries.words_with_slips(edge)
    got = spelling.variants(words).collect()
    assert {r.word for r in got} >= {"gammaray", "deltawing"}
    assert all(r.root == r.word for r in got if r.form is None)
    assert spelling.variants(words.limit(0)).collect() == []
    twice = words.unionByName(words)
    assert {r.word: r.n for r in spelling.variants(twice).collect()} == {r.word: 2 * r.n for r in got}
