"""Registered queries of the operators, over whole tables, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, collocations, decontaminate, exact_sql, fuzzy_lines, langid, ngram_rules, phrases, reputation, secrets_forest, setsketch, spelling, token_files, zstd_quality
from .common import crc_mod, labelled_sample


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_zstd_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    sample = labelled_sample(docs, labels, "quality", zstd_quality.PER_LABEL, crc_mod("k", 5) != 0, chars=zstd_quality.TEXT_CHARS)
    scored = zstd_quality.score_quality(docs, zstd_quality.fit(sample))
    return scored.select(
        "doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op2_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode_documents(table(spark, sf, "documents"), path, pattern)
    return bpe.decode_documents(encoded, path, pattern).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_phrase_automata(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.remove_repeats(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_ngram_ratio_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    ratios = ngram_rules.fit(docs, table(spark, sf, "labels"))
    found, name = ngram_rules.measured(docs.select("doc_id", "text"), ratios)
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio"]
    return found.select("doc_id", *(F.col(name)[f].alias(f) for f in fields))


def op5_fuzzy_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its text after the lines that repeat went, and how many did."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    gone = fuzzy_lines.repeated_lines(docs, at=fuzzy_lines.EVERY_PLACE)
    left = docs.withColumn("n_lines", F.size(F.split(F.coalesce("text", F.lit("")), "\n")))
    count = gone.groupBy(F.col("id").alias("doc_id"), "text_hash").agg(F.count("pos").alias("n_removed"), F.sort_array(F.collect_set("pos")).alias("removed"))
    both = left.withColumn("text_hash", F.xxhash64("text")).select("doc_id", "text_hash", "n_lines").join(count, ["doc_id", "text_hash"], "left")
    return both.select("doc_id", "n_lines", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), "removed")


def op6_suffix_array_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found, name = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"), ["doc_id"])
    got = F.col(name)
    return found.select(
        "doc_id", got["n_words"].alias("n_words"), got["n_hit"].alias("n_hit"), F.size(got["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(got["items"], ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated(name).alias("contaminated"),
        got["longest_words"].alias("longest_words"), got["longest_start"].alias("longest_start"))


#: Fixed values of the contract.
URL_RULES = [
    reputation.Rule("block", "net", "/"), reputation.Rule("allow", "example.net", "/en/"),
    reputation.Rule("block", "example.com", "/de/"), reputation.Rule("allow", "org", "/fr/")]


def op7_secret_forest(spark: SparkSession, sf: str) -> DataFrame:
    return secrets_forest.scan(table(spark, sf, "documents"))


def op8_host_reputation(spark: SparkSession, sf: str) -> DataFrame:
    """Outcomes are the labels of the document that a page shows, whose id is the number in its path."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    labels = table(spark, sf, "labels")
    shown = pages.select(
        reputation.host_of("url").alias("host"),
        F.expr("try_cast(regexp_extract(url, '://[^?#]*/([0-9]{1,18})(/|[.]html)?([?#]|$)', 1) AS bigint)").alias("doc_id"))
    outcomes = shown.join(labels.select(
        "doc_id", F.when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), (
            (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int")).alias("bad")), "doc_id")
    return reputation.judge(pages, outcomes.select("host", "bad"), URL_RULES)


def op9_setsketch_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf, "documents"))


def op10_byte_gru_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = langid.train(docs.where(crc_mod("doc_id", 4) != 2))
    return langid.identify(docs, model).select(
        "doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op11_token_files(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    back = token_files.through_files(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return back.select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_toivonen_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))


def words_with_slips(docs: DataFrame) -> DataFrame:
    """word, n by the contract: runs of letters, of which one in 31 by checksum loses a letter; a missing id is the empty text."""
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # A run of fewer than 7 letters makes no word of 7.
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(low, F.lit(r"[a-z\u00C0-\u00FF]{7,}"), F.lit(0))).alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    slipped = F.expr("concat(substring(run, 1, cast(h % length(run) as int)), substring(run, cast(h % length(run) as int) + 2))")
    words = runs.withColumn("h", h).select(F.when(F.col("h") % 31 == 0, slipped).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= 7).groupBy("word").agg(F.count("word").alias("n")).where("n >= 2")


def op13_partenum_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(words_with_slips(table(spark, sf, "documents")))


QUERIES = {f.__name__: f for f in (op1_zstd_quality, op2_byte_bpe, op3_phrase_automata, op4_ngram_ratio_rules, op5_fuzzy_lines,
    op6_suffix_array_decontamination, op7_secret_forest,
    op8_host_reputation, op9_setsketch_near_duplicates, op10_byte_gru_language, op11_token_files,
    op12_toivonen_collocations, op13_partenum_spelling)}
ORACLE_SQL: dict[str, str] = {
    op3_phrase_automata.__name__: exact_sql.PHRASES,
    op6_suffix_array_decontamination.__name__: exact_sql.DECONTAMINATION,
    op9_setsketch_near_duplicates.__name__: exact_sql.NEAR_DUPLICATES,
    op12_toivonen_collocations.__name__: collocations.oracle_sql(),
    op13_partenum_spelling.__name__: exact_sql.SPELLING}
