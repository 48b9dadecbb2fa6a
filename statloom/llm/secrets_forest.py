"""Secret scan: candidates by format, false positives removed by a random forest.

A candidate is a whole token of `MIN_CHARS` or more key characters, a token of any length behind an
assignment, or a value of any characters behind a key word (and each long token inside that value). Its
features are its length, how often the kind of character changes in it, its shares of digits,
capitals, hexadecimal digits and vowels, the share that words of the dictionary cover, the neighbouring words before
and after it (an assignment, quotes, key words, how many words), and the
path: whether it is part of one, and how deep the path of its text is. The dictionary is the words that stand in the texts
`WORD_TIMES` times or more. The forest is trained on labelled findings: a bounded
sample of distinct tokens with their label (at most `FINDINGS` of each label).

All is built-in Spark expressions and the DataFrame-based learner. Null and empty texts have no
candidate. Rows are scanned one by one; a repeated row repeats its findings; a null path is the empty
path. Other columns are not looked at. With findings of one label only, every candidate gets it.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import stage

MIN_CHARS = 16
#: Findings of each label that the forest is trained on, at most.
FINDINGS = 3_000
TREES = 30
DEPTH = 6
THRESHOLD = 0.5

#: Formats that issuers give to keys, and words that stand before a secret.
KNOWN_FORMAT = r"^(AKIA[0-9A-Z]{16}|[0-9a-f]{18}|[0-9a-f]{40}|gh[pousr]_[0-9A-Za-z]{36})$"
KEY_WORD = r"(?i)(password|passwd|pwd|token|secret|api_?key|access_?key|auth)\W*$"
KEY = "(?i:password|passwd|pwd|token|secret|api_?key|access_?key|auth)"
#: A whole token; one right behind an assignment; a value behind a key word, in quotes or up to a separator.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+={0,2}"
ASSIGNED = r"(?<=[=:]>?[ \t]{0,4}[\"']?)(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++={0,2}"
VALUE = (
    rf"(?<={KEY}\w{{0,16}}\W{{1,6}})(?:(?<=\")(?!\s*[:=,])[^\"\n]+(?=\")|(?<=')(?!\s*[:=,])[^'\n]+(?=')|"
    r"(?![=:>|,;.)\]}-])[^\s\"'`,;&<>]+)")
#: Text up to the next candidate and the candidate; or the rest of the text, so that every place is tried once.
CANDIDATE = rf"(?s)(.*?)(?:((?<=\W){VALUE}|{TOKEN}|(?<=[=:>\s\"']){ASSIGNED})|\z)"
AROUND = 40
#: Parts of a token that may be words, and how often a word stands in all texts to be in the dictionary.
PART = r"\p{Lu}?\p{Ll}{2,}|\p{Lu}{3,}"
WORD_TIMES = 5

FEATURES = [
    "length", "changes", "digits", "capitals", "hexadecimal", "vowels", "covered", "assigned", "quoted", "key_word", "closed",
    "key_word_after", "words_around", "in_path", "path_depth"]


def candidates(docs: DataFrame, text: str = "text", path: str | None = "source", key: str = "doc_id") -> DataFrame:
    """(doc_id, n, token, before, after, path): every candidate of every whole text, in order of its place."""
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")
    found = [F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(k)) for k in (1, 2)]
    rows = docs.where(F.col(text).rlike(rf"[A-Za-z0-9+/_-]{{16}}|[=:]|{KEY}")).select(
        F.col(key).alias("doc_id"), where.alias("path"), found[0].alias("gaps"), found[1].alias("tokens"))
    rows = rows.select("doc_id", "path", "tokens", F.transform("gaps", lambda g: F.struct(
        F.right(g, F.lit(AROUND)).alias("end"), F.left(g, F.lit(AROUND)).alias("start"))).alias("gaps"))
    hits = F.transform("tokens", lambda t, i: F.struct(
        t.alias("token"), F.get("gaps", i)["end"].alias("before"), F.get("gaps", i + 1)["start"].alias("after")))
    # A value of other characters is a candidate as a whole, and so is every long token in it.
    inside = lambda h: F.filter(F.regexp_extract_all(h["token"], F.lit(TOKEN), F.lit(0)), lambda t: t != h["token"])
    each = F.flatten(F.transform(F.filter(hits, lambda h: h["token"] != ""), lambda h: F.concat(F.array(h), F.transform(inside(h), lambda t: F.struct(
        t.alias("token"), h["before"].alias("before"), h["after"].alias("after"))))))
    return rows.select("doc_id", "path", F.posexplode(each).alias("n", "hit")).select("doc_id", "n", "hit.*", "path")


def _parts(text: str) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(PART), F.lit(0)), lambda w: F.lower(w))


def with_coverage(found: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The candidates and `covered`: the share of each token's characters in words of the dictionary of all texts."""
    parts = found.select("token").distinct().select("token", F.explode(_parts("token")).alias("word"))
    needed = stage(parts, "token-words")
    # Counted before they meet the tokens' words, so that a frequent word is one row of each task.
    counts = docs.select(F.explode(_parts(text)).alias("word")).groupBy("word").count()
    known = counts.where(F.col("count") >= WORD_TIMES).select("word")
    covered = needed.join(known, "word").groupBy("token").agg(F.sum(F.length("word")).alias("chars"))
    both = found.join(covered, "token", "left")
    return both.withColumn("covered", F.coalesce(F.col("chars") / F.length("token"), F.lit(0.0))).drop("chars")


def _share(token: Column, pattern: str) -> Column:
    return 1 - F.length(F.regexp_replace(token, pattern, "")) / F.length(token)


def with_features(found: DataFrame) -> DataFrame:
    """The features of candidates with their coverage."""
    t = F.col("token")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, "[0-9]+", "0"), "[a-z]+", "a"), "[A-Z]+", "A")
    around = F.size(F.regexp_extract_all(F.concat_ws(" ", "before", "after"), F.lit(r"\p{L}{3,}"), F.lit(0)))
    return found.select(
        "*", F.length(t).cast("double").alias("length"),
        ((F.length(kinds) - 1) / F.length(t)).alias("changes"), _share(t, "[0-9]").alias("digits"),
        _share(t, "[A-Z]").alias("capitals"), _share(t, "[0-9a-f]").alias("hexadecimal"),
        _share(t, "(?i)[aeiou]").alias("vowels"),
        F.col("before").rlike(r"[=:]\s*[\"']?$").cast("double").alias("assigned"),
        F.col("before").rlike(r"[\"']$").cast("double").alias("quoted"),
        F.col("before").rlike(KEY_WORD).cast("double").alias("key_word"),
        F.coalesce(F.col("after").rlike(r"^[\"']"), F.lit(False)).cast("double").alias("closed"),
        F.coalesce(F.col("after").rlike(KEY), F.lit(False)).cast("double").alias("key_word_after"),
        around.cast("double").alias("words_around"),
        (t.contains("/") | F.col("before").rlike(r"[/\\]$")).cast("double").alias("in_path"),
        F.size(F.split("path", "/")).cast("double").alias("path_depth"))


def labelled_findings(found: DataFrame) -> DataFrame:
    """Candidates with a label where the format decides: 1 for an issuer's format behind its context, 0 for prose.

    A team's reviewed findings can be used in their place; they need the features and `label`.
    """
    known = F.col("token").rlike(KNOWN_FORMAT)
    sure = known & (F.col("token").startswith("AKIA") | (F.col("assigned") > 0))
    prose = ~known & (F.col("digits") < 0.15) & (F.col("assigned") == 0) & (F.col("key_word") == 0)
    return found.withColumn("label", F.when(sure, 1.0).when(prose, 0.0)).where("label IS NOT NULL")


def train(findings: DataFrame) -> PipelineModel | float:
    """The forest of a bounded sample of labelled findings, or the only label there is (0 if none)."""
    # A token counts once for a label, however often it was copied.
    once = findings.groupBy("label", "token").agg(F.min(F.struct("before", *FEATURES)).alias("x")).select("label", "token", "x.*")
    parts = [once.where(F.col("label") == y).orderBy(F.xxhash64("token"), "token").limit(FINDINGS) for y in (0.0, 1.0)]
    sample = parts[0].unionByName(parts[1]).select("label", *FEATURES).collect()
    labels = {r.label for r in sample}
    if len(labels) < 2:
        return labels.pop() if labels else 0.0
    rows = findings.sparkSession.createDataFrame(sample, findings.select("label", *FEATURES).schema)
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest: RandomForestClassificationModel = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=7, featuresCol="features", labelCol="label").fit(vectors.transform(rows))
    return PipelineModel([vectors, forest])


def scan(docs: DataFrame, model: PipelineModel | float | None = None, text: str = "text", path: str | None = "source", key: str = "doc_id") -> DataFrame:
    """doc_id, n, token_sha256, before, score, secret: every candidate and the forest's verdict on it."""
    # Coverage, training and verdicts read the few candidates, not the texts again.
    found = with_features(with_coverage(stage(candidates(docs, text, path, key), "candidates"), docs, text))
    if model is None:
        found = stage(found, "candidate-features")
    model = train(labelled_findings(found)) if model is None else model
    if isinstance(model, float):
        scored = found.withColumn("score", F.lit(model))
    else:
        scored = model.transform(found).withColumn("score", vector_to_array("probability")[1])
    return scored.select(
        "doc_id", "n", F.sha2("token", 256).alias("token_sha256"), F.length("token").alias("token_chars"), "before", "score",
        (F.col("score") >= THRESHOLD).alias("secret"))
