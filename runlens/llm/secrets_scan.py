"""Secret scan: candidates by pattern, false positives removed by a random forest, in DataFrame functions only.

A candidate is the value of an assignment to a telling name, a private key block, the user and password of an
address, or a run of at least twelve key characters with a digit in it. Its features are its length, what characters it has and how they change from one to
the next, how much of it the corpus's frequent words cover, where it was found and the words around it.
The forest is trained from labelled findings, half of `TRAINING_FINDINGS` of each kind in expectation. Where findings
of one kind are missing, there is no forest: labelled findings keep their label as score, and of the others those
assigned to a telling name get 0.5, the rest 0.25.

Defined results: null or empty text has no candidates. Repeated rows give their findings once each; a
null doc_id or path is kept. Candidates of any length are whole; their text does not leave the operator
but as a digest.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.shared import held_out, stored

TRAINING_FINDINGS = 20_000
DICTIONARY_WORDS = 5_000
TREES = 30
DEPTH = 6
SECRET = 0.5
CONTEXT = 40

# Names whose values are secret, beginnings of issued keys, and words of harmless context.
_NAMES = r"(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth)"
_ASSIGNMENT = rf"{_NAMES}[\"']?[ \t]{{0,3}}[=:][ \t]{{0,3}}[\"']?"
_KEY = r"(?<![A-Za-z0-9_+/=.-])(?=[A-Za-z_+/=.-]*+[0-9])[A-Za-z0-9_+/=.-]{12,}+"
_BLOCK = r"-----BEGIN (?:(?!PRIVATE )[A-Z0-9]++ ){0,4}PRIVATE KEY-----(?:\s++[A-Za-z0-9+/=]{16,}+)*+"
_LOGIN = r"(?<=[A-Za-z0-9]://)[^\s/:@\"'<>]++:[^\s/:@\"'<>]++(?=@)"
PATTERN = rf"{_BLOCK}|{_LOGIN}|{_ASSIGNMENT}[^\s\"']{{6,}}+|{_KEY}"
_ISSUED = r"^(?:AKIA|ASIA|gh[pousr]_|github_pat_|glpat-|sk_|sk-|xox[abprs]-|AIza|eyJ|-----BEGIN )"
# Issued keys in full.
_ISSUED_KEY = (
    r"^(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|github_pat_\w{20,}|glpat-[\w-]{16,}|sk[_-][\w-]{16,}|"
    r"xox[abprs]-[\w-]{10,}|AIza[\w-]{30,}|eyJ[\w-]{8,}\.[\w-]{8,}\.?[\w-]*)$|^-----BEGIN "
)
_HARMLESS = r"(?i)\b(?:example|sample|dummy|checksum|commit|digest|hash|version|uuid|isbn|phone|card)\b"
_TEST_PATH = r"(?i)(?:test|spec|example|sample|mock|fixture|doc)"
_CODE_PATH = r"(?i)\.(?:py|js|ts|java|go|rb|env|ya?ml|json|toml|ini|cfg|properties|sh)$"

FEATURES = (
    "size", "digits", "uppers", "lowers", "marks", "turns", "case_turns", "letter_pairs", "distinct", "hexadecimal",
    "issued", "assigned", "covered", "longest_word", "in_test", "in_code", "named_before", "sign_before", "quote_before",
    "quote_after", "harmless_near",
)


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """doc_id, path, row, nth, position, value, assigned and the text before and after, one row per candidate."""
    likely = F.col("text").rlike("[0-9=:]|-----BEGIN ")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(path).cast("string").alias("path"),
        F.monotonically_increasing_id().alias("row"),
        F.when(likely, F.col("text")).alias("text"),
    ).where("text IS NOT NULL")
    matches = F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))
    rows = rows.withColumn("found", matches).where(F.size("found") > 0)
    gaps = F.split("text", PATTERN, -1)
    closing = F.concat("found", F.array(F.lit("")))
    pieces = F.transform(
        F.arrays_zip(gaps.alias("gap"), closing.alias("found")),
        lambda z: F.struct(
            (F.length(z["gap"]) + F.length(z["found"])).alias("size"),
            F.length(z["gap"]).alias("lead"),
            F.right(z["gap"], F.lit(CONTEXT)).alias("before"),
            F.left(z["gap"], F.lit(CONTEXT)).alias("head"),
            z["found"].alias("found"),
        ),
    )
    each = rows.select("doc_id", "path", "row", F.posexplode(pieces).alias("nth", "piece")).select("doc_id", "path", "row", "nth", "piece.*")
    ordered = Window.partitionBy("row").orderBy("nth")
    earlier = F.coalesce(F.sum("size").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    each = each.withColumn("start", earlier + F.col("lead")).withColumn("after", F.lead("head").over(ordered))
    told = F.regexp_extract("found", f"^{_ASSIGNMENT}", 0)
    return each.where("after IS NOT NULL").select(
        "doc_id",
        "path",
        "row",
        "nth",
        (F.col("start") + F.length(told)).cast("long").alias("position"),
        F.substr("found", F.length(told) + 1, F.length("found")).alias("value"),
        (F.length(told) > 0).alias("assigned"),
        F.concat("before", told).alias("before"),
        F.col("after"),
    )


def dictionary(docs: DataFrame, words: int = DICTIONARY_WORDS) -> DataFrame:
    """The most frequent words of the corpus, a bounded number of them."""
    found = docs.select(F.explode(F.split(F.lower("text"), "[^a-z]+", -1)).alias("word")).where(F.length("word") >= 3)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(words).select("word")


def _share(value: str, kept: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{kept}]", "")) / F.length(value)


def _count(value: str, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.length(value)


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with one double column per feature."""
    parts = found.select("row", "nth", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    known = parts.join(F.broadcast(words), "word").groupBy("row", "nth").agg(
        F.sum(F.length("word")).alias("in_words"), F.max(F.length("word")).alias("longest")
    )
    joined = found.join(known, ["row", "nth"], "left")
    path = F.coalesce("path", F.lit(""))
    columns = {
        "size": F.length("value"),
        "digits": _share("value", "0-9"),
        "uppers": _share("value", "A-Z"),
        "lowers": _share("value", "a-z"),
        "marks": _share("value", "_+/=.-"),
        "turns": _count("value", "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"),
        "case_turns": _count("value", "(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        "letter_pairs": _count("value", "(?i)(?<=[aeiou])(?=[b-df-hj-np-tv-z])"),
        "distinct": F.size(F.array_distinct(F.split("value", "", -1))) / F.length("value"),
        "hexadecimal": F.col("value").rlike("^[0-9a-f]{16,}$"),
        "issued": F.col("value").rlike(_ISSUED),
        "assigned": F.col("assigned"),
        "covered": F.coalesce("in_words", F.lit(0)) / F.length("value"),
        "longest_word": F.coalesce("longest", F.lit(0)),
        "in_test": path.rlike(_TEST_PATH),
        "in_code": path.rlike(_CODE_PATH),
        "named_before": F.col("before").rlike(rf"{_NAMES}\W{{0,4}}$"),
        "sign_before": F.col("before").rlike(r"[=:]\s*[\"']?$"),
        "quote_before": F.col("before").rlike(r"[\"']$"),
        "quote_after": F.col("after").rlike(r"^[\"']"),
        "harmless_near": F.concat("before", F.lit(" "), "after").rlike(_HARMLESS),
    }
    kept = [c for c in joined.columns if c not in ("in_words", "longest")]
    return joined.select(*kept, *[columns[name].cast("double").alias(f"f_{name}") for name in FEATURES])


def _assembled(found: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"f_{name}" for name in FEATURES], outputCol="features").transform(found)


def train(labelled: DataFrame):
    """A forest from rows with features and a `label` of 0 or 1; None where one kind is missing."""
    rows = labelled.where("label IN (0, 1)")
    ones, count = rows.agg(F.count_if(F.col("label") == 1), F.count(F.lit(1))).first()
    if not 0 < ones < count:
        return None
    # As many of either kind, however rare one is.
    parts = [int((1 << 30) * min(1.0, TRAINING_FINDINGS / 2 / n)) for n in (count - ones, ones)]
    features = [f"f_{name}" for name in FEATURES]
    part = F.when(F.col("label") == 1, parts[1]).otherwise(parts[0])
    drawn = rows.where(F.pmod(F.xxhash64(*features, "value", F.lit("secrets")), F.lit(1 << 30)) < part)
    # A bounded sample in one sorted partition: the same rows always give the same forest.
    sample = drawn.select("label", *features).coalesce(1).sortWithinPartitions("label", *features)
    if min(parts) == 0 or sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=11)
    return forest.fit(_assembled(sample))


def scored(found: DataFrame, model) -> DataFrame:
    """doc_id, position, size, digest, score and is_secret of every candidate."""
    if model is None:
        unsure = F.when(F.col("assigned"), 0.5).otherwise(0.25)
        rows = rule_labels(found).withColumn("score", F.coalesce(F.col("label").cast("double"), unsure))
    else:
        chance = vector_to_array("probability")[1]
        rows = model.transform(_assembled(found)).withColumn("score", chance)
    return rows.select(
        "doc_id",
        "position",
        F.length("value").alias("size"),
        F.sha2("value", 256).alias("value_sha256"),
        "score",
        (F.col("score") >= SECRET).alias("is_secret"),
    )


def rule_labels(found: DataFrame) -> DataFrame:
    """Labels where rules are sure: issued keys, key blocks, logins in addresses and assigned values that look drawn
    are secret; plain numbers, addresses and words with a number are not. What is left gets no label."""
    value = F.col("value")
    drawn = value.rlike("[0-9]") & value.rlike("[a-zA-Z]") & (F.col("f_turns") >= 0.15)
    plain = value.rlike(r"^[0-9./:+-]+$") | value.rlike(r"^[A-Za-z]+[0-9]{0,4}(?:\.[A-Za-z0-9-]+)*\.?$")
    login = F.col("before").endswith("://") & F.col("after").startswith("@")
    secret = value.rlike(_ISSUED_KEY) | login | (F.col("assigned") & drawn)
    return found.withColumn("label", F.when(secret, 1).when(~F.col("assigned") & plain, 0))


def scan(docs: DataFrame, path: str = "source") -> DataFrame:
    """Find the candidates of `docs`, learn from those that rules can label, and score all of them."""
    words = stored(dictionary(docs), "dictionary")
    # Stored first: the features look at the candidates twice.
    found = stored(with_features(stored(candidates(docs, path), "candidates"), words), "findings")
    return scored(found, train(rule_labels(found).where(~held_out("doc_id"))))
