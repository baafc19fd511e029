"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A document is a weighted set: its lower-cased words between white space, weighted by how often they occur.
For each of SAMPLES samples every term draws two Gamma(2, 1) numbers r, c and a uniform b from the hash of
the term and the sample's number. With t = floor(ln(weight) / r + b) and y = exp(r (t - b)), the term of
least c / (y exp(r)) is sampled together with its t. Two documents agree in a sample with a probability
equal to their generalised Jaccard similarity, the sum of the lesser weights over that of the greater.

Defined results: null text counts as empty; documents without terms have the fingerprint `-`, which is
wholly like itself and unlike all others. The next document has the next larger doc_id, and the first
follows the last; a single document follows itself. Rows without a doc_id are left out, and of rows that
share one the least text counts. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.shared import stored

SAMPLES = 32
# Samples drawn side by side in one row; a row for each group of them.
TOGETHER = 8
# Sampled keys: 2**-20 steps of the logarithm above their sample's 32 bits of identity.
_STEPS, _LOWEST, _HIGHEST = 1 << 20, -512.0, 512.0
EMPTY = "-"


def _uniform(bits: Column, shift: int, size: int) -> Column:
    """`size` bits of a hash as a number strictly between 0 and 1."""
    part = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << size) - 1)).cast("double")
    return (part + 0.5) / float(1 << size)


def _draws(sample: Column) -> dict[str, Column]:
    """r, ln c and b of the column `term` in a sample of this number."""
    first, second = F.xxhash64("term", sample), F.xxhash64("term", sample, F.lit(1))
    return {
        "r": -F.ln(_uniform(first, 0, 32) * _uniform(first, 32, 32)),
        "c": F.ln(-F.ln(_uniform(second, 0, 24) * _uniform(second, 24, 24))),
        "b": _uniform(second, 48, 16),
    }


def _sampled(log_weight: str, j: int) -> Column:
    """The key of a term as one integer, ordered as ln(c / (y exp(r))), its identity in the low 32 bits."""
    r, c, b = F.col(f"r{j}"), F.col(f"c{j}"), F.col(f"b{j}")
    t = F.floor(F.col(log_weight) / r + b)
    key = F.greatest(F.lit(_LOWEST), F.least(F.lit(_HIGHEST), c - r * (t - b) - r))
    ordered = F.shiftleft(F.floor((key - _LOWEST) * _STEPS), 32)
    name = F.col("term").bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseXOR(F.shiftleft(F.pmod(t, F.lit(1 << 20)), 12))
    return F.when(F.col(log_weight).isNotNull(), ordered.bitwiseOR(name))


def _neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, the previous document's id and half length, and the next one's id."""
    ids = docs.groupBy("doc_id").agg(F.min(F.coalesce(F.col("n_chars"), F.lit(0))).alias("n_chars"))
    spread = ids.repartitionByRange(F.col("doc_id")).withColumn("bucket", F.spark_partition_id())
    ids = stored(spread, "order")
    inside = Window.partitionBy("bucket").orderBy("doc_id")
    before = F.struct("doc_id", "n_chars")
    ids = ids.withColumn("before", F.lag(before).over(inside)).withColumn("after", F.lead("doc_id").over(inside))
    # One row per bucket; the borders close the ring.
    ends = ids.groupBy("bucket").agg(F.min("doc_id").alias("first"), F.max(before).alias("last"))
    ring = Window.orderBy("bucket")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "bucket",
        F.coalesce(F.lag("last").over(ring), F.max("last").over(whole)).alias("last_before"),
        F.coalesce(F.lead("first").over(ring), F.min("first").over(whole)).alias("first_after"),
    )
    joined = ids.join(F.broadcast(ends), "bucket")
    previous = F.coalesce("before", "last_before")
    return joined.select(
        "doc_id",
        "n_chars",
        previous["doc_id"].alias("previous"),
        F.floor(previous["n_chars"] / 2).cast("int").alias("wanted"),
        F.coalesce("after", "first_after").alias("next"),
    )


def _edited(docs: DataFrame) -> DataFrame:
    """doc_id, text, edited text and the ids before and after."""
    sized = docs.select("doc_id", F.char_length("text").cast("long").alias("n_chars"))
    placed = _neighbours(sized).join(docs, "doc_id")
    # Every document hands its beginning on to the one before it.
    handed = placed.select(F.col("previous").alias("doc_id"), F.substr("text", F.lit(1), F.col("wanted")).alias("beginning"))
    both = placed.join(handed, "doc_id")
    kept = (F.col("n_chars") - F.floor(F.col("n_chars") / 2)).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), kept), F.col("beginning"))
    return both.select("doc_id", "n_chars", "previous", "text", edited.alias("edited"))


def _plain(text: str) -> Column:
    """Lower-cased, with every kind of ASCII white space as a blank."""
    plain = F.lower(text)
    for space in "\t\n\x0b\f\r":
        plain = F.replace(plain, F.lit(space), F.lit(" "))
    return plain


def _terms(texts: DataFrame) -> DataFrame:
    """doc_id, term and the logarithms of its counts in the text and in the edited text.

    Rows of a document are together already, so nothing is shuffled here.
    """
    sides = F.array(
        F.struct(F.lit(0).alias("side"), _plain("text").alias("words")),
        F.struct(F.lit(1).alias("side"), _plain("edited").alias("words")),
    )
    rows = texts.select("doc_id", F.inline(sides))
    words = rows.select("doc_id", "side", F.explode(F.split("words", " ", -1)).alias("word")).where("word <> ''")
    counts = words.groupBy("doc_id", F.xxhash64("word").alias("term")).agg(
        F.sum(1 - F.col("side")).alias("own"), F.sum("side").alias("other")
    )
    return counts.select(
        "doc_id",
        "term",
        F.when(F.col("own") > 0, F.ln("own")).alias("own"),
        F.when(F.col("other") > 0, F.ln("other")).alias("other"),
    )


def _signatures(texts: DataFrame, samples: int) -> DataFrame:
    """doc_id and the sampled identities of its text and of its edited text, in the order of the samples."""
    groups = samples // TOGETHER
    rows = _terms(texts).select("*", F.explode(F.array(*[F.lit(g) for g in range(groups)])).alias("part"))
    draws = []
    for j in range(TOGETHER):
        for name, column in _draws(F.col("part") * TOGETHER + j).items():
            draws.append(column.alias(f"{name}{j}"))
    least = [
        F.min(_sampled(side, j)).alias(f"{side}{j}") for side in ("own", "other") for j in range(TOGETHER)
    ]
    found = rows.select("doc_id", "part", "term", "own", "other", *draws).groupBy("doc_id", "part").agg(*least)

    def identities(side: str) -> Column:
        return F.transform(
            F.array(*[F.col(f"{side}{j}") for j in range(TOGETHER)]), lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF))
        )

    parts = found.select("doc_id", F.struct("part", identities("own").alias("own"), identities("other").alias("other")).alias("p"))
    gathered = parts.groupBy("doc_id").agg(F.array_sort(F.collect_list("p")).alias("p"))
    return gathered.select("doc_id", F.flatten(F.col("p.own")).alias("own"), F.flatten(F.col("p.other")).alias("other"))


def _written(identities: Column) -> Column:
    """Hexadecimal, eight digits a sample; `-` for a document without terms."""
    known = F.filter(identities, lambda x: x.isNotNull())
    text = F.array_join(F.transform(known, lambda x: F.lpad(F.hex(x), 8, "0")), "")
    return F.when(F.size(known) > 0, text).otherwise(EMPTY)


def _likeness(left: str, right: str, samples: int) -> Column:
    same = F.aggregate(
        F.sequence(F.lit(0), F.lit(samples - 1)),
        F.lit(0),
        lambda n, i: n + (F.substr(left, i * 8 + 1, F.lit(8)) == F.substr(right, i * 8 + 1, F.lit(8))).cast("int"),
    )
    empty = (F.col(left) == EMPTY) | (F.col(right) == EMPTY)
    return F.when(F.col(left) == F.col(right), 1.0).when(empty, 0.0).otherwise(same / F.lit(float(samples)))


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness and that to the next document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.where("doc_id IS NOT NULL")
    repeated = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("doc_id")
    if not repeated.isEmpty():
        single = rows.join(repeated, "doc_id", "left_anti")
        rows = single.union(rows.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text")))
    texts = _edited(rows)
    about = texts.select("doc_id", "n_chars", "previous", F.sha2("edited", 256).alias("edited_sha256"))
    signed = about.join(_signatures(texts, samples), "doc_id", "left")
    none = F.array().cast("array<bigint>")
    signed = signed.select(
        "doc_id",
        "previous",
        "n_chars",
        "edited_sha256",
        _written(F.coalesce("own", none)).alias("fingerprint"),
        _written(F.coalesce("other", none)).alias("edited_fingerprint"),
    )
    # Each document keeps its own row and hands its fingerprint on to the one before it.
    told = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint")
    missing = [F.lit(None).alias(c) for c in told]
    ways = F.array(
        F.struct("doc_id", *told, F.lit(None).cast("string").alias("next_fingerprint")),
        F.struct(F.col("previous").alias("doc_id"), *missing, F.col("fingerprint").alias("next_fingerprint")),
    )
    both = signed.select(F.inline(ways)).groupBy("doc_id").agg(*[F.max(c).alias(c) for c in (*told, "next_fingerprint")])
    return both.select(
        "doc_id",
        *told,
        _likeness("fingerprint", "edited_fingerprint", samples).alias("near_edited"),
        _likeness("fingerprint", "next_fingerprint", samples).alias("near_next"),
    )
