"""Scoring of predictions and aggregation into leaderboards.

Rankings stay long: `preds(model, sample_id, subtask, pos, name)`, `truth(sample_id, subtask, pos,
name)` and `values(sample_id, subtask, name, value)`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.operators.skew import top_n

# Cut-offs and floors of the metrics.
NDCG_K = 5
RECALL_K = 5
VALUE_POOL = 20
FLOORS = {"peak": 10_000.0, "wall": 0.01}
HOT = ["hot_methods_time", "hot_methods_alloc", "hot_lines_time", "hot_lines_alloc"]
HEADLINES = {
    "outcome": ("f1", True),
    "peak_rss": ("log10_mae", False),
    "wall_time": ("log10_mae", False),
    **{task: ("ndcg_at_5", True) for task in HOT},
}

RESPONSE = ["model", "sample_id"]


def _label(name: str) -> Column:
    return F.lower(F.trim(F.coalesce(F.col(name), F.lit(""))))


def score_outcome() -> list[Column]:
    """Confusion flags for 'the test fails', and the exception match where it does."""
    truth, pred = _label("gt_outcome").isin("failed", "error"), _label("pred_outcome").isin("failed", "error")
    gt_exc = F.trim(F.coalesce("gt_exception", F.lit("")))
    pred_exc = F.trim(F.coalesce("pred_exception", F.lit("")))
    return [
        (truth & pred).cast("int").alias("tp"),
        (~truth & pred).cast("int").alias("fp"),
        (truth & ~pred).cast("int").alias("fn"),
        (~truth & ~pred).cast("int").alias("tn"),
        F.when(truth, ((gt_exc != "") & (gt_exc == pred_exc)).cast("double")).alias("exception_match"),
    ]


def score_numeric(field: str) -> list[Column]:
    """Floored log10 of truth and prediction and their distance; a missing prediction counts as 0."""
    floor = F.lit(FLOORS[field])
    truth = F.log10(F.greatest(F.col(f"gt_{field}"), floor))
    truth = F.when(F.col(f"gt_{field}").isNotNull(), truth)
    pred = F.log10(F.greatest(F.coalesce(F.col(f"pred_{field}"), F.lit(0.0)), floor))
    pred = F.when(F.col(f"gt_{field}").isNotNull(), pred)
    return [
        truth.alias(f"{field}_gt_log10"),
        pred.alias(f"{field}_pred_log10"),
        F.abs(pred - truth).alias(f"{field}_log10_mae"),
    ]


def discount(position: Column) -> Column:
    """Weight of a 0-based position."""
    return 1 / F.log2(position + 2)


def shuffled_gain(mean: Column, count: Column, k: int = NDCG_K) -> Column:
    """Expected gain of a random order: the mean value times the discounts of the filled positions."""
    sums = [sum(1 / math.log2(i + 2) for i in range(n)) for n in range(k + 1)]
    filled = F.least(count, F.lit(k)).cast("int")
    return mean * F.get(F.array(*[F.lit(s) for s in sums]), filled)


def _of(items: str, subtask: Column) -> Column:
    return F.filter(F.coalesce(F.col(items), F.array()), lambda x: x["subtask"] == subtask)


def with_values(items: Column, table: Column) -> Column:
    """(pos, name, value, known) of each named item; `known` tells whether the table lists it at all.

    A name that the table lists twice gives two entries.
    """

    def found(item: Column) -> Column:
        listed = F.filter(table, lambda v: v["name"] == item["name"])
        none = F.array(_valued(item, F.lit(0.0), F.lit(False)))
        return F.when(F.size(listed) == 0, none).otherwise(
            F.transform(listed, lambda v: _valued(item, F.coalesce(v["value"].cast("double"), F.lit(0.0)), F.lit(True)))
        )

    return F.flatten(F.transform(items, found))


def _valued(item: Column, value: Column, known: Column) -> Column:
    return F.struct(item["pos"].alias("pos"), item["name"].alias("name"), value.alias("value"), known.alias("known"))


def _total(items: Column, number) -> Column:
    """Sum of what `number` gives for each item; items it gives null for do not count."""
    return F.reduce(items, F.lit(0.0), lambda total, x: total + F.coalesce(number(x), F.lit(0.0)))


def _gain(largest: Column, size: Column) -> Column:
    """Gain of numbers in descending order; items of equal value give the same in any order. Null over nothing."""
    first = [F.coalesce(F.get(largest, F.lit(i)) / math.log2(i + 2), F.lit(0.0)) for i in range(NDCG_K)]
    return F.when(size > 0, sum(first[1:], first[0]))


def truth_gains(rows: DataFrame) -> DataFrame:
    """Of `_truth` and `_table`: ideal gain, expected gains of shuffled lists, hottest true item; null without a truth."""
    before = lambda x: F.coalesce(-x["pos"].cast("long"), F.lit((1 << 63) - 1)).alias("before")
    keyed = lambda x: F.struct(x["value"].alias("value"), before(x), x["name"].alias("name"))
    rows = rows.withColumn("_valued", with_values(F.col("_truth"), F.col("_table")))
    rows = rows.withColumns(
        {
            "_top": F.array_max(F.transform("_valued", keyed)),
            "_largest": F.sort_array(F.transform("_valued", lambda x: x["value"]), asc=False),
            "_first": F.filter("_valued", lambda x: x["pos"] < NDCG_K),
            "_pool": F.slice(F.sort_array(F.transform("_table", lambda v: v["value"].cast("double")), asc=False), 1, VALUE_POOL),
        }
    )
    rows = rows.withColumn("_told", F.array_compact("_pool"))
    first, pool = F.size("_first"), F.size("_pool")
    mean = lambda items, number: F.when(F.size(items) > 0, _total(F.col(items), number) / F.size(items))
    return rows.withColumns(
        {
            "idcg": _gain(F.col("_largest"), F.size("_largest")),
            "hottest": F.when(F.col("_top.value") > 0, F.col("_top.name")),
            "gt5_gain": shuffled_gain(mean("_first", lambda x: x["value"]), first),
            "gt20_gain": shuffled_gain(mean("_told", lambda x: x), pool),
        }
    ).drop("_valued", "_top", "_largest", "_first", "_pool", "_told")


def pred_gains(rows: DataFrame) -> DataFrame:
    """Of a response's `_own` and `_table`: gain as predicted, reordered by true value, and shuffled; null without predictions."""
    rows = rows.withColumn("_valued", with_values(F.col("_own"), F.col("_table")))
    rows = rows.withColumn("_largest", F.sort_array(F.transform("_valued", lambda x: x["value"]), asc=False))
    valued, size = F.col("_valued"), F.size("_valued")
    told = lambda column: F.when(size > 0, column)
    discounted = lambda x: F.when(x["pos"] < NDCG_K, x["value"] * discount(x["pos"]))
    hit = F.exists(valued, lambda x: (x["pos"] < RECALL_K) & (x["name"] == F.col("hottest")))
    return rows.withColumns(
        {
            "executed_ratio": told(_total(valued, lambda x: x["known"].cast("double")) / size),
            "dcg": told(_total(valued, discounted)),
            "pred_gain": told(shuffled_gain(_total(valued, lambda x: x["value"]) / size, size)),
            "oracle_gain": _gain(F.col("_largest"), size),
            "hit": F.when(F.col("hottest").isNotNull(), F.coalesce(hit, F.lit(False))),
        }
    )


def score_hot(responses: DataFrame, preds: DataFrame, truth: DataFrame, values: DataFrame) -> DataFrame:
    """Ranking metrics for each response and hot sub-task.

    Every table is laid out by sample once. A sample's rankings meet in one row, as the stored records hold them, and
    all its responses are scored there.
    """

    def folded(df: DataFrame, alias: str, *columns: str) -> DataFrame:
        return df.groupBy("sample_id").agg(F.collect_list(F.struct(*columns)).alias(alias))

    samples = folded(responses, "_responses", "model")
    for df, alias, columns in (
        (truth, "_truth", ("subtask", "pos", "name")),
        (values, "_values", ("subtask", "name", "value")),
        (preds, "_preds", ("model", "subtask", "pos", "name")),
    ):
        samples = samples.join(folded(df, alias, *columns), "sample_id", "left")
    subtask = F.col("subtask")
    rows = samples.withColumn("subtask", F.explode(F.array(*[F.lit(t) for t in HOT])))
    rows = rows.select("sample_id", "subtask", "_responses", _of("_preds", subtask).alias("_preds"), _of("_truth", subtask).alias("_truth"), _of("_values", subtask).alias("_table"))
    rows = truth_gains(rows).withColumn("_response", F.explode("_responses")).withColumn("model", F.col("_response.model"))
    rows = rows.withColumn("_own", F.filter("_preds", lambda p: p["model"] == F.col("model")))
    joined = pred_gains(rows)
    scorable = F.col("idcg") > 0

    def ratio(gain: str) -> Column:
        return F.when(scorable, F.col(gain) / F.col("idcg"))

    return joined.select(
        *RESPONSE,
        "subtask",
        F.coalesce("executed_ratio", F.lit(0.0)).alias("executed_ratio"),
        F.coalesce(ratio("dcg"), F.lit(0.0)).alias("ndcg_at_5"),
        ratio("gt5_gain").alias("ndcg_gt5_shuffled"),
        ratio("gt20_gain").alias("ndcg_gt20_shuffled"),
        ratio("pred_gain").alias("ndcg_pred_shuffled"),
        ratio("oracle_gain").alias("ndcg_pred_oracle"),
        F.col("hit").cast("double").alias("recall_at_5_top1"),
    )


def score_responses(responses: DataFrame) -> DataFrame:
    """Outcome and numeric signals next to each response, with the validity flag."""
    return responses.select(
        "*",
        *score_outcome(),
        *score_numeric("peak"),
        *score_numeric("wall"),
        F.coalesce("valid", F.lit(False)).cast("int").alias("valid_pred"),
    )


def _rate(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def common_figures() -> list[Column]:
    n, valid, errors = F.count(F.lit(1)), F.sum("valid_pred"), F.count_if(F.length("error") > 0)
    failures = F.greatest(F.lit(0), n - valid - errors)
    return [
        n.alias("n"),
        valid.alias("n_valid"),
        failures.alias("n_parse_failure"),
        errors.alias("n_api_error"),
        _rate(valid, n).alias("valid_pred_rate"),
        _rate(failures, n).alias("parse_failure_rate"),
        _rate(errors, n).alias("api_error_rate"),
    ]


def aggregate_common(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Run health: responses, valid ones, API errors, parse failures and rates."""
    return scored.groupBy(*keys).agg(*common_figures())


def outcome_sums() -> list[Column]:
    return [*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")], F.avg("exception_match").alias("exception_match")]


def with_outcome_figures(sums: DataFrame) -> DataFrame:
    precision = _rate(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _rate(F.col("tp"), F.col("tp") + F.col("fn"))
    return (
        sums.withColumn("precision", precision)
        .withColumn("recall", recall)
        .withColumn("f1", _rate(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
        .withColumn("n_failure_gt", F.col("tp") + F.col("fn"))
    )


def aggregate_outcome(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Precision, recall and F1 of predicted failures; 0 on empty denominators."""
    return with_outcome_figures(scored.groupBy(*keys).agg(*outcome_sums()))


FIT = ["n_fitted", "slope", "bias", "residual_std", "log10_mae"]


def fit_moments(field: str) -> list[Column]:
    x, y = F.col(f"{field}_gt_log10"), F.col(f"{field}_pred_log10")
    fitted = F.count(F.when(x.isNotNull() & y.isNotNull(), F.lit(1)))
    return [
        fitted.alias(f"{field}_n_fitted"),
        F.when(fitted >= 2, F.regr_slope(y, x)).alias(f"{field}_slope"),
        F.when(fitted >= 2, F.regr_intercept(y, x)).alias(f"{field}_bias"),
        F.regr_sxy(y, x).alias(f"{field}_sxy"),
        F.regr_syy(y, x).alias(f"{field}_syy"),
        F.avg(f"{field}_log10_mae").alias(f"{field}_log10_mae"),
    ]


def residual_std(field: str) -> Column:
    """Population deviation of the residuals, from the same second moments as the slope."""
    n, slope = F.col(f"{field}_n_fitted"), F.col(f"{field}_slope")
    rest = F.greatest(F.lit(0.0), F.col(f"{field}_syy") - slope * F.col(f"{field}_sxy"))
    return F.when((n >= 3) & slope.isNotNull(), F.sqrt(rest / n))


def aggregate_numeric(scored: DataFrame, keys: list[str], field: str) -> DataFrame:
    """Log-log calibration: slope, bias, population residual deviation and mean error.

    A fit needs two points with some variance, its residuals three.
    """
    moments = scored.groupBy(*keys).agg(*fit_moments(field)).withColumn(f"{field}_residual_std", residual_std(field))
    return moments.select(*keys, *[F.col(f"{field}_{name}").alias(name) for name in FIT])


HOT_METRICS = [
    "executed_ratio",
    "ndcg_at_5",
    "ndcg_gt5_shuffled",
    "ndcg_gt20_shuffled",
    "ndcg_pred_shuffled",
    "ndcg_pred_oracle",
    "recall_at_5_top1",
]


def aggregate_hot(hot: DataFrame, keys: list[str]) -> DataFrame:
    """Means over the responses that have each metric."""
    return hot.groupBy(*keys).agg(
        *[F.avg(m).alias(m) for m in HOT_METRICS], F.count("recall_at_5_top1").alias("recall_at_5_top1_n")
    )


OUTCOME_METRICS = ["tp", "fp", "fn", "tn", "precision", "recall", "f1", "exception_match", "n_failure_gt"]
HEALTH = ["n", "n_valid", "n_parse_failure", "n_api_error", "valid_pred_rate", "parse_failure_rate", "api_error_rate"]


def _entry(subtask: Column, metric: str, value: str) -> Column:
    return F.struct(
        subtask.alias("subtask"), F.lit(metric).alias("metric"), F.col(value).cast("double").alias("value")
    )


def leaderboard(scored: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Every metric of every sub-task per key, long: (keys, subtask, metric, value).

    One aggregation over the responses and one over the rankings.
    """
    fields = {"peak_rss": "peak", "wall_time": "wall"}
    moments = [m for field in fields.values() for m in fit_moments(field)]
    one = with_outcome_figures(scored.groupBy(*keys).agg(*common_figures(), *outcome_sums(), *moments))
    for field in fields.values():
        one = one.withColumn(f"{field}_residual_std", residual_std(field))
    entries = [_entry(F.lit("outcome"), m, m) for m in OUTCOME_METRICS]
    entries += [_entry(F.lit(t), m, f"{field}_{m}") for t, field in fields.items() for m in FIT]
    entries += [_entry(F.lit(t), m, m) for t in HEADLINES for m in HEALTH]
    of_hot = aggregate_hot(hot, [*keys, "subtask"])
    ranked = [_entry(F.col("subtask"), m, m) for m in [*HOT_METRICS, "recall_at_5_top1_n"]]
    return one.select(*keys, F.inline(F.array(*entries))).unionByName(
        of_hot.select(*keys, F.inline(F.array(*ranked)))
    )


def rank_models(board: DataFrame, keys: list[str]) -> DataFrame:
    """Models per sub-task by its headline metric, missing values last, ties within 1e-9 all best.

    One row per (sub-task, model): the window's groups are as large as the number of models.
    """
    headline = F.coalesce(*[F.when(F.col("subtask") == t, F.lit(m)) for t, (m, _) in HEADLINES.items()])
    higher = F.coalesce(*[F.when(F.col("subtask") == t, F.lit(up)) for t, (_, up) in HEADLINES.items()])
    rows = board.where(F.col("metric") == headline)
    signed = F.when(higher, F.col("value")).otherwise(-F.col("value"))
    names = [F.col(k) for k in keys]
    rows = rows.withColumn("_signed", signed)
    by_task = Window.partitionBy("subtask")
    return (
        rows.withColumn("place", F.row_number().over(by_task.orderBy(F.col("_signed").desc_nulls_last(), *names)))
        .withColumn("best", F.coalesce(F.abs(F.col("_signed") - F.max("_signed").over(by_task)) < 1e-9, F.lit(False)))
        .drop("_signed")
    )


def predicted_outcomes(responses: DataFrame, keys: list[str]) -> DataFrame:
    """Predicted labels per key, anything else under other."""
    label = _label("pred_outcome")
    known = ["passed", "failed", "error"]
    return responses.groupBy(*keys).agg(
        *[F.count_if(label == k).alias(k) for k in known], F.count_if(~label.isin(known)).alias("other_or_none")
    )


def gt_distribution(responses: DataFrame, keys: list[str]) -> DataFrame:
    label = _label("gt_outcome")
    return responses.groupBy(*keys).agg(*[F.count_if(label == k).alias(k) for k in ("passed", "failed", "error")])


def top_predictions(responses: DataFrame, field: str, keys: list[str], n: int = 3) -> DataFrame:
    """Most frequent predicted values per key; ties go to the smaller value."""
    counts = responses.where(F.col(field).isNotNull()).groupBy(*keys, F.col(field).alias("value")).agg(
        F.count(F.lit(1)).alias("times")
    )
    return top_n(counts, keys, [F.col("times").desc(), F.col("value")], n, "place")


def scatter_pairs(responses: DataFrame, field: str) -> DataFrame:
    """Truth and prediction for plotting, never below zero."""
    both = responses.where(F.col(f"gt_{field}").isNotNull() & F.col(f"pred_{field}").isNotNull())
    return both.select(
        *RESPONSE,
        F.greatest(F.lit(0.0), F.col(f"gt_{field}")).alias("truth"),
        F.greatest(F.lit(0.0), F.col(f"pred_{field}")).alias("prediction"),
        "side",
    )
