"""Batch scoring of applicant rows: input completion, score card, change
flags and domain checks.

The reference scores one row typed into a form; here the same rules run
over a table of applicants of any size. Everything is a projection or a
join against per-feature tables (one row per feature: bounded by the schema
width, so broadcasting them is safe); no per-row Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.exprs import clip

# Score range, tier cut-offs and labels.
SCORE_MIN, SCORE_MAX = 300, 800
TIERS = [(740, "Excellent"), (670, "Good"), (580, "Fair")]
LOWEST_TIER = "Poor"
CHANGE_TOLERANCE = 1e-6
CONSTANT_RANGE = 1e-9

# Feature-group rules, checked in this order; the first rule
# that matches names the group ("in" = name in list, "prefix+suffix" = both).
CORE_FINANCIALS = ["INCOME", "SAVINGS", "DEBT", "R_SAVINGS_INCOME", "R_DEBT_INCOME", "R_DEBT_SAVINGS"]
GROUP_RULES = [
    ("in", CORE_FINANCIALS, "Core Financials"),
    ("prefix+suffix", ("T_", "_12"), "Annual Spend ($)"),
    ("prefix+suffix", ("T_", "_6"), "Semi-Annual Spend ($)"),
    ("suffix", "_INCOME", "Ratio to Income"),
    ("suffix", "_DEBT", "Ratio to Debt"),
    ("suffix", "_SAVINGS", "Ratio to Savings"),
    ("prefix", "CAT_", "Binary Flags"),
]
OTHER_GROUP = "Other Ratios"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def complete_inputs(applicants: DataFrame, feature_cols: list[str], defaults: dict[str, float],
                    categories: dict[str, list[str]], keep: list[str] | None = None) -> DataFrame:
    """Every feature column, in order: the given value, else the median
    default, else the first category, else 0.0. Absent columns are added."""
    keep = keep or []
    present = set(applicants.columns)
    out = [_c(k) for k in keep]
    for f in feature_cols:
        given = _c(f) if f in present else None
        if f in defaults:
            fill = F.lit(float(defaults[f]))
            val = F.coalesce(given.cast("double"), fill) if given is not None else fill
        elif f in categories:
            fill = F.lit(categories[f][0] if categories[f] else "")
            val = F.coalesce(given.cast("string"), fill) if given is not None else fill
        else:
            fill = F.lit(0.0)
            val = F.coalesce(given, fill) if given is not None else fill
        out.append(val.alias(f))
    return applicants.select(*out)


def tier(score_int: Column) -> Column:
    """Tier label from the clipped integer score."""
    expr = None
    for cut, label in TIERS:
        expr = F.when(score_int >= cut, label) if expr is None else expr.when(score_int >= cut, label)
    return expr.otherwise(LOWEST_TIER)


def score_card(scored: DataFrame, prediction: str, dataset_mean: float | Column,
               keep: list[str] | None = None) -> DataFrame:
    """Clipped half-even integer score, position in range, difference
    to the dataset mean (signed label, above/below), tier."""
    keep = keep or []
    s = clip(F.col(prediction).cast("double"), float(SCORE_MIN), float(SCORE_MAX))
    score_int = F.bround(s, 0).cast("int")
    mean = dataset_mean if isinstance(dataset_mean, Column) else F.lit(float(dataset_mean))
    delta = score_int - F.bround(mean, 0).cast("int")
    return scored.select(
        *[_c(k) for k in keep],
        score_int.alias("score"),
        clip((score_int - SCORE_MIN) / float(SCORE_MAX - SCORE_MIN), 0.0, 1.0).alias("position"),
        delta.alias("delta"),
        F.when(delta >= 0, F.concat(F.lit("+"), delta.cast("string"))).otherwise(delta.cast("string"))
        .alias("delta_label"),
        F.when(delta >= 0, "above").otherwise("below").alias("direction"),
        tier(score_int).alias("tier"))


def _long_inputs(applicants: DataFrame, key: str, numeric: list[str], categorical: list[str]) -> DataFrame:
    items = [F.struct(F.lit(f).alias("feature"), _c(f).cast("double").alias("num_value"),
                      F.lit(None).cast("string").alias("str_value")) for f in numeric]
    items += [F.struct(F.lit(f).alias("feature"), F.lit(None).cast("double").alias("num_value"),
                       _c(f).cast("string").alias("str_value")) for f in categorical]
    return applicants.select(_c(key).alias("row_id"), F.inline(F.array(*items))) \
        .filter(F.col("num_value").isNotNull() | F.col("str_value").isNotNull())


def change_flags(applicants: DataFrame, key: str, numeric: list[str], categorical: list[str],
                 defaults: DataFrame) -> DataFrame:
    """One row per given (non-NULL) input: value, default, changed flag.
    Numeric: |value - default| > 1e-6. A categorical input has no median
    default, so it always counts as changed (the reference compares it with
    the text "N/A"). ``defaults`` is (feature, default), one row per feature."""
    long = _long_inputs(applicants, key, numeric, categorical)
    j = long.join(F.broadcast(defaults.select("feature", "default")), "feature", "left")
    changed = F.when(F.col("str_value").isNotNull(), F.lit(True)).otherwise(
        F.coalesce(F.abs(F.col("num_value") - F.col("default")) > CHANGE_TOLERANCE, F.lit(False)))
    return j.select("row_id", "feature", "num_value", "str_value", "default", changed.alias("changed"))


def change_counts(flags: DataFrame, n_features: int) -> DataFrame:
    """Per applicant: changed inputs, shown (given) inputs, auto-filled."""
    return flags.groupBy("row_id").agg(
        F.count_if(F.col("changed")).alias("n_changed"),
        F.count(F.lit(1)).alias("n_shown")).select(
        "row_id", "n_changed", "n_shown", (F.lit(n_features) - F.col("n_shown")).alias("n_auto_filled"))


def feature_group(name: Column) -> Column:
    """Group label from a feature name (rules in order, first match)."""
    expr = None
    for kind, pat, label in GROUP_RULES:
        if kind == "in":
            cond = name.isin(pat)
        elif kind == "prefix+suffix":
            cond = name.startswith(pat[0]) & name.endswith(pat[1])
        elif kind == "suffix":
            cond = name.endswith(pat)
        else:
            cond = name.startswith(pat)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(OTHER_GROUP)


def group_rollup(ranges: DataFrame) -> DataFrame:
    """Feature-range table rolled up by feature group."""
    g = ranges.withColumn("feature_group", feature_group(F.col("feature")))
    return g.groupBy("feature_group").agg(
        F.count(F.lit(1)).alias("n_features"), F.min("min").alias("min_of_min"),
        F.max("max").alias("max_of_max"), F.avg("std").alias("avg_std"))


def key_features(importance: DataFrame, features: DataFrame, k: int = 12,
                 fallback: DataFrame | None = None) -> DataFrame:
    """Features ranked by importance that exist in the feature table,
    first k; categorical features are always exposed (all of them when none
    made the list). ``features`` is (feature, kind). When the importance table
    is empty, ``fallback`` (feature, rank) is used (K9: top-k by std)."""
    ranked = importance.join(features, "feature", "left_semi")
    if fallback is not None:
        none = fallback.join(importance.limit(1), F.lit(True), "left_anti")  # rows only without importances
        ranked = ranked.select("feature", "rank").unionByName(none.select("feature", "rank"))
    top = ranked.orderBy("rank").limit(k).join(features, "feature")
    cats = features.filter(F.col("kind") == "categorical").select(
        "feature", F.lit(None).cast("long").alias("rank"), "kind")
    missing_cats = cats.join(top.filter(F.col("kind") == "categorical"), "feature", "left_anti")
    add = missing_cats.join(top.filter(F.col("kind") == "categorical").limit(1).select(F.lit(1).alias("_any")),
                            F.lit(True), "left_anti")
    return top.select("feature", F.col("rank").cast("long").alias("rank"), "kind").unionByName(add)


def remaining_features(features: DataFrame, primary: DataFrame) -> DataFrame:
    """Numeric features that are not key features (set difference)."""
    return features.filter(F.col("kind") == "numeric").join(primary, "feature", "left_anti") \
        .select("feature")


def domain_check(applicants: DataFrame, key: str, numeric: list[str], ranges: DataFrame) -> DataFrame:
    """Each given numeric input against the training [min, max]; the
    default clipped into range; constant features (range < 1e-9) flagged."""
    long = _long_inputs(applicants, key, numeric, []).select("row_id", "feature", "num_value")
    r = F.broadcast(ranges.select("feature", "min", "max", "median"))  # one row per feature
    j = long.join(r, "feature")
    v = F.col("num_value")
    return j.select(
        "row_id", "feature", v.alias("value"), "min", "max",
        v.between(F.col("min"), F.col("max")).alias("in_range"),
        clip(F.col("median"), F.col("min"), F.col("max")).alias("default_clipped"),
        (F.abs(F.col("max") - F.col("min")) < CONSTANT_RANGE).alias("is_constant"))
