import math

from pyspark.sql import functions as F

from ridgeline.operators import profile as P
from ridgeline.spec import detect_roles


def test_even_median_and_describe(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    d = P.describe(df, ["x"]).first()
    assert d["p50"] == 2.5 and d["count"] == 4
    assert abs(d["std"] - 1.2909944487358056) < 1e-12  # ddof = 1


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,), (None,), (None,)], "c string")
    assert P.modes(df, ["c"]).first()["mode"] == "a"


def test_nan_normalised_then_counted(spark):
    from ridgeline.sources.tables import normalize_missing

    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double")
    nc = P.null_counts(normalize_missing(df)).first()
    assert nc["missing_count"] == 2


def test_duplicates_null_equal(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "x int")
    assert P.duplicate_count(df).first()["n_duplicates"] == 2


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "c double, y double")
    r = P.target_correlations(df, ["c"], "y").first()["r"]
    assert r is None


def test_pairwise_null_correlation(spark):
    rows = [(1.0, 2.0), (2.0, 4.1), (None, 5.0), (4.0, 8.2), (5.0, None), (6.0, 11.9)]
    df = spark.createDataFrame(rows, "x double, y double")
    r = P.target_correlations(df, ["x"], "y").first()["r"]
    import numpy as np
    xs = np.array([1, 2, 4, 6.0]); ys = np.array([2, 4.1, 8.2, 11.9])
    assert abs(r - np.corrcoef(xs, ys)[0, 1]) < 1e-12


def test_overview_roles(spark):
    df = spark.createDataFrame([(1, "a", 2.0, 10.0, 0), (2, "b", None, 12.0, 1)],
                               "CUST_ID int, G string, X double, SCORE double, DEFAULT int")
    spec = detect_roles(df, "SCORE", id_cols=["CUST_ID"], exclude_cols=["DEFAULT"])
    assert spec.numeric == ("X",) and spec.categorical == ("G",)
    o = P.overview(df, spec).first()
    assert o["total_rows"] == 2 and o["n_missing_total"] == 1 and o["n_duplicates"] == 0
    assert o["target_median"] == 11.0


def test_missing_target_raises(spark):
    import pytest
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        detect_roles(df, "SCORE")


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-2.5,)], "x double")
    got = [r[0] for r in df.select(F.bround("x", 0)).collect()]
    assert got == [2.0, 4.0, -2.0]


def test_top_abs_and_missing_table(spark):
    df = spark.createDataFrame([(1.0, None, 1.0), (2.0, 1.0, 2.0), (3.0, None, 3.5)], "a double, b double, y double")
    mt = P.missing_table(df, ["a", "b", "y"]).collect()
    assert [(r["column"], r["missing_count"], r["missing_pct"]) for r in mt] == [("b", 2, 66.6667)]
    top = P.top_abs(P.target_correlations(df, ["a", "b"], "y"), 1).collect()
    assert top[0]["feature"] == "a"


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    h = {r["bin"]: r["count"] for r in __import__("ridgeline.operators.curves", fromlist=["x"]).histogram(df, "x", 5).collect()}
    assert sum(h.values()) == 11 and h[4] == 3


def test_kde_close_to_exact(spark):
    import numpy as np
    from ridgeline.operators.curves import kde_curve
    rng = np.random.default_rng(1)
    xs = rng.normal(size=2000)
    df = spark.createDataFrame([(float(v),) for v in xs], "x double")
    out = kde_curve(df, "x", grid=50).orderBy("k").collect()
    h = xs.std(ddof=1) * len(xs) ** -0.2
    worst = 0.0
    for r in out:
        exact = np.exp(-0.5 * ((r["x"] - xs) / h) ** 2).sum() / (len(xs) * h * math.sqrt(2 * math.pi))
        worst = max(worst, abs(exact - r["density"]))
    peak = max(r["density"] for r in out)
    assert worst < 1e-3 * peak


def test_tables_without_categories_or_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0)], "x double, y double")
    assert P.category_values(df, []).count() == 0 and P.modes(df, []).count() == 0
    assert P.null_counts(df, []).count() == 0 and P.null_counts(df).count() == 2
    assert P.duplicate_count(df.unionAll(df)).first()[0] == 2
    none = df.where("false")
    assert P.duplicate_count(none).first()[0] == 0
    assert P.describe(none, ["x"]).first()["p50"] is None
    one = P.describe(df.limit(1), ["x"]).first()
    assert one["p25"] == one["p75"] == one["min"] and one["std"] is None


def test_duplicates_tell_nulls_apart(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (1, None), (None, None)], "a int, b int")
    assert P.duplicate_count(df).first()[0] == 1


def test_ranges_from_the_fit_equal_ranges_of_the_imputed_rows(spark):
    from ridgeline.operators.prepare import TabularPrep, impute_numeric

    df = spark.createDataFrame([(float(i) if i % 3 else None, float(i * i)) for i in range(20)] + [(float("nan"), None)], "x double, z double")
    stats = TabularPrep(numericCols=["x", "z"]).fit(df).stats
    a = P.fitted_ranges(spark, stats, ["x", "z"]).collect()
    med = {k: v["median"] for k, v in stats["numeric"].items()}
    clean = df.selectExpr("if(isnan(x), null, x) x", "z")
    b = P.feature_ranges(impute_numeric(clean, med), ["x", "z"]).collect()
    for r, s in zip(a, b):
        assert r["feature"] == s["feature"]
        for k in ("min", "max", "median", "mean", "std"):
            assert abs(r[k] - s[k]) < 1e-9, k
