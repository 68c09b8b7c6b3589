import math

import numpy as np
import pytest

from ridgeline.operators import quantiles as Q

PROBS = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]


def frame(spark, cols, parts):
    rows = [tuple(None if v is None else float(v) for v in r) for r in zip(*cols.values())]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(parts)


@pytest.mark.parametrize("parts", [2, 7])
def test_exact_quantiles_match_numpy(spark, monkeypatch, parts):
    monkeypatch.setattr(Q, "SMALL", 40)      # force several rounds
    monkeypatch.setattr(Q, "ACCURACY", 100)
    rng = np.random.default_rng(7)
    n = 4500
    cols = {
        "skew": np.concatenate([rng.lognormal(size=3000), np.full(1500, 2.5)]),  # a hot value: a third of rows
        "ties": rng.integers(0, 5, size=n).astype(float),
        "decades": 10.0 ** rng.uniform(-150, 150, size=n),
        "gaps": [None if x < 0.3 else (float("nan") if x < 0.4 else x) for x in rng.random(n)],
        "same": np.full(n, 3.25),
    }
    got = Q.exact_quantiles(frame(spark, cols, parts), list(cols), PROBS)
    for name, arr in cols.items():
        arr = np.array([x for x in arr if x is not None and not math.isnan(x)])
        assert np.allclose(got[name], np.quantile(arr, PROBS), rtol=1e-12, atol=0), name


def test_infinite_empty_one_row_and_nan(spark):
    inf = float("inf")
    cols = {"a": [1.0, inf, -inf, 2.0], "b": [None] * 4, "c": [None, None, 5.0, None], "d": [1.0, 2.0, float("nan"), None]}
    got = Q.exact_quantiles(frame(spark, cols, 2), list(cols), [0.0, 0.5, 1.0])
    assert got == {"a": [-inf, 1.5, inf], "b": [None] * 3, "c": [5.0] * 3, "d": [1.0, 1.5, 2.0]}
    none = frame(spark, cols, 1).where("false")
    assert Q.exact_quantiles(none, ["a"], [0.5]) == {"a": [None]}
    assert Q.exact_quantiles_by(none.selectExpr("cast(a as string) g", "a v"), "g", "v", [0.5]) == {}


@pytest.mark.parametrize("parts", [2, 7])
def test_grouped_quantiles_hot_group(spark, monkeypatch, parts):
    monkeypatch.setattr(Q, "SMALL", 30)
    monkeypatch.setattr(Q, "GRID", 10)
    rng = np.random.default_rng(11)
    g = np.where(rng.random(3000) < 0.6, "hot", np.where(rng.random(3000) < 0.5, "b", "c"))
    v = np.where(rng.random(3000) < 0.3, 1.0, 10.0 ** rng.uniform(-100, 100, size=3000))
    rows = [(str(a), float(b)) for a, b in zip(g, v)] + [("one", 4.0), ("b", float("nan")), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(parts)
    got = Q.exact_quantiles_by(df, "g", "v", [0.25, 0.5, 0.75])
    assert got["one"] == (1, [4.0] * 3)
    for key in ("hot", "b", "c"):
        assert got[key][0] == int((g == key).sum())
        assert np.allclose(got[key][1], np.quantile(v[g == key], [0.25, 0.5, 0.75]), rtol=1e-12, atol=0)


def test_sketches_of_wide_tables_stay_small(spark, monkeypatch):
    """One task merges a sketch per column, rank and partition."""
    sizes, sketch = [], Q.F.percentile_approx
    monkeypatch.setattr(Q.F, "percentile_approx", lambda v, p, accuracy: (sizes.append(accuracy), sketch(v, p, accuracy))[1])
    rng = np.random.default_rng(3)
    cols = {"a": rng.normal(size=20_000), "b": np.round(rng.normal(size=20_000), 1)}
    got = Q.exact_quantiles(frame(spark, cols, 3), list(cols), PROBS)
    for name, arr in cols.items():
        assert np.allclose(got[name], np.quantile(arr, PROBS), rtol=1e-12, atol=0), name
    assert sizes and max(sizes) <= 1000
