import numpy as np

from ridgeline.operators import curves as C


def test_whiskers_are_clamped_to_the_box(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 2.0), ("g", 3.0), ("g", 100.0), ("h", 7.0), (None, 1.0), ("g", None)], "c string, y double")
    r = {x["category"]: x for x in C.box_stats(df, "c", "y").collect()}
    assert r["g"]["whisker_hi"] == r["g"]["q3"] == 27.25 and r["g"]["whisker_lo"] == 1.0 and r["g"]["n_outliers"] == 1
    assert r["h"]["whisker_lo"] == r["h"]["whisker_hi"] == 7.0
    assert [x["y"] for x in C.box_outliers(df.withColumnRenamed("c", "k"), "k", "y", "k").collect()] == [100.0]
    assert C.box_stats(df.where("false"), "c", "y").count() == 0


def test_kde_is_the_exact_kernel_sum(spark):
    rng = np.random.default_rng(1)
    y = np.concatenate([rng.normal(size=700), rng.normal(8, 0.2, size=100), [60.0]])  # an outlier far from the rest
    rows = [("a" if i % 3 else "b", float(v)) for i, v in enumerate(y)] + [("one", 1.0), ("same", 2.0), ("same", 2.0)]
    df = spark.createDataFrame(rows, "c string, y double").repartition(5)

    def exact(v, x):
        h = v.std(ddof=1) * len(v) ** -0.2
        return np.exp(-0.5 * ((x[:, None] - v[None, :]) / h) ** 2).sum(axis=1) / (len(v) * h * np.sqrt(2 * np.pi))

    pdf = C.kde_curve(df.where("c in ('a', 'b')"), "y", grid=120).orderBy("k").toPandas()
    want = exact(y, pdf["x"].to_numpy())
    assert len(pdf) == 120 and np.max(np.abs(pdf["density"] - want)) < 1e-9 * want.max()
    v = C.violin_density(df, "c", "y", grid=50).orderBy("category", "k").toPandas()
    assert v.groupby("category").size().to_dict() == {"a": 50, "b": 50, "one": 50, "same": 50}
    for c in "ab":
        g = v[v.category == c]
        own = np.array([b for a, b in rows if a == c])
        want = exact(own, g["x"].to_numpy())
        assert np.max(np.abs(g["density"] - want)) < 1e-9 * want.max()
    assert v[v.category.isin(["one", "same"])]["density"].isna().all()  # no bandwidth
    assert C.kde_curve(df.where("false"), "y").count() == 0


def test_a_hundred_thousand_groups(spark):
    from pyspark.sql import functions as F

    from ridgeline.operators.evaluate import grouped_histogram
    from ridgeline.operators.grouped import grouped_quantiles
    n = 100_000
    # group i holds i % 7 + 1 values, and one group a third of all rows with few values
    many = spark.range(n).select(F.concat(F.lit("g"), "id").alias("g"), F.explode(F.sequence(F.lit(0), (F.col("id") % 7).cast("int"))).alias("i"))
    many = many.select("g", (F.col("i") * F.col("i") - 3.0).alias("v"))
    hot = spark.range(200_000).select(F.lit("hot").alias("g"), (F.col("id") % 11).cast("double").alias("v"))
    d = many.unionByName(hot)
    got = {r["g"]: r for r in grouped_quantiles(d, [0.25, 0.5, 0.9]).collect()}
    assert len(got) == n + 1
    want = {k: np.quantile([i * i - 3.0 for i in range(k)], [0.25, 0.5, 0.9]) for k in range(1, 8)}
    for i in range(n):
        r = got[f"g{i}"]
        assert r["n"] == i % 7 + 1 and np.allclose([r["q0"], r["q1"], r["q2"]], want[i % 7 + 1])
    r = got["hot"]
    assert r["n"] == 200_000 and np.allclose([r["q0"], r["q1"], r["q2"]], np.quantile(np.arange(200_000) % 11, [0.25, 0.5, 0.9]))
    boxes = C.box_stats(d, "g", "v").agg(F.count(F.lit(1)), F.sum("n")).first()
    assert tuple(boxes) == (n + 1, d.count())
    assert grouped_histogram(d, "g", "v", 2).agg(F.count(F.lit(1)), F.sum("count")).first()[:] == (2 * (n + 1), d.count())


def test_parameters_that_are_not_broadcast(spark, monkeypatch):
    from ridgeline.operators import grouped
    monkeypatch.setattr(grouped, "BROADCAST_BYTES", 0)
    test_whiskers_are_clamped_to_the_box(spark)
    test_kde_is_the_exact_kernel_sum(spark)
