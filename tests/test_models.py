import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ridgeline.operators import models as M
from ridgeline.operators.split import fold_column
from ridgeline.sources.fixtures import modelling_table, mt_spec
from ridgeline.spec import FeatureSpec
from tests.conftest import SF001


def _mt(spark):
    mt = modelling_table(spark, SF001)
    return mt, mt_spec(mt), mt.filter("bucket >= 2000"), mt.filter("bucket < 2000")


def test_tree_leaf_is_mean_label(spark):
    mt, spec, train, test = _mt(spark)
    model = M.fit(spec, "decision_tree", train, maxDepth=3, minInstancesPerNode=10)
    out = model.transform(train.filter(F.col(spec.target).isNotNull()))
    # every leaf predicts the mean training label of its rows
    g = out.groupBy("prediction").agg(F.avg(spec.target).alias("m")).collect()
    assert all(abs(r["prediction"] - r["m"]) < 1e-6 * max(1.0, abs(r["m"])) for r in g)


def test_ols_residuals_orthogonal(spark):
    mt, spec, train, test = _mt(spark)
    model = M.fit(spec, "linear_regression", train)
    pdf = model.transform(train).select(vector_to_array("features").alias("x"), spec.target, "prediction").toPandas()
    Xs = np.stack(pdf["x"].to_numpy())
    res = pdf[spec.target].to_numpy() - pdf["prediction"].to_numpy()
    assert abs(res.mean()) < 1e-6 * np.abs(pdf[spec.target]).mean()
    assert np.max(np.abs(Xs.T @ res) / len(res)) < 1e-4 * np.abs(pdf[spec.target]).mean()


def test_cv_metric_is_mean_of_manual_folds(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    mt, spec, train, test = _mt(spark)
    train = train.withColumn("fold", fold_column("rk").cast("int"))
    grid = {"maxDepth": [2, 3], "minInstancesPerNode": [5]}
    cvm, maps = M.cross_validate(spec, "decision_tree", train, grid, parallelism=2)
    ev = RegressionEvaluator(labelCol=spec.target, metricName="rmse")
    lab = train.filter(F.col(spec.target).isNotNull())
    manual = []
    for k in range(5):
        m = M.fit(spec, "decision_tree", lab.filter(F.col("fold") != k), maxDepth=2, minInstancesPerNode=5)
        manual.append(ev.evaluate(m.transform(lab.filter(F.col("fold") == k))))
    assert abs(cvm.avgMetrics[0] - np.mean(manual)) < 1e-9
    t = M.best_params_table(spark, cvm, maps, "decision_tree").collect()
    assert {r["param"] for r in t} == {"maxDepth", "minInstancesPerNode"}


def test_ols_min_norm_matches_numpy(spark):
    from pyspark.ml.linalg import Vectors
    from ridgeline.operators.ols import OLSRegressor
    rng = np.random.default_rng(5)
    X = rng.normal(size=(200, 3))
    d = (rng.random(200) < 0.5).astype(float)
    Xf = np.column_stack([X, d, 1 - d])  # two dummies + intercept: rank deficient
    y = X @ [1.0, -2.0, 0.5] + 3 * d + rng.normal(size=200) * 0.1
    df = spark.createDataFrame([(Vectors.dense(r.tolist()), float(v)) for r, v in zip(Xf, y)], ["features", "label"])
    m = OLSRegressor().fit(df)
    Xc = Xf - Xf.mean(0)
    ref = np.linalg.lstsq(Xc, y - y.mean(), rcond=None)[0]
    assert np.max(np.abs(np.array(m.coef) - ref)) < 1e-8
    got = np.array([r[0] for r in m.transform(df).select("prediction").collect()])
    want = Xf @ ref + (y.mean() - Xf.mean(0) @ ref)
    assert np.max(np.abs(got - want)) < 1e-8


def test_models_do_not_depend_on_input_partitions(spark):
    mt, spec, train, test = _mt(spark)
    for kind, params in (("random_forest", {"numTrees": 5, "maxDepth": 4}),
                         ("xgboost", {"maxIter": 4, "maxDepth": 3, "subsamplingRate": 0.5})):
        sums = [M.fit(spec, kind, train.repartition(n), **params).transform(test).agg(F.sum("prediction")).first()[0]
                for n in (2, 8)]
        assert abs(sums[0] - sums[1]) < 1e-6 * abs(sums[0]), kind


def test_tree_grid_equals_separate_fits(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    mt, spec, train, test = _mt(spark)
    train = train.withColumn("fold", fold_column("rk").cast("int"))
    grid = {"maxDepth": [2, 4], "minInstancesPerNode": [3, 20], M.SPLIT: [2, 2000]}
    cvm, points = M.cross_validate(spec, "decision_tree", train, grid, parallelism=2)
    assert len(points) == len(cvm.avgMetrics) == 8
    rows = M.fit_rows(spec, train, ["fold"])
    ev = RegressionEvaluator(labelCol=spec.target, metricName="rmse")
    for d in (2, 4):
        for n in (3, 20):
            want = []
            for k in range(5):
                m = M.build_pipeline(spec, "decision_tree", maxDepth=d, minInstancesPerNode=n).fit(rows.filter(F.col("fold") != k))
                want.append(ev.evaluate(m.transform(rows.filter(F.col("fold") == k))))
            i = points.index({"maxDepth": d, "minInstancesPerNode": n, M.SPLIT: 2})
            assert abs(cvm.avgMetrics[i] - np.mean(want)) < 1e-9
    by = {p["maxDepth"]: cvm.avgMetrics[i] for i, p in enumerate(points) if p["minInstancesPerNode"] == 3 and p[M.SPLIT] == 2000}
    full = {p["maxDepth"]: cvm.avgMetrics[i] for i, p in enumerate(points) if p["minInstancesPerNode"] == 3 and p[M.SPLIT] == 2}
    assert by[4] != full[4]  # the split minimum cuts the deeper tree
    params = {r["param"] for r in M.best_params_table(spark, cvm, points, "decision_tree").collect()}
    assert params == {"maxDepth", "minInstancesPerNode", M.SPLIT}


def _separate(spec, kind, rows, folds=5, **params):
    from pyspark.ml.evaluation import RegressionEvaluator
    ev = RegressionEvaluator(labelCol=spec.target, metricName="rmse")
    return np.mean([ev.evaluate(M.build_pipeline(spec, kind, **params).fit(rows.filter(F.col("fold") != k))
                                .transform(rows.filter(F.col("fold") == k))) for k in range(folds)])


def test_boosting_grid_equals_separate_fits(spark):
    mt, spec, train, test = _mt(spark)
    train = train.withColumn("fold", fold_column("rk").cast("int") % 2)
    grid = {"maxIter": [2, 5], "maxDepth": [2], "stepSize": [0.1, 0.3], "subsamplingRate": [0.8], "featureSubsetStrategy": ["all"]}
    cvm, points = M.cross_validate(spec, "xgboost", train, grid, parallelism=2, folds=2)
    assert len(points) == 4 and len(M.grid_points(M.GBT_GRID)) == 72
    rows = M.fit_rows(spec, train, ["fold"])
    for i, p in enumerate(points):
        if p["stepSize"] == 0.3:
            assert abs(cvm.avgMetrics[i] - _separate(spec, "xgboost", rows, 2, **p)) < 1e-9
    got = cvm.bestModel.stages[-1]
    assert got.getNumTrees == points[cvm.bestIndex]["maxIter"]


def test_forest_grid_and_refit(spark):
    from ridgeline.operators.explain import ensemble
    from ridgeline.operators.tree_grid import cut_model, prefix_errors, truncated_predictions

    mt, spec, train, test = _mt(spark)
    train = train.withColumn("fold", fold_column("rk").cast("int") % 2)
    grid = {"numTrees": [2, 4], "maxDepth": [3, 6], M.SPLIT: [2, 400], "minInstancesPerNode": [5]}
    cvm, points = M.cross_validate(spec, "random_forest", train, grid, parallelism=2, folds=2)
    assert len(points) == 8 and len(M.grid_points(M.RF_GRID)) == 54
    rows = M.fit_rows(spec, train, ["fold"])
    i = points.index({"numTrees": 4, "maxDepth": 3, M.SPLIT: 2, "minInstancesPerNode": 5})
    assert abs(cvm.avgMetrics[i] - _separate(spec, "random_forest", rows, 2, numTrees=4, maxDepth=3, minInstancesPerNode=5)) < 1e-9
    # a cut model predicts what the truncated walk says, and survives saving
    for kind, params in (("random_forest", {"numTrees": 3, "maxDepth": 5}), ("decision_tree", {"maxDepth": 6})):
        model = M.build_pipeline(spec, kind, **params).fit(rows)
        x = model.stages[0].transform(test).select("features", spec.target).limit(300)
        cut = cut_model(spark, model.stages[-1], 300)
        got = np.array([r.prediction for r in cut.transform(x).collect()])
        X, y = (np.array(v) for v in zip(*[(r[0].toArray(), float(r[1])) for r in x.collect()]))
        trees = ensemble(spark, model.stages[-1])
        want = np.mean([truncated_predictions(t, X, [30], [300])[0, 0] for t in trees], axis=0)
        assert np.abs(got - want).max() < 1e-9
        assert abs(prefix_errors(trees, True, X, y, [len(trees)], [30], [300])[0, 0, 0] - ((want - y) ** 2).sum()) < 1e-6 * ((want - y) ** 2).sum()
        assert cut.totalNumNodes < model.stages[-1].totalNumNodes if kind == "random_forest" else cut.numNodes < model.stages[-1].numNodes
    best = M.refit(M.build_pipeline(spec, "decision_tree"), M.build_pipeline(spec, "decision_tree").getStages()[-1], rows,
                   {"maxDepth": 4, "minInstancesPerNode": 5, M.SPLIT: 200}).stages[-1]
    assert all(t.cover[t.left >= 0].min() >= 200 for t in ensemble(spark, best))


def test_predictions_of_all_models_in_one_scan(spark):
    mt, spec, train, test = _mt(spark)
    models = {"linear_regression": M.fit(spec, "linear_regression", train), "decision_tree": M.fit(spec, "decision_tree", train, maxDepth=3),
              "xgboost": M.fit(spec, "xgboost", train, maxIter=3, maxDepth=2)}
    got = M.predict_all(models, test, "rk", spec.target)
    assert got._jdf.queryExecution().toString().count("Scan parquet") <= 3 * test._jdf.queryExecution().toString().count("Scan parquet")
    got = {(r.model, r.rk): (r.y, r.p) for r in got.collect()}
    for name, model in models.items():
        for r in M.predict(model, test, "rk", label=spec.target, name=name).collect():
            assert got[name, r.rk] == pytest.approx((r.y, r.p), rel=1e-12)
    assert len(got) == 3 * test.count()


def test_boosting_stops_where_the_held_out_rows_say(spark):
    from ridgeline.operators.split import validation_flag
    mt, spec, train, test = _mt(spark)
    train = train.withColumn("is_val", validation_flag("rk"))
    params = {"maxDepth": 3, "stepSize": 0.3}
    model = M.fit_early_stopped(spec, train, "is_val", maxIter=40, validationTol=0.0, **params)
    kept = model.stages[-1].getNumTrees
    assert 1 < kept < 40
    curve = M.boosting_curve(spec, model, train.filter("is_val"))
    assert len(curve) == kept and curve[-1] == min(curve)
    # the held-out rows decide when to stop and nothing else: the same rounds grown without them
    rows = M.fit_rows(spec, train, ["is_val"])
    prep, boosting = M.build_pipeline(spec, "xgboost", maxIter=kept, **params).getStages()
    vectors = prep.fit(rows).transform(rows)
    plain = boosting.fit(vectors.filter("not is_val"))
    a = model.transform(test).agg(F.sum("prediction")).first()[0]
    b = plain.transform(model.stages[0].transform(test)).agg(F.sum("prediction")).first()[0]
    assert abs(a - b) < 1e-6 * abs(a)
    assert abs(curve[-1] - plain.transform(vectors.filter("is_val")).agg(
        F.sqrt(F.avg(F.pow(F.col("prediction") - F.col(spec.target), 2)))).first()[0]) < 1e-6 * curve[-1]
    again = M.fit_early_stopped(spec, train.repartition(7), "is_val", maxIter=40, validationTol=0.0, **params)
    assert again.stages[-1].getNumTrees == kept


def test_a_deep_tree_keeps_the_node_of_each_row_and_is_the_same_tree(spark):
    df = spark.createDataFrame([(float(i * 7919 % 1009), float(i * 31 % 97), float(i * i % 251)) for i in range(1500)],
                               "a double, b double, y double")
    spec = FeatureSpec("y", ("a", "b"), ("a", "b"), ())
    x = M.build_pipeline(spec, "decision_tree").getStages()[0].fit(df).transform(df)
    tree = M.regressor("decision_tree", "y", maxDepth=20)
    assert tree.getCacheNodeIds()
    text = [tree.copy({tree.cacheNodeIds: c}).fit(x).toDebugString.split("\n", 1)[1] for c in (True, False)]
    assert text[0] == text[1]
