import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array

from ridgeline.operators.prepare import TabularPrep


def _train(spark):
    return spark.createDataFrame(
        [(1.0, "High"), (2.0, "Low"), (3.0, "No"), (4.0, "Low"), (None, None)], "x double, g string")


def test_median_mode_scale_onehot(spark, tmp_path):
    m = TabularPrep(numericCols=["x"], categoricalCols=["g"], scale=True).fit(_train(spark))
    assert m.feature_names() == ["x", "g_High", "g_Low", "g_No"]
    st = m.stats
    assert st["numeric"]["x"]["median"] == 2.5
    assert st["categorical"]["g"]["mode"] == "Low"
    test = spark.createDataFrame([(None, "ZZ"), (2.5, None)], "x double, g string")
    rows = [r[0] for r in m.transform(test).select(vector_to_array("features")).collect()]
    imputed = [1.0, 2.0, 3.0, 4.0, 2.5]
    import numpy as np
    mu, sd = np.mean(imputed), np.std(imputed)
    assert rows[0][1:] == [0.0, 0.0, 0.0]          # unseen category -> zeros
    assert rows[1][1:] == [0.0, 1.0, 0.0]          # NULL -> mode
    assert abs(rows[0][0] - (2.5 - mu) / sd) < 1e-12  # population std of imputed column


def test_fit_ignores_test_rows(spark):
    """Held-out rows with other values, categories and gaps change nothing."""
    from ridgeline.operators.models import fit
    from ridgeline.operators.split import exact_split, train_test
    from ridgeline.spec import detect_roles

    rows = [(i, float(i % 7), "High" if i % 2 else "Low", float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, x double, g string, y double")
    train, test = train_test(exact_split(df, "id"))
    held = {r["id"] for r in test.select("id").collect()}
    assert 0 < len(held) < 60
    other = spark.createDataFrame([(i, 1e6, "Unseen", -1e6) if i in held else (i, x, g, y) for i, x, g, y in rows],
                                  "id long, x double, g string, y double")
    train2, _ = train_test(exact_split(other, "id"))
    spec = detect_roles(df, "y", id_cols=["id"])
    stats = [fit(spec, "decision_tree", t, maxDepth=2).stages[0].stats for t in (train, train2)]
    assert stats[0] == stats[1] and "Unseen" not in stats[0]["categorical"]["g"]["categories"]


def test_constant_column_scale_one(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    m = TabularPrep(numericCols=["x"], scale=True).fit(df)
    assert m.stats["numeric"]["x"]["scale"] == 1.0


def test_persistence_round_trip(spark, tmp_path):
    m = Pipeline(stages=[TabularPrep(numericCols=["x"], categoricalCols=["g"], scale=True)]).fit(_train(spark))
    path = str(tmp_path / "prep")
    m.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = [r[0] for r in m.transform(_train(spark)).select(vector_to_array("features")).collect()]
    b = [r[0] for r in loaded.transform(_train(spark)).select(vector_to_array("features")).collect()]
    assert a == b


def test_prepared_rows_have_no_vector_between(spark, tmp_path):
    """every feature is computed once, not once per element of a vector."""
    from datetime import datetime

    from ridgeline.plans.q_prepare import f7_prepared_rows

    rows = [(i, i % 7, i % 3, 1 + i % 4, float(i % 50), 900.0 + i, i % 11 / 100, i % 9 / 100, "ANR"[i % 3], "FO"[i % 2], datetime(1995, 1, 1 + i % 28))
            for i in range(200)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp") \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    out = f7_prepared_rows(spark, str(tmp_path))
    assert "UDF(" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.columns == ["rk", "is_train", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag_A", "l_returnflag_N",
                           "l_returnflag_R", "l_linestatus_F", "l_linestatus_O"]
    assert out.count() == 200 and out.where("l_returnflag_A + l_returnflag_N + l_returnflag_R <> 1").isEmpty()
