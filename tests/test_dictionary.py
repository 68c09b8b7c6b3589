import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ridgeline.operators import profile as P
from ridgeline.operators.dictionary import DictionaryPrep, DictionaryPrepModel
from ridgeline.operators.prepare import TabularPrep


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_equal_to_the_preparation_with_categories_in_the_model(spark, tmp_path):
    rows = [(1, 1.0, "b", "x"), (2, None, None, "y"), (3, 4.0, "a", None), (4, 9.0, "b", "é"), (5, 2.0, "", "y")]
    df = spark.createDataFrame(rows, "_value int, n double, c string, d string")
    new = spark.createDataFrame([(6, 3.0, "zz", "x"), (7, None, "a", "no"), (8, 1.0, None, None), (8, 1.0, None, None)], df.schema)
    for scale in (False, True):
        a = TabularPrep(numericCols=["n"], categoricalCols=["c", "d"], scale=scale).fit(df)
        b = DictionaryPrep(numericCols=["n"], categoricalCols=["c", "d"], scale=scale).fit(df)
        b.write().overwrite().save(str(tmp_path / f"m{scale}"))
        for model in (b, DictionaryPrepModel.load(str(tmp_path / f"m{scale}"))):
            for table in (df, new, df.where("false")):
                want, got = ([(r[0], r[1]) for r in m.transform(table).select("_value", vector_to_array("features")).orderBy("_value").collect()]
                             for m in (a, model))
                assert [k for k, _ in want] == [k for k, _ in got]
                assert all(np.allclose(x, y) for (_, x), (_, y) in zip(want, got))


def test_columns_without_values_or_categories(spark):
    df = spark.createDataFrame([(1.0, None)], "n double, c string")
    assert DictionaryPrep(numericCols=["n"], categoricalCols=["c"]).fit(df).transform(df).first()["features"].toArray().tolist() == [1.0]
    assert DictionaryPrep(numericCols=["n"]).fit(df).transform(df).first()["features"].toArray().tolist() == [1.0]
    only = spark.createDataFrame([("q",), ("p",)], "c string")
    assert [r["features"].toArray().tolist() for r in DictionaryPrep(categoricalCols=["c"]).fit(only).transform(only).orderBy("c").collect()] == [[1, 0], [0, 1]]
    none = only.where("false")
    assert DictionaryPrep(categoricalCols=["c"]).fit(none).transform(only).first()["features"].size == 0


def test_a_hundred_thousand_categories(spark):
    n = 100_000
    df = spark.range(n + 50_000).select("id", F.when(F.col("id") < n, F.concat(F.lit("k"), F.col("id").cast("string")))
                                        .otherwise("k7").alias("c"), (F.col("id") % 5).cast("double").alias("x"))
    model = DictionaryPrep(numericCols=["x"], categoricalCols=["c"]).fit(df)
    assert len(model.getOrDefault("statistics")) < 1000  # no category travels in the model
    assert model.stats["sizes"] == {"c": n} and model.stats["modes"] == {"c": "k7"}
    out = model.transform(df).select("id", "x", F.unwrap_udt("features").alias("v")).select(
        "id", "x", "v.size", F.size("v.indices").alias("k"), F.col("v.indices")[1].alias("at"), F.col("v.values").alias("values"))
    assert out.count() == n + 50_000
    assert out.where(f"size != {n + 1} or k != 2 or values[0] != x or values[1] != 1").count() == 0
    places = {f"k{i}": at + 1 for at, i in enumerate(sorted(range(n), key=lambda i: f"k{i}"))}
    got = {r["id"]: r["at"] for r in out.where("id % 997 = 0 or id = 7 or id >= 149990").collect()}
    assert all(at == places[f"k{i}" if i < n else "k7"] for i, at in got.items())


def test_ranks_over_many_values_use_no_window(spark):
    df = spark.range(30_000).select(F.concat(F.lit("v"), F.col("id") % 20_000).alias("a"),
                                    F.when(F.col("id") % 3 > 0, F.concat(F.lit("w"), F.col("id") % 7)).alias("b"), F.lit("z").alias("c"))
    ranks = P.category_values(df, ["a", "b", "c"])
    assert "Window" not in _plan(ranks) and "Window" not in _plan(P.modes(df, ["a", "b"]))
    got = {}
    for r in ranks.collect():
        got.setdefault(r["column"], {})[r["value"]] = r["value_rank"]
    want = {"a": [f"v{i}" for i in range(20_000)], "b": [f"w{i}" for i in range(7)], "c": ["z"]}
    assert got == {k: {v: i + 1 for i, v in enumerate(sorted(vs))} for k, vs in want.items()}
    assert {r["column"]: (r["mode"], r["count"]) for r in P.modes(df, ["a", "c"]).collect()} == {"a": ("v0", 2), "c": ("z", 30_000)}
