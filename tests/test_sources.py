from pyspark.sql import functions as F

from ridgeline.sources import tables as S
from ridgeline.spec import detect_roles, role_table


def test_csv_na_tokens_and_inference(spark, tmp_path):
    p = tmp_path / "d.csv"
    p.write_text("id,x,g,flag\n1,1.5,High,0\n2,NA,N/A,1\n3,,Low,1\n4,2.0,null,0\n")
    df = S.read_csv(spark, str(p))
    types = dict(df.dtypes)
    assert types["id"] == "bigint" and types["x"] == "double" and types["g"] == "string"
    assert df.filter(F.col("x").isNull()).count() == 2 and df.filter(F.col("g").isNull()).count() == 2
    spec = detect_roles(df, "x", id_cols=["id"])
    assert spec.categorical == ("g",) and spec.numeric == ("flag",)
    roles = {r["column"]: r["role"] for r in role_table(spark, df, spec).collect()}
    assert roles == {"id": "id", "x": "target", "g": "categorical", "flag": "numeric"}


def test_json_round_trip_and_default(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5, ["x", "y"])], "k string, v double, l array<string>")
    path = str(tmp_path / "j")
    S.write_table(df, path, "json")
    back = S.read_json(spark, path, multi_line=False, schema="k string, v double, l array<string>")
    assert back.collect() == df.collect()
    missing = S.read_or_default(spark, str(tmp_path / "nope"), "k string", fmt="json", default_rows=[("unknown",)])
    assert missing.collect()[0]["k"] == "unknown"
    assert S.to_json_records(df).first()["json"] == '{"k":"a","v":1.5,"l":["x","y"]}'


def test_csv_write_read(spark, tmp_path):
    df = spark.createDataFrame([("f1", 1.0), ("f2", None)], "feature string, default double")
    path = str(tmp_path / "c")
    S.write_table(df, path, "csv")
    back = S.read_csv(spark, path, schema="feature string, default double")
    assert sorted(back.collect()) == sorted(df.collect())


def test_csv_numbers_are_typed_by_how_they_are_written(spark, tmp_path):
    p = tmp_path / "n.csv"
    p.write_text("a,b,c,d\n1.0,1e3,7,9223372036854775808\n2.0,2,NA,1\n")
    df = S.read_csv(spark, str(p))
    assert dict(df.dtypes) == {"a": "double", "b": "double", "c": "bigint", "d": "double"}
    assert [tuple(r)[:3] for r in df.collect()] == [(1.0, 1000.0, 7), (2.0, 2.0, None)]


def test_checkpoint_folder_must_be_shared_on_a_cluster(monkeypatch):
    import pytest

    from ridgeline import session

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: Conf())

    class Session:
        sparkContext, conf = Context, Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session)
