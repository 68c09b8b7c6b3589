from ridgeline.operators import score as R


def test_score_card(spark):
    df = spark.createDataFrame([(1, 250.0), (2, 739.5), (3, 740.5), (4, 900.0), (5, 586.4)], "id int, s double")
    rows = {r["id"]: r for r in R.score_card(df, "s", 586.712, keep=["id"]).collect()}
    assert rows[1]["score"] == 300 and rows[1]["tier"] == "Poor" and rows[1]["position"] == 0.0
    assert rows[2]["score"] == 740 and rows[2]["tier"] == "Excellent"  # half-even: 739.5 -> 740
    assert rows[3]["score"] == 740                                      # 740.5 -> 740
    assert rows[4]["score"] == 800 and rows[4]["position"] == 1.0
    assert rows[5]["delta"] == -1 and rows[5]["delta_label"] == "-1" and rows[5]["direction"] == "below"
    assert rows[2]["delta_label"] == "+153"


def test_feature_groups(spark):
    from pyspark.sql import functions as F
    names = ["INCOME", "T_TAX_12", "T_TAX_6", "R_TAX_INCOME", "CAT_DEBT", "R_TAX_SAVINGS", "CAT_GAMBLING", "R_TAX"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    got = {r["f"]: r["g"] for r in df.select("f", R.feature_group(F.col("f")).alias("g")).collect()}
    assert got["INCOME"] == "Core Financials" and got["T_TAX_12"] == "Annual Spend ($)"
    assert got["CAT_DEBT"] == "Ratio to Debt"  # the suffix rule comes before the prefix rule
    assert got["CAT_GAMBLING"] == "Binary Flags" and got["R_TAX"] == "Other Ratios"


def test_complete_and_change_flags(spark):
    app = spark.createDataFrame([(1, None, "x"), (2, 5.0, None)], "id int, a double, g string")
    done = R.complete_inputs(app, ["a", "g", "missing"], {"a": 3.0}, {"g": ["p", "q"]}, keep=["id"])
    rows = {r["id"]: r for r in done.collect()}
    assert rows[1]["a"] == 3.0 and rows[2]["g"] == "p" and rows[1]["missing"] == 0.0
    defaults = spark.createDataFrame([("a", 5.0000001)], "feature string, default double")
    flags = R.change_flags(app, "id", ["a"], ["g"], defaults).collect()
    got = {(r["row_id"], r["feature"]): r["changed"] for r in flags}
    assert got == {(1, "g"): True, (2, "a"): False}
