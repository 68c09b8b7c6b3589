import os
import uuid

from pyspark.sql import functions as F

from ridgeline.operators import models as M
from ridgeline.operators.prepare import TabularPrep
from ridgeline.session import checkpoint_dir
from ridgeline.sources.fixtures import customer_wide, cw_spec, scoring_table
from ridgeline.streaming.scoring import score_applicants, start_scoring_stream
from tests.conftest import SF001


def test_stream_scores_equal_batch(spark):
    cw = customer_wide(spark, SF001)
    spec = cw_spec(cw)
    train = cw.filter("bucket >= 2000")
    model = M.fit(spec, "decision_tree", train, maxDepth=3)
    st = TabularPrep(numericCols=list(spec.numeric), categoricalCols=list(spec.categorical)).fit(train).stats
    defaults = {x: s["median"] for x, s in st["numeric"].items()}
    cats = {x: s["categories"] for x, s in st["categorical"].items()}
    mean = cw.agg(F.avg("SCORE")).first()[0]
    apps = scoring_table(spark, SF001).drop("raw_score")
    batch = score_applicants(apps, model, list(spec.features), defaults, cats, mean, "c_custkey")

    base = os.path.join(checkpoint_dir(spark), f"stream-test-{uuid.uuid4().hex}")
    src = os.path.join(base, "in")
    apps.write.parquet(src)
    stream = spark.readStream.schema(apps.schema).parquet(src)
    q = start_scoring_stream(spark, stream, model, list(spec.features), defaults, cats, mean,
                             "c_custkey", os.path.join(base, "out"), name=f"t{uuid.uuid4().hex[:8]}")
    q.processAllAvailable()
    q.stop()
    out = spark.read.parquet(os.path.join(base, "out"))
    cols = ["c_custkey", "score", "tier", "delta"]
    assert sorted(out.select(*cols).collect()) == sorted(batch.select(*cols).collect())
