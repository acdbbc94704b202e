from pyspark.sql import functions as F

from genoloom import fixtures, queries
from genoloom.plans.pipelines import score_variants
from genoloom.streaming.scoring import score_stream

from .conftest import SMALL


def test_stream_scores_as_the_batch_does(spark, tmp_path):
    v = queries.as_features(fixtures.fixture(spark, SMALL, "fx_variants"))
    at = str(tmp_path / "in")
    v.filter("variant_id % 2 = 0").write.mode("append").parquet(at)
    for part in (0, 1):
        if part:
            v.filter("variant_id % 2 = 1").write.mode("append").parquet(at)
        score_stream(spark, at, v.schema, queries.USED, queries.FOREST, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("variant_id", F.round("pathogenicity", 9))
    want = score_variants(v, queries.USED, queries.FOREST).select("variant_id", F.round("pathogenicity", 9))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
