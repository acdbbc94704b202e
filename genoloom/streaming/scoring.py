"""Scoring of variants as their files arrive. Scoring is row-local, so the batch plan is the streaming plan; ranks and
inheritance look at whole samples and genes and stay batch operators."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..plans.pipelines import score_variants


def score_stream(spark: SparkSession, source: str, schema: StructType, features: list[str], trees: list, out: str, checkpoint: str) -> StreamingQuery:
    """Score the Parquet files of ``source`` as they arrive, once each, into ``out``; stops when all there is is done."""
    scored = score_variants(spark.readStream.schema(schema).parquet(source), features, trees)
    return scored.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
