"""Pathogenicity scoring: features to numbers, imputation, tree ensembles, overrides, final score."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FEATURES, MEAN, MEDIAN, POPULATIONS, SPLICE, SYNONYMOUS, Settings
from ..functions import scalars as X
from ..functions.forests import FlatForest
from ..shared import fresh, ship, written


def max_frequency(df: DataFrame, populations: tuple[str, ...] = POPULATIONS) -> DataFrame:
    """MAX_AF: the largest of all populations' &-lists, nulls ignored."""
    own = [X.score_max(p) for p in populations if p in df.columns]
    return df.withColumn("MAX_AF", X.largest(*own)) if own else df


def imputed_feature(name: str, impact: str = "impact", consequence: str = "consequence") -> Column:
    """A feature as the model reads it: lists reduced, missing values replaced by fixed constants."""
    if name in ("MAX_AF", "homAF", "HIGH_IMPACT"):
        return F.coalesce(X.score_max(name), F.lit(0.0))
    if name == "IS_INDEL":
        return F.col(name).cast("double")
    if name == "SIFT":
        return F.coalesce(X.score_min(name), F.lit(MEDIAN[name]))
    if name.startswith("oe_"):
        return F.coalesce(X.score_min(name, strict=True), F.lit(MEDIAN[name]))
    if name in ("REVEL", "ALPHA_MISSENSE_SCORE"):
        severe = F.coalesce((F.col(impact) == "HIGH") & ~X.any_term(consequence, SPLICE), F.lit(False))
        return F.coalesce(X.score_max(name, strict=True), F.when(severe, 1.0).otherwise(MEDIAN[name]))
    return F.coalesce(X.score_max(name), F.lit(MEAN.get(name, MEDIAN.get(name))))


def with_imputed(df: DataFrame, features: tuple[str, ...] = FEATURES, prefix: str = "x_") -> DataFrame:
    """``df`` and its features as the model reads them, in one projection; the raw columns stay."""
    return df.select("*", *[imputed_feature(f).alias(prefix + f) for f in features if f in df.columns])


def missing_share(features: tuple[str, ...]) -> Column:
    """Share of features that are null or stand for a missing value."""
    gone = [F.when(F.coalesce(F.col(f).cast("string"), F.lit("")).isin("", ".", "nan", "NA"), 1).otherwise(0) for f in features]
    return sum(gone[1:], gone[0]) / len(gone)


def tree(nodes: dict[int, tuple], at: int = 0) -> Column:
    """A tree as nested conditions. A node is (feature, threshold, left, right), left where feature <= threshold, or
    (leaf,)."""
    node = nodes[at]
    if len(node) == 1:
        return F.lit(float(node[0]))
    feature, threshold, left, right = node
    return F.when(F.col(feature) <= threshold, tree(nodes, left)).otherwise(tree(nodes, right))


def forest(trees: list[dict[int, tuple]]) -> Column:
    """Mean of the trees' leaves: the probability of class 1, in one code-generated expression."""
    leaves = [tree(t) for t in trees]
    return sum(leaves[1:], leaves[0]) / len(leaves)


def scored_by(df: DataFrame, trees: list[dict[int, tuple]], out: str = "pathogenicity", most_nodes: int = 200) -> DataFrame:
    """``df`` with the forest's probability of class 1. Up to ``most_nodes`` nodes become one code-generated expression;
    a larger forest is sent to the executors once, as flat arrays, and looked up by whole Arrow batches: nested conditions
    of that size take minutes to plan and don't compile."""
    if sum(map(len, trees)) <= most_nodes:
        return df.withColumn(out, forest(trees))
    flat = FlatForest(trees)
    ship(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(flat)  # of the model's size

    def looked_up(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series(sent.value(np.column_stack([c.to_numpy("float64", na_value=np.nan) for c in columns])))

    return df.withColumn(out, F.pandas_udf(looked_up, "double")(*[F.col(f).cast("double") for f in flat.features]))


def trees_of(model, features: list[str]) -> list[dict[int, tuple]]:
    """The node tables of a fitted Spark forest, for ``scored_by``; leaves hold the share of class 1. They are read from the
    model's files in the shared folder, all nodes at once."""
    from pyspark.sql import SparkSession

    spark, path = SparkSession.active(), fresh(SparkSession.active(), "forest")
    model.write().save(path)
    out: list[dict[int, tuple]] = [{} for _ in range(model.getNumTrees)]
    for r in spark.read.parquet(f"{path}/data").collect():  # of the model's size
        node, split = r.nodeData, r.nodeData.split
        leaf = node.leftChild < 0
        out[r.treeID][node.id] = (node.impurityStats[1] / sum(node.impurityStats),) if leaf else (features[split.featureIndex], split.leftCategoriesOrThreshold[0], node.leftChild, node.rightChild)
    return out


def train_forest(labelled: DataFrame, features: list[str], label: str = "label", trees: int = 50, depth: int = 8, seed: int = 14038) -> PipelineModel:
    """A random forest on named columns, in Spark's own format (``write().save(path)``). The trainer reads its rows several
    times before it holds them, and then once a level; so label and features are computed once and dealt to four tasks a
    core, however few pieces the input's files have."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    steps = [VectorAssembler(inputCols=features, outputCol="_features"), RandomForestClassifier(labelCol=label, featuresCol="_features", numTrees=trees, maxDepth=depth, seed=seed)]
    dealt = labelled.select(label, *features).repartition(4 * labelled.sparkSession.sparkContext.defaultParallelism).persist()
    try:
        return Pipeline(stages=steps).fit(dealt)
    finally:
        dealt.unpersist()


def predict(df: DataFrame, model: PipelineModel, out: str = "pathogenicity") -> DataFrame:
    """Probability of class 1 by a fitted model."""
    done = model.transform(df)
    return done.select(*[F.col(c) for c in df.columns if c != out], vector_to_array("probability")[1].alias(out))


def fold_of(patient: str, folds: int = 5, seed: int = 14038) -> Column:
    """The fold of a patient, by a hash of seed and id: the same in every run, and one for all of a patient's variants."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(patient).cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % folds).cast("int")


def out_of_fold(labelled: DataFrame, features: list[str], patient: str = "sample_id", label: str = "label", folds: int = 5, out: str = "pathogenicity", seed: int = 14038, **forest: int) -> DataFrame:
    """``labelled`` with fold and a score by a forest that has seen no variant of the patient: ``folds`` forests, each trained
    on the other folds (which must hold both labels). What is measured on these scores holds for new patients."""
    df = written(labelled.withColumn("fold", fold_of(patient, folds, seed)), "folds")
    every = None
    for k in range(folds):
        own, others = df.filter(F.col("fold") == k), df.filter(F.col("fold") != k)
        if own.isEmpty():
            continue
        part = predict(own, train_forest(others, features, label, seed=seed, **forest), out)
        every = part if every is None else every.unionByName(part)
    return every if every is not None else df.withColumn(out, F.lit(None).cast("double"))


def fit_calibration(scored: DataFrame, score: str = "pathogenicity", label: str = "label", bins: int = 1000):
    """Isotonic regression of label on score, to be fitted on out-of-fold scores: the best steps that never fall. Scores
    are first summed into ``bins`` bins of equal width, so however many variants there are, Spark's fit, whose last step is
    one task's, sees no more rows than bins."""
    from pyspark.ml.regression import IsotonicRegression

    place = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1))
    few = scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(place.alias("bin")).agg(F.avg(score).alias("_score"), F.avg(F.col(label).cast("double")).alias("_label"), F.count("*").cast("double").alias("_weight"))
    return IsotonicRegression(featuresCol="_score", labelCol="_label", weightCol="_weight", predictionCol="_calibrated").fit(few)


def calibrated(df: DataFrame, model, score: str = "pathogenicity", out: str = "calibrated") -> DataFrame:
    """``df`` with the calibrated score, between steps on the line from one to the next; null where the score is."""
    known = model.transform(df.withColumn("_score", F.coalesce(score, F.lit(0.0))))
    return known.withColumn(out, F.when(F.col(score).isNotNull(), F.col("_calibrated"))).drop("_score", "_calibrated")


def log_loss(score: str, label: str, least: float = 1e-6) -> Column:
    """Mean log loss of a probability, cut at ``least`` from either end; an aggregate."""
    p = F.least(F.greatest(F.col(score), F.lit(least)), F.lit(1 - least))
    return F.avg(-F.when(F.col(label) == 1, F.log(p)).otherwise(F.log(1 - p)))


def overridden(score: Column, consequence: str = "consequence", ref: str = "ref", alt: str = "alt") -> Column:
    """Frameshifts score 0.9, purely synonymous variants 0.0, purely splice variants nothing."""
    return F.when(X.length_difference(ref, alt) % 3 != 0, F.lit(0.9)).when(X.only_terms(consequence, SPLICE), F.lit(None).cast("double")).when(X.only_terms(consequence, SYNONYMOUS), F.lit(0.0)).otherwise(score)


def source_score(df: DataFrame, score: str = "pathogenicity", splice: str = "spliceai") -> Column:
    """Where a variant's pathogenicity comes from: the predicted score, else the largest splice score if ``df`` has one."""
    return F.coalesce(score, X.score_max(splice)) if splice in df.columns else F.col(score)


def final_score(path: Column, phenotype: Column | None, partners: Column | None, excluded: Column | None = None, settings: Settings = Settings()) -> Column:
    """Weighted sum; without a phenotype query the pathogenicity alone; null for an excluded gene."""
    a, b, c = settings.weights
    score = path if phenotype is None else a * path + b * F.coalesce(phenotype, F.lit(0.0)) + c * F.coalesce(partners, F.lit(0.0))
    return score if excluded is None else F.when(~F.coalesce(excluded, F.lit(False)), score)
