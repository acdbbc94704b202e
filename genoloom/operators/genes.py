"""Gene-level joins: symbols, interactions, phenotype similarity of a variant's gene and its partners, transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as X


def first_aliases(aliases: DataFrame, source: str = "Ensembl_HGNC_symbol") -> DataFrame:
    """protein, symbol: the first alias of a source, in alphabetic order (files have no order in Spark)."""
    nth = F.row_number().over(Window.partitionBy("protein").orderBy("alias"))
    return aliases.filter(F.col("source") == source).withColumn("_n", nth).filter("_n = 1").select("protein", F.upper("alias").alias("symbol"))


def interactions(links: DataFrame, aliases: DataFrame, least: int = 900) -> DataFrame:
    """gene, partner, conf_exp, conf_db of links whose experimental or database confidence reaches ``least``, both ends
    translated from proteins to symbols."""
    strong = links.filter((F.col("conf_exp") >= least) | (F.col("conf_db") >= least))
    a = aliases.select(F.col("protein").alias("protein1"), F.col("symbol").alias("gene"))
    b = aliases.select(F.col("protein").alias("protein2"), F.col("symbol").alias("partner"))
    return strong.join(a, "protein1").join(b, "protein2").select("gene", "partner", "conf_exp", "conf_db")


def confident(edges: DataFrame, least: int = 900) -> DataFrame:
    """Interaction edges (gene, partner, conf_exp, conf_db) that either confidence supports."""
    return edges.filter((F.col("conf_exp") >= least) | (F.col("conf_db") >= least))


def with_gene(variants: DataFrame, known: DataFrame, hgnc: DataFrame | None = None, symbol: str = "symbol", hgnc_id: str = "hgnc_id") -> DataFrame:
    """``variants`` with gene: the upper-case symbol if ``known`` (gene) has it, else the current symbol of their HGNC id."""
    own = known.select(F.col("gene").alias("_own")).distinct()
    df = variants.join(own, F.upper(symbol) == F.col("_own"), "left")
    if hgnc is None or hgnc_id not in variants.columns:
        return df.withColumn("gene", F.upper(symbol)).drop("_own")
    by_id = hgnc.select(F.col("hgnc_id").alias("_id"), F.col("symbol").alias("_current"))
    df = df.join(by_id, F.regexp_replace(F.col(hgnc_id).cast("string"), "^HGNC:", "") == F.col("_id"), "left")
    return df.withColumn("gene", F.coalesce("_own", "_current", F.upper(symbol))).drop("_own", "_id", "_current")


def with_phenotype(variants: DataFrame, similarity: DataFrame, partners: DataFrame, key: str = "sample_id") -> DataFrame:
    """``variants`` (key, gene) with the similarity of their gene and the best of its partners, 0 where there is none.
    Both tables have one row per key and gene, so variants don't multiply."""
    df = variants.join(similarity.select(key, "gene", "similarity"), [key, "gene"], "left").join(partners.select(key, "gene", "partner_similarity"), [key, "gene"], "left")
    return df.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("similarity", "partner_similarity")})


def with_cds(variants: DataFrame, transcripts: DataFrame, score: str = "pathogenicity") -> DataFrame:
    """``variants`` with cds_share, predicted and the score less the penalty of frameshifts near their transcript's end."""
    df = variants.join(transcripts.select(F.col("transcript_id").alias("feature"), "cds_length"), "feature", "left")
    share = X.cds_share("cds_position", "cds_length", "consequence", "ref", "alt")
    df = df.withColumn("cds_share", share).withColumn("predicted", F.col(score))
    return df.withColumn(score, F.col(score) - X.cds_penalty(F.coalesce("cds_share", F.lit(0.0)))).drop("cds_length")
