"""Genomic tables derived from the star-schema tables, as SQL that Spark and DuckDB both run unchanged."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

FIXTURES = {
    "fx_variants": """
SELECT o_orderkey AS variant_id, o_custkey % 20 AS sample_id,
       CASE WHEN o_orderkey % 5 = 0 THEN 'chrX' ELSE concat('chr', CAST(o_orderkey % 5 AS STRING)) END AS chrom,
       100 + o_orderkey * 7 AS pos,
       CASE WHEN o_orderkey % 7 = 0 THEN 'ACC' ELSE substring('ACGT', CAST(o_custkey % 4 AS INT) + 1, 1) END AS ref,
       CASE WHEN o_orderkey % 7 = 1 THEN 'GTTT' ELSE substring('CGTA', CAST(o_custkey % 4 AS INT) + 1, 1) END AS alt,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE concat('G', CAST(o_custkey % 50 AS STRING)) END AS symbol,
       CASE o_orderkey % 8 WHEN 0 THEN 'missense_variant' WHEN 1 THEN 'stop_gained'
            WHEN 2 THEN 'frameshift_variant' WHEN 3 THEN 'synonymous_variant'
            WHEN 4 THEN 'intron_variant&splice_region_variant' WHEN 5 THEN 'intron_variant'
            WHEN 6 THEN 'inframe_deletion' ELSE 'splice_region_variant&missense_variant' END AS consequence,
       CASE WHEN o_orderkey % 8 IN (1, 2) THEN 'HIGH' WHEN o_orderkey % 8 IN (0, 6, 7) THEN 'MODERATE' ELSE 'LOW' END AS impact,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 40 AS DOUBLE) / 1000 END AS max_af,
       CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '.'
            ELSE concat('0.', CAST(o_orderkey % 10 AS STRING), '&.&0.', CAST(o_custkey % 10 AS STRING)) END AS sift,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice / 10000 END AS cadd,
       CASE WHEN o_orderkey % 13 = 0 THEN 'low_conf_region' WHEN o_orderkey % 17 = 0 THEN 'off-target' ELSE '.' END AS filter_col,
       CASE o_orderkey % 5 WHEN 0 THEN 'Pathogenic%20x' WHEN 1 THEN 'Benign/Likely_benign%20y'
            WHEN 2 THEN 'Uncertain_significance' ELSE NULL END AS clinvar,
       CASE o_custkey % 6 WHEN 0 THEN 'DM' WHEN 1 THEN 'DM?' WHEN 2 THEN 'R' ELSE NULL END AS hgmd
FROM orders""",
    "fx_genotypes": """
SELECT o_orderkey AS variant_id, m.member, CASE WHEN m.member = 0 THEN 1 ELSE 0 END AS affected,
       CASE WHEN (o_orderkey + m.member) % 29 = 0 THEN './.'
            WHEN m.member = 0 THEN CASE o_orderkey % 3 WHEN 0 THEN '0/0' WHEN 1 THEN '0|1' ELSE '1/1' END
            WHEN m.member = 1 THEN CASE o_custkey % 3 WHEN 0 THEN '0/0' WHEN 1 THEN '0/1' ELSE '1/1' END
            WHEN (o_orderkey * 5 + o_custkey * 3) % 7 < 3 THEN '0/0'
            WHEN (o_orderkey * 5 + o_custkey * 3) % 7 < 6 THEN '0/1' ELSE '1/1' END AS gt
FROM orders CROSS JOIN (SELECT 0 AS member UNION ALL SELECT 1 AS member UNION ALL SELECT 2 AS member) m""",
    "fx_expanded": """
SELECT l_orderkey AS indel_id,
       CASE l_returnflag WHEN 'R' THEN 'HIGH' WHEN 'A' THEN 'MODERATE' ELSE 'LOW' END AS impact,
       CASE WHEN l_linestatus = 'F' THEN 'missense_variant' WHEN l_linenumber % 2 = 0 THEN 'synonymous_variant'
            ELSE 'splice_donor_variant' END AS consequence,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END AS feature
FROM lineitem""",
    "fx_scores": """
SELECT o.o_orderkey AS variant_id, max(l.l_extendedprice) AS score
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey HAVING max(l.l_discount) < 0.09""",
    "fx_regions": """
SELECT CASE WHEN c_custkey % 5 = 0 THEN 'chrX' ELSE concat('chr', CAST(c_custkey % 5 AS STRING)) END AS chrom,
       c_custkey * 61 AS start0, c_custkey * 61 + 20 + (c_custkey * 13) % 900 AS end0, c_name AS name
FROM customer""",
    "fx_edges": """
SELECT p_partkey AS term, CAST(floor(CAST(p_partkey - 1 AS DOUBLE) / 2) AS BIGINT) AS parent FROM part WHERE p_partkey > 0
UNION
SELECT p_partkey AS term, CAST(floor(CAST(p_partkey - 1 AS DOUBLE) / 3) AS BIGINT) AS parent FROM part WHERE p_partkey > 0""",
    "fx_term_counts": "SELECT l_partkey AS term, count(*) AS n FROM lineitem GROUP BY l_partkey",
    "fx_gene_terms": "SELECT DISTINCT concat('G', CAST(l_suppkey % 50 AS STRING)) AS gene, l_partkey AS term FROM lineitem",
    "fx_query_terms": "SELECT DISTINCT o_custkey % 20 AS sample_id, l_partkey AS term FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "fx_interactions": """
SELECT DISTINCT concat('G', CAST(s_suppkey % 50 AS STRING)) AS gene,
       concat('G', CAST((s_suppkey * 3 + 1) % 50 AS STRING)) AS partner,
       (s_suppkey * 377) % 1000 AS conf_exp, (s_suppkey * 591) % 1000 AS conf_db
FROM supplier""",
    "fx_rankings": """
SELECT CASE l_returnflag WHEN 'R' THEN 'rf' WHEN 'A' THEN 'dom' ELSE 'rec' END AS ranking,
       l_orderkey % 20 AS sample_id, concat('G', CAST(l_suppkey % 50 AS STRING)) AS gene, max(l_extendedprice) AS score
FROM lineitem GROUP BY 1, 2, 3""",
    "fx_tiles": "SELECT 'chr1' AS chrom, c_custkey AS tile, translate(md5(c_name), '0123456789abcdef', 'ACGTACGTAAAACCGT') AS seq FROM customer",
    "fx_transcripts": "SELECT concat('T', CAST(s_suppkey AS STRING)) AS transcript_id, 100 + s_suppkey % 7 AS cds_length FROM supplier",
    "fx_coding": """
SELECT v.*, concat('T', CAST(variant_id % 50 AS STRING)) AS feature, CAST(variant_id % 10 AS DOUBLE) / 10 AS pathogenicity,
       CASE variant_id % 12 WHEN 0 THEN NULL WHEN 1 THEN '?-20' WHEN 2 THEN 'NA' ELSE concat(CAST(variant_id % 108 + 1 AS STRING), '-', CAST(variant_id % 108 + 3 AS STRING)) END AS cds_position
FROM fx_variants v""",
    "fx_hits": """
SELECT chrom, pos, ref, CASE WHEN l_linenumber % 5 = 0 THEN 'N' ELSE alt END AS alt, concat('T', CAST(l_linenumber AS STRING)) AS feature, CAST(l_suppkey AS STRING) AS hit
FROM lineitem JOIN fx_variants ON l_orderkey = variant_id WHERE l_linenumber <> 2""",
    "fx_exclusions": "SELECT DISTINCT concat('g', CAST(n_nationkey AS STRING)) AS gene FROM nation",
}
NEEDS = {"fx_coding": ("fx_variants",), "fx_hits": ("fx_variants",)}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The DataFrame of a fixture. Its tables are views under names of their own, so a session's views stay as they are."""
    views = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES} | {n: fixture(spark, sf_dir, n) for n in NEEDS.get(name, ())}
    for n, df in views.items():
        df.createOrReplaceTempView(f"genoloom_{n}")
    return spark.sql(re.sub(rf"\b(FROM|JOIN) ({'|'.join(views)})\b", r"\1 genoloom_\2", FIXTURES[name]))


def with_fixtures(body: str, *names: str) -> str:
    """``body`` as SQL for DuckDB, with the fixtures it uses."""
    every = [m for n in names for m in (*NEEDS.get(n, ()), n)]
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({FIXTURES[n]})" for n in dict.fromkeys(every)) + (", " if body.lstrip().startswith("_") else " ") + body.replace("_,", "", 1)
