"""The composite operators and the three pipelines. Each is one lazy plan keyed by sample; resources are DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FEATURES, Settings
from ..functions import scalars as X
from ..operators import annotate, filters, genes, inheritance, meta, ontology, ranking, scoring
from ..shared import written


def score_variants(df: DataFrame, features: list[str], trees: list | None = None, model=None) -> DataFrame:
    """``df`` with pathogenicity: features imputed for the model alone, a forest (node tables or a fitted model), overrides."""
    x = scoring.with_imputed(scoring.max_frequency(df), tuple(features))
    x = scoring.predict(x, model) if model is not None else scoring.scored_by(x, trees)
    return x.withColumn("pathogenicity", scoring.overridden(F.col("pathogenicity"))).drop(*[f"x_{f}" for f in features])


def prioritize(df: DataFrame, gene_similarity: DataFrame | None = None, partners: DataFrame | None = None, hgnc: DataFrame | None = None, known_genes: DataFrame | None = None, exclusions: DataFrame | None = None,
               transcripts: DataFrame | None = None, genotypes: DataFrame | None = None, family: str = "TRIO", family_keys: tuple[str, ...] = (), settings: Settings = Settings(), features: tuple[str, ...] = FEATURES) -> DataFrame:
    """``df`` with inheritance, missing share, adjusted scores, phenotype similarity, final score, filter and rank.
    Parts whose resource isn't given, or whose columns ``df`` hasn't got, are left out."""
    has = lambda *cs: all(c in df.columns for c in cs)
    if genotypes is not None:
        df = inheritance.inheritance(df, genotypes, family, keys=family_keys)
    there = tuple(f for f in features if f in df.columns)
    if there:
        df = df.withColumn("missing_share", scoring.missing_share(there))
    if has("SIFT", "PolyPhen"):
        df = df.withColumn("opposed", X.opposed(X.score_max("PolyPhen"), X.score_min("SIFT")))
    if transcripts is not None and has("feature", "cds_position"):
        df = genes.with_cds(df, transcripts)
    if has("clinvar", "hgmd"):
        df = df.withColumn("database_score", X.database_score("clinvar", "hgmd")).withColumn("pathogenicity", X.blended("pathogenicity", F.col("database_score"), settings.database_share))
    if exclusions is not None:
        df = filters.excluded_gene(df, exclusions)
    path = scoring.source_score(df)
    query = gene_similarity is not None
    if query:
        known = known_genes if known_genes is not None else gene_similarity.select("gene").distinct()
        df = genes.with_phenotype(genes.with_gene(df, known, hgnc), gene_similarity, partners)
    excluded = F.col("gene_excluded") if exclusions is not None else None
    final = scoring.final_score(path, F.col("similarity") if query else None, F.col("partner_similarity") if query else None, excluded, settings)
    return filters.filtered(df.withColumn("final_score", final), settings=settings, with_query=query)


def rank_passed(df: DataFrame, top: int | None = None) -> DataFrame:
    """The rows that passed, ranked within their sample, those of rank up to ``top`` if given. Scores that agree to nine
    decimals tie."""
    out = filters.passed(df).withColumn("final_score", F.round("final_score", 9))
    return ranking.top_ranked(out, top) if top else ranking.ranked_in_pieces(out)


def rf_ranking(df: DataFrame, trees: list | None, features: list[str], rare: bool = False, top: int | None = None, settings: Settings = Settings(), model=None, **resources) -> DataFrame:
    """From annotated variants to a ranking: optional frequency cut, scores (of node tables or of a fitted ``model`` on the
    columns x_<feature>), priorities, ranks. The judged variants are
    written to the shared folder and the passed ones read from there: else the optimizer would copy the whole score, with
    the forest in it, into every rule of the filter on its way down to the scan."""
    df = scoring.max_frequency(filters.without_empty_rows(df))
    df = filters.rare(df, settings.rare_af) if rare else df
    scored = score_variants(df, features, trees, model)
    return rank_passed(written(prioritize(scored, settings=settings, features=tuple(features), **resources), "judged"), top)


def phenotype_tables(query: DataFrame, gene_terms: DataFrame, edges: DataFrame, counts: DataFrame, graph_edges: DataFrame, include_self: bool = False) -> tuple[DataFrame, DataFrame]:
    """(sample, gene, similarity) and (sample, gene, partner_similarity) of query terms, from the ontology's edges (term,
    parent), its annotation counts (term, n), genes' terms and the gene graph. Counts of terms outside the graph are dropped."""
    terms = edges.select("term").union(edges.select(F.col("parent").alias("term"))).distinct()
    ancestors = ontology.above(edges)
    counts = counts.join(terms, "term", "left_semi")
    total = counts.agg(F.sum("n")).first()[0] or 1
    ic = written(ontology.information_content(ontology.inclusive_counts(terms, ancestors, counts), total), "information")
    up = ontology.with_self(ancestors, terms) if include_self else ancestors
    per_gene = written(ontology.similarity(query, gene_terms, up, ic), "per-gene")
    return per_gene, ontology.partner_similarity(graph_edges, per_gene)


def meta_table(rf: DataFrame, dom: DataFrame, rec: DataFrame, rf_picks: DataFrame, eb_picks: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row a sample and gene of the best entries of three rankings, with the places of the model's picks."""
    best = [filters.top(meta.per_gene(r), settings.prompt_rank) for r in (rf, dom, rec)]
    return meta.one_hot_model(meta.with_picks(meta.with_picks(meta.merged(*best), rf_picks, "rf_rank_llm"), eb_picks, "eb_rank_llm"))


def meta_table_rf(rf: DataFrame, rf_picks: DataFrame) -> DataFrame:
    """The same with one ranking alone."""
    return meta.with_picks(meta.per_gene(rf).select("sample_id", "gene", "variant", F.col("rank").alias("rf_rank"), F.col("score").alias("rf_score")), rf_picks, "rf_rank_llm")


def meta_ranking(table: DataFrame, trees: list | None = None, model=None) -> DataFrame:
    scored = scoring.predict(table, model, "meta_score") if model is not None else scoring.scored_by(table, trees, "meta_score")
    return meta.meta_ranked(scored)


def flattened(records: DataFrame, fields: list[str], canonical: list[str], kind: str = "snv") -> DataFrame:
    """VCF records as annotated variants: INFO and CSQ to columns, one transcript chosen, genotype fields unpacked, blanks
    null, derived columns added. ``kind``: snv, indel or expanded (which keep INDEL_ID)."""
    df = records.withColumn("_r", X.chosen_record(X.csq_records(X.info_value("info", "CSQ"), fields), canonical))
    keep = [c for c in ("chrom", "pos", "ref", "alt", "qual", "filter", "sample_id") if c in df.columns]
    out = df.select(*keep, *([X.info_value("info", "INDEL_ID").alias("indel_id")] if kind != "snv" else []), *[F.col("_r")[f].alias(f) for f in fields],
                    *([X.genotype_fields("format", "sample").alias("_g")] if {"format", "sample"} <= set(df.columns) else []))
    if "_g" in out.columns:
        out = out.select("*", "_g.*").drop("_g")
    out = out.withColumnsRenamed({a: b for a, b in {"SYMBOL": "symbol", "IMPACT": "impact", "Consequence": "consequence", "Feature": "feature", "HGNC_ID": "hgnc_id", "CDS_position": "cds_position"}.items() if a in out.columns})
    derived = {"most_severe": X.most_severe("consequence"), "HIGH_IMPACT": X.high_impact("impact"), "IS_INDEL": F.lit(0 if kind == "snv" else 1)}
    splice = [c for c in out.columns if c.startswith("SpliceAI_pred_DS_")]
    if splice:
        derived["spliceai"] = X.largest(*[X.score_max(c) for c in splice])
    if {"Hom", "AN"} <= set(out.columns):
        derived["homAF"] = X.hom_frequency(F.col("Hom").try_cast("double"), F.col("AN").try_cast("double"))
    return scoring.max_frequency(filters.blanks_to_null(out.withColumns(derived)))


def annotated(snvs: DataFrame, indels: DataFrame, expanded: DataFrame, features: list[str]) -> DataFrame:
    """SNVs and indels in one table, indels with the means of the synthetic SNVs around them."""
    return snvs.unionByName(annotate.backfilled(indels, expanded, features).drop("indel_id"), allowMissingColumns=True)
