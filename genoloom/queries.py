"""One query for each operator on the derived tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .config import CODING, SEVERITY, SPLICE, SYNONYMOUS
from .fixtures import fixture, with_fixtures
from .functions import scalars as X
from .operators import annotate, filters, genes, inheritance, meta, ontology, ranking, scoring
from .plans import pipelines
from .shared import fresh, written
from .sources import store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(*fixtures: str, sql: str | None = None):
    """Register a function of the fixtures' DataFrames; ``sql`` may start with more CTEs, after ``_,``."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(*[fixture(spark, sf_dir, n) for n in fixtures])
        if sql:
            SQL[f.__name__] = with_fixtures(sql, *fixtures)
        return f

    return register


def register_plain(f, sql: str) -> None:
    """Register a function of (spark, sf_dir) that reads the tables themselves."""
    QUERIES[f.__name__], SQL[f.__name__] = f, sql


r6 = lambda c: F.round(c, 6)
listed = lambda names: ", ".join(f"'{n}'" for n in names)
SEV = "sev(t, s) AS (VALUES " + ", ".join(f"('{t}', {s})" for t, s in SEVERITY.items()) + ")"
MOST = f"{SEV}, parts AS (SELECT variant_id, unnest(string_split(consequence, '&')) AS t, unnest(range(1, len(string_split(consequence, '&')) + 1)) AS i FROM fx_variants), most AS (SELECT variant_id, arg_min(t, coalesce(s, 42) * 1000 + i) AS term FROM parts LEFT JOIN sev USING (t) GROUP BY variant_id)"
NUMS = "list_filter(list_transform(string_split({0}, '&'), lambda x: TRY_CAST(x AS DOUBLE)), lambda x: x IS NOT NULL)"
SIFT_MIN = f"list_min({NUMS.format('sift')})"
only = lambda names: f"len(list_filter(string_split(consequence, '&'), lambda x: x NOT IN ({listed(names)}))) = 0"
anyt = lambda names: f"len(list_filter(string_split(consequence, '&'), lambda x: x IN ({listed(names)}))) > 0"
#: A fixed forest of two trees on three features.
FOREST = [
    {0: ("x_CADD_PHRED", 10.0, 1, 2), 1: ("x_SIFT", 0.25, 3, 4), 2: (0.8,), 3: (0.6,), 4: (0.2,)},
    {0: ("x_MAX_AF", 0.015, 1, 2), 1: ("x_CADD_PHRED", 20.0, 3, 4), 2: (0.1,), 3: (0.5,), 4: (0.9,)},
]
USED = ["SIFT", "CADD_PHRED", "MAX_AF"]
x_sift, x_cadd, x_af = f"coalesce({SIFT_MIN}, 0.153)", "coalesce(cadd, 3.99)", "coalesce(max_af, 0.0)"
FOREST_SQL = f"CAST(((CASE WHEN {x_cadd} <= 10 THEN CASE WHEN {x_sift} <= 0.25 THEN 0.6 ELSE 0.2 END ELSE 0.8 END) + (CASE WHEN {x_af} <= 0.015 THEN CASE WHEN {x_cadd} <= 20 THEN 0.5 ELSE 0.9 END ELSE 0.1 END)) / 2 AS DOUBLE)"
SCORED_SQL = f"CASE WHEN abs(length(ref) - length(alt)) % 3 <> 0 THEN 0.9 WHEN {only(SPLICE)} THEN NULL WHEN {only(SYNONYMOUS)} THEN 0.0 ELSE {FOREST_SQL} END"


def as_features(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"sift": "SIFT", "cadd": "CADD_PHRED", "max_af": "MAX_AF", "filter_col": "filter"})


@query("fx_variants", sql=f"SELECT variant_id, {SIFT_MIN} AS lowest, list_max({NUMS.format('sift')}) AS highest, len({NUMS.format('sift')}) AS numbers, list_max(list_filter({NUMS.format('sift')}, lambda x: x > 0.3)) AS above FROM fx_variants")
def x01_score_lists(v):
    return v.select("variant_id", X.score_min("sift").alias("lowest"), X.score_max("sift").alias("highest"), F.when(F.col("sift").isNotNull(), F.size(X.scores("sift"))).cast("long").alias("numbers"), F.array_max(F.filter(X.scores("sift"), lambda x: x > 0.3)).alias("above"))


@query("fx_variants", sql=f"_, {MOST} SELECT variant_id, term, s AS severity FROM most JOIN sev ON t = term")
def x02_most_severe(v):
    return v.select("variant_id", X.most_severe("consequence").alias("term"), X.severity(X.most_severe("consequence")).alias("severity"))


@query("fx_variants", sql="""_, d AS (SELECT *, CASE WHEN variant_id % 3 = 0 THEN 0 ELSE variant_id % 7 END AS hom, variant_id % 100 AS an FROM fx_variants)
SELECT variant_id, CASE WHEN hom > 0 AND an > 0 THEN round(hom * 1.0 / an, 6) END AS hom_af, CASE WHEN impact = 'HIGH' THEN 1 ELSE 0 END AS high_impact,
 CASE WHEN length(ref) > 1 OR length(alt) > 1 THEN 1 ELSE 0 END AS is_indel, greatest(max_af, cadd) AS largest, concat('chr', replace(chrom, 'chr', '')) AS named,
 CASE WHEN filter_col NOT IN ('', '.', 'nan', 'NA') THEN filter_col END AS filled FROM d""")  # fmt: skip
def x07_derived_columns(v):
    hom, an = F.when(F.col("variant_id") % 3 == 0, 0).otherwise(F.col("variant_id") % 7), F.col("variant_id") % 100
    return v.select("variant_id", r6(X.hom_frequency(hom, an)).alias("hom_af"), X.high_impact("impact").alias("high_impact"), X.is_indel("ref", "alt").alias("is_indel"), X.largest("max_af", "cadd").alias("largest"), X.chrom_with_prefix(F.replace("chrom", F.lit("chr"), F.lit(""))).alias("named"), X.missing_to_null("filter_col").alias("filled"))


@query("fx_variants", sql=f"SELECT variant_id, {x_sift} AS \"x_SIFT\", {x_cadd} AS \"x_CADD_PHRED\", {x_af} AS \"x_MAX_AF\", CAST(CASE WHEN sift LIKE '0.9%' THEN 0.9 WHEN impact = 'HIGH' AND NOT {anyt(SPLICE)} THEN 1.0 ELSE 0.193 END AS DOUBLE) AS \"x_REVEL\" FROM fx_variants")
def x10_imputation(v):
    df = as_features(v).withColumn("REVEL", F.when(F.col("SIFT").startswith("0.9"), "0.9&0.1"))
    return scoring.with_imputed(df, (*USED, "REVEL")).select("variant_id", "x_SIFT", "x_CADD_PHRED", "x_MAX_AF", "x_REVEL")


@query("fx_variants", sql="SELECT variant_id, round(((CASE WHEN sift IS NULL OR sift IN ('.', '') THEN 1 ELSE 0 END) + (CASE WHEN cadd IS NULL THEN 1 ELSE 0 END) + (CASE WHEN max_af IS NULL THEN 1 ELSE 0 END)) / 3.0, 6) AS missing FROM fx_variants")
def a12_missing_share(v):
    return as_features(v).select("variant_id", r6(scoring.missing_share(tuple(USED))).alias("missing"))


@query("fx_variants", sql=f"SELECT variant_id, round({FOREST_SQL}, 6) AS p FROM fx_variants")
def m04_forest_expression(v):
    return scoring.with_imputed(as_features(v), tuple(USED)).select("variant_id", r6(scoring.forest(FOREST)).alias("p"))


@query("fx_variants", sql=f"SELECT variant_id, round(CAST({SCORED_SQL} AS DOUBLE), 6) AS pathogenicity FROM fx_variants")
def c01_score_variants(v):
    """X11 included."""
    return pipelines.score_variants(as_features(v), USED, FOREST).select("variant_id", r6("pathogenicity").alias("pathogenicity"))


CDS_SQL = """_, j AS (SELECT *, TRY_CAST(string_split(CASE WHEN cds_position <> 'NA' THEN cds_position END, '-')[1] AS DOUBLE) AS st FROM fx_coding LEFT JOIN fx_transcripts ON feature = transcript_id),
s AS (SELECT *, CASE WHEN (contains(consequence, 'frameshift') OR abs(length(ref) - length(alt)) % 3 <> 0) AND st <= cds_length THEN st / cds_length END AS share FROM j)
SELECT variant_id, round(share, 6) AS cds_share, round(pathogenicity, 6) AS predicted, round(pathogenicity - CASE WHEN share >= 0.99 THEN 0.05 WHEN share >= 0.98 THEN 0.04 WHEN share >= 0.97 THEN 0.03 WHEN share >= 0.96 THEN 0.02 WHEN share >= 0.95 THEN 0.01 ELSE 0 END, 6) AS pathogenicity FROM s"""


@query("fx_coding", "fx_transcripts", sql=CDS_SQL)
def x12_cds_penalty(v, t):
    """J6 included."""
    return genes.with_cds(v.withColumn("pathogenicity", F.col("pathogenicity").cast("double")), t).select("variant_id", r6("cds_share").alias("cds_share"), r6("predicted").alias("predicted"), r6("pathogenicity").alias("pathogenicity"))


DB_SQL = """_, d AS (SELECT variant_id, cadd AS p, CASE split_part(clinvar, '%', 1) WHEN 'Pathogenic' THEN 1.0 WHEN 'Benign/Likely_benign' THEN 0.25 WHEN 'Uncertain_significance' THEN 0.5 END AS c, CASE hgmd WHEN 'DM' THEN 1.0 WHEN 'DM?' THEN 0.75 END AS h FROM fx_variants),
e AS (SELECT *, coalesce((c + h) / 2, c, h) AS db FROM d) SELECT variant_id, round(CAST(db AS DOUBLE), 6) AS database_score, round(coalesce(0.8 * p + 0.2 * db, p), 6) AS blended FROM e"""


@query("fx_variants", sql=DB_SQL)
def x13_known_variants(v):
    db = X.database_score("clinvar", "hgmd")
    return v.select("variant_id", r6(db).alias("database_score"), r6(X.blended("cadd", db)).alias("blended"))


@query("fx_variants", sql="""_, d AS (SELECT variant_id, CAST(variant_id % 10 AS DOUBLE) / 10 AS pp, CAST(variant_id % 7 AS DOUBLE) / 6 AS sf, cadd / 100 AS p, max_af AS sp, symbol FROM fx_variants)
SELECT variant_id, CASE WHEN pp < 0.5 AND sf < 0.5 OR pp > 0.5 AND sf > 0.5 THEN 1 ELSE 0 END AS opposed, coalesce(p, greatest(sp, 0.001)) AS source,
 CASE WHEN symbol IS DISTINCT FROM 'G1' THEN round(0.34 * coalesce(p, greatest(sp, 0.001)) + 0.65 * pp + 0.01 * sf, 6) END AS final_score FROM d""")  # fmt: skip
def x16_final_score(v):
    """X14 and X15 included."""
    pp, sf = (F.col("variant_id") % 10).cast("double") / 10, (F.col("variant_id") % 7).cast("double") / 6
    v = v.withColumns({"pathogenicity": F.col("cadd") / 100, "spliceai": F.concat_ws("&", F.lit("0.001"), F.col("max_af").cast("string"))})
    path = scoring.source_score(v)
    return v.select("variant_id", X.opposed(pp, sf).alias("opposed"), path.alias("source"), r6(scoring.final_score(path, pp, sf, F.col("symbol") == "G1")).alias("final_score"))


@query("fx_variants", sql="SELECT variant_id, max_af FROM fx_variants WHERE max_af <= 0.02")
def f01_rare_variants(v):
    return filters.rare(v, 0.02, "max_af").select("variant_id", "max_af")


@query("fx_variants", sql=f"SELECT variant_id, concat('C', ';CODING_FILTERED=TRUE') AS info FROM fx_variants WHERE {anyt((*CODING, *SPLICE, *SYNONYMOUS))}")
def f02_coding_filter(v):
    return annotate.coding_only(v.select("variant_id", F.array("consequence").alias("consequences"), F.lit("C").alias("info"))).select("variant_id", "info")


ROUTES = "CASE WHEN length(ref) = 1 AND length(alt) = 1 THEN 'snv' WHEN length(ref) = 1 OR length(alt) = 1 THEN 'indel' END"


@query("fx_variants", sql=f"SELECT variant_id, {ROUTES} AS route FROM fx_variants WHERE {ROUTES} IS NOT NULL AND NOT contains(alt, ',')")
def f04_routes(v):
    """F3 included."""
    return annotate.routed(v).select("variant_id", "route")


@query("fx_variants", "fx_exclusions", sql="SELECT variant_id, coalesce(symbol IN (SELECT upper(gene) FROM fx_exclusions), false) AS gene_excluded FROM fx_variants")
def f05_gene_exclusion(v, e):
    return filters.excluded_gene(v.select("variant_id", "symbol"), e).select("variant_id", "gene_excluded")


@query("fx_interactions", "fx_exclusions", sql="SELECT gene, partner FROM fx_interactions WHERE partner NOT IN (SELECT upper(gene) FROM fx_exclusions)")
def f05_partner_exclusion(i, e):
    return filters.without_excluded(i, e).select("gene", "partner")


@query("fx_variants", sql="SELECT variant_id, nullif(trim(filter_col), '') AS filter_col, CASE WHEN NOT (contains(lower(clinvar), 'benign') AND contains(lower(clinvar), 'pathogenic')) THEN clinvar END AS clinvar FROM fx_variants")
def f11_blanks_and_conflicts(v):
    """F12 included."""
    return filters.blanks_to_null(v.select("variant_id", "filter_col", "clinvar")).withColumn("clinvar", X.conflicting_to_null("clinvar"))


CASCADE_SQL = f"""CASE WHEN filter_col = 'low_conf_region' THEN 'low confidence region' WHEN filter_col = 'off-target' THEN 'off target' WHEN max_af > 0.01 THEN 'high MAF'
 WHEN term IN ({listed(SYNONYMOUS)}) THEN 'synonymous variant' WHEN term NOT IN ({listed((*CODING, *SPLICE))}) THEN 'variant type not supported' WHEN final_score IS NULL THEN 'missing prediction' ELSE 'no HPO terms given' END"""
RANKED_SQL = f"""_, {MOST}, scored AS (SELECT v.*, term, {SCORED_SQL} AS p, CASE split_part(clinvar, '%', 1) WHEN 'Pathogenic' THEN 1.0 WHEN 'Benign/Likely_benign' THEN 0.25 WHEN 'Uncertain_significance' THEN 0.5 END AS c, CASE hgmd WHEN 'DM' THEN 1.0 WHEN 'DM?' THEN 0.75 END AS h FROM fx_variants v JOIN most USING (variant_id)),
final AS (SELECT *, coalesce(0.8 * p + 0.2 * coalesce((c + h) / 2, c, h), p) AS final_score FROM scored), judged AS (SELECT *, {CASCADE_SQL} AS filter_comment FROM final)"""


@query("fx_variants", sql=RANKED_SQL + " SELECT variant_id, round(final_score, 6) AS final_score, CASE WHEN filter_comment = 'no HPO terms given' THEN 1 ELSE 0 END AS filter_passed, filter_comment FROM judged")
def f06_filter_cascade(v):
    df = pipelines.score_variants(as_features(v), USED, FOREST)
    return pipelines.prioritize(df, features=tuple(USED)).select("variant_id", r6("final_score").alias("final_score"), "filter_passed", "filter_comment")


@query("fx_variants", sql=RANKED_SQL + ", top AS (SELECT *, rank() OVER (PARTITION BY sample_id ORDER BY round(final_score, 9) DESC) AS rank FROM judged WHERE filter_comment = 'no HPO terms given' AND max_af <= 0.02) SELECT sample_id, variant_id, round(final_score, 6) AS final_score, rank FROM top WHERE rank <= 25")
def e01_ranking(v):
    """From variants to the reported rows of each sample, by the whole pipeline: F9, F1, C1, C2, F8, W1, F7, T3."""
    out = pipelines.rf_ranking(as_features(v), FOREST, USED, rare=True, top=25)
    return out.select("sample_id", "variant_id", r6("final_score").alias("final_score"), "rank")


@query("fx_variants", sql="SELECT variant_id, sample_id, rank() OVER (PARTITION BY sample_id ORDER BY cadd DESC NULLS LAST) AS rank FROM fx_variants")
def w01_rank(v):
    return ranking.ranked(v, "cadd").select("variant_id", "sample_id", "rank")


@query("fx_variants", sql="_, v AS (SELECT variant_id, CASE WHEN variant_id % 2 = 0 THEN 0 ELSE sample_id END AS sample_id, CASE WHEN variant_id % 3 = 0 THEN 7 ELSE cadd END AS cadd FROM fx_variants) SELECT variant_id, sample_id, rank() OVER (PARTITION BY sample_id ORDER BY cadd DESC NULLS LAST) AS rank FROM v")
def w01_rank_in_pieces(v):
    """One sample holds over half of all rows, and a third of all rows tie."""
    v = v.withColumns({"sample_id": F.when(F.col("variant_id") % 2 == 0, 0).otherwise(F.col("sample_id")), "cadd": F.when(F.col("variant_id") % 3 == 0, 7.0).otherwise(F.col("cadd"))})
    return ranking.ranked_in_pieces(v, "cadd", piece_rows=500).select("variant_id", "sample_id", "rank")


@query("fx_variants", "fx_scores", sql="SELECT v.variant_id, score, CAST(score AS VARCHAR) IS NOT NULL AS found FROM fx_variants v LEFT JOIN fx_scores s USING (variant_id)")
def j01_exact_allele(v, s):
    key = v.select("variant_id", *annotate.ALLELE)
    resource = s.join(key, "variant_id").select(*annotate.ALLELE, "score")
    return annotate.by_unique_allele(key, resource, ["score"]).select("variant_id", "score", F.col("score").isNotNull().alias("found"))


OVERLAP = "r.chrom = v.chrom AND r.start0 < v.pos - 1 + length(v.ref) AND r.end0 > v.pos - 1"


@query("fx_variants", "fx_regions", sql=f"""_, r AS (SELECT * FROM fx_regions UNION ALL SELECT DISTINCT chrom, 5000, 3000000000, concat('all of ', chrom) FROM fx_regions UNION ALL SELECT chrom, start0 * 3, start0 * 40, concat(name, ' wide') FROM fx_regions WHERE start0 % 7 = 0)
SELECT v.variant_id, string_agg(DISTINCT r.name, '&' ORDER BY r.name) AS regions FROM fx_variants v LEFT JOIN r ON {OVERLAP} GROUP BY v.variant_id""")  # fmt: skip
def j02_region_overlap(v, r):
    """Regions of all lengths, some as long as a chromosome."""
    whole = r.select("chrom", F.lit(5000).alias("start0"), F.lit(3_000_000_000).alias("end0"), F.concat(F.lit("all of "), "chrom").alias("name")).distinct()
    wide = r.filter("start0 % 7 = 0").select("chrom", (F.col("start0") * 3).alias("start0"), (F.col("start0") * 40).alias("end0"), F.concat("name", F.lit(" wide")).alias("name"))
    places = v.select("variant_id", "chrom", "pos", "ref")  # rows travel whole
    return annotate.with_regions(places, r.unionByName(whole).unionByName(wide), "regions", width=1024).select("variant_id", "regions")


@query("fx_variants", sql="SELECT variant_id, CASE WHEN floor((pos - 1) / 64) % 3 > 0 THEN floor((pos - 1) / 64) % 100 END AS track FROM fx_variants")
def j02b_track_value(v):
    places = v.select("chrom", F.floor((F.col("pos") - 1) / 64).alias("k")).distinct().filter("k % 3 > 0")  # a third of the genome has no value
    track = places.select("chrom", (F.col("k") * 64).alias("start0"), (F.col("k") * 64 + 64).alias("end0"), (F.col("k") % 100).cast("double").alias("value"))
    return annotate.with_track(v, track, "track", width=1000).select("variant_id", "track")


@query("fx_variants", "fx_scores", "fx_hits", sql="""_, s AS (SELECT chrom, pos, ref, alt, max(score) AS score, max(score) / 2 AS half FROM fx_scores JOIN fx_variants USING (variant_id) GROUP BY ALL), h AS (SELECT chrom, pos, ref, alt, string_agg(DISTINCT hit, '&' ORDER BY hit) AS hits, string_agg(DISTINCT feature, '&' ORDER BY feature) AS features FROM fx_hits GROUP BY ALL)
SELECT variant_id, score, half, hits, features FROM fx_variants LEFT JOIN s USING (chrom, pos, ref, alt) LEFT JOIN h USING (chrom, pos, ref, alt)""")  # fmt: skip
def j01_allele_store(v, s, h):
    """J1 from one bucketed store of two resources, written, opened anew and joined once."""
    scores = s.join(v.select("variant_id", *annotate.ALLELE), "variant_id").withColumn("half", F.col("score") / 2)
    lists = [(h.select(*annotate.ALLELE, F.col("hit").alias("hits"), F.col("feature").alias("features")), ["hits", "features"])]
    at = fresh(v.sparkSession, "store")
    store.write_store(store.merged(lists, [(scores, ["score", "half"])]), at, 8)
    return store.with_store(v, store.open_store(v.sparkSession, at)).select("variant_id", "score", "half", "hits", "features")


@query("fx_interactions", sql="SELECT DISTINCT a.gene, a.partner, a.conf_exp, a.conf_db FROM fx_interactions a WHERE conf_exp >= 900 OR conf_db >= 900")
def j03_interactions(i):
    """G7 included: both ends by aliases, then the confidence filter."""
    ends = i.select(F.col("gene").alias("g")).union(i.select("partner")).distinct()
    alias = genes.first_aliases(ends.select(F.concat(F.lit("P"), "g").alias("protein"), F.lower("g").alias("alias"), F.lit("Ensembl_HGNC_symbol").alias("source")))
    links = i.select(F.concat(F.lit("P"), "gene").alias("protein1"), F.concat(F.lit("P"), "partner").alias("protein2"), "conf_exp", "conf_db")
    return genes.interactions(links, alias).distinct()


@query("fx_variants", "fx_gene_terms", sql="""_, known AS (SELECT DISTINCT gene FROM fx_gene_terms WHERE gene <> 'G7')
SELECT variant_id, coalesce(k.gene, concat('G', CAST(variant_id % 9 AS VARCHAR))) AS gene FROM fx_variants v LEFT JOIN known k ON upper(v.symbol) = k.gene""")  # fmt: skip
def j04_gene_fallback(v, t):
    known = t.select("gene").filter("gene <> 'G7'").distinct()
    df = v.withColumn("hgnc_id", F.concat(F.lit("HGNC:"), (F.col("variant_id") % 9).cast("string")))
    hgnc = v.select((F.col("variant_id") % 9).cast("string").alias("hgnc_id")).distinct().withColumn("symbol", F.concat(F.lit("G"), "hgnc_id"))
    return genes.with_gene(df, known, hgnc).select("variant_id", "gene")


@query("fx_tiles", sql="""_, p AS (SELECT tile AS variant_id, tile * 32 + tile % 32 + 1 AS pos FROM fx_tiles), w AS (SELECT string_agg(seq, '' ORDER BY tile) AS genome FROM fx_tiles)
SELECT variant_id, 'chr1' AS chrom, substring(genome, CAST(greatest(pos - 6, 0) + 1 AS INT), CAST(pos + 5 - greatest(pos - 6, 0) AS INT)) AS context FROM p, w UNION ALL SELECT variant_id, 'chr9', '.' FROM p WHERE variant_id % 3 = 0""")  # fmt: skip
def j07_reference_context(t):
    """From the contig's first bases on; a contig without tiles gives a dot."""
    v = t.select(F.col("tile").alias("variant_id"), F.lit("chr1").alias("chrom"), (F.col("tile") * 32 + F.col("tile") % 32 + 1).alias("pos"))
    near = annotate.with_context(v, t, 32)
    return near.unionByName(annotate.with_context(v.filter("variant_id % 3 = 0").withColumn("chrom", F.lit("chr9")), t, 32)).select("variant_id", "chrom", "context")


@query("fx_tiles", sql="SELECT tile, len(list_filter(string_split(seq, ''), lambda x: x = 'A')) AS a, round(greatest(length(seq) - length(replace(seq, 'A', '')), length(seq) - length(replace(seq, 'C', '')), length(seq) - length(replace(seq, 'G', '')), length(seq) - length(replace(seq, 'T', ''))) * 1.0 / length(seq), 2) AS share, (SELECT max(length(m)) FROM (SELECT unnest(regexp_extract_all(seq, 'A+|C+|G+|T+')) AS m)) AS run FROM fx_tiles")
def x17_runs_and_shares(t):
    """X18 included."""
    return t.select("tile", (F.length("seq") - F.length(F.translate("seq", "A", ""))).cast("long").alias("a"), X.base_share("seq").alias("share"), X.longest_run("seq").cast("long").alias("run"))


@query("fx_tiles", sql="""_, d AS (SELECT tile, CASE tile % 3 WHEN 0 THEN seq WHEN 1 THEN replace(seq, 'A', 'AA') ELSE replace(seq, 'G', '') END AS s FROM fx_tiles), e AS (SELECT tile, s, (SELECT max(length(m)) FROM (SELECT unnest(regexp_extract_all(s, 'A+|C+|G+|T+')) AS m)) AS run FROM d),
f AS (SELECT *, round(greatest(length(s) - length(replace(s, 'A', '')), length(s) - length(replace(s, 'C', '')), length(s) - length(replace(s, 'G', '')), length(s) - length(replace(s, 'T', ''))) * 1.0 / length(s), 2) AS share,
 (CASE WHEN contains(s, 'A') THEN 0 ELSE 1 END) + (CASE WHEN contains(s, 'C') THEN 0 ELSE 1 END) + (CASE WHEN contains(s, 'G') THEN 0 ELSE 1 END) + (CASE WHEN contains(s, 'T') THEN 0 ELSE 1 END) AS absent FROM e)
SELECT tile, CASE WHEN run >= 5 OR share >= 0.8 THEN 1 ELSE 0 END AS homopolymer, CASE WHEN absent >= 2 OR run >= 4 THEN 1 ELSE 0 END AS low_complexity FROM f""")  # fmt: skip
def x19_complexity_flags(t):
    s = F.when(F.col("tile") % 3 == 0, F.col("seq")).when(F.col("tile") % 3 == 1, F.replace("seq", F.lit("A"), F.lit("AA"))).otherwise(F.replace("seq", F.lit("G"), F.lit("")))
    return t.select("tile", X.is_homopolymer(s).alias("homopolymer"), X.is_low_complexity(s).alias("low_complexity"))


@query("fx_expanded", sql=f"SELECT indel_id, round(avg(CASE WHEN NOT {anyt((*SPLICE, *SYNONYMOUS))} AND impact IN ('HIGH', 'MODERATE') THEN coalesce(feature, CASE WHEN impact = 'HIGH' THEN 1.0 END) END), 6) AS feature FROM fx_expanded GROUP BY indel_id")
def a01_indel_means(e):
    """J8 included."""
    return annotate.indel_means(e, ["feature"]).select("indel_id", r6("feature").alias("feature"))


@query("fx_variants", "fx_expanded", sql=f"_, m AS (SELECT indel_id, avg(CASE WHEN NOT {anyt((*SPLICE, *SYNONYMOUS))} AND impact IN ('HIGH', 'MODERATE') THEN coalesce(feature, CASE WHEN impact = 'HIGH' THEN 1.0 END) END) AS f FROM fx_expanded GROUP BY indel_id) SELECT variant_id, round(CASE WHEN {ROUTES} = 'snv' THEN cadd ELSE f END, 6) AS feature FROM fx_variants LEFT JOIN m ON indel_id = variant_id WHERE {ROUTES} IS NOT NULL")
def u01_snv_indel_union(v, e):
    """Both routes in one table, indels back-filled."""
    df = annotate.routed(v).select("variant_id", "route", F.col("variant_id").alias("indel_id"), F.col("cadd").alias("feature"))
    out = pipelines.annotated(df.filter("route = 'snv'").drop("indel_id"), df.filter("route = 'indel'"), e, ["feature"])
    return out.select("variant_id", r6("feature").alias("feature"))


@query("fx_tiles", sql="""_, p AS (SELECT concat('i', CAST(tile AS VARCHAR)) AS indel_id, tile, tile * 32 + 11 AS pos FROM fx_tiles), g AS (SELECT indel_id, tile, unnest(range(pos - 3, pos + 4)) AS p0 FROM p)
SELECT indel_id, p0 + 1 AS pos, substring(seq, CAST(p0 % 32 + 1 AS INT), 1) AS ref, true AS other_kind FROM g JOIN fx_tiles USING (tile)""")  # fmt: skip
def n01_indel_expansion(t):
    """The drawn alternative is only asked to be of the other kind: its draw is a hash."""
    v = t.select(F.concat(F.lit("i"), F.col("tile").cast("string")).alias("indel_id"), "chrom", (F.col("tile") * 32 + 11).alias("pos"), F.lit("AC").alias("ref"))
    return annotate.expand_indels(v, t, 32).select("indel_id", "pos", "ref", (F.col("ref").isin("A", "T") != F.col("alt").isin("A", "T")).alias("other_kind"))


TERMS = "all_terms AS (SELECT term FROM fx_edges UNION SELECT parent FROM fx_edges)"
CLOSURE = "up(term, ancestor) AS (SELECT term, parent FROM fx_edges UNION SELECT up.term, e.parent FROM up JOIN fx_edges e ON up.ancestor = e.term)"
IC = f"{TERMS}, {CLOSURE}, incl AS (SELECT t.term, CAST(coalesce(sum(n), 0) AS BIGINT) AS n FROM (SELECT term, term AS below FROM all_terms UNION ALL SELECT ancestor, term FROM up) t LEFT JOIN fx_term_counts c ON c.term = t.below GROUP BY t.term), total AS (SELECT sum(n) AS total FROM fx_term_counts WHERE term IN (SELECT term FROM all_terms)), ic AS (SELECT term, -ln(greatest(n, 1) / total) AS ic FROM incl, total)"


def graph(edges: DataFrame, counts: DataFrame):
    terms = edges.select("term").union(edges.select("parent")).distinct()
    up = ontology.above(edges)
    counts = counts.join(terms, "term", "left_semi")
    incl = written(ontology.inclusive_counts(terms, up, counts), "counts")
    return terms, up, incl, ontology.information_content(incl, counts.agg(F.sum("n")).first()[0] or 1)


@query("fx_edges", sql=f"_, {CLOSURE} SELECT term, ancestor FROM up")
def g02_closure(e):
    """G1 included."""
    return ontology.closure(e)


@query("fx_edges", "fx_term_counts", sql=f"_, {IC} SELECT term, incl.n, round(ic, 6) AS ic FROM incl JOIN ic USING (term)")
def g03_information_content(e, c):
    """A2 and A3 included."""
    _, _, incl, ic = graph(e, c)
    return incl.join(ic, "term").select("term", "n", r6("ic").alias("ic"))


@query("fx_edges", "fx_term_counts", sql=f"""_, {IC}, p AS (SELECT term AS a, parent + 1 AS b FROM fx_edges), m AS (SELECT a, b, max(ic) AS m FROM (SELECT DISTINCT a, b FROM p) q JOIN up x ON x.term = a JOIN up y ON y.term = b AND x.ancestor = y.ancestor JOIN ic ON ic.term = x.ancestor GROUP BY a, b)
SELECT DISTINCT p.a, p.b, round(CASE WHEN ia.ic + ib.ic > 0 THEN 2 * coalesce(m, 0) / (ia.ic + ib.ic) ELSE 0 END, 6) AS lin, round(coalesce(m, 0), 6) AS resnik, round(1 - (ia.ic + ib.ic - 2 * coalesce(m, 0)), 6) AS jc, round(CASE WHEN ia.ic + ib.ic > 0 THEN 2 * coalesce(m, 0) / (ia.ic + ib.ic) * (1 - 1 / (1 + coalesce(m, 0))) ELSE 0 END, 6) AS coefficient FROM p LEFT JOIN m USING (a, b) JOIN ic ia ON ia.term = p.a JOIN ic ib ON ib.term = p.b""")  # fmt: skip
def g05_node_similarity(e, c):
    """G4 and U3 included."""
    _, up, _, ic = graph(e, c)
    pairs = e.select(F.col("term").alias("a"), (F.col("parent") + 1).alias("b"))
    of = lambda m, name: ontology.measured(m).alias(name)
    df = ontology.shared_information(pairs, up, ic).select("a", "b", of("lin", "lin"), of("resnik", "resnik"), of("jiang_conrath", "jc"), of("information_coefficient", "coefficient"))
    return df.select("a", "b", *[r6(m).alias(m) for m in df.columns[2:]])


SIM = f"""{IC}, gt AS (SELECT gene, ancestor, min(ic) AS least FROM fx_gene_terms JOIN ic USING (term) JOIN up USING (term) GROUP BY gene, ancestor),
best AS (SELECT a.term, gene, max(2 * c.ic / (ia.ic + least)) AS best FROM (SELECT DISTINCT term FROM fx_query_terms) a JOIN ic ia ON ia.term = a.term JOIN up ON up.term = a.term JOIN gt ON gt.ancestor = up.ancestor JOIN ic c ON c.term = up.ancestor WHERE c.ic > 0 GROUP BY a.term, gene),
valid AS (SELECT sample_id, term FROM fx_query_terms WHERE term IN (SELECT term FROM ic)), genes AS (SELECT DISTINCT sample_id, gene FROM valid JOIN best USING (term)),
sim AS (SELECT g.sample_id, g.gene, median(coalesce(best, 0)) AS similarity FROM genes g JOIN valid v USING (sample_id) LEFT JOIN best b ON b.term = v.term AND b.gene = g.gene GROUP BY g.sample_id, g.gene)"""


@query("fx_query_terms", "fx_gene_terms", "fx_edges", "fx_term_counts", sql=f"_, {SIM} SELECT sample_id, gene, round(similarity, 6) AS similarity FROM sim")
def g06_phenotype_similarity(q, t, e, c):
    """A4, A5 and J11 included."""
    terms, up, _, ic = graph(e, c)
    asked = ontology.resolved(q, terms, q.sparkSession.createDataFrame([], "term long, replaced_by long"))
    return ontology.similarity(asked, t, up, ic).select("sample_id", "gene", r6("similarity").alias("similarity"))


@query("fx_variants", "fx_interactions", "fx_query_terms", "fx_gene_terms", "fx_edges", "fx_term_counts", sql=f"""_, {SIM}, partner AS (SELECT sample_id, i.gene, max(similarity) AS p FROM (SELECT DISTINCT gene, partner FROM fx_interactions WHERE conf_exp >= 900 OR conf_db >= 900) i JOIN sim ON sim.gene = i.partner GROUP BY sample_id, i.gene)
SELECT variant_id, round(coalesce(s.similarity, 0), 6) AS similarity, round(coalesce(p, 0), 6) AS partner_similarity FROM fx_variants v LEFT JOIN sim s ON s.sample_id = v.sample_id AND s.gene = v.symbol LEFT JOIN partner q ON q.sample_id = v.sample_id AND q.gene = v.symbol""")  # fmt: skip
def j05_partner_similarity(v, i, q, t, e, c):
    """A6 and F10's renames on the way: variants with their gene's and its partners' similarity."""
    per_gene, partners = pipelines.phenotype_tables(q, t, e, c, genes.confident(i))
    df = genes.with_phenotype(v.withColumn("gene", F.upper("symbol")), per_gene, partners)
    return df.select("variant_id", r6("similarity").alias("similarity"), r6("partner_similarity").alias("partner_similarity"))


GT = "replace(gt, '|', '/')"
VERDICTS = f"""verdicts AS (SELECT variant_id,
 CASE WHEN max(CASE WHEN affected = 0 AND {GT} = '0/1' OR affected = 1 AND {GT} = '0/0' OR {GT} = '1/1' THEN 1 ELSE 0 END) = 0 AND max(CASE WHEN affected = 1 AND {GT} = '0/1' OR affected = 0 AND {GT} = '0/0' THEN 1 ELSE 0 END) = 1 THEN 1 ELSE 0 END AS denovo,
 CASE WHEN max(CASE WHEN affected = 1 AND {GT} = '0/0' OR affected = 0 AND {GT} IN ('0/1', '1/1') THEN 1 ELSE 0 END) = 0 AND max(CASE WHEN affected = 1 AND {GT} IN ('0/1', '1/1') OR affected = 0 AND {GT} = '0/0' THEN 1 ELSE 0 END) = 1 THEN 1 ELSE 0 END AS dominant,
 CASE WHEN max(CASE WHEN affected = 1 AND {GT} IN ('0/0', '0/1') OR affected = 0 AND {GT} IN ('1/1', '0/0') THEN 1 ELSE 0 END) = 0 AND max(CASE WHEN affected = 1 AND {GT} = '1/1' OR affected = 0 AND {GT} = '0/1' THEN 1 ELSE 0 END) = 1 THEN 1 ELSE 0 END AS recessive,
 CASE WHEN max(CASE WHEN affected = 1 AND {GT} IN ('0/0', '0/1') OR affected = 0 AND {GT} = '1/1' THEN 1 ELSE 0 END) = 0 AND max(CASE WHEN affected = 0 AND {GT} = '0/1' THEN 1 ELSE 0 END) = 1 AND max(CASE WHEN affected = 0 AND {GT} = '0/0' THEN 1 ELSE 0 END) = 1 THEN 1 ELSE 0 END AS xlinked
 FROM fx_genotypes GROUP BY variant_id)"""


@query("fx_genotypes", sql=f"_, {VERDICTS} SELECT variant_id, denovo, dominant, recessive, xlinked FROM verdicts")
def a07_family_verdicts(g):
    return inheritance.family_verdicts(g)


WIDE = f"wide AS (SELECT v.variant_id, sample_id, symbol, chrom, max(CASE WHEN member = 0 THEN {GT} END) AS c, max(CASE WHEN member = 1 THEN {GT} END) AS p, max(CASE WHEN member = 2 THEN {GT} END) AS m FROM fx_variants v JOIN fx_genotypes g USING (variant_id) GROUP BY ALL)"


@query("fx_variants", "fx_genotypes", sql=f"_, {WIDE} SELECT variant_id, CASE WHEN symbol IS NOT NULL AND c = '0/1' AND sum(CASE WHEN c = '0/1' THEN 1 ELSE 0 END) OVER (PARTITION BY sample_id, symbol) >= 2 THEN 1 ELSE 0 END AS compound FROM wide")
def w03_compound_single(v, g):
    return inheritance.compound_single(v.join(g.filter("member = 0"), "variant_id")).select("variant_id", "compound")


PAIRS = """cls AS (SELECT *, c = '0/1' AND p = '0/1' AND m = '0/0' AS a, c = '0/1' AND p = '0/0' AND m = '0/1' AS b FROM wide), pairs AS (SELECT DISTINCT unnest([x.variant_id, y.variant_id]) AS variant_id FROM cls x JOIN cls y ON x.sample_id = y.sample_id AND x.symbol = y.symbol WHERE x.a AND y.b)"""
COMPOUND = f"{WIDE}, {PAIRS}"


@query("fx_variants", "fx_genotypes", sql=f"_, {COMPOUND} SELECT variant_id, CASE WHEN variant_id IN (SELECT variant_id FROM pairs) THEN 1 ELSE 0 END AS compound FROM wide")
def w04_compound_trio(v, g):
    """The SQL forms the pairs, the query doesn't."""
    gt = g.groupBy("variant_id").agg(*[F.max(F.when(F.col("member") == i, F.col("gt"))).alias(c) for i, c in enumerate(("gt_child", "gt_first", "gt_second"))])
    return inheritance.compound_trio(v.join(gt, "variant_id")).select("variant_id", "compound")


@query("fx_variants", "fx_genotypes", sql=f"""_, {VERDICTS}, {COMPOUND} SELECT variant_id, concat_ws('&', CASE WHEN dominant = 1 THEN 'DOMINANT' END, CASE WHEN denovo = 1 THEN 'DOMINANT_DENOVO' END, CASE WHEN recessive = 1 THEN 'RECESSIVE' END,
 CASE WHEN variant_id IN (SELECT variant_id FROM pairs) THEN 'COMPOUND' END, CASE WHEN xlinked = 1 AND chrom = 'chrX' THEN 'XLINKED' END) AS inheritance FROM wide JOIN verdicts USING (variant_id)""")  # fmt: skip
def c03_inheritance(v, g):
    """X25 included."""
    return inheritance.inheritance(v, g).select("variant_id", "inheritance")


TRIM = "CASE WHEN length(ref) > 1 OR length(alt) > 1 THEN CASE WHEN ref[1] = alt[1] THEN 1 ELSE 0 END ELSE 0 END"


X06 = f"""a AS (SELECT variant_id, chrom, pos, ref, alt, {TRIM} AS f FROM fx_variants), b AS (SELECT *, substring(ref, f + 1) AS r, substring(alt, f + 1) AS q FROM a),
 c AS (SELECT *, coalesce((SELECT max(n) FROM (SELECT unnest(range(1, 5)) AS n) WHERE n <= length(r) AND n <= length(q) AND right(r, n) = right(q, n)), 0) AS e FROM b), d AS (SELECT *, left(r, length(r) - e) AS r2, left(q, length(q) - e) AS q2 FROM c),
 g AS (SELECT *, coalesce((SELECT max(n) FROM (SELECT unnest(range(1, 5)) AS n) WHERE n <= length(r2) AND n <= length(q2) AND left(r2, n) = left(q2, n)), 0) AS s FROM d), h AS (SELECT *, substring(r2, s + 1) AS r3, substring(q2, s + 1) AS q3, pos + f + s AS p3 FROM g),
 keys AS (SELECT variant_id, chrom, CASE WHEN r3 = '' THEN p3 - 1 ELSE p3 END AS k_start, CASE WHEN r3 = '' THEN p3 - 1 ELSE p3 + length(r3) - 1 END AS k_end, CASE WHEN r3 = '' THEN '-' ELSE r3 END AS k_ref, CASE WHEN q3 = '' THEN '-' ELSE q3 END AS k_alt FROM h)"""
KEY = "concat(keys.chrom, ':', k_start, '-', k_end, '_', k_ref, '>', k_alt)"


@query("fx_variants", sql=f"_, {X06} SELECT variant_id, {KEY} AS key FROM keys")
def x06_variant_key(v):
    return v.select("variant_id", X.variant_key("chrom", "pos", "ref", "alt").alias("key"))


@query("fx_variants", sql="SELECT variant_id, chrom, pos AS \"start\", pos + length(ref) - 1 AS \"end\", ref, alt AS obs FROM fx_variants")
def x06_split_key(v):
    key = F.concat("chrom", F.lit(":"), F.col("pos").cast("string"), F.lit("-"), (F.col("pos") + F.length("ref") - 1).cast("string"), F.lit("_"), "ref", F.lit(">"), "alt")
    k = X.split_key(key)
    return v.select("variant_id", k["chrom"].alias("chrom"), k["start"].alias("start"), k["end"].alias("end"), k["ref"].alias("ref"), k["alt"].alias("obs"))


@query("fx_genotypes", sql=f"SELECT variant_id, member, CASE WHEN {GT} = '1/1' THEN 'hom' WHEN {GT} IN ('0/1', '1/0') THEN 'het' END AS word, CASE {GT} WHEN '1/1' THEN 'hom' WHEN '0/1' THEN 'het' WHEN '0/0' THEN 'wt' ELSE 'n/a' END AS text FROM fx_genotypes")
def x21_genotype_words(g):
    return g.select("variant_id", "member", X.genotype_word("gt").alias("word"), X.genotype_text("gt").alias("text"))


TYPES = "CASE WHEN term IN ('stop_gained', 'frameshift_variant') THEN 'loss of function variant' WHEN term = 'inframe_deletion' THEN 'inframe insertion/deletion' WHEN term = 'missense_variant' THEN 'missense variant' WHEN term = 'splice_region_variant' THEN 'splice region variant' ELSE 'unspecified variant' END"


@query("fx_variants", sql=f"_, {MOST} SELECT variant_id, {TYPES} AS type FROM most")
def x22_variant_type(v):
    return v.select("variant_id", X.variant_type(X.most_severe("consequence"), "ref", "alt").alias("type"))


@query("fx_variants", sql=f"_, {MOST} SELECT variant_id, symbol AS gene, term AS consequence, {TYPES} AS type FROM most JOIN fx_variants USING (variant_id) WHERE symbol IS NOT NULL")
def x23_evidence_gene(v):
    """The supported entry of most severe consequence, of two in a cell."""
    df = v.filter("symbol IS NOT NULL")
    cell = F.concat("symbol", F.lit(":t:"), "consequence", F.lit(":x,OTHER:t:downstream_gene_variant:x"))
    unsupported = ~X.most_severe("consequence").isin("stop_gained", "frameshift_variant", "inframe_deletion", "missense_variant", "splice_region_variant")
    swapped = F.when(unsupported, F.concat("symbol", F.lit(":t:"), "consequence")).otherwise(cell)
    g = meta.gsvar_choice(swapped, "ref", "alt")
    return df.select("variant_id", g["gene"].alias("gene"), g["consequence"].alias("consequence"), g["type"].alias("type"))


@query("fx_variants", sql=f"_, {MOST}, {X06}, r AS (SELECT *, rank() OVER (PARTITION BY sample_id ORDER BY cadd DESC) AS rk FROM fx_variants WHERE symbol IS NOT NULL AND cadd IS NOT NULL) SELECT v.sample_id, v.symbol AS gene, term AS consequence, {TYPES} AS type, CAST(rk AS INT) AS rank, round(cadd, 6) AS score, CASE WHEN v.variant_id % 2 = 0 THEN 'het' ELSE 'hom' END AS genotype, {KEY} AS variant FROM r v JOIN most USING (variant_id) JOIN keys USING (variant_id) WHERE rk <= 25")
def x26_entry_round_trip(v):
    """A sample's top entries to one text and back, all their fields."""
    df = ranking.top_ranked(v.filter("symbol IS NOT NULL AND cadd IS NOT NULL"), 25, "cadd").withColumns({"gt": F.when(F.col("variant_id") % 2 == 0, "0|1").otherwise("1/1"), "final_score": F.col("cadd")})
    back = meta.entry_list(meta.entries(df)).select("sample_id", F.explode(meta.parsed_entries("entries")).alias("e")).select("sample_id", "e.*")
    return back.withColumn("score", F.round("score", 6))


RANKINGS = "ranked AS (SELECT *, rank() OVER (PARTITION BY ranking, sample_id ORDER BY score DESC) AS rk FROM fx_rankings), best AS (SELECT * FROM ranked WHERE rk <= 10)"
MERGED = f"""{RANKINGS}, m AS (SELECT sample_id, gene, coalesce(max(CASE WHEN ranking = 'rf' THEN rk END), 11) AS rf_rank, coalesce(max(CASE WHEN ranking = 'rf' THEN score END), 0) AS rf_score, coalesce(max(CASE WHEN ranking = 'dom' THEN rk END), 11) AS dr, coalesce(max(CASE WHEN ranking = 'dom' THEN score END), 0) AS ds,
 coalesce(max(CASE WHEN ranking = 'rec' THEN rk END), 11) AS rr, coalesce(max(CASE WHEN ranking = 'rec' THEN score END), 0) AS rs FROM best GROUP BY sample_id, gene),
 merged AS (SELECT *, CASE WHEN rr < dr OR rr = dr AND rs > ds THEN 'rec' ELSE 'dom' END AS eb_model, CASE WHEN rr < dr OR rr = dr AND rs > ds THEN rr ELSE dr END AS eb_rank, CASE WHEN rr < dr OR rr = dr AND rs > ds THEN rs ELSE ds END AS eb_score FROM m),
 picks AS (SELECT sample_id, gene, rk AS place FROM ranked WHERE ranking = 'dom' AND rk <= 3 UNION ALL SELECT sample_id, gene, rk FROM ranked WHERE ranking = 'rec' AND rk <= 3), rfp AS (SELECT sample_id, gene, rk AS place FROM ranked WHERE ranking = 'rf' AND rk <= 3)"""


def rankings(r: DataFrame, name: str) -> DataFrame:
    df = ranking.ranked(r.filter(F.col("ranking") == name), "score")
    return df.select("sample_id", "gene", F.lit("missense_variant").alias("consequence"), F.col("rank").cast("int"), "score", F.concat("gene", F.lit("-"), F.lit(name)).alias("variant"))


def picks(r: DataFrame, *names: str) -> DataFrame:
    out = [rankings(r, n).filter("rank <= 3").select("sample_id", "gene", F.col("rank").alias("place")) for n in names]
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


@query("fx_rankings", sql=f"""_, {MERGED} SELECT sample_id, gene, rf_rank, round(rf_score, 4) AS rf_score, eb_model, eb_rank, round(eb_score, 4) AS eb_score, coalesce((SELECT min(place) FROM rfp p WHERE p.sample_id = merged.sample_id AND p.gene = merged.gene), 4) AS rf_rank_llm,
 coalesce((SELECT min(place) FROM picks p WHERE p.sample_id = merged.sample_id AND p.gene = merged.gene), 4) AS eb_rank_llm, CASE WHEN eb_model = 'dom' THEN 1 ELSE 0 END AS eb_dom, CASE WHEN eb_model = 'rec' THEN 1 ELSE 0 END AS eb_rec,
 array_to_string(list_distinct_kept, ';') AS variant FROM (SELECT *, list_filter([CASE WHEN rf_score > 0 THEN concat(gene, '-rf') END, CASE WHEN ds > 0 THEN concat(gene, '-dom') END, CASE WHEN rs > 0 THEN concat(gene, '-rec') END], lambda x: x IS NOT NULL) AS list_distinct_kept FROM merged) merged""")  # fmt: skip
def j09_meta_table(r):
    """A10, U2, J10, X27 and X28 included."""
    t = pipelines.meta_table(*[rankings(r, n) for n in ("rf", "dom", "rec")], picks(r, "rf"), picks(r, "dom", "rec"))
    return t.select("sample_id", "gene", "rf_rank", F.round("rf_score", 4).alias("rf_score"), "eb_model", "eb_rank", F.round("eb_score", 4).alias("eb_score"), "rf_rank_llm", "eb_rank_llm", "eb_dom", "eb_rec", "variant")


META = [{0: ("rf_rank", 3.0, 1, 2), 1: (0.9,), 2: ("eb_rank", 5.0, 3, 4), 3: (0.6,), 4: (0.1,)}]


@query("fx_rankings", sql=f"_, {MERGED}, s AS (SELECT sample_id, gene, CASE WHEN rf_rank <= 3 THEN 0.9 WHEN eb_rank <= 5 THEN 0.6 ELSE 0.1 END AS meta_score FROM merged) SELECT sample_id, gene, CAST(meta_score AS DOUBLE) AS meta_score, rank() OVER (PARTITION BY sample_id ORDER BY meta_score DESC) AS meta_rank FROM s")
def e02_meta_ranking(r):
    """M2, W2 and T4 on the meta table."""
    t = pipelines.meta_table(*[rankings(r, n) for n in ("rf", "dom", "rec")], picks(r, "rf"), picks(r, "dom", "rec"))
    return pipelines.meta_ranking(t, META).select("sample_id", "gene", "meta_score", "meta_rank")


@query("fx_rankings", sql=f"_, {RANKINGS}, c AS (SELECT sample_id, concat('G', CAST(sample_id * 7 % 50 AS VARCHAR)) AS causal FROM (SELECT DISTINCT sample_id FROM fx_rankings)), k AS (SELECT c.sample_id, coalesce(min(CASE WHEN gene = causal AND rk <= 3 THEN rk END), -1) AS causal_rank FROM c JOIN ranked ON ranked.sample_id = c.sample_id AND ranking = 'rf' GROUP BY c.sample_id) SELECT count(*) AS samples, avg(CASE WHEN causal_rank = 1 THEN 1.0 ELSE 0 END) AS top_1, avg(CASE WHEN causal_rank BETWEEN 1 AND 2 THEN 1.0 ELSE 0 END) AS top_2, avg(CASE WHEN causal_rank BETWEEN 1 AND 3 THEN 1.0 ELSE 0 END) AS top_3 FROM k")
def m05_hit_rates(r):
    """X31 included."""
    best = picks(r, "rf").groupBy("sample_id").agg(*[F.min(F.when(F.col("place") == i, F.col("gene"))).alias(f"p{i}") for i in (1, 2, 3)])
    known = best.withColumn("causal", F.concat(F.lit("G"), (F.col("sample_id") * 7 % 50).cast("string")))
    return ranking.hit_rates(known.withColumn("causal_rank", ranking.pick_rank("causal", ["p1", "p2", "p3"])))


PROMPT_SQL = """_, c AS (SELECT DISTINCT sample_id, symbol AS gene, CASE WHEN sample_id % 4 = 0 THEN 'het' ELSE 'hom' END AS gt FROM fx_variants WHERE symbol IS NOT NULL), o AS (SELECT *, unnest(['both', 'type', 'none']) AS kind FROM c),
l AS (SELECT sample_id, kind, string_agg(CASE WHEN kind = 'none' THEN gene WHEN kind = 'both' AND gt = 'hom' THEN concat(gene, ' (homozygous missense variant)') ELSE concat(gene, ' (missense variant)') END, ', ' ORDER BY gene) AS genes FROM o GROUP BY ALL)
SELECT sample_id, kind, concat('A ', CASE WHEN sample_id % 2 = 0 THEN 'female ' ELSE '' END, 'rare disease patient', CASE WHEN sample_id % 3 = 0 THEN concat(' of age ', CAST(sample_id AS VARCHAR)) ELSE '' END, ' has the following symptoms: x, y. A causal variant in which of the following candidate genes would best explain these symptoms? ',
 CASE WHEN kind <> 'none' THEN 'For each candidate gene the type of the variant is given in brackets. ' ELSE '' END, CASE WHEN kind = 'both' THEN 'Furthermore the genotype of the variant is included in the brackets if it is a homozygous variant. ' ELSE '' END) AS opening, genes FROM l"""


@query("fx_variants", sql=PROMPT_SQL)
def x29_prompts(v):
    """All wordings, whole prompts; the genes, which stand in a seeded order (T5), are sorted for the comparison."""
    c = v.filter("symbol IS NOT NULL").select("sample_id", F.col("symbol").alias("gene")).distinct().withColumns({"type": F.lit("missense variant"), "genotype": F.when(F.col("sample_id") % 4 == 0, "het").otherwise("hom")})
    p = v.select("sample_id").distinct().withColumns({"sex": F.when(F.col("sample_id") % 2 == 0, "female").otherwise(""), "age": F.when(F.col("sample_id") % 3 == 0, F.col("sample_id")), "phenotypes": F.lit("x, y")})
    parts = F.split("prompt", "Candidate genes: ")
    of = lambda kind, *has: meta.prompts(p, c, *has).select("sample_id", F.lit(kind).alias("kind"), parts[0].alias("opening"), F.array_join(F.array_sort(F.split(parts[1], ", ")), ", ").alias("genes"))
    return of("both", True, True).unionByName(of("type", True, False)).unionByName(of("none", False, False))


def nth_row(df: DataFrame, *within: str, out: str = "_nth") -> DataFrame:
    """``df`` (_id, a monotonically increasing id as the rows were read) with the number of each row from 1 on, within each of
    ``within``: the rows of the parts before its own, a number a part, and its place in the part. No task sees all rows."""
    part = F.shiftright("_id", 33)
    df = df.withColumn("_part", part)
    sizes = written(df.groupBy(*within, "_part").agg(F.count("*").alias("_n"), F.min("_id").alias("_first")), "parts")
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = F.broadcast(sizes.select(*within, "_part", (before - F.col("_first") + 1).alias("_shift")))
    return df.join(sizes, [*within, "_part"]).withColumn(out, F.col("_id") + F.col("_shift")).drop("_part", "_shift", "_id")


def places(df: DataFrame, *ties: str):
    """The place of each row in the order that ``df`` has, equal rows sharing the first: a check of order. The ordered rows are
    written with their ids, so their parts are counted and numbered as they were ordered; equal rows meet by a join with
    the first of them."""
    df = nth_row(written(df.select("*", F.monotonically_increasing_id().alias("_id")), "ordered"))
    first = df.groupBy(*[F.col(t).alias(f"_{t}") for t in ties]).agg(F.min("_nth").cast("long").alias("_first"))
    same = [F.col(t).eqNullSafe(F.col(f"_{t}")) for t in ties]
    return F.col("_first"), df.join(first, same).drop(*[f"_{t}" for t in ties])


@query("fx_variants", sql="SELECT variant_id, rank() OVER (ORDER BY cadd DESC NULLS LAST) AS by_score, rank() OVER (ORDER BY chrom, pos) AS by_place FROM fx_variants")
def t01_sorts(v):
    """Places in each order."""
    score, df = places(ranking.by_score(v, "cadd"), "cadd")
    place, other = places(ranking.by_place(v), "chrom", "pos")
    return df.select("variant_id", score.alias("by_score")).join(other.select("variant_id", place.alias("by_place")), "variant_id")


@query("fx_rankings", sql=f"_, {MERGED}, s AS (SELECT sample_id, gene, CASE WHEN rf_rank <= 3 THEN 0.9 WHEN eb_rank <= 5 THEN 0.6 ELSE 0.1 END AS meta_score FROM merged), r AS (SELECT *, rank() OVER (PARTITION BY sample_id ORDER BY meta_score DESC) AS k FROM s) SELECT sample_id, gene, rank() OVER (ORDER BY sample_id, k) AS place FROM r")
def t04_meta_order(r):
    """The rows of the meta ranking in its order."""
    t = pipelines.meta_table(*[rankings(r, n) for n in ("rf", "dom", "rec")], picks(r, "rf"), picks(r, "dom", "rec"))
    place, df = places(pipelines.meta_ranking(t, META), "sample_id", "meta_rank")
    return df.select("sample_id", "gene", place.alias("place"))


@query("fx_rankings", sql="_, g AS (SELECT DISTINCT sample_id, gene FROM fx_rankings), n AS (SELECT sample_id, count(*) AS n FROM g GROUP BY sample_id) SELECT sample_id, unnest(range(1, n + 1)) AS shuffle_rank, true AS same FROM n")
def t05_shuffled(r):
    """A sample's genes get the places from 1 on, the same ones however the rows lie."""
    g = r.select("sample_id", "gene").distinct()
    again = ranking.shuffled(g.repartition(5, "gene"), 7, "sample_id", "gene").select("sample_id", "gene", F.col("shuffle_rank").alias("again"))
    return ranking.shuffled(g, 7, "sample_id", "gene").join(again, ["sample_id", "gene"]).select("sample_id", F.col("shuffle_rank").cast("long").alias("shuffle_rank"), (F.col("shuffle_rank") == F.col("again")).alias("same"))


@query("fx_variants", sql="SELECT chrom, count(*) AS n, count(DISTINCT (pos, ref, alt)) AS ids, count(DISTINCT (pos, ref, alt)) AS alleles FROM (SELECT chrom, pos // 2 AS pos, ref, alt FROM fx_variants) GROUP BY chrom")
def w05_indel_ids(v):
    """One id for each allele, and one allele for each id."""
    ids = annotate.with_indel_id(v.withColumn("pos", F.floor(F.col("pos") / 2)))
    return ids.groupBy("chrom").agg(F.count("*").alias("n"), F.count_distinct("indel_id").alias("ids"), F.count_distinct(F.struct("pos", "ref", "alt", "indel_id")).alias("alleles"))


@query("fx_variants", sql="SELECT variant_id, concat(symbol, ' (inh=n/a oe_syn=n/a oe_mis=n/a oe_lof=n/a)') AS gene_info, nullif(filter_col, '.') AS filter, concat('QUAL=', CAST(variant_id AS VARCHAR)) AS quality FROM fx_variants WHERE symbol IS NOT NULL")
def x24_exchange_columns(v):
    """K6's table."""
    from .sources.writers import gsvar_table

    df = v.filter("symbol IS NOT NULL").withColumnRenamed("filter_col", "filter").withColumn("qual", F.col("variant_id"))
    return gsvar_table(df, "s").select(F.regexp_extract("quality", r"(\d+)", 1).cast("long").alias("variant_id"), "gene_info", "filter", "quality")


@query("fx_genotypes", "fx_variants", sql=f"_, {VERDICTS} SELECT mode AS inheritance_mode, count(*) AS n FROM (SELECT unnest([CASE WHEN dominant = 1 THEN 'dominant' END, CASE WHEN denovo = 1 THEN 'dominant_denovo' END, CASE WHEN recessive = 1 THEN 'recessive' END]) AS mode FROM verdicts) WHERE mode IS NOT NULL GROUP BY mode")
def k02_inheritance_modes(g, v):
    """The exploded modes that the partitioned sink writes."""
    from .sources.writers import modes

    df = inheritance.inheritance(v, g).filter("dominant = 1 OR denovo = 1 OR recessive = 1")
    return modes(df).filter("inheritance_mode IN ('dominant', 'dominant_denovo', 'recessive')").groupBy("inheritance_mode").agg(F.count("*").alias("n"))


def x30_answer_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers built from the events' JSON: fenced and cut, one object, a list, one without its last bracket, no JSON."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k")
    body = F.concat(F.lit('{"1st ranked Gene": "g'), k, F.lit('", "2nd ranked Gene": " b ", "3rd ranked Gene": "c"'))
    n = F.col("event_id") % 6
    answer = (
        F.when(n == 0, F.concat(F.lit("```json\n["), body, F.lit("]\n```"))).when(n == 1, F.concat(body, F.lit("}"))).when(n == 2, F.concat(F.lit("["), body, F.lit("}]")))
        .when(n == 3, F.concat(F.lit("```\n"), body)).when(n == 4, F.concat(F.lit("I think g"), k)).otherwise(F.lit("[1, 2]"))
    )
    return meta.picks_of(e.select(F.col("event_id").alias("sample_id"), answer.alias("answer"))).select("sample_id", "gene", F.col("place").cast("long").alias("place"))


register_plain(x30_answer_parsing, "SELECT event_id AS sample_id, CASE i WHEN 1 THEN concat('G', json_extract_string(props, '$.k')) WHEN 2 THEN 'B' ELSE 'C' END AS gene, i AS place FROM events, (SELECT unnest([1, 2, 3]) AS i) WHERE event_id % 6 < 4")


@query("fx_variants", sql="SELECT variant_id, 0.0::DOUBLE AS difference, true AS probability FROM fx_variants")
def m01_trained_forest(v):
    """M3 and M1: a forest trained by Spark and applied, against the same forest as a code-generated expression (M4)."""
    df = scoring.with_imputed(as_features(v), tuple(USED)).withColumn("label", (F.col("impact") == "HIGH").cast("double"))
    names = [f"x_{f}" for f in USED]
    model = scoring.train_forest(df, names, trees=10, depth=4)
    p = scoring.predict(df, model).withColumn("again", scoring.forest(scoring.trees_of(model.stages[-1], names)))
    return p.select("variant_id", F.abs(F.round(F.col("pathogenicity") - F.col("again"), 6)).alias("difference"), F.col("pathogenicity").between(0, 1).alias("probability"))


def steps(feature: str, thresholds: list[float]) -> dict[int, tuple]:
    """A balanced tree whose leaf is the share of ``thresholds`` (ascending) below the feature."""
    nodes: dict[int, tuple] = {}

    def grow(lo: int, hi: int) -> int:
        at, nodes[at] = len(nodes), ()
        mid = (lo + hi) // 2
        nodes[at] = (feature, thresholds[mid], grow(lo, mid), grow(mid + 1, hi)) if lo < hi else (lo / len(thresholds),)
        return at

    grow(0, len(thresholds))
    return nodes


def two_sided(t: int) -> dict[int, tuple]:
    """Tree ``t`` of the large forest, ten conditions deep: steps of the frequency, or of SIFT where CADD is large."""
    low, high = steps("x_MAX_AF", [(k + 0.5 + t / 2000) / 12800 for k in range(511)]), steps("x_SIFT", [(k + 0.51 + t / 2500) / 511 for k in range(511)])
    moved = lambda nodes, by: {i + by: n if len(n) == 1 else (n[0], n[1], n[2] + by, n[3] + by) for i, n in nodes.items()}
    return {0: ("x_CADD_PHRED", 5 + t / 10, 1, 1 + len(low))} | moved(low, 1) | moved(high, 1 + len(low))


step_sql = lambda x, width, shift, by: f"least(511, greatest(0, ceil({x} * {width} - CAST({shift} AS DOUBLE) - CAST(t AS DOUBLE) / {by}))) / 511"


@query("fx_variants", sql=f"""_, x AS (SELECT variant_id, CAST({x_sift} AS DOUBLE) AS s, CAST({x_cadd} AS DOUBLE) AS c, CAST({x_af} AS DOUBLE) AS a FROM fx_variants)
SELECT variant_id, round(list_sum(list_transform(range(200), lambda t: CASE WHEN c <= 5 + CAST(t AS DOUBLE) / 10 THEN {step_sql("a", 12800, 0.5, 2000)} ELSE {step_sql("s", 511, 0.51, 2500)} END)) / 200, 6) AS p FROM x""")  # fmt: skip
def m04_large_forest(v):
    """200 trees of depth 10, as flat arrays."""
    x = scoring.with_imputed(as_features(v), tuple(USED))
    return scoring.scored_by(x, [two_sided(t) for t in range(200)], "p").select("variant_id", r6("p").alias("p"))


@query("fx_variants", sql="SELECT variant_id, 0.0 AS difference, true AS probability FROM fx_variants")
def m03_full_forest(v):
    """A forest of the trainer's own size, 50 trees of depth 8, by Spark and as flat arrays."""
    df = scoring.with_imputed(as_features(v), tuple(USED)).withColumn("label", (F.col("impact") == "HIGH").cast("double"))
    names = [f"x_{f}" for f in USED]
    df = written(df.select("variant_id", "label", *names), "imputed")
    model = scoring.train_forest(df, names)
    p = scoring.scored_by(scoring.predict(df, model), scoring.trees_of(model.stages[-1], names), "again")
    return p.select("variant_id", F.abs(F.round(F.col("pathogenicity") - F.col("again"), 6)).alias("difference"), F.col("pathogenicity").between(0, 1).alias("probability"))


@query("fx_variants", sql="SELECT variant_id, sample_id, CAST(CAST(concat('0x', substring(md5(concat('14038:', CAST(sample_id AS VARCHAR))), 1, 8)) AS BIGINT) % 4 AS INT) AS fold, true AS probability, true AS rises FROM fx_variants")
def m05_out_of_fold(v):
    """Folds by patient, scores by forests that haven't seen the patient, calibrated on those scores."""
    df = scoring.with_imputed(as_features(v), tuple(USED)).withColumn("label", (F.col("impact") == "HIGH").cast("double"))
    scored = scoring.out_of_fold(df, [f"x_{f}" for f in USED], folds=4, trees=8, depth=5)
    known = scoring.calibrated(scored, scoring.fit_calibration(scored))
    before = F.max("calibrated").over(Window.partitionBy("sample_id").orderBy("pathogenicity"))  # a higher score is never less likely
    return known.select("variant_id", "sample_id", "fold", (F.col("pathogenicity").between(0, 1) & F.col("calibrated").between(0, 1)).alias("probability"), (F.col("calibrated") >= before).alias("rises"))


@query("fx_variants", "fx_tiles", sql="""_, want AS (SELECT variant_id, greatest(pos - 6, 0) AS a, pos + 5 AS b FROM fx_variants WHERE chrom = 'chr1'), t AS (SELECT w.variant_id, tile, substring(seq, CAST(greatest(a - tile * 32, 0) + 1 AS INT), CAST(least(b - tile * 32, 32) - greatest(a - tile * 32, 0) AS INT)) AS s FROM want w JOIN fx_tiles ON tile BETWEEN floor(a / 32) AND floor((b - 1) / 32))
SELECT variant_id, string_agg(s, '' ORDER BY tile) AS context FROM t GROUP BY variant_id""")  # fmt: skip
def j07_tile_store(v, t):
    """J7 from a tile store: files around the variants alone are opened."""
    at = fresh(v.sparkSession, "tiles")
    store.write_tiles(t, at, block_tiles=64)
    near = v.filter("chrom = 'chr1'")
    return annotate.with_context(near, store.tiles_around(near, at, 32), 32).filter("context <> '.'").select("variant_id", "context")


@query("fx_variants", sql="SELECT variant_id, symbol, max_af FROM fx_variants WHERE variant_id % 7 <> 0")
def f09_empty_rows(v):
    """Rows without any value go, those with one stay."""
    bare = F.col("variant_id") % 7 == 0
    df = v.select(*[F.when(~bare, F.col(c)).alias(c) for c in ("variant_id", "symbol", "max_af")])
    return filters.without_empty_rows(df)


@query("fx_variants", sql="SELECT variant_id, sift AS source, symbol AS gene FROM fx_variants")
def f10_filled_and_renamed(v):
    """A14 included: the first of the candidates that has any value at all, and renames of what is there."""
    df = v.select("variant_id", "symbol", F.lit(None).cast("string").alias("a"), F.col("sift").alias("b"), F.col("hgmd").alias("c"))
    return filters.renamed(filters.first_filled(df, ["absent", "a", "b", "c"], "source"), {"symbol": "gene", "nothing": "x"}).select("variant_id", "source", "gene")


HITS = "string_agg(DISTINCT hit, '&' ORDER BY hit)"


@query("fx_variants", "fx_hits", sql=f"_, h AS (SELECT chrom, pos, ref, alt, {HITS} AS hits FROM fx_hits GROUP BY ALL) SELECT variant_id, hits FROM fx_variants LEFT JOIN h USING (chrom, pos, ref, alt)")
def j01_allele_lists(v, h):
    """Several hits of an allele in one cell; other alleles of the place don't count."""
    return annotate.by_allele(v, h.withColumnRenamed("hit", "hits"), ["hits"]).select("variant_id", "hits")


@query("fx_variants", "fx_hits", sql=f"_, h AS (SELECT chrom, pos, ref, alt, feature, {HITS} AS hits FROM fx_hits GROUP BY ALL) SELECT variant_id, hits FROM (SELECT *, concat('T', CAST(variant_id % 8 AS VARCHAR)) AS feature FROM fx_variants) LEFT JOIN h USING (chrom, pos, ref, alt, feature)")
def j01b_transcript_lists(v, h):
    """The transcript is part of the key."""
    own = v.withColumn("feature", F.concat(F.lit("T"), (F.col("variant_id") % 8).cast("string")))
    return annotate.by_allele(own, h.withColumnRenamed("hit", "hits"), ["hits"], keys=(*annotate.ALLELE, "feature")).select("variant_id", "hits")


@query("fx_query_terms", "fx_edges", sql="_, t AS (SELECT DISTINCT term FROM fx_edges), q AS (SELECT sample_id, CASE WHEN term % 5 = 0 THEN term + 7 ELSE term END AS term FROM fx_query_terms WHERE term % 4 > 0) SELECT DISTINCT sample_id, term FROM q JOIN t USING (term)")
def j11_resolved_terms(q, e):
    """Terms by their replacements; those that the ontology lacks are dropped."""
    asked = q.withColumn("term", F.when(F.col("term") % 4 == 0, -F.col("term") - 1).when(F.col("term") % 5 == 0, F.col("term") + 1_000_000).otherwise(F.col("term")))
    old = q.select("term").distinct().filter("term % 5 = 0").select((F.col("term") + 1_000_000).alias("term"), (F.col("term") + 7).alias("replaced_by"))
    return ontology.resolved(asked, e.select("term").distinct(), old).select("sample_id", "term")


@query("fx_variants", sql="SELECT variant_id, CASE WHEN variant_id % 6 <> 0 OR max_af IS NOT NULL THEN greatest(CASE WHEN variant_id % 6 <> 0 THEN 0.015 END, max_af) END AS frequency FROM fx_variants")
def a11_max_frequency(v):
    """The largest of the populations' lists; missing ones don't count."""
    df = v.withColumns({"gnomADg_AFR_AF": F.when(F.col("variant_id") % 6 != 0, "0.001&0.015&."), "gnomADg_EAS_AF": F.col("max_af").cast("string"), "gnomADg_SAS_AF": F.lit(".")})
    return scoring.max_frequency(df).select("variant_id", F.col("MAX_AF").alias("frequency"))


@query("fx_variants", sql="SELECT variant_id, CAST(CASE WHEN variant_id % 3 = 0 THEN 0.75 ELSE 0.5 END AS DOUBLE) AS highest, CAST(CASE WHEN variant_id % 2 = 0 THEN 0.25 ELSE 0.5 END AS DOUBLE) AS lowest, CAST(CASE WHEN variant_id % 3 = 0 THEN 0.75 ELSE 0.5 END AS DOUBLE) AS loose_highest, -2.0::DOUBLE AS loose_lowest FROM fx_variants")
def x01_strict_lists(v):
    """Tokens with a colon or a minus sign don't count in the strict forms."""
    n = F.col("variant_id")
    cell = F.concat(F.lit("-2&9:9&0.5"), F.when(n % 3 == 0, "&0.75").otherwise(""), F.when(n % 2 == 0, "&0.25&.").otherwise("&nan"), F.lit("&3-4"))
    return v.select("variant_id", X.score_max(cell, strict=True).alias("highest"), X.score_min(cell, strict=True).alias("lowest"), X.score_max(cell).alias("loose_highest"), X.score_min(cell).alias("loose_lowest"))


@query("fx_variants", sql="SELECT variant_id, symbol AS gene, max_af AS af, CAST(CASE WHEN variant_id % 2 = 0 THEN 0.75 ELSE 0.5 END AS DOUBLE) AS splice, 0.25::DOUBLE AS oe FROM fx_variants")
def x04_info_columns(v):
    """Keys of an INFO cell as text, largest or least of a list, and the splice record's scores."""
    n = F.col("variant_id")
    info = F.concat(F.lit("A=1;GENE="), F.coalesce("symbol", F.lit(".")), F.lit(";AF="), F.coalesce(F.concat(F.lit("0&"), F.col("max_af").cast("string")), F.lit("nan")), F.lit(";SPLICE=G|X|0.1|"), F.when(n % 2 == 0, "0.75").otherwise("0.5"), F.lit("|.|0.2|9|9,C|Y|0|0|0|0.3|8|8;OE=0.25&-1&0.5;XGENE=no"))
    return v.select("variant_id", *X.info_columns(info, {"gene": ("GENE", "text"), "af": ("AF", "max"), "splice": ("SPLICE", "splice"), "oe": ("OE", "min")}))


@query("fx_genotypes", sql=f"_, w AS (SELECT DISTINCT variant_id FROM fx_genotypes) SELECT variant_id, concat('s', CAST(member AS VARCHAR)) AS sample, CASE WHEN {GT} = './.' THEN '.' ELSE {GT} END AS gt, CAST(variant_id % 50 AS INT) AS dp, CAST(member AS INT) AS alt FROM fx_genotypes")
def x05_packed_genotypes(g):
    """Several samples in one cell."""
    word = F.coalesce(X.lookup({"0/0": "wt", "0/1": "het", "1/1": "hom"}, F.replace("gt", F.lit("|"), F.lit("/"))), F.lit("."))
    cell = F.concat(F.lit("s"), "member", F.lit("="), word, F.lit("|"), F.col("variant_id") % 50, F.lit("|"), "member")
    packed = g.groupBy("variant_id").agg(F.array_join(F.collect_list(cell), ",").alias("cells"))
    return packed.select("variant_id", F.explode(X.packed_genotypes("cells")).alias("x")).select("variant_id", "x.*")


JUDGED = f"""_, {MOST}, d AS (SELECT v.*, term, variant_id AS n, CASE WHEN variant_id % 31 <> 0 THEN variant_id % 100 / 100.0 END AS score, length(ref) > 1 OR length(alt) > 1 AS long FROM fx_variants v JOIN most USING (variant_id)),
j AS (SELECT variant_id, CASE WHEN filter_col = 'low_conf_region' THEN 'low confidence region' WHEN filter_col = 'off-target' THEN 'off target' WHEN n % 19 = 0 THEN 'low confidence region' WHEN n % 23 = 0 THEN 'gene exclusion'
 WHEN score < 0.7 AND n % 5 = 0 THEN 'tandem repeat' WHEN score < 0.7 AND n % 6 = 0 THEN 'segmental duplication' WHEN score < 0.7 AND long AND n % 4 = 0 THEN 'homopolymer and low complexity region' WHEN score < 0.7 AND long AND n % 4 = 1 THEN 'homopolymer'
 WHEN score < 0.7 AND long AND n % 4 = 2 THEN 'low complexity region' WHEN score < 0.7 AND n % 7 = 0 THEN 'masked repeat region' WHEN max_af > 0.01 THEN 'high MAF' WHEN term IN ({listed(SYNONYMOUS)}) THEN 'synonymous variant'
 WHEN term NOT IN ({listed((*CODING, *SPLICE))}) THEN 'variant type not supported' WHEN score IS NULL THEN 'missing prediction' WHEN n % 3 > 0 THEN 'passed all' WHEN n % 2 > 0 THEN 'HPO related to interacting genes' ELSE 'no HPO relation' END AS filter_comment FROM d)"""


@query("fx_variants", sql=JUDGED + " SELECT variant_id, filter_comment, CASE WHEN filter_comment IN ('passed all', 'HPO related to interacting genes') THEN 1 ELSE 0 END AS filter_passed FROM j")
def f06_all_outcomes(v):
    """Every rule of the cascade, on a frame that has all its columns."""
    n = F.col("variant_id")
    df = v.withColumnsRenamed({"filter_col": "filter", "max_af": "MAX_AF"}).withColumns({
        "final_score": F.when(n % 31 != 0, n % 100 / 100), "low_conf_region": F.when(n % 19 == 0, "x").otherwise(" "), "gene_excluded": n % 23 == 0, "simple_repeat": F.when(n % 5 == 0, "r"), "segmental_duplication": F.when(n % 6 == 0, "0.9").otherwise("0"),
        "context": F.element_at(F.array(*map(F.lit, ("AAAAAAAAAAA", "AAACAAAGAAA", "ACACACACACA", "ACGTACGTACG"))), (n % 4 + 1).cast("int")), "repeat_mask": F.when(n % 7 == 0, "m").otherwise("."),
        "similarity": F.when(n % 3 > 0, 0.2).otherwise(0.0), "partner_similarity": F.when(n % 2 > 0, 0.1).otherwise(0.0),
    })
    return filters.filtered(df).select("variant_id", "filter_comment", "filter_passed")


FAMILIES = f"""_, fam AS (SELECT variant_id, sample_id, symbol, chrom, 0 AS moved FROM fx_variants UNION ALL SELECT variant_id, sample_id + 100, symbol, chrom, 1 FROM fx_variants), typed AS (SELECT *, CASE sample_id % 3 WHEN 0 THEN 'SINGLE' WHEN 1 THEN 'TRIO' ELSE 'MULTI' END AS kind FROM fam),
gts AS (SELECT f.*, member, CASE WHEN kind = 'TRIO' AND sample_id % 4 = 1 AND member = 1 THEN 1 ELSE affected END AS affected, CASE WHEN moved = 1 AND {GT} = '0/0' THEN '0/1' ELSE {GT} END AS gt FROM typed f JOIN fx_genotypes USING (variant_id) WHERE kind <> 'SINGLE' OR member = 0),
w AS (SELECT sample_id, variant_id, symbol, chrom, kind, sum(affected) AS ill, max(CASE WHEN member = 0 THEN gt END) AS c, max(CASE WHEN member = 1 THEN gt END) AS p, max(CASE WHEN member = 2 THEN gt END) AS m,
 max(CASE WHEN affected = 0 AND gt = '0/1' OR affected = 1 AND gt = '0/0' OR gt = '1/1' THEN 1 ELSE 0 END) = 0 AND max(CASE WHEN affected = 1 AND gt = '0/1' OR affected = 0 AND gt = '0/0' THEN 1 ELSE 0 END) = 1 AND kind = 'TRIO' AS denovo,
 max(CASE WHEN affected = 1 AND gt = '0/0' OR affected = 0 AND gt IN ('0/1', '1/1') THEN 1 ELSE 0 END) = 0 AND max(CASE WHEN affected = 1 AND gt IN ('0/1', '1/1') OR affected = 0 AND gt = '0/0' THEN 1 ELSE 0 END) = 1 AND kind <> 'SINGLE' AS dominant,
 CASE kind WHEN 'SINGLE' THEN max(CASE WHEN gt = '1/1' THEN 1 ELSE 0 END) = 1 WHEN 'TRIO' THEN max(CASE WHEN affected = 1 AND gt IN ('0/0', '0/1') OR affected = 0 AND gt IN ('1/1', '0/0') THEN 1 ELSE 0 END) = 0 AND max(CASE WHEN affected = 1 AND gt = '1/1' OR affected = 0 AND gt = '0/1' THEN 1 ELSE 0 END) = 1
 ELSE max(CASE WHEN affected = 1 AND gt IN ('0/0', '0/1') OR affected = 0 AND gt = '1/1' THEN 1 ELSE 0 END) = 0 AND max(CASE WHEN affected = 1 AND gt = '1/1' OR affected = 0 AND gt IN ('0/1', '0/0') THEN 1 ELSE 0 END) = 1 END AS recessive,
 max(CASE WHEN affected = 1 AND gt IN ('0/0', '0/1') OR affected = 0 AND gt = '1/1' THEN 1 ELSE 0 END) = 0 AND max(CASE WHEN affected = 0 AND gt = '0/1' THEN 1 ELSE 0 END) = 1 AND max(CASE WHEN affected = 0 AND gt = '0/0' THEN 1 ELSE 0 END) = 1 AND kind <> 'SINGLE' AND chrom = 'chrX' AS xlinked
 FROM gts GROUP BY sample_id, variant_id, symbol, chrom, kind),
k AS (SELECT *, c = '0/1' AND p = '0/1' AND m = '0/0' AS a, c = '0/1' AND p = '0/0' AND m = '0/1' AS b FROM w), s AS (SELECT *, max(a) OVER g AND max(b) OVER g AS both_, sum(CASE WHEN c = '0/1' THEN 1 ELSE 0 END) OVER g AS hets FROM k WINDOW g AS (PARTITION BY sample_id, symbol))"""


@query("fx_variants", "fx_genotypes", sql=FAMILIES + """ SELECT sample_id, variant_id, concat_ws('&', CASE WHEN dominant THEN 'DOMINANT' END, CASE WHEN denovo THEN 'DOMINANT_DENOVO' END, CASE WHEN recessive THEN 'RECESSIVE' END,
 CASE WHEN symbol IS NOT NULL AND (kind = 'SINGLE' AND c = '0/1' AND hets >= 2 OR kind = 'TRIO' AND ill = 1 AND both_ AND (a OR b)) THEN 'COMPOUND' END, CASE WHEN xlinked THEN 'XLINKED' END) AS inheritance FROM s""")  # fmt: skip
def c03_families(v, g):
    """C3 for a cohort: single patients, trios (of some a parent is ill, too) and larger families in one job, two families
    for each variant."""
    moved = v.withColumns({"sample_id": F.col("sample_id") + 100})
    kind = F.element_at(F.array(*map(F.lit, inheritance.FAMILIES)), (F.col("sample_id") % 3 + 1).cast("int"))
    of = lambda d, gt: d.select("variant_id", "sample_id").join(g.withColumn("gt", gt), "variant_id")
    plain = F.replace("gt", F.lit("|"), F.lit("/"))
    gts = of(v, F.col("gt")).unionByName(of(moved, F.when(plain == "0/0", "0/1").otherwise(F.col("gt")))).withColumn("kind", kind).filter("kind <> 'SINGLE' OR member = 0")
    gts = gts.withColumn("affected", F.when((F.col("kind") == "TRIO") & (F.col("sample_id") % 4 == 1) & (F.col("member") == 1), 1).otherwise(F.col("affected")))
    return inheritance.inheritance(v.unionByName(moved), gts, "kind", keys=("sample_id",)).select("sample_id", "variant_id", "inheritance")


FULL = f"""_, {MOST}, known AS (SELECT sample_id, gene, CAST(substring(gene, 2) AS INT) AS k FROM (SELECT DISTINCT sample_id, gene FROM fx_rankings)), sim AS (SELECT sample_id, gene, k % 10 / 10.0 AS s FROM known WHERE k < 30), part AS (SELECT sample_id, gene, k % 7 / 10.0 AS p FROM known WHERE k >= 20),
g0 AS (SELECT v.*, term, {SCORED_SQL} AS raw, coalesce(CASE WHEN v.symbol IN (SELECT gene FROM sim) THEN v.symbol END, CASE WHEN variant_id % 9 < 8 THEN concat('G', CAST(variant_id % 9 AS VARCHAR)) END, v.symbol) AS gene, coalesce(symbol IN (SELECT upper(gene) FROM fx_exclusions), false) AS gone,
 CASE split_part(clinvar, '%', 1) WHEN 'Pathogenic' THEN 1.0 WHEN 'Benign/Likely_benign' THEN 0.25 WHEN 'Uncertain_significance' THEN 0.5 END AS c, CASE hgmd WHEN 'DM' THEN 1.0 WHEN 'DM?' THEN 0.75 END AS h, TRY_CAST(string_split(CASE WHEN cds_position <> 'NA' THEN cds_position END, '-')[1] AS DOUBLE) AS st, cds_length
 FROM fx_coding v JOIN most USING (variant_id) LEFT JOIN fx_transcripts ON feature = transcript_id WHERE max_af <= 0.02),
g1 AS (SELECT *, CASE WHEN (contains(consequence, 'frameshift') OR abs(length(ref) - length(alt)) % 3 <> 0) AND st <= cds_length THEN st / cds_length END AS share FROM g0),
g2 AS (SELECT *, raw - CASE WHEN share >= 0.99 THEN 0.05 WHEN share >= 0.98 THEN 0.04 WHEN share >= 0.97 THEN 0.03 WHEN share >= 0.96 THEN 0.02 WHEN share >= 0.95 THEN 0.01 ELSE 0 END AS cut FROM g1),
g3 AS (SELECT *, coalesce(0.8 * cut + 0.2 * coalesce((c + h) / 2, c, h), cut) AS path FROM g2), g4 AS (SELECT g3.*, coalesce(s, 0) AS s, coalesce(p, 0) AS p FROM g3 LEFT JOIN sim USING (sample_id, gene) LEFT JOIN part USING (sample_id, gene)),
g5 AS (SELECT *, CASE WHEN NOT gone THEN 0.34 * path + 0.65 * s + 0.01 * p END AS final_score FROM g4),
g6 AS (SELECT *, CASE WHEN filter_col = 'low_conf_region' OR filter_col = 'off-target' OR gone OR max_af > 0.01 OR term NOT IN ({listed((*CODING, *SPLICE))}) OR final_score IS NULL THEN '' WHEN s > 0 THEN 'passed all' WHEN p > 0 THEN 'HPO related to interacting genes' ELSE '' END AS comment FROM g5),
{VERDICTS}, {WIDE}, {PAIRS.replace("FROM wide)", "FROM wide WHERE variant_id IN (SELECT variant_id FROM g0))")}
SELECT sample_id, variant_id, gene, round(final_score, 6) AS final_score, comment AS filter_comment, rank() OVER (PARTITION BY sample_id ORDER BY round(final_score, 9) DESC) AS rank,
 concat_ws('&', CASE WHEN dominant = 1 THEN 'DOMINANT' END, CASE WHEN denovo = 1 THEN 'DOMINANT_DENOVO' END, CASE WHEN recessive = 1 THEN 'RECESSIVE' END, CASE WHEN variant_id IN (SELECT variant_id FROM pairs) THEN 'COMPOUND' END, CASE WHEN xlinked = 1 AND g6.chrom = 'chrX' THEN 'XLINKED' END) AS inheritance
FROM g6 JOIN verdicts USING (variant_id) WHERE comment <> ''"""


@query("fx_coding", "fx_variants", "fx_genotypes", "fx_transcripts", "fx_exclusions", "fx_rankings", sql=FULL)
def e03_full_ranking(v, _, g, t, e, r):
    """The whole pipeline with every resource: F9, F1, C1, C3, J6, X13, F5, J4 with current symbols, J5, X16, F6, W1."""
    known = r.select("sample_id", "gene").distinct().withColumn("k", F.substring("gene", 2, 9).cast("int"))
    sim = known.filter("k < 30").select("sample_id", "gene", (F.col("k") % 10 / 10).alias("similarity"))
    partners = known.filter("k >= 20").select("sample_id", "gene", (F.col("k") % 7 / 10).alias("partner_similarity"))
    df = as_features(v.drop("pathogenicity")).withColumn("hgnc_id", F.concat(F.lit("HGNC:"), (F.col("variant_id") % 9).cast("string")))
    hgnc = v.select((F.col("variant_id") % 9).alias("k")).distinct().filter("k < 8").select(F.col("k").cast("string").alias("hgnc_id"), F.concat(F.lit("G"), "k").alias("symbol"))
    out = pipelines.rf_ranking(df, FOREST, USED, rare=True, gene_similarity=sim, partners=partners, hgnc=hgnc, exclusions=e, transcripts=t, genotypes=g)
    return out.select("sample_id", "variant_id", "gene", r6("final_score").alias("final_score"), "filter_comment", "rank", "inheritance")


@query("fx_rankings", sql=f"_, {MERGED}, rf AS (SELECT * FROM ranked WHERE ranking = 'rf') SELECT sample_id, gene, concat(gene, '-rf') AS variant, rk AS rf_rank, round(score, 4) AS rf_score, coalesce((SELECT min(place) FROM rfp p WHERE p.sample_id = rf.sample_id AND p.gene = rf.gene), 4) AS rf_rank_llm FROM rf")
def c06_meta_table_rf(r):
    """The meta table of one ranking alone."""
    t = pipelines.meta_table_rf(rankings(r, "rf"), picks(r, "rf"))
    return t.select("sample_id", "gene", "variant", "rf_rank", F.round("rf_score", 4).alias("rf_score"), "rf_rank_llm")
