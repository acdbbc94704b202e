"""Queries of the sources and sinks: the text of a file is made from the given tables and written to the shared folder,
scanned again, and held against SQL on the tables themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


from .operators import genes, inheritance, ontology
from .plans import pipelines
from .queries import GT, PAIRS, SEV, VERDICTS, WIDE, X06, listed, nth_row, query as register, register_plain
from .shared import fresh, written
from .sources import readers, writers

#: What a text cell says where it says something.
FILLED = "CASE WHEN {0} NOT IN ('', '.', 'nan', 'NA') THEN {0} END"


#: As resources come: packed, in files that one task reads each.
PACKED = {"compression": "gzip", "maxRecordsPerFile": 1_000_000}


def text_file(lines: DataFrame, name: str, **options: str | int) -> str:
    """A folder of text files of the one column of ``lines``."""
    at = fresh(lines.sparkSession, name)
    lines.write.options(**options).text(at)
    return at


def table_file(df: DataFrame, name: str, sep: str = "\t", header: bool = True, **options: str | int) -> str:
    at = fresh(df.sparkSession, name)
    df.write.options(**options).option("sep", sep).option("header", header).option("emptyValue", "").option("comment", "\u0001").csv(at)
    return at


def with_lines(body: DataFrame, *lines: str | Column) -> DataFrame:
    """``body`` and more lines, before or after it."""
    spark = body.sparkSession
    return spark.createDataFrame([(x,) for x in lines], "value string").unionByName(body)


def tabbed(*columns: Column | str) -> Column:
    """Columns as one tab-separated line; null cells are empty."""
    return F.concat_ws("\t", *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]).alias("value")


VCF_HEAD = ("##fileformat=VCFv4.2", "##source=made", "##other=no", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1")


@register("fx_variants", sql=f"SELECT variant_id, chrom, {FILLED.format('symbol')} AS symbol, {FILLED.format('sift')} AS sift, {FILLED.format('filter_col')} AS filter_col FROM fx_variants")
def s01_variants_tsv(v):
    df = readers.variants_tsv(v.sparkSession, table_file(v.select("variant_id", "chrom", "symbol", "sift", "filter_col"), "variants"))
    return df.withColumn("variant_id", F.col("variant_id").cast("long"))


@register("fx_variants", "fx_genotypes", sql="SELECT chrom, pos, concat('rs', CAST(v.variant_id AS VARCHAR)) AS id, ref, alt, CAST(sample_id AS VARCHAR) AS qual, filter_col AS filter, concat('A=', impact) AS info, 'GT' AS format, gt AS \"S1\" FROM fx_variants v JOIN fx_genotypes g ON g.variant_id = v.variant_id WHERE member = 0")
def s02_vcf_records(v, g):
    rows = v.join(g.filter("member = 0"), "variant_id").select(tabbed("chrom", "pos", F.concat(F.lit("rs"), "variant_id"), "ref", "alt", "sample_id", "filter_col", F.concat(F.lit("A="), "impact"), F.lit("GT"), "gt"))
    return readers.vcf(v.sparkSession, text_file(with_lines(rows, *VCF_HEAD), "vcf"))[1]


@register("fx_variants", sql="SELECT chrom, pos, ref, alt, concat('rs', CAST(variant_id AS VARCHAR)) AS id FROM fx_variants WHERE chrom IN ('chr1', 'chrX')")
def s02_block_gzip(v):
    """One block-gzipped file, written in parts by all tasks, read by many; chromosomes and columns are left out by the source."""
    spark, at = v.sparkSession, fresh(v.sparkSession, "packed") + ".vcf.gz"
    records = v.select("chrom", "pos", F.concat(F.lit("rs"), "variant_id").alias("id"), "ref", "alt", F.lit(".").alias("qual"), F.lit("PASS").alias("filter"), F.sha2("clinvar", 512).alias("info"), F.lit("GT").alias("format"), F.lit("0/1").alias("S1"))
    writers.vcf(records, spark.createDataFrame([(x,) for x in VCF_HEAD], "line string"), at, block_gzip=True)
    return readers.vcf(spark, at, contigs="chr1,chrX", columns=8, split_bytes=50_000)[1].filter("S1 IS NULL AND format IS NULL").select("chrom", "pos", "ref", "alt", "id")


def s03_csq_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields are the regions' names."""
    names = spark.read.parquet(f"{sf_dir}/region.parquet").agg(F.array_join(F.array_sort(F.collect_list(F.struct("r_regionkey", "r_name")))["r_name"], "|").alias("n"))
    head = names.select(F.concat(F.lit('##INFO=<ID=CSQ,Number=.,Type=String,Description="Made. Format: '), "n", F.lit('">')).alias("value"))
    fields = readers.csq_fields(readers.header_lines(spark, text_file(with_lines(head, *VCF_HEAD), "head")))
    return spark.createDataFrame(list(enumerate(fields, 1)), "place long, field string")


def s04_sample_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    lines = nation.select(F.concat(F.lit("##SAMPLE=<ID="), "n_name", F.when(F.col("n_nationkey") % 2 == 0, ",DiseaseStatus=affected>").otherwise(">")).alias("value"))
    return spark.createDataFrame([(x,) for x in readers.sample_ids(readers.header_lines(spark, text_file(with_lines(lines, *VCF_HEAD), "head")))], "sample string")


@register("fx_variants", sql="SELECT chrom AS chr, CAST(pos AS VARCHAR) AS start, symbol AS gene, nullif(sift, '') AS evidence FROM fx_variants")
def s05_gsvar(v):
    rows = v.select(tabbed("chrom", "pos", "symbol", "sift"))
    return readers.gsvar(v.sparkSession, text_file(with_lines(rows, "##GENOME_BUILD=GRCh38", "#chr\tstart\tgene\tevidence"), "gsvar"))


OBO_SQL = """_, t AS (SELECT term, term % 17 = 0 AS gone FROM (SELECT DISTINCT term FROM fx_edges)), n AS (SELECT concat('P', CAST(term AS VARCHAR)) AS p, * FROM t)
SELECT 'term' AS kind, p AS a, concat('name ', CAST(term AS VARCHAR)) AS b FROM n WHERE NOT gone UNION ALL SELECT 'edge', p, concat('P', CAST(parent AS VARCHAR)) FROM n JOIN fx_edges USING (term) WHERE NOT gone
UNION ALL SELECT 'replacement', concat('A', CAST(term AS VARCHAR)), p FROM n WHERE NOT gone AND term % 10 = 0 UNION ALL SELECT 'replacement', p, concat('P', CAST(term + 1 AS VARCHAR)) FROM n WHERE gone AND term % 2 = 0
UNION ALL SELECT 'replacement', p, concat('P', CAST(term + 2 AS VARCHAR)) FROM n WHERE gone AND term % 2 = 1 UNION ALL SELECT 'synonym', p, concat('the ', CAST(term AS VARCHAR), 'th') FROM n WHERE NOT gone AND term % 3 = 0"""


@register("fx_edges", sql=OBO_SQL)
def s06_ontology(e):
    """G1 included: obsolete terms lose their edges, and are replaced by what the file names or says to consider."""
    p = lambda c: F.concat(F.lit("P"), c.cast("string"))
    tag = lambda name, c, test=None: F.concat(F.lit(f"{name}: "), c, F.lit("\n")) if test is None else F.when(test, F.concat(F.lit(f"{name}: "), c, F.lit("\n"))).otherwise("")
    t, gone = F.col("term"), F.col("term") % 17 == 0
    terms = e.groupBy("term").agg(F.collect_set("parent").alias("up"))
    stanza = F.concat(F.lit("[Term]\n"), tag("id", p(t)), tag("name", F.concat(F.lit("name "), t.cast("string"))), tag("alt_id", F.concat(F.lit("A"), t.cast("string")), (t % 10 == 0) & ~gone),
                      tag("synonym", F.concat(F.lit('"the '), t.cast("string"), F.lit('th" EXACT []')), t % 3 == 0), F.array_join(F.transform("up", lambda x: tag("is_a", F.concat(p(x), F.lit(" ! parent")))), ""),
                      F.when(gone, "is_obsolete: true\n").otherwise(""), tag("replaced_by", p(t + 1), gone & (t % 2 == 0)), tag("consider", p(t + 2), gone & (t % 2 == 1)))
    o = readers.obo(e.sparkSession, text_file(terms.select(stanza.alias("value")), "obo"))
    of = lambda kind, df, a, b: df.select(F.lit(kind).alias("kind"), F.col(a).alias("a"), F.col(b).alias("b"))
    return of("term", o["terms"], "term", "name").unionByName(of("edge", o["edges"], "term", "parent")).unionByName(of("replacement", o["replacements"], "term", "replaced_by")).unionByName(of("synonym", o["synonyms"], "term", "synonym"))


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def s07_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lineitem(spark, sf_dir).select(F.when(F.col("l_linenumber") == 1, "#comment").otherwise("db").alias("db"), F.concat(F.lit("H"), "l_partkey").alias("hpo_id"))
    return readers.term_counts(spark, table_file(rows, "annotations"))


def s08_gene_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 included: distinct terms of each gene."""
    rows = lineitem(spark, sf_dir).select(F.concat(F.lit("H"), "l_partkey").alias("hpo_id"), F.lit("n").alias("name"), F.lit(1).alias("ncbi"), F.concat(F.lit("g"), F.col("l_suppkey") % 50).alias("gene_symbol"))
    return readers.gene_terms(spark, table_file(rows, "gene-terms"))


def s09_hgnc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.concat(F.lit("HGNC:"), F.col("s_suppkey") % 40).alias("id"), F.concat(F.lit("g"), "s_suppkey").alias("symbol"))
    return readers.hgnc(spark, table_file(rows, "hgnc"))


@register("fx_interactions", sql="SELECT gene, partner, conf_exp, conf_db FROM fx_interactions WHERE conf_exp >= 900 OR conf_db >= 900")
def s10_interactions(i):
    """Both files, then their join and its confidence filter."""
    one = lambda c: F.lit(1).alias(c)
    links = table_file(i.select(F.concat(F.lit("9606.P"), "gene").alias("protein1"), F.concat(F.lit("9606.P"), "partner").alias("protein2"), one("a"), one("b"), one("c"), one("d"), "conf_exp", "conf_db"), "links", sep=" ")
    ends = i.select("gene").unionByName(i.select(F.col("partner").alias("gene"))).distinct()
    named = ends.select(F.concat(F.lit("9606.P"), "gene").alias("p"), F.lower("gene").alias("alias"), F.lit("Ensembl_HGNC_symbol").alias("source")).unionByName(ends.select(F.concat(F.lit("9606.P"), "gene").alias("p"), F.lit("other").alias("alias"), F.lit("UniProt").alias("source")))
    spark = i.sparkSession
    return genes.interactions(readers.interaction_links(spark, links), genes.first_aliases(readers.interaction_aliases(spark, table_file(named, "aliases"))))


@register("fx_transcripts", sql="SELECT transcript_id, CAST(cds_length AS BIGINT) AS cds_length FROM fx_transcripts WHERE cds_length <> 103")
def s11_transcripts(t):
    rows = t.select(F.lit("G").alias("gene"), "transcript_id", F.when(F.col("cds_length") == 103, " ").otherwise(F.concat(F.lit(" "), "cds_length")).alias("length"))
    return readers.transcripts(t.sparkSession, table_file(rows, "transcripts"))


def s12_pedigree(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    rows = c.select(F.concat(F.when(F.col("c_custkey") % 11 == 0, "#F").otherwise("F"), "c_nationkey"), F.concat(F.lit("m"), "c_custkey"), F.lit(0), F.lit(0), F.lit(1), F.element_at(F.array(*map(F.lit, ("2", "1", "0", "-9"))), (F.col("c_custkey") % 4 + 1).cast("int")))
    return readers.pedigree(spark, table_file(rows, "ped", header=False))


def s13_query_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a file with several terms a line, and of a comma list (of the regions' names)."""
    rows = lineitem(spark, sf_dir).select(F.concat(F.lit("HP:"), "l_partkey", F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit(", HP:"), "l_suppkey")).otherwise("")).alias("value"))
    names = spark.read.parquet(f"{sf_dir}/region.parquet").agg(F.array_join(F.collect_list("r_name"), ", ")).first()[0]
    of = lambda kind, df: df.select(F.lit(kind).alias("source"), "term")
    return of("file", readers.query_terms(spark, text_file(rows, "terms"))).unionByName(of("list", readers.query_terms(spark, f"{names},{names}")))


def s14_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    lines = c.select(F.when(F.col("c_custkey") % 7 == 0, "").when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("# g"), "c_custkey")).otherwise(F.concat(F.lit("g"), F.col("c_custkey") % 100, F.lit("\twhy"))).alias("value"))
    return readers.listed(spark, text_file(lines, "exclusions"))


@register("fx_transcripts", sql="SELECT DISTINCT concat(transcript_id, '.', CAST(cds_length % 3 AS VARCHAR)) AS transcript FROM fx_transcripts")
def s15_canonical(t):
    lines = t.select(F.concat("transcript_id", F.lit("."), F.col("cds_length") % 3).alias("value"))
    return readers.listed(t.sparkSession, text_file(with_lines(lines.unionByName(lines), "# id"), "canonical"), "transcript", upper=False)


def s16_fasta_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs of 70-base lines, cut again into tiles of 32."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", F.translate(F.md5("c_name"), "0123456789abcdef", "ACGTACGTAAAACCGT").alias("s"))
    whole = c.groupBy((F.col("c_custkey") % 25).alias("k")).agg(F.array_join(F.array_sort(F.collect_list(F.struct("c_custkey", "s")))["s"], "").alias("s"))
    lines = whole.select(F.concat(F.lit(">c"), "k", F.lit(" made\n"), F.array_join(F.regexp_extract_all("s", F.lit(".{1,70}"), 0), "\n")).alias("value"))
    return readers.fasta_tiles(spark, text_file(lines, "fasta"), 32)


PLACE = "CASE WHEN l_linenumber % 2 = 0 THEN 'chr' ELSE '' END || CAST(l_suppkey % 5 AS VARCHAR)"
SCORE_ROWS = f"_, l AS (SELECT 'chr' || CAST(l_suppkey % 5 AS VARCHAR) AS chrom, l_orderkey * 10 + l_linenumber AS pos, 'A' AS ref, 'G' AS alt, CAST(l_partkey AS VARCHAR) AS score, l_linenumber % 4 AS k FROM lineitem)"


def s17_score_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven score resources (S17a to S17g; the sixth from two inputs at once, U5): resource and the common columns.
    Every fourth row has no score and is dropped."""
    l_ = lineitem(spark, sf_dir).select(F.concat(F.when(F.col("l_linenumber") % 2 == 0, "chr").otherwise(""), F.col("l_suppkey") % 5).alias("c"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("p"),
                                        F.when(F.col("l_linenumber") % 4 == 0, F.lit(".")).otherwise(F.col("l_partkey").cast("string")).alias("s"), "l_linenumber")
    a, g, x = F.lit("a").alias("ref"), F.lit("G").alias("alt"), lambda n: [F.lit("x").alias(f"x{i}") for i in range(n)]
    out = {
        "cadd": readers.score_table(spark, text_file(with_lines(l_.select(tabbed("c", "p", a, g, F.lit("0.1"), "s")), "## CADD", "#Chrom\tPos\tRef\tAlt\tRawScore\tPHRED"), "cadd", **PACKED), "cadd"),
        "capice": readers.score_table(spark, text_file(with_lines(l_.select(tabbed("c", "p", a, g, "s")), "#chr\tpos\tref\talt\tscore"), "capice", **PACKED), "capice"),
        "fathmm_xf": readers.score_table(spark, text_file(l_.select(tabbed("c", "p", a, g, "s")), "fathmm", **PACKED), "fathmm_xf"),
        "eigen": readers.score_table(spark, text_file(with_lines(l_.select(tabbed("c", "p", a, g, *x(14), "s", *x(2))), "chr\tpos\tref\talt"), "eigen", **PACKED), "eigen"),
        "condel": readers.condel(spark, table_file(l_.select(F.col("c").alias("CHR"), F.col("p").alias("START"), a.alias("REF"), g.alias("ALT"), F.col("s").alias("CONDEL")), "condel", **PACKED)),
    }
    m = l_.select(F.concat_ws(",", F.lit("hg38"), "c", "p", a, g).alias("Mutation"), F.lit("v").alias("Variant"), F.col("s").alias("FI score"), "l_linenumber")
    out["mutation_assessor"] = readers.mutation_assessor(spark, [table_file(m.filter(t).drop("l_linenumber"), "assessor", sep=",", **PACKED) for t in ("l_linenumber <= 3", "l_linenumber > 3")])
    r = table_file(l_.select(F.col("c").alias("chr"), F.col("p").alias("hg19_pos"), F.when(F.col("l_linenumber") == 1, ".").otherwise((F.col("p") + 7).cast("string")).alias("grch38_pos"), a, g, F.col("s").alias("REVEL")), "revel", sep=",", **PACKED)
    out["revel_hg19"], out["revel_grch38"] = readers.revel(spark, r)
    every = [df.select(F.lit(k).alias("resource"), "chrom", "pos", "ref", "alt", "score") for k, df in out.items()]
    first = every[0]
    for df in every[1:]:
        first = first.unionByName(df)
    return first


def s18_clinvar(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    sig = F.when(n % 4 == 0, "CLNSIG=;").when(n % 4 == 1, "CLNSIG=Conflicting_interpretations_of_pathogenicity;").when(n == 7, "").otherwise("CLNSIG=Benign;")
    rows = lineitem(spark, sf_dir).select(tabbed(F.concat(F.lit(""), F.col("l_suppkey") % 5), F.col("l_orderkey") * 10 + n, F.lit("."), F.lit("A"), F.when(n == 2, ".").otherwise("G"), F.lit("."), F.lit("."), F.concat(F.lit("X=1;"), sig, F.lit("CLNDN=d"), "l_partkey", F.when(n == 3, ";CLNDNINCL=i").otherwise(""))))
    return readers.clinvar(spark, text_file(with_lines(rows, *VCF_HEAD[:2], "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"), "clinvar"))


def s19_gnomad(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    info = F.concat(F.lit("AN="), "l_partkey", F.when(n == 1, "").otherwise(";AF=0.25"), F.when(n == 2, ";nhomalt=.").otherwise(F.concat(F.lit(";nhomalt="), "l_suppkey")), F.lit(";AF_afr=0.5"), F.when(n > 4, ";AF_sas=0.125").otherwise(""))
    rows = lineitem(spark, sf_dir).select(tabbed(F.lit("chr7"), F.col("l_orderkey") * 10 + n, F.lit("."), F.lit("A"), F.lit("G"), F.lit("."), F.lit("."), info))
    return readers.gnomad(spark, text_file(with_lines(rows, *VCF_HEAD[:2], "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"), "gnomad"))


@register("fx_regions", sql="SELECT chrom, start0, end0, concat(name, ' (Simple_repeat)') AS name FROM fx_regions")
def s20_repeatmasker(r):
    cells = F.concat(F.lit("  463   1.3  0.6  1.7  "), "chrom", F.lit("   "), (F.col("start0") + 1).cast("string"), F.lit("  "), F.col("end0").cast("string"), F.lit(" (5) +  "), "name", F.lit(" Simple_repeat   1 2 (3) 4"))
    return readers.repeatmasker(r.sparkSession, text_file(with_lines(r.select(cells.alias("value")), "   SW   perc perc perc  query position in query matching repeat position in repeat", "score   div. del. ins.  sequence begin end (left) repeat class/family begin end (left) ID", ""), "repeats"))


@register("fx_regions", sql="SELECT chrom, start0, end0, name, 'named' AS kind FROM fx_regions WHERE end0 % 9 <> 0 UNION ALL SELECT chrom, start0, end0, '1', 'bare' FROM fx_regions")
def s21_bed(r):
    spark = r.sparkSession
    named = text_file(with_lines(r.select(tabbed("chrom", "start0", "end0", F.when(F.col("end0") % 9 == 0, "NA").otherwise(F.col("name")))), "track name=x", "# c", "browser y"), "bed")
    bare = text_file(r.select(tabbed("chrom", "start0", "end0")), "bed")
    return readers.bed(spark, named).withColumn("kind", F.lit("named")).unionByName(readers.bed(spark, bare, name=None).withColumn("kind", F.lit("bare")))


@register("fx_regions", sql="SELECT chrom, start0, end0, CAST(end0 % 100 AS DOUBLE) / 8 AS value, unnest(['text', 'parquet']) AS kind FROM fx_regions")
def s22_track(r):
    """An interval export as text, and as Parquet."""
    df = r.select("chrom", "start0", "end0", (F.col("end0") % 100 / 8).cast("double").alias("value"))
    spark, at = r.sparkSession, fresh(r.sparkSession, "track") + ".parquet"
    df.write.parquet(at)
    return readers.track(spark, text_file(df.select(tabbed(*df.columns)), "track")).withColumn("kind", F.lit("text")).unionByName(readers.track(spark, at).withColumn("kind", F.lit("parquet")))


@register("fx_variants", sql="SELECT variant_id, symbol, unnest(CASE WHEN variant_id % 3 = 0 THEN ['all', 'filtered'] ELSE ['all'] END) AS file FROM fx_variants")
def k01_results(v):
    at = fresh(v.sparkSession, "results")
    writers.results(v.select("variant_id", "symbol", F.when(F.col("variant_id") % 3 == 0, 1).otherwise(0).alias("filter_passed")), at)
    back = lambda name: v.sparkSession.read.parquet(f"{at}/{name}").select("variant_id", "symbol", F.lit(name).alias("file"))
    return back("all").unionByName(back("filtered"))


@register("fx_variants", "fx_genotypes", sql=f"""_, {VERDICTS}, {WIDE}, {PAIRS}, flags AS (SELECT variant_id, unnest([CASE WHEN dominant = 1 THEN 'dominant' END, CASE WHEN denovo = 1 THEN 'dominant_denovo' END, CASE WHEN recessive = 1 THEN 'recessive' END,
 CASE WHEN variant_id IN (SELECT variant_id FROM pairs) THEN 'compound' END, CASE WHEN xlinked = 1 AND chrom = 'chrX' THEN 'xlinked' END]) AS inheritance_mode FROM wide JOIN verdicts USING (variant_id)) SELECT variant_id, inheritance_mode FROM flags WHERE inheritance_mode IS NOT NULL""")  # fmt: skip
def k02_files_by_mode(v, g):
    """All five modes, from the partitioned sink."""
    at = fresh(v.sparkSession, "modes")
    writers.by_mode(inheritance.inheritance(v, g), at)
    return v.sparkSession.read.parquet(at).select("variant_id", "inheritance_mode")


@register("fx_variants", sql="SELECT variant_id, row_number() OVER (ORDER BY chrom, pos, variant_id) AS place FROM fx_variants")
def k03_sorted_tsv(v):
    """A gzip table in order (T2): rows keep their place over the files."""
    at = fresh(v.sparkSession, "sorted")
    writers.tsv(v.select("chrom", "pos", "variant_id"), at, gzip=True, sort=("chrom", "pos", "variant_id"))
    back = readers.variants_tsv(v.sparkSession, at).select(F.col("variant_id").cast("long"), F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("nth"))
    from pyspark.sql import Window

    files = written(back.groupBy("file").agg(F.count("*").alias("n"), F.min("nth").alias("first")), "files")  # a file's rows have ids in a row
    before = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return back.join(F.broadcast(files.select("file", (before - F.col("first") + 1).alias("shift"))), "file").select("variant_id", (F.col("nth") + F.col("shift")).alias("place"))


@register("fx_variants", sql="SELECT chrom, pos, ref, alt, CASE WHEN length(ref) = 1 AND length(alt) = 1 THEN 'snv' ELSE 'indel' END AS file FROM fx_variants WHERE (length(ref) = 1 OR length(alt) = 1) AND NOT contains(alt, ',')")
def k04_split_vcf(v):
    from .operators import annotate

    spark, at = v.sparkSession, fresh(v.sparkSession, "split")
    records = v.select("chrom", "pos", F.lit(".").alias("id"), "ref", "alt", F.lit(".").alias("qual"), F.lit("PASS").alias("filter"), F.lit("X=1").alias("info"))
    head = spark.createDataFrame([(x,) for x in (VCF_HEAD[0], VCF_HEAD[2], "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO")], "line string")
    writers.split_vcf(annotate.routed(records), head, at)
    return readers.vcf(spark, f"{at}/snv")[1].withColumn("file", F.lit("snv")).unionByName(readers.vcf(spark, f"{at}/indel")[1].withColumn("file", F.lit("indel"))).select("chrom", "pos", "ref", "alt", "file")


@register("fx_variants", sql="SELECT pos, file, row_number() OVER (PARTITION BY file ORDER BY chrom, pos) + 2 AS place FROM (SELECT chrom, pos, CASE WHEN length(ref) = 1 AND length(alt) = 1 THEN 'snv' ELSE 'indel' END AS file FROM fx_variants WHERE (length(ref) = 1 OR length(alt) = 1) AND NOT contains(alt, ','))")
def k04_one_file(v):
    """Each route as one file in order, made of parts that all tasks write; place is the line in the file."""
    from .operators import annotate

    spark, at = v.sparkSession, fresh(v.sparkSession, "one")
    records = v.select("chrom", "pos", F.lit(".").alias("id"), "ref", "alt", F.lit(".").alias("qual"), F.lit("PASS").alias("filter"), F.lit("X=1").alias("info"))
    head = spark.createDataFrame([(x,) for x in (VCF_HEAD[0], "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO")], "line string")
    writers.split_vcf(annotate.routed(records), head, at, single_file=True)
    every = [spark.read.text(f"{at}/{k}.vcf").select(F.lit(k).alias("file"), F.monotonically_increasing_id().alias("_id"), "value") for k in ("snv", "indel")]
    numbered = [nth_row(df, "file", out="place") for df in every]
    lines = numbered[0].unionByName(numbered[1])
    return lines.filter(~F.col("value").startswith("#")).select(F.split("value", "\t")[1].cast("long").alias("pos"), "file", "place")


def k05_reduced_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs of even nations are kept, the other lines go."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.concat(F.when(F.col("n_nationkey") % 2 == 0, "##contig=<ID=").otherwise("##command=<ID="), "n_name", F.lit(">")).alias("value"))
    head = with_lines(n, *VCF_HEAD).withColumnRenamed("value", "line")
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.lit("chr1").alias("chrom"), F.col("c_custkey").alias("pos"), F.lit(".").alias("id"), F.lit("A").alias("ref"), F.lit("G").alias("alt"))
    at = fresh(spark, "reduced")
    writers.vcf(c, head, at, reduced=True)
    return spark.read.text(at).select(F.col("value").alias("line"))


@register("fx_variants", "fx_genotypes", sql=f"""_, {X06}, s AS (SELECT v.*, g.gt FROM fx_variants v JOIN fx_genotypes g ON g.variant_id = v.variant_id AND member = 0)
SELECT s.chrom AS chr, CAST(k_start AS VARCHAR) AS start, CAST(k_end AS VARCHAR) AS "end", k_ref AS ref, k_alt AS obs, nullif(filter_col, '.') AS filter,
 concat(coalesce(symbol, ''), ':T', CAST(s.variant_id % 50 AS VARCHAR), ':', consequence, ':', impact, '::::') AS coding_and_splicing, CAST(NULL AS VARCHAR) AS "OMIM", clinvar AS "ClinVar", hgmd AS "HGMD", CAST(s.variant_id % 8 AS VARCHAR) AS gnomAD,
 CASE WHEN s.variant_id % 3 <> 0 THEN concat(CASE WHEN s.variant_id % 3 = 1 THEN '1' ELSE 'nan' END, ',nan,', CASE WHEN s.variant_id % 3 = 2 THEN '2' ELSE 'nan' END, ',nan,nan') END AS "gnomAD_sub", CAST(NULL AS VARCHAR) AS "phyloP", CAST(NULL AS VARCHAR) AS "SpliceAI",
 concat(coalesce(symbol, ''), ' (inh=n/a oe_syn=n/a oe_mis=n/a oe_lof=', CASE WHEN s.variant_id % 4 = 0 THEN '0.25' ELSE 'n/a' END, ')') AS gene_info, CAST(NULL AS VARCHAR) AS "NGSD_hom", CAST(NULL AS VARCHAR) AS "NGSD_het", CAST(NULL AS VARCHAR) AS classification, CAST(NULL AS VARCHAR) AS "MaxEntScan",
 concat('QUAL=', CAST(s.variant_id AS VARCHAR)) AS quality, CASE {GT} WHEN '1/1' THEN 'hom' WHEN '0/1' THEN 'het' WHEN '0/0' THEN 'wt' ELSE 'n/a' END AS "S1" FROM s JOIN keys USING (variant_id)""")  # fmt: skip
def k06_exchange_file(v, g):
    """All 21 columns of the exchange format, written as text and read back."""
    n = F.col("variant_id")
    df = v.join(g.filter("member = 0").select("variant_id", "gt"), "variant_id").withColumnsRenamed({"filter_col": "filter"}).withColumns({
        "feature": F.concat(F.lit("T"), n % 50), "qual": n, "MAX_AF": n % 8, "gnomADg_AFR_AF": F.when(n % 3 == 1, "1"), "gnomADg_EAS_AF": F.when(n % 3 == 2, "2"), "oe_lof": F.when(n % 4 == 0, "0.5&0.25&-1:3"),
    })
    for c in ("gnomADg_AMR_AF", "gnomADg_NFE_AF", "gnomADg_SAS_AF"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    at = fresh(v.sparkSession, "exchange")
    writers.gsvar(df, at, "S1")
    return readers.gsvar(v.sparkSession, at)


@register("fx_rankings", sql="SELECT sample_id, gene, '[' || CAST(count(*) AS VARCHAR) || ',' || CAST(sample_id AS VARCHAR) || ']' AS picks FROM fx_rankings GROUP BY sample_id, gene")
def k07_meta_tsv(r):
    """A table with a nested column as JSON text."""
    at = fresh(r.sparkSession, "meta")
    writers.tsv(r.groupBy("sample_id", "gene").agg(F.count("*").alias("n")).select("sample_id", "gene", F.array("n", "sample_id").alias("picks")), at, sort=("sample_id", "gene"))
    return readers.variants_tsv(r.sparkSession, at).withColumn("sample_id", F.col("sample_id").cast("long"))


FIELDS = ["Allele", "Consequence", "IMPACT", "SYMBOL", "HGNC_ID", "Feature", "CDS_position", "gnomADg_AFR_AF", "gnomADg_EAS_AF", "SpliceAI_pred_DS_AG", "SpliceAI_pred_DS_DL", "Hom", "AN"]
CANONICAL = [f"T{i}" for i in range(0, 50, 10)]
FLAT_SQL = f"""_, {SEV}, g AS (SELECT * FROM fx_genotypes WHERE member = 0), two AS (SELECT v.*, g.gt, unnest([1, 2]) AS i FROM fx_variants v JOIN g ON g.variant_id = v.variant_id),
r AS (SELECT *, CASE i WHEN 1 THEN 'intron_variant' ELSE consequence END AS c, CASE i WHEN 1 THEN 'LOW' ELSE impact END AS imp, concat('T', CAST((variant_id * i) % 50 AS VARCHAR)) AS f FROM two),
t AS (SELECT variant_id, i, string_split(c, '&') AS ts FROM r), u AS (SELECT variant_id, i, unnest(ts) AS t, unnest(range(1, len(ts) + 1)) AS k FROM t), m AS (SELECT variant_id, i, arg_min(u.t, coalesce(s, 42) * 100 + k) AS term, min(coalesce(s, 42)) AS sv FROM u LEFT JOIN sev ON sev.t = u.t GROUP BY variant_id, i),
best AS (SELECT variant_id, arg_min(i, CASE WHEN f IN ({listed(CANONICAL)}) THEN i ELSE 1000 + sv * 10 + i END) AS i FROM r JOIN m USING (variant_id, i) GROUP BY variant_id)
SELECT chrom, pos, ref, alt, CAST(variant_id AS VARCHAR) AS qual, c AS consequence, imp AS impact, nullif(coalesce(symbol, ''), '') AS symbol, f AS feature, term AS most_severe, CASE WHEN imp = 'HIGH' THEN 1 ELSE 0 END AS "HIGH_IMPACT", 0 AS "IS_INDEL",
 {FILLED.format('gt')} AS gt, CASE WHEN variant_id % 4 = 0 THEN NULL ELSE CAST(variant_id % 30 AS INT) END AS dp, CAST(sample_id AS INT) AS ad_ref, CAST(variant_id % 5 AS INT) AS ad_alt, CASE WHEN sample_id + variant_id % 5 = 0 THEN 0.0 ELSE round((variant_id % 5) / (sample_id + variant_id % 5), 6) END AS af,
 CAST(CASE WHEN variant_id % 6 = 0 THEN 0.5 ELSE 0.25 END AS DOUBLE) AS "MAX_AF", CAST(CASE WHEN variant_id % 2 = 0 THEN 0.75 ELSE 0.125 END AS DOUBLE) AS spliceai, CASE WHEN variant_id % 7 > 0 THEN round((variant_id % 7) / 100.0, 6) END AS "homAF" FROM r JOIN best USING (variant_id, i) JOIN m USING (variant_id, i)"""


@register("fx_variants", "fx_genotypes", sql=FLAT_SQL)
def c04_flattened_vcf(v, g):
    """A VCF with CSQ and sample columns to annotated variants: S2, S3, X3, J13, X4, X5, A11 and X9 in one plan."""
    n = F.col("variant_id")
    record = lambda i, c, imp: F.concat_ws("|", "alt", c, imp, F.coalesce("symbol", F.lit("")), F.lit("HGNC:1"), F.concat(F.lit("T"), n * i % 50), F.lit(""), F.when(n % 6 == 0, "0.1&0.5").otherwise("0.25"), F.lit("."), F.when(n % 2 == 0, "0.75").otherwise("."), F.lit("0.125"), (n % 7).cast("string"), F.lit("100"))
    info = F.concat(F.lit("DP=3;CSQ="), record(1, F.lit("intron_variant"), F.lit("LOW")), F.lit(","), record(2, F.col("consequence"), F.col("impact")))
    sample = F.concat_ws(":", "gt", F.when(n % 4 == 0, ".").otherwise((n % 30).cast("string")), F.concat_ws(",", F.col("sample_id").cast("string"), (n % 5).cast("string")))
    rows = v.join(g.filter("member = 0"), "variant_id").select(tabbed("chrom", "pos", F.lit("."), "ref", "alt", n, F.lit("PASS"), info, F.lit("GT:DP:AD:GQ"), sample))
    head = [VCF_HEAD[0], f'##INFO=<ID=CSQ,Number=.,Type=String,Description="Made. Format: {"|".join(FIELDS)}">', VCF_HEAD[3]]
    lines, records = readers.vcf(v.sparkSession, text_file(with_lines(rows, *head), "vcf"))
    flat = pipelines.flattened(records.withColumnRenamed("S1", "sample"), readers.csq_fields(lines), CANONICAL)
    six = lambda c: F.round(c, 6).alias(c)
    return flat.select("chrom", "pos", "ref", "alt", "qual", "consequence", "impact", "symbol", "feature", "most_severe", "HIGH_IMPACT", "IS_INDEL", "gt", "dp", "ad_ref", "ad_alt", six("af"), "MAX_AF", "spliceai", six("homAF"))


@register("fx_edges", sql="_, n AS (SELECT DISTINCT parent AS term FROM fx_edges) SELECT q.term, concat('name ', CAST(q.term AS VARCHAR)) AS name FROM (SELECT DISTINCT term FROM fx_edges) q JOIN n USING (term)")
def j12_term_names(e):
    """Terms to names; those without one are dropped."""
    names = e.select(F.col("parent").alias("term")).distinct().withColumn("name", F.concat(F.lit("name "), "term"))
    return ontology.term_names(e.select("term").distinct(), names).select("term", "name")


register_plain(s03_csq_fields, "SELECT row_number() OVER (ORDER BY r_regionkey) AS place, r_name AS field FROM region")
register_plain(s04_sample_ids, "SELECT n_name AS sample FROM nation")
register_plain(s07_term_counts, "SELECT concat('H', CAST(l_partkey AS VARCHAR)) AS term, count(*) AS n FROM lineitem WHERE l_linenumber <> 1 GROUP BY 1")
register_plain(s08_gene_terms, "SELECT DISTINCT concat('G', CAST(l_suppkey % 50 AS VARCHAR)) AS gene, concat('H', CAST(l_partkey AS VARCHAR)) AS term FROM lineitem")
register_plain(s09_hgnc, "SELECT CAST(s_suppkey % 40 AS VARCHAR) AS hgnc_id, max(concat('G', CAST(s_suppkey AS VARCHAR))) AS symbol FROM supplier GROUP BY 1")
register_plain(s12_pedigree, "SELECT concat('F', CAST(c_nationkey AS VARCHAR)) AS family, concat('m', CAST(c_custkey AS VARCHAR)) AS member, CASE c_custkey % 4 WHEN 0 THEN 1 ELSE 0 END AS affected FROM customer WHERE c_custkey % 4 < 2 AND c_custkey % 11 <> 0")
register_plain(s13_query_terms, "SELECT 'file' AS source, term FROM (SELECT concat('HP:', CAST(l_partkey AS VARCHAR)) AS term FROM lineitem UNION SELECT concat('HP:', CAST(l_suppkey AS VARCHAR)) FROM lineitem WHERE l_linenumber % 2 = 0) UNION ALL SELECT 'list', r_name FROM region")
register_plain(s14_exclusions, "SELECT DISTINCT concat('G', CAST(c_custkey % 100 AS VARCHAR)) AS gene FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 5 <> 0")
register_plain(s16_fasta_tiles, "WITH s AS (SELECT c_custkey % 25 AS k, string_agg(translate(md5(c_name), '0123456789abcdef', 'ACGTACGTAAAACCGT'), '' ORDER BY c_custkey) AS s FROM customer GROUP BY 1) SELECT concat('c', CAST(k AS VARCHAR)) AS chrom, tile, substring(s, tile * 32 + 1, 32) AS seq FROM (SELECT k, s, unnest(range(0, (length(s) + 31) // 32)) AS tile FROM s)")
register_plain(s17_score_tables, f"WITH {SCORE_ROWS.removeprefix('_, ')} SELECT resource, chrom, CASE WHEN resource = 'revel_grch38' THEN pos + 7 ELSE pos END AS pos, ref, alt, score FROM l, (SELECT unnest(['cadd', 'capice', 'fathmm_xf', 'eigen', 'condel', 'mutation_assessor', 'revel_hg19', 'revel_grch38']) AS resource) WHERE k <> 0 AND NOT (resource = 'revel_grch38' AND pos % 10 = 1)")
register_plain(s18_clinvar, "SELECT concat('chr', CAST(l_suppkey % 5 AS VARCHAR)) AS chrom, l_orderkey * 10 + l_linenumber AS pos, 'A' AS ref, 'G' AS alt, concat('Benign%20d', CAST(l_partkey AS VARCHAR), '%3D', CASE WHEN l_linenumber = 3 THEN 'i' ELSE '' END) AS score FROM lineitem WHERE l_linenumber % 4 > 1 AND l_linenumber NOT IN (2, 7)")
register_plain(s19_gnomad, "SELECT 'chr7' AS chrom, l_orderkey * 10 + l_linenumber AS pos, 'A' AS ref, 'G' AS alt, CAST(l_partkey AS DOUBLE) AS an, CAST(0.25 AS DOUBLE) AS af, CAST(l_suppkey AS DOUBLE) AS hom, CAST(0.5 AS DOUBLE) AS af_afr, CAST(NULL AS DOUBLE) AS af_amr, CAST(NULL AS DOUBLE) AS af_eas, CAST(NULL AS DOUBLE) AS af_nfe, CASE WHEN l_linenumber > 4 THEN CAST(0.125 AS DOUBLE) END AS af_sas FROM lineitem WHERE l_linenumber NOT IN (1, 2)")
register_plain(k05_reduced_header, "SELECT concat('##contig=<ID=', n_name, '>') AS line FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT unnest(['##fileformat=VCFv4.2', '##source=made', concat_ws(chr(9), '#CHROM', 'POS', 'ID', 'REF', 'ALT', 'QUAL', 'FILTER', 'INFO', 'FORMAT', 'S1')]) UNION ALL SELECT concat_ws(chr(9), 'chr1', CAST(c_custkey AS VARCHAR), '.', 'A', 'G') FROM customer")
