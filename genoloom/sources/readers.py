"""Scans of variant, resource and ontology files as DataFrames. Block-gzipped VCF files are read in many tasks; other gzip
files are one split each: repartition after them where they are large. Missing values become null at the source; NaN is
never stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators.filters import blanks_to_null
from . import blockgzip

VCF_COLUMNS = ("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format")


def _tsv(spark: SparkSession, path: str | list[str], header: bool = True, sep: str = "\t", comment: str | None = None, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("sep", sep).option("header", header).option("quote", "")
    reader = reader.option("comment", comment) if comment else reader
    return (reader.schema(schema) if schema else reader).csv(path)


def variants_tsv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """An annotated table with a header; all columns are text unless a schema is given, missing values null."""
    df = _tsv(spark, path, schema=schema)
    return df.select(*[X.missing_to_null(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])


def text_lines(spark: SparkSession, path: str, **options: str | int) -> DataFrame:
    """value: the lines of a text file or folder; of a ``.gz`` or ``.bgz`` file in as many tasks as its size asks for.
    ``options``, for these alone: contigs, columns, split_bytes (see ``blockgzip``)."""
    if path.endswith((".gz", ".bgz")):
        return blockgzip.lines(spark, path, **options)
    return spark.read.text(path)


def _cells(lines: DataFrame) -> DataFrame:
    """cells: an array of a line's cells, cut once a line. A plain ``split`` would be cut again for each column that is
    taken from it and each filter on those, as the optimizer puts the expression in their place."""
    return lines.select(F.explode(F.array(F.split("value", "\t"))).alias("cells"))


def header_lines(spark: SparkSession, path: str) -> DataFrame:
    """line: the header lines of a VCF or GSvar file."""
    return text_lines(spark, path).filter(F.col("value").startswith("#")).select(F.col("value").alias("line"))


def vcf(spark: SparkSession, path: str, **options: str | int) -> tuple[DataFrame, DataFrame]:
    """(header lines, records) of a VCF: records have the fixed columns, then one text column a sample. The column names
    take one small read of the header. ``options``: see ``text_lines``."""
    head = header_lines(spark, path)
    names = (head.filter(F.col("line").startswith("#CHROM")).first() or [""])[0].split("\t")[9:]
    records = _cells(text_lines(spark, path, **options).filter(~F.col("value").startswith("#") & (F.trim("value") != ""))).select(*[F.try_element_at("cells", F.lit(i + 1)).alias(c) for i, c in enumerate([*VCF_COLUMNS, *names])])
    return head, records.withColumn("pos", F.col("pos").try_cast("long"))


def csq_fields(head: DataFrame, field: str = "CSQ") -> list[str]:
    """Names of a packed annotation's fields, from the header."""
    row = head.filter(F.col("line").startswith(f"##INFO=<ID={field},")).select(F.regexp_extract("line", r'Format: ([^">]+)', 1)).first()
    return row[0].strip().split("|") if row else []


def sample_ids(head: DataFrame) -> list[str]:
    return [r[0] for r in head.filter(F.col("line").startswith("##SAMPLE=<ID=")).select(F.regexp_extract("line", r"##SAMPLE=<ID=([^,>]+)", 1)).collect()]


def gsvar(spark: SparkSession, path: str) -> DataFrame:
    """An evidence ranking: ``##`` lines skipped, columns named by the ``#chr`` line."""
    names = header_lines(spark, path).filter(F.col("line").startswith("#chr")).first()[0].lstrip("#").split("\t")
    df = _cells(spark.read.text(path).filter(~F.col("value").startswith("#") & (F.trim("value") != "")))
    return blanks_to_null(df.select(*[F.try_element_at("cells", F.lit(i + 1)).alias(c) for i, c in enumerate(names)]))


def obo(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """terms (term, name, obsolete), edges (term, parent), replacements (term, replaced_by), synonyms (term, synonym) of
    an ontology file. Obsolete terms have no edges; an alternative id is replaced by its term, an obsolete one by what
    the file names, or is to be considered in its place."""
    block = F.col("value")
    tag = lambda name: F.regexp_extract_all(block, F.lit(rf"(?m)^{name}: (\S+)"), F.lit(1))
    one = lambda name: F.nullif(F.regexp_extract(block, rf"(?m)^{name}: (.*)$", 1), F.lit(""))
    stanzas = spark.read.option("lineSep", "\n\n").text(path).filter(F.trim(block).startswith("[Term]"))
    all_ = stanzas.select(one("id").alias("term"), one("name").alias("name"), F.coalesce(one("is_obsolete") == "true", F.lit(False)).alias("obsolete"), tag("is_a").alias("parents"), tag("alt_id").alias("alts"),
                          F.coalesce(one("replaced_by"), F.try_element_at(tag("consider"), F.lit(1))).alias("instead"), F.regexp_extract_all(block, F.lit(r'(?m)^synonym: "([^"]*)"'), F.lit(1)).alias("synonyms"))
    live = all_.filter("NOT obsolete")
    return {
        "terms": live.select("term", "name", "obsolete"),
        "edges": live.select("term", F.explode("parents").alias("parent")),
        "replacements": live.select(F.explode("alts").alias("term"), F.col("term").alias("replaced_by")).unionByName(all_.filter("instead IS NOT NULL").select("term", F.col("instead").alias("replaced_by"))).dropDuplicates(["term"]),
        "synonyms": live.select("term", F.explode("synonyms").alias("synonym")),
    }


def term_counts(spark: SparkSession, path: str) -> DataFrame:
    """term, n of a phenotype annotation table (column hpo_id)."""
    return _tsv(spark, path, comment="#").groupBy(F.col("hpo_id").alias("term")).agg(F.count("*").alias("n"))


def gene_terms(spark: SparkSession, path: str) -> DataFrame:
    """gene, term: columns 4 and 1, distinct."""
    df = _tsv(spark, path)
    c = df.columns
    return df.select(F.upper(F.col(f"`{c[3]}`")).alias("gene"), F.col(f"`{c[0]}`").alias("term")).distinct()


def hgnc(spark: SparkSession, path: str) -> DataFrame:
    """hgnc_id (without prefix), symbol; of a repeated id, the greatest symbol."""
    df = _tsv(spark, path)
    c = df.columns
    return df.groupBy(F.regexp_replace(F.col(f"`{c[0]}`"), "^HGNC:", "").alias("hgnc_id")).agg(F.max(F.upper(F.col(f"`{c[1]}`"))).alias("symbol"))


def interaction_links(spark: SparkSession, path: str) -> DataFrame:
    """protein1, protein2, conf_exp, conf_db: columns 1, 2, 7, 8 of a space-separated file."""
    df = _tsv(spark, path, sep=" ")
    c = [f"`{x}`" for x in df.columns]
    return df.select(F.col(c[0]).alias("protein1"), F.col(c[1]).alias("protein2"), F.col(c[6]).cast("int").alias("conf_exp"), F.col(c[7]).cast("int").alias("conf_db"))


def interaction_aliases(spark: SparkSession, path: str) -> DataFrame:
    df = _tsv(spark, path)
    c = [f"`{x}`" for x in df.columns]
    return df.select(F.col(c[0]).alias("protein"), F.col(c[1]).alias("alias"), F.col(c[2]).alias("source"))


def transcripts(spark: SparkSession, path: str) -> DataFrame:
    """transcript_id, cds_length; transcripts without a length are dropped."""
    df = _tsv(spark, path)
    c = [f"`{x}`" for x in df.columns]
    return df.select(F.col(c[1]).alias("transcript_id"), F.trim(F.col(c[2])).try_cast("long").alias("cds_length")).filter("cds_length IS NOT NULL")


def pedigree(spark: SparkSession, path: str) -> DataFrame:
    """family, member, affected of a PED file; rows of another status are skipped."""
    df = _tsv(spark, path, header=False, comment="#")
    status = F.trim(F.col("_c5"))
    return df.select(F.col("_c0").alias("family"), F.col("_c1").alias("member"), F.when(status == "2", 1).when(status == "1", 0).alias("affected")).filter("affected IS NOT NULL")


def query_terms(spark: SparkSession, source: str, is_file: bool | None = None) -> DataFrame:
    """term: distinct and sorted, of a file with one (or several, comma-separated) a line, or of a comma list."""
    is_file = "/" in source or "." in source if is_file is None else is_file
    df = spark.read.text(source) if is_file else spark.createDataFrame([(source,)], "value string")
    return df.select(F.explode(F.split("value", ",")).alias("term")).select(F.trim("term").alias("term")).filter("term <> ''").distinct().orderBy("term")


def listed(spark: SparkSession, path: str, column: str = "gene", upper: bool = True) -> DataFrame:
    """First tab column of a list, comments and blank lines skipped, distinct: gene exclusions, canonical transcripts."""
    first = F.trim(F.split("value", "\t")[0])
    df = spark.read.text(path).filter(~F.col("value").startswith("#") & (F.trim("value") != ""))
    return df.select((F.upper(first) if upper else first).alias(column)).distinct()


def fasta_tiles(spark: SparkSession, path: str, width: int = 4096) -> DataFrame:
    """chrom, tile, seq: a genome in pieces of ``width`` bases; write it once. Files are read line by line in Spark's splits.
    A line's place is its offset within its split, by a window over the split, and what the splits before it leave over
    of its contig, by a window over one row a split; so no task holds a contig. A contig ends with its file."""
    head = F.nullif(F.regexp_extract("value", r"^>(\S+)", 1), F.lit(""))
    at = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("nth")
    lines = spark.read.text(path).select(*at, head.alias("head"), F.when(F.col("value").startswith(">"), "").otherwise(F.regexp_replace("value", r"\s", "")).alias("bases"))
    so_far = Window.partitionBy("file", "split").orderBy("nth")
    n = F.length("bases").cast("long")
    lines = lines.withColumns({"own": F.last("head", True).over(so_far), "to": F.sum(n).over(so_far)})
    lines = lines.withColumn("base", F.last(F.when(F.col("head").isNotNull(), F.col("to")), True).over(so_far))
    by_split = Window.partitionBy("file").orderBy("split")
    left = lines.groupBy("file", "split").agg(F.max_by("own", "nth").alias("last"), (F.max("to") - F.coalesce(F.max("base"), F.lit(0))).alias("tail"))
    left = left.withColumns({"contig": F.last("last", True).over(by_split), "run": F.count("last").over(by_split)})
    left = left.withColumn("tail", F.sum("tail").over(Window.partitionBy("file", "run").orderBy("split")))
    left = left.select("file", "split", F.lag("contig").over(by_split).alias("contig"), F.lag("tail", 1, 0).over(by_split).alias("before"))
    placed = lines.join(left, ["file", "split"]).filter("bases <> ''").select(F.coalesce("own", "contig").alias("chrom"), "bases", (F.col("to") - n - F.coalesce("base", -F.col("before"))).alias("from"))
    cut = placed.select("*", F.explode(F.sequence(F.floor(F.col("from") / width), F.floor((F.col("from") + n - 1) / width))).alias("tile"))
    begin = F.greatest(F.col("tile") * width - F.col("from"), F.lit(0))
    part = F.struct(F.greatest(F.col("from"), F.col("tile") * width).alias("at"), F.substr("bases", (begin + 1).cast("int"), F.least((F.col("tile") + 1) * width - F.col("from") - begin, F.lit(width)).cast("int")).alias("s"))
    return cut.filter("chrom IS NOT NULL").groupBy("chrom", "tile").agg(F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["s"]), "").alias("seq"))


def _scores(df: DataFrame, chrom: Column, pos: Column, ref: Column, alt: Column, score: Column) -> DataFrame:
    out = df.select(X.chrom_with_prefix(F.trim(chrom)).alias("chrom"), pos.try_cast("long").alias("pos"), F.upper(ref).alias("ref"), F.upper(alt).alias("alt"), X.missing_to_null(score).alias("score"))
    return out.filter("score IS NOT NULL AND pos IS NOT NULL")


#: Columns (from 0) of chromosome, position, alleles and score in tables without a usable header.
PLACES = {"cadd": (0, 1, 2, 3, 5), "capice": (0, 1, 2, 3, 4), "fathmm_xf": (0, 1, 2, 3, 4), "eigen": (0, 1, 2, 3, 18)}


def score_table(spark: SparkSession, path: str, resource: str) -> DataFrame:
    """chrom, pos, ref, alt, score of a resource in PLACES; rows without a score, and headers, are dropped."""
    df = _cells(spark.read.text(path).filter(~F.col("value").startswith("#") & ~F.lower("value").startswith("chr\t")))
    return _scores(df, *[F.coalesce(F.try_element_at("cells", F.lit(i + 1)), F.lit("")) for i in PLACES[resource]])


def condel(spark: SparkSession, path: str) -> DataFrame:
    return _scores(_tsv(spark, path), *[F.col(c) for c in ("CHR", "START", "REF", "ALT", "CONDEL")])


def mutation_assessor(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Many files at once; the place is the Mutation cell's second to fifth part."""
    m = F.col("m")
    df = spark.read.option("header", True).csv(paths).select("FI score", F.explode(F.array(F.split("Mutation", ","))).alias("m"))
    return _scores(df, m[1], m[2], m[3], m[4], F.col("FI score"))


def revel(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(by hg19 position, by GRCh38 position where it has one), from one scan."""
    df = spark.read.option("header", True).csv(path)
    at = lambda d, pos: _scores(d, F.col("chr"), F.col(pos), F.col("ref"), F.col("alt"), F.col("REVEL"))
    return at(df, "hg19_pos"), at(df.filter(F.col("grch38_pos") != "."), "grch38_pos")


def clinvar(spark: SparkSession, path: str) -> DataFrame:
    """Significance, disease and included disease as one text; entries without an allele or a significance, and
    conflicting ones, are dropped."""
    _, df = vcf(spark, path)
    get = lambda k: F.coalesce(X.info_value("info", k), F.lit(""))
    df = df.filter(F.col("alt") != ".").select("chrom", "pos", "ref", "alt", get("CLNSIG").alias("sig"), get("CLNDN").alias("dn"), get("CLNDNINCL").alias("incl"))
    df = df.filter((F.col("sig") != "") & (F.col("sig") != "Conflicting_interpretations_of_pathogenicity"))
    return df.select(X.chrom_with_prefix("chrom").alias("chrom"), "pos", "ref", "alt", F.concat("sig", F.lit("%20"), "dn", F.lit("%3D"), "incl").alias("score"))


GNOMAD = {"AN": "an", "AF": "af", "nhomalt": "hom", "AF_afr": "af_afr", "AF_amr": "af_amr", "AF_eas": "af_eas", "AF_nfe": "af_nfe", "AF_sas": "af_sas"}


def gnomad(spark: SparkSession, path: str) -> DataFrame:
    """Allele number, frequency, homozygotes and five populations' frequencies; the first three are required."""
    _, df = vcf(spark, path)
    df = df.select("chrom", "pos", "ref", "alt", F.explode(F.array(F.concat(F.lit(";"), "info"))).alias("info"))
    df = df.select("chrom", "pos", "ref", "alt", F.inline(F.array(F.struct(*[X.info_text("info", k).alias(v) for k, v in GNOMAD.items()]))))  # once a row, not once more for the filter
    df = df.select(X.chrom_with_prefix("chrom").alias("chrom"), "pos", "ref", "alt", *[X.missing_to_null(v).try_cast("double").alias(v) for v in GNOMAD.values()])
    return df.filter("an IS NOT NULL AND af IS NOT NULL AND hom IS NOT NULL")


def repeatmasker(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start0, end0, name ``repeat (class)`` of a whitespace-aligned table with header rows."""
    c = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")
    df = spark.read.text(path).select(c.alias("c")).filter(F.size("c") > 10).filter(F.col("c")[5].try_cast("long").isNotNull())
    return df.select(F.col("c")[4].alias("chrom"), (F.col("c")[5].cast("long") - 1).alias("start0"), F.col("c")[6].cast("long").alias("end0"), F.concat(F.col("c")[9], F.lit(" ("), F.col("c")[10], F.lit(")")).alias("name"))


def bed(spark: SparkSession, path: str, name: int | None = 3) -> DataFrame:
    """chrom, start0, end0, name (a column, or 1 where there is none); missing names are dropped."""
    c = F.col("cells")
    df = _cells(spark.read.text(path).filter(~F.col("value").rlike("^(#|track|browser)") & (F.trim("value") != "")))
    named = F.lit("1") if name is None else X.missing_to_null(F.try_element_at(c, F.lit(name + 1)))
    return df.select(c[0].alias("chrom"), c[1].cast("long").alias("start0"), c[2].cast("long").alias("end0"), named.alias("name")).filter("name IS NOT NULL")


def track(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start0, end0, value of an interval export of a position-score track (text or Parquet)."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return bed(spark, path).select("chrom", "start0", "end0", F.col("name").try_cast("double").alias("value"))
