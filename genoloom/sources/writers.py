"""Sinks. Parquet is the default for tables; the text formats are for exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators.inheritance import MODES
from ..shared import fresh
from . import blockgzip

#: Header lines that a reduced VCF keeps, columns of the exchange format.
KEPT_HEADER = ("##fileformat=", "##filedate=", "##source=", "##reference=", "##contig=", "##FORMAT=", "##FILTER=", "#CHROM")
GSVAR_COLUMNS = ("chr", "start", "end", "ref", "obs", "filter", "coding_and_splicing", "OMIM", "ClinVar", "HGMD", "gnomAD", "gnomAD_sub", "phyloP",
                 "SpliceAI", "gene_info", "NGSD_hom", "NGSD_het", "classification", "MaxEntScan", "quality")


def _flat(df: DataFrame) -> DataFrame:
    nested = [c for c, t in df.dtypes if t.startswith(("array", "map", "struct"))]
    return df.withColumns({c: F.to_json(c) for c in nested}) if nested else df


def tsv(df: DataFrame, path: str, gzip: bool = False, sort: tuple[str, ...] = ()) -> None:
    """A table with header; nested columns as JSON. ``sort`` gives a total order over the files."""
    out = _flat(df.orderBy(*sort) if sort else df).write.mode("overwrite").option("sep", "\t").option("header", True)
    (out.option("compression", "gzip") if gzip else out).csv(path)


def results(df: DataFrame, path: str) -> None:
    """The full table and the rows that passed the filters, both as Parquet."""
    df.write.mode("overwrite").parquet(f"{path}/all")
    df.filter("filter_passed = 1").write.mode("overwrite").parquet(f"{path}/filtered")


def by_mode(df: DataFrame, path: str) -> None:
    """One folder for each inheritance mode, from one scan; a variant of several modes is in each."""
    modes(df).write.mode("overwrite").partitionBy("inheritance_mode").parquet(path)


def modes(df: DataFrame) -> DataFrame:
    """``df`` with one row for each mode that is set."""
    set_ = F.array_compact(F.array(*[F.when(F.col(m if m != "dominant_denovo" else "denovo") == 1, m) for m in MODES]))
    return df.withColumn("inheritance_mode", F.explode(set_))


def vcf_lines(records: DataFrame, header: DataFrame, reduced: bool = False) -> DataFrame:
    """value: header lines (those of KEPT_HEADER alone if ``reduced``), then records by place."""
    kept = header.filter(F.col("line").rlike("^(" + "|".join(KEPT_HEADER) + ")")) if reduced else header
    rank = F.when(F.col("line").startswith("##fileformat"), 0).when(F.col("line").startswith("##"), 1).otherwise(2)
    head = kept.select(rank.alias("r"), F.lit("").alias("c"), F.lit(0).cast("long").alias("p"), F.col("line").alias("value"))
    body = records.select(F.lit(3).alias("r"), F.col("chrom").alias("c"), F.col("pos").alias("p"), F.concat_ws("\t", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(".")) for c in records.columns]).alias("value"))
    return head.unionByName(body).orderBy("r", "c", "p", "value").select("value")


def joined_files(spark: SparkSession, parts: list[str], path: str, ending: bytes = b"") -> None:
    """The files ``parts``, one after the other, as one file. No task and no table holds all rows: bytes are appended by the
    file system where it can (as HDFS does, by moving blocks), else copied in order through a buffer. They gather under a
    name of this attempt's own, and only the whole file gets its name, so an attempt that fails or is repeated leaves no
    half or doubled file."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    of = jvm.org.apache.hadoop.fs.Path
    target = of(path)
    fs, own = target.getFileSystem(conf), of(f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(own)
    if fs.getScheme() == "hdfs" and parts:
        out.close()
        some = spark.sparkContext._gateway.new_array(of, len(parts))
        for i, p in enumerate(parts):
            some[i] = of(p)
        fs.concat(own, some)
        out = fs.append(own)
    else:
        for p in parts:
            source = of(p)
            read = source.getFileSystem(conf).open(source)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(read, out, conf, False)
            read.close()
    out.write(bytearray(ending))
    out.close()
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(own, target):
        raise OSError(f"{path} could not be put in place")


def one_text_file(lines: DataFrame, path: str, block_gzip: bool = False) -> None:
    """The lines (value) of an ordered table as one file, written in parts by all tasks and joined in order."""
    spark = lines.sparkSession
    if block_gzip:
        return joined_files(spark, blockgzip.write_parts(lines), path, blockgzip.LAST)
    at = fresh(spark, "parts")
    lines.select("value").write.text(at)
    of = spark._jvm.org.apache.hadoop.fs.Path
    fs = of(at).getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().toString() for f in fs.listStatus(of(at)) if f.getPath().getName().startswith("part-")]
    joined_files(spark, sorted(names), path)  # part-00000 and so on: the order of the partitions


def vcf(records: DataFrame, header: DataFrame, path: str, reduced: bool = False, single_file: bool = False, block_gzip: bool = False) -> None:
    """Text in order: a folder of files, or, as other tools want it, one file, also block-gzipped."""
    lines = vcf_lines(records, header, reduced)
    if single_file or block_gzip:
        one_text_file(lines, path, block_gzip)
    else:
        lines.write.mode("overwrite").text(path)


def split_vcf(routed: DataFrame, header: DataFrame, path: str, single_file: bool = False) -> None:
    """SNVs and indels (column route) into two folders or files, each with the header."""
    for route in ("snv", "indel"):
        vcf(routed.filter(F.col("route") == route).drop("route"), header, f"{path}/{route}" + ".vcf" * single_file, single_file=single_file)


def gsvar_table(df: DataFrame, sample: str) -> DataFrame:
    """The columns of the exchange format; what a table doesn't have is empty."""
    has = lambda c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
    v = X.trimmed("pos", "ref", "alt")
    text = lambda c: F.coalesce(has(c), F.lit(""))
    coding = F.concat_ws(":", text("symbol"), text("feature"), text("consequence"), text("impact"), F.coalesce(has("exon"), has("intron"), F.lit("")), text("hgvsc"), text("hgvsp"), F.lit(""))
    subs = [has(f"gnomADg_{p}_AF") for p in ("AFR", "AMR", "EAS", "NFE", "SAS")]
    lof = F.coalesce(X.score_min(has("oe_lof"), strict=True).cast("string"), F.lit("n/a"))
    values = {
        "chr": has("chrom"), "start": v["start"], "end": v["end"], "ref": v["ref"], "obs": v["alt"], "filter": F.nullif(has("filter"), F.lit(".")), "coding_and_splicing": coding,
        "OMIM": has("omim"), "ClinVar": has("clinvar"), "HGMD": has("hgmd"), "gnomAD": has("MAX_AF"),
        "gnomAD_sub": F.when(F.coalesce(*subs).isNotNull(), F.concat_ws(",", *[F.coalesce(s, F.lit("nan")) for s in subs])),
        "phyloP": has("phyloP_vertebrate"), "SpliceAI": has("spliceai"), "gene_info": F.concat(text("symbol"), F.lit(" (inh=n/a oe_syn=n/a oe_mis=n/a oe_lof="), lof, F.lit(")")),
        "quality": F.concat(F.lit("QUAL="), text("qual")),
    }
    return df.select(*[values.get(c, F.lit(None).cast("string")).alias(c) for c in GSVAR_COLUMNS], X.genotype_text("gt").alias(sample) if "gt" in df.columns else F.lit("n/a").alias(sample))


def gsvar(df: DataFrame, path: str, sample: str, single_file: bool = False) -> None:
    """The exchange format as text, header lines first: a folder of ordered files, or one file."""
    table = gsvar_table(df, sample)
    head = ["##GENOME_BUILD=GRCh38", f"##SAMPLE=<ID={sample},DiseaseStatus=affected>", "##FILTER=off-target=Variant marked as 'off-target'.",
            "##FILTER=low_conf_region=Variant marked as 'low_conf_region'.", f"##DESCRIPTION={sample}=Genotype of variant in sample.", "#" + "\t".join(table.columns)]
    top = df.sparkSession.createDataFrame([(i, "", 0, line) for i, line in enumerate(head)], "r int, c string, p long, value string")
    body = table.select(F.lit(len(head)).alias("r"), F.col("chr").alias("c"), F.col("start").cast("long").alias("p"), F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in table.columns]).alias("value"))
    lines = top.unionByName(body).orderBy("r", "c", "p", "value").select("value")
    if single_file:
        one_text_file(lines, path)
    else:
        lines.write.mode("overwrite").text(path)
