"""Sources and sinks on literal files."""

import glob
import gzip
import random

from pyspark.sql import functions as F

from genoloom.plans import pipelines
from genoloom.sources import blockgzip, readers, writers

VCF = """##fileformat=VCFv4.2
##source=x
##other=y
##INFO=<ID=CSQ,Number=.,Description="Consequence annotations. Format: Consequence|Feature|SYMBOL|IMPACT">
##SAMPLE=<ID=s1,Status=affected>
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1
chr1\t10\t.\tA\tG\t50\tPASS\tCSQ=missense_variant|T1|G1|MODERATE,stop_gained|T2|G1|HIGH\tGT:DP:AD\t0/1:10:4,6
chr1\t5\t.\tAC\tA\t50\tPASS\tX=1;CSQ=intron_variant|T1|G2|LOW;INDEL_ID=i1\tGT\t1/1
chr2\t7\t.\tA\tC,T\t50\tPASS\t.\tGT\t./.
"""


def put(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_vcf(spark, tmp_path):
    head, records = readers.vcf(spark, put(tmp_path, "a.vcf", VCF))
    assert readers.csq_fields(head) == ["Consequence", "Feature", "SYMBOL", "IMPACT"] and readers.sample_ids(head) == ["s1"]
    assert records.count() == 3 and records.columns[-1] == "s1"
    flat = pipelines.flattened(records.withColumnRenamed("s1", "sample"), readers.csq_fields(head), [], "indel")
    rows = {r.pos: r for r in flat.collect()}
    assert rows[10].feature == "T2" and rows[10].HIGH_IMPACT == 1 and round(rows[10].af, 2) == 0.6
    assert rows[5].indel_id == "i1" and rows[7].consequence is None
    writers.vcf(records, head, str(tmp_path / "out"), reduced=True, single_file=True)
    lines = open(tmp_path / "out").read().splitlines()  # one file, as other tools want it
    assert lines[0] == "##fileformat=VCFv4.2" and not any("other" in x for x in lines) and [x.split("\t")[1] for x in lines if x[0] != "#"] == ["5", "10", "7"]


def test_obo(spark, tmp_path):
    text = 'format-version: 1.2\n\n[Term]\nid: HP:1\nname: root\n\n[Term]\nid: HP:2\nname: two\nalt_id: HP:9\nsynonym: "zwei" EXACT []\nis_a: HP:1 ! root\n\n[Term]\nid: HP:3\nname: gone\nis_obsolete: true\nreplaced_by: HP:2\nis_a: HP:1\n\n[Typedef]\nid: x\n'
    o = readers.obo(spark, put(tmp_path, "h.obo", text))
    assert sorted(r.term for r in o["terms"].collect()) == ["HP:1", "HP:2"]
    assert [tuple(r) for r in o["edges"].collect()] == [("HP:2", "HP:1")]
    assert sorted(tuple(r) for r in o["replacements"].collect()) == [("HP:3", "HP:2"), ("HP:9", "HP:2")]
    assert [r.synonym for r in o["synonyms"].collect()] == ["zwei"]


def test_small_tables(spark, tmp_path):
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(readers.pedigree(spark, put(tmp_path, "p.ped", "f\ta\t0\t0\t1\t2\nf\tb\t0\t0\t1\t1\nf\tc\t0\t0\t1\t0\n"))) == [("f", "a", 1), ("f", "b", 0)]
    assert rows(readers.term_counts(spark, put(tmp_path, "x.hpoa", "#c\ndb\thpo_id\n1\tH1\n2\tH1\n3\tH2\n"))) == [("H1", 2), ("H2", 1)]
    assert rows(readers.gene_terms(spark, put(tmp_path, "g.txt", "t\tn\ti\tg\nH1\tx\t1\tabc\nH1\tx\t1\tabc\n"))) == [("ABC", "H1")]
    assert rows(readers.hgnc(spark, put(tmp_path, "hg.txt", "id\ts\nHGNC:5\ta1bg\n"))) == [("5", "A1BG")]
    assert rows(readers.transcripts(spark, put(tmp_path, "t.tsv", "g\tt\tl\nG\tT1\t300\nG\tT2\t\n"))) == [("T1", 300)]
    assert rows(readers.query_terms(spark, "HP:2, HP:1,HP:2")) == [("HP:1",), ("HP:2",)]
    assert rows(readers.listed(spark, put(tmp_path, "e.txt", "#x\nabc\t1\n\nAbc\n"))) == [("ABC",)]
    assert rows(readers.interaction_links(spark, put(tmp_path, "l.txt", "a b c d e f g h\nP1 P2 1 1 1 1 901 5\n"))) == [("P1", "P2", 901, 5)]
    assert rows(readers.bed(spark, put(tmp_path, "b.bed", "chr1\t1\t5\tx\nchr1\t7\t9\tNA\n"))) == [("chr1", 1, 5, "x")]
    assert rows(readers.fasta_tiles(spark, put(tmp_path, "g.fa", ">c1 d\nACGT\nAC\n>c2\nTT\n"), 4)) == [("c1", 0, "ACGT"), ("c1", 1, "AC"), ("c2", 0, "TT")]
    assert rows(readers.repeatmasker(spark, put(tmp_path, "r.out", "  SW x\n score\n\n  463 1.3 0.6 1.7 chr1 10001 10468 (5) + (CCCTAA)n Simple_repeat 1\n"))) == [("chr1", 10000, 10468, "(CCCTAA)n (Simple_repeat)")]


def test_fasta_in_many_splits(spark, tmp_path):
    r = random.Random(5)
    want, text = {}, ""
    for name, n in (("c1", 1000), ("c2", 3), ("c3", 2500), ("c4", 0), ("c5", 77)):
        seq = "".join(r.choices("ACGTn", k=n))
        want |= {(name, i // 64): seq[i : i + 64] for i in range(0, n, 64)}
        text += f">{name} some words\n" + "".join(seq[i : i + 50] + "\n" for i in range(0, n, 50))
    at = put(tmp_path, "g.fa", text)
    put(tmp_path, "h.fa", text.replace(">c", ">d"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 300)
    try:
        tiles = readers.fasta_tiles(spark, at, 64)
        assert {(x.chrom, x.tile): x.seq for x in tiles.collect()} == want
        both = readers.fasta_tiles(spark, str(tmp_path), 64)
        assert {(x.chrom, x.tile): x.seq for x in both.collect()} == want | {(f"d{c[1:]}", t): s for (c, t), s in want.items()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_score_resources(spark, tmp_path):
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(readers.score_table(spark, put(tmp_path, "c.tsv", "## x\n#Chrom\tPos\n1\t5\tA\tG\t0.1\t7.5\n1\t6\tA\tG\t0.1\t\n"), "cadd")) == [("chr1", 5, "A", "G", "7.5")]
    assert rows(readers.condel(spark, put(tmp_path, "co.tsv", "CHR\tSTART\tREF\tALT\tCONDEL\n2\t5\tA\tG\t0.4\n"))) == [("chr2", 5, "A", "G", "0.4")]
    assert rows(readers.mutation_assessor(spark, put(tmp_path, "m.csv", 'Mutation,FI score\n"hg38,3,9,A,T",1.5\n'))) == [("chr3", 9, "A", "T", "1.5")]
    a, b = readers.revel(spark, put(tmp_path, "r.csv", "chr,hg19_pos,grch38_pos,ref,alt,REVEL\n1,5,.,A,G,0.3\n1,6,7,A,G,0.4\n"))
    assert [r.pos for r in a.orderBy("pos").collect()] == [5, 6] and [r.pos for r in b.collect()] == [7]
    head = "##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n"
    cv = readers.clinvar(spark, put(tmp_path, "cv.vcf", head + "1\t5\t.\tA\tG\t.\t.\tCLNSIG=Benign;CLNDN=d\n1\t6\t.\tA\t.\t.\t.\tCLNSIG=Benign\n1\t7\t.\tA\tG\t.\t.\tCLNSIG=Conflicting_interpretations_of_pathogenicity\n"))
    assert [r.score for r in cv.collect()] == ["Benign%20d%3D"]
    gn = readers.gnomad(spark, put(tmp_path, "gn.vcf", head + "1\t5\t.\tA\tG\t.\t.\tAN=10;AF=0.1;nhomalt=1;AF_afr=0.2\n1\t6\t.\tA\tG\t.\t.\tAN=10;AF=0.1\n"))
    assert [(r.an, r.af, r.hom, r.af_afr, r.af_sas) for r in gn.collect()] == [(10.0, 0.1, 1.0, 0.2, None)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("chr2", 5, "A", "G", 1, 0, 1), ("chr1", 9, "A", "GTT", 0, 1, 1)], "chrom string, pos long, ref string, alt string, dominant int, denovo int, filter_passed int").withColumns({m: F.lit(0) for m in ("recessive", "compound", "xlinked")})
    writers.tsv(df, str(tmp_path / "t"), gzip=True, sort=("chrom", "pos"))
    back = readers.variants_tsv(spark, str(tmp_path / "t"))
    assert sorted(r.chrom for r in back.collect()) == ["chr1", "chr2"]
    writers.by_mode(df, str(tmp_path / "m"))
    assert sorted(x.rsplit("=")[-1] for x in glob.glob(str(tmp_path / "m/inheritance_mode=*"))) == ["dominant", "dominant_denovo"]
    writers.results(df, str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r/filtered")).count() == 2
    full = df.withColumns({"symbol": F.lit("G"), "filter": F.lit("."), "qual": F.lit(3), "gt": F.lit("0/1")})
    writers.gsvar(full, str(tmp_path / "g"), "s1")
    again = readers.gsvar(spark, str(tmp_path / "g"))
    assert again.count() == 2 and {r.s1 for r in again.collect()} == {"het"} and {r.obs for r in again.collect()} == {"G", "GTT"}


def test_block_gzip_in_many_tasks(spark, tmp_path):
    """Lines of all lengths over members of all sizes: for any split size the same lines as from the plain text, each once;
    other tools' plain gzip, no last newline, an empty file, and a part that lies within one line."""
    r = random.Random(4)
    rows = ["##fileformat=x", "#CHROM\tPOS"] + [f"chr{r.randint(1, 3)}\t{i}\t" + "é" * r.choice([0, 1, 30, 400]) + "x" * r.choice([0, 5, 90_000 if i % 100 == 0 else 7]) for i in range(1200)]
    text = "\n".join(rows).encode()
    cuts = sorted({0, len(text), *(r.randrange(len(text)) for _ in range(150))})
    for ending in (b"", b"\n"):
        path = tmp_path / f"a{len(ending)}.vcf.gz"
        path.write_bytes(b"".join(blockgzip.packed(text[a:b]) for a, b in zip(cuts, cuts[1:])) + blockgzip.packed(ending) + blockgzip.LAST)
        assert gzip.decompress(path.read_bytes()) == text + ending
        for split_bytes in (97, 1000, 30_000, 1 << 30):
            got = blockgzip.lines(spark, str(path), split_bytes=split_bytes)
            assert [x.value for x in got.collect()] == rows
            assert got.rdd.getNumPartitions() == -(-path.stat().st_size // split_bytes)
    some = blockgzip.lines(spark, str(path), split_bytes=5000, contigs="chr2", columns=2).collect()
    assert [x.value for x in some] == rows[:2] + ["\t".join(x.split("\t")[:2]) for x in rows[2:] if x.startswith("chr2\t")]
    (tmp_path / "plain.gz").write_bytes(gzip.compress(text[:5000]) + gzip.compress(text[5000:]))
    assert [x.value for x in blockgzip.lines(spark, str(tmp_path / "plain.gz"), split_bytes=100).collect()] == rows
    (tmp_path / "none.gz").write_bytes(blockgzip.LAST)
    assert blockgzip.lines(spark, str(tmp_path / "none.gz")).count() == 0


def test_one_file_in_order(spark, tmp_path):
    """Written by many tasks; a file that is there is replaced as a whole, and nothing else is left."""
    lines = spark.range(5000).select(F.concat(F.lit("line "), F.lpad("id", 6, "0")).alias("value")).repartition(7).orderBy("value")
    want = [f"line {i:06d}" for i in range(5000)]
    at = tmp_path / "out.txt"
    for _ in range(2):
        writers.one_text_file(lines, str(at))
        assert at.read_text().splitlines() == want
    writers.one_text_file(lines, str(tmp_path / "out.gz"), block_gzip=True)
    assert gzip.decompress((tmp_path / "out.gz").read_bytes()).decode().splitlines() == want
    writers.one_text_file(lines.filter("value < ''"), str(tmp_path / "none.txt"))
    assert (tmp_path / "none.txt").read_bytes() == b"" and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["none.txt", "out.gz", "out.txt"]


def test_lines_are_cut_once(spark, tmp_path):
    """However many columns and filters read a line's cells, and an INFO cell's keys."""
    lines = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO", "1\t5\t.\tA\tG\t.\t.\tXAN=1;AN=7;AF=0.5;AN=8;nhomalt=2", "1\t6\t.\tA\tG\t.\t.\tAN=.;AF=0.5;nhomalt=2", "1\t7\t.\tA\tG"]
    (tmp_path / "x.vcf").write_text("\n".join(lines) + "\n")
    df = readers.gnomad(spark, str(tmp_path / "x.vcf"))
    assert [(r.chrom, r.pos, r.an, r.af, r.hom, r.af_afr) for r in df.collect()] == [("chr1", 5, 7.0, 0.5, 2.0, None)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.count(";AN=, ") <= 2, plan
    (tmp_path / "x.tsv").write_text("1\t5\ta\tg\t0.5\n")
    assert readers.score_table(spark, str(tmp_path / "x.tsv"), "capice")._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


def test_score_files_are_packed(spark):
    from genoloom import file_queries

    rows = spark.range(3000, numPartitions=1).select(F.concat(F.lit("chr1\t"), "id", F.lit("\ta\tG\t0.5")).alias("value"))
    at = file_queries.text_file(rows, "scores", **(file_queries.PACKED | {"maxRecordsPerFile": 1000}))
    assert len(glob.glob(f"{at}/*.gz")) == 3 and readers.score_table(spark, at, "capice").count() == 3000
