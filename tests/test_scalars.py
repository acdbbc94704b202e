"""Column functions on literal rows."""

import pytest
from pyspark.sql import functions as F

from genoloom.functions import scalars as X
from genoloom.operators import filters, meta, scoring


def one(spark, c, /, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1)])
    return df.select(c.alias("x")).first().x


@pytest.mark.parametrize("cell, strict, low, high", [("0.1&.&0.5", False, 0.1, 0.5), (".", False, None, None), ("", False, None, None), (None, False, None, None), ("nan&NA&-2", False, -2.0, -2.0), ("-2&1:5&3", True, 3.0, 3.0)])
def test_score_lists(spark, cell, strict, low, high):
    df = spark.createDataFrame([(cell,)], "c string")
    assert tuple(df.select(X.score_min("c", strict), X.score_max("c", strict)).first()) == (low, high)


@pytest.mark.parametrize("text, term", [("intron_variant&stop_gained", "stop_gained"), ("odd&intron_variant", "intron_variant"), ("odd", "odd"), ("missense_variant", "missense_variant")])
def test_most_severe(spark, text, term):
    assert one(spark, X.most_severe("c"), c=text) == term


@pytest.mark.parametrize("share, off", [(0.949, 0.0), (0.95, 0.01), (0.96, 0.02), (0.97, 0.03), (0.98, 0.04), (0.99, 0.05), (1.0, 0.05), (1.01, 0.0)])
def test_cds_penalty_steps(spark, share, off):
    assert one(spark, X.cds_penalty(F.col("s")), s=share) == off


@pytest.mark.parametrize("said, score", [("Pathogenic%20x", 1.0), ("Benign/Likely_benign%20y", 0.25), ("pathogenic(replaced by 7)", 1.0), ("other%20", None)])
def test_clinvar(spark, said, score):
    assert one(spark, X.clinvar_score("c"), c=said) == score


@pytest.mark.parametrize("p, s, flag", [(0.4, 0.4, 1), (0.6, 0.6, 1), (0.5, 0.5, 0), (0.4, 0.6, 0)])
def test_opposed(spark, p, s, flag):
    assert one(spark, X.opposed("p", "s"), p=p, s=s) == flag


@pytest.mark.parametrize("pos, ref, alt, key", [(100, "A", "G", "1:100-100_A>G"), (100, "ACC", "A", "1:101-102_CC>-"), (100, "G", "GTTT", "1:100-100_->TTT"), (100, "ACGT", "ATGT", "1:101-101_C>T"), (10, "TCA", "GCA", "1:10-10_T>G")])
def test_variant_key(spark, pos, ref, alt, key):
    assert one(spark, X.variant_key("chrom", "pos", "ref", "alt"), chrom="1", pos=pos, ref=ref, alt=alt) == key
    back = one(spark, X.split_key("k"), k=key)
    assert f"{back.chrom}:{back.start}-{back.end}_{back.ref}>{back.alt}" == key


@pytest.mark.parametrize("seq, run, homo, low", [("AAAAACGTACG", 5, 1, 1), ("ACGTACGTACG", 1, 0, 0), ("ACACACACACA", 1, 0, 1), ("AAAACGTACGT", 4, 0, 1)])
def test_sequence_flags(spark, seq, run, homo, low):
    assert one(spark, F.struct(X.longest_run("s"), X.is_homopolymer("s"), X.is_low_complexity("s")), s=seq) == (run, homo, low)


def test_genotype_fields(spark):
    g = one(spark, X.genotype_fields("f", "s"), f="GT:DP:AD:GQ", s="0/1:30:10,20:99")
    assert (g.gt, g.dp, g.ad_ref, g.ad_alt, g.gq, round(g.af, 4)) == ("0/1", 30, 10, 20, 99, 0.6667)
    g = one(spark, X.genotype_fields("f", "s"), f="GT:DP:AD:GQ", s="./.")
    assert (g.gt, g.dp, g.af) == ("./.", None, None)
    assert one(spark, X.genotype_fields("f", "s"), f="GT:AD", s="0/0:0,0").af == 0.0
    packed = one(spark, X.packed_genotypes("s"), s="a=wt|9|0,b=het|8|4,c=hom|7|7")
    assert [(p.sample, p.gt, p.dp, p.alt) for p in packed] == [("a", "0/0", 9, 0), ("b", "0/1", 8, 4), ("c", "1/1", 7, 7)]


def test_info_and_csq(spark):
    assert one(spark, X.info_value("i", "B"), i="A=1;B=x;CB=y") == "x"
    assert one(spark, X.info_value("i", "C"), i="A=1;C=.;D") is None
    csq = "intron_variant|T1|G,stop_gained&intron_variant|T2|H,missense_variant|T3|"
    fields = ["Consequence", "Feature", "SYMBOL"]
    pick = lambda canonical: one(spark, X.chosen_record(X.csq_records("c", fields), canonical), c=csq)
    assert pick([]).Feature == "T2" and pick(["T3"]).Feature == "T3" and pick(["T3"]).SYMBOL is None


def test_legacy_info(spark):
    df = spark.createDataFrame([("AF=0.1&0.3;SPL=A|G1|0.1|0.9|.|0.2|5,B|G1|0.95|0|0|0|7;OE=0.4&-1&0.2;T=x",)], "i string")
    row = df.select(*X.info_columns("i", {"af": ("AF", "max"), "spl": ("SPL", "splice"), "oe": ("OE", "min"), "t": ("T", "text"), "no": ("NO", "max")})).first()
    assert tuple(row) == (0.3, 0.95, 0.2, "x", None)


def test_overrides(spark):
    run = lambda c, ref="A", alt="G": one(spark, scoring.overridden(F.lit(0.4), "c", "r", "a"), c=c, r=ref, a=alt)
    assert run("missense_variant") == 0.4 and run("synonymous_variant") == 0.0 and run("splice_region_variant") is None
    assert run("missense_variant", "A", "AT") == 0.9 and run("missense_variant", "A", "ATTT") == 0.4


def test_imputation_of_severe_variants(spark):
    df = spark.createDataFrame([("HIGH", "stop_gained", None), ("HIGH", "splice_donor_variant", None), ("LOW", "missense_variant", "0.2&0.4"), ("HIGH", "stop_gained", "-1")], "impact string, consequence string, REVEL string")
    assert [r.x for r in df.select(scoring.imputed_feature("REVEL").alias("x")).collect()] == [1.0, 0.193, 0.4, 1.0]


CASES = [
    ({"filter": "low_conf_region;x"}, 0, "low confidence region"), ({"filter": "off-target"}, 0, "off target"), ({"low_conf_region": "r"}, 0, "low confidence region"),
    ({"gene_excluded": True}, 0, "gene exclusion"), ({"simple_repeat": "r", "final_score": 0.69}, 0, "tandem repeat"), ({"simple_repeat": "r", "final_score": 0.7}, 1, "passed all"),
    ({"segmental_duplication": "0.9", "final_score": 0.1}, 0, "segmental duplication"), ({"context": "AAAAAAAAAAA", "ref": "AC", "final_score": 0.1}, 0, "homopolymer and low complexity region"),
    ({"context": "ACACACACACA", "ref": "AC", "final_score": 0.1}, 0, "low complexity region"), ({"repeat_mask": "L1", "final_score": 0.1}, 0, "masked repeat region"), ({"repeat_mask": ".", "final_score": 0.1}, 1, "passed all"),
    ({"MAX_AF": 0.02}, 0, "high MAF"), ({"MAX_AF": None}, 1, "passed all"), ({"consequence": "synonymous_variant"}, 0, "synonymous variant"), ({"consequence": "intron_variant"}, 0, "variant type not supported"),
    ({"final_score": None}, 0, "missing prediction"), ({"similarity": 0.0, "partner_similarity": 0.2}, 1, "HPO related to interacting genes"), ({"similarity": 0.0}, 0, "no HPO relation"),
]


def test_cascade(spark):
    base = {"filter": ".", "low_conf_region": None, "gene_excluded": False, "simple_repeat": None, "segmental_duplication": None, "context": "ACGTTGCATGC", "ref": "A", "alt": "C", "repeat_mask": None, "MAX_AF": 0.001,
            "consequence": "missense_variant", "final_score": 0.9, "similarity": 0.5, "partner_similarity": 0.0}
    schema = "filter string, low_conf_region string, gene_excluded boolean, simple_repeat string, segmental_duplication string, context string, ref string, alt string, repeat_mask string, MAX_AF double, consequence string, final_score double, similarity double, partner_similarity double"
    df = spark.createDataFrame([tuple((base | c).values()) for c, _, _ in CASES], schema).coalesce(1)
    assert [(r.filter_passed, r.filter_comment) for r in filters.filtered(df).collect()] == [(p, t) for _, p, t in CASES]


@pytest.mark.parametrize("text, genes", [('{"1st ranked Gene": "a", "2nd ranked Gene": "B ", "3rd ranked Gene": "c"}', ["A", "B", "C"]), ('```json\n[{"1st ranked Gene": "a", "2nd ranked Gene": "b", "3rd ranked Gene": "c"}]\n```', ["A", "B", "C"]),
                                         ('{"1st ranked Gene": "a", "2nd ranked Gene": "b", "3rd ranked Gene": "c"', ["A", "B", "C"]), ("no json", None), (None, None)])
def test_answers(spark, text, genes):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(meta.parsed_answer("t")).first()[0] == genes


def test_records_and_genotypes_are_cut_once(spark):
    """The work on a CSQ record or a sample cell doesn't grow with the square of its fields."""
    cuts = lambda c: str(spark.createDataFrame([("a", "b")], "f string, s string").select(c.alias("x"))._jdf.queryExecution().optimizedPlan().toString()).count("split(")
    assert cuts(X.csq_records("f", list("abcdef"))) == cuts(X.csq_records("f", ["a"])) == 2
    assert cuts(X.genotype_fields("f", "s")) == 4
    g = one(spark, X.genotype_fields("f", "s"), f="GT:GT:AD", s="0/1:1/1:3,1")
    assert (g.gt, g.ad_ref, g.ad_alt, g.af, g.dp) == ("0/1", 3, 1, 0.25, None)
