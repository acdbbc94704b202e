"""Per-gene merge of several rankings and of model picks, prompts and answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import PROMPT, VARIANT_TYPE
from ..functions import scalars as X

ENTRY = "gene string, consequence string, type string, rank int, score double, genotype string, variant string"


def entries(df: DataFrame, rank: str = "rank", score: str = "final_score", gt: str = "gt") -> DataFrame:
    """One ranked entry a variant: sample_id, gene and the fields of ENTRY."""
    return df.select("sample_id", F.upper("symbol").alias("gene"), X.most_severe("consequence").alias("consequence"), X.variant_type(X.most_severe("consequence"), "ref", "alt").alias("type"),
                     F.col(rank).cast("int").alias("rank"), F.col(score).cast("double").alias("score"), X.genotype_word(gt).alias("genotype"), X.variant_key("chrom", "pos", "ref", "alt").alias("variant"))


def entry_text(genotype: Column | str = "genotype") -> Column:
    """An entry as exported text."""
    return F.format_string("%s(Consequence: %s, Type: %s, Rank: %d, Score: %s, Genotype: %s, Variant: %s)", "gene", "consequence", "type", "rank", F.col("score").cast("string"), F.coalesce(X.col(genotype), F.lit("nan")), "variant")


def parsed_entries(text: Column | str) -> Column:
    """An array of entries from ;-joined exported text."""
    field = lambda t, name: F.regexp_extract(t, name + r": ([^,)]*)", 1)
    one = lambda t: F.struct(F.regexp_extract(t, r"^([^(]*)\(", 1).alias("gene"), field(t, "Consequence").alias("consequence"), field(t, "Type").alias("type"), field(t, "Rank").try_cast("int").alias("rank"),
                             field(t, "Score").try_cast("double").alias("score"), field(t, "Genotype").alias("genotype"), F.regexp_extract(t, r"Variant: (.*)\)$", 1).alias("variant"))
    return F.transform(F.filter(F.split(X.col(text), r"(?<=\));"), lambda t: t != ""), one)


def entry_list(df: DataFrame) -> DataFrame:
    """One ;-joined text a sample, entries by rank; a cell grows with a sample's entries, so give it the top-ranked ones."""
    texts = F.array_sort(F.collect_list(F.struct("rank", "gene", "variant", entry_text().alias("t"))))
    return df.groupBy("sample_id").agg(F.array_join(F.transform(texts, lambda x: x["t"]), ";").alias("entries"))


def per_gene(ranking: DataFrame) -> DataFrame:
    """One entry a sample and gene: the one of most severe consequence, on a tie the best rank. Genes joined by ``/`` count each."""
    split = ranking.withColumn("gene", F.explode(F.split("gene", "/")))
    order = F.struct(X.severity(F.col("consequence")), "rank", "variant")
    return split.groupBy("sample_id", "gene").agg(*[F.min_by(c, order).alias(c) for c in ("rank", "score", "variant")])


def merged(rf: DataFrame, dom: DataFrame, rec: DataFrame, missing_rank: int = 11) -> DataFrame:
    """One row a sample and gene of any of three rankings (sample_id, gene, rank, score, variant), by one union and one
    aggregation in place of two full outer joins. Absent rankings get ``missing_rank`` and score 0. The evidence side
    takes the better of dominant and recessive: lower rank, then higher score, then dominant."""
    tagged = rf.select(F.lit("rf").alias("k"), "sample_id", "gene", "rank", "score", "variant")
    for name, d in (("dom", dom), ("rec", rec)):
        tagged = tagged.unionByName(d.select(F.lit(name).alias("k"), "sample_id", "gene", "rank", "score", "variant"))
    of = lambda name, c: F.max(F.when(F.col("k") == name, F.col(c))).alias(f"{name}_{c}")
    wide = tagged.groupBy("sample_id", "gene").agg(*[of(n, c) for n in ("rf", "dom", "rec") for c in ("rank", "score", "variant")])
    rank = lambda n: F.coalesce(F.col(f"{n}_rank"), F.lit(missing_rank))
    score = lambda n: F.coalesce(F.col(f"{n}_score"), F.lit(0.0))
    use_rec = (rank("rec") < rank("dom")) | ((rank("rec") == rank("dom")) & (score("rec") > score("dom")))
    variants = F.array_join(F.array_distinct(F.array_compact(F.array("rf_variant", "dom_variant", "rec_variant"))), ";")
    return wide.select("sample_id", "gene", variants.alias("variant"), rank("rf").alias("rf_rank"), score("rf").alias("rf_score"),
                       F.when(use_rec, "rec").otherwise("dom").alias("eb_model"), F.when(use_rec, rank("rec")).otherwise(rank("dom")).alias("eb_rank"), F.when(use_rec, score("rec")).otherwise(score("dom")).alias("eb_score"))


def one_hot_model(df: DataFrame) -> DataFrame:
    return df.withColumns({"eb_dom": F.when(F.col("eb_model") == "dom", 1).otherwise(0), "eb_rec": F.when(F.col("eb_model") == "rec", 1).otherwise(0)})


def with_picks(df: DataFrame, picks: DataFrame, out: str, none: int = 4) -> DataFrame:
    """``df`` with the best place (1 to 3) of its gene among a sample's picks (sample_id, gene, place), else ``none``.
    Several pick lists, as of dominant and recessive prompts, come in one table."""
    best = picks.groupBy("sample_id", "gene").agg(F.min("place").alias(out))
    return df.join(best, ["sample_id", "gene"], "left").withColumn(out, F.coalesce(out, F.lit(none)))


def meta_ranked(df: DataFrame, score: str = "meta_score") -> DataFrame:
    """``df`` with meta_rank within each sample; an order, if one is wanted, is the sink's."""
    return df.withColumn("meta_rank", F.rank().over(Window.partitionBy("sample_id").orderBy(F.desc_nulls_last(score))))


def gsvar_choice(cell: Column | str, ref: Column | str, alt: Column | str) -> Column:
    """gene, consequence, type of the most severe supported entry in a comma list of ``gene:transcript:consequence:...``;
    if none is supported, of the last entry, as an unspecified variant."""
    parts = F.transform(F.split(X.col(cell), ","), lambda e: F.struct(F.split(e, ":")[0].alias("gene"), X.most_severe(F.regexp_replace(F.coalesce(F.try_element_at(F.split(e, ":"), F.lit(3)), F.lit("unknown")), "_variant_variant", "_variant")).alias("consequence")))
    supported = F.filter(parts, lambda p: p["consequence"].isin(*VARIANT_TYPE, "protein_altering_variant", "coding_sequence_variant"))
    best = F.array_min(F.transform(supported, lambda p, i: F.struct(X.severity(p["consequence"]).alias("s"), i.alias("i"), p.alias("p"))))["p"]
    chosen = F.coalesce(best, F.element_at(parts, -1))
    return F.struct(chosen["gene"].alias("gene"), chosen["consequence"].alias("consequence"), F.when(best.isNull(), "unspecified variant").otherwise(X.variant_type(chosen["consequence"], ref, alt)).alias("type"))


def prompts(patients: DataFrame, candidates: DataFrame, with_type: bool = True, with_genotype: bool = True, seed: int = 14038) -> DataFrame:
    """sample_id, prompt: the question to a language model, of patients (sample_id, sex, age, phenotypes) and candidate
    genes (sample_id, gene, type, genotype), listed in a seeded order."""
    shown = F.col("gene")
    if with_type:
        typed = F.concat("gene", F.lit(" ("), "type", F.lit(")"))
        shown = F.when(F.col("genotype") == "hom", F.concat("gene", F.lit(" (homozygous "), "type", F.lit(")"))).otherwise(typed) if with_genotype else typed
    listed = F.array_sort(F.collect_list(F.struct(F.xxhash64(F.lit(seed), "gene").alias("h"), "gene", shown.alias("t"))))
    genes = candidates.groupBy("sample_id").agg(F.array_join(F.transform(listed, lambda x: x["t"]), ", ").alias("_genes"))
    sex = F.when(F.coalesce("sex", F.lit("")) != "", F.concat("sex", F.lit(" "))).otherwise("")
    age = F.when(F.col("age").isNotNull(), F.concat(F.lit(" of age "), F.col("age").cast("int").cast("string"))).otherwise("")
    hint = PROMPT["type"] * with_type + PROMPT["genotype"] * (with_type and with_genotype)
    text = F.concat(F.lit("A "), sex, F.lit(PROMPT["patient"]), age, F.lit(PROMPT["symptoms"]), "phenotypes", F.lit(PROMPT["question"] + hint + PROMPT["genes"]), "_genes")
    return patients.join(genes, "sample_id").select("sample_id", text.alias("prompt"))


def parsed_answer(text: Column | str) -> Column:
    """An array of the three picked genes, upper case, from a model's answer: fences are stripped, a missing bracket is
    closed, a single object counts as a list of one; null where it isn't JSON with the expected keys."""
    body = F.regexp_replace(X.col(text), r"^\s*(```(?:json)?)?\s*|\s*(```)?\s*$", "")
    inner = F.regexp_replace(body, r"^\[|\s*\]$", "")
    inner = F.when(inner.endswith("}"), inner).otherwise(F.concat(inner, F.lit("}")))
    body = F.when(body.startswith("["), F.concat(F.lit("["), inner, F.lit("]"))).otherwise(inner)
    body = F.when(body.startswith("{"), F.concat(F.lit("["), body, F.lit("]"))).otherwise(body)
    keys = ("1st ranked Gene", "2nd ranked Gene", "3rd ranked Gene")
    first = F.try_element_at(F.from_json(body, "array<map<string,string>>"), F.lit(1))
    genes = F.array(*[F.upper(F.trim(first[k])) for k in keys])
    return F.when(first.isNotNull() & F.exists(genes, lambda g: g.isNotNull()), genes)


def picks_of(answers: DataFrame, text: str = "answer") -> DataFrame:
    """sample_id, gene, place (1 to 3) of model answers (sample_id, answer)."""
    return answers.select("sample_id", F.posexplode(parsed_answer(text)).alias("_p", "gene")).filter("gene IS NOT NULL AND gene <> ''").select("sample_id", "gene", (F.col("_p") + 1).alias("place"))
