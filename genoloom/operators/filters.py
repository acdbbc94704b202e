"""Row filters and the ordered filter cascade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CODING, SPLICE, SYNONYMOUS, Settings
from ..functions import scalars as X


def rare(df: DataFrame, most: float = 0.02, af: str = "MAX_AF") -> DataFrame:
    """Variants of at most this frequency; a missing frequency is dropped where the column exists."""
    return df.filter(F.col(af) <= most) if af in df.columns else df


def passed(df: DataFrame) -> DataFrame:
    return df.filter("filter_passed = 1")


def top(df: DataFrame, k: int, rank: str = "rank") -> DataFrame:
    """Rows of rank at most ``k``, ties kept."""
    return df.filter(F.col(rank) <= k)


def without_empty_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Blank cells of all text columns become null, in one projection."""
    return df.select(*[X.blank_to_null(c).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def first_filled(df: DataFrame, candidates: list[str], out: str) -> DataFrame:
    """``out`` from the first of ``candidates`` that has any value at all; the others are dropped."""
    there = [c for c in candidates if c in df.columns]
    filled = df.agg(*[F.count(c).alias(c) for c in there]).first().asDict() if there else {}
    chosen = next((c for c in there if filled[c]), there[0] if there else None)
    return df.drop(*[c for c in there if c != chosen]).withColumnRenamed(chosen, out) if chosen else df


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def excluded_gene(df: DataFrame, exclusions: DataFrame, gene: str = "symbol", out: str = "gene_excluded") -> DataFrame:
    """``df`` with a flag for rows any of whose ;-separated genes (upper case) is on the list (column gene)."""
    listed = exclusions.select(F.upper("gene").alias("_gene")).distinct()
    symbols = df.select(F.col(gene).alias("_symbol")).distinct().withColumn("_gene", F.explode(F.split(F.upper("_symbol"), ";")))
    hits = symbols.join(listed, "_gene", "left_semi").select("_symbol", F.lit(True).alias("_hit")).distinct()
    marked = df.join(hits, df[gene] == hits["_symbol"], "left")  # one row a symbol, so rows don't multiply
    return marked.withColumn(out, F.coalesce("_hit", F.lit(False))).drop("_symbol", "_hit")


def without_excluded(edges: DataFrame, exclusions: DataFrame, gene: str = "partner") -> DataFrame:
    """Interaction partners that aren't on the exclusion list."""
    listed = exclusions.select(F.upper("gene").alias("_g")).distinct()
    return edges.join(listed, F.upper(edges[gene]) == listed["_g"], "left_anti")


def cascade(df: DataFrame, settings: Settings = Settings(), with_query: bool = True, score: str = "final_score", consequence: str = "consequence",
            af: str = "MAX_AF", context: str = "context", term: Column | None = None) -> Column:
    """struct(passed, comment): the first rule that holds decides. ``term`` is the most severe consequence, if it is at
    hand. Columns that ``df`` hasn't got switch their rules off."""
    has = lambda c: c in df.columns
    c = lambda name: F.col(name) if has(name) else F.lit(None).cast("string")
    yes = lambda x: F.coalesce(x, F.lit(False))
    weak = yes(F.col(score) < settings.filter_score)
    filled = lambda name: yes(F.trim(c(name).cast("string")) != "")
    homo = yes(X.is_homopolymer(context) == 1) if has(context) else F.lit(False)
    low = yes(X.is_low_complexity(context) == 1) if has(context) else F.lit(False)
    long = yes((F.length(c("ref")) > 1) | (F.length(c("alt")) > 1))
    term = X.most_severe(consequence) if term is None else term
    supported = yes(term.isin(*CODING, *SPLICE))
    rules = [
        (yes(c("filter").contains("low_conf_region")), "low confidence region"),
        (yes(c("filter").contains("off-target")), "off target"),
        (filled("low_conf_region"), "low confidence region"),
        (yes(c("gene_excluded").cast("boolean")), "gene exclusion"),
        (weak & filled("simple_repeat"), "tandem repeat"),
        (weak & yes(c("segmental_duplication").try_cast("double") > 0), "segmental duplication"),
        (weak & long & homo & low, "homopolymer and low complexity region"),
        (weak & long & homo, "homopolymer"),
        (weak & long & low, "low complexity region"),
        (weak & filled("repeat_mask") & yes(c("repeat_mask") != "."), "masked repeat region"),
        (yes(X.score_max(c(af).cast("string")) > settings.max_af), "high MAF"),
        (~supported & yes(term.isin(*SYNONYMOUS)), "synonymous variant"),
        (~supported, "variant type not supported"),
        (F.col(score).isNull(), "missing prediction"),
    ]
    if with_query:
        ends = [(yes(c("similarity") > 0), 1, "passed all"), (yes(c("partner_similarity") > 0), 1, "HPO related to interacting genes"), (F.lit(True), 0, "no HPO relation")]
    else:
        ends = [(F.lit(True), 1, "no HPO terms given")]
    out = None
    for test, ok, text in [(t, 0, x) for t, x in rules] + ends:
        value = F.struct(F.lit(ok).alias("passed"), F.lit(text).alias("comment"))
        out = F.when(test, value) if out is None else out.when(test, value)
    return out


def filtered(df: DataFrame, **options) -> DataFrame:
    """``df`` with filter_passed and filter_comment."""
    named = df.withColumn("_term", X.most_severe(options.get("consequence", "consequence")))
    judged = named.withColumn("_f", cascade(df, term=F.col("_term"), **options))
    return judged.select(*df.columns, F.col("_f.passed").alias("filter_passed"), F.col("_f.comment").alias("filter_comment"))
