"""Inheritance patterns over a pedigree: one aggregation of the long genotype table for the four family verdicts, and
gene-level windows for compound heterozygosity. A missing or unusual genotype (``./.``, ``1/0``) is neutral."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MODES = ("dominant", "dominant_denovo", "recessive", "compound", "xlinked")
FAMILIES = ("SINGLE", "TRIO", "MULTI")


def _gt(c: str = "gt") -> Column:
    return F.replace(F.col(c), F.lit("|"), F.lit("/"))


def _any(c: Column) -> Column:
    return F.max(F.when(c, 1).otherwise(0))


def _bits(conditions: list[Column]) -> Column:
    """Which of the conditions hold, as one number."""
    return reduce(add, [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions)])


def _type(family: str) -> Column:
    """A family type as a value, or the column that holds it."""
    return F.lit(family) if family in FAMILIES else F.col(family)


def _verdicts(family: str) -> dict[str, Column]:
    """The aggregates behind ``family_verdicts``."""
    g, aff, un = _gt(), F.col("affected") == 1, F.col("affected") == 0
    is_ = lambda *x: g.isin(*x)
    multi = _type(family) == "MULTI"
    rules = {
        "denovo": ((aff & is_("0/1")) | (un & is_("0/0")), (un & is_("0/1")) | (aff & is_("0/0")) | is_("1/1")),
        "dominant": ((aff & is_("0/1", "1/1")) | (un & is_("0/0")), (aff & is_("0/0")) | (un & is_("0/1", "1/1"))),
        "recessive": ((aff & is_("1/1")) | (un & is_("0/1")) | (un & is_("0/0") & multi), (aff & is_("0/0", "0/1")) | (un & is_("1/1")) | (un & is_("0/0") & ~multi)),
    }
    x_rules = (un & is_("0/1"), un & is_("0/0"), (aff & is_("0/0", "0/1")) | (un & is_("1/1")))
    conditions = [c for good, bad in rules.values() for c in (good, bad)] + list(x_rules)
    met = F.bit_or(_bits(conditions))  # one number for a variant, whichever of its members meet which condition
    any_ = [met.bitwiseAND(F.lit(1 << i)) != 0 for i in range(len(conditions))]
    verdict = {m: F.when(any_[2 * k] & ~any_[2 * k + 1], 1).otherwise(0) for k, m in enumerate(rules)}
    verdict["xlinked"] = F.when(any_[-3] & any_[-2] & ~any_[-1], 1).otherwise(0)
    return verdict


def family_verdicts(genotypes: DataFrame, family: str = "TRIO", keys: tuple[str, ...] = ("variant_id",)) -> DataFrame:
    """Flags of de novo, dominant, recessive and x-linked inheritance per variant, of (keys, member, affected, gt).
    A verdict is 1 iff no member contradicts and at least one supports it. ``family``: TRIO or MULTI, or a column that
    says which, one type for each group of ``keys``. The x-linked one is for variants on X alone and asks for both a
    carrier and a non-carrier among the unaffected."""
    return genotypes.groupBy(*keys).agg(*[v.alias(m) for m, v in _verdicts(family).items()])


def on_x(chrom: str = "chrom") -> Column:
    return F.col(chrom).isin("X", "x", "chrX", "chrx", "23")


def recessive_single(gt: str = "gt") -> Column:
    return F.when(_gt(gt) == "1/1", 1).otherwise(0)


def dominant_single(gt: str = "gt") -> Column:
    return F.when(_gt(gt) == "0/1", 1).otherwise(0)


def _by_gene(df: DataFrame, gene: str, keys: tuple[str, ...], id_col: str) -> Window:
    """A window of a gene's variants. Those without a gene, most of a genome, need no window: they are dealt by their id."""
    return Window.partitionBy(*keys, gene, F.when(F.col(gene).isNull(), F.xxhash64(id_col)))


def _single(gene: str, het: Column, w: Window) -> Column:
    return F.when(F.col(gene).isNotNull() & het & (F.sum(F.when(het, 1).otherwise(0)).over(w) >= 2), 1).otherwise(0)


def _from_parents(child: Column, first: Column, second: Column, none: str | int = "0/0", het: str | int = "0/1") -> tuple[Column, Column]:
    """Whether the child's heterozygous variant comes from the first parent alone, and from the second alone."""
    return (child == het) & (first == het) & (second == none), (child == het) & (first == none) & (second == het)


def _trio(gene: str, from_first: Column, from_second: Column, w: Window) -> Column:
    both = (_any(from_first).over(w) == 1) & (_any(from_second).over(w) == 1)
    return F.when(F.col(gene).isNotNull() & both & (from_first | from_second), 1).otherwise(0)


def compound_single(df: DataFrame, gene: str = "symbol", gt: str = "gt", keys: tuple[str, ...] = ("sample_id",), id_col: str = "variant_id") -> DataFrame:
    """compound = 1 for the heterozygous variants of a gene that has at least two; 0 without a gene."""
    return df.withColumn("compound", _single(gene, _gt(gt) == "0/1", _by_gene(df, gene, keys, id_col)))


def compound_trio(df: DataFrame, gene: str = "symbol", child: str = "gt_child", first: str = "gt_first", second: str = "gt_second", keys: tuple[str, ...] = ("sample_id",), id_col: str = "variant_id") -> DataFrame:
    """compound = 1 for the child's heterozygous variants that come from one parent alone, where the gene has some from
    either parent: the same rows as all pairs in trans would flag, by two window maxima."""
    return df.withColumn("compound", _trio(gene, *_from_parents(_gt(child), _gt(first), _gt(second)), _by_gene(df, gene, keys, id_col)))


def inheritance_text(denovo: str = "denovo", dominant: str = "dominant", recessive: str = "recessive", compound: str = "compound", xlinked: str = "xlinked") -> Column:
    """The names of the set flags, &-joined in a fixed order."""
    named = ((dominant, "DOMINANT"), (denovo, "DOMINANT_DENOVO"), (recessive, "RECESSIVE"), (compound, "COMPOUND"), (xlinked, "XLINKED"))
    return F.array_join(F.array_compact(F.array(*[F.when(F.col(c) == 1, n) for c, n in named])), "&")


def inheritance(variants: DataFrame, genotypes: DataFrame, family: str = "TRIO", id_col: str = "variant_id", keys: tuple[str, ...] = ()) -> DataFrame:
    """``variants`` with the flags that the family type asks for and their text; flags that don't apply are 0.

    ``family`` is SINGLE, TRIO or MULTI, or a column of ``genotypes`` that says so for each family. ``keys`` (such as a
    family's or its patient's id, in both tables) tell families apart that carry the same variant, so one job serves a
    cohort of all three types. Roles follow from the members' status: the child is the affected one, the parents are the
    two unaffected ones by name. A trio with other than one affected and two unaffected members has no such roles, so none
    of its variants is compound (the other flags ask for no roles). A variant without genotypes gets no flag.

    The genotypes are dealt by family and variant and aggregated there, so a task holds its share of the families however
    large a piece of the input is: a variant's members alone meet, nothing is gained by aggregating before. Genotypes are
    kept as numbers, which Spark aggregates by hash; where members have names instead of numbers, by sort. All flags but
    the compound ones are set before the one window, which sees of a variant its gene and one number."""
    by = [*keys, id_col]
    typed = genotypes.withColumn("_family", _type(family)).repartition(*by)
    aff, un, g = F.col("affected") == 1, F.col("affected") == 0, _gt()
    code = F.when(g == "0/0", 1).when(g == "0/1", 2).when(g == "1/1", 3).otherwise(0)
    unaffected, nameless = F.when(un, F.col("member")), F.col("member").isNull()
    kind = F.when(F.col("_family") == "TRIO", 3).when(F.col("_family") == "SINGLE", 2).when(F.col("_family") == "MULTI", 1)
    child = F.coalesce(F.max(F.when(aff & nameless, code)), F.min_by(code, F.when(aff, F.col("member"))), F.max(F.when(nameless, code)), F.min_by(code, "member"))
    roles = {"_kind": F.max(kind), "_roles": (F.count_if(aff) == 1) & (F.count_if(un) == 2), "_child": child, "_first": F.min_by(code, unaffected), "_second": F.max_by(code, unaffected)}
    known = typed.groupBy(*by).agg(*[c.alias(n) for n, c in (roles | _verdicts("_family")).items()])
    from_first, from_second = _from_parents(F.col("_child"), F.col("_first"), F.col("_second"), 1, 2)
    single, trio, larger, set_ = F.col("_kind") == 2, F.col("_kind") == 3, F.col("_kind").isin(1, 3), lambda m: F.col(m) == 1
    facts = {
        "denovo": trio & set_("denovo"), "dominant": larger & set_("dominant"), "recessive": F.when(single, F.col("_child") == 3).otherwise(larger & set_("recessive")), "xlinked": larger & set_("xlinked"),
        "single": single, "pair": trio & F.col("_roles"), "het": F.col("_child") == 2, "from_first": from_first, "from_second": from_second,
    }
    known = known.select(*by, _bits(list(facts.values())).alias("_bits"))
    fact = {name: F.col("_bits").bitwiseAND(F.lit(1 << i)) != 0 for i, name in enumerate(facts)}
    off_x = F.when(on_x(), F.col("_bits")).otherwise(F.col("_bits").bitwiseAND(F.lit(~(1 << list(facts).index("xlinked")))))
    df = variants.join(known, by, "left").withColumn("_bits", F.coalesce(off_x, F.lit(0)))
    w = _by_gene(df, "symbol", tuple(k for k in dict.fromkeys(("sample_id", *keys)) if k in df.columns), id_col)
    df = df.select("*", _single("symbol", fact["het"], w).alias("_single"), _trio("symbol", fact["from_first"], fact["from_second"], w).alias("_pair"))
    df = df.withColumns({m: F.when(fact[m], 1).otherwise(0) for m in ("denovo", "dominant", "recessive", "xlinked")})
    df = df.withColumn("compound", F.when(fact["single"], F.col("_single")).when(fact["pair"], F.col("_pair")).otherwise(0))
    return df.withColumn("inheritance", inheritance_text()).drop("_bits", "_single", "_pair")
