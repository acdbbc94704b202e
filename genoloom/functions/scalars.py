"""Column functions on scores, consequences, genotypes and variant keys. None needs Python on the executors."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CLINVAR, HGMD, MISSING, SEVERITY, VARIANT_TYPE

C = Column | str


def col(c: C) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def lookup(values: dict, key: Column) -> Column:
    """The value of ``key`` in a fixed table, null if it has none."""
    return F.try_element_at(literal_map(values), key)


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.transform(F.array(value), f)[0]


def blank_to_null(c: C) -> Column:
    return F.when(F.trim(col(c)) != "", col(c))


def missing_to_null(c: C) -> Column:
    """Null for the texts that stand for a missing value."""
    return F.when(~F.trim(col(c)).isin(*MISSING), col(c))


def scores(c: C, skip: str | None = None) -> Column:
    """The numbers of an &-separated cell as an array; tokens that match ``skip`` or are no numbers are left out."""
    tokens = F.filter(F.split(col(c).cast("string"), "&"), lambda t: ~t.isin(*MISSING) & (~t.rlike(skip) if skip else F.lit(True)))
    return F.filter(F.transform(tokens, lambda t: t.try_cast("double")), lambda x: x.isNotNull() & ~F.isnan(x))


def score_max(c: C, strict: bool = False) -> Column:
    """Largest number of a cell; ``strict`` also skips tokens with a colon or a minus sign."""
    return F.array_max(scores(c, "[:-]" if strict else None))


def score_min(c: C, strict: bool = False) -> Column:
    return F.array_min(scores(c, "[:-]" if strict else None))


def largest(*cs: C) -> Column:
    """Largest of several columns, nulls ignored."""
    return F.greatest(*[col(c) for c in cs]) if len(cs) > 1 else col(cs[0])


def terms(c: C) -> Column:
    return F.split(col(c), "&")


def severity(term: Column) -> Column:
    return F.coalesce(lookup(SEVERITY, term), F.lit(SEVERITY["unknown"]))


def most_severe(c: C) -> Column:
    """The most severe term of an &-separated list, the first on a tie; unknown terms count as least severe."""
    ranked = F.transform(terms(c), lambda t, i: F.struct(severity(t).alias("s"), i.alias("i"), t.alias("t")))
    return F.array_min(ranked)["t"]


def any_term(c: C, names: tuple[str, ...]) -> Column:
    return F.arrays_overlap(terms(c), F.array(*[F.lit(n) for n in names]))


def only_terms(c: C, names: tuple[str, ...]) -> Column:
    return F.forall(terms(c), lambda t: t.isin(*names))


def length_difference(ref: C, alt: C) -> Column:
    return F.abs(F.length(col(ref)) - F.length(col(alt)))


def hom_frequency(hom: C, an: C) -> Column:
    return F.when((col(hom) > 0) & (col(an) > 0), col(hom) / col(an))


def high_impact(c: C) -> Column:
    return F.when(col(c) == "HIGH", 1).otherwise(0)


def is_indel(ref: C, alt: C) -> Column:
    return F.when((F.length(col(ref)) > 1) | (F.length(col(alt)) > 1), 1).otherwise(0)


def opposed(polyphen: C, sift: C) -> Column:
    """1 where the two predictors (of opposite direction) contradict each other."""
    a, b = col(polyphen), col(sift)
    return F.when(((a < 0.5) & (b < 0.5)) | ((a > 0.5) & (b > 0.5)), 1).otherwise(0)


def cds_position(c: C) -> Column:
    """First base of a CDS position cell; null where it is missing or unsure."""
    return F.split(missing_to_null(c), "-")[0].try_cast("double")


def cds_share(cds: C, length: C, consequence: C, ref: C, alt: C) -> Column:
    """Share of the coding sequence before a frameshift; null where it doesn't apply."""
    start, whole = cds_position(cds), col(length).cast("double")
    shifted = F.coalesce(col(consequence).contains("frameshift"), F.lit(False)) | (length_difference(ref, alt) % 3 != 0)
    return F.when(shifted & (start <= whole), start / whole)


def cds_penalty(share: Column) -> Column:
    """Taken off the score of a frameshift near its transcript's end."""
    steps = ((0.99, 0.05), (0.98, 0.04), (0.97, 0.03), (0.96, 0.02), (0.95, 0.01))
    out = reduce(lambda w, s: w.when(share >= s[0], s[1]), steps[1:], F.when(share >= steps[0][0], steps[0][1]))
    return F.when(share <= 1, out.otherwise(0.0)).otherwise(0.0)


def clinvar_score(c: C) -> Column:
    said = F.lower(F.split(col(c), "%")[0])
    said = F.when(said.contains("(replaced"), F.split(said, r"\(replaced")[0]).otherwise(said)
    said = F.when(said.isin("benign/likely_benign", "likely_benign/benign"), "likely_benign").when(said.isin("pathogenic/likely_pathogenic", "likely_pathogenic/pathogenic"), "likely_pathogenic").otherwise(said)
    return lookup(CLINVAR, said)


def database_score(clinvar: C, hgmd: C) -> Column:
    """Mean of what the two databases say, or the one that says something."""
    a, b = clinvar_score(clinvar), lookup(HGMD, col(hgmd))
    return F.coalesce((a + b) / 2, a, b)


def blended(score: C, database: Column, share: float = 0.2) -> Column:
    return F.coalesce((1 - share) * col(score) + share * database, col(score))


def conflicting_to_null(c: C) -> Column:
    """Null for database entries that contradict themselves."""
    x = F.lower(col(c))
    both = lambda a, b: x.contains(a) & x.contains(b)
    return F.when(~(x.contains("conflicting") | both("benign", "pathogenic") | both("benign", "uncertain") | both("pathogenic", "uncertain")), col(c))


def chrom_with_prefix(c: C) -> Column:
    return F.when(col(c).contains("chr"), col(c)).otherwise(F.concat(F.lit("chr"), col(c)))


def longest_run(seq: C) -> Column:
    """Length of the longest run of one base."""
    return F.coalesce(F.array_max(F.transform(F.regexp_extract_all(col(seq), F.lit(r"((.)\2*)"), 1), F.length)), F.lit(0))


def base_share(seq: C) -> Column:
    """Share of the most frequent base, to two decimals."""
    s = col(seq)
    counts = [F.length(s) - F.length(F.translate(s, b, "")) for b in "ACGTN"]
    return F.round(F.greatest(*counts) / F.length(s), 2)


def is_homopolymer(seq: C) -> Column:
    return F.when((longest_run(seq) >= 5) | (base_share(seq) >= 0.8), 1).otherwise(0)


def is_low_complexity(seq: C) -> Column:
    absent = reduce(lambda a, b: a + b, [F.when(col(seq).contains(x), 0).otherwise(1) for x in "ACGT"])
    return F.when((absent >= 2) | (longest_run(seq) >= 4), 1).otherwise(0)


def genotype_word(c: C) -> Column:
    g = F.replace(col(c), F.lit("|"), F.lit("/"))
    return F.when(g == "1/1", "hom").when(g.isin("0/1", "1/0"), "het")


def genotype_text(c: C) -> Column:
    """Genotype as exported: hom, het, wt or n/a."""
    g = F.replace(col(c), F.lit("|"), F.lit("/"))
    return F.when(g == "1/1", "hom").when(g.isin("0/1", "1/0"), "het").when(g == "0/0", "wt").otherwise("n/a")


def variant_type(consequence: C, ref: C, alt: C) -> Column:
    """Plain words for a consequence; the two unspecific coding ones go by the alleles' lengths."""
    shift = F.when(length_difference(ref, alt) % 3 == 0, VARIANT_TYPE["inframe_deletion"]).otherwise(VARIANT_TYPE["frameshift_variant"])
    one_sided = (F.length(col(ref)) == 1) != (F.length(col(alt)) == 1)
    vague = col(consequence).isin("protein_altering_variant", "coding_sequence_variant") & one_sided
    return F.when(vague, shift).otherwise(F.coalesce(lookup(VARIANT_TYPE, col(consequence)), F.lit("unspecified variant")))


def trimmed(pos: C, ref: C, alt: C) -> Column:
    """start, end, ref, alt of a variant without what its alleles share: the first base, then the longest common end,
    then the longest common beginning; an empty allele is ``-``. Insertions lie between ``start`` and the next base."""
    p, r, a = col(pos), F.upper(col(ref)), F.upper(col(alt))
    longer = (F.length(r) > 1) | (F.length(a) > 1)
    first = F.when(longer & (F.substring(r, 1, 1) == F.substring(a, 1, 1)), 1).otherwise(0)
    r1, a1 = F.substr(r, first + 1), F.substr(a, first + 1)
    shared = lambda x, y: F.length(F.regexp_extract(F.concat(x, F.lit("\x01"), y), r"^([^\x01]*)[^\x01]*+\x01\1", 1))  # noqa: E731  longest common beginning
    end = shared(F.reverse(r1), F.reverse(a1))
    r2, a2 = F.substr(r1, F.lit(1), F.length(r1) - end), F.substr(a1, F.lit(1), F.length(a1) - end)
    begin = shared(r2, a2)
    r3, a3, at = F.substr(r2, begin + 1), F.substr(a2, begin + 1), p + first + begin
    start = F.when(F.length(r3) == 0, at - 1).otherwise(at)
    stop = F.when(F.length(r3) == 0, at - 1).otherwise(at + F.length(r3) - 1)
    dash = lambda x: F.when(F.length(x) == 0, "-").otherwise(x)
    return F.struct(start.alias("start"), stop.alias("end"), dash(r3).alias("ref"), dash(a3).alias("alt"))


def variant_key(chrom: C, pos: C, ref: C, alt: C) -> Column:
    v = trimmed(pos, ref, alt)
    return F.concat(col(chrom), F.lit(":"), v["start"].cast("string"), F.lit("-"), v["end"].cast("string"), F.lit("_"), v["ref"], F.lit(">"), v["alt"])


def split_key(key: C) -> Column:
    """chrom, start, end, ref, alt of a variant key."""
    part = lambda i: F.regexp_extract(col(key), r"^(.*):(\d+)-(\d+)_(.*)>(.*)$", i)
    return F.struct(part(1).alias("chrom"), part(2).try_cast("long").alias("start"), part(3).try_cast("long").alias("end"), part(4).alias("ref"), part(5).alias("alt"))


def info_text(cell: C, key: str) -> Column:
    """What a key says in an INFO cell with a semicolon before it; null without the key."""
    c, tag = col(cell), f";{key}="
    return F.when(F.contains(c, F.lit(tag)), F.substring_index(F.substring(c, F.instr(c, tag) + len(tag), F.length(c)), ";", 1))


def info_value(info: C, key: str) -> Column:
    """A key of an INFO cell, null where it stands for a missing value."""
    return let(let(F.concat(F.lit(";"), col(info)), lambda c: info_text(c, key)), missing_to_null)


def info_columns(info: C, columns: dict[str, tuple[str, str]]) -> list[Column]:
    """Columns of an INFO cell by name: (key, kind) with kind text, max, min (of an &-list), or splice (the largest of a
    |-separated record's four scores, which follow allele and symbol, over all records)."""

    def one(key: str, kind: str) -> Column:
        value = info_value(info, key)
        if kind == "splice":
            fields = F.flatten(F.transform(F.split(value, ","), lambda r: F.slice(F.split(r, r"\|"), 3, 4)))
            return F.array_max(F.filter(F.transform(fields, lambda t: t.try_cast("double")), lambda x: x.isNotNull()))
        return {"text": lambda: value, "max": lambda: score_max(value), "min": lambda: score_min(value, strict=True)}[kind]()

    return [one(key, kind).alias(name) for name, (key, kind) in columns.items()]


def genotype_fields(fmt: C, sample: C) -> Column:
    """gt, dp, ad_ref, ad_alt, gq, af of a sample cell by its FORMAT; missing values are null, a depth of 0 gives af 0."""
    cell = F.struct(F.split(col(fmt), ":").alias("names"), F.split(col(sample), ":").alias("cells"))

    def get(c: Column, k: str) -> Column:
        place = F.array_position(c["names"], F.lit(k)).cast("int")
        return missing_to_null(F.try_element_at(c["cells"], F.when(place > 0, place)))

    depth = lambda ad, i: F.try_element_at(F.split(ad, ","), F.lit(i)).try_cast("int")
    read = lambda c: F.struct(get(c, "GT").alias("gt"), get(c, "DP").try_cast("int").alias("dp"), let(get(c, "AD"), lambda ad: F.struct(depth(ad, 1).alias("ref"), depth(ad, 2).alias("alt"))).alias("ad"), get(c, "GQ").try_cast("int").alias("gq"))
    share = lambda r, a: F.when(r + a > 0, a / (r + a)).when(r + a == 0, 0.0)
    return let(let(cell, read), lambda x: F.struct(x["gt"].alias("gt"), x["dp"].alias("dp"), x["ad"]["ref"].alias("ad_ref"), x["ad"]["alt"].alias("ad_alt"), x["gq"].alias("gq"), share(x["ad"]["ref"], x["ad"]["alt"]).alias("af")))


def packed_genotypes(sample: C) -> Column:
    """Array of sample, gt, dp, alt from a cell that packs several samples as ``id=wt|dp|alt,...``."""
    cells = F.filter(F.split(col(sample), ","), lambda x: x.contains("="))
    gt = {"wt": "0/0", "het": "0/1", "hom": "1/1"}

    def one(x: Column) -> Column:
        parts = F.split(F.split(x, "=")[1], r"\|")
        at = lambda i: F.try_element_at(parts, F.lit(i))
        return F.struct(F.split(x, "=")[0].alias("sample"), F.coalesce(lookup(gt, at(1)), at(1)).alias("gt"), at(2).try_cast("int").alias("dp"), at(3).try_cast("int").alias("alt"))

    return F.transform(cells, one)


def csq_records(csq: C, fields: list[str]) -> Column:
    """The records of a CSQ value as an array of structs; missing values are null."""
    cells = F.transform(F.split(col(csq), ","), lambda r: F.split(r, r"\|"))
    return F.transform(cells, lambda c: F.struct(*[missing_to_null(F.try_element_at(c, F.lit(i + 1))).alias(f) for i, f in enumerate(fields)]))


def chosen_record(records: Column, canonical: list[str], consequence: str = "Consequence", feature: str = "Feature") -> Column:
    """The first record of a canonical transcript, else the one with the most severe consequence, first on a tie."""

    def chosen(rs: Column) -> Column:
        by_severity = F.array_min(F.transform(rs, lambda r, i: F.struct(severity(most_severe(r[consequence])).alias("s"), i.alias("i"))))["i"]
        own = F.filter(rs, lambda r: r[feature].isin(*canonical)) if canonical else F.filter(rs, lambda r: F.lit(False))
        return F.coalesce(F.try_element_at(own, F.lit(1)), F.try_element_at(rs, by_severity.cast("int") + 1))

    return let(records, chosen)
