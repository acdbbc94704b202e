"""Ranks, orders and their evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import written


def ranked(df: DataFrame, score: str = "final_score", keys: tuple[str, ...] = ("sample_id",), out: str = "rank") -> DataFrame:
    """Least rank on ties, best score first, nulls last, within each sample."""
    return df.withColumn(out, F.rank().over(Window.partitionBy(*keys).orderBy(F.desc_nulls_last(score))))


def ranked_in_pieces(df: DataFrame, score: str = "final_score", keys: tuple[str, ...] = ("sample_id",), out: str = "rank", piece_rows: int = 250_000, pieces: int = 256, salts: int = 64) -> DataFrame:
    """The ranks of ``ranked``, with no task that sees a whole large sample.

    A sample of over ``piece_rows`` rows is cut at about ``pieces`` quantiles of its scores. Rows between two cuts are one
    piece; rows that equal a cut, and those without a score, are a piece of their own: they all tie, so their rank
    within the piece is 1, and they are dealt by a hash (``salts``). So however many rows share a score, no task sorts
    them. The rows of all pieces before a piece are one running sum over a sample's pieces, a few hundred numbers, and a
    row's rank is that sum plus its rank within its piece.

    ``df`` is written once to the shared folder and read three times: for the quantiles (of the columns of keys and
    score alone), for the counts, and for the ranks; the rows are shuffled once."""
    df = written(df, "to-rank")
    s = F.col(score)
    cuts = [i / pieces for i in range(1, pieces)]
    per_sample = df.groupBy(*keys).agg(F.count("*").alias("_n"), F.percentile_approx(s, cuts, 20 * pieces).alias("_cuts"))
    same = lambda a, b: [a[k].eqNullSafe(b[f"_k{i}"]) for i, k in enumerate(keys)]
    named = lambda d, *more: d.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *more)
    large = written(named(per_sample.filter(F.col("_n") > piece_rows), F.array_distinct("_cuts").alias("_cuts")), "cuts")  # at most rows / piece_rows samples

    def cut(d: DataFrame, cuts: DataFrame) -> DataFrame:
        """``d`` with _piece: 0 in small samples; else even between cuts, odd at a cut, ascending as scores fall."""
        met = d.join(cuts, same(d, cuts), "left").drop(*[f"_k{i}" for i in range(len(keys))])
        above, at = F.size(F.filter("_cuts", lambda c: c > s)), F.array_contains("_cuts", s)
        return met.withColumn("_piece", F.when(F.col("_cuts").isNull(), 0).when(s.isNull(), 2 * F.size("_cuts") + 1).otherwise(2 * above + at.cast("int")))

    few = df.select(*keys, score)
    counts = cut(few, large).filter("_cuts IS NOT NULL").groupBy(*keys, "_piece").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1))
    sums = counts.withColumn("_before", F.coalesce(before, F.lit(0))).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_piece", "_before"))).alias("_sums"))
    sums = named(sums, "_sums")
    with_sums = large.join(sums, [large[f"_k{i}"].eqNullSafe(sums[f"_k{i}"]) for i in range(len(keys))], "left").select(*[large[f"_k{i}"] for i in range(len(keys))], "_cuts", "_sums")
    rows = cut(df, written(with_sums, "pieces"))
    tie = F.when(F.col("_piece") % 2 == 1, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t]), F.lit(salts)))
    before = F.coalesce(F.try_element_at("_sums", F.col("_piece")), F.lit(0))  # looked up here: a sample's cuts and sums don't travel with its rows
    rows = rows.withColumns({"_salt": tie, "_before": before}).drop("_cuts", "_sums")
    within = F.rank().over(Window.partitionBy(*keys, "_piece", "_salt").orderBy(F.desc_nulls_last(score)))
    placed = rows.withColumn(out, (within + F.col("_before")).cast("int"))
    return placed.drop("_before", "_piece", "_salt")


def top_ranked(df: DataFrame, k: int, score: str = "final_score", keys: tuple[str, ...] = ("sample_id",)) -> DataFrame:
    """As ``ranked``, rows of rank at most ``k``; Spark prunes each partition's groups before the shuffle."""
    return ranked(df, score, keys).filter(F.col("rank") <= k)


def by_score(df: DataFrame, score: str = "final_score") -> DataFrame:
    return df.orderBy(F.desc_nulls_last(score))


def by_place(df: DataFrame, chrom: str = "chrom", pos: str = "pos") -> DataFrame:
    """Order by chromosome as text, then position."""
    return df.orderBy(chrom, pos)


def shuffled(df: DataFrame, seed: int, *keys: str) -> DataFrame:
    """``df`` with shuffle_rank: an order by a hash of seed and keys, the same in every run and partitioning."""
    return df.withColumn("shuffle_rank", F.row_number().over(Window.partitionBy(keys[0]).orderBy(F.xxhash64(F.lit(seed), *keys), *keys)))


def pick_rank(causal: str, picks: list[str]):
    """Place of the causal gene among the picks, -1 if it isn't there."""
    out = F.lit(-1)
    for i, p in reversed(list(enumerate(picks, 1))):
        out = F.when(F.col(p) == F.col(causal), i).otherwise(out)
    return out


def causal_ranks(df: DataFrame, score: str = "pathogenicity", label: str = "label", keys: tuple[str, ...] = ("sample_id",)) -> DataFrame:
    """keys, causal_rank: the best rank of a sample's variants of label 1 by score; samples without one have no row."""
    return ranked(df, score, keys, "causal_rank").filter(F.col(label) == 1).groupBy(*keys).agg(F.min("causal_rank").alias("causal_rank"))


def hit_rates(df: DataFrame, rank: str = "causal_rank", ks: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Share of samples whose causal gene ranks within each k."""
    return df.agg(F.count("*").alias("samples"), *[F.avg(F.when((F.col(rank) >= 1) & (F.col(rank) <= k), 1.0).otherwise(0.0)).alias(f"top_{k}") for k in ks])
