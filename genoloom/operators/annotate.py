"""Joins that attach resources to variants, the variant routes, and the back-fill of indels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from ..config import CODING, SEED, SPLICE, SYNONYMOUS
from ..functions import scalars as X
from ..shared import written

ALLELE = ("chrom", "pos", "ref", "alt")


def by_allele(variants: DataFrame, resource: DataFrame, scores: list[str], keys: tuple[str, ...] = ALLELE) -> DataFrame:
    """Exact-allele left join. Several hits of a key become one &-separated cell, in the order of their values, so the
    join never multiplies variants. Both sides shuffle on the key, once if bucketed by it. Add a transcript to ``keys``
    for transcript-matched resources."""
    joined = [F.array_join(F.array_sort(F.collect_set(F.col(s).cast("string"))), "&") for s in scores]
    one = resource.groupBy(*keys).agg(*[F.when(F.count(s) > 0, j).alias(s) for s, j in zip(scores, joined)])
    return variants.join(one, list(keys), "left")


def by_unique_allele(variants: DataFrame, resource: DataFrame, scores: list[str], keys: tuple[str, ...] = ALLELE) -> DataFrame:
    """As ``by_allele`` for resources with one row a key; values keep their type."""
    return variants.join(resource.select(*keys, *scores), list(keys), "left")


def _bins(first: Column, last: Column, width: Column | int) -> Column:
    return F.sequence(F.floor(first / width), F.floor(last / width))


def overlaps(variants: DataFrame, regions: DataFrame, id_col: str = "variant_id", width: int = 4096, chrom: str = "chrom", factor: int = 8, levels: int = 9) -> DataFrame:
    """id, name for each region (``chrom, start0, end0, name``; half-open, from 0) that a variant's reference bases touch.

    Bins come in ``levels`` sizes, each ``factor`` times the one before, the last one without an end. A region is in one
    bin: the smallest that holds all of it, so a region as long as a chromosome is one row like any other. A variant asks
    the bin it lies in (or two, at a border) of each size that its chromosome's regions use, and both meet by an equi-join
    on chromosome, size and bin; a pair can meet but once, so no distinct is needed."""
    sizes = [width * factor**i for i in range(levels - 1)]
    last = len(sizes)  # of all that no smaller bin holds
    v = variants.select(F.col(id_col), F.col(chrom).alias("_c"), (F.col("pos") - 1).alias("_a"), (F.col("pos") - 1 + F.length("ref")).alias("_b")).filter("_b > _a")
    r = regions.filter("end0 > start0").select(F.col("chrom").alias("_c"), F.col("start0").alias("_s"), F.col("end0").alias("_e"), "name")
    holds = lambda w: F.floor(F.col("_s") / w) == F.floor((F.col("_e") - 1) / w)
    level, place = F.lit(last), F.lit(0).cast("long")
    for i, w in reversed(list(enumerate(sizes))):
        level, place = F.when(holds(w), i).otherwise(level), F.when(holds(w), F.floor(F.col("_s") / w)).otherwise(place)
    r = r.select("*", level.alias("_level"), place.alias("_bin"))
    used = F.broadcast(r.groupBy("_c").agg(F.collect_set("_level").alias("_used")))  # one row a chromosome, at most ``levels`` numbers in each
    size_of = F.array(*map(F.lit, [*sizes, 0]))
    bins = lambda i: F.when(i == last, F.array(F.lit(0).cast("long"))).otherwise(_bins(F.col("_a"), F.col("_b") - 1, F.get(size_of, i)))
    asked = F.flatten(F.transform("_used", lambda i: F.transform(bins(i), lambda k: F.struct(i.alias("level"), k.alias("bin")))))
    v = v.join(used, "_c").withColumn("_q", F.explode(asked)).select(id_col, "_c", "_a", "_b", F.col("_q.level").alias("_level"), F.col("_q.bin").alias("_bin"))
    return v.join(r, ["_c", "_level", "_bin"]).filter((F.col("_s") < F.col("_b")) & (F.col("_e") > F.col("_a"))).select(id_col, "name")


def with_regions(variants: DataFrame, regions: DataFrame, out: str, id_col: str = "variant_id", width: int = 4096, stretch_rows: int = 16_384) -> DataFrame:
    """``variants`` with the names of all overlapping regions, &-joined in order; null where none does.

    Pairs of a variant and a region, which long regions make many, are never rows. A chromosome is cut into stretches of
    about ``stretch_rows`` variants and of at least ``width`` bases and the longest reference bases. A region goes to the
    stretches that it can touch and that hold variants; each stretch is a stream, its regions first, in order of their
    names, then its variants, whole, each compared with them by array operations. So what is shuffled are the variants
    once and the regions once a stretch, and a task holds one stretch's regions. A stretch of far more variants is dealt
    over several streams by a hash. Broadcast are a row a chromosome and a row a stretch."""
    spark = variants.sparkSession
    first, bases = F.col("pos") - 1, F.length("ref")
    v = variants.select(F.col("chrom").alias("_c"), first.alias("_a"), (first + bases).alias("_b"), F.struct(*[F.col(f"`{c}`") for c in variants.columns]).alias("_row"), F.xxhash64(id_col).alias("_h"))
    span, streams = F.max("_a") - F.min("_a") + 1, F.ceil(F.count("_a") / stretch_rows)
    shape = v.filter("_b > _a").groupBy("_c").agg(F.greatest(F.ceil(span / streams), F.max(F.col("_b") - F.col("_a")), F.lit(width)).alias("_w"), F.min("_a").alias("_lo"), F.max("_a").alias("_hi"))
    shape = F.broadcast(written(shape, "chromosomes"))
    v = v.join(shape, "_c", "left").withColumn("_tile", F.when(F.col("_b") > F.col("_a"), F.floor(F.col("_a") / F.col("_w"))))
    held = v.filter("_tile IS NOT NULL").groupBy("_c", "_tile").agg(F.ceil(F.count("*") / (4 * stretch_rows)).alias("_salts"))
    held = F.broadcast(written(held, "stretches"))
    deal = F.pmod("_h", F.coalesce("_salts", F.lit(4096)))  # those without a place meet no region
    v = v.join(held, ["_c", "_tile"], "left").select("_c", "_tile", deal.alias("_salt"), "_a", "_b", F.lit(None).cast("string").alias("_name"), "_row")
    r = regions.filter("end0 > start0 AND name IS NOT NULL").select(F.col("chrom").alias("_c"), F.col("start0").cast("long").alias("_a"), F.col("end0").cast("long").alias("_b"), F.col("name").cast("string").alias("_name")).join(shape, "_c")
    from_, to = F.greatest(F.floor(F.col("_a") / F.col("_w")) - 1, F.floor(F.col("_lo") / F.col("_w"))), F.least(F.floor((F.col("_b") - 1) / F.col("_w")), F.floor(F.col("_hi") / F.col("_w")))
    r = r.withColumns({"_from": from_, "_to": to}).filter("_from <= _to").withColumn("_tile", F.explode(F.sequence("_from", "_to"))).join(held, ["_c", "_tile"])
    r = r.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1))).select("_c", "_tile", "_salt", "_a", "_b", "_name", F.lit(None).cast(v.schema["_row"].dataType).alias("_row"))
    streams = v.unionByName(r).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "_c", "_tile", "_salt")  # few bytes, much work: not to be merged by size
    keys = ["_c", "_tile", "_salt"]
    listed = streams.sortWithinPartitions(*keys, F.col("_row").isNotNull(), "_name").select(*keys, F.col("_row").isNull().alias("_region"), "_a", "_b", "_name", "_row")
    made = StructType([StructField("_row", v.schema["_row"].dataType), StructField("_out", StringType())])
    schema = to_arrow_schema(made)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, starts, ends, names, known = None, [], [], [], None
        for batch in batches:
            of = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            is_region, a, b, text = (batch.column(i).to_pylist() for i in range(3, 7))
            rows, found, size = [], [], 0
            piece = lambda: pa.RecordBatch.from_arrays([batch.column(7).take(pa.array(rows, pa.int64())).cast(schema.field(0).type), pa.array(found, schema.field(1).type)], schema=schema)  # noqa: B023, E731
            for i, key in enumerate(of):
                if key != at:
                    at, starts, ends, names, known = key, [], [], [], None
                if is_region[i]:
                    starts.append(a[i]), ends.append(b[i]), names.append(text[i])
                    continue
                if known is None:
                    known = np.array(starts, np.int64), np.array(ends, np.int64), np.array(names, object), np.cumsum([0, *(x != y for x, y in zip(names[1:], names))])
                    unlike = known[3][-1] == len(names) - 1  # no name comes twice
                rows.append(i)
                hit = np.flatnonzero((known[0] < b[i]) & (known[1] > a[i])) if names and a[i] is not None and b[i] is not None and b[i] > a[i] else ()
                if len(hit) and not unlike:
                    hit = hit[np.flatnonzero(np.diff(known[3][hit], prepend=-1))]
                found.append("&".join(known[2][hit].tolist()) if len(hit) else None)
                size += len(found[-1] or "")
                if size > 1 << 24:
                    yield piece()
                    rows, found, size = [], [], 0
            if rows:
                yield piece()

    return listed.mapInArrow(meet, made).select("_row.*", F.col("_out").alias(out))


def with_track(variants: DataFrame, track: DataFrame, out: str, width: int = 1 << 16) -> DataFrame:
    """``variants`` with the value of the interval (``chrom, start0, end0, value``; intervals don't overlap) at their position.

    Starts of intervals and positions of variants are one ordered list, in which a variant takes the last interval before
    it. The list is cut into tiles of ``width`` bases, each sorted by a task; what is the last interval before a tile is
    carried over its border. The track, an interval a base if need be, is shuffled once as it is, tiles without a variant
    not at all, and the variants travel whole, so nothing is joined back. Two tables are broadcast, of a row a tile that
    holds something: at most as many as there are tiles in a genome."""
    tile = F.floor(F.col("_p") / width)
    points = variants.select(F.col("chrom").alias("_c"), (F.col("pos") - 1).alias("_p"), F.struct(*[F.col(f"`{c}`") for c in variants.columns]).alias("_row")).withColumn("_tile", tile)
    starts = track.select(F.col("chrom").alias("_c"), F.col("start0").alias("_p"), F.struct(F.col("end0").alias("end"), F.col("value").alias("value")).alias("_v")).withColumn("_tile", tile)
    wanted = points.select("_c", "_tile").distinct()
    ends = starts.groupBy("_c", "_tile").agg(F.max_by("_v", "_p").alias("_v")).unionByName(wanted, allowMissingColumns=True).groupBy("_c", "_tile").agg(F.first("_v", ignorenulls=True).alias("_v"))
    order = Window.partitionBy("_c").orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_c", "_tile", F.last("_v", ignorenulls=True).over(order).alias("_carried"))
    needed = starts.join(F.broadcast(wanted), ["_c", "_tile"], "left_semi")
    listed = points.unionByName(needed, allowMissingColumns=True).join(F.broadcast(carried), ["_c", "_tile"], "left")
    sweep = Window.partitionBy("_c", "_tile").orderBy("_p", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    met = listed.withColumn("_hit", F.coalesce(F.last("_v", ignorenulls=True).over(sweep), "_carried")).filter("_row IS NOT NULL")
    return met.select("_row.*", F.when(F.col("_hit.end") > F.col("_p"), F.col("_hit.value")).alias(out))


def with_context(variants: DataFrame, tiles: DataFrame, width: int, reach: int = 5, id_col: str = "variant_id", out: str = "context") -> DataFrame:
    """``variants`` with the reference bases from ``reach`` before their position to ``reach`` - 1 after it, of tiles
    (chrom, tile, seq) of ``width`` bases; ``.`` where the contig is missing. One or two tiles meet each variant."""
    from_, to = F.greatest(F.col("pos") - 1 - reach, F.lit(0)), F.col("pos") + reach
    want = variants.select(id_col, "chrom", from_.alias("_a"), to.alias("_b")).withColumn("tile", F.explode(_bins(F.col("_a"), F.col("_b") - 1, width)))
    begin = F.greatest(F.col("_a") - F.col("tile") * width, F.lit(0))
    part = F.substr("seq", (begin + 1).cast("int"), (F.least(F.col("_b") - F.col("tile") * width, F.lit(width)) - begin).cast("int"))
    met = want.join(tiles, ["chrom", "tile"]).groupBy(id_col).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tile", part.alias("s")))), lambda x: x["s"]), "").alias(out))
    return variants.join(met, id_col, "left").withColumn(out, F.coalesce(out, F.lit(".")))


def coding_only(variants: DataFrame, consequences: str = "consequences") -> DataFrame:
    """Variants of which any transcript has a coding, splice or synonymous term; ``consequences`` holds one &-list per
    transcript (array). Rows without the annotation go. INFO, if there, gets the mark of the filter."""
    wanted = F.array(*[F.lit(t) for t in (*CODING, *SPLICE, *SYNONYMOUS)])
    kept = variants.filter(F.arrays_overlap(F.flatten(F.transform(consequences, lambda c: F.split(c, "&"))), wanted))
    return kept.withColumn("info", F.concat("info", F.lit(";CODING_FILTERED=TRUE"))) if "info" in variants.columns else kept


def routed(variants: DataFrame) -> DataFrame:
    """``variants`` with route: ``snv`` (one base by one), ``indel`` (one side longer); those with several alternative
    alleles, or both sides longer, are dropped."""
    r, a = F.length("ref"), F.length("alt")
    route = F.when((r == 1) & (a == 1), "snv").when((r == 1) | (a == 1), "indel")
    return variants.filter(~F.col("alt").contains(",")).withColumn("route", route).filter("route IS NOT NULL")


def with_indel_id(variants: DataFrame) -> DataFrame:
    """``variants`` with indel_id, the same for rows of one allele and for no other: its place and a hash of its bases.
    A join key and nothing more, so no running number, which one task a chromosome would have to give, is needed."""
    bases = F.hex(F.xxhash64("ref", "alt"))
    return variants.withColumn("indel_id", F.concat_ws("_", F.lit("indel"), "chrom", F.col("pos").cast("string"), bases))


def expand_indels(indels: DataFrame, tiles: DataFrame, width: int, seed: int = SEED) -> DataFrame:
    """Synthetic SNVs around each indel: one for every reference base from two before it to two after its bases (N
    skipped, lower case raised), with an alternative of the other kind drawn by a hash of the seed and the place."""
    from_, to = F.greatest(F.col("pos") - 3, F.lit(0)), F.col("pos") + F.length("ref") + 2
    want = indels.select("indel_id", "chrom", F.explode(F.sequence(from_, to - 1)).alias("_p"))
    base = F.upper(F.substr("seq", (F.col("_p") % width + 1).cast("int"), F.lit(1)))
    met = want.withColumn("tile", F.floor(F.col("_p") / width)).join(tiles, ["chrom", "tile"]).select("indel_id", "chrom", (F.col("_p") + 1).alias("pos"), base.alias("ref"))
    coin = F.pmod(F.xxhash64(F.lit(seed), "chrom", "pos", "indel_id"), F.lit(2)) == 0
    alt = F.when(F.col("ref").isin("A", "T"), F.when(coin, "G").otherwise("C")).otherwise(F.when(coin, "A").otherwise("T"))
    return met.filter(F.col("ref").isin("A", "C", "G", "T")).withColumn("alt", alt)


def indel_means(expanded: DataFrame, features: list[str], impact: str = "impact", consequence: str = "consequence") -> DataFrame:
    """Mean of each feature over an indel's synthetic SNVs that are neither synonymous nor splice and of HIGH or MODERATE
    impact; of those, HIGH ones without a value count as 1. One aggregation for all features."""
    counted = ~X.any_term(consequence, SPLICE + SYNONYMOUS) & F.col(impact).isin("HIGH", "MODERATE")
    value = lambda f: F.coalesce(X.score_max(f), F.when(F.col(impact) == "HIGH", 1.0))
    return expanded.groupBy("indel_id").agg(*[F.avg(F.when(counted, value(f))).alias(f) for f in features])


def backfilled(indels: DataFrame, expanded: DataFrame, features: list[str]) -> DataFrame:
    """``indels`` with their features taken from the synthetic SNVs around them."""
    return indels.drop(*features).join(indel_means(expanded, features), "indel_id", "left")
