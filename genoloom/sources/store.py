"""Resources kept for many annotations: one table of all allele resources, and the reference's tiles.

The allele store is bucketed and sorted by allele; variants join it without a shuffle of the table. A resource of a whole genome is merged into the store once, not grouped and shuffled at every annotation: the store has
one row an allele with the columns of all resources, so any number of them costs one join. Variants alone are shuffled,
into the store's buckets. An allele is its bases, or for long ones a 256-bit hash of them, so keys stay short."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("chrom", "pos", "allele")


def allele(ref: str = "ref", alt: str = "alt", longest: int = 64) -> Column:
    """``ref>alt``, hashed if longer than ``longest``; no base letter is in front of a hash, so the two can't be confused."""
    text = F.concat(ref, F.lit(">"), alt)
    return F.when(F.length(text) <= longest, text).otherwise(F.concat(F.lit("#"), F.sha2(text, 256)))


def merged(lists: list[tuple[DataFrame, list[str]]] = (), values: list[tuple[DataFrame, list[str]]] = (), keys: tuple[str, ...] = ()) -> DataFrame:
    """One row an allele of all resources (chrom, pos, ref, alt and their columns). Several hits in one of ``lists`` become
    a text, &-joined in order; ``values`` have one row an allele and keep their types. More ``keys``, such as a transcript,
    can be part of what is matched. One union, one aggregation."""
    parts = [df.select("chrom", "pos", allele().alias("allele"), *keys, *columns) for df, columns in (*lists, *values)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p, allowMissingColumns=True)
    joined = lambda c: F.when(F.count(c) > 0, F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), "&")).alias(c)
    return every.groupBy(*KEYS, *keys).agg(*[joined(c) for _, columns in lists for c in columns], *[F.max(c).alias(c) for _, columns in values for c in columns])


def write_store(df: DataFrame, path: str, buckets: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """``df`` (of ``merged``) as a store of one sorted file a bucket, opened. Take as many buckets as make files of a few
    hundred megabytes."""
    name = f"allele_store_{uuid.uuid4().hex}"
    by = (*KEYS, *keys)
    df.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by).format("parquet").option("path", path).saveAsTable(name)
    df.sparkSession.createDataFrame([(buckets, list(by))], "buckets int, keys array<string>").coalesce(1).write.parquet(f"{path}/_store")
    return df.sparkSession.table(name)


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """A store that another session has written."""
    found = spark.read.parquet(f"{path}/_store").first()
    name, by = f"allele_store_{uuid.uuid4().hex}", ", ".join(f"`{k}`" for k in found["keys"])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {found['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def with_store(variants: DataFrame, store: DataFrame, columns: list[str] | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """``variants`` with ``columns`` (by default all) of the store at their allele, null where it has none. Only the columns
    that are asked for are read."""
    by = (*KEYS, *keys)
    columns = [c for c in store.columns if c not in by] if columns is None else columns
    return variants.withColumn("allele", allele()).join(store.select(*by, *columns), list(by), "left").drop("allele").select(*variants.columns, *columns)


def write_tiles(tiles: DataFrame, path: str, block_tiles: int = 4096) -> None:
    """Reference tiles (chrom, tile, seq) as files of ``block_tiles`` neighbouring tiles, a folder each, sorted."""
    blocks = tiles.withColumn("block", F.floor(F.col("tile") / block_tiles))
    blocks.repartition("chrom", "block").sortWithinPartitions("chrom", "block", "tile").write.partitionBy("chrom", "block").parquet(path)
    tiles.sparkSession.createDataFrame([(block_tiles,)], "block_tiles int").coalesce(1).write.parquet(f"{path}/_tiles")


def tiles_around(variants: DataFrame, path: str, width: int, reach: int = 8) -> DataFrame:
    """The tiles (of ``width`` bases) of a tile store around ``variants``, for ``with_context`` and ``expand_indels``. The
    blocks that hold any of them are found first, at most as many as the genome has, and only their files are opened: a
    panel of a few genes reads a few files, whatever the genome's size. ``reach``: bases on either side of a variant's."""
    spark = variants.sparkSession
    own = spark.read.parquet(f"{path}/_tiles").first()["block_tiles"] * width
    first, last = F.greatest(F.col("pos") - 1 - reach, F.lit(0)), F.col("pos") + F.length("ref") + reach
    asked = variants.select("chrom", F.explode(F.sequence(F.floor(first / own), F.floor(last / own))).alias("block")).distinct().collect()
    blocks: dict[str, list[int]] = {}
    for r in asked:
        blocks.setdefault(r.chrom, []).append(r.block)
    wanted = F.lit(False)
    for chrom, some in sorted(blocks.items(), key=str):
        wanted = wanted | ((F.col("chrom") == chrom) & F.col("block").isin(some))
    return spark.read.schema("tile long, seq string, chrom string, block long").parquet(path).filter(wanted).select("chrom", "tile", "seq")
