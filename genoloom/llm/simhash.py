"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint's 32 segments of two bits are mapped to their bit counts. The Manhattan distance of two such vectors never
exceeds the fingerprints' Hamming distance, so it is a lower bound for pruning. The vectors are cut into ``limit + 2``
blocks; vectors within ``limit`` agree in at least two blocks, so the grid cells of a fingerprint are its vectors'
values in every two blocks (15 cells for a limit of 4). From 2^25 distinct fingerprints on, ``limit + 4`` blocks of which
four must agree (70 cells) keep the cells small; the links are the same. Rows of a cell are compared in Arrow batches:
lower bound first, then the exact distance. A cell gives only a spanning forest of its links, never all pairs; a crowded
cell is dealt over pairs of bounded sub-blocks. Components come from contracting the links round by round; a
fingerprint has at most 679,120 others within 4 bits, so no node is a larger hub.

Edge cases: a null text is an empty one; a text without words has fingerprint zero and links like any other; texts of
any length are read whole; repeated doc_ids each get a row; a null doc_id gets a row and is never a component's name
unless all its members are null; an empty table gives an empty result; other columns are ignored, or kept by
``keep_one``. Copies share a fingerprint and meet as one row before any comparison.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from .common import arrow_schema, batch_of, join_skewed, map_rows, saved, ship, stored, table

LANES = 0x5555555555555555


def fingerprint(raw: bytes, words: int = 4, seed: int = 42) -> bytes:
    """Eight bytes, most significant first, of a text's UTF-8 bytes."""
    found = raw.lower().split()  # of bytes: A-Z and ASCII white space only
    if not found:
        return bytes(8)
    joined, k = b" ".join(found), min(words, len(found))
    ends = list(accumulate(len(w) + 1 for w in found))
    starts = [0, *ends]
    total, n = np.zeros(64, np.int64), len(found) - k + 1
    for at in range(0, n, 1 << 15):
        part = range(at, min(n, at + (1 << 15)))
        hashes = b"".join([xxh64_digest(joined[starts[i] : ends[i + k - 1] - 1], seed) for i in part])
        total += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return np.packbits(total * 2 > n).tobytes()


def fingerprints(docs: DataFrame, *carried: str) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of whole texts, and ``carried`` columns of longs."""

    def make():
        def step(ids, texts, *more):
            raw = b"".join([fingerprint(x or b"") for x in texts])
            return [ids, np.frombuffer(raw, ">i8").astype(np.int64), *more]

        return step

    ddl = ", ".join(["doc_id long", "fp long", *(f"{c} long" for c in carried)])
    return map_rows(docs.select("doc_id", F.col("text").cast("binary").alias("raw"), *carried), make, ddl, ["doc_id", "raw", *carried])


def popcounts(fp: Column) -> Column:
    """The bit counts of the 32 two-bit segments, two bits each, in one long."""
    lanes = F.lit(LANES)
    even, odd = fp.bitwiseAND(lanes), F.shiftrightunsigned(fp, 1).bitwiseAND(lanes)
    return even.bitwiseXOR(odd).bitwiseOR(F.shiftleft(even.bitwiseAND(odd), 1))  # their sum, without overflow of the sign


def _masks(limit: int, blocks: int) -> list[int]:
    """For every ``blocks - limit`` of the blocks of segments, the mask of their lanes, as a signed long."""
    cut = [32 * i // blocks * 2 for i in range(blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(cut, cut[1:])]
    return [int(np.array([sum(x)], np.uint64).view(np.int64)[0]) for x in combinations(block, blocks - limit)]


def _forest(cell: np.ndarray, fp: np.ndarray, limit: int) -> np.ndarray:
    """For sorted cells, each row's first linked row within its cell (by links of links): labels, as row numbers."""
    n = len(fp)
    label, alive, step = np.arange(n), np.arange(n), 1
    x = fp.view(np.uint64)
    lanes = np.uint64(LANES)
    counts = (x & lanes) + ((x >> np.uint64(1)) & lanes)
    while True:
        alive = alive[alive + step < n]
        alive = alive[cell[alive + step] == cell[alive]]
        if not len(alive):
            return label
        other = alive + step
        diff = counts[alive] ^ counts[other]
        bound = np.bitwise_count(diff & lanes) + 2 * np.bitwise_count((diff >> np.uint64(1)) & ~diff & lanes)
        near = np.flatnonzero(bound <= limit)
        a, b = alive[near], other[near]
        linked = np.bitwise_count(x[a] ^ x[b]) <= limit
        a, b = label[a[linked]], label[b[linked]]
        apart = a != b
        if apart.any():
            root: dict[int, int] = {}

            def find(i):
                while i in root:
                    i = root[i]
                return i

            for i, j in zip(a[apart].tolist(), b[apart].tolist()):
                i, j = find(i), find(j)
                if i != j:
                    root[max(i, j)] = min(i, j)
            renamed = np.arange(n)
            for i in root:
                renamed[i] = find(i)
            label = renamed[label]
        step += 1


def links(fps: DataFrame, limit: int = 4, block_rows: int = 4096, blocks: int | None = None) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp) that join all that are within ``limit`` of each other,
    directly or by links of links. ``blocks`` (by default chosen from their number) only sets how fine the cells are.
    ``block_rows`` bounds the rows compared with each other in one go: fuller cells are
    dealt by hash into sub-blocks, and every two of those meet once."""
    n = fps.count()
    masks = _masks(limit, blocks or (limit + 2 if n < 1 << 25 else limit + 4))
    cells = fps.select("fp", F.posexplode(F.array(*[popcounts(F.col("fp")).bitwiseAND(F.lit(m)) for m in masks])).alias("pair", "key"))
    sizes = cells.groupBy("pair", "key").agg(F.count("*").alias("n")).filter("n > 1")
    own = F.pmod(F.hash("fp"), F.col("k"))
    dealt = (
        join_skewed(cells, sizes.withColumn("k", F.ceil(F.col("n") / block_rows).cast("int")), ["pair", "key"], n * len(masks))
        .withColumn("other", F.explode(F.when(F.col("k") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("k") - 1))))
        .select("fp", F.struct("pair", "key", F.least(own, "other").alias("i"), F.greatest(own, "other").alias("j")).alias("cell"))
        .select("fp", F.xxhash64("cell").alias("cell"))  # a clash of hashes only compares more rows
    )
    schema = arrow_schema("a long, b long")

    def run(batches):
        cell, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def found(c, f):
            label = _forest(c, f, limit)
            rows = np.flatnonzero(label != np.arange(len(label)))
            return batch_of(schema, [f[rows], f[label[rows]]])

        for batch in batches:
            cell, fp = np.concatenate([cell, batch.column(0).to_numpy()]), np.concatenate([fp, batch.column(1).to_numpy()])
            if len(cell) > 1 << 16:
                last = np.searchsorted(cell, cell[-1])  # the last cell may go on in the next batch
                if last:
                    yield found(cell[:last], fp[:last])
                    cell, fp = cell[last:], fp[last:]
        yield found(cell, fp)

    ship(fps.sparkSession)
    return dealt.select("cell", "fp").repartition("cell").sortWithinPartitions("cell", "fp").mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame, most: int = 100_000) -> DataFrame:
    """node, root of every node of the links (a, b). In each round a node moves to its neighbour (or itself) of least
    hash, anew in each round, and the links are carried over; links within one node vanish. Expected rounds: the
    logarithm of the largest component. Only nodes that have links take part; nothing is collected. Where there are over
    ``most`` links or nodes, nodes of many links and components of many nodes are joined apart."""
    links_, maps = saved(edges.select("a", "b").filter("a != b").distinct()), []
    while left := links_.count():
        r = F.lit(len(maps))
        both = links_.unionByName(links_.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", r).alias("h"), "b")).alias("m"), F.count("*").alias("n"))
        moved = saved(least.select(F.col("a").alias("node"), F.when(F.struct(F.xxhash64("a", r).alias("h"), F.col("a").alias("b")) < F.col("m"), F.col("a")).otherwise(F.col("m.b")).alias("root"), "n"))
        to = lambda c: moved.select(F.col("node").alias(c), F.col("root").alias(f"{c}_to"), "n")  # noqa: E731, B023
        met = join_skewed(join_skewed(links_, to("a"), ["a"], left, most), to("b"), ["b"], left, most)  # a node may have any number of links
        links_ = saved(met.select(F.col("a_to").alias("a"), F.col("b_to").alias("b")).filter("a != b").distinct())
        maps.append(moved.drop("n"))
    if not maps:
        return links_.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = maps[0]
    many = len(maps) > 1 and out.count() > most
    for later in maps[1:]:
        after = later.select(F.col("node").alias("root"), F.col("root").alias("next"))
        if many:
            out = saved(out)
            ends = out.groupBy("root").agg(F.count("*").alias("n")).join(after, "root", "left").select("root", F.coalesce("next", "root").alias("next"), "n")
            out = join_skewed(out, ends, ["root"], out.count(), most).select("node", F.col("next").alias("root"))
        else:
            out = out.join(after, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return out


def _named(prints: DataFrame, limit: int, *more: Column) -> tuple[DataFrame, int]:
    """fp, root (a fingerprint of its component), n (rows with this fp) and ``more`` aggregates, of each distinct
    fingerprint; and the number of rows."""
    distinct = stored(prints.groupBy("fp").agg(F.count("*").alias("n"), *more), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), limit)).withColumnRenamed("node", "fp")
    named = stored(distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "named-fingerprints")
    return named, named.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def near_duplicates(docs: DataFrame, limit: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id (the smallest doc_id of its group)."""
    prints = stored(fingerprints(docs), "fingerprints")
    named, total = _named(prints, limit, F.min("doc_id").alias("least"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    groups = join_skewed(named.select("fp", "root", F.col("n").alias("rows")), least, ["root"], total).select("fp", "component_id", F.col("rows").alias("n"))
    return join_skewed(prints, groups, ["fp"], total).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, limit: int = 4, most: int = 250_000) -> DataFrame:
    """``docs`` without near-duplicates: of each group one row stays, that of smallest doc_id, then of smallest hash of its
    text; rows without an id come last. Rows that share an id but not a group all stay. A row is known by its id and 128
    bits of its text. The rows to drop are told apart where they lie, without a shuffle of texts, if there are at most
    ``most`` of them to broadcast, else in a join. Of rows equal in id and text one stays, with its other columns."""
    keys = ["id", "h1", "h2"]
    hashes = [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")]
    prints = stored(fingerprints(docs.select("doc_id", "text", *hashes), "h1", "h2").withColumnRenamed("doc_id", "id"), "fingerprints")
    row = F.struct(F.col("id").isNull().alias("last"), *keys)
    named, total = _named(prints, limit, F.min(row).alias("first"))
    groups = named.groupBy("root").agg(F.min("first").alias("first"), F.sum("n").alias("rows"), F.count("*").alias("n")).filter("rows > 1")
    members = join_skewed(named.select("fp", "root", F.col("n").alias("own")), groups, ["root"], total).select("fp", F.col("first").alias("stays"), F.col("own").alias("n"))
    found = join_skewed(prints, members, ["fp"], total).withColumn("stays", F.col("stays") == row).groupBy(*keys, "stays").agg(F.count("*").alias("n"))
    found = stored(found.filter("NOT stays OR n > 1"), "near-duplicates")  # rows to drop, and rows of which one stays
    many, repeated = found.agg(F.count("*"), F.count_if("stays")).first()
    packed = docs.select(F.col("doc_id").alias("id"), *hashes, F.struct("*").alias("doc"))  # so that no column of docs can clash with ours
    away = found.select(*[F.col(k).alias(f"{k}_") for k in keys], "stays")
    away = F.broadcast(away) if many <= most else away
    same = F.col("id").eqNullSafe(F.col("id_")) & (F.col("h1") == F.col("h1_")) & (F.col("h2") == F.col("h2_"))
    kept = packed.join(away, same, "left_anti").select("doc.*")
    if repeated:
        kept = kept.unionByName(packed.join(away.filter("stays"), same, "left_semi").dropDuplicates(keys).select("doc.*"))
    return kept


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
