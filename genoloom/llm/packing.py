"""Best-fit packing with certified bin counts.

Documents' lengths are dealt over partitions so that each has the same mix; each is packed best-fit decreasing and its bin count compared with
the largest of several dual-feasible-function lower bounds. A partition that meets its bound is certified and closed.
The others give the documents of their bins with gaps to a common pool, which is dealt anew over fewer partitions and
packed again; a round that saves no bin is dropped and ends the work. Lengths alone travel, never ids.

Edge cases: null and empty texts are one piece, the end id; a text of any length is cut into whole pieces of the
capacity after a first one that may be shorter; repeated doc_ids and repeated rows each get their own pieces; of equal
lengths the smaller row number is placed first, of bins with equal space the one left last; an empty table gives an
empty result; other columns are ignored. A sequence's number is its round, partition and bin (full pieces: below zero,
from their row's number), so no two sequences can share one.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_rows, saved, stored, table
from .tokens import byte_bpe, encoder


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing of ``lengths`` (1 to capacity) needs: the best of the sum, of the functions that let small
    items vanish and large ones fill a bin, of the rounding functions u(k), and of those that count by 1/epsilon."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1)
    best = -(-int((count * sizes).sum()) // capacity)
    mass, items = np.cumsum(count * sizes), np.cumsum(count)
    for eps in range(1, capacity // 2 + 1):  # x > C - eps: C, x < eps: 0, else x
        large = int(items[capacity] - items[capacity - eps])
        middle = int(mass[capacity - eps] - mass[eps - 1])
        best = max(best, large + -(-middle // capacity))
    for k in range(1, 21):  # x(k + 1)/C whole: x, else floor(x(k + 1)/C) C/k; scaled by k
        whole = sizes * (k + 1) % capacity == 0
        value = np.where(whole, sizes * k, sizes * (k + 1) // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (capacity * k)))
    for eps in range(1, capacity // 2 + 1, max(1, capacity // 128)):
        q = capacity // eps
        value = np.where(2 * sizes > capacity, 2 * (q - (capacity - sizes) // eps), np.where(2 * sizes == capacity, q, 2 * (sizes // eps)))
        best = max(best, -(-int((count * value).sum()) // (2 * q)))
    return best


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """bin and offset of each item, and the space left in each bin. Bins wait by their free space; a bit mask of the
    spaces at hand finds the tightest that fits."""
    order = sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True)
    bins, offsets, free = [0] * len(lengths), [0] * len(lengths), []
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i in order:
        n = lengths[i]
        fits = mask >> n
        if fits:
            space = n + (fits & -fits).bit_length() - 1
            b = waiting[space].pop()
            if not waiting[space]:
                mask ^= 1 << space
        else:
            b, space = len(free), capacity
            free.append(capacity)
        bins[i], offsets[i] = b, capacity - space
        free[b] = space - n
        if space > n:
            waiting[space - n].append(b)
            mask |= 1 << (space - n)
    return bins, offsets, free


_PLACED = "uid long, length long, part long, bin long, offset long, space long, gap long"


def dealt(items: DataFrame, parts: int, capacity: int, group: int = 1000) -> DataFrame:
    """``items`` with part: dealt like cards in order of length, so that every part gets the same mix of lengths, and
    none is left with large items that lack small ones. Places come from the count of each length (at most ``capacity``
    rows on the driver) and a running number within the length; lengths of over ``group`` items are numbered in salted
    groups of about that size, so no task numbers more."""
    if parts == 1:
        return items.withColumn("part", F.lit(0).cast("long"))
    counts = {r.length: r["count"] for r in items.groupBy("length").count().collect()}
    before, salts, at = [0] * capacity, [1] * capacity, 0
    for n in range(1, capacity + 1):
        before[n - 1], salts[n - 1], at = at, -(-counts.get(n, 1) // group), at + counts.get(n, 0)
    of = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("length").cast("int"))
    salted = items.select("uid", "length", of(before).cast("long").alias("before"), of(salts).cast("long").alias("salts")).withColumn("salt", F.pmod(F.xxhash64("uid"), F.col("salts")))
    nth = F.row_number().over(Window.partitionBy("length", "salt").orderBy("uid")) - 1
    share = F.col("salt") * group  # where a salted group starts, about
    return salted.withColumn("part", F.pmod(F.col("before") + share + nth, F.lit(parts)).cast("long")).select("uid", "length", "part")


def _round(items: DataFrame, parts: int, capacity: int) -> DataFrame:
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "uid"], ascending=[False, True])
        bins, offsets, free = best_fit_decreasing(pdf["length"].tolist(), capacity)
        gap = len(free) - lower_bound(pdf["length"].to_numpy(), capacity)
        return pdf.assign(bin=bins, offset=offsets, space=np.array(free)[bins], gap=gap)[["uid", "length", "part", "bin", "offset", "space", "gap"]]

    return saved(dealt(items.select("uid", "length"), parts, capacity).groupBy("part").applyInPandas(pack, _PLACED))


def pack_lengths(items: DataFrame, capacity: int, part_items: int = 32_768, rounds: int = 6) -> DataFrame:
    """Place items (uid unique, length from 1 to ``capacity``) into bins of ``capacity``: uid, bin_id (long, not below
    zero), offset. ``part_items`` bounds a task's items, whatever the input. A bin's number holds its round (7 bits),
    partition (32) and bin in it (24). An empty table gives an empty result."""
    empty = items.sparkSession.createDataFrame([], "uid long, bin_id long, offset long")
    key = lambda r: (F.shiftleft(F.lit(r).cast("long"), 56) + F.shiftleft("part", 24) + F.col("bin")).alias("bin_id")
    bins = lambda df: df.agg(F.count_distinct("part", "bin"), F.count("*")).first()
    done, pool, held, size = empty, items, None, items.count()
    if not size:
        return empty
    for r in range(rounds):
        placed = _round(pool, -(-size // part_items), capacity)
        if held is not None:
            if bins(placed)[0] >= bins(held[1])[0]:
                break  # the exchange saved no bin: the packing before it stays
        # bins that are full, or lie in certified partitions, are final
        done = done.unionByName(placed.filter((F.col("gap") == 0) | (F.col("space") == 0)).select("uid", key(r), "offset"))
        open_ = placed.filter((F.col("gap") > 0) & (F.col("space") > 0))
        pool, held = open_.select("uid", "length"), (r, open_)
        left, parts = open_.agg(F.count("*"), F.count_distinct("part")).first()
        if not left or parts == 1 and left >= size:
            break
        size = left
    if held is not None:
        done = done.unionByName(held[1].select("uid", key(held[0]), "offset"))
    return done


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """One row a piece: doc_id, row (tells repeated doc_ids apart), piece, start, length, ids_crc32. A null text is empty:
    its one piece is the end id. Only documents of over ``capacity`` ids are cut; then the first piece may be shorter."""

    def make():
        enc = encoder(tokenizer)
        end = np.array([end_id], dtype="<u4")

        def step(keys, rows, texts):
            out: list[list] = [[] for _ in range(6)]
            for d, row, raw in zip(keys, rows, enc.encode([x or "" for x in texts])):
                ids = np.concatenate([np.frombuffer(raw, enc.dtype).astype("<u4"), end])
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids), capacity), len(ids)] if len(ids) > capacity else [0, len(ids)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    for column, value in zip(out, (d, row, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))):
                        column.append(value)
            return out

        return step

    numbered = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    return map_rows(numbered, make, "doc_id long, row long, piece int, start long, length long, ids_crc32 long", ["doc_id", "row", "text"], most=512)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """Sequences of at most ``capacity`` ids: the pieces of ``token_pieces`` with sequence_id and offset. Pieces of full
    length are sequences by themselves; the others go through ``pack_lengths``. Extra columns of ``docs`` are ignored."""
    pieces = stored(token_pieces(docs, tokenizer, end_id, capacity).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    full = pieces.filter(F.col("length") == capacity).select(*columns, (F.lit(-1) - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = pieces.filter(F.col("length") < capacity)
    placed = pack_lengths(part.select("uid", "length"), capacity)
    rest = part.join(placed, "uid").select(*columns, F.col("bin_id").alias("sequence_id"), "offset")
    return full.unionByName(rest)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), byte_bpe())
