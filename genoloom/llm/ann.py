"""Nearest neighbours by largest inner product: an inverted-list index with adaptive dimension scans.

Vectors get one more component, so that their lengths are equal and the largest inner product is the least distance.
Lists are k-means cells fitted on a bounded sample, beyond 1024 lists in two levels, the second fitted by Spark within
the cells of the first; every vector is in the index. A query is scanned against the lists nearest to it. Within a
list, vectors and queries are turned by one random rotation and distances are summed over blocks of columns; after each
block a hypothesis test drops the candidates whose partial distance, scaled to all columns, is too far beyond the
query's bound. The bound comes from the query's nearest list, which is scanned first, so the other lists return next to
nothing. Survivors are scored anew on the original vectors in double precision.

Small lists that lie side by side form groups of about ``block_rows`` vectors, and a query travels once to each group in
which it has lists, not once to each list; full groups, and groups that many queries ask, are dealt over blocks.

How many lists to probe is measured: for a sample of queries the exact neighbours are found by brute force over all
vectors, and the number is the least that holds ``aim`` of them.

Vectors travel as bytes and are known by 128 bits of a hash of them. Equal vectors meet as one row that carries its
``k + 1`` smallest ids: by the ties' order no other can be returned. Equal queries are searched once, and what was found
is handed to rows that share a vector where they lie.

Edge cases: vectors that are null, zero, of another length than most, or hold null or non-finite components take no
part, neither as queries nor as candidates, nor do rows without an id; a row repeated as a whole counts once; with fewer
candidates than ``k`` all are returned; ties go to smaller ids; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_schema, batch_of, hashed_share, join_skewed, map_rows, rows_in_batches, saved, ship, stored, table


def usable(df: DataFrame) -> DataFrame:
    """vec_id, v (array of double) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    fine = df.select("vec_id", v.alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf')) AND exists(v, x -> x <> 0)")
    sizes = fine.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return fine.filter(F.size("v") == (sizes[0].n if sizes else 0))


def vectors_of(raw: list[bytes] | pa.ChunkedArray) -> np.ndarray:
    raw = raw if isinstance(raw, list) else raw.to_pylist()
    return np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)


def rotation(d: int, seed: int = 5) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0]


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    r = np.random.default_rng(seed)
    c = x[r.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = (x @ c.T - 0.5 * (c * c).sum(1)).argmax(1)
        n = np.bincount(near, minlength=k)
        order = np.argsort(near, kind="stable")
        at = np.flatnonzero(np.diff(near[order], prepend=-1))
        sums = np.zeros_like(c)
        sums[near[order[at]]] = np.add.reduceat(x[order], at, axis=0)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[r.choice(len(x), k)])
    return c


def lifted(x: np.ndarray, reach: float) -> np.ndarray:
    """One component more, so that all have length ``reach``."""
    return np.hstack([x, np.sqrt(np.maximum(reach * reach - (x * x).sum(1), 0))[:, None]])


def adaptive_scan(queries: np.ndarray, vectors: np.ndarray, k: int, bound: np.ndarray | None = None, block: int = 16, eps: float = 2.1) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, vector) that may be among a query's ``k`` nearest. ``queries`` and ``vectors`` are rotated alike.
    ``bound`` is each query's squared distance to beat. Without it, the ``k`` candidates nearest by the first block are
    measured in full, and the farthest of them is the bound. A candidate is dropped when partial distance * D / d > bound * (1 + eps / sqrt(d))**2."""
    d = vectors.shape[1]
    if len(vectors) <= k and bound is None:
        q, c = np.indices((len(queries), len(vectors)))
        return q.ravel(), c.ravel()
    a, b = queries[:, :block], vectors[:, :block]
    part = np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)
    if bound is None:
        first = np.argpartition(part, k - 1, axis=1)[:, :k]
        bound = ((queries[:, None, :] - vectors[first]) ** 2).sum(2).max(1)
    bound = bound * (1 + 1e-9) + 1e-12  # ties with the bound stay
    q, c = np.nonzero(part * (d / min(block, d)) <= (bound * (1 + eps / np.sqrt(min(block, d))) ** 2)[:, None])
    total = part[q, c]
    for at in range(block, d, block):
        to = min(d, at + block)
        total += ((queries[q, at:to] - vectors[c, at:to]) ** 2).sum(1)
        scale = bound[q] * (1 + eps / np.sqrt(to)) ** 2 if to < d else bound[q]
        stay = total * (d / to) <= scale
        q, c, total = q[stay], c[stay], total[stay]
    return q, c


def best(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best rows of each query: largest score, then smallest id."""
    order = np.lexsort((ids, -score, q))
    q, ids, score = q[order], ids[order], score[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], ids[keep], score[keep]


def fit_centres(distinct: DataFrame, n: int, reach: float, lists: int | None, sample: int, coarse: int = 256, most: int = 65_536, two_levels: int = 1024, a_list: int = 32) -> np.ndarray:
    """Centres of the lists, those side by side in the order of their main axis. ``sample`` bounds the vectors that the
    driver fits on; beyond ``two_levels`` lists it fits ``coarse`` cells alone, and the lists within a cell are fitted
    in a task of its own, on about ``a_list`` vectors a list."""
    lists = min(lists or int(np.sqrt(n)), most)
    fit_on = lifted(vectors_of([r.raw for r in hashed_share(distinct, n, sample, "h1").select("h1", "h2", "raw").orderBy("h1", "h2").collect()]), reach)
    if lists <= two_levels:
        centres = kmeans(fit_on, max(1, min(lists, len(fit_on))))
    else:
        sent, chosen = distinct.sparkSession.sparkContext.broadcast(kmeans(fit_on, min(coarse, len(fit_on)))), min(n, a_list * lists)

        def cell():
            half = 0.5 * (sent.value * sent.value).sum(1)
            return lambda raw: [(lifted(vectors_of(raw), reach) @ sent.value.T - half).argmax(1).tolist(), raw]

        def within(t: pa.Table) -> pa.Table:
            x = lifted(vectors_of(t["raw"]), reach)
            c = kmeans(x, min(len(x), max(1, round(lists * len(x) / chosen))))
            return pa.table({"raw": pa.array([v.tobytes() for v in c.astype("<f8")], pa.binary())})

        part = map_rows(hashed_share(distinct, n, chosen, "h2").select("raw"), cell, "list long, raw binary", ["raw"])
        centres = vectors_of([r.raw for r in part.groupBy("list").applyInArrow(within, "raw binary").collect()])
    mid = centres - centres.mean(0)
    return centres[np.argsort(mid @ np.linalg.svd(mid, full_matrices=False)[2][0], kind="stable")]


def nearest(df: DataFrame, is_query: str, k: int = 20, sample: int = 20_000, lists: int | None = None, aim: float = 0.95, tested: int = 200, block_rows: int = 4096, two_levels: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of ``df`` (vec_id, embedding) where ``is_query`` holds.
    ``sample`` (give or take its root) bounds the vectors that the driver fits on, ``lists`` is their number (else the
    root of the number of distinct vectors, at most 65,536), ``tested`` the queries that the probe count is measured on."""
    spark = df.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    ship(spark)

    def coded():
        def step(ids, asks, vs):
            x = np.array(vs, dtype="<f8")
            return [ids, asks, [v.tobytes() for v in x], np.sqrt((x * x).sum(1))]

        return step

    key = ["h1", "h2"]
    chosen = usable(df).withColumn("asks", F.coalesce(F.expr(is_query), F.lit(False)))
    rows = map_rows(chosen, coded, "vec_id long, asks boolean, raw binary, norm double", ["vec_id", "asks", "v"])
    rows = stored(rows.withColumns({"h1": F.xxhash64("raw"), "h2": F.xxhash64(F.lit(1), "raw")}), "vectors")
    nth = F.dense_rank().over(Window.partitionBy(*key).orderBy("vec_id"))
    ids = rows.select("vec_id", *key).withColumn("nth", nth).filter(F.col("nth") <= k + 1).groupBy(*key).agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    one = rows.groupBy(*key).agg(F.first("raw").alias("raw"), F.max("norm").alias("norm"), F.count_if("asks").alias("n"))
    distinct = stored(one.join(ids, key).withColumn("uid", F.monotonically_increasing_id()), "distinct-vectors")
    n, reach, asking = distinct.agg(F.count("*"), F.max("norm"), F.sum("n")).first()
    if not n or not asking:
        return empty
    asked = distinct.filter("n > 0").select("uid", "raw", *key)

    centres = fit_centres(distinct, n, reach, lists, sample, two_levels=two_levels)
    sent = spark.sparkContext.broadcast(centres)
    few = max(64, (1 << 22) // len(centres))  # rows that are held against all centres at a time

    def assign():
        half = 0.5 * (sent.value * sent.value).sum(1)
        return lambda uids, raw, ids: [uids, (lifted(vectors_of(raw), reach) @ sent.value.T - half).argmax(1).tolist(), raw, ids]

    index = stored(map_rows(distinct, assign, "uid long, list long, raw binary, ids array<long>", ["uid", "raw", "ids"], most=few), "index")

    probe = vectors_of([r.raw for r in asked.orderBy(*key).limit(tested).collect()])
    tests = spark.sparkContext.broadcast(probe)
    best_ddl = "q int, list long, s double"

    def exact(batches):
        qs, top, where = tests.value, None, None
        for lists_, raw in rows_in_batches(batches, ["list", "raw"], 4096):
            s = qs @ vectors_of(raw).T
            at = np.broadcast_to(np.array(lists_), s.shape)
            top, where = (s, at) if top is None else (np.hstack([top, s]), np.hstack([where, at]))
            order = np.argsort(-top, axis=1)[:, :k]
            top, where = np.take_along_axis(top, order, 1), np.take_along_axis(where, order, 1)
        if top is not None:
            yield batch_of(arrow_schema(best_ddl), [np.repeat(np.arange(len(qs), dtype=np.int32), top.shape[1]), where.ravel().astype(np.int64), top.ravel()])

    true = index.select("list", "raw").mapInArrow(exact, best_ddl).withColumn("nth", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s")))).filter(F.col("nth") <= k).collect()

    def to_lists(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
        """Lists of each query, nearest first."""
        return np.argsort(0.5 * (centres * centres).sum(1) - (lifted(x, 0.0) @ centres.T) * (reach / np.linalg.norm(x, axis=1))[:, None], axis=1)

    place = np.argsort(to_lists(probe, centres), axis=1)
    ranks = np.sort([place[r.q, r.list] for r in true])
    probes = int(ranks[min(len(ranks) - 1, int(np.ceil(aim * len(ranks))))]) + 1

    sizes = {r.list: r["count"] for r in index.groupBy("list").count().collect()}  # at most one row a list
    groups, filled = np.zeros(len(centres), np.int64), [0]
    for i in range(len(centres)):
        if filled[-1] and filled[-1] + sizes.get(i, 0) > block_rows:
            filled.append(0)
        groups[i] = len(filled) - 1
        filled[-1] += sizes.get(i, 0)
    sent_groups = spark.sparkContext.broadcast(groups)
    grouped = F.broadcast(spark.createDataFrame([(i, int(g), -(-filled[g] // block_rows) or 1) for i, g in enumerate(groups.tolist())], "list long, g long, parts int"))  # as many rows as lists
    parts = F.broadcast(spark.createDataFrame([(g, -(-m // block_rows) or 1) for g, m in enumerate(filled)], "g long, parts int"))

    def routes(first: bool):
        def make():
            def step(uids, raw, least):
                near, out = to_lists(vectors_of(raw), sent.value)[:, :probes], [[], [], [], [], []]
                for uid, r, bound, own in zip(uids, raw, least, near[:, :1] if first else near[:, 1:]):
                    by: dict[int, list[int]] = {}
                    for i in own.tolist():
                        by.setdefault(int(sent_groups.value[i]), []).append(i)
                    for g, some in by.items():
                        for column, value in zip(out, (uid, r, bound, g, some)):
                            column.append(value)
                return out

            return step

        return make

    def scan(vectors: pa.Table, asks: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if vectors.num_rows and asks.num_rows:
            x, list_of, own = vectors_of(vectors["raw"]), vectors["list"].to_numpy(), vectors["ids"].combine_chunks()
            starts, ids = own.offsets.to_numpy(), own.values.to_numpy()
            y, least, wanted = vectors_of(asks["raw"]), asks["least"].to_numpy(), asks["lists"].combine_chunks()
            asks_of, asked_list = np.repeat(np.arange(len(y)), np.diff(wanted.offsets.to_numpy())), wanted.values.to_numpy()[wanted.offsets[0].as_py() : wanted.offsets[-1].as_py()]
            turn, scale = rotation(x.shape[1] + 1), reach / np.linalg.norm(y, axis=1)
            turned, asking = lifted(x, reach) @ turn, (lifted(y, 0.0) * scale[:, None]) @ turn
            for i in np.unique(list_of).tolist():
                mine, who = np.flatnonzero(list_of == i), asks_of[asked_list == i]
                for at in range(0, len(who), 256):
                    w = who[at : at + 256]
                    known = None if np.isnan(least[w]).any() else 2 * reach * reach - 2 * scale[w] * least[w]
                    q, c = adaptive_scan(asking[w], turned[mine], k + 1, known)
                    q, c = w[q], mine[c]
                    score = (y[q] * x[c]).sum(1)
                    many = starts[c + 1] - starts[c]
                    each = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(starts[c], many)
                    out.append(best(np.repeat(q, many), ids[each], np.repeat(score, many), k + 1))
        q, found, score = best(*(np.concatenate(c) for c in zip(*out)), k + 1)
        return pa.table({"uid": asks["uid"].to_numpy()[q] if len(q) else np.zeros(0, np.int64), "vec_id": found, "score": score})

    def scanned(asked: DataFrame, first: bool) -> DataFrame:
        """The ``k + 1`` best of each query in each group, or those that reach ``least``, where that isn't NaN."""
        routed = stored(map_rows(asked, routes(first), "uid long, raw binary, least double, g long, lists array<long>", ["uid", "raw", "least"], most=min(few, 512)), "routed")
        asking = F.broadcast(routed.groupBy("g").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("times")))  # a row a group, fewer than lists
        deal = lambda m: F.pmod(F.hash("uid"), F.col(m))
        every = lambda m: F.explode(F.sequence(F.lit(0), F.col(m) - 1))
        left = index.join(grouped, "list").join(asking, "g").select("g", deal("parts").alias("i"), every("times").alias("j"), "list", "raw", "ids")
        right = routed.join(parts, "g").join(asking, "g").select("g", deal("times").alias("j"), every("parts").alias("i"), "uid", "raw", "least", "lists")
        return left.groupBy("g", "i", "j").cogroup(right.groupBy("g", "i", "j")).applyInArrow(lambda a, b: scan(a, b), "uid long, vec_id long, score double")

    def tops(found: DataFrame) -> DataFrame:
        """uid, top: a query's ``k + 1`` best of what its groups found, each group at most so many."""
        every = F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id"))
        return found.groupBy("uid").agg(F.slice(F.array_sort(every), 1, k + 1).alias("top"))

    first = saved(tops(scanned(asked.select("uid", "raw", F.lit(float("nan")).alias("least")), True)))
    bound = F.when(F.size("top") > k, -F.element_at("top", -1)["less"]).otherwise(float("-inf"))
    rest = scanned(asked.join(first.select("uid", bound.alias("least")), "uid", "left").select("uid", "raw", F.coalesce("least", F.lit(float("-inf"))).alias("least")), False)
    before = first.select("uid", F.explode("top").alias("x")).select("uid", "x.vec_id", (-F.col("x.less")).alias("score"))
    top = saved(tops(before.unionByName(rest)))
    answers = distinct.filter("n > 0").select("uid", *key, "n").join(top, "uid").drop("uid")
    queries = rows.filter("asks").select(F.col("vec_id").alias("query_id"), *key).distinct()
    others = F.slice(F.filter("top", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return join_skewed(queries, answers, key, asking).select("query_id", F.posexplode(others).alias("at", "x")).select("query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", (-F.col("x.less")).alias("score"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")
