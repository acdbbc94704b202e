"""Near-duplicate vectors: an inverted-list index with product-quantised residuals, that loses no link.

Vectors are scaled to length 1, so a cosine of at least ``least`` is a distance of at most ``delta``. Lists are k-means
cells; a vector's residual to its list's centre is cut into subspaces, and each piece becomes the number of its entry in
that subspace's codebook. Centres and codebooks are fitted on a bounded sample; every vector is in the index.

Which lists a vector asks is no matter of luck. If two vectors of different cells are within ``delta``, the plane between
the two centres parts them, so one of the two is within ``delta / 2`` of it: each vector asks its own list and all lists
whose plane is that near, and every link is met. It is counted once, at the list to which the pair's midpoint belongs.
Within a list, distances to the coded vectors are sums of looked-up inner products (one table a query, whatever the list)
and of two stored numbers. Such a distance is wrong by the length of what the code left over, at most, which is stored
with the code, so the candidates that it lets pass hold all links; the exact cosine in double precision decides on them.

Hot groups: where at least ``hot`` vectors of the sample lie within ``delta / 2`` of one of them, that one becomes the
centre of a ball, and all vectors that near to it form its list. Any two of a ball are linked, so their links are counted
without looking at them, however many they are; only vectors outside it and other balls ask its list.
Lists that lie side by side make groups of about ``block_rows`` vectors, full groups are cut, and each such block of the
index is a file in the shared folder, written once, its rows by list. Vectors don't travel to the lists they ask: a task
reads one block and then those that any of its rows ask, one at a time, at first their codes alone, the vectors only where
a code lets something pass. So the pairs of blocks may grow with the square of the vectors, as they do on data without
clusters, but what is shuffled and written grows with the vectors. Of each pair of blocks a spanning forest and one count a
vector are returned, never the pairs.

Equal vectors meet as one row with a weight. Edge cases: vectors that are null, zero, of another length than most, or
hold null or non-finite components link with nothing, but are returned. Every row is a vector of its own: a repeated row
is a copy, linked like any other. Rows without an id take part; where a group's rows all have none its component_id is
null. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import fit_centres, kmeans, vectors_of
from .codebooks import finite
from .common import arrow_schema, batch_of, hashed_share, join_skewed, map_rows, rows_in_batches, shared_dir, ship, stored, table
from .simhash import components

INDEX = "uid long, block long, list long, raw binary, copies long, code binary, left double, constant double"
SLACK = 1e-6  # on the safe side of rounding, in routes and bounds; links themselves are decided exactly


def units(df: DataFrame) -> DataFrame:
    """row, vec_id and raw (the vector scaled to length 1, as bytes) of the rows of ``df`` (row, vec_id, embedding) that can link."""
    fine = finite(df).filter("exists(v, x -> x <> 0)").select("row", "vec_id", "v")

    def scaled():
        def step(rows, ids, vectors):
            x = np.array(vectors, dtype="<f8")
            x /= np.abs(x).max(1)[:, None]
            x /= np.sqrt((x * x).sum(1))[:, None]
            return [rows, ids, [v.tobytes() for v in x]]

        return step

    return map_rows(fine, scaled, "row long, vec_id long, raw binary", ["row", "vec_id", "v"])


def find_balls(x: np.ndarray, cell: np.ndarray, reach: float, hot: int) -> np.ndarray:
    """Centres: rows of ``x`` that have ``hot`` rows of their own cell within ``reach``, fullest first, no row in two balls."""
    out = []
    for i in np.flatnonzero(np.bincount(cell) >= hot).tolist():
        own = x[cell == i]
        while len(own) >= hot:
            n = np.concatenate([(own[at : at + 512] @ own.T >= 1 - reach * reach / 2).sum(1) for at in range(0, len(own), 512)])
            if n.max() < hot:
                break
            out.append(own[n.argmax()])
            own = own[own @ out[-1] < 1 - reach * reach / 2]
    return np.array(out).reshape(-1, x.shape[1])


def quantisers(residuals: np.ndarray, subspaces: int, entries: int) -> np.ndarray:
    """Codebooks: subspaces, entries, width."""
    pieces = residuals.reshape(len(residuals), subspaces, -1)
    return np.stack([kmeans(np.ascontiguousarray(pieces[:, m]), min(entries, len(residuals)), rounds=6) for m in range(subspaces)])


def encode(residuals: np.ndarray, books: np.ndarray) -> np.ndarray:
    pieces = residuals.reshape(len(residuals), books.shape[0], -1)
    return np.stack([(pieces[:, m] @ books[m].T - 0.5 * (books[m] ** 2).sum(1)).argmax(1) for m in range(len(books))], 1).astype(np.uint8)


def decode(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    return np.concatenate([books[m][codes[:, m]] for m in range(len(books))], 1)


def plane_distances(x: np.ndarray, own: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distance of each row to the planes between its own cell's centre and every other centre (0 to its own)."""
    half = 0.5 * (centres * centres).sum(1)
    score = x @ centres.T - half
    apart = np.sqrt(np.maximum(2 * (half[own][:, None] + half[None, :] - centres[own] @ centres.T), 0))
    return np.where(np.arange(len(centres)) == own[:, None], 0.0, (score[np.arange(len(x)), own][:, None] - score) / np.maximum(apart, 1e-300))


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node that each of ``n`` nodes reaches over the links (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def midpoint_side(x: np.ndarray, y: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Above 0 where the pair's midpoint lies on the side of ``low``. Summed component by component, so that every task
    finds the same number for the same pair, whichever of the two asked."""
    s = np.zeros(len(x))
    for j in range(x.shape[1]):
        s += (x[:, j] + y[:, j] - low[:, j] - high[:, j]) * (low[:, j] - high[:, j])
    return s


def linked(distinct: DataFrame, n: int, least: float = 0.9, sample: int = 20_000, lists: int | None = None, subspaces: int = 16, entries: int = 256, hot: int = 32, block_rows: int = 4096) -> tuple[DataFrame, DataFrame]:
    """For the ``n`` rows of ``distinct`` (uid, raw, h1, h2, copies): uid, n_links to rows of other vectors, of those that
    have any; and links a, b (uids) that join all that are linked, directly or by links of links.
    ``sample`` (give or take its root) bounds the vectors that the driver fits on; ``lists`` is their number."""
    spark = distinct.sparkSession
    ship(spark)
    delta = float(np.sqrt(2 - 2 * least))
    lists = lists or 4 * int(np.sqrt(n))
    centres = fit_centres(distinct, n, 1.0, lists, sample)[:, :-1]  # all have length 1, so what is lifted is 0
    fit_on = vectors_of([r.raw for r in hashed_share(distinct, n, sample, "h1").select("raw", "h1", "h2").orderBy("h1", "h2").collect()])
    half = 0.5 * (centres * centres).sum(1)
    own = (fit_on @ centres.T - half).argmax(1)
    balls = find_balls(fit_on, own, delta / 2 - SLACK, hot)
    d, first_ball, every = fit_on.shape[1], len(centres), np.vstack([centres, balls])
    padded = -(-d // subspaces) * subspaces

    def home(x: np.ndarray, centres: np.ndarray, balls: np.ndarray) -> np.ndarray:
        """The list of each row: its ball's, if it is in one, else its cell's."""
        cell = (x @ centres.T - 0.5 * (centres * centres).sum(1)).argmax(1)
        if len(balls):
            near = x @ balls.T
            at = near.argmax(1)
            cell = np.where(near[np.arange(len(x)), at] >= 1 - (delta / 2 - SLACK) ** 2 / 2, len(centres) + at, cell)
        return cell

    def padded_to(x: np.ndarray) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, padded - d)))

    books = quantisers(padded_to(fit_on - every[home(fit_on, centres, balls)])[: sample // 2], subspaces, entries)
    sent = spark.sparkContext.broadcast((centres, balls, every, books))
    few = max(64, (1 << 21) // len(every))

    def at_home():
        def step(uids, raw, copies):
            centres, balls, _, _ = sent.value
            return [uids, home(vectors_of(raw), centres, balls), copies]

        return step

    homes = stored(map_rows(distinct, at_home, "uid long, list long, copies long", ["uid", "raw", "copies"], most=few), "homes")
    sizes = {r.list: r["count"] for r in homes.groupBy("list").count().collect()}  # at most one row a list
    groups, filled = np.zeros(len(every), np.int64), [0]
    for i in range(len(every)):
        if filled[-1] and filled[-1] + sizes.get(i, 0) > block_rows:
            filled.append(0)
        groups[i] = len(filled) - 1
        filled[-1] += sizes.get(i, 0)
    parts = np.maximum(1, -(-np.array(filled) // block_rows))
    blocks, empty = int(parts.sum()), np.array([i not in sizes for i in range(len(every))])
    sent_groups = spark.sparkContext.broadcast((groups, parts, np.cumsum(parts) - parts, empty))

    def assign():
        def step(uids, raw, copies):
            centres, balls, every, books = sent.value
            groups, parts, first, _ = sent_groups.value
            x = vectors_of(raw)
            at = home(x, centres, balls)
            codes = encode(padded_to(x - every[at]), books)
            coded = decode(codes, books)[:, :d]
            left = np.sqrt(((x - every[at] - coded) ** 2).sum(1))
            constant = (coded * coded).sum(1) + 2 * (every[at] * coded).sum(1)  # of the distance to the coded vector
            deal = (np.array(uids, np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % parts[groups[at]]
            return [uids, first[groups[at]] + deal, at, raw, copies, [c.tobytes() for c in codes], left, constant]

        return step

    def asked(x: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The lists that each row asks: rows, lists."""
        centres, balls, every, _ = sent.value
        asks = np.zeros((len(x), len(every)), bool)
        for at in range(0, len(x), few):
            part, of = x[at : at + few], own[at : at + few]
            asks[at : at + few, :first_ball] = (plane_distances(part, np.minimum(of, first_ball - 1), centres) <= delta / 2 + SLACK) & (of < first_ball)[:, None]
            if len(balls):  # a ball's radius is at most delta / 2; of two balls the one of lower number asks
                near = part @ balls.T >= 1 - (1.5 * delta + SLACK) ** 2 / 2
                asks[at : at + few, first_ball:] = near & (np.arange(first_ball, len(every)) > of[:, None])
        return asks & ~sent_groups.value[3]

    index = map_rows(distinct, assign, INDEX, ["uid", "raw", "copies"], most=few)
    dealt = index.repartition(min(blocks, 4 * spark.sparkContext.defaultParallelism + blocks // 16), "block").sortWithinPartitions("block", "list", "uid")
    index_dir, about = f"{shared_dir(spark)}/vector-blocks-{uuid.uuid4().hex}", "block long, g long, path string, asks array<long>"

    def write(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(index_dir)
        store.create_dir(root, recursive=True)
        mark, schema, held = uuid.uuid4().hex, arrow_schema(about), []

        def flush():
            block = pa.Table.from_batches(held).combine_chunks()
            number, lists, groups = block["block"][0].as_py(), block["list"].to_numpy(), sent_groups.value[0]
            path = f"{root}/{number:09d}-{mark}.arrow"
            with store.open_output_stream(path) as out, pa.ipc.new_file(out, block.schema) as file:
                file.write_table(block)
            wants = np.unique(groups[asked(vectors_of(block["raw"]), lists).any(0)])
            return batch_of(schema, [[number], [groups[lists[0]]], [path], [wants.tolist()]])

        for batch in batches:
            numbers = batch.column(1).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for lo, hi in zip(edges, edges[1:]) if len(numbers) else ():
                if held and held[0].column(1)[0].as_py() != numbers[lo]:
                    yield flush()
                    held = []
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield flush()

    manifest = stored(dealt.mapInArrow(write, about), "vector-manifest")
    cores = spark.sparkContext.defaultParallelism
    span = max(1, min(32, blocks * blocks // (8 * cores)))  # blocks that a piece of work meets
    wanted = manifest.select(F.col("path").alias("asks"), F.explode("asks").alias("g"))
    work = wanted.join(manifest.select("g", "block", "path"), "g").groupBy("asks", F.floor(F.col("block") / span).alias("near")).agg(F.collect_list("path").alias("paths"))
    work = stored(work.select("asks", "paths"), "vector-work")
    pieces = work.count()

    def met(y: np.ndarray, own: np.ndarray, y_uid: np.ndarray, asked_copies: np.ndarray, asks: np.ndarray, tables: np.ndarray, vectors: pa.Table, exact: Callable[[], np.ndarray]) -> pa.RecordBatch | None:
        """uid, n, other of the links between the rows of one block, which ask, and those of another or the same."""
        _, _, every, _ = sent.value
        from_, to, mutual, x = [], [], [], None
        list_of, x_uid = vectors["list"].to_numpy(), vectors["uid"].to_numpy()
        codes = np.frombuffer(b"".join(vectors["code"].to_pylist()), np.uint8).reshape(len(list_of), -1)
        over, constant = (delta + vectors["left"].to_numpy()) ** 2, vectors["constant"].to_numpy()
        for i in np.unique(list_of).tolist():
            mine, who = np.flatnonzero(list_of == i), np.flatnonzero(asks[:, i])
            bound = (0.5 * (constant[mine] - over[mine]) - 1e-4).astype(np.float32)
            for at in range(0, len(who), 512):
                w = who[at : at + 512]
                near = np.zeros((len(w), len(mine)), np.float32)
                for m in range(len(tables)):
                    near += tables[m][w][:, codes[mine, m]]
                q, c = np.nonzero(near >= bound + (0.5 * ((y[w] - every[i]) ** 2).sum(1)).astype(np.float32)[:, None])
                if not len(q):
                    continue
                x = exact() if x is None else x
                q, c = w[q], mine[c]
                close = (y[q] * x[c]).sum(1) >= least
                close &= y_uid[q] != x_uid[c]
                q, c = q[close], c[close]
                apart = own[q] != i
                if i < first_ball and apart.any():  # a pair of two cells counts at the list on whose side its midpoint lies
                    low, high = np.minimum(own[q], i), np.maximum(own[q], i)
                    side = midpoint_side(y[q], x[c], every[low], every[high])
                    here = ~apart | np.where(i == low, side > 0, side <= 0)
                    q, c, apart = q[here], c[here], apart[here]
                from_.append(q)
                to.append(c)
                mutual.append(apart)
        if not sum(map(len, from_)):
            return None
        q, c, both = map(np.concatenate, (from_, to, mutual))
        copies = vectors["copies"].to_numpy()
        node, at = np.unique(np.concatenate([y_uid[q], x_uid[c]]), return_inverse=True)
        a, b = at[: len(q)], at[len(q) :]
        count = np.zeros(len(node), np.int64)
        np.add.at(count, a, copies[c])
        np.add.at(count, b[both], asked_copies[q[both]])  # within a list both ask, between lists one does
        label = forest(a, b, len(node))
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(count), pa.array(node[label])], ["uid", "n", "other"])

    def scan(batches):
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(index_dir)
        names = arrow_schema(INDEX).names

        def read(path: str, *columns: str) -> pa.Table:
            with store.open_input_file(path) as file:
                return pa.ipc.open_file(file, options=pa.ipc.IpcReadOptions(included_fields=[names.index(c) for c in columns])).read_all().combine_chunks()

        for path, others in (row for some in rows_in_batches(batches, ["asks", "paths"]) for row in zip(*some)):
            own = read(path, "uid", "list", "raw", "copies")
            y, lists, books = vectors_of(own["raw"]), own["list"].to_numpy(), sent.value[3]
            cut = padded_to(y).reshape(len(y), len(books), -1)
            tables = np.stack([(cut[:, m] @ books[m].T).astype(np.float32) for m in range(len(books))])  # subspaces, queries, entries
            asks = asked(y, lists)
            for other in others:
                found = met(y, lists, own["uid"].to_numpy(), own["copies"].to_numpy(), asks, tables, read(other, "uid", "list", "copies", "code", "left", "constant"), lambda: vectors_of(read(other, "raw")["raw"]))  # noqa: B023
                if found:
                    yield found

    found = stored(work.repartition(max(1, min(pieces, max(4 * cores, pieces // 4)))).mapInArrow(scan, "uid long, n long, other long"), "links")
    in_ball = homes.filter(F.col("list") >= first_ball)
    whole = F.broadcast(in_ball.groupBy("list").agg(F.sum("copies").alias("all"), F.min("uid").alias("other")))  # a row a ball, at most sample / hot
    of_balls = in_ball.join(whole, "list").select("uid", (F.col("all") - F.col("copies")).alias("n"), "other")
    every_link = found.unionByName(of_balls)
    return every_link.groupBy("uid").agg(F.sum("n").alias("n_links")), every_link.filter("uid <> other").select(F.col("uid").alias("a"), F.col("other").alias("b"))


def near_duplicate_vectors(df: DataFrame, least: float = 0.9, **index: int) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``df`` (vec_id, embedding). ``index``: see ``linked``."""
    key = ["h1", "h2"]
    df = stored(df.select("vec_id", "embedding").withColumn("row", F.monotonically_increasing_id()), "embeddings")
    rows = stored(units(df).withColumns({"h1": F.xxhash64("raw"), "h2": F.xxhash64(F.lit(1), "raw")}), "unit-vectors")
    distinct = stored(rows.groupBy(*key).agg(F.first("raw").alias("raw"), F.count("*").alias("copies"), F.min("vec_id").alias("least")).withColumn("uid", F.monotonically_increasing_id()), "distinct-vectors")
    n, total = distinct.agg(F.count("*"), F.coalesce(F.sum("copies"), F.lit(0))).first()
    alone = df.join(rows.select("row"), "row", "left_anti").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if not n:
        return alone.withColumn("kept", F.lit(True))
    counts, edges = linked(distinct.select("uid", "raw", "copies", *key), n, least, **index)
    roots = components(edges).select(F.col("node").alias("uid"), "root")
    named = distinct.join(counts, "uid", "left").join(roots, "uid", "left").select(*key, "least", "copies", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "uid").alias("root"))
    named = stored(named, "named-vectors")
    groups = named.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    named = join_skewed(named, groups, ["root"], n).select(*key, "n_links", "component_id", F.col("copies").alias("n"))
    out = join_skewed(rows.select("vec_id", *key), named, key, total).select("vec_id", "n_links", "component_id")
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


OP11_SQL = """
WITH RECURSIVE fine AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0)
, scaled AS (SELECT vec_id, len(v) AS d, v, sqrt(list_inner_product(v, v)) AS norm FROM fine)
, links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM scaled a JOIN scaled b ON a.vec_id <> b.vec_id AND a.d = b.d WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.9)
, reach AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other)
, component AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN component USING (vec_id) LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
"""
