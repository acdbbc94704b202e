"""Whitening of embeddings with distributed block matrices.

Rows become whole numbers, their exact sums per dimension give the mean, and the centred rows are indexed without gaps
and cut into the blocks of a BlockMatrix. Its transpose times itself is the scatter; the blocks' products are made in
many tasks, each over some of the blocks, and added up. The scatter, of dimensions squared, is all that the driver sees:
it is decomposed there, and the BlockMatrix times the whitening matrix projects the rows.

What the driver holds: the matrices of dimensions squared, one count for each file part of the stored rows, and the
coordinates of the blocks (Spark's own multiplication lists them), one for ``block_rows`` rows. The mean is subtracted
before anything is multiplied, so the common offset of the integers costs no digits. Deviations are whole numbers: in
longs where a batch's numbers provably fit, else in numbers of any size.

Edge cases: vectors that are null or hold null or non-finite entries are dropped, as are vectors of another length than
most of the rest; zero vectors stay. Repeated rows and ids are rows of their own; rows without an id are fitted on and
returned. With fewer than ``most`` dimensions there are as many components as dimensions. A direction without variance
can't be whitened: its values are 0 and it is left out of ``identity_error``. Entries of more than 2**55 times the unit
count as that. A deviation beyond the largest long is given as the largest long. Other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .codebooks import MOST, finite
from .common import arrow_schema, batch_of, map_rows, rows_in_batches, ship, stored, table

DDL = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_of(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), "<i8").reshape(len(raw), -1)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """The sum over dimensions of (n * x - sum)**2, of each row, at most the largest long."""
    reach = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if reach < 1 << 62:
        far = n * x - np.array(sums, np.int64)
        if int(np.abs(far).max(initial=0)) ** 2 * x.shape[1] <= MOST:
            return (far * far).sum(1).tolist()
    return [min(MOST, sum((n * a - s) ** 2 for a, s in zip(row, sums))) for row in x.tolist()]


def gram(a: BlockMatrix, blocks: int, each: int) -> np.ndarray:
    """The transpose of ``a`` times ``a``; the blocks' products are made ``each`` blocks a task and then added. Without
    the splits Spark would send all blocks to the one task that holds the result."""
    splits = max(1, -(-blocks // each))
    java = a.transpose()._java_matrix_wrapper.call("multiply", a._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, a.colsPerBlock, a.colsPerBlock).toLocalMatrix().toArray()


def whitened(df: DataFrame, most: int = 32, scale: int = 64, offset: int = 1_000_000, block_rows: int = 4096, each: int = 16) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of the rows of ``df`` (vec_id, embedding)."""
    spark = df.sparkSession
    ship(spark)
    fine = finite(df).select("vec_id", "v")

    def whole():
        def step(ids, vectors):
            x = np.clip(np.floor(np.array(vectors) * scale), -(2.0**55), 2.0**55).astype("<i8") + offset
            return [ids, [row.tobytes() for row in x]]

        return step

    kept = stored(map_rows(fine, whole, "vec_id long, raw binary", ["vec_id", "v"]).withColumn("row", F.monotonically_increasing_id()), "whole-vectors")
    part, place = F.shiftright("row", 33), F.col("row").bitwiseAND((1 << 33) - 1)
    counts = {r.part: r.n for r in kept.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    n = sum(counts.values())
    if not n:
        return spark.createDataFrame([], DDL)
    before, offsets = 0, []
    for p in sorted(counts):
        offsets.append((p, before))
        before += counts[p]

    def added(batches):
        high = low = None  # of 2**30 and below, so that no sum overflows
        for (raw,) in rows_in_batches(batches, ["raw"], 4096):
            x = whole_of(raw)
            a, b = (x >> 30).sum(0), (x & ((1 << 30) - 1)).sum(0)
            high, low = (a, b) if high is None else (high + a, low + b)
        if high is not None:
            yield batch_of(arrow_schema("d int, high long, low long"), [np.arange(len(high), dtype=np.int32), high, low])

    total = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).alias(c)
    by = kept.select("raw").mapInArrow(added, "d int, high long, low long").groupBy("d").agg(total("high"), total("low")).orderBy("d").collect()  # a row a dimension
    sums = [(int(r.high) << 30) + int(r.low) for r in by]
    mean = np.array([s // n + (s % n) / n for s in sums])
    d = len(sums)

    def centred():
        def step(ids, rows, raw):
            x = whole_of(raw)
            base = np.array([s // n for s in sums])
            return [ids, rows, ((x - base) - (mean - base)).tolist(), deviations(x, n, sums)]

        return step

    starts = F.broadcast(spark.createDataFrame(offsets, "part long, start long"))  # a row a part
    placed = kept.select("vec_id", "raw", part.alias("part"), place.alias("place")).join(starts, "part").select("vec_id", "raw", (F.col("start") + F.col("place")).alias("i"))
    rows = map_rows(placed, centred, "vec_id long, i long, v array<double>, deviation long", ["vec_id", "i", "raw"])
    rows = stored(rows, "centred-vectors")
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("i", array_to_vector("v").alias("v")), "v")
    blocks = -(-n // block_rows)
    a = IndexedRowMatrix(vectors, n, d).toBlockMatrix(block_rows, d)
    scatter = gram(a, blocks, each)
    e, directions = np.linalg.eigh((scatter + scatter.T) / (2 * n))
    e, directions = e[::-1][:most], directions[:, ::-1][:, :most]
    live = e > max(e[0], 0) * 1e-12
    share = np.where(live, e, 0) / max(np.trace(scatter) / n, np.finfo(float).tiny)
    by_component = np.where(live, directions / np.sqrt(np.where(live, e, 1)), 0)
    one = spark.sparkContext.parallelize([((0, 0), Matrices.dense(d, len(e), by_component.ravel(order="F").tolist()))], 1)
    projected = a.multiply(BlockMatrix(one, d, len(e)))
    out = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    out = stored(out.select(F.col("index").alias("i"), vector_to_array("vector").alias("w")), "projected")
    out = stored(rows.select("vec_id", "i", "deviation").join(out, "i").select("vec_id", "deviation", "w"), "whitened")

    def moments(centre):
        def run(batches):
            first, second = np.zeros(len(e)), np.zeros((len(e), len(e)))
            for (w,) in rows_in_batches(batches, ["w"], 4096):
                w = np.array(w) - centre
                first, second = first + w.sum(0), second + w.T @ w
            yield batch_of(arrow_schema("j int, k int, s double"), [np.repeat(np.arange(len(e), dtype=np.int32), len(e) + 1), np.tile(np.arange(-1, len(e), dtype=np.int32), len(e)), np.hstack([first[:, None], second]).ravel()])

        sent = out.select("w").mapInArrow(run, "j int, k int, s double").groupBy("j", "k").agg(F.sum("s").alias("s")).collect()  # components squared
        found = np.zeros((len(e), len(e) + 1))
        for r in sent:
            found[r.j, r.k + 1] = r.s
        return found / n

    centre = moments(np.zeros(len(e)))[:, 0]
    error = float(np.abs(moments(centre)[:, 1:] - np.eye(len(e)))[np.ix_(live, live)].max(initial=0))
    shares = F.array(*[F.lit(float(s)) for s in share])
    return out.select("vec_id", "deviation", F.posexplode("w").alias("k", "whitened")).select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.element_at(shares, F.col("k") + 1).alias("explained"), F.lit(error).alias("identity_error"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
