"""Vector codes: product codebooks of integers, searched through dictionaries of values.

Components become integers and vectors are cut into parts. To find the nearest entries of a batch of rows, each
dimension's distinct integers form a dictionary, and the squared differences of every one of them to all entries of the
part's codebook are tabulated once. A row's distances to all entries are then the sum, over the dimensions of the part, of
table rows gathered by dictionary code. All of this is in whole numbers, so results are exact and ties are real ties.

A round reads the stored integers once; of every task one row an entry is shuffled (count and sums of its parts), and the
driver sees the codebooks alone: 16 times 64 entries. The rows that share a label are summed as partial sums, and the sums
go back to the rows by broadcast of the hot labels and by a join of all others.

Edge cases: vectors that are null or hold null or non-finite components are dropped, as are vectors of another length
than most of the rest; zero vectors stay. Where the length isn't a multiple of the parts, zeros are added at the end.
Fewer than 64 vectors make a codebook of fewer entries. Repeated ids and rows are coded one by one; the first entries are
taken by id (rows without an id last) and, where ids are equal, by vector. Components of a size whose squares don't fit
a long (beyond some two million for four dimensions a part) count as the largest that do, and sums beyond a long as the
largest long. Rows without a label form one group. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_schema, batch_of, join_skewed, map_rows, rows_in_batches, ship, stored, table

MOST = (1 << 63) - 1


def finite(df: DataFrame) -> DataFrame:
    """``df`` with v (array of double): the rows whose vector has no null or non-finite component, of the length that most have."""
    v = F.col("embedding").cast("array<double>")
    fine = df.withColumn("v", v).filter("v IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))")
    sizes = fine.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return fine.filter(F.size("v") == (sizes[0].n if sizes else 0))


def as_long(total: Column) -> Column:
    """A decimal sum as a long, the largest long if it is beyond that."""
    return F.least(total, F.lit(MOST).cast("decimal(38,0)")).cast("long")


def assign(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties to the lower) and squared distance, of each row and part.
    ``x``: rows, parts, width; ``entries``: parts, entries, width; both whole numbers."""
    rows, parts, width = x.shape
    codes, least = np.empty((rows, parts), np.int64), np.empty((rows, parts), np.int64)
    for p in range(parts):
        distance = np.zeros((rows, entries.shape[1]), np.int64)
        for j in range(width):
            values, at = np.unique(x[:, p, j], return_inverse=True)  # the dictionary of this dimension
            squares = (values[:, None] - entries[p, :, j][None, :]) ** 2
            distance += squares[at]
        codes[:, p] = distance.argmin(1)
        least[:, p] = np.take_along_axis(distance, codes[:, p, None], 1)[:, 0]
    return codes, least


def coded(df: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of the rows of ``df`` (vec_id, embedding, label)."""
    spark = df.sparkSession
    ship(spark)
    fine = finite(df).select("vec_id", "v", F.col("label").cast("string").alias("label"))
    first = fine.select(F.size("v").alias("n")).first()
    if first is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    width = -(-first.n // parts)
    most = isqrt((1 << 62) // width) // 2

    def whole():
        def step(ids, labels, vectors):
            x = np.zeros((len(vectors), parts * width), "<i4")
            x[:, : first.n] = np.clip(np.floor(np.array(vectors) * scale), -min(most, 1 << 30), min(most, 1 << 30))
            return [ids, labels, [row.tobytes() for row in x]]

        return step

    kept = stored(map_rows(fine, whole, "vec_id long, label string, raw binary", ["vec_id", "label", "v"], 4096), "whole-vectors")

    def whole_of(raw: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(raw), "<i4").reshape(len(raw), parts, width).astype(np.int64)

    start = kept.orderBy(F.col("vec_id").asc_nulls_last(), "raw").select("raw").limit(entries).collect()
    books = np.ascontiguousarray(whole_of([r.raw for r in start]).transpose(1, 0, 2))
    ddl = "part int, entry int, n long, sums array<long>"

    def partial(sent):
        def run(batches):
            books = sent.value
            n, sums = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
            for (raw,) in rows_in_batches(batches, ["raw"], 8192):
                x = whole_of(raw)
                codes, _ = assign(x, books)
                for p in range(parts):
                    np.add.at(n[p], codes[:, p], 1)
                    np.add.at(sums[p], codes[:, p], x[:, p])
            p, e = np.nonzero(n)
            yield batch_of(arrow_schema(ddl), [p.astype(np.int32), e.astype(np.int32), n[p, e], sums[p, e].tolist()])

        return run

    for _ in range(rounds):
        found = kept.select("raw").mapInArrow(partial(spark.sparkContext.broadcast(books)), ddl)
        added = [F.sum(F.col("sums")[j].cast("decimal(20,0)")).alias(f"s{j}") for j in range(width)]
        books = books.copy()
        for r in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *added).collect():  # at most parts x entries rows
            books[r.part, r.entry] = [int(r[f"s{j}"]) // r.n for j in range(width)]
    sent, digest = spark.sparkContext.broadcast(books), hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()

    def last():
        def step(ids, labels, raw):
            codes, least = assign(whole_of(raw), sent.value)
            big = least.astype(np.float64).sum(1) >= 2.0**62
            errors = [sum(map(int, row)) if b else int(s) for row, s, b in zip(least, least.sum(1), big)]
            return [ids, labels, ["".join(f"{c:02x}" for c in row) for row in codes.tolist()], [min(e, MOST) for e in errors]]

        return step

    final = stored(map_rows(kept, last, "vec_id long, label string, code string, error long", ["vec_id", "label", "raw"], 8192), "vector-codes")
    final = final.select("vec_id", "code", "error", F.col("label").isNull().alias("none"), F.coalesce("label", F.lit("")).alias("label"))
    groups = final.groupBy("none", "label").agg(as_long(F.sum(F.col("error").cast("decimal(38,0)"))).alias("label_error"), F.count("*").alias("n"))
    return join_skewed(final, groups, ["none", "label"], final.count()).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded(table(spark, sf_dir, "embeddings"))


def _rounds(n: int) -> str:
    """The rounds of assigning and moving, as SQL: books0 is the start, books``n`` the final codebooks."""
    out = ""
    for i in range(n):
        out += f"""
, near{i} AS (SELECT p.r, p.part, min(list_sum(list_transform([0, 1, 2, 3], lambda j: (p.x[j + 1] - b.x[j + 1]) * (p.x[j + 1] - b.x[j + 1]))) * 64 + b.entry) % 64 AS entry FROM parts p JOIN books{i} b USING (part) GROUP BY p.r, p.part)
, books{i + 1} AS (SELECT b.part, b.entry, CASE WHEN m.n IS NULL THEN b.x ELSE m.x END AS x FROM books{i} b LEFT JOIN (
    SELECT part, entry, count(*) AS n, list_transform([sum(x[1]), sum(x[2]), sum(x[3]), sum(x[4])], lambda s: CAST((s - ((s % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)) AS x FROM near{i} JOIN parts USING (r, part) GROUP BY part, entry) m USING (part, entry))"""
    return out


#: For vectors of 64 components.
OP13_SQL = f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)
, parts AS (SELECT r, CAST(k AS BIGINT) AS part, x[4 * k + 1 : 4 * k + 4] AS x FROM kept, range(16) t(k))
, books0 AS (SELECT part, r - 1 AS entry, x FROM parts WHERE r <= 64){_rounds(2)}
, nearest AS (SELECT p.r, p.part, min(list_sum(list_transform([0, 1, 2, 3], lambda j: (p.x[j + 1] - b.x[j + 1]) * (p.x[j + 1] - b.x[j + 1]))) * 64 + b.entry) AS best FROM parts p JOIN books2 b USING (part) GROUP BY p.r, p.part)
, coded AS (SELECT r, string_agg(printf('%02x', CAST(best % 64 AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(best // 64) AS BIGINT) AS error FROM nearest GROUP BY r)
SELECT k.vec_id, o.code, o.error, CAST(sum(o.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM books2) AS codebooks_sha256
FROM coded o JOIN kept k USING (r)
"""
