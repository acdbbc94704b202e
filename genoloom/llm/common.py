"""Helpers that the training-data operators share: tables, shared folders, Arrow batches, hash splits."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import folder


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once a session, for those that don't have it installed."""
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    context = spark.sparkContext
    if not getattr(context, "_genoloom_shipped", False):
        at = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="spark-"), "genoloom"), "zip", os.path.dirname(package), os.path.basename(package))
        context.addPyFile(at)
        context._genoloom_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, where tasks also find this package."""
    ship(spark)
    return folder(spark)


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh Parquet folder in the shared folder and read it again: a lineage cut whose columns can be pruned."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_split(doc_id: Column, modulus: int, part: int) -> Column:
    """True where crc32 of the id's text leaves ``part``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus == part


def hashed_share(df: DataFrame, n: int, most: int, *keys: str) -> DataFrame:
    """About ``most`` of the ``n`` rows of ``df``, or all if there are fewer, by a hash of ``keys``: the same rows in every
    run, with no sort and nothing sent to the driver. Rows equal in all keys go together."""
    return df if n <= most else df.filter(F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) < (most << 30) // n)


def join_skewed(left: DataFrame, right: DataFrame, keys: list[str], total: int, most: int = 100_000, parts: int = 500) -> DataFrame:
    """Inner join of ``left`` (of ``total`` rows) with ``right``, one row a key, whose column n counts the key's rows in
    ``left``. Keys with over ``most`` rows and over one ``parts``-th of all, so fewer than ``parts`` keys, are joined by
    broadcast where their rows lie; all others meet in a shuffle, in which none of them is large."""
    hot = F.col("n") > max(most, total // parts)
    if total <= most:
        return left.join(right.drop("n"), keys)
    few = F.broadcast(right.filter(hot).drop("n"))
    rest = left.join(F.broadcast(right.filter(hot).select(*keys)), keys, "left_anti")
    return left.join(few, keys).unionByName(rest.join(right.filter(~hot).drop("n"), keys))


def rows_in_batches(batches: Iterable[pa.RecordBatch], names: list[str], most: int = 1024) -> Iterator[list[list]]:
    """Lists of Python values of the named columns, ``most`` rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            part = batch.slice(at, most)
            yield [part.column(part.schema.get_field_index(n)).to_pylist() for n in names]


def kept_rows(docs: DataFrame, make: Callable[[], Callable[[list[str | None]], list[bool]]], most: int = 1024) -> DataFrame:
    """The rows of ``docs`` whose texts the function that ``make()`` gives in each task says yes to, ``most`` at a time."""

    def run(batches):
        keep = make()
        for batch in batches:
            at_text = batch.schema.get_field_index("text")
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                yield part.filter(pa.array(keep(part.column(at_text).to_pylist()), pa.bool_()))

    ship(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(),
             "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string()), "array<double>": pa.list_(pa.float64()), "array<binary>": pa.list_(pa.binary())}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ddl.split(", "))])


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def map_rows(df: DataFrame, make: Callable[[], Callable[..., list]], ddl: str, names: list[str], most: int = 1024) -> DataFrame:
    """mapInArrow: ``make()`` runs once in each task and returns a function from the named columns' values
    (``most`` rows at a time) to the output columns of ``ddl`` ("name type, name type")."""

    def run(batches):
        step, schema = make(), arrow_schema(ddl)
        for columns in rows_in_batches(batches, names, most):
            out = step(*columns)
            yield batch_of(schema, out)

    ship(df.sparkSession)
    return df.select(*names).mapInArrow(run, ddl)
