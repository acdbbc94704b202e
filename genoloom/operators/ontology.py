"""Ontology graph: closure, information content, semantic similarity of phenotypes and genes."""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DataType, DoubleType, IntegerType, LongType, StructField, StructType

from ..shared import ship, written


def _ranges(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of each of ``many`` cells, one range after the other."""
    return np.arange(many.sum()) + np.repeat(first - (np.cumsum(many) - many), many)


def _levels(first: np.ndarray, parents: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """The ``starts`` and all above them, in order, and the steps that carry something up from every node to its parents, in
    an order in which a node has got all from below before it gives: children (by place among the nodes), where each
    parent's children begin, parents."""
    nodes = new = np.unique(starts)
    while len(new):
        new = np.unique(parents[_ranges(first[new], first[new + 1] - first[new])]).astype(np.int64)
        new = new[nodes[np.minimum(np.searchsorted(nodes, new), len(nodes) - 1)] != new]
        nodes = np.sort(np.concatenate([nodes, new]), kind="stable")
    many = first[nodes + 1] - first[nodes]
    up, begin = np.searchsorted(nodes, parents[_ranges(first[nodes], many)]), np.cumsum(many) - many
    waits, steps, done = np.bincount(up, minlength=len(nodes)), [], 0
    ready = np.flatnonzero(waits == 0)
    while len(ready):
        done += len(ready)
        to, child = up[_ranges(begin[ready], many[ready])], np.repeat(ready, many[ready])
        order = np.argsort(to, kind="stable")
        to, child = to[order], child[order]
        cut = np.flatnonzero(np.diff(to, prepend=-1))
        if len(cut):
            steps.append((child, cut, to[cut]))
        waits[to[cut]] -= np.diff(cut, append=len(to))
        ready = to[cut][waits[to[cut]] == 0]
    if done < len(nodes):
        raise ValueError("the ontology has a cycle")
    return nodes, steps


def _above(first: np.ndarray, parents: np.ndarray, starts: np.ndarray, most_bits: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """row, node: the strict ancestors of each of ``starts``, by row and node. Each start is a bit, and the bits are carried
    up through all that lies above any of them; starts far apart, which share little, are taken in smaller groups."""
    nodes, steps = _levels(first, parents, starts)
    if len(nodes) * len(starts) > most_bits and len(starts) > 64:
        half = len(starts) // 2
        (row, node), (more, other) = (_above(first, parents, x, most_bits) for x in (starts[:half], starts[half:]))
        return np.concatenate([row, more + half]), np.concatenate([node, other])
    rows = np.arange(len(starts))
    own, bits = (np.zeros((len(nodes), -(-len(starts) // 64)), np.uint64) for _ in range(2))
    np.bitwise_or.at(own, (np.searchsorted(nodes, starts), rows // 64), np.uint64(1) << (rows % 64).astype(np.uint64))
    for child, cut, to in steps:
        bits[to] |= np.bitwise_or.reduceat(bits[child] | own[child], cut, axis=0)
    seen = np.ascontiguousarray(np.unpackbits(bits.astype("<u8").view(np.uint8), axis=1, bitorder="little")[:, : len(starts)].T)
    row, place = np.divmod(np.flatnonzero(seen.view(bool)), max(1, len(nodes)))
    return row, nodes[place]


class Graph:
    """An ontology's edges (term, parent) as flat arrays that travel to the tasks, 4 bytes an edge and 8 a term, and are
    walked up there. Terms are numbered in their order, so that terms of near numbers, which one task walks from, share most
    of their ancestors where names follow the graph. ``inclusive``: a term is its own ancestor, too."""

    def __init__(self, up: DataFrame, inclusive: bool = False):
        self.spark, self.inclusive, schema = up.sparkSession, inclusive, to_arrow_schema(up.schema)
        ship(self.spark)
        known = up.toArrow()  # at most most_edges rows
        both = pa.chunked_array([*known["term"].chunks, *known["ancestor"].chunks], schema.field(0).type).combine_chunks().dictionary_encode()
        order = pc.sort_indices(both.dictionary).to_numpy()
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(len(order), dtype=np.int32)
        at, self.names = number[both.indices.to_numpy()], both.dictionary.take(pa.array(order))
        child, parent = at[: len(known)], at[len(known) :]
        self.size, self.type = len(order), up.schema["term"].dataType
        self.sent = self.spark.sparkContext.broadcast((np.searchsorted(np.sort(child), np.arange(len(order) + 1)), parent[np.argsort(child, kind="stable")]))
        self.tasks = min(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 4 * self.spark.sparkContext.defaultParallelism)
        self.block = max(64, min(4096, self.size // (4 * self.tasks)))
        self._terms = None

    def terms(self) -> DataFrame:
        """term, _i: the terms and their numbers."""
        if self._terms is None:
            out = StructType([StructField("term", self.type), StructField("_i", LongType())])
            schema, names = to_arrow_schema(out), self.spark.sparkContext.broadcast(self.names)

            def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    yield pa.RecordBatch.from_arrays([names.value.take(batch.column(0)), batch.column(0)], schema=schema)

            self._terms = written(self.spark.range(self.size).mapInArrow(named, out), "terms")
        return self._terms

    def dealt(self, df: DataFrame, *more: str) -> DataFrame:
        """``df`` (_i, ...) by blocks of terms, over a few tasks a core."""
        return df.repartition(self.tasks, F.floor(F.col("_i") / self.block)).sortWithinPartitions("_i", *more)

    def pairs(self) -> DataFrame:
        """term, ancestor."""
        out = StructType([StructField("term", self.type), StructField("ancestor", self.type)])
        schema, sent, inclusive, names = to_arrow_schema(out), self.sent, self.inclusive, self.spark.sparkContext.broadcast(self.names)

        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                every = batch.column(0).to_numpy()
                for lo in range(0, len(every), 1024):
                    starts = every[lo : lo + 1024]
                    row, node = _with_own(*_above(*sent.value, starts), starts, inclusive)
                    yield pa.RecordBatch.from_arrays([names.value.take(pa.array(starts[row])), names.value.take(pa.array(node))], schema=schema)

        return self.dealt(self.spark.range(self.size).withColumnRenamed("id", "_i")).mapInArrow(walk, out)


def _with_own(row: np.ndarray, node: np.ndarray, starts: np.ndarray, inclusive: bool) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of ``_above``, and each start with itself if ``inclusive``; in order of the rows."""
    if not inclusive:
        return row, node
    row, node = np.concatenate([row, np.arange(len(starts))]), np.concatenate([node, starts])
    order = np.argsort(row, kind="stable")
    return row[order], node[order]


def above(edges: DataFrame, hops: int = 4, most_rounds: int = 1000, most_edges: int = 25_000_000) -> Graph | DataFrame:
    """The ancestors of all terms, for the other functions: up to ``most_edges`` edges a ``Graph``, so no pair of a term and an
    ancestor is shuffled or written; of a larger graph the pairs themselves (``joined_closure``)."""
    up = written(edges.select("term", F.col("parent").alias("ancestor")).filter("term <> ancestor").distinct(), "edges")
    return joined_closure(edges, hops, most_rounds) if up.count() > most_edges else Graph(up)


def closure(edges: DataFrame, hops: int = 4, most_rounds: int = 1000, most_edges: int = 25_000_000) -> DataFrame:
    """term, ancestor for all strict ancestors of (term, parent). Loops of a term to itself are ignored; longer cycles end in
    an error. Up to ``most_edges`` edges, as any ontology has, travel to the tasks, which walk up from their terms: no
    shuffle of pairs at all. A larger graph is closed by joins (``joined_closure``)."""
    up = above(edges, hops, most_rounds, most_edges)
    return written(up.pairs(), "closure") if isinstance(up, Graph) else up


def joined_closure(edges: DataFrame, hops: int = 4, most_rounds: int = 1000) -> DataFrame:
    """The closure of a graph of any size. Ancestors within ``hops`` steps are found first; each round then joins only the
    pairs that the last one found at its full reach with those, so the work is in proportion to the pairs, not to the
    pairs of pairs, and the rounds are the longest path's length over ``hops``. What a round finds is written to the
    shared folder and read from there. Cycles end in an error after ``most_rounds``."""
    up = written(edges.select(F.col("term").alias("ancestor"), "parent").filter("ancestor <> parent").distinct(), "edges")
    at = up.select(F.col("ancestor").alias("term"), F.col("parent").alias("ancestor"))
    near = at.withColumn("step", F.lit(1))
    for step in range(2, hops + 1):
        at = at.join(up, "ancestor").select("term", F.col("parent").alias("ancestor")).distinct()
        near = near.unionByName(at.withColumn("step", F.lit(step)))
    found = [written(near, "paths")]
    near = found[0].select(F.col("term").alias("ancestor"), F.col("ancestor").alias("parent"), "step")
    while not (last := found[-1].filter(F.col("step") == hops).select("term", "ancestor")).isEmpty():
        if len(found) > most_rounds:
            raise ValueError("the ontology has a cycle")
        found.append(written(last.join(near, "ancestor").select("term", F.col("parent").alias("ancestor"), "step").distinct(), "paths"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return written(every.select("term", "ancestor").distinct(), "closure")


def _walked_counts(terms: DataFrame, graph: Graph, counts: DataFrame) -> DataFrame:
    """``inclusive_counts`` by walks: a task adds its terms' counts to all that is above them and gives the sums."""
    every = graph.terms().select("_i", "term").join(counts.groupBy("term").agg(F.sum("n").cast("long").alias("n")), "term", "left").select("_i", F.coalesce("n", F.lit(0)).alias("n"))
    sent, size = graph.sent, graph.size

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            at, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            total = np.zeros(size, np.int64) if total is None else total
            for lo in range(0, len(at), 1024):
                row, node = _with_own(*_above(*sent.value, at[lo : lo + 1024]), at[lo : lo + 1024], True)
                np.add.at(total, node, n[lo : lo + 1024][row])
        if total is not None:
            hit = np.flatnonzero(total)
            for lo in range(0, len(hit), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(hit[lo : lo + (1 << 16)]), pa.array(total[hit[lo : lo + (1 << 16)]])], ["_i", "n"])

    sums = graph.dealt(every).mapInArrow(add, "_i long, n long").groupBy("_i").agg(F.sum("n").alias("n"))
    known = graph.terms().join(sums, "_i").select("term", "n")
    lone = counts.groupBy("term").agg(F.sum("n").cast("long").alias("_own"))  # of terms without an edge
    return terms.select("term").join(known, "term", "left").join(lone, "term", "left").select("term", F.coalesce("n", "_own", F.lit(0)).alias("n"))


def inclusive_counts(terms: DataFrame, ancestors: DataFrame | Graph, counts: DataFrame) -> DataFrame:
    """term, n: annotations (term, n) of a term and all its distinct descendants; 0 where there are none."""
    if isinstance(ancestors, Graph):
        return _walked_counts(terms, ancestors, counts)
    own = terms.select("term", F.col("term").alias("below")).union(ancestors.select(F.col("ancestor").alias("term"), F.col("term").alias("below")))
    met = own.join(counts.select(F.col("term").alias("below"), "n"), "below", "left")
    return met.groupBy("term").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def information_content(inclusive: DataFrame, total: Column | int) -> DataFrame:
    """term, ic = -ln(n / total); a term without annotations as if it had one."""
    total = F.lit(total) if isinstance(total, int) else total
    return inclusive.select("term", (-F.log(F.greatest(F.col("n"), F.lit(1)) / total)).alias("ic"))


def resolved(query: DataFrame, terms: DataFrame, replacements: DataFrame) -> DataFrame:
    """Query terms that the ontology has, by their replacement where they have one; others are dropped. Keeps the other columns."""
    r = replacements.select(F.col("term").alias("_old"), F.col("replaced_by").alias("_new"))
    named = query.join(r, query["term"] == r["_old"], "left").withColumn("term", F.coalesce("_new", "term")).drop("_old", "_new")
    return named.join(terms.select("term"), "term", "left_semi").distinct()


def with_self(ancestors: DataFrame | Graph, terms: DataFrame) -> DataFrame | Graph:
    if isinstance(ancestors, Graph):
        out = copy.copy(ancestors)
        out.inclusive = True
        return out
    return ancestors.union(terms.select("term", F.col("term").alias("ancestor")))


def _measure(name: str, a: Column, b: Column, m: Column) -> Column:
    """Similarity of two terms from their information and that of their best shared ancestor."""
    lin = F.when(a + b > 0, 2 * m / (a + b)).otherwise(0.0)
    return {"lin": lin, "resnik": m, "jiang_conrath": 1 - (a + b - 2 * m), "information_coefficient": lin * (1 - 1 / (1 + m))}[name]


def _measured(name: str, a: float | np.ndarray, b: np.ndarray, m: np.ndarray) -> np.ndarray:
    """``_measure`` on arrays."""
    if name in ("lin", "information_coefficient"):
        lin = np.divide(2 * m, a + b, out=np.zeros_like(m), where=a + b > 0)
        return lin if name == "lin" else lin * (1 - 1 / (1 + m))
    return m if name == "resnik" else 1 - (a + b - 2 * m)


def _dealt(df: DataFrame) -> DataFrame:
    """``df`` over as many tasks as a shuffle makes: few bytes, much work, so not to be merged by size."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _least_below(own: DataFrame, informative: DataFrame) -> DataFrame:
    """gene, ancestor, ic_c, least_b: the least information of a gene's terms (gene, term, ic_b) below each ancestor. The
    genes of all terms travel to the tasks as sorted vectors; an ancestor takes the minimum over those of its descendants."""
    table = own.toArrow()
    genes, terms = (table[c].combine_chunks().dictionary_encode() for c in ("gene", "term"))
    order = np.argsort(terms.indices.to_numpy(), kind="stable")
    first = np.searchsorted(terms.indices.to_numpy()[order], np.arange(len(terms.dictionary) + 1))
    sent = own.sparkSession.sparkContext.broadcast((first, genes.indices.to_numpy()[order], table["ic_b"].to_numpy()[order], genes.dictionary, terms.dictionary))
    out = own.select("gene").schema.add(informative.schema["ancestor"]).add("ic_c", "double").add("least_b", "double")
    schema = to_arrow_schema(out)

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, of, ics, genes, names = sent.value
        place, many = {x: i for i, x in enumerate(names.to_pylist())}, np.diff(first)
        tops, infos, found, values, held = [], [], [], [], 0

        def done():
            at, best = np.concatenate([np.zeros(0, np.int64), *found]), np.concatenate([np.zeros(0), *values])
            return pa.RecordBatch.from_arrays([genes.take(pa.array(at)), pa.array(tops, schema.field(1).type), pa.array(infos, pa.float64()), pa.array(best)], schema=schema)

        for batch in batches:
            for ancestor, ic_c, below in zip(*(batch.column(i).to_pylist() for i in range(3))):
                lines = np.array([place[t] for t in below if t in place], np.int64)
                n = many[lines]
                cells = np.arange(n.sum()) + np.repeat(first[lines] - (np.cumsum(n) - n), n)
                best = np.full(len(genes), np.inf)
                np.minimum.at(best, of[cells], ics[cells])
                hit = np.flatnonzero(best < np.inf)
                tops += [ancestor] * len(hit)
                infos += [ic_c] * len(hit)
                found.append(hit)
                values.append(best[hit])
                held += len(hit)
                if held > 1 << 18:
                    yield done()
                    tops, infos, found, values, held = [], [], [], [], 0
        yield done()

    return _dealt(informative.groupBy("ancestor", "ic_c").agg(F.collect_list("term").alias("below"))).mapInArrow(least, out)


def _walked_match(query: DataFrame, gene_terms: DataFrame, graph: Graph, ic: DataFrame, measure: str) -> tuple[DataFrame, pa.Array]:
    """``best_match`` by walks, as a row a term: term, _g (numbers of genes), _best; and the names of the genes. A block of near terms gives the least information of each gene below each ancestor of theirs,
    as one row of vectors an ancestor; rows of an ancestor from several blocks are merged. A block of query terms then gets
    the vectors of its ancestors, those of few, and takes the maxima. What travels grows with the terms and their genes,
    not with the pairs of terms and ancestors."""
    spark, jc, sent, inclusive = graph.spark, measure == "jiang_conrath", graph.sent, graph.inclusive
    numbered = graph.terms().join(ic.select("term", "ic"), "term")
    own = written(gene_terms.select("gene", "term").distinct().join(numbered, "term").select("gene", "_i", "ic"), "gene-terms")
    if jc:
        of = own.groupBy("gene").agg(F.min("ic").alias("b")).orderBy("gene").toArrow()  # a row a gene
    else:
        of = own.select("gene").distinct().orderBy("gene").toArrow()
    names = of["gene"].combine_chunks()
    many = max(1, len(names))
    gene_type = gene_terms.schema["gene"].dataType
    genes = spark.createDataFrame([(x, i) for i, x in enumerate(names.to_pylist())], StructType([StructField("gene", gene_type), StructField("_g", IntegerType())]))
    listed = own.join(F.broadcast(genes), "gene").groupBy("_i", "ic").agg(F.collect_list("_g").alias("_genes"))
    vectors = StructType([StructField("_i", LongType()), StructField("_genes", ArrayType(IntegerType())), StructField("_least", ArrayType(DoubleType()))])
    flat = to_arrow_schema(vectors)

    def rows_of(node: np.ndarray, gene: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        """One row a node, of cells in order of the nodes."""
        first = np.flatnonzero(np.diff(node, prepend=-1))
        offsets = pa.array(np.append(first, len(node)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)).cast(flat.field(i).type) for i, x in ((1, gene.astype(np.int32)), (2, value))]
        return pa.RecordBatch.from_arrays([pa.array(node[first].astype(np.int64)), *lists], schema=flat)

    def least_of(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((value, key))
        key, value = key[order], value[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        return key[first], value[first]

    def cells_of(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lists = batch.column(column)
        offsets = lists.offsets.to_numpy()
        return offsets[:-1] - offsets[0], np.diff(offsets), lists.flatten().to_numpy(zero_copy_only=False)

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, values = batch.column("_i").to_numpy(), batch.column("ic").to_numpy()
            first, of, every = cells_of(batch, "_genes")
            tops, steps = _levels(*sent.value, starts)
            if len(tops) * many <= 1 << 23:  # carried up, a vector of all genes a node
                own, below = (np.full((len(tops), many), np.inf) for _ in range(2))
                at = np.searchsorted(tops, starts)
                own[np.repeat(at, of), every] = np.repeat(values, of)
                for child, cut, to in steps:
                    below[to] = np.minimum(below[to], np.minimum.reduceat(np.minimum(below[child], own[child]), cut, axis=0))
                dense = (np.minimum(below, own) if inclusive else below).ravel()
                key = np.flatnonzero(dense < np.inf)
                value = dense[key]
            else:
                row, node = _with_own(*_above(*sent.value, starts), starts, inclusive)
                tops, place = np.unique(node, return_inverse=True)
                keys, found = [np.zeros(0, np.int64)], [np.zeros(0)]
                step = max(1, (1 << 20) * max(1, len(row)) // max(1, of[row].sum()))
                for lo in range(0, len(row), step):
                    r, p = row[lo : lo + step], place[lo : lo + step]
                    key, value = least_of(np.repeat(p * many, of[r]) + every[_ranges(first[r], of[r])], np.repeat(values[r], of[r]))
                    keys.append(key), found.append(value)
                key, value = least_of(np.concatenate(keys), np.concatenate(found))
            if len(key):
                yield rows_of(tops[key // many], key % many, value)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # an ancestor that goes over the border of two batches has two rows: no harm to a maximum
            _, of, every = cells_of(batch, "_genes")
            key, value = least_of(np.repeat(batch.column("_i").to_numpy(), of) * many + every, cells_of(batch, "_least")[2])
            if len(key):
                yield rows_of(key // many, key % many, value)

    info = numbered.select("_i", "ic") if jc else numbered.select("_i", "ic").filter("ic > 0")
    held = graph.dealt(graph.dealt(listed).mapInArrow(least, vectors)).mapInArrow(merge, vectors).join(info, "_i")
    asked = query.select("term").distinct().join(numbered, "term").select("term", "_i", "ic")
    block = graph.block

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = batch.column(0).to_numpy()
            for own in np.split(starts, np.flatnonzero(np.diff(starts // block)) + 1) if len(starts) else ():
                nodes, steps = _levels(*sent.value, own)
                nodes = nodes if inclusive else nodes[np.unique(np.concatenate([np.zeros(0, np.int64), *(to for _, _, to in steps)]))]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(nodes), own[0] // block)), pa.array(nodes)], ["_block", "_i"])

    wanted = graph.dealt(asked.select("_i")).mapInArrow(needed, "_block long, _i long").distinct()
    text = asked.schema["term"].dataType
    given = wanted.join(held, "_i").select("_block", F.lit(False).alias("_asked"), "_i", "ic", "_genes", "_least", F.lit(None).cast(text).alias("term"))
    asks = asked.select(F.floor(F.col("_i") / block).alias("_block"), F.lit(True).alias("_asked"), "_i", "ic", F.lit(None).cast("array<int>").alias("_genes"), F.lit(None).cast("array<double>").alias("_least"), "term")
    streams = given.unionByName(asks).repartition(graph.tasks, "_block").sortWithinPartitions("_block", "_asked", "_i")
    out = StructType([StructField("term", text), StructField("_g", ArrayType(IntegerType())), StructField("_best", ArrayType(DoubleType()))])
    schema, tail = to_arrow_schema(out), spark.sparkContext.broadcast(of["b"].to_numpy() if jc else None)

    def best_of(best: np.ndarray, row: np.ndarray, place: np.ndarray, a: np.ndarray, full: np.ndarray, least: np.ndarray, ic_c: np.ndarray, there: np.ndarray) -> None:
        """Raise ``best`` (rows, genes) to the measure of all pairs (row, place). A row meets its ancestors from the one that
        can give most, which is the measure of the gene of least information there, until none left can raise any gene."""
        most = _measured(measure, a[row], least[place], ic_c[place])
        order = np.lexsort((-most, row))
        place, most = place[order], most[order]
        n = np.bincount(row, minlength=len(a))
        at, end = np.cumsum(n) - n, np.cumsum(n)
        live = np.flatnonzero(n)
        while len(live):
            c = place[at[live]]
            value = _measured(measure, np.repeat(a[live], many), full[c].ravel(), np.repeat(ic_c[c], many)).reshape(-1, many)
            now = np.maximum(best[live], np.where(full[c] < np.inf, value, -np.inf))
            best[live] = now
            at[live] += 1
            more = at[live] < end[live]
            live, now = live[more], now[more]
            live = live[now[:, there].min(1) < most[at[live]]]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none, full = tail.value, None
        at, parts, known = None, [], None
        for batch in batches:
            blocks, asked = batch.column("_block").to_numpy(), batch.column("_asked").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(asked.astype(np.int8)) != 0)) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(blocks)]):
                piece = batch.slice(lo, hi - lo)
                if blocks[lo] != at:
                    at, parts, known = blocks[lo], [], None
                if not asked[lo]:
                    parts.append((piece.column("_i").to_numpy(), piece.column("ic").to_numpy(), cells_of(piece, "_genes")[1], cells_of(piece, "_genes")[2], cells_of(piece, "_least")[2]))
                    continue
                if known is None:
                    column = lambda i: np.concatenate([x[i] for x in parts]) if parts else np.zeros(0, np.int64)  # noqa: B023, E731
                    node, ic_c, of, gene, least_b = (column(i) for i in range(5))
                    tops = np.unique(node)
                    cells = np.concatenate([[0], np.cumsum(of)]).astype(np.int64)
                    first = cells[np.searchsorted(node, np.append(tops, node[-1] + 1 if len(node) else 0))]
                    known = tops, first[:-1], np.diff(first), gene, least_b, np.repeat(ic_c, of)
                    full = None
                    if 4 * len(gene) >= len(tops) * many and len(tops) * many <= 1 << 23:  # most genes lie below most nodes
                        full = np.full((len(tops), many), np.inf)
                        np.minimum.at(full, (np.repeat(np.arange(len(tops)), known[2]), gene), least_b)  # an ancestor may have two rows
                        full = full, full.min(1), known[5][known[1]], (full < np.inf).any(0)
                tops, first, of, gene, least_b, ic_c = known
                starts, a = piece.column("_i").to_numpy(), piece.column("ic").to_numpy()
                step = max(1, min(128, (1 << 22) // many)) if full is None else max(1, min(4096, (1 << 20) // many))
                for k in range(0, len(starts), step):
                    mine = starts[k : k + step]
                    best = np.full(len(mine) * many, -np.inf)
                    if none is not None:
                        best[:] = _measured(measure, np.repeat(a[k : k + step], many), np.tile(none, len(mine)), np.zeros(len(mine) * many))
                    row, node = _with_own(*_above(*sent.value, mine), mine, inclusive)
                    if len(tops):
                        place = np.minimum(np.searchsorted(tops, node), len(tops) - 1)
                        has = tops[place] == node
                        row, place = row[has], place[has]
                        if full is not None:
                            best_of(best.reshape(-1, many), row, place, a[k : k + step], *full)
                        else:
                            n = of[place]
                            cell, line = _ranges(first[place], n), np.repeat(row, n)
                            np.maximum.at(best, line * many + gene[cell], _measured(measure, a[k : k + step][line], least_b[cell], ic_c[cell]))
                    hit = np.flatnonzero(best > -np.inf)
                    if len(hit):
                        line = hit // many
                        cut = np.flatnonzero(np.diff(line, prepend=-1))
                        lists = [pa.ListArray.from_arrays(pa.array(np.append(cut, len(hit)).astype(np.int32)), pa.array(x)).cast(schema.field(i).type) for i, x in ((1, (hit % many).astype(np.int32)), (2, best[hit]))]
                        yield pa.RecordBatch.from_arrays([piece.column("term").take(pa.array(k + line[cut])), *lists], schema=schema)

    return streams.mapInArrow(look_up, out), names


def _cells(found: DataFrame, names: pa.Array, gene_type: DataType) -> DataFrame:
    """term, gene, best of rows (term, _g, _best)."""
    out = StructType([found.schema["term"], StructField("gene", gene_type), StructField("best", DoubleType())])
    schema, sent = to_arrow_schema(out), found.sparkSession.sparkContext.broadcast(names)

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                terms, genes, best = (batch.column(i).slice(lo, 256) for i in range(3))
                rows = np.repeat(np.arange(len(terms)), np.diff(genes.offsets.to_numpy()))
                yield pa.RecordBatch.from_arrays([terms.take(pa.array(rows)), sent.value.take(genes.flatten()), best.flatten()], schema=schema)

    return found.mapInArrow(flat, out)


def best_match(query: DataFrame, gene_terms: DataFrame, ancestors: DataFrame | Graph, ic: DataFrame, measure: str = "lin", most_pairs: int = 4_000_000) -> DataFrame:
    """term, gene, best: for each distinct query term and gene, the largest similarity to any of the gene's terms.

    Every measure grows with the shared ancestor's information and falls with the gene term's, so the maximum over the
    gene's terms b is the one over shared ancestors c of measure(ic(a), least ic of the gene's terms below c, ic(c)):
    one minimum to (gene, ancestor, least ic), then one maximum; no pairs of terms are formed.

    Ancestors that many genes share, the root's kin, are heavy: joined as rows each would meet every query term with every
    gene. The genes of the heaviest ones, up to ``most_pairs`` pairs (a genome's all, so usually of all ancestors), travel
    to the tasks once as sorted vectors, and a task takes the maximum over a query term's ancestors by array operations.
    The light rest, whose ancestors are of few genes each, meets in a join. Where ancestors of no information can't raise
    a maximum above the 0 that a missing pair means, they are left out. A term that shares no ancestor with a gene has no
    row; by jiang_conrath it counts as sharing one of no information, as in ``node_similarity``."""
    if isinstance(ancestors, Graph):
        found, names = _walked_match(query, gene_terms, ancestors, ic, measure)
        return _cells(found, names, gene_terms.schema["gene"].dataType)
    spark, jc = query.sparkSession, measure == "jiang_conrath"
    ship(spark)
    ic_of = lambda key, name: ic.select(F.col("term").alias(key), F.col("ic").alias(name))
    informative = ancestors.join(ic_of("ancestor", "ic_c"), "ancestor")
    informative = informative if jc else informative.filter("ic_c > 0")
    own = gene_terms.select("gene", "term").distinct().join(ic_of("term", "ic_b"), "term")
    own = written(own, "gene-terms")
    if own.count() > most_pairs:
        gene = own.join(informative, "term").groupBy("gene", "ancestor", "ic_c").agg(F.min("ic_b").alias("least_b"))
    else:
        gene = _least_below(own, informative)
    gene = written(gene, "gene-ancestors")
    degree = gene.groupBy("ancestor").agg(F.count("*").alias("n"))
    left, least_degree = most_pairs, 1
    for r in degree.groupBy("n").agg(F.count("*").alias("times")).orderBy(F.desc("n")).collect():  # a row a distinct degree
        left -= r.n * r.times
        if left < 0:
            least_degree = r.n + 1
            break
    heavy = degree.filter(F.col("n") >= least_degree)
    held = (gene if left >= 0 else gene.join(heavy, "ancestor", "left_semi")).toArrow()  # at most most_pairs rows
    none = own.groupBy("gene").agg(F.min("ic_b").alias("b")).toArrow() if jc else None  # a row a gene
    genes = pa.chunked_array([*held["gene"].chunks, *(none["gene"].chunks if jc else [])], held.schema.field("gene").type).combine_chunks().dictionary_encode()
    above = held["ancestor"].combine_chunks().dictionary_encode()
    order = np.lexsort((genes.indices.to_numpy()[: len(held)], above.indices.to_numpy()))
    first = np.searchsorted(above.indices.to_numpy()[order], np.arange(len(above.dictionary) + 1))
    column = lambda name: held[name].to_numpy()[order]
    sent = spark.sparkContext.broadcast((first, genes.indices.to_numpy()[: len(held)][order], column("least_b"), column("ic_c"), genes.dictionary, above.dictionary,
                                         (genes.indices.to_numpy()[len(held) :], none["b"].to_numpy()) if jc else None))
    asked = query.select("term").distinct().join(ic_of("term", "ic_a"), "term")
    met = asked.join(ancestors, "term", "left" if jc else "inner").groupBy("term", "ic_a").agg(F.collect_list("ancestor").alias("above"))
    out = query.select("term").schema.add("gene", gene_terms.schema["gene"].dataType).add("best", "double")
    schema = to_arrow_schema(out)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, of, least, info, genes, names, none = sent.value
        place = {x: i for i, x in enumerate(names.to_pylist())}
        many = np.diff(first)
        terms, found, values, held = [], [], [], 0

        def done():
            at = np.concatenate([np.zeros(0, np.int64), *found])
            return pa.RecordBatch.from_arrays([pa.array(terms, schema.field(0).type), genes.take(pa.array(at)), pa.array(np.concatenate([np.zeros(0), *values]))], schema=schema)

        for batch in batches:
            for term, a, above in zip(*(batch.column(i).to_pylist() for i in range(3))):
                best = np.full(len(genes), -np.inf)
                if none:
                    best[none[0]] = _measured(measure, a, none[1], np.zeros(len(none[1])))
                lines = np.array([place[c] for c in above if c in place], np.int64)
                n = many[lines]
                cells = np.arange(n.sum()) + np.repeat(first[lines] - (np.cumsum(n) - n), n)  # those of all its ancestors
                np.maximum.at(best, of[cells], _measured(measure, a, least[cells], info[cells]))
                hit = np.flatnonzero(best > -np.inf)
                terms += [term] * len(hit)
                found.append(hit)
                values.append(best[hit])
                held += len(hit)
                if held > 1 << 18:
                    yield done()
                    terms, found, values, held = [], [], [], 0
        yield done()

    whole = _dealt(met).mapInArrow(look_up, out)
    if left >= 0:
        return whole
    rare = asked.join(ancestors, "term").join(gene.join(heavy, "ancestor", "left_anti"), "ancestor").select("term", "gene", _measure(measure, F.col("ic_a"), F.col("least_b"), F.col("ic_c")).alias("best"))
    return whole.unionByName(rare).groupBy("term", "gene").agg(F.max("best").alias("best"))


def similarity(query: DataFrame, gene_terms: DataFrame, ancestors: DataFrame | Graph, ic: DataFrame, measure: str = "lin", key: str = "sample_id", bins: int = 4096, most_cells: int = 1_000_000) -> DataFrame:
    """key, gene, similarity: the median over a query's terms of their best match among the gene's (asymmetric); terms
    without a match count as 0. Genes that match no query term at all are left out: their similarity is 0.

    The median is exact, and values aren't gathered for it: matches are counted in bins of 1 / ``bins``, and only those in
    the bins of the one or two middle ranks are looked at one by one, equal ones as one row. Walks of a graph give a row a
    term, of all its genes, to which the keys that ask it are joined; up to ``most_cells`` pairs of a key and a gene, a task
    counts them by array operations, so no match is a row of its own."""
    terms = written(query.select(key, "term").distinct().join(ic.select("term"), "term", "left_semi"), "query")
    sizes = terms.groupBy(key).agg(F.count("*").alias("_n"))
    if not isinstance(ancestors, Graph):
        return _joined_median(terms, sizes, best_match(terms, gene_terms, ancestors, ic, measure), key, bins)
    found, names = _walked_match(terms, gene_terms, ancestors, ic, measure)
    sizes = written(sizes.filter(F.col(key).isNotNull()), "sizes")
    if sizes.count() * max(1, len(names)) > most_cells:
        return _joined_median(terms, sizes, _cells(found, names, gene_terms.schema["gene"].dataType), key, bins)
    return _counted_median(terms, sizes, found, names, gene_terms.schema["gene"].dataType, key, bins)


def _joined_median(terms: DataFrame, sizes: DataFrame, best: DataFrame, key: str, bins: int) -> DataFrame:
    """``similarity`` from term, gene, best, a row a match."""
    best = written(best, "best")
    met = terms.join(best, "term").select(key, "gene", "best", F.floor(F.col("best") * bins).alias("_bin"))
    counts = written(met.groupBy(key, "gene", "_bin").agg(F.count("*").alias("_m")), "bins")
    return _median(counts, sizes, key, "gene", lambda middle: met.join(middle.select(key, "gene", "_bin"), [key, "gene", "_bin"]).groupBy(key, "gene", "_bin", "best").agg(F.count("*").alias("_m")))


def _counted_median(terms: DataFrame, sizes: DataFrame, found: DataFrame, names: pa.Array, gene_type: DataType, key: str, bins: int) -> DataFrame:
    """``similarity`` from a row a term (term, _g, _best); keys and genes are numbered, and a task counts."""
    spark, many = terms.sparkSession, max(1, len(names))
    keys = [r[0] for r in sizes.select(key).orderBy(key).collect()]
    of = lambda name, kind, values, number: F.broadcast(spark.createDataFrame([(x, i) for i, x in enumerate(values)], StructType([StructField(name, kind), StructField(number, IntegerType())])))
    key_of, gene_of = of(key, terms.schema[key].dataType, keys, "_k"), of("gene", gene_type, names.to_pylist(), "_g")
    asked = terms.join(key_of, key).groupBy("term").agg(F.collect_list("_k").alias("_keys"))
    lines = written(found.join(asked, "term").select("_keys", "_g", "_best"), "matches")

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The number of key and gene, and the value, of about a million matches at a time."""
        for batch in batches:
            (keys, n_keys), (genes, n), (best, _) = ((c.flatten().to_numpy(), np.diff(c.offsets.to_numpy())) for c in batch.columns)
            row = np.repeat(np.arange(len(n)), n_keys)
            first, up_to = (np.cumsum(n) - n)[row], np.cumsum(n[row])
            cuts = np.unique(np.searchsorted(up_to, np.arange(0, up_to[-1] if len(up_to) else 0, 1 << 20), "right"))
            for lo, hi in zip(cuts, [*cuts[1:], len(row)]):
                at = _ranges(first[lo:hi], n[row[lo:hi]])
                yield np.repeat(keys[lo:hi].astype(np.int64) * many, n[row[lo:hi]]) + genes[at], best[at]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, low, wide = np.zeros(0, np.int64), 0, 0  # counts by cell and bin, from bin ``low`` on, ``wide`` bins a cell

        def told(cell: np.ndarray, place: np.ndarray, m: np.ndarray) -> Iterator[pa.RecordBatch]:
            for lo in range(0, len(m), 1 << 16):
                k, g = np.divmod(cell[lo : lo + (1 << 16)], many)
                yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(g.astype(np.int32)), pa.array(place[lo : lo + (1 << 16)]), pa.array(m[lo : lo + (1 << 16)])], ["_k", "_g", "_bin", "_m"])

        def kept() -> Iterator[pa.RecordBatch]:
            hit = np.flatnonzero(held)
            return told(hit // max(1, wide), hit % max(1, wide) + low, held[hit])

        for cell, best in cells(batches):
            place = np.floor(best * bins).astype(np.int64)
            least, most = int(place.min()), int(place.max())
            if least < low or most >= low + wide:
                yield from kept()
                low, wide = (min(least, low), max(most + 1, low + wide) - min(least, low)) if wide else (min(0, least), max(most + 1, bins + 1) - min(0, least))
                fits = len(keys) * many * wide <= 1 << 23
                held = np.zeros(len(keys) * many * wide if fits else 0, np.int64)
            if len(held):
                held += np.bincount(cell * wide + (place - low), minlength=len(held))
            else:
                code, m = np.unique(cell * wide + (place - low), return_counts=True)
                yield from told(code // wide, code % wide + low, m)
        yield from kept()

    counts = written(lines.mapInArrow(count, "_k int, _g int, _bin long, _m long").groupBy("_k", "_g", "_bin").agg(F.sum("_m").alias("_m")), "bins")

    def near(middle: DataFrame) -> DataFrame:
        table = middle.groupBy("_k", "_g").agg(F.min("_bin").alias("low"), F.max("_bin").alias("high")).toArrow()  # a row a key and gene, at most most_cells
        bounds = np.full((2, len(keys) * many), np.iinfo(np.int64).min)
        bounds[:, table["_k"].to_numpy().astype(np.int64) * many + table["_g"].to_numpy()] = table["low"].to_numpy(), table["high"].to_numpy()
        sent = spark.sparkContext.broadcast(bounds)

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for cell, best in cells(batches):
                place = np.floor(best * bins).astype(np.int64)
                hit = np.flatnonzero((place == sent.value[0][cell]) | (place == sent.value[1][cell]))
                order = hit[np.lexsort((best[hit], cell[hit]))]
                first = np.flatnonzero((np.diff(cell[order], prepend=-1) != 0) | (np.diff(best[order], prepend=np.nan) != 0))
                k, g = np.divmod(cell[order[first]], many)
                yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(g.astype(np.int32)), pa.array(place[order[first]]), pa.array(best[order[first]]), pa.array(np.diff(first, append=len(order)))], ["_k", "_g", "_bin", "best", "_m"])

        return lines.mapInArrow(pick, "_k int, _g int, _bin long, best double, _m long").groupBy("_k", "_g", "_bin", "best").agg(F.sum("_m").alias("_m"))

    return _median(counts, sizes.join(key_of, key).drop(key), "_k", "_g", near).join(key_of, "_k").join(gene_of, "_g").select(key, "gene", "similarity")


def _median(counts: DataFrame, sizes: DataFrame, key: str, gene: str, values_in: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """key, gene, similarity from counts of matches by bin (key, gene, _bin, _m), the number of terms a key (key, _n), and a
    function that gives the values (key, gene, _bin, best, _m) in given bins (key, gene, _bin)."""
    missing = written(counts.groupBy(key, gene).agg(F.sum("_m").alias("_m")).join(sizes, key).select(key, gene, "_n", (F.col("_n") - F.col("_m")).alias("_m")), "missing").filter("_m > 0")
    zero = F.lit(0).cast("long").alias("_bin")
    every = counts.unionByName(missing.select(key, gene, zero, "_m")).groupBy(key, gene, "_bin").agg(F.sum("_m").alias("_m")).join(sizes, key)
    up_to = lambda order: F.sum("_m").over(Window.partitionBy(key, gene).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    low, high = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    holds = lambda rank: (F.col("_to") - F.col("_m") < rank) & (F.col("_to") >= rank)
    middle = every.withColumn("_to", up_to("_bin")).filter(holds(low) | holds(high)).select(key, gene, "_bin", "_n", (F.col("_to") - F.col("_m")).alias("_before"))
    middle = written(middle, "middle")
    values = values_in(middle).join(middle, [key, gene, "_bin"]).select(key, gene, "best", "_m", "_n", "_before")
    zeros = missing.drop("_n").withColumn("_bin", zero).join(middle, [key, gene, "_bin"]).select(key, gene, F.lit(0.0).alias("best"), "_m", "_n", "_before")
    least = F.min("_before").over(Window.partitionBy(key, gene))
    # the bins of both ranks may lie apart, but what is between them holds no value
    at = values.unionByName(zeros).withColumn("_to", least + up_to("best"))
    of = lambda rank: F.max(F.when(holds(rank), F.col("best")))
    return at.groupBy(key, gene).agg(((of(low) + of(high)) / 2).alias("similarity"))


def shared_information(pairs: DataFrame, ancestors: DataFrame | Graph, ic: DataFrame) -> DataFrame:
    """a, b, ia, ib, m of pairs (a, b) whose terms have information: their own and that of their most informative strict
    shared ancestor, 0 where they share none."""
    p = pairs.select("a", "b").distinct()
    of = lambda key, c: ic.select(F.col("term").alias(key), F.col("ic").alias(c))
    if not isinstance(ancestors, Graph):
        up = lambda key, c: ancestors.select(F.col("term").alias(key), F.col("ancestor").alias(c))
        shared = p.join(up("a", "c"), "a").join(up("b", "c"), ["b", "c"]).join(ic.select(F.col("term").alias("c"), "ic"), "c").groupBy("a", "b").agg(F.max("ic").alias("m"))
        return p.join(shared, ["a", "b"], "left").join(of("a", "ia"), "a").join(of("b", "ib"), "b").select("a", "b", "ia", "ib", F.coalesce("m", F.lit(0.0)).alias("m"))
    known = ancestors.terms().join(ic.select("term", "ic"), "term")
    numbers = written(known.select("_i", "ic"), "information").toArrow()  # a number a term, as many as the graph's
    info = np.full(ancestors.size, -np.inf)
    info[numbers["_i"].to_numpy()] = numbers["ic"].to_numpy()
    sent, told, inclusive = ancestors.sent, ancestors.spark.sparkContext.broadcast(info), ancestors.inclusive
    end = lambda key: known.select(F.col("term").alias(key), F.col("_i").alias(f"_{key}"), F.col("ic").alias(f"i{key}"))
    ends = p.join(end("a"), "a").join(end("b"), "b").select("a", "b", "ia", "ib", F.col("_a").alias("_i"), "_b")
    out = StructType([*ends.schema.fields[:4], StructField("m", DoubleType())])
    schema = to_arrow_schema(out)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = np.full(batch.num_rows, -np.inf)
            for lo in range(0, batch.num_rows, 1024):
                n, keys = len(info_ := told.value), []
                for c in ("_i", "_b"):
                    starts = batch.column(c).to_numpy()[lo : lo + 1024]
                    row, node = _with_own(*_above(*sent.value, starts), starts, inclusive)
                    keys.append(row * n + node)
                row, node = np.divmod(np.intersect1d(*keys, assume_unique=True), n)
                np.maximum.at(m, row + lo, info_[node])
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(np.where(m > -np.inf, m, 0.0))], schema=schema)

    return ancestors.dealt(ends).mapInArrow(meet, out)


def node_similarity(pairs: DataFrame, ancestors: DataFrame | Graph, ic: DataFrame, measure: str = "lin") -> DataFrame:
    """a, b, similarity of pairs (a, b) by their most informative strict shared ancestor; 0 where they share none.
    Measures: lin, resnik, jiang_conrath, information_coefficient."""
    return shared_information(pairs, ancestors, ic).select("a", "b", measured(measure).alias("similarity"))


def measured(name: str) -> Column:
    """A measure of the rows of ``shared_information``."""
    return _measure(name, F.col("ia"), F.col("ib"), F.col("m"))


def partner_similarity(edges: DataFrame, per_gene: DataFrame, key: str = "sample_id") -> DataFrame:
    """key, gene, partner_similarity: the largest similarity among the genes that a gene interacts with (gene, partner)."""
    other = per_gene.select(key, F.col("gene").alias("partner"), "similarity")
    return edges.select("gene", "partner").distinct().join(other, "partner").groupBy(key, "gene").agg(F.max("similarity").alias("partner_similarity"))


def term_names(terms: DataFrame, names: DataFrame) -> DataFrame:
    """Terms with their names; unknown ones are dropped."""
    return terms.join(names.select("term", "name"), "term")
