"""Benchmark decontamination by Wu-Manber multi-pattern search.

Benchmark items are cut into windows of ten words (an item of fewer is one window). Texts and windows are brought to
words joined by single spaces, so a window occurs in a text iff its bytes, with a space on either side, do. For each
class of window lengths, a shift table over blocks of up to eight bytes says how far the search may skip; where it may
not, the block's bucket (by suffix block, then by prefix) names the windows to compare byte by byte.

Windows beyond ``block_bytes`` are searched in several passes over the texts, so the tables sent to executors stay
bounded for any benchmark. Edge cases: null or empty texts and items have no words; repeated doc_ids keep their rows;
repeated items count once; a null item_id counts as the empty string; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_schema, batch_of, kept_rows, map_rows, rows_in_batches, ship, stored, table

WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(WORD_BYTES).split()


class WuManber:
    """Exact occurrences of many byte strings. Strings are searched in classes of like length, so that one short string
    doesn't shorten the skips for long ones."""

    def __init__(self, patterns: list[bytes]):
        classes: dict[int, list[bytes]] = {}
        for p in set(patterns):
            classes.setdefault(min(len(p).bit_length(), 6), []).append(p)
        self.classes = []
        for group in classes.values():
            m = min(map(len, group))
            b = min(8, max(1, m // 2))
            shift: dict[bytes, int] = {}
            buckets: dict[bytes, dict[bytes, list[bytes]]] = {}
            for p in group:
                for i in range(m - b + 1):
                    block = p[i : i + b]
                    if shift.get(block, m) > m - b - i:
                        shift[block] = m - b - i
                buckets.setdefault(p[m - b : m], {}).setdefault(p[:b], []).append(p)
            self.classes.append((m, b, shift, buckets))

    def find(self, text: bytes) -> list[tuple[int, bytes]]:
        hits = []
        for m, b, shift, buckets in self.classes:
            at, last, far, get = m - b, len(text) - b, m - b + 1, shift.get
            while at <= last:
                step = get(text[at : at + b], far)
                if step:
                    at += step
                    continue
                start = at + b - m
                for p in buckets[text[at : at + b]].get(text[start : start + b], ()):
                    if text.startswith(p, start):
                        hits.append((start, p))
                at += 1
        return hits


def windows(benchmark: DataFrame, width: int = 10) -> DataFrame:
    """Distinct (item, pattern): the items' windows as bytes, with a space on either side."""
    schema = arrow_schema("item string, pattern binary")

    def run(batches):
        for ids, texts in rows_in_batches(batches, ["item", "raw"], 64):
            for item, raw in zip(ids, texts):
                words = words_of(raw)
                for at in range(0, max(len(words) - width + 1, 1 if words else 0), 4096):
                    part = [b" " + b" ".join(words[i : i + width]) + b" " for i in range(at, min(at + 4096, max(len(words) - width + 1, 1)))]
                    yield batch_of(schema, [[item] * len(part), part])

    ship(benchmark.sparkSession)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("binary").alias("raw"))
    return items.mapInArrow(run, "item string, pattern binary").distinct()


def _digest(n_words: int, spans: list[int], items: set[str]) -> tuple:
    """spans: first word and word after the last, one after the other."""
    hit = 0
    if spans:
        edge = np.zeros(n_words + 1, np.int64)
        np.add.at(edge, spans[::2], 1)
        np.add.at(edge, spans[1::2], -1)
        hit = int((np.cumsum(edge[:-1]) > 0).sum())
    return n_words, hit, len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), hit > 0


_OUT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
_PART = "doc_id long, row long, n_words long, spans array<long>, items array<string>"


def _passes(benchmark: DataFrame, width: int, block_bytes: int):
    """The number of passes, and a function that sends the windows of one of them, with their items, to the executors."""
    all_windows = stored(windows(benchmark, width), "windows")
    n = max(1, math.ceil((all_windows.agg(F.sum(F.length("pattern") + F.length("item"))).first()[0] or 0) / block_bytes))

    def send(k: int):
        of: dict[bytes, list[str]] = {}
        for r in all_windows.filter(F.pmod(F.xxhash64("pattern", "item"), F.lit(n)) == k).collect():
            of.setdefault(bytes(r.pattern), []).append(r.item)
        return benchmark.sparkSession.sparkContext.broadcast(of)

    return n, send


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = 2_000_000) -> DataFrame:
    """One row a document: doc_id, n_words, n_hit (words inside any occurrence of a window), n_items, items_sha256,
    contaminated. ``block_bytes`` bounds the windows that one pass sends to the executors."""
    passes, send = _passes(benchmark, width, block_bytes)
    source = docs.select("doc_id", F.lit(0).cast("long").alias("row"), F.col("text").cast("binary").alias("raw"))
    if passes > 1:
        source = stored(source.withColumn("row", F.monotonically_increasing_id()), "texts")

    def one_pass(k: int, ddl: str, finish) -> DataFrame:
        sent = send(k)

        def make():
            known = sent.value
            search = WuManber(list(known))

            def step(ids, rows, texts):
                out = []
                for d, row, raw in zip(ids, rows, texts):
                    words = words_of(raw)
                    text = b" " + b" ".join(words) + b" "
                    spans, items = [], set()
                    if hits := search.find(text):
                        spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
                        for start, p in hits:
                            first = int(np.searchsorted(spaces, start))
                            spans += (first, first + p.count(b" ") - 1)
                            items.update(known[p])
                    out.append(finish(d, row, len(words), spans, items))
                return [list(c) for c in zip(*out)] if out else [[] for _ in ddl.split(", ")]

            return step

        return map_rows(source, make, ddl, ["doc_id", "row", "raw"])

    if passes == 1:
        return one_pass(0, _OUT, lambda d, row, n, spans, items: (d, *_digest(n, spans, items)))
    parts = [stored(one_pass(k, _PART, lambda d, row, n, spans, items: (d, row, n, spans, sorted(items))), "hits") for k in range(passes)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    merged = every.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    return map_rows(merged, lambda: lambda ids, ns, spans, items: [list(c) for c in zip(*[(d, *_digest(n, s, set(i))) for d, n, s, i in zip(ids, ns, spans, items)])] or [[]] * 6, _OUT, ["doc_id", "n_words", "spans", "items"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_bytes: int = 2_000_000) -> DataFrame:
    """``docs`` without the rows that hold a window of the benchmark; no text is shuffled. Of several passes, each works
    on what the one before it kept."""
    passes, send = _passes(benchmark, width, block_bytes)
    for k in range(passes):
        sent = send(k)

        def make(sent=sent):
            search = WuManber(list(sent.value))
            return lambda texts: [not search.find(b" " + b" ".join(words_of((x or "").encode())) + b" ") for x in texts]

        docs = kept_rows(docs, make)
        docs = stored(docs, "clean") if passes > 1 else docs
    return docs


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP3_SQL = r"""
WITH doc AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS p FROM (SELECT item, w, least(10, len(w)) AS n, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
gram AS (SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS p FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM doc, sizes WHERE len(w) >= n)),
hit AS (SELECT r, gram.n, i, item FROM gram JOIN win USING (n, p)),
covered AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS pos FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS h FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""
