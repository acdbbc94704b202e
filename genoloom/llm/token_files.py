"""Token-ID files: a concatenated id array with Elias-Fano coded document boundaries.

A file (little-endian): ``magic, id width, docs, null ids, tokens, smallest doc_id`` and the lengths of its sections;
an Elias-Fano list of the doc_ids (less the smallest), one of the documents' first ids, then all ids at 2 bytes each
(4 where the vocabulary needs them). An Elias-Fano list of n values below u keeps ``l = floor(log2(u / n))`` low bits
of each in a packed array and the rest as a bit vector with n ones, about ``2 + l`` bits a value; ``select`` finds a
value through the position of every 256th one, kept in 32 bits, and ``block`` the 256 values from there. Readers hold
the values of one block at a time: no table of 64-bit offsets of a file exists, on disk or in memory.

Edge cases: a null text is an empty one (its only id is the end id); repeated doc_ids are kept, in the order of a hash
of their texts, so a doc_id that many rows share is spread over many files; null doc_ids come first and are counted in the
header; texts of any length are encoded whole and never cut, one longer than a file's size has a file alone; an empty
table writes no file; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_schema, batch_of, rows_in_batches, shared_dir, ship, stored, table
from .tokens import byte_bpe, encoder

MAGIC = b"TOKIDEF1"
HEAD = struct.Struct("<8sIIIQqIIII")
SAMPLE = 256


class EliasFano:
    """A nondecreasing list of integers from 0; ``select(i)`` is value i, ``block(b)`` the values from b * SAMPLE on."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.l, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        values = values.astype(np.uint64)
        u = int(values[-1]) + 1 if n else 1
        bits = max(0, (u // max(n, 1)).bit_length() - 1)
        low = np.packbits(((values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little") if bits else np.zeros(0, np.uint8)
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        flags[ones] = 1
        return cls(n, bits, low, np.packbits(flags, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def select(self, i: int) -> int:
        """Value i alone: from the nearest sampled one, over the words between, to its low bits."""
        at = int(self.samples[i // SAMPLE])
        left, byte = i % SAMPLE, at // 8
        word = int(self.high[byte]) & (0xFF << (at % 8))
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        one = byte * 8 + (word & -word).bit_length() - 1
        low = 0
        for k in range(self.l):
            bit = i * self.l + k
            low |= (int(self.low[bit // 8]) >> (bit % 8) & 1) << k
        return ((one - i) << self.l) | low

    def block(self, b: int) -> np.ndarray:
        """At most SAMPLE values: the bits from one sampled position to the next, and their low bits."""
        first, last = b * SAMPLE, min(self.n, (b + 1) * SAMPLE)
        at = int(self.samples[b])
        to = int(self.samples[b + 1]) if b + 1 < len(self.samples) else len(self.high) * 8
        flags = np.unpackbits(self.high[at // 8 : -(-to // 8)], bitorder="little")[at % 8 :]
        ones = np.flatnonzero(flags)[: last - first] + (at - first) - np.arange(last - first)
        if not self.l:
            return ones
        low = np.unpackbits(self.low[first * self.l // 8 : -(-last * self.l // 8)], bitorder="little")[: (last - first) * self.l]
        return (ones << self.l) | (low.reshape(-1, self.l).astype(np.int64) << np.arange(self.l)).sum(1)

    def values(self) -> np.ndarray:
        return np.concatenate([self.block(b) for b in range(len(self.samples))] or [np.zeros(0, np.int64)])

    def to_bytes(self) -> bytes:
        return struct.pack("<IIIII", self.n, self.l, len(self.low), len(self.high), len(self.samples)) + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> EliasFano:
        n, bits, low, high, samples = struct.unpack_from("<IIIII", raw)
        at = 20
        return cls(n, bits, np.frombuffer(raw, np.uint8, low, at), np.frombuffer(raw, np.uint8, high, at + low), np.frombuffer(raw, "<u4", samples, at + low + high))


def to_file(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """The bytes of a file of these documents, given in ascending order of doc_id, nulls first."""
    known = [d for d in doc_ids if d is not None]
    least = known[0] if known else 0
    ends = np.cumsum([len(x) // width for x in ids], dtype=np.int64)
    keys = EliasFano.of(np.array([d - least for d in known], dtype=np.uint64)).to_bytes()
    starts = EliasFano.of(np.concatenate([[0], ends[:-1]]).astype(np.int64)).to_bytes()
    total = int(ends[-1]) if len(ends) else 0
    return HEAD.pack(MAGIC, width, len(ids), len(ids) - len(known), total, least, len(keys), len(starts), 0, 0) + keys + starts + b"".join(ids)


class TokenFile:
    """Reads one file's bytes."""

    def __init__(self, raw: bytes):
        magic, self.width, self.n, self.nulls, self.tokens, self.least, keys, starts, _, _ = HEAD.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = HEAD.size
        self.keys, self.starts = EliasFano.from_bytes(raw[at : at + keys]), EliasFano.from_bytes(raw[at + keys : at + keys + starts])
        self.ids = np.frombuffer(raw, "<u2" if self.width == 2 else "<u4", self.tokens, at + keys + starts)

    def documents(self) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
        """doc_ids, first ids and lengths, SAMPLE documents at a time, each block found by its select sample."""
        keys, held = 0, np.zeros(0, np.int64)
        for b in range(len(self.starts.samples)):
            starts = self.starts.block(b)
            after = (b + 1) * SAMPLE
            lengths = np.diff(starts, append=self.starts.select(after) if after < self.n else self.tokens)
            nulls = min(max(self.nulls - b * SAMPLE, 0), len(starts))
            while len(held) < len(starts) - nulls:
                held, keys = np.concatenate([held, self.keys.block(keys)]), keys + 1
            yield [None] * nulls + (held[: len(starts) - nulls] + self.least).tolist(), starts, lengths
            held = held[len(starts) - nulls :]

    def document(self, i: int) -> np.ndarray:
        """The ids of document i alone."""
        return self.ids[self.starts.select(i) : self.starts.select(i + 1) if i + 1 < self.n else self.tokens]


def write_token_files(docs: DataFrame, out_dir: str, tokenizer: str, end_id: int = 0, file_tokens: int = 4_000_000) -> DataFrame:
    """Write ``docs`` (doc_id, text) in ascending doc_id order into files of at most ``file_tokens`` ids (a longer text has
    one of its own) under ``out_dir``, a folder all executors share. Ranges of (doc_id, hash of the text, row) keep the
    order and split a doc_id that many rows share. Each task writes its own files under names of its attempt, and the
    returned manifest (part, seq, path, n_docs, n_tokens) names only those of attempts that counted. Memory in a task: one
    file and the rows of one batch."""
    order = ["doc_id", "h", "row"]
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns({"h": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(out_dir)
        store.create_dir(root, recursive=True)
        enc, part, seq, mark = encoder(tokenizer), TaskContext.get().partitionId(), 0, uuid.uuid4().hex
        end, width = enc.raw[end_id], enc.dtype.itemsize
        schema = arrow_schema("part long, seq long, path string, n_docs long, n_tokens long")
        keys, held, size = [], [], 0

        def flush():
            path = f"{root}/{part:06d}-{seq:06d}-{mark}.tid"
            with store.open_output_stream(path) as out:
                out.write(to_file(keys, held, width))
            return batch_of(schema, [[part], [seq], [path], [len(keys)], [size // width]])

        for ids, texts in rows_in_batches(batches, ["doc_id", "text"], 512):
            for d, raw in zip(ids, enc.encode(texts)):
                if keys and size + len(raw) + width > file_tokens * width:
                    yield flush()
                    keys, held, size, seq = [], [], 0, seq + 1
                keys.append(d)
                held.append(raw + end)
                size += len(held[-1])
        if keys:
            yield flush()

    return stored(ordered.mapInArrow(run, "part long, seq long, path string, n_docs long, n_tokens long"), "token-manifest")


def read_token_files(manifest: DataFrame, out_dir: str, task_tokens: int = 64_000_000) -> DataFrame:
    """doc_id, start (ids of all documents before it, over all files), n_tokens, ids_crc32 from the files of a manifest.
    First ids come from the select structures of the Elias-Fano lists; a file's base is the sum of the counts before it,
    taken in two steps (parts, then files of a part), so no step sees more than one row a part or the files of one part.
    A reading task takes the files of about ``task_tokens`` ids, in order; where there are few files, one each: the
    manifest's rows are few and small, so Spark would merge them all into one."""
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    bases = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_base"))
    files = manifest.join(bases, "part").select("part", "seq", "path", (F.col("part_base") + F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")).alias("base"))
    ddl = "doc_id long, start long, n_tokens long, ids_crc32 long"
    schema = arrow_schema(ddl)

    def run(batches):
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(out_dir)
        for paths, bases in rows_in_batches(batches, ["path", "base"]):
            for path, base in zip(paths, bases):
                with store.open_input_stream(path) as f:
                    file = TokenFile(f.read())
                out: list[list] = [[], [], [], []]
                for keys, starts, lengths in file.documents():
                    crcs = [zlib.crc32(file.ids[a : a + n].astype("<u4").tobytes()) for a, n in zip(starts.tolist(), lengths.tolist())]
                    for column, values in zip(out, (keys, (starts + base).tolist(), lengths.tolist(), crcs)):
                        column.extend(values)
                    if len(out[0]) >= 8192:
                        yield batch_of(schema, out)
                        out = [[], [], [], []]
                yield batch_of(schema, out)

    ship(manifest.sparkSession)
    n, tokens = manifest.agg(F.count("*"), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    tasks = max(1, min(n, max(4 * manifest.sparkSession.sparkContext.defaultParallelism, -(-tokens // task_tokens))))
    return files.repartitionByRange(tasks, "part", "seq").select("path", "base").mapInArrow(run, ddl)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out_dir = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    manifest = write_token_files(table(spark, sf_dir, "documents"), out_dir, byte_bpe())
    return read_token_files(manifest, out_dir)
