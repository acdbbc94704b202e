"""Block-gzipped text, as variant files come: a source that reads one file in many tasks, and a sink.

Such a file is a row of gzip members of at most 64 KiB, each with its length in its header. A task takes a range of bytes:
it looks for the first member that begins there (a header whose length leads to another header or to the file's end) and
unpacks those that begin before the range's end. As in any split text, a line belongs to the range in which it begins; the
line that begins right behind a range belongs to it, too, and is left out by the next. A plain gzip file, whose members have
no length, is one range."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..shared import fresh, ship

MAGIC = b"\x1f\x8b\x08\x04"
#: Fixed value: the empty member that ends a file.
LAST = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def member_size(head: bytes) -> int | None:
    """The length of the member that ``head`` begins, None where there is no such header."""
    if len(head) < 18 or head[:4] != MAGIC or head[12:16] != b"BC\x02\x00":
        return None
    return struct.unpack_from("<H", head, 16)[0] + 1


def packed(text: bytes) -> bytes:
    """``text`` as members."""
    out = []
    for at in range(0, len(text), 65_280):
        part = text[at : at + 65_280]
        deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = deflate.compress(part) + deflate.flush()
        out.append(MAGIC + b"\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part)))
    return b"".join(out)


def opened(path: str):
    """(file system, path in it) of a local path or a URI that pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


class BlockGzipReader(DataSourceReader):
    def __init__(self, schema, options):
        self.path, self.split_bytes = options["path"], int(options.get("split_bytes", 32 << 20))
        self.contigs = {c for c in options.get("contigs", "").split(",") if c}
        self.columns = int(options.get("columns", 0))

    def partitions(self) -> list[Range]:
        from pyarrow import fs

        store, at = opened(self.path)
        found = store.get_file_info(at)
        files = [found] if found.type == fs.FileType.File else [f for f in store.get_file_info(fs.FileSelector(at)) if f.type == fs.FileType.File and not f.base_name.startswith(("_", "."))]
        out = []
        for f in sorted(files, key=lambda f: f.path):
            with store.open_input_file(f.path) as raw:
                whole = member_size(raw.read(18)) is None
            step = max(1, f.size if whole else self.split_bytes)
            out += [Range(f.path, a, min(a + step, f.size)) for a in range(0, f.size, step)]
        return out

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        store, _ = opened(self.path)
        with store.open_input_file(part.path) as raw:
            size = raw.size()
            raw.seek(0)
            plain = member_size(raw.read(18)) is None
            pieces = self._plain(raw) if plain else self._members(raw, part, size)
            held, skip, lines = b"", part.start > 0, []
            for own, piece in pieces:
                if skip:  # up to the first line that begins here
                    if not own:
                        return
                    cut = piece.find(b"\n")
                    if cut < 0:
                        continue
                    piece, skip = piece[cut + 1 :], False
                if not own:  # the line behind the range's end
                    cut = piece.find(b"\n")
                    if cut < 0:
                        held += piece
                        continue
                    lines += self._kept([held + piece[:cut]])
                    held = None
                    break
                *whole, held = (held + piece).split(b"\n")
                lines += self._kept(whole)
                if len(lines) > 8192:
                    yield pa.record_batch([pa.array(lines, pa.string())], names=["value"])
                    lines = []
            if held and not skip:
                lines += self._kept([held])
            yield pa.record_batch([pa.array(lines, pa.string())], names=["value"])

    def _kept(self, lines: list[bytes]) -> list[str]:
        """Header lines, and records of the wanted contigs, cut to the wanted columns."""
        out = []
        for line in lines:
            if not line.startswith(b"#"):
                if self.contigs and line.split(b"\t", 1)[0].decode() not in self.contigs:
                    continue
                if self.columns:
                    line = b"\t".join(line.split(b"\t", self.columns)[: self.columns])
            out.append(line.decode().rstrip("\r"))
        return out

    @staticmethod
    def _plain(raw) -> Iterator[tuple[bool, bytes]]:
        raw.seek(0)
        unpack = zlib.decompressobj(31)
        while block := raw.read(1 << 20):
            while block:
                yield True, unpack.decompress(block)
                block = unpack.unused_data
                if unpack.eof:
                    unpack = zlib.decompressobj(31)

    @staticmethod
    def _members(raw, part: Range, size: int) -> Iterator[tuple[bool, bytes]]:
        """(whether it begins in the range, text) of each member from the range's first on."""
        at = part.start
        if at:
            raw.seek(at)
            window, i = raw.read(min(size - at, 1 << 17)), -1
            while (i := window.find(MAGIC, i + 1)) >= 0:
                n = member_size(window[i : i + 18])
                if n and (at + i + n == size or (i + n < len(window) and window[i + n : i + n + 4] == MAGIC[: len(window) - i - n])):
                    break
            at = at + i if i >= 0 else size
        while at < size:
            raw.seek(at)
            head = raw.read(18)
            n = member_size(head)
            if n is None:
                raise ValueError(f"{part.path} is damaged at byte {at}")
            body = head + raw.read(n - 18)
            yield at < part.end, zlib.decompress(body, 31)
            at += n


class BlockGzip(DataSource):
    """``spark.read.format("block_gzip")``: value, a line. Options: split_bytes; contigs, a comma list of the first columns to
    keep; columns, the number of columns to keep. Header lines (#) always stay."""

    @classmethod
    def name(cls) -> str:
        return "block_gzip"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> BlockGzipReader:
        return BlockGzipReader(schema, self.options)


def lines(spark: SparkSession, path: str, **options: str | int) -> DataFrame:
    """value: the lines of a block-gzipped (or plain gzip) file or folder."""
    ship(spark)
    spark.dataSource.register(BlockGzip)
    reader = spark.read.format("block_gzip")
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return reader.load(path)


def write_parts(ordered: DataFrame, column: str = "value") -> list[str]:
    """The lines of ``ordered`` as files of members, one a partition, in the shared folder; their paths in order. Files are
    named by attempt, and only those of attempts that counted are returned."""
    spark = ordered.sparkSession
    ship(spark)
    at = fresh(spark, "block-gzip")

    def run(batches):
        from pyspark import TaskContext

        store, root = opened(at)
        store.create_dir(root, recursive=True)
        part, path, held, size = TaskContext.get().partitionId(), f"{at}/{uuid.uuid4().hex}.gz", [], 0
        with store.open_output_stream(opened(path)[1], compression=None) as out:
            for batch in batches:
                for line in batch.column(0).to_pylist():
                    held.append((line or "").encode() + b"\n")
                    size += len(held[-1])
                    if size > 1 << 20:
                        out.write(packed(b"".join(held)))
                        held, size = [], 0
            out.write(packed(b"".join(held)))
        yield pa.record_batch([pa.array([part], pa.int64()), pa.array([path])], names=["part", "path"])

    return [r.path for r in sorted(ordered.select(column).mapInArrow(run, "part long, path string").collect())]  # a row a partition
