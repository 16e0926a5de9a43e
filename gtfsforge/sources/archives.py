"""Zip deliveries -> table lines (A-4), by member and stretch of lines.

1. *List.*  One task per archive walks its directory (an archive inside it is opened in memory)
   and hands on every member as slices of its bytes as they are stored; nothing is inflated.
2. *Inflate.*  One task per member streams its slices through the decompressor, tells
   which line ends lie inside a quoted field, and hands on stretches of whole lines.
3. *Deal.*  Stretches go to tasks of their own, so that a member of any length is parsed by
   many; memory is bounded by one slice, one stretch and one quoted field.

Lines are decoded as Latin-1 (lossless; the feed charset is applied later in the JVM).
"""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .kv1 import table_name

SCHEMA = "archive string, member string, table string, line string"
#: Bytes of a member per row, and characters of text per stretch of lines.
SLICE = 1 << 20
STRETCH = 1 << 20
#: A quoted field that is not closed within so many characters is text.
FIELD = 1 << 20

_LOCAL_HEADER = 30  # bytes before a member's name and extra field, whose lengths are the last four
_STARTS = re.compile(r'(?:^|\|)"')
_INNER = re.compile(r'\|"')


def _quote_open(line: str, inside: bool) -> bool:
    """Whether a quoted field is open at the end of a line, given whether one was at its start.
    Every character is looked at once."""
    at, first = 0, not inside
    while True:
        if not inside:
            m = (_STARTS if first else _INNER).search(line, at)
            if m is None:
                return False
            at, inside = m.end(), True
        first = False
        at = line.find('"', at)
        if at < 0:
            return True
        if line.startswith('""', at):  # a quote that stands for itself
            at += 2
        else:
            at, inside = at + 1, False


def split_lines(parts: Iterable[bytes] | bytes, field: int = FIELD) -> Iterator[str]:
    """Lines of a table file, given whole or in parts of any length, as Latin-1 text: cut at LF or CR LF
    only (other control bytes are text) and not inside a quoted field.  A quote that is
    not closed within ``field`` characters, or at all, is text: its lines come as they are."""
    held: list[str] = []
    size, inside = 0, False
    begun: list[str] = []  # of a line whose end is not there yet
    for part in _ended([parts] if isinstance(parts, bytes) else parts):
        lines = "\n" if part is None else part.decode("latin-1")
        if "\n" not in lines:
            begun.append(lines)
            continue
        lines = "".join([*begun, lines]).split("\n")
        begun = [lines.pop()]
        for line in lines:
            inside = _quote_open(line, inside) if '"' in line or inside else False
            if inside:
                held.append(line)
                size += len(line) + 1
                if size > field:
                    yield from (x.removesuffix("\r") for x in held)
                    held, size, inside = [], 0, False
            elif held:
                yield "\n".join([*held, line]).removesuffix("\r")
                held, size = [], 0
            else:
                yield line.removesuffix("\r")
    yield from (x.removesuffix("\r") for x in held)


def _ended(parts: Iterable[bytes]) -> Iterator[bytes | None]:
    yield from parts
    yield None


def _stored_members(content: bytes, prefix: str = "") -> Iterator[tuple[str, int, memoryview]]:
    """(name, compression method, stored bytes) of every member, archives in archives included."""
    view = memoryview(content)
    with zipfile.ZipFile(io.BytesIO(content)) as zf:
        for info in zf.infolist():
            if info.is_dir():
                continue
            if info.filename.lower().endswith(".zip"):
                yield from _stored_members(zf.read(info), f"{prefix}{info.filename}!")
                continue
            if info.flag_bits & 1 or info.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                raise ValueError(f"{prefix}{info.filename}: only stored and deflated members without password can be read")
            names = struct.unpack_from("<HH", content, info.header_offset + _LOCAL_HEADER - 4)
            start = info.header_offset + _LOCAL_HEADER + sum(names)
            yield prefix + info.filename, info.compress_type, view[start:start + info.compress_size]


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            for member, method, data in _stored_members(content.as_py()):
                for seq, at in enumerate(range(0, max(1, len(data)), SLICE)):
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([member]), pa.array([seq], pa.int32()), pa.array([method], pa.int32()),
                                                      pa.array([bytes(data[at:at + SLICE])], pa.binary())], names=["archive", "member", "seq", "method", "data"])


def _inflated(slices: Iterable[tuple[int, bytes]]) -> Iterator[bytes]:
    """The bytes of one member, a bounded part at a time."""
    inflate = None
    for method, data in slices:
        if method == zipfile.ZIP_STORED:
            yield data
            continue
        inflate = inflate or zlib.decompressobj(-zlib.MAX_WBITS)
        while data:
            yield inflate.decompress(data, SLICE)
            data = inflate.unconsumed_tail
    if inflate is not None:
        yield inflate.flush()


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members in order of their slices -> stretches of whole lines."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns])

    stream = rows()
    ahead = next(stream, None)
    while ahead is not None:
        now = ahead[:2]

        def own() -> Iterator[tuple[int, bytes]]:
            nonlocal ahead
            while ahead is not None and ahead[:2] == now:
                yield ahead[3], ahead[4]
                ahead = next(stream, None)

        def stretch(lines: list[str]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]]), pa.array([table_name(now[1].rsplit("!", 1)[-1])]), pa.array([n], pa.int64()),
                                               pa.array([lines], pa.list_(pa.string()))], names=["archive", "member", "table", "stretch", "lines"])

        n, size, lines = 0, 0, []
        for line in split_lines(_inflated(own())):
            if line:
                lines.append(line)
                size += len(line)
            if size >= STRETCH:
                yield stretch(lines)
                n, size, lines = n + 1, 0, []
        if lines:
            yield stretch(lines)


def expand(files: DataFrame) -> DataFrame:
    """(archive, member, table, line) for every line of every zip in (path, content)."""
    spark = files.sparkSession
    ship_package(spark)
    slices = files.select("path", "content").mapInArrow(_list, "archive string, member string, seq int, method int, data binary")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    members = slices.repartition(n, "archive", "member").sortWithinPartitions("archive", "member", "seq")
    stretches = members.mapInArrow(_stretches, "archive string, member string, table string, stretch long, lines array<string>")
    return stretches.repartition("archive", "member", "stretch").select("archive", "member", "table", F.explode("lines").alias("line"))


def expand_archives(spark: SparkSession, path: str) -> DataFrame:
    """(archive, member, table, line) for every line of every zip under ``path``."""
    return expand(spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path))
