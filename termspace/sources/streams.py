"""Files read piece by piece in a task, whatever their size."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow.fs as pafs
from pyspark.sql import SparkSession

PIECE = 2**20
# The most that a compressed piece may grow to at once.
_GROWN = 4 * 2**20
_GZIP = 16 + zlib.MAX_WBITS


class Broken(Exception):
    """A compressed stream that cannot be read on; ``offset`` counts the compressed bytes before the break."""

    def __init__(self, offset: int, why: str):
        super().__init__(f"broken at byte {offset}: {why}")
        self.offset = offset


def filesystem_of(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark names it, and the path within."""
    parts = re.fullmatch(r"([A-Za-z][A-Za-z0-9+.-]+):(?://([^/]*))?(/.*)", path, re.DOTALL)
    if parts is None or parts[1] == "file":
        return pafs.LocalFileSystem(), parts[3] if parts else path
    scheme, host = "s3" if parts[1] in ("s3a", "s3n") else parts[1], parts[2] or ""
    if scheme in ("s3", "gs"):
        return pafs.FileSystem.from_uri(f"{scheme}://{host}/")[0], host + parts[3]
    return pafs.FileSystem.from_uri(f"{scheme}://{host}/")[0], parts[3]


def tasks_can_open(spark: SparkSession, path: str) -> bool:
    """Whether Python can read the path's file system itself; if not, Spark hands over whole files."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        filesystem_of(files.getUri().toString().rstrip("/").replace("file:", "file:/") + "/")
    except (OSError, ValueError, ImportError):
        return False
    return True


def pieces_of(path: str) -> Iterator[bytes]:
    """The bytes of a file in pieces. A failed read raises, and the task is tried again."""
    files, inner = filesystem_of(path)
    with files.open_input_stream(inner, compression=None, buffer_size=0) as stream:
        while piece := stream.read(PIECE):
            yield piece


def gunzipped(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Decompressed pieces of a gzip stream, of one member or several; zeros after a member are padding.

    Raises ``Broken`` where the data are damaged or end too early; all that
    comes before has been given out by then.
    """
    member, offset, ended = None, 0, False
    for piece in pieces:
        left = piece
        while left:
            if member is None:
                left = left.lstrip(b"\0") if ended else left
                if not left:
                    break
                member = zlib.decompressobj(_GZIP)
            before = member.copy()
            try:
                out = member.decompress(left, _GROWN)
            except zlib.error as problem:
                good, used = _until_error(before, left)
                yield good
                raise Broken(offset + len(piece) - len(left) + used, str(problem)) from None
            if out:
                yield out
            if member.eof:
                left, member, ended = member.unused_data, None, True
            else:
                left = member.unconsumed_tail
        offset += len(piece)
    if member is not None:
        raise Broken(offset, "the file ends before its data do")


def _until_error(member, data: bytes) -> tuple[bytes, int]:
    """(output, bytes used) of all that can be decompressed: in steps first, then byte by byte."""
    out, used = [], 0
    for step in (4096, 64, 1):
        while used < len(data):
            before = member.copy()
            try:
                out.append(member.decompress(data[used : used + step]))
            except zlib.error:
                member = before
                break
            used += step
    return b"".join(out), used


class Stream:
    """Pieces as a file that can only be read on. A failure comes once all bytes before it have been read."""

    def __init__(self, pieces: Iterator[bytes]):
        self._pieces, self._left = pieces, memoryview(b"")

    def read(self, size: int) -> bytes:
        """At most ``size`` bytes, fewer where a piece ends; none at the end."""
        while not self._left:
            piece = next(self._pieces, None)
            if piece is None:
                return b""
            self._left = memoryview(piece)
        out, self._left = self._left[:size], self._left[size:]
        return bytes(out)


def parted(pieces: Iterator[bytes], start: bytes, end: bytes) -> Iterator[tuple[bytes, bool]]:
    """(text, closed) from each match of the pattern ``start`` to the mark ``end``; ``closed`` is False for a last one without it.

    Only what may still become a part is held. After an exception of ``pieces``
    the open part comes first, then the exception.
    """
    opening, held, seen = re.compile(start), bytearray(), 0
    failure = None
    iterator = iter(pieces)
    while True:
        try:
            piece = next(iterator)
        except StopIteration:
            break
        except Broken as problem:
            failure = problem
            break
        held += piece
        at = held.find(end, max(0, seen - len(end)))
        begin = 0
        while at >= 0:
            found = opening.search(held, begin, at)
            if found:
                yield bytes(held[found.start() : at + len(end)]), True
            begin = at + len(end)
            at = held.find(end, begin)
        del held[:begin]
        # What stands before the next start is not needed.
        found = opening.search(held)
        del held[: found.start() if found else max(0, len(held) - 64)]
        seen = len(held)
    found = opening.search(held)
    if found:
        yield bytes(held[found.start() :]), False
    if failure is not None:
        raise failure
