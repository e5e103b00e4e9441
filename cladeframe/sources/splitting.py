"""Byte ranges of plain, gzip and bzip2 files as streams of decoded bytes.

A range of a file gives its own bytes first and then, marked as such, those after it, of
which a reader takes what it needs to finish its last record.  A plain file can be cut
anywhere.  A bzip2 file is cut between its blocks, which start at any bit: a block is
found by its mark and decoded as a stream of its own.  A gzip file can't be cut and
belongs to the range it starts in.  The format is told by the first bytes, never by name.
"""

from __future__ import annotations

import bz2
import zlib
from collections.abc import Iterator
from typing import BinaryIO

from .storage import read_range

# Leading bytes of the two formats, marks of a bzip2 block and of the end
# of a bzip2 stream.
GZIP_MAGIC = b"\x1f\x8b"
BZ2_MAGIC = b"BZh"
BLOCK_MARK = 0x314159265359
END_MARK = 0x177245385090
MARK_BITS = 48

STEP = 1 << 20
#: What is read at once beyond a range smaller than ``STEP``, at least.
LEAST_STEP = 1 << 16

Chunks = Iterator[tuple[bytes, bool]]


def decoded(handle: BinaryIO, start: int, end: int, size: int) -> Chunks:
    """Decoded bytes of a range, each with whether it is the range's own."""
    handle.seek(0)
    magic = handle.read(3)
    if magic[:2] == GZIP_MAGIC:
        return ((data, True) for data in _gzip(handle, size)) if start == 0 else iter(())
    if magic == BZ2_MAGIC:
        return _bzip2(handle, start, end, size)
    return _plain(handle, start, end, size)


def _plain(handle: BinaryIO, start: int, end: int, size: int) -> Chunks:
    for data in read_range(handle, start, end, STEP):
        yield data, True
    for data in read_range(handle, end, size, _step(start, end)):
        yield data, False


def _step(start: int, end: int) -> int:
    """Bytes to read at once: no more than a small range has, as most of it ends there."""
    return min(STEP, max(LEAST_STEP, end - start))


def _gzip(handle: BinaryIO, size: int) -> Iterator[bytes]:
    """All members of a gzip file."""
    engine = zlib.decompressobj(31)
    for data in read_range(handle, 0, size, STEP):
        while data:
            if engine.eof:
                engine = zlib.decompressobj(31)
                data = data.lstrip(b"\0")  # padding between members
                if not data:
                    break
            yield engine.decompress(data)
            data = engine.unused_data
    if not engine.eof:
        raise EOFError("a gzip file ends before its end mark")


def find_marks(data: bytes, mark: int) -> list[int]:
    """Bit positions of a 48-bit mark in ``data``."""
    found = []
    for shift in range(8):
        # bytes that the mark fills wholly when it starts ``shift`` bits into a byte
        lead = -shift % 8
        whole = (MARK_BITS - lead) // 8
        rest = MARK_BITS - lead - 8 * whole
        inner = (mark >> rest & ((1 << 8 * whole) - 1)).to_bytes(whole, "big")
        at = data.find(inner)
        while at >= 0:
            first = at - (lead > 0)
            if first >= 0:
                window = data[first : first + 7].ljust(7, b"\0")
                bits = int.from_bytes(window, "big") >> (56 - shift - MARK_BITS) & ((1 << MARK_BITS) - 1)
                if bits == mark and 8 * first + shift + MARK_BITS <= 8 * len(data):
                    found.append(8 * first + shift)
            at = data.find(inner, at + 1)
    return found


def _marks(handle: BinaryIO, start: int, size: int, step: int = STEP) -> Iterator[tuple[int, bool]]:
    """Bit positions of marks from byte ``start`` on, and whether each is a block's."""
    at = start
    while at < size:
        # windows overlap so that each mark lies wholly in the one it starts in
        handle.seek(at)
        data = handle.read(step + 7)
        found = [(m, True) for m in find_marks(data, BLOCK_MARK)] + [(m, False) for m in find_marks(data, END_MARK)]
        for m, block in sorted(found):
            if m < 8 * step:
                yield 8 * at + m, block
        at += step


def decode_block(handle: BinaryIO, first: int, last: int) -> bytes:
    """The bzip2 block between two bit positions, as a stream of one block."""
    low = first // 8
    handle.seek(low)
    data = handle.read(-(-last // 8) - low)
    bits = int.from_bytes(data, "big") >> (8 * len(data) - (last - 8 * low)) & ((1 << (last - first)) - 1)
    crc = bits >> (last - first - MARK_BITS - 32) & 0xFFFFFFFF
    bits = (bits << MARK_BITS | END_MARK) << 32 | crc
    length = last - first + MARK_BITS + 32
    pad = -length % 8
    return bz2.decompress(BZ2_MAGIC + b"9" + (bits << pad).to_bytes((length + pad) // 8, "big"))


def _bzip2(handle: BinaryIO, start: int, end: int, size: int) -> Chunks:
    """Blocks that start in the range, then those after it; nothing where none starts."""
    block, owns = None, False
    for position, is_block in _marks(handle, start, size, _step(start, end)):
        owns = owns or is_block and position < 8 * end
        if not owns and position >= 8 * end:
            return
        if block is not None:
            try:
                yield decode_block(handle, block, position), block < 8 * end
            except (OSError, ValueError, EOFError):
                continue  # the mark is a coincidence inside the block
        block = position if is_block else None
    if block is not None:
        raise EOFError("a bzip2 file ends before its end mark")
