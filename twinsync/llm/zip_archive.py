"""ZIP files of stored members, written as a stream and read by ranges; both in the 64-bit form where sizes need it."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple
from zlib import crc32

# Fixed values of the format: signatures, layouts after the signature, and the marks for "see the 64-bit field".
LOCAL, CENTRAL, DESCRIPTOR = b"PK\x03\x04", b"PK\x01\x02", b"PK\x07\x08"
END, END_64, LOCATOR_64 = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_LOCAL = struct.Struct("<4s5H3I2H")
_CENTRAL = struct.Struct("<4s6H3I5H2I")
_END = struct.Struct("<4s4H2IH")
_END_64 = struct.Struct("<4sQ2H2I4Q")
_LOCATOR_64 = struct.Struct("<4sIQI")
_FULL_16, _FULL_32 = 0xFFFF, 0xFFFFFFFF
_EXTRA_64 = 1
_STORED, _UTF8_NAME, _SIZES_FOLLOW, _ENCRYPTED = 0, 0x800, 0x8, 0x1
_DATE = (1 << 5) | 1  # the first day of 1980, so that equal input gives equal files
MAX_COMMENT = 1 << 16


class ArchiveError(ValueError):
    """The file is no readable ZIP archive."""


class Member(NamedTuple):
    name: str
    method: int
    header: int  # where its local header stands
    size: int  # as stored
    crc: int
    encrypted: bool

    @property
    def ranges(self) -> bool:
        """Whether parts of it can be read as they stand."""
        return self.method == _STORED and not self.encrypted


class ZipWriter:
    """Writes members one after another to a stream that cannot seek.  ``wide`` uses the 64-bit form throughout."""

    def __init__(self, out: BinaryIO, wide: bool = False) -> None:
        self.out, self.wide, self.written = out, wide, 0
        self.members: list[Member] = []
        self._open: list | None = None

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.written += len(data)

    def start(self, name: str) -> None:
        """A new member; its size follows its data."""
        raw, at = name.encode(), self.written
        # Sizes that follow are read as 64-bit only beside a 64-bit field here, so every member has one.
        extra = struct.pack("<2H2Q", _EXTRA_64, 16, 0, 0)
        flags = _UTF8_NAME | _SIZES_FOLLOW
        self._put(_LOCAL.pack(LOCAL, 45, flags, _STORED, 0, _DATE, 0, _FULL_32, _FULL_32, len(raw), len(extra)) + raw + extra)
        self._open = [name, at, 0, 0]

    @property
    def size(self) -> int:
        """Bytes of the open member so far."""
        return self._open[2]

    def write(self, data: bytes) -> None:
        self._put(data)
        self._open[2] += len(data)
        self._open[3] = crc32(data, self._open[3])

    def finish(self) -> None:
        """Ends the open member."""
        name, at, size, crc = self._open
        self._put(struct.pack("<4sI2Q", DESCRIPTOR, crc, size, size))
        self.members.append(Member(name, _STORED, at, size, crc, False))
        self._open = None

    def close(self) -> None:
        """Writes the directory.  The stream stays open."""
        start = self.written
        for member in self.members:
            raw = member.name.encode()
            wide = self.wide or member.size >= _FULL_32 or member.header >= _FULL_32
            extra = struct.pack("<2H3Q", _EXTRA_64, 24, member.size, member.size, member.header) if wide else b""
            size, header = (_FULL_32, _FULL_32) if wide else (member.size, member.header)
            self._put(_CENTRAL.pack(
                CENTRAL, 45, 45, _UTF8_NAME | _SIZES_FOLLOW, _STORED, 0, _DATE, member.crc, size, size,
                len(raw), len(extra), 0, 0, 0, 0, header,
            ) + raw + extra)
        length, count = self.written - start, len(self.members)
        if self.wide or start >= _FULL_32 or length >= _FULL_32 or count >= _FULL_16:
            at = self.written
            self._put(_END_64.pack(END_64, _END_64.size - 12, 45, 45, 0, 0, count, count, length, start))
            self._put(_LOCATOR_64.pack(LOCATOR_64, 0, at, 1))
            count, length, start = _FULL_16, _FULL_32, _FULL_32
        self._put(_END.pack(END, 0, 0, count, count, length, start, 0))


def read_at(file: BinaryIO, offset: int, length: int) -> bytes:
    """A range of a file; an error if the file ends within it."""
    file.seek(offset)
    data = file.read(length)
    if len(data) < length:
        raise ArchiveError(f"{length} bytes wanted at {offset}, {len(data)} there")
    return data


def _directory(file: BinaryIO, size: int) -> tuple[int, int, int]:
    """Start, length and number of entries of the central directory.

    The end record is the last one whose comment reaches exactly to the end of the file.
    """
    tail_at = max(0, size - _END.size - MAX_COMMENT)
    tail = read_at(file, tail_at, size - tail_at)
    at = tail.rfind(END)
    while at >= 0:
        if len(tail) - at >= _END.size:
            _, disk, first_disk, _, count, length, start, comment = _END.unpack_from(tail, at)
            if at + _END.size + comment == len(tail):
                break
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ArchiveError("no end of a central directory")
    end_at = tail_at + at
    if _FULL_16 in (disk, first_disk, count) or _FULL_32 in (length, start):
        if end_at < _LOCATOR_64.size:
            raise ArchiveError("no 64-bit end of a central directory")
        mark, _, end_64, _ = _LOCATOR_64.unpack(read_at(file, end_at - _LOCATOR_64.size, _LOCATOR_64.size))
        if mark == LOCATOR_64:
            fields = _END_64.unpack(read_at(file, end_64, _END_64.size))
            if fields[0] != END_64:
                raise ArchiveError("no 64-bit end of a central directory")
            return fields[9], fields[8], fields[7]
        if _FULL_32 in (length, start):
            raise ArchiveError("no 64-bit end of a central directory")
    if disk or first_disk:
        raise ArchiveError("parts of an archive over several files")
    return start, length, count


def _wide_fields(extra: bytes, size: int, packed: int, header: int) -> tuple[int, int]:
    """Stored size and header place, taken from the 64-bit field where they are marked to be there."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<2H", extra, at)
        if kind == _EXTRA_64:
            field = extra[at + 4:at + 4 + length]
            values = iter(struct.unpack(f"<{len(field) // 8}Q", field[:len(field) // 8 * 8]))
            try:
                if size == _FULL_32:
                    next(values)
                if packed == _FULL_32:
                    packed = next(values)
                if header == _FULL_32:
                    header = next(values)
            except StopIteration:
                raise ArchiveError("a 64-bit field is too short") from None
            break
        at += 4 + length
    return packed, header


def members(file: BinaryIO, size: int, chunk: int = 1 << 20) -> Iterator[Member]:
    """The members by the central directory, which is read in chunks."""
    start, length, count = _directory(file, size)
    if start + length > size:
        raise ArchiveError("the central directory reaches beyond the file")
    held, at, read = b"", 0, 0

    def ahead(want: int) -> None:
        nonlocal held, at, read
        while len(held) - at < want:
            if read >= length:
                raise ArchiveError("the central directory ends within an entry")
            more = read_at(file, start + read, min(chunk, length - read))
            held, at, read = held[at:] + more, 0, read + len(more)

    for _ in range(count):
        ahead(_CENTRAL.size)
        (mark, _, _, flags, method, _, _, crc, packed, plain, n_name, n_extra, n_comment, _, _, _, header) = (
            _CENTRAL.unpack_from(held, at)
        )
        if mark != CENTRAL:
            raise ArchiveError("no entry where the central directory should have one")
        ahead(_CENTRAL.size + n_name + n_extra + n_comment)
        at += _CENTRAL.size
        name = held[at:at + n_name].decode("utf-8" if flags & _UTF8_NAME else "cp437")
        packed, header = _wide_fields(held[at + n_name:at + n_name + n_extra], plain, packed, header)
        at += n_name + n_extra + n_comment
        yield Member(name, method, header, packed, crc, bool(flags & _ENCRYPTED))


def data_start(file: BinaryIO, member: Member) -> int:
    """Where a member's data begin: its local header may be longer than its entry tells."""
    fields = _LOCAL.unpack(read_at(file, member.header, _LOCAL.size))
    if fields[0] != LOCAL:
        raise ArchiveError(f"no local header of {member.name}")
    return member.header + _LOCAL.size + fields[9] + fields[10]
