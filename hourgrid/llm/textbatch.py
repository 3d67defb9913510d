"""Texts of Arrow batches as numpy arrays, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 18


@dataclass
class Piece:
    """Code points of some whole documents, or of a part of one long document.

    first is the batch row of the first document; starts has the position at which
    each document begins. seen counts code points at the front that the piece before
    has had already.
    """

    first: int
    points: np.ndarray
    starts: np.ndarray
    seen: int = 0


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    found = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return found[at[0] : at[-1]], at - at[0]


def row_groups(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with up to limit bytes each; a longer row comes alone."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def pieces(column: pa.Array, overlap: int, limit: int = PIECE_BYTES) -> Iterator[Piece]:
    """All texts of a column as code points; parts of a long text share overlap points."""
    data, offsets = utf8(column)
    for row, end in row_groups(offsets, limit):
        part = data[offsets[row] : offsets[end]]
        if len(part) <= limit:
            heads = np.concatenate(([0], np.cumsum((part & 0xC0) != 0x80)))
            points = _points(part)
            if heads[-1] == len(points):
                yield Piece(row, points, heads[offsets[row:end] - offsets[row]])
            else:  # bytes that are no UTF-8
                for one in range(row, end):
                    points = _points(data[offsets[one] : offsets[one + 1]])
                    yield Piece(one, points, np.zeros(1, np.int64))
            continue
        at, seen = 0, np.zeros(0, np.uint32)
        while at < len(part):
            stop = min(len(part), at + limit)
            while stop < len(part) and part[stop] & 0xC0 == 0x80:
                stop += 1
            points = np.concatenate((seen, _points(part[at:stop])))
            yield Piece(row, points, np.zeros(1, np.int64), len(seen))
            at, seen = stop, points[max(0, len(points) - overlap) :]


def _points(part: np.ndarray) -> np.ndarray:
    return np.frombuffer(part.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


def _letter_table() -> np.ndarray:
    """For each code point of the basic plane: its lower case if a letter, else a blank."""
    table = np.full(1 << 16, 32, np.uint32)
    for point in range(1 << 16):
        char = chr(point)
        if char.isalpha():
            lower = char.lower()
            table[point] = ord(lower) if len(lower) == 1 else point
    return table


_TABLE: list[np.ndarray] = []


def letters(points: np.ndarray) -> np.ndarray:
    """Lower-case letters; every other code point becomes a blank."""
    if not _TABLE:
        _TABLE.append(_letter_table())
    high = points >= 1 << 16
    if not high.any():
        return _TABLE[0][points]
    found = _TABLE[0][np.where(high, 32, points)]
    for point in np.unique(points[high]):
        if chr(point).isalpha():
            found[points == point] = point
    return found
