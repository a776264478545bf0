"""Whole texts as one flat byte array: words, their rows and their breaks found by numpy, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are held as flat arrays at once; a longer single text goes alone.
CHUNK = 8 << 20

BREAK, BLANK, WORD = 0, 1, 2
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_classes(blank: bytes = b"", breaks: bytes = b"") -> np.ndarray:
    """Class by byte: the given ones are blanks or breaks, all others belong to words."""
    classes = np.full(256, WORD, np.uint8)
    classes[list(blank)] = BLANK
    classes[list(breaks)] = BREAK
    return classes


def chunks(batch: pa.RecordBatch, text: str, size: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``size`` (``CHUNK``) bytes of text each, a longer single text alone."""
    column = batch.column(batch.schema.get_field_index(text))
    size, ends = size or CHUNK, text_offsets(column)[1:]
    at = 0
    while at < len(batch):
        below = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, below + size, side="right")))
        yield batch.slice(at, upto - at)
        at = upto


def _plain(column: pa.Array) -> tuple[np.ndarray, pa.Buffer | None]:
    filled = pc.fill_null(column.cast(pa.binary()), b"")
    buffers = filled.buffers()
    return np.frombuffer(buffers[1], np.int32, len(filled) + 1, filled.offset * 4) if len(filled) else np.zeros(1, np.int32), buffers[2]


def text_offsets(column: pa.Array) -> np.ndarray:
    """Where each text begins in the flat bytes, and the end; a null is an empty text."""
    bounds = _plain(column)[0]
    return bounds.astype(np.int64) - int(bounds[0])


def text_bytes(column: pa.Array) -> np.ndarray:
    """All bytes of all texts, one after the other."""
    bounds, data = _plain(column)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if bounds[-1] > bounds[0] else np.zeros(0, np.uint8)


def words(column: pa.Array, classes: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words in lower case (A-Z) as binary array, row of each word, piece of each word).

    Two words have the same piece number if they stand in one row with no break between them.
    """
    offsets, raw = text_offsets(column), text_bytes(column)
    kind = classes[raw]
    inside = kind == WORD
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    # A row that begins inside what looks like a word of the row before begins a word of its own.
    heads = offsets[:-1][offsets[:-1] < len(raw)]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    row = np.searchsorted(offsets, starts, side="right") - 1
    broken = np.cumsum(kind == BREAK, dtype=np.int64)
    piece = broken[starts] + row if len(starts) else np.zeros(0, np.int64)
    upto = np.cumsum(inside, dtype=np.int64)
    at = upto[starts] - 1 if len(starts) else np.zeros(0, np.int64)
    ends = np.append(at, upto[-1] if len(raw) else 0).astype(np.int32)
    data = LOWER[raw[inside]]
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)]), row, piece
