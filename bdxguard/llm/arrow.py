"""Arrow-side helpers shared by the operators: bounded slices, group streaming, numpy views."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20


def text_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string or binary column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most ``limit`` bytes of text (a longer text is a run of its own)."""
    if batch.num_rows == 0:
        return
    _, offsets = text_view(batch.column(batch.schema.get_field_index(column)))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def binary_array(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binary column whose row i holds the next ``counts[i]`` items of the flat array ``values``."""
    raw = np.ascontiguousarray(values).view(np.uint8) if values.size else np.zeros(0, np.uint8)
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(np.asarray(counts) * values.itemsize, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Complete runs of equal ``keys`` from batches of a partition sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        change = np.zeros(batch.num_rows, bool)
        cols = [column(batch, k).to_numpy(zero_copy_only=False) for k in keys]
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        change[0] = first != last
        cuts = np.flatnonzero(change)
        begin = 0
        for cut in cuts:
            if cut > begin:
                held.append(batch.slice(begin, cut - begin))
            if held:
                yield pa.Table.from_batches(held)
                held = []
            begin = int(cut)
        held.append(batch.slice(begin))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)
