"""Arrow batches of texts as numpy arrays, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; one longer text is a piece of its own.
PIECE_BYTES = 1 << 18


def pieces(batches, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of the batches with at most ``limit`` text bytes, and their text as binary (null: empty)."""
    for batch in batches:
        text = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary()).fill_null(b"")
        ends = np.cumsum(np.diff(_offsets(text)))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, stop - at), text.slice(at, stop - at)
            at = stop


def _offsets(text: pa.Array) -> np.ndarray:
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)
    return offsets[text.offset : text.offset + len(text) + 1]


def joined_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a piece one after another, and where each text starts (one more at the end)."""
    offsets = _offsets(text)
    data = text.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def with_columns(batch: pa.RecordBatch, keep: list[str], **columns: pa.Array) -> pa.RecordBatch:
    arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep]
    return pa.RecordBatch.from_arrays(arrays + list(columns.values()), names=[*keep, *columns])


def span_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` in each [bounds[i], bounds[i + 1]); empty spans give 0."""
    total = np.zeros(len(values) + 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
