"""Arrow batches in pieces, so that a worker's memory doesn't follow a batch's size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: Rows of a piece, and bytes of its data; a longer row is a piece of its own.
ROWS, BYTES = 256, 4 << 20


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in the same order, a few at a time."""
    for b in batches:
        if not b.num_rows:
            continue
        rows = max(1, min(ROWS, BYTES * b.num_rows // max(1, b.nbytes)))
        for a in range(0, b.num_rows, rows):
            yield b.slice(a, rows)
    pa.default_memory_pool().release_unused()
