"""Arrow batches cut to a bounded amount of text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer text is worked on alone, whole.
MOST_BYTES = 12_000_000


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = MOST_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about so many bytes in the column, a row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // most
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            yield batch.slice(a, b - a)
