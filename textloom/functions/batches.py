"""Arrow batches cut by the size of their texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def text_slices(batches: Iterator[pa.RecordBatch], column: int, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most_bytes`` of that column's text, or of one longer
    text, so that what is made of a slice doesn't grow with the length of texts; memory of a
    finished batch goes back to the system."""
    for batch in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = upto[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(upto, before + most_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop
        del batch
        pa.default_memory_pool().release_unused()
