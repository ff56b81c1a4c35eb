"""Arrow batches cut to a bounded amount of text, as a batch is bounded in rows alone."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one step of a Python operator works on; a longer text is a step of its own.
STEP_BYTES = 4 << 20


def bounded(batches: Iterator[pa.RecordBatch], columns: list[str], most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in their order, in batches of about ``most`` bytes of text of ``columns``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
        step = np.cumsum(size) // most
        starts = np.flatnonzero(np.r_[True, step[1:] != step[:-1]])
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(int(a), int(b - a))
