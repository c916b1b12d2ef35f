"""Arrow batches cut to a bounded size inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

# Text that one slice of a batch may hold before Python objects are made of it.
SLICE_BYTES = 8 * 1024 * 1024
SLICE_ROWS = 2_000


def slices(
    batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS, size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in the same order, in slices of few rows and few bytes.

    A single row is never cut, however long its text is.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        each = max(1, batch.nbytes // batch.num_rows)
        step = int(max(1, min(rows, size // each)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def fresh_name(df, wanted: str) -> str:
    """``wanted``, or a longer name that no column of ``df`` has in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
