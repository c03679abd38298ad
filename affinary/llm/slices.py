"""Batches cut small, so that a task holds few texts at once besides the batch it was given."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, at most ``rows`` at a time; an unused memory pool is given back at the end."""
    for batch in batches:
        for start in range(0, max(1, len(batch)), rows):
            yield batch.slice(start, rows)
    pa.default_memory_pool().release_unused()
