"""Helpers for Arrow batches and numpy arrays inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Characters of text a task works on at a time; a longer text is alone.
GROUP = 1 << 20


def ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers from each begin up to its end, one range after another."""
    counts = end - begin
    shift = begin - (np.cumsum(counts) - counts)
    return np.arange(int(counts.sum())) + np.repeat(shift, counts)


def offsets(counts) -> np.ndarray:
    """Where each of the runs of these lengths begins, and where the last one ends."""
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(np.asarray(counts, np.int64))))


def groups(batch: pa.RecordBatch, text: str = "text", size: int = GROUP) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The rows of a batch in runs of about `size` characters, with their texts; a null is empty."""
    texts, first, total = [], 0, 0
    for i, value in enumerate(batch.column(text)):
        texts.append(value.as_py() or "")
        total += len(texts[-1])
        if total >= size:
            yield batch.slice(first, i + 1 - first), texts
            texts, first, total = [], i + 1, 0
    if texts:
        yield batch.slice(first), texts


def lists(counts, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Runs of `values` of these lengths as an array of lists."""
    return pa.ListArray.from_arrays(pa.array(offsets(counts), pa.int32()), pa.array(values, kind))
