"""Streaming of sorted groups through numpy, for operators that compare rows tile by tile."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups of a partition that is sorted by ``keys``.

    A group that goes on in the next batch is held back, so memory is one batch and one
    group, and callers bound their groups.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(new)
        if held:
            last = held[-1]
            same = all(last.column(k)[last.num_rows - 1].as_py() == c[0] for k, c in zip(keys, cols, strict=True))
            if not same:
                yield pa.Table.from_batches(held)
                held = []
        cut = int(starts[-1]) if len(starts) else 0
        if cut:
            held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where groups of a sorted table begin, and its end."""
    n = table.num_rows
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        c = table.column(k).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), n)
