"""Runs of sorted Arrow rows that share a key, one at a time, across batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa


def runs(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Each run of neighbouring rows equal in the whole-number ``keys`` as a table.

    Only the open run is held, so keys must be made such that a run is bounded.
    """
    held: list[pa.Table] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            key = tuple(c[a] for c in columns)
            if held and key != held_key:
                yield pa.concat_tables(held)
                held = []
            held_key = key
            held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
    if held:
        yield pa.concat_tables(held)
