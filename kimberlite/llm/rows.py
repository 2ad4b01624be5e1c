"""Reading sorted Arrow batches one key at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows with equal ``keys``, from batches sorted by them."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held and not _same(held[0].slice(0, 1), table.slice(0, 1), keys):
            yield pa.concat_tables(held)
            held = []
        new = np.zeros(table.num_rows, bool)
        for key in keys:
            column = table.column(key).combine_chunks()
            new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        edges = [0, *np.flatnonzero(new).tolist(), table.num_rows]
        for begin, end in zip(edges[:-1], edges[1:]):
            if held and begin:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(begin, end - begin))
    if held:
        yield pa.concat_tables(held)


def _same(one: pa.Table, two: pa.Table, keys: list[str]) -> bool:
    return all(one.column(k)[0] == two.column(k)[0] for k in keys)
