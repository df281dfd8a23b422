"""Walk sorted Arrow batches group by group inside a task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str], most_rows: int | None = None) -> Iterator[tuple[pa.Table, bool, bool]]:
    """``(rows, begins, ends)`` of each run of equal keys in batches sorted by them.

    Memory holds one group and one batch.  With ``most_rows`` a longer group comes in
    several parts, of which only the first ``begins`` and only the last ``ends``.
    """
    rest: pa.Table | None = None
    begun = False
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        rest = part if rest is None else pa.concat_tables([rest, part])
        new = np.zeros(rest.num_rows, bool)
        for key in keys:
            values = rest.column(key).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        cuts = [0, *np.flatnonzero(new).tolist()]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield rest.slice(a, b - a), not begun, True
            begun = False
        rest = rest.slice(cuts[-1])
        if most_rows is not None and rest.num_rows > most_rows:
            yield rest.slice(0, rest.num_rows - 1), not begun, False
            begun, rest = True, rest.slice(rest.num_rows - 1)
    if rest is not None and rest.num_rows:
        yield rest, not begun, True


def binary_column(values: Sequence[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())
