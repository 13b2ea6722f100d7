"""Arrow batches in slices, so that only some rows are Python objects at once."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

ROWS = 256


def slices(values: pa.Array, rows: int = ROWS) -> Iterator[list]:
    for at in range(0, len(values), rows):
        yield values[at:at + rows].to_pylist()
