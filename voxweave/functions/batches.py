"""Arrow batches in bounded parts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20


def text_slices(texts: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """(first row, rows) of runs with about ``limit`` bytes of text; a longer text is in a run without others like it."""
    size = np.array(pc.fill_null(pc.binary_length(texts), 0), np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(size) // limit)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]):
        if b > a:
            yield a, b - a
