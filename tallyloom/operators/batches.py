"""Arrow batches as numpy arrays, for functions inside tasks. Workers import this module alone, not the whole of Spark ML."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def rows_by_part(batch: pa.RecordBatch) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Rows of a batch of (part, label, feature list) per part: its number, labels, features behind a one for the intercept."""
    found, numbers = [], batch.column(0).to_numpy(zero_copy_only=False)
    for part in np.unique(numbers):
        own = batch.filter(pa.array(numbers == part))
        x = own.column(2).flatten().to_numpy(zero_copy_only=False).reshape(own.num_rows, -1)
        found.append((int(part), own.column(1).to_numpy(zero_copy_only=False), np.hstack([np.ones((len(x), 1)), x])))
    return found
