"""What the operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Finite entries whose scaled floor would leave this range raise an error, so that sums stay exact.
LARGEST = 1 << 40


def finite_rows(table: DataFrame) -> DataFrame:
    """The rows whose embedding is neither null nor empty and holds no null, NaN or infinity."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return table.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & usable)


def dimension(rows: DataFrame) -> int:
    """The one length of all embeddings; 0 without a row, an error if lengths differ."""
    least, most = rows.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if least != most:
        raise ValueError(f"embeddings have from {least} to {most} entries")
    return least or 0


def scaled(column: pa.Array, factor: int, width: int) -> np.ndarray:
    """floor(factor * entry) of a batch of embeddings, a row each, as 64-bit integers."""
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * factor)
    if x.size and np.abs(x).max() >= LARGEST:
        raise ValueError(f"an entry times {factor} is beyond {LARGEST}")
    return x.astype(np.int64).reshape(-1, width)
