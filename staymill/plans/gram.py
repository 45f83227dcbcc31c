"""Cross products of many columns in one pass: partial matrices per partition, summed per cell."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_sums(df: DataFrame, columns: Sequence[str], shift: Sequence[float]) -> DataFrame:
    """Per ordered pair (i, j) the sums over rows where both columns are present:
    n, sum of x_i, sum of x_i^2 and sum of x_i * x_j, of values minus `shift`."""
    columns, at = list(columns), np.asarray(shift, dtype=float)
    p = len(columns)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((4, p, p))
        for pdf in batches:
            x = pdf[columns].to_numpy(dtype=float) - at
            v = (~np.isnan(x)).astype(float)
            x = np.where(v > 0, x, 0.0)
            total += np.stack([v.T @ v, x.T @ v, (x * x).T @ v, x.T @ x])
        i, j = np.divmod(np.arange(p * p), p)
        n, sx, sxx, sxy = total.reshape(4, -1)
        yield pd.DataFrame({"i": i, "j": j, "n": n, "sx": sx, "sxx": sxx, "sxy": sxy})

    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    cells = doubles.mapInPandas(partial, "i int, j int, n double, sx double, sxx double, sxy double")
    return cells.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sxx", "sxy")])
