"""What the operators on embeddings share: which rows take part, and components as whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components are counted in this part of 1.
SCALE = 256
#: Whole numbers beyond this are refused, as doubles would no longer tell them apart.
LIMIT = 2**52


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is there and has no null or non-finite component."""
    finite = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    return df.where(F.col(vector).isNotNull() & finite)


def whole(vector: str = "embedding") -> Column:
    """Each component c as floor(256 c), c as double; beyond ``LIMIT`` an error."""

    def one(c: Column) -> Column:
        scaled = F.floor(c.cast("double") * SCALE)
        return F.when(F.abs(scaled) <= LIMIT, scaled).otherwise(F.raise_error(F.lit("a component is too large to be a whole number of 52 bits")).cast("long"))

    return F.transform(vector, one)


def padded(x: str, width: int) -> Column:
    """Vectors of one length: what a shorter one lacks counts as 0."""
    return F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(x)))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A batch's vectors of one length as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
