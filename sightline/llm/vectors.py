"""Which rows of a table of vectors take part, and how they are dealt out."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_flag(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, vector, usable) of every row: usable with an id and a vector neither null nor zero, all of it finite."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col("id").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    return rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).withColumn("usable", F.coalesce(good, F.lit(False)))


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, vector) of the usable rows."""
    return with_flag(rows, id_col, vector_col).where("usable").drop("usable")


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as the rows of a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)
