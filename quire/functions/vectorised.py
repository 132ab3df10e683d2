"""Arrow-batched column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


#: Bytes of one Arrow batch handed to Python.
BATCH_BYTES = 4 << 20


def batched(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session's Python stages by bytes, for rows that hold blocks."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def vectorised(ddl: str) -> Callable[[Callable], Callable[..., Column]]:
    """Make a function of pandas series a function of columns; the type is parsed when first called, with a session."""

    def wrap(f: Callable) -> Callable[..., Column]:
        def column(*columns: Column) -> Column:
            return F.pandas_udf(f, ddl)(*columns)

        column.__name__, column.__doc__ = f.__name__, f.__doc__
        return column

    return wrap
