"""Run fitted row-wise transforms over a file stream.

Every fitted transform is an expression or a join with a static mapping, so it
needs no state and no watermark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.columns import nan_to_null

Transform = Callable[[DataFrame], DataFrame]


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A file stream with NaN as null; the schema is the fitted table's."""
    return nan_to_null(spark.readStream.schema(schema).format(fmt).load(path))


def transform_stream(frame: DataFrame, transforms: Sequence[Transform]) -> DataFrame:
    for transform in transforms:
        frame = frame.transform(transform)
    return frame


def write_stream(frame: DataFrame, path: str, checkpoint: str, timeout: int | None = None) -> None:
    """Append everything available now to a Parquet folder, then stop."""
    query = (
        frame.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination(timeout) if timeout else query.awaitTermination()
