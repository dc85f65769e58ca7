"""Table functions for SQL text."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf


class ShiftGrid:
    """All (dx, dy) on a square grid of trial shifts."""

    def eval(self, low: float, high: float, step: float) -> Iterator[tuple[float, float]]:
        count = int(round((high - low) / step)) + 1
        for i in range(count):
            for j in range(count):
                yield low + i * step, low + j * step


def register_table_functions(spark: SparkSession) -> None:
    spark.udtf.register("shift_grid", udtf(ShiftGrid, returnType="dx double, dy double"))
