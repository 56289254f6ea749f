"""The same steps for several parameter sets."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.operators.setops import union_all


def run_for_each(build: Callable[..., DataFrame], params: Mapping[str, Mapping], column: str = "run") -> DataFrame:
    """One lazy plan over all parameter sets, marked by name. Written with ``partitionBy(column)`` it gives one folder
    per set, and Spark runs the parts of the union side by side."""
    return union_all(*[build(**p).withColumn(column, F.lit(name)) for name, p in params.items()])
