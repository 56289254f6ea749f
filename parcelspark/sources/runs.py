"""Tables kept in parts, one per run or version, each replaced as a whole and visible only once it is complete.

A part is written to a folder of its own for every attempt; when all its tables are written, one row in the ``_ready`` table
names the attempt. Readers take the newest named attempt of each part, so a run that died half-way, or is still
writing, is not there for them, and a rerun takes the place of the earlier one, also when it has no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

READY = "part string, attempt string, turn bigint"


def _ready(spark: SparkSession, root: str) -> DataFrame:
    """part, attempt: the newest complete attempt of each part; one row a part, so it is small."""
    try:
        named = spark.read.schema(READY).parquet(f"{root}/_ready")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        named = spark.createDataFrame([], READY)
    return named.groupBy("part").agg(F.max(F.struct("turn", "attempt")).alias("newest")) \
        .select("part", F.col("newest.attempt").alias("attempt"), F.col("newest.turn").alias("turn"))


def write_part(tables: Mapping[str, DataFrame], root: str, part: str) -> None:
    """Write all ``tables`` (by name) of one part below ``root``; they become visible together, in the place of an earlier attempt."""
    if not tables or not part or "/" in part:
        raise ValueError(f"a part needs a table and a name without a slash: {part!r}")
    attempt = uuid.uuid4().hex
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}/{part}/{attempt}")
    turn = _ready(spark, root).agg(F.coalesce(F.max("turn"), F.lit(0)) + 1).first()[0]
    spark.createDataFrame([(part, attempt, turn)], READY).coalesce(1).write.mode("append").parquet(f"{root}/_ready")


def parts_of(spark: SparkSession, root: str) -> list[str]:
    """The complete parts, in text order."""
    return sorted(r.part for r in _ready(spark, root).select("part").collect())


def read_part(spark: SparkSession, root: str, name: str, part: str) -> DataFrame:
    """One table of a complete part."""
    row = _ready(spark, root).filter(F.col("part") == part).first()
    if row is None:
        raise ValueError(f"no complete part {part!r} below {root}")
    return spark.read.parquet(f"{root}/{name}/{part}/{row.attempt}")


def read_parts(spark: SparkSession, root: str, name: str, schema, before: str | None = None, column: str = "run") -> DataFrame:
    """A table of all complete parts (those before ``before`` in text order, if given), with the part in ``column``.

    ``schema`` is that of the table: columns an older part lacks are NULL, and without any part the table is empty.
    """
    kept = [(r.part, r.attempt) for r in _ready(spark, root).collect() if before is None or r.part < before]
    empty = spark.createDataFrame([], schema)
    if not kept:
        return empty.withColumn(column, F.lit("").cast("string"))
    read = spark.read.schema(empty.schema).parquet(*[f"{root}/{name}/{p}/{a}" for p, a in sorted(kept)])
    # the folder names the part: .../part/attempt/file
    return read.withColumn(column, F.url_decode(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -3)))
