"""Reading and writing tables.

A target with a slash or a scheme is a parquet folder, any other name is a catalog table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.session import scratch_path
from parcelspark.sources.runs import parts_of, read_part, write_part
from parcelspark.sources.schemas import DIMENSIONS, LISTINGS


def _is_path(target: str) -> bool:
    return "/" in target


def read_target(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target) if _is_path(target) else spark.table(target)


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    """Scan nested listings with the declared schema (no inference; unused fields are pruned, nested ones too)."""
    return spark.read.schema(LISTINGS).parquet(path)


def read_dimension(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """A lookup table: below ``root`` with its declared schema, else from the catalog.

    No broadcast hint: Spark compares its size with ``spark.sql.autoBroadcastJoinThreshold`` and picks the join.
    """
    if root is None:
        return spark.table(name)
    reader = spark.read.schema(DIMENSIONS[name]) if name in DIMENSIONS else spark.read
    return reader.parquet(f"{root}/{name}.parquet")


def replace_table(df: DataFrame, target: str) -> DataFrame:
    """Create or replace ``target`` from ``df`` and return it as read back."""
    writer = df.write.mode("overwrite")
    writer.parquet(target) if _is_path(target) else writer.saveAsTable(target)
    return read_target(df.sparkSession, target)


def stage(df: DataFrame, name: str | None = None) -> DataFrame:
    """Keep a stage for repeated use in this session, as a temporary view too when a name is given."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    if name:
        kept.createOrReplaceTempView(name)
    return kept


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table of its own in the shared work folder: computed once, whatever reads it later.

    Unlike ``persist`` it outlives lost executors, cuts the plan, and gives Spark the true size for the joins that
    follow.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_aligned(df: DataFrame, target: str, drop: Sequence[str] = (), fill: Sequence[str] = ()) -> None:
    """Append to ``target``, columns matched by name and cast to the target's types.

    Columns the target lacks must be named in ``drop`` to be left out, those ``df`` lacks in ``fill`` to become NULL: any other
    difference raises, as it is more likely a mistake.
    """
    schema = read_target(df.sparkSession, target).schema
    have, wanted = set(df.columns), {f.name for f in schema.fields}
    unknown, missing = sorted(have - wanted - set(drop)), sorted(wanted - have - set(fill))
    if unknown or missing:
        raise ValueError(f"{target}: columns it does not have: {unknown}; columns that are missing: {missing}")
    aligned = df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])
    writer = aligned.write.mode("append")
    writer.parquet(target) if _is_path(target) else writer.saveAsTable(target)


def tables_like(spark: SparkSession, pattern: str, nonempty: bool = True) -> DataFrame:
    """Tables and views whose name fits a LIKE pattern, with row counts, the biggest first.

    The list of names is driver metadata; the counts of all of them come from one job.
    """
    names = [t.name for t in spark.catalog.listTables()]
    listed = spark.createDataFrame([(n,) for n in names], "table_name string")
    fitting = [r.table_name for r in listed.filter(F.col("table_name").like(pattern)).collect()]
    empty = spark.createDataFrame([], "table_name string, row_count bigint")
    counts = [spark.table(n).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
              for n in fitting]
    found = reduce(DataFrame.unionByName, counts, empty)
    if nonempty:
        found = found.filter(F.col("row_count") > 0)
    return found.orderBy(F.desc("row_count"), "table_name")


def snapshot_version(df: DataFrame, root: str, name: str, version: int) -> DataFrame:
    """Write ``df`` as one version of a named dataset; writing the same version again replaces it.

    A version is there for readers only once it is complete; until then they see the one before.
    """
    write_part({"data": df}, f"{root}/{name}", str(int(version)))
    return read_version(df.sparkSession, root, name, version)


def read_version(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A complete version, the latest when none is named. Only the folder of that version is scanned."""
    if version is None:
        version = max((int(p) for p in parts_of(spark, f"{root}/{name}")), default=0)
    return read_part(spark, f"{root}/{name}", "data", str(int(version))).withColumn("version", F.lit(int(version)))


def score_to_table(model, df: DataFrame, passthrough: list[str], target: str) -> DataFrame:
    """Score a table into a table, keeping the passthrough columns beside the prediction."""
    return replace_table(model.transform(df).select(*passthrough, "prediction"), target)
