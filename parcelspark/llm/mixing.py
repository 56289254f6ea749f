"""Mixing sources to target weights with distributed prefix sums over hash-random keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm.columns import space_words
from parcelspark.sources.tables import written

#: Documents of one source that a task sorts at a time.
RANGE_ROWS = 5_000


def source_targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """One row per source: source, source_size, n_docs, target.

    ``sizes`` has source and size. Weights go round over the sources by code point, null last. A target stops at ``most``
    times the source's size and the rest is shared out again by weight until none is above. With the sources sorted by
    cap / weight, those that stop are the first ones, so one running sum finds the level of all others. The table has one row
    per source; its two windows run over sources, never over documents.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    given = F.array(*[F.lit(float(w)) for w in weights])
    ranked = by_source.withColumn("weight", F.get(given, (F.row_number().over(order) - 1) % len(weights))) \
        .withColumn("cap", most * F.col("source_size"))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before, all_rows = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    # level: what is left for the sources from this one on, for each unit of their weight
    left = F.least(share * F.sum("source_size").over(all_rows), F.sum("cap").over(all_rows)) \
        - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = ranked.withColumn("level", left / open_weight)
    # the level stands at the first source that stays below its cap, and holds for all after it
    stays = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    final = F.first(stays, ignorenulls=True).over(all_rows)
    return level.withColumn("final", final).select(
        "source", "source_size", "n_docs",
        F.least("cap", F.coalesce(F.col("final") * F.col("weight"), F.col("cap"))).alias("target"))


def mix(docs: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0, seed: int = 17) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size (words), source_size, target, taken (words, repeats counted).

    Within a source, documents follow a hash-random key. Each whole epoch of a source takes all its documents once; of the
    rest of the budget, documents take their words in key order until it is used up, the last one in part, so that a source's
    sum is its target without the fraction. The keys of a source are dealt into ranges of even width, as many as its
    documents need; sums of ranges and of rows inside a range add up to the prefix sum, so no task meets a whole source. Null
    and empty texts have size 0 and take nothing; null sources are one source. Rows equal in id, source and size are
    exchangeable. Reruns agree. Only doc_id, source and text are read.
    """
    measured = docs.select("doc_id", "source", F.size(space_words(F.col("text"))).cast("long").alias("size"),
                           F.xxhash64(F.lit(seed), "doc_id", "source").alias("key"))
    sizes = written(measured)
    targets = source_targets(sizes, weights, share, most)
    ranges = F.greatest(F.ceil(F.col("n_docs") / RANGE_ROWS), F.lit(1))
    # a key as a share of all keys, from 0 to below 1
    share_of_keys = F.shiftrightunsigned("key", 11) / F.lit(float(2 ** 53))
    budget = F.floor("target")
    size0 = F.greatest(F.col("source_size"), F.lit(1))
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target", ranges.alias("ranges"),
                       F.floor(budget / size0).alias("epochs"), (budget % size0).alias("rest"))
    t = written(t)  # Spark plans the join by its true size: with few sources no document is shuffled for it
    keyed = sizes.join(t, F.col("source").eqNullSafe(F.col("t_source"))) \
        .withColumn("part", F.floor(share_of_keys * F.col("ranges")))
    sums = keyed.groupBy("t_source", "part").agg(F.sum("size").alias("part_size"))
    before = Window.partitionBy("t_source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("t_source").alias("o_source"), F.col("part").alias("o_part"),
                          F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("t_source", "part").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0))) \
        .join(offsets, F.col("t_source").eqNullSafe(F.col("o_source")) & (F.col("part") == F.col("o_part")))
    start = F.col("offset") + F.col("ahead")
    once_more = F.greatest(F.lit(0), F.least("size", F.col("rest") - start))
    return placed.select("doc_id", "source", "size", "source_size", "target",
                         (F.col("epochs") * F.col("size") + once_more).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights: list[float], share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``docs`` that the mix takes, with size, source_size, target and taken.

    Documents that take nothing go. A column of ``docs`` that has one of the four names raises. Rows that share id, source and
    size each take what one of them is due, so that a source's sum is its target here too. Rows are numbered by a hash of
    their text; rows alike in that as well are exchangeable.
    """
    added = ["size", "source_size", "target", "taken"]
    clash = sorted(set(added) & set(docs.columns))
    if clash:
        raise ValueError(f"columns that the mix adds are there already: {clash}")
    alike = Window.partitionBy("doc_id", "source", "size")
    taken = mix(docs, weights, share, most).withColumn("copy", F.row_number().over(alike.orderBy("taken")))
    taken = written(taken.filter(F.col("taken") > 0).select(
        F.col("doc_id").alias("m_id"), F.col("source").alias("m_source"), "size", "source_size", "target", "taken", "copy"))
    words = F.size(space_words(F.col("text"))).cast("long")
    numbered = docs.select(F.struct("*").alias("doc"), "doc_id", "source", words.alias("words"), F.xxhash64("text").alias("text_key")) \
        .withColumn("place", F.row_number().over(Window.partitionBy("doc_id", "source", "words").orderBy("text_key")))
    same = F.col("doc_id").eqNullSafe(F.col("m_id")) & F.col("source").eqNullSafe(F.col("m_source")) \
        & (F.col("words") == F.col("size")) & (F.col("place") == F.col("copy"))
    return numbered.join(taken, same).select("doc.*", *added)


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), [5, 2, 1])
