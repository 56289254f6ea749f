"""Benchmark decontamination: word windows of test items, found in training documents and cut out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.columns import covered, let, plain_words, window_hashes

#: A window table of at most so many rows is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 500_000


def item_windows(benchmark: DataFrame, size: int = 10) -> DataFrame:
    """Distinct windows of the items: key, n (words), window (array), items (sorted ids).

    An item of fewer words than ``size`` is one window, one without words is none.
    """
    words = benchmark.select("item_id", plain_words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    cut = words.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, size))).alias("window"))
    return cut.groupBy("window").agg(F.array_sort(F.collect_set("item_id")).alias("items")).select(
        _key(F.col("window"), size).alias("key"), F.size("window").alias("n"), "window", "items")


def _key(window: Column, size: int) -> Column:
    """The hash that ``window_hashes`` gives a window of at most ``size`` words."""
    return F.coalesce(*[F.when(F.size(window) == n, F.get(window_hashes(window, n), F.lit(0))) for n in range(1, size + 1)])


def find_hits(docs: DataFrame, benchmark: DataFrame, size: int = 10, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, spans (start from 0, length; by start), items (sorted ids).

    Rows equal in doc_id and text give one row; rows that share an id with other texts give one each (text_key tells
    them apart). Null and empty texts have no words. Only doc_id and text are read. The corpus is scanned once: word
    windows meet the window table by hash, hits are compared word by word, and only hits and one row per document are shuffled.
    """
    windows = item_windows(benchmark, size)
    lengths = sorted(r.n for r in windows.select("n").distinct().collect())  # at most ``size`` numbers
    small = windows.limit(broadcast_rows + 1).count() <= broadcast_rows
    key = F.xxhash64("text")
    words = docs.select("doc_id", key.alias("text_key"), plain_words(F.col("text")).alias("words"))
    none = F.struct(F.lit(-1).alias("start"), F.lit(0).alias("n"), F.lit(None).cast("long").alias("key"))

    def of_length(n: int) -> Column:
        return F.transform(window_hashes(F.col("words"), n), lambda h, i: F.struct(
            i.alias("start"), F.lit(n).alias("n"), h.alias("key")))

    def places(arrays: list[Column]) -> DataFrame:
        return words.select("doc_id", "text_key", "words", F.explode(F.concat(*arrays)).alias("p")) \
            .select("doc_id", "text_key", "words", F.col("p.start").alias("start"), F.col("p.n").alias("n"), F.col("p.key").alias("key"))

    arrays = [of_length(n) for n in lengths]
    table = windows.select("key", "window", "items")
    gram = F.slice("words", F.col("start") + 1, F.col("n"))
    if small:
        # one place that never matches stands for the document itself
        met = places([F.array(none), *arrays]).join(F.broadcast(table), "key", "left")
        hits = met.select(
            "doc_id", "text_key", "start", "n",
            F.when(F.col("start") < 0, F.size("words")).alias("n_words"),
            F.when((F.col("start") >= 0) & F.col("window").isNotNull() & (gram == F.col("window")), F.col("items")).alias("items")) \
            .filter((F.col("start") < 0) | F.col("items").isNotNull())
    else:
        # a window is shuffled with its own words only, and the documents' own rows stay out of the join
        met = places(arrays).select("doc_id", "text_key", "start", "n", "key", gram.alias("gram")).join(table, "key")
        hits = met.filter(F.col("gram") == F.col("window")) \
            .select("doc_id", "text_key", "start", "n", F.lit(None).cast("int").alias("n_words"), "items") \
            .unionByName(words.select("doc_id", "text_key", F.lit(-1).alias("start"), F.lit(0).alias("n"),
                                      F.size("words").alias("n_words"), F.lit(None).alias("items")))
    # a span as one number in the order of (start, length), so that a set of them needs no comparison by pairs
    span = F.when(F.col("start") >= 0, F.col("start").cast("long") * (size + 1) + F.col("n"))
    return hits.groupBy("doc_id", "text_key").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.transform(F.array_sort(F.collect_set(span)), lambda x: F.struct(
            F.floor(x / (size + 1)).cast("int").alias("start"), (x % (size + 1)).cast("int").alias("length"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", size: int = 10) -> DataFrame:
    """``docs`` without what they share with the benchmark; columns as they came.

    ``documents`` leaves out every document with a hit; ``spans`` cuts the hit words, with what follows each up to the
    next word, out of the text. Rows without a hit stay as they are, null texts and ids too.
    """
    found = find_hits(docs, benchmark, size).filter(F.size("spans") > 0) \
        .select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), F.col("spans").alias("hit_spans"))
    rows = docs.select(F.struct("*").alias("doc"))
    same = rows.doc.doc_id.eqNullSafe(found.hit_id) & (F.xxhash64(rows.doc.text) == found.hit_key)
    if mode == "documents":
        return rows.join(found, same, "left_anti").select("doc.*")
    if mode != "spans":
        raise ValueError(f"mode {mode!r}")
    text = F.col("doc.text")
    pieces = F.regexp_extract_all(text, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)"), 1)
    hit = F.flatten(F.transform("hit_spans", lambda s: F.sequence(s.start, s.start + s.length - 1)))
    left = let(pieces, lambda p: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(p) - 1), hit), lambda i: F.get(p, i)))
    cut = F.concat(F.regexp_extract(text, r"^([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)", 1), F.array_join(left, ""))
    joined = rows.join(found, same, "left")
    return joined.select(*[
        (F.when(F.col("hit_spans").isNull(), text).otherwise(cut) if c == "text" else F.col(f"doc.`{c}`")).alias(c)
        for c in docs.columns])


def op1_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id", "n_words", covered(F.col("spans")).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


OP1_SQL = r"""
WITH lowered AS (
  SELECT item_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i:i + 9], ' ') AS gram
  FROM lowered, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS t(i) WHERE len(words) > 0
), d AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents
), places AS (
  SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS gram
  FROM d, (SELECT DISTINCT n FROM windows) AS l, unnest(range(1, len(words) - n + 2)) AS t(i)
), hits AS (
  SELECT doc_id, i, p.n, item_id FROM places p JOIN windows w ON p.n = w.n AND p.gram = w.gram
), by_word AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit
  FROM (SELECT DISTINCT doc_id, i, n FROM hits), unnest(range(n)) AS t(k) GROUP BY doc_id
), by_item AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN by_word USING (doc_id) LEFT JOIN by_item USING (doc_id)
"""
