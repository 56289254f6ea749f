"""Spelling variants: words one edit apart by an asymmetric q-chunk join, followed to the spelling most in use.

Of two words one edit apart, the shorter (of equal lengths the smaller) gives two disjoint chunks, its halves. The edit touches at
most one of them; the other stands in the longer word unchanged, the first half in its place and the second shifted by the
difference of the lengths, so by one at most. The longer word gives its positional grams of those sizes, and equal chunks
and grams meet. Where too many words share a chunk, the other half, which must hold the edit, is halved again, and the chunk grows
by the part that stays: no pair is lost, and words meet only that agree ever more closely.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.columns import lower_ascii
from parcelspark.sources.tables import written


@dataclass(frozen=True)
class Settings:
    least_length: int = 6  # code points of a word, at least
    least_n: int = 5  # occurrences of a word, at least
    factor: int = 5  # a word's form occurs at least so many times as often
    typo_every: int = 0  # if above 0, a run loses a letter where its crc32 is a multiple of this
    pairs_of_key: int = 256  # words of a chunk that make more pairs meet by a longer one


def word_counts(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """word, n: runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF), A-Z in lower case, of the wanted length and number.

    With ``typo_every`` a run whose crc32 (of ``<doc_id>:<run>``) it divides loses the letter at crc32 modulo length first.
    Null and empty texts have no words; a row without an id has an empty one there; each row counts, repeated or not.
    """
    # a run must have the length before a letter goes, so shorter ones need not be listed
    runs = F.regexp_extract_all("text", F.lit(f"([A-Za-zÀ-ÿ]{{{max(1, settings.least_length)},}})"), 1)
    found = docs.select("doc_id", F.explode(runs).alias("run")).select("doc_id", lower_ascii(F.col("run")).alias("run"))
    word = F.col("run")
    if settings.typo_every:
        h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
        at = (h % F.length(word)).cast("int")
        shorter = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
        word = F.when(h % settings.typo_every == 0, shorter).otherwise(word)
    return found.select(word.alias("word")).filter(F.length("word") >= settings.least_length) \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= settings.least_n)


def _left(text: Column, n: Column) -> Column:
    return F.substring(text, F.lit(1), n)


def _after(text: Column, n: Column) -> Column:
    """What follows the first ``n`` code points."""
    return F.substring(text, n + 1, F.length(text))


def _keys(rows: DataFrame, level: int, length: Column) -> DataFrame:
    """``rows`` (word, regions, side) with the key of each region of a chunk word of ``length``: the word without the region.

    Region i of level l is the stretch from floor(length * i / 2^l) to floor(length * (i + 1) / 2^l).
    """
    longer = F.length("word") - F.col("length")
    size, region = F.col("length").cast("long"), F.col("region").cast("long")
    low = F.floor(size * region / F.lit(1 << level)).cast("int")
    high = F.floor(size * (region + 1) / F.lit(1 << level)).cast("int")
    key = F.xxhash64("length", "region", _left(F.col("word"), F.col("low")), _after(F.col("word"), F.col("high") + F.col("longer")))
    return rows.withColumn("length", length).withColumn("region", F.explode("regions")) \
        .withColumns({"low": low, "high": high, "longer": longer}).filter(F.col("low") < F.col("high")) \
        .select("word", "length", "region", key.alias("key"), (F.col("high") - F.col("low")).alias("open"))


def near_words(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """a, b: all pairs of different ``words`` (a column ``word``) one insertion, deletion or replacement apart, both ways round.

    Repeated words and nulls count once and never; a replaced letter is a code point. Words of one letter take part.
    """
    listed = words.select("word").filter(F.length("word") > 0).distinct()
    halves = F.array(F.lit(0), F.lit(1))
    size = F.length("word")
    chunks = _keys(listed.withColumn("regions", halves), 1, size)
    # a word meets chunk words of its own length and of one less
    lengths = listed.withColumn("own", F.explode(F.array(size, size - 1))).filter(F.col("own") > 0)
    grams = _keys(lengths.withColumn("regions", halves), 1, F.col("own"))
    near, level = None, 1
    while True:
        chunks, grams = written(chunks), written(grams)
        met = chunks.groupBy("key").agg(F.count(F.lit(1)).alias("n_chunks"), F.max("open").alias("most_open")) \
            .join(grams.groupBy("key").agg(F.count(F.lit(1)).alias("n_grams")), "key")
        # a stretch of one letter can't be halved: words that agree in all else are near, so their pairs are results
        crowded = (F.col("n_chunks") * F.col("n_grams") > settings.pairs_of_key) & (F.col("most_open") > 1)
        keys = written(met.select("key", crowded.alias("crowded")))
        few, many = keys.filter(~F.col("crowded")).select("key"), keys.filter("crowded").select("key")
        a = chunks.join(few, "key", "left_semi").select("key", F.col("word").alias("a"))
        b = grams.join(few, "key", "left_semi").select("key", F.col("word").alias("b"))
        smaller = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
        pairs = a.join(b, "key").filter(smaller & (F.levenshtein("a", "b", 1) == 1)).select("a", "b")
        near = pairs if near is None else near.unionByName(pairs)
        if many.isEmpty():
            break
        level += 1
        parts = F.array(F.col("region") * 2, F.col("region") * 2 + 1)
        chunks, grams = (_keys(x.join(many, "key", "left_semi").select("word", F.col("length").alias("own"), parts.alias("regions")),
                               level, F.col("own")) for x in (chunks, grams))
    once = near.distinct()
    return once.unionByName(once.select(F.col("b").alias("a"), F.col("a").alias("b")))


def group_variants(counts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``counts`` (word, n; words distinct): word, n, n_near, form, form_n, root.

    form is the near word of the largest n (ties: the smallest by code points) if that is ``factor`` times the word's n or
    more. Since n grows with each form, following them ends; root is where, or the word itself.
    """
    counts = written(counts.select("word", "n"))
    links = near_words(counts, settings)
    other = counts.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    best = links.join(other, "b").groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("word"))).alias("best"))
    formed = -F.col("best.less") >= settings.factor * F.col("n")
    rows = written(counts.join(best, F.col("word") == F.col("a"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("best.word")).alias("form"), F.when(formed, -F.col("best.less")).alias("form_n")))
    # each round doubles the steps that a pointer takes, and words without a form need none
    steps = written(rows.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    while True:
        ahead = steps.select(F.col("word").alias("at"), F.col("root").alias("next"))
        jumped = written(steps.join(ahead, F.col("root") == F.col("at"), "left")
                         .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        steps = jumped.select("word", "root")
        if jumped.filter("moved").isEmpty():
            break
    return rows.join(steps.withColumnRenamed("word", "of"), F.col("word") == F.col("of"), "left") \
        .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    settings = Settings(typo_every=199)
    return group_variants(word_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), settings), settings)
