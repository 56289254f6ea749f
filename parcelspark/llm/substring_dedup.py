"""Substring dedup: suffixes dealt by prefix into groups that fit in memory, with a suffix tree cut at the repeat length in each."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.texts import STEP, U64, Words, grams, mixed, slices, sliding_min, texts_of
from parcelspark.sources.tables import written


#: A document in the tables below: its id, and a hash of its text for rows that share an id but not the text.
DOC = "doc struct<id:bigint,key:bigint>"


@dataclass(frozen=True)
class Settings:
    window: int = 20
    prefix: int = 8  # words of the shortest prefix
    copies_from: int = 1_000  # runs under a prefix met more often are first reduced to different ones
    group_rows: int = 20_000  # different runs under a prefix; beyond, prefixes of whole windows take its place


def prefixes(w: Words, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, the prefix hash of each, selected hashes as (place, hash)).

    Of the short prefixes inside a window, the least hash stands for all suffixes that start in it before: equal windows choose
    equal ones, so one in seven is enough. Every place with a chosen hash is selected.
    """
    inner = settings.window - settings.prefix + 1
    at = w.windows(settings.window)
    short = grams(w.hash, settings.prefix)
    if not len(at):
        return at, np.zeros(0, U64), at
    least = sliding_min(short, inner)
    masked = np.zeros(len(short), U64)
    masked[at] = least[at]
    reached = ~sliding_min(~np.concatenate([np.zeros(inner - 1, U64), masked]), inner)
    return at, least[at], np.flatnonzero((reached == short) & (short > 0))


def selected(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc, prefix, n: the chosen prefixes of each document and how often they stand in it."""
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            for a, b in slices(texts):
                w = Words(texts[a:b])
                _, _, place = prefixes(w, settings)
                h, text = grams(w.hash, settings.prefix)[place], w.text[place]
                order = np.lexsort((h, text))
                h, text = h[order], text[order]
                new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1]))[:len(h)])
                n = np.diff(np.append(new, len(h)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).take(pa.array(text[new])), pa.array(h[new].view(np.int64)),
                     pa.array(n.astype(np.int32))], ["doc", "prefix", "n"])

    return docs.mapInArrow(choose, f"{DOC}, prefix bigint, n int")


SUFFIXES = f"large boolean, prefix bigint, {DOC}, start bigint, n bigint, words binary"
SUFFIX_NAMES = [x.split()[0] for x in SUFFIXES.split(", ")]


def suffixes(docs: DataFrame, settings: Settings) -> DataFrame:
    """Runs of windows whose prefix is met elsewhere too: large, prefix, doc, start, n (windows) and the words themselves.

    ``docs`` has doc, text, live (repeated prefixes) and large (the frequent ones of them).
    """
    size = settings.window

    def keys(lists: list, n: int) -> np.ndarray:
        text = np.repeat(np.arange(n), [len(x or ()) for x in lists]).astype(U64)
        flat = np.array([h for x in lists for h in x or ()], np.int64).view(U64)
        return mixed(flat ^ (text * STEP))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            live, large = (batch.column(i).to_pylist() for i in (2, 3))
            for a, b in slices(texts):
                w = Words(texts[a:b])
                at, prefix, _ = prefixes(w, settings)
                own = mixed(prefix ^ (w.text[at].astype(U64) * STEP))
                alive = np.isin(own, keys(live[a:b], b - a))
                big = np.isin(own, keys(large[a:b], b - a))[alive]
                place, prefix = at[alive], prefix[alive]
                new = np.append(True, (np.diff(place) != 1) | (prefix[1:] != prefix[:-1]))[:len(place)]
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(place)))
                s = place[first]
                # one blank between words, so that equal words are equal bytes
                words = [b" ".join(w.data[i:j].split()) for i, j in zip(w.start[s], w.end[s + n + size - 2])]
                text = w.text[s]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(big[first]), pa.array(prefix[first].view(np.int64)), batch.column(0).slice(a, b - a).take(pa.array(text)),
                     pa.array(s - w.first[text]), pa.array(n.astype(np.int64)), pa.array(words, pa.binary())], SUFFIX_NAMES)

    return docs.mapInArrow(emit, SUFFIXES)


def window_rows(runs: DataFrame, settings: Settings) -> DataFrame:
    """k1, k2 (128 bits of the words), doc, start: each window of ``runs`` (doc, start, words)."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(2))
            for a, b in slices(texts):
                w = Words(texts[a:b])
                at = w.windows(settings.window)
                row = w.text[at]
                k1, k2 = (grams(w.hash, settings.window, salt)[at] for salt in (0, 7))
                start = batch.column(1).slice(a, b - a).to_numpy()[row] + at - w.first[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), batch.column(0).slice(a, b - a).take(pa.array(row)),
                     pa.array(start)], ["k1", "k2", "doc", "start"])

    return runs.select("doc", "start", "words").mapInArrow(emit, f"k1 bigint, k2 bigint, {DOC}, start bigint")


def later_leaves(group: np.ndarray, ident: np.ndarray, key: np.ndarray, start: np.ndarray, texts: list[bytes], size: int) -> tuple:
    """(row, first window, windows) of runs that stand earlier too, for the rows of whole groups.

    The suffixes of a group are sorted by their first ``size`` words, named by doubling as in a suffix array; suffixes of one
    name are the leaves under one internal node of that depth. Under each node all leaves but the earliest are repeats.
    """
    w = Words(texts)
    at = w.windows(size)
    row = w.text[at]
    two = grams(w.hash, 2)
    names, have = (two if size > 1 else w.hash), 2
    while have * 2 <= size:
        names = mixed(names[:len(names) - have] * U64(0xD6E8FEB86659FD93) + names[have:])
        have *= 2
    if have < size:  # the last step overlaps
        step = size - have
        names = mixed(names[:len(names) - step] * U64(0xD6E8FEB86659FD93) + names[step:])
    node = mixed(names[at] ^ (group[row].astype(U64) * STEP))
    offset = at - w.first[row]
    place, ident, key = start[row] + offset, ident[row], key[row]
    order = np.lexsort((place, key, ident, node))
    same = np.append(False, node[order][1:] == node[order][:-1])
    first = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    # rows that repeat an id and its text have leaves at one place; none of them is later than the others
    later = np.zeros(len(at), bool)
    later[order] = same & ((ident[order] != ident[first]) | (key[order] != key[first]) | (place[order] != place[first]))
    hit = np.flatnonzero(later)
    r, o = row[hit], offset[hit]
    new = np.flatnonzero(np.append(True, (np.diff(o) != 1) | (r[1:] != r[:-1]))[:len(hit)])
    return r[new], o[new], np.diff(np.append(new, len(hit)))


def repeats_in_groups(rows: DataFrame, settings: Settings) -> DataFrame:
    """doc, start, n: runs of windows that stand earlier too, from rows sorted by prefix inside each partition."""
    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def work(table: pa.Table) -> pa.RecordBatch:
            prefix, start = (table.column(c).to_numpy() for c in ("prefix", "start"))
            doc = table.column("doc").combine_chunks()
            ident, key = (doc.field(c).to_numpy() for c in ("id", "key"))
            r, o, n = later_leaves(prefix.view(U64), ident, key, start, texts_of(table.column("words")), settings.window)
            return pa.RecordBatch.from_arrays([doc.take(pa.array(r)), pa.array(start[r] + o), pa.array(n.astype(np.int64))],
                                              ["doc", "start", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            last = int(np.searchsorted(key, key[-1]))  # where the last, maybe unfinished, group begins
            if last:
                table = pa.Table.from_batches([*held, batch.slice(0, last)])
                held = []
                yield work(table)
            elif held and held[-1].column(0)[0].as_py() != key[0]:
                yield work(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(last))
        if held:
            yield work(pa.Table.from_batches(held))

    return rows.mapInArrow(trees, f"{DOC}, start bigint, n bigint")


def repeated_runs(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc, start, n: runs of ``n`` windows from word ``start`` on that also start earlier in the corpus.

    ``docs`` has doc (id and key) and text without nulls. Copies of a whole text are settled by text; prefixes are counted over all documents, and only suffixes under a
    prefix that is met again are dealt out, with their words. Under a frequent prefix, equal runs are first reduced to the
    earliest; a prefix that is still too frequent for one task is lengthened to whole windows, whose earliest places are found by
    aggregation.
    """
    text_key = F.md5(F.col("text").cast("binary"))
    kinds = written(docs.select("doc", text_key.alias("kind")))
    first = kinds.groupBy("kind").agg(F.min("doc").alias("first_doc"), F.count(F.lit(1)).alias("copies"))
    copies = written(kinds.join(first.filter(F.col("copies") > 1), "kind").filter(F.col("doc") != F.col("first_doc"))
                     .select(F.col("doc").alias("copy_doc")))
    own = docs.select("doc", F.col("text").cast("binary").alias("text")) \
        .join(copies, F.col("doc") == F.col("copy_doc"), "left_anti")
    chosen = written(selected(own, settings))
    met = chosen.groupBy("prefix").agg(F.sum("n").alias("places")).filter(F.col("places") > 1)
    live = chosen.join(met, "prefix").groupBy(F.col("doc").alias("l_doc")).agg(
        F.collect_list("prefix").alias("live"),
        F.collect_list(F.when(F.col("places") > settings.copies_from, F.col("prefix"))).alias("large"))
    found = written(suffixes(own.join(live, F.col("doc") == F.col("l_doc")).select("doc", "text", "live", "large"), settings))
    # runs of the same words under a frequent prefix: the earliest stands for them, all others are repeats from end to end
    frequent = found.filter("large").withColumn("kind", F.md5("words"))
    different = written(frequent.groupBy("prefix", "kind").agg(
        F.min(F.struct("doc", "start", "n", "words")).alias("first"), F.count(F.lit(1)).alias("copies")))
    same = different.filter(F.col("copies") > 1).select(
        F.col("prefix").alias("s_prefix"), F.col("kind").alias("s_kind"), F.col("first.doc").alias("f_doc"), F.col("first.start").alias("f_start"))
    later = frequent.join(same, (F.col("prefix") == F.col("s_prefix")) & (F.col("kind") == F.col("s_kind"))) \
        .filter((F.col("doc") != F.col("f_doc")) | (F.col("start") != F.col("f_start"))).select("doc", "start", "n")
    too_many = different.groupBy(F.col("prefix").alias("m_prefix")).count().filter(F.col("count") > settings.group_rows)
    spread = different.select("prefix", "first.*")
    on_prefix = F.col("prefix") == F.col("m_prefix")
    trees = found.filter(~F.col("large")).select("prefix", "doc", "start", "n", "words") \
        .unionByName(spread.join(too_many, on_prefix, "left_anti"))
    in_groups = repeats_in_groups(
        trees.select("prefix", "doc", "start", "words").repartition("prefix").sortWithinPartitions("prefix"), settings)
    windows = window_rows(spread.join(too_many, on_prefix, "left_semi"), settings)
    earliest = windows.groupBy("k1", "k2").agg(F.min(F.struct("doc", "start")).alias("first"), F.count(F.lit(1)).alias("n")) \
        .filter(F.col("n") > 1).select("k1", "k2", "first")
    in_large = windows.join(earliest, ["k1", "k2"]).filter(F.struct("doc", "start") != F.col("first")) \
        .select("doc", "start", F.lit(1).cast("long").alias("n"))
    whole = copies.select(F.col("copy_doc").alias("doc"), F.lit(0).cast("long").alias("start"), F.lit(-1).cast("long").alias("n"))
    return in_groups.union(later).union(in_large).union(whole)


DONE = "doc_id bigint, n_words bigint, n_removed bigint, kept binary"


def dedup_substrings(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (the words left, joined by one space).

    A word goes if a window of 20 words over it also starts earlier: in a smaller doc_id, or before in the same document. Windows
    are judged on the input. Texts of fewer words, null texts and rows without an id lose nothing. Rows that share an id but not
    the text are documents of their own, in the order of a hash of their texts; equal rows stay or go alike. Only doc_id and
    text are read.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("key")).alias("doc"),
                       text.alias("text"))
    runs = repeated_runs(rows.filter(F.col("doc_id").isNotNull()).select("doc", "text"), settings) \
        .groupBy(F.col("doc").alias("r_doc")).agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("ns"))
    joined = rows.join(runs, F.col("doc") == F.col("r_doc"), "left").select(
        "doc_id", F.col("text").cast("binary").alias("text"), "starts", "ns")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = settings.window
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, starts, ns in zip(texts_of(batch.column(1)), *(batch.column(i).to_pylist() for i in (2, 3))):
                words = text.split()
                gone = 0
                if starts and len(words) >= size:
                    change = np.zeros(len(words) + 1, np.int64)
                    for s, n in zip(starts, ns):
                        change[s] += 1
                        change[len(words) if n < 0 else s + n + size - 1] -= 1
                    covered = np.cumsum(change[:-1]) > 0
                    gone = int(covered.sum())
                    words_left = [x for x, c in zip(words, covered.tolist()) if not c]
                else:
                    words_left = words
                counts.append(len(words))
                removed.append(gone)
                kept.append(b" ".join(words_left))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(cut, DONE)


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    done = dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), places AS (
  SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS gram FROM d, unnest(range(1, len(words) - 18)) AS t(i)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) AS k FROM places) WHERE k > 1
), gone AS (
  SELECT doc_id, list(DISTINCT i + k) AS gone_at FROM later, unnest(range(20)) AS t(k) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone_at), 0)::BIGINT AS n_removed,
  sha256(array_to_string(list_filter(words, lambda w, i: NOT list_contains(coalesce(gone_at, []), i)), ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""
