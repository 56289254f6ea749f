"""Line dedup: a segment-partition edit join over all lines, verified by banded bit-parallel edit distance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.graph import components
from parcelspark.llm.near_dedup import NODE, node_of
from parcelspark.llm.texts import KEEP, SLICE_BYTES, STEP, U64, mixed, slices, texts_of, times
from parcelspark.sources.tables import written

FACTOR = 0x5851F42D4C957F2D
INVERSE = pow(FACTOR, -1, 2 ** 64)


@dataclass(frozen=True)
class Settings:
    edits: int = 2  # over UTF-8 bytes
    least_bytes: int = 20  # shorter lines are left alone


class Lines:
    """The lines of ``least`` bytes and more of several texts: text, no (in its text), start, end; without copies if asked."""

    def __init__(self, texts: list[bytes], least: int):
        self.data = b"\n".join(texts) + b"\n" * 9
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        breaks = np.flatnonzero(np.frombuffer(self.data, np.uint8)[:ends[-1]] == 10)
        start = np.append(0, breaks[:-1] + 1)
        text = np.searchsorted(ends, start, "right")
        first = np.searchsorted(text, np.arange(len(texts)))
        no = np.arange(len(start)) - first[text]
        long = breaks - start >= least
        self.text, self.no, self.start, self.end = text[long], no[long], start[long], breaks[long]
        self.key = line_hashes(self.data, self.start, self.end)


def line_hashes(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each stretch of ``data`` from the sum of its scrambled (eight bytes, place) pieces, all stretches at once.

    ``data`` must go on for eight bytes after the last one.
    """
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    if not len(start):
        return np.zeros(0, U64)
    pieces = np.maximum((end - start + 7) // 8, 1)
    first = np.cumsum(pieces) - pieces
    place = np.arange(pieces.sum()) - np.repeat(first, pieces)
    at = np.repeat(start, pieces) + 8 * place
    piece = eight[at] & KEEP[np.minimum(np.repeat(end, pieces) - at, 8)]
    sums = np.add.reduceat(mixed(piece + mixed((place.astype(U64) + U64(1)) * STEP)), first)
    return mixed(sums + (end - start).astype(U64) * STEP)


@lru_cache(maxsize=2)
def _powers(n: int, factor: int) -> np.ndarray:
    out = np.full(n, factor, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int, factor: int) -> np.ndarray:
    """1, factor, factor^2, ...: worked out once for all slices of usual size."""
    usual = SLICE_BYTES + 4096
    return _powers(usual, factor)[:n] if n <= usual else _powers.__wrapped__(n, factor)


def _mark_table() -> np.ndarray:
    """For each two bytes (the first one low): the bit of the first byte's class and the bit of the pair's class."""
    first, second = np.arange(1 << 16, dtype=np.uint32) & 255, np.arange(1 << 16, dtype=np.uint32) >> 8
    pair = (first * np.uint32(31) + second) * np.uint32(0x85EBCA6B) >> np.uint32(27)
    return SINGLE[first] | U64(1) << (U64(32) + pair.astype(U64))


SINGLE = U64(1) << ((np.arange(256, dtype=np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(27)) & np.uint32(31)).astype(U64)
MARKS = _mark_table()


def parities(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of each stretch, 32 parities of bytes and 32 of pairs of bytes, by class. Stretches are not empty.

    One edit changes two of the first and four of the second at most, so they tell far lines apart without losing near ones.
    """
    two = np.ndarray((len(data) - 1,), "<u2", data, strides=(1,))
    run = np.append(U64(0), np.bitwise_xor.accumulate(MARKS[two]))
    return run[end - 1] ^ run[start] ^ SINGLE[np.frombuffer(data, np.uint8)[end - 1]]


def segment_bounds(length: np.ndarray, parts: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of segment ``k`` of ``parts`` almost even ones."""
    size, longer = length // parts, length % parts
    short = parts - longer  # the longer segments come last
    return k * size + np.maximum(0, k - short), size + (k >= short)


def segment_rows(docs: DataFrame, settings: Settings, probe: bool) -> DataFrame:
    """key, line, marks: the segments of lines, or with ``probe`` the substrings that a line looks up.

    A line looks for segments of lines of its own length and of up to ``edits`` bytes less; a substring is looked up only where
    the edits left of it and right of it can add up. Copies of a line within a slice of texts give their rows once.
    """
    edits, parts = settings.edits, settings.edits + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(0))
            for a, b in slices(texts):
                x = Lines(texts[a:b], settings.least_bytes)
                _, once = np.unique(x.key, return_index=True)
                start, length, line = x.start[once], (x.end - x.start)[once], x.key[once]
                raw = np.frombuffer(x.data, np.uint8)
                marks = parities(x.data, start, start + length)
                sums = np.append(U64(0), np.cumsum((raw.astype(U64) + U64(1)) * powers(len(raw), FACTOR)))
                back = powers(len(raw) + 1, INVERSE)

                def rows(at, size, of_length, k, rows_of):
                    h = (sums[at + size] - sums[at]) * back[at]
                    key = mixed(mixed(h) + of_length.astype(U64) * STEP + times(k + 1))
                    return pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(line[rows_of].view(np.int64)),
                         pa.array(marks[rows_of].view(np.int64))], ["key", "line", "marks"])

                for k in range(parts):
                    if not probe:
                        at, size = segment_bounds(length, parts, k)
                        yield rows(start + at, size, length, k, slice(None))
                        continue
                    for less in range(edits + 1):
                        at, size = segment_bounds(length - less, parts, k)
                        low = max(-k, less - (edits - k))
                        high = min(k, less + (edits - k))
                        for shift in range(low, high + 1):
                            ok = np.flatnonzero((at + shift >= 0) & (at + shift + size <= length))
                            yield rows((start + at + shift)[ok], size[ok], (length - less)[ok], k, ok)

    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(
        cut, "key bigint, line bigint, marks bigint")


def within(a: bytes, b: bytes, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``: bit-parallel over a band of 2 * edits + 1 diagonals.

    Equal ends are cut off first. The longer string gives the rows; the band's last row is followed down to the end of it, and
    from there along the last row.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > edits:
        return False
    n = len(b)
    p = next((i for i in range(0, n, 64) if a[i:i + 64] != b[i:i + 64]), n)
    while p < n and a[p] == b[p]:
        p += 1
    a, b = a[p:], b[p:]
    q = 0
    while q < len(b) and a[-1 - q] == b[-1 - q]:
        q += 1
    a, b = a[:len(a) - q], b[:len(b) - q]
    if len(a) <= edits:
        return True  # replace or remove all of it
    where: dict[int, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << (2 * edits + 1)) - 1
    up, down = full ^ ((1 << edits) - 1), 0
    distance, last_row = edits, 1 << (2 * edits - 1)
    for j, c in enumerate(b):
        places = where.get(c, 0)
        same = (places >> (j - edits) if j >= edits else places << (edits - j)) & full
        flat = ((((same & up) + up) ^ up) | same | down) & full
        right_up, right_down = (down | ~(flat | up)) & full, flat & up
        if j < len(a) - edits:
            distance += not flat >> (2 * edits) & 1
        else:
            distance += bool(right_up & last_row) - bool(right_down & last_row)
            last_row >>= 1
        if distance > 2 * edits + len(b) - j:
            return False
        up, down = (right_down | ~((flat >> 1) | right_up)) & full, (flat >> 1) & right_up
    return distance <= edits


def near_lines(docs: DataFrame, firsts: DataFrame, settings: Settings) -> DataFrame:
    """Links (a, b) between keys of different lines within ``edits``."""
    x = segment_rows(docs, settings, False).select("key", F.col("line").alias("a"), F.col("marks").alias("a_marks"))
    y = segment_rows(docs, settings, True).select("key", F.col("line").alias("b"), F.col("marks").alias("b_marks"))
    differ = x.a_marks.bitwiseXOR(y.b_marks)
    # the marks are part of the join: far lines that share a common segment give no row
    may = (F.bit_count(differ.bitwiseAND(F.lit(0xFFFFFFFF))) <= 2 * settings.edits) \
        & (F.bit_count(F.shiftrightunsigned(differ, 32)) <= 4 * settings.edits)
    pairs = written(x.join(y, (x.key == y.key) & (x.a != y.b) & may).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    named = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    places = firsts.join(named, "key").select("key", F.col("first.node").alias("at_node"), F.col("first.no").alias("no"))
    texts = written(docs.join(places, F.col("node") == F.col("at_node")).select(
        "key", F.get(F.split(F.col("text"), "\n", -1), "no").cast("binary").alias("line"))
        .groupBy("key").agg(F.min("line").alias("line")))  # a row that is repeated has the line again
    left, right = (texts.select(F.col("key").alias(f"{s}_key"), F.col("line").alias(s)) for s in ("left", "right"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = pa.array([within(p or b"", q or b"", settings.edits) for p, q in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())])
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(near) for i in (0, 1)], ["a", "b"])

    both = pairs.join(left, F.col("a") == F.col("left_key")).join(right, F.col("b") == F.col("right_key"))
    return written(both.select("a", "b", "left", "right").mapInArrow(verify, "a bigint, b bigint"))


def repeated_lines(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """node (id, text_key), no, first_node, first_no: lines (from 0) that have a copy or near copy earlier, and where their
    class begins.

    Lines of ``least_bytes`` and more count; a class is what links of at most ``edits`` edits connect; earlier is a smaller
    doc_id, then a smaller hash of the text, or the same text and a smaller number. Lines are told apart by 64-bit hash, links
    are verified on the bytes. Rows without an id or text take no part; of rows that share an id each is judged by its own
    text, and rows that repeat both count as one document. Only doc_id and text are read.
    """
    rows = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()) \
        .select(node_of(F.col("doc_id"), F.col("text")).alias("node"), "text")

    def list_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            for a, b in slices(texts):
                x = Lines(texts[a:b], settings.least_bytes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).take(pa.array(x.text)), pa.array(x.no), pa.array(x.key.view(np.int64))],
                    ["node", "no", "key"])

    lines = written(rows.select("node", F.col("text").cast("binary").alias("text"))
                    .mapInArrow(list_lines, f"node {NODE}, no bigint, key bigint"))
    firsts = written(lines.groupBy("key").agg(F.min(F.struct("node", "no")).alias("first"), F.count(F.lit(1)).alias("n")))
    classes = components(near_lines(rows, firsts, settings)).withColumnRenamed("node", "c_node")
    near = firsts.join(classes, F.col("key") == F.col("c_node"))
    begins = near.groupBy("component").agg(F.min("first").alias("begin"))
    of_line = firsts.join(classes, F.col("key") == F.col("c_node"), "left").filter((F.col("n") > 1) | F.col("component").isNotNull()) \
        .join(begins, "component", "left").select(F.col("key").alias("c_key"), F.coalesce("begin", "first").alias("begin"))
    return lines.join(written(of_line), F.col("key") == F.col("c_key")) \
        .filter((F.col("begin.node") != F.col("node")) | (F.col("begin.no") != F.col("no"))) \
        .select("node", "no", F.col("begin.node").alias("first_node"), F.col("begin.no").alias("first_no"))


def without_repeats(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows of ``docs`` as a struct ``doc``, with removed (numbers of repeated lines, or null) and cleaned (the lines left)."""
    # written, so that Spark knows its size and moves no text where it can be broadcast
    gone = written(repeated_lines(docs, settings).groupBy("node").agg(F.collect_set("no").alias("removed")))
    rows = docs.select(F.struct("*").alias("doc"), node_of(F.col("doc_id"), F.col("text")).alias("own"))
    joined = rows.join(gone, F.col("own") == F.col("node"), "left").drop("own", "node")
    # the numbers are sorted out against all lines at once, so a text of many lines takes no quadratic search
    lines = F.split(F.col("doc.text"), "\n", -1)
    wanted = F.array_except(F.sequence(F.lit(0).cast("long"), F.size(lines).cast("long") - 1), F.col("removed"))
    left = F.array_join(F.transform(wanted, lambda i: F.get(F.col("lines"), i.cast("int"))), "\n")
    cut = joined.withColumn("lines", F.when(F.col("removed").isNotNull(), lines))
    return cut.select("doc", "removed", F.when(F.col("removed").isNotNull(), left).otherwise(F.col("doc.text")).alias("cleaned"))


def dedup_lines(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with repeated lines cut out of the texts; columns as they came. Documents of which nothing is left go.

    Null and empty texts stay as they are; rows that repeat id and text are cut alike, and both stay.
    """
    done = without_repeats(docs, settings)
    kept = done.filter(F.col("removed").isNull() | (F.length(F.trim("cleaned")) > 0))
    return kept.select(*[(F.col("cleaned") if c == "text" else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    done = without_repeats(docs)
    text = F.coalesce("doc.text", F.lit(""))
    return done.select(
        "doc.doc_id", (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.sha2(F.coalesce("cleaned", F.lit("")), 256).alias("kept_sha256"))
