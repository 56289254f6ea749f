"""Near duplicates by DartMinHash signatures of word shingles, banded joins and exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm.graph import components
from parcelspark.llm.texts import STEP, U64, Words, grams, mixed, slices, texts_of, times
from parcelspark.sources.tables import written


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    least: float = 0.8
    bands: int = 25
    rows: int = 5  # signature coordinates in a band: a pair at 0.8 shares none of 25 bands once in 20,000 times
    estimate: float = 0.58  # pairs whose signatures agree less are not verified: six standard errors below 0.8
    weights: str = "set"  # or "count": a shingle weighs as often as it occurs


#: A text of a row: two rows may share an id, but not its text. Ordered by id first.
NODE = "struct<id: bigint, text_key: bigint>"


def node_of(doc_id: Column, text: Column) -> Column:
    return F.struct(doc_id.cast("bigint").alias("id"), F.xxhash64(text).alias("text_key"))


class Shingles:
    """The distinct shingles of several texts: text (its number), hash, weight. A text of fewer words is one shingle."""

    def __init__(self, texts: list[bytes], size: int, weights: str):
        w = Words(texts)
        at = w.windows(size)
        text, h = w.text[at], grams(w.hash, size)[at]
        short = np.flatnonzero((w.count > 0) & (w.count < size))
        if len(short):
            own = [grams(w.hash[w.first[i]:w.first[i] + w.count[i]], int(w.count[i]))[0] for i in short]
            text, h = np.concatenate([text, short]), np.concatenate([h, np.array(own, U64)])
        key = mixed(h ^ (text.astype(U64) * STEP))
        order = np.argsort(key)
        ordered = key[order]
        new = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[:len(ordered)])
        self.n_words = w.count
        self.text, self.hash = text[order][new], h[order][new]
        times = np.diff(np.append(new, len(order)))
        self.weight = times.astype(float) if weights == "count" else np.ones(len(new))


def uniform(h: np.ndarray) -> np.ndarray:
    """Hashes as numbers above 0 and up to 1."""
    return ((h >> U64(11)).astype(np.float64) + 1) / 2.0 ** 53


def dart_signatures(s: Shingles, n_texts: int, k: int) -> np.ndarray:
    """k dart numbers for each text (0 for texts without words).

    Each element owns the plane of weight by rank. Its weights lie in bands of width 1, 2, 4, ...; darts fall on a band
    as a Poisson stream over rank whose rate is the width, all by hashes of (element, band, number of the dart), so that equal
    elements get equal darts in every text. A dart hits if its weight is below the element's. Ranks go as far as k ln k + 2k
    darts are to be expected; each coordinate keeps its earliest dart, and texts with an empty coordinate go twice as far.
    """
    out = np.zeros((n_texts, k), U64)
    total = np.bincount(s.text, s.weight, n_texts)
    darts = k * math.log(k) + 2 * k
    todo, reach = np.flatnonzero(total > 0), darts
    while len(todo):
        limit = np.zeros(n_texts)
        limit[todo] = reach / total[todo]
        alive = np.flatnonzero(limit[s.text] > 0)
        found = [[], [], []]  # cell, rank, dart
        band = 0
        while len(alive):
            e = alive
            width = 2.0 ** band
            state = mixed(s.hash[e] + times(band + 1))
            rank = np.zeros(len(e))
            throw = 0
            while len(e):
                throw += 1
                dart = mixed(state + times(throw))
                rank = rank - np.log(uniform(dart)) / width
                on = rank < limit[s.text[e]]
                e, state, rank, dart = e[on], state[on], rank[on], dart[on]
                place = mixed(dart ^ STEP)
                hit = width - 1 + width * uniform(place) <= s.weight[e] if s.weight.max() > 1 else slice(None)
                number = mixed(place + STEP)
                found[0].append((s.text[e] * k + (number % U64(k)).astype(np.int64))[hit])
                found[1].append(rank[hit])
                found[2].append(number[hit])
            band += 1
            alive = alive[s.weight[alive] > 2.0 ** band - 1]
        cell, rank, number = map(np.concatenate, found)
        order = np.argsort(-rank)  # the earliest is written last
        out.reshape(-1)[cell[order]] = number[order]
        filled = np.bincount(np.unique(cell) // k, minlength=n_texts)
        todo = todo[filled[todo] < k]
        reach *= 2
    return out


def signatures(docs: DataFrame, settings: Settings) -> DataFrame:
    """node, n_shingles, set1 and set2 (128 bits of the shingle set), sketch (a byte a coordinate), planes (four bits a
    coordinate, one plane of longs for each), bands (hashes)."""
    k = settings.bands * settings.rows

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(1))
            for a, b in slices(texts):
                n = b - a
                s = Shingles(texts[a:b], settings.shingle, settings.weights)
                signed = dart_signatures(s, n, k)
                weighed = s.hash * s.weight.astype(U64)
                sums = []
                for salt in (1, 2):
                    x = np.zeros(n, U64)
                    np.add.at(x, s.text, mixed(weighed + times(salt)))
                    sums.append(pa.array(x.view(np.int64)))
                band = grams_of_rows(signed, settings)
                size = np.bincount(s.text, minlength=n)
                lists = pa.ListArray.from_arrays(np.cumsum(np.append(0, np.where(size > 0, settings.bands, 0))).astype(np.int32),
                                                 pa.array(band[size > 0].reshape(-1).view(np.int64)))
                sketch = [x.tobytes() for x in (signed >> U64(56)).astype(np.uint8)]
                longs = -(-k // 64)
                bits = np.zeros((n, PLANES, longs * 64), np.uint8)
                for plane in range(PLANES):
                    bits[:, plane, :k] = (signed >> U64(56 + plane)) & U64(1)
                planes = np.packbits(bits, axis=2).reshape(n, -1).view(np.int64)
                plane_lists = pa.ListArray.from_arrays(np.arange(0, planes.size + 1, PLANES * longs, dtype=np.int32),
                                                       pa.array(planes.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), pa.array(size), *sums, pa.array(sketch, pa.binary()), plane_lists, lists],
                    ["node", "n_shingles", "set1", "set2", "sketch", "planes", "bands"])

    return docs.select(node_of(F.col("doc_id"), F.col("text")).alias("node"), F.col("text").cast("binary").alias("text")).mapInArrow(
        sign, f"node {NODE}, n_shingles bigint, set1 bigint, set2 bigint, sketch binary, planes array<bigint>, bands array<bigint>")


#: Bits of a coordinate that are compared inside a join.
PLANES = 4


def may_be_near(settings: Settings) -> Column:
    """Whether ``planes`` and ``x_planes`` differ in no more coordinates than ``estimate`` leaves open: never stricter than it."""
    k = settings.bands * settings.rows
    longs = -(-k // 64)
    differ = F.lit(0)
    for word in range(longs):
        unlike = reduce(Column.bitwiseOR, [F.col("planes")[p * longs + word].bitwiseXOR(F.col("x_planes")[p * longs + word])
                                           for p in range(PLANES)])
        differ = differ + F.bit_count(unlike)
    return differ <= math.floor((1 - settings.estimate) * k + 1e-9)


def grams_of_rows(signed: np.ndarray, settings: Settings) -> np.ndarray:
    """A hash for each band of each signature, the number of the band included."""
    cut = signed.reshape(len(signed), settings.bands, settings.rows)
    out = np.arange(1, settings.bands + 1, dtype=U64) * STEP + np.zeros((len(signed), 1), U64)
    for i in range(settings.rows):
        out = mixed(out * U64(0xD6E8FEB86659FD93) + cut[:, :, i])
    return out


def verified(pairs: DataFrame, texts: DataFrame, sketches: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) of nodes with similarity ``least`` and more, by their whole shingle sets.

    ``sketches`` has node and sketch, ``texts`` node and text, each node once; or it is the documents, of which the texts in
    likely pairs are picked.
    """
    k = settings.bands * settings.rows

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, k) for i in (2, 3))
            near = (left == right).mean(1) >= settings.estimate
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(near)) for i in (0, 1)], ["a", "b"])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = texts_of(batch.column(2)), texts_of(batch.column(3))
            near = np.zeros(len(left), bool)
            for a, b in slices([x + y for x, y in zip(left, right)]):
                n = b - a
                s = Shingles(left[a:b] + right[a:b], settings.shingle, settings.weights)
                pair = (s.text % n).astype(U64)
                key = mixed(s.hash ^ (pair * STEP))
                order = np.argsort(key)
                twin = np.flatnonzero(key[order][1:] == key[order][:-1])
                both = np.bincount(pair[order][twin].astype(np.int64), np.minimum(s.weight[order][twin], s.weight[order][twin + 1]), n)
                all_ = np.bincount(pair.astype(np.int64), s.weight, n)
                near[a:b] = both >= settings.least * (all_ - both) - 1e-9
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(near)) for i in (0, 1)], ["a", "b"])

    def with_both(table: DataFrame, found: DataFrame, column: str) -> DataFrame:
        a, b = (table.select(F.col("node").alias(f"{x}_node"), F.col(column).alias(x)) for x in ("left", "right"))
        return found.join(a, F.col("a") == F.col("left_node")).join(b, F.col("b") == F.col("right_node")) \
            .select("a", "b", "left", "right")

    likely = written(with_both(sketches, pairs, "sketch").mapInArrow(close, f"a {NODE}, b {NODE}"))
    if "node" not in texts.columns:
        named = written(likely.select("a").union(likely.select("b")).toDF("node").distinct())
        texts = written(texts_of_nodes(texts, named))
    return written(with_both(texts, likely, "text").mapInArrow(exact, f"a {NODE}, b {NODE}"))


#: Bits that mark wanted texts: 2 MB, whatever the input.
MARKS = 1 << 24


def marked_rows(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The ``rows`` (t_node) whose text may be that of one of ``nodes``: so that other texts are not moved for an exact join."""
    bit = F.pmod(F.col("text_key"), F.lit(MARKS)) + 1
    bitmaps = nodes.select(F.col("node.text_key").alias("text_key")) \
        .groupBy(F.bitmap_bucket_number(bit).alias("stretch")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    own = rows.withColumn("text_key", F.col("t_node.text_key"))
    met = own.join(F.broadcast(bitmaps), F.bitmap_bucket_number(bit) == F.col("stretch"))
    place = F.bitmap_bit_position(bit).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    on = byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), place % 8 + 1)) != 0
    return met.filter(on).select(*rows.columns)


def texts_of_nodes(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The columns of ``nodes`` and text (binary), each node once however many rows repeat it."""
    rows = docs.select(node_of(F.col("doc_id"), F.col("text")).alias("t_node"), F.col("text").cast("binary").alias("text"))
    found = marked_rows(rows, nodes).join(nodes, F.col("t_node") == F.col("node")).drop("t_node")
    order = Window.partitionBy("node").orderBy("node")
    return found.withColumn("copy", F.row_number().over(order)).filter("copy = 1").drop("copy")


#: Slots in which shingles are counted to order them: one number each goes through the driver, whatever the input.
SLOTS = 1 << 17


def rare_pairs(own: DataFrame, planes: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) of ``own`` (node, part, text) of different parts that may have similarity ``least`` and more.

    All texts order their shingles alike, rarely counted slots first. The shingles that two such texts share cannot all stand
    behind the first fifth of either (for 0.8), so they meet in a shingle of both first fifths. At the first shingle that two
    texts share, they can share no more than what stands from there on in either; pairs for which that is too little give no
    row. The order only decides how many pairs meet, not which may be missed. Shingles of one part only are dropped before
    the join, and the signatures (``planes`` by node) are part of it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            found = texts_of(batch.column(0))
            for a, b in slices(found):
                s = Shingles(found[a:b], settings.shingle, settings.weights)
                total += np.bincount((s.hash % U64(SLOTS)).astype(np.int64), minlength=SLOTS)
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total[slot])], ["slot", "n"])

    counted = own.select("text").mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    times_seen = np.zeros(SLOTS, np.int64)
    times_seen[counted["slot"].to_numpy()] = counted["n"].to_numpy()

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = texts_of(batch.column(2))
            for a, b in slices(found):
                s = Shingles(found[a:b], settings.shingle, settings.weights)
                order = np.lexsort((s.hash, times_seen[(s.hash % U64(SLOTS)).astype(np.int64)], s.text))
                text, weight = s.text[order], s.weight[order]
                total = np.bincount(text, weight, b - a)
                left = total[text] - (np.cumsum(weight) - weight - (np.cumsum(total) - total)[text])
                first = left >= settings.least * total[text] - 1e-6
                at = pa.array(a + text[first])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.hash[order][first].view(np.int64)), batch.column(0).take(at), batch.column(1).take(at),
                     pa.array(total[text[first]]), pa.array(left[first])], ["gram", "node", "part", "total", "left"])

    rows = written(own.mapInArrow(rare, f"gram bigint, node {NODE}, part {NODE}, total double, left double"))
    several = rows.groupBy("gram").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high").select("gram")
    signed = planes.select(F.col("node").alias("p_node"), "planes")
    met = written(rows.join(several, "gram", "left_semi").join(signed, F.col("node") == F.col("p_node")).drop("p_node"))
    other = met.select("gram", *[F.col(c).alias(f"x_{c}") for c in ("node", "part", "total", "left", "planes")])
    # shared / (total + x_total - shared) >= least
    alike = (1 + settings.least) * F.least("left", "x_left") >= settings.least * (F.col("total") + F.col("x_total")) - 1e-6
    return met.join(other, "gram").filter((F.col("node") < F.col("x_node")) & (F.col("part") != F.col("x_part")) & alike & may_be_near(settings)) \
        .select(F.col("node").alias("a"), F.col("x_node").alias("b")).distinct()


#: Rounds in which open buckets get new pivots before the rest meets by shingles.
ROUNDS = 2


def in_open_buckets(members: DataFrame, found: DataFrame) -> DataFrame:
    """bucket, node and part (its component, or itself) of the buckets whose members (bucket, node) are still in several parts."""
    placed = members.join(found.withColumnRenamed("node", "c_node"), F.col("node") == F.col("c_node"), "left") \
        .select("bucket", "node", F.coalesce("component", "node").alias("part"))
    several = placed.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high").select("bucket")
    return placed.join(several, "bucket", "left_semi")


def merged(found: DataFrame, fresh: DataFrame) -> DataFrame:
    """The components ``found`` once the links ``fresh`` (a, b) are added: only the parts that these touch are walked again."""
    ends = fresh.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    known = found.withColumnsRenamed({"node": "f_node", "component": "old"})
    part_of = written(ends.join(known, F.col("node") == F.col("f_node"), "left").select("node", F.coalesce("old", "node").alias("part")))
    a, b = (part_of.select(F.col("node").alias(f"{x}_node"), F.col("part").alias(f"{x}_part")) for x in "ab")
    joined = components(fresh.join(a, F.col("a") == F.col("a_node")).join(b, F.col("b") == F.col("b_node"))
                        .select(F.col("a_part").alias("a"), F.col("b_part").alias("b"))).withColumnRenamed("node", "p_node")
    every = found.select("node", F.col("component").alias("part")).union(
        part_of.join(found.select(F.col("node").alias("f_node")), F.col("node") == F.col("f_node"), "left_anti"))
    return every.join(joined, F.col("part") == F.col("p_node"), "left").select("node", F.coalesce("component", "part").alias("component"))


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (smallest id of its class), n_shingles, kept (whether its text stays).

    A class holds what links of similarity ``least`` and more connect; shingles are runs of five words between white space, and
    a shorter text is one shingle. Texts with the same shingles are one node, that of the smallest id. In a bucket of a band, all
    nodes are held against one of them, so a group of near copies costs one comparison a member and band; buckets that
    are still in several components get new pivots twice. Nodes of buckets that stay in several meet by their rarest
    shingles, so no link in a bucket is lost.
    Texts without words and rows without an id are classes of their own and stay. Rows that share an id are judged each by
    its own text; rows that repeat id and text are kept or not alike. Only doc_id and text are read.
    """
    return _judged(docs, settings).select("node.id", "class_node.id", "n_shingles", "kept").toDF(
        "doc_id", "class_id", "n_shingles", "kept")


def _judged(docs: DataFrame, settings: Settings) -> DataFrame:
    """One row per row of ``docs``: node, class_node (smallest node of its class), n_shingles, kept."""
    signed = written(signatures(docs, settings))
    marked = signed.filter(F.col("node.id").isNotNull() & (F.col("n_shingles") > 0))
    kinds = written(marked.groupBy("n_shingles", "set1", "set2").agg(
        F.min("node").alias("node"), F.min_by(F.struct("sketch", "planes", "bands"), "node").alias("first"))
        .select("n_shingles", "set1", "set2", "node", "first.sketch", "first.planes", "first.bands"))
    rows = kinds.select("node", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct(
        F.xxhash64("node", "bucket").alias("turn"), "node")).node.alias("pivot")).filter(F.col("size") > 1)
    members = written(rows.join(shared, "bucket"))
    sketches = kinds.select("node", "sketch")

    def ordered(table: DataFrame, x: str, y: str) -> DataFrame:
        return table.filter(F.col(x) != F.col(y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()

    star = written(ordered(members, "node", "pivot"))
    found = components(verified(star, docs, sketches, settings))
    # buckets of three and more; in those of two the one pair has been tried
    crowded = members.filter(F.col("size") > 2).select("bucket", "node")
    unsure = written(in_open_buckets(crowded, found).select("node").distinct())
    texts = written(texts_of_nodes(docs, unsure).select("node", "text"))
    marks = written(kinds.select("node", "sketch", "planes").join(unsure, "node", "left_semi"))
    for turn in range(1, ROUNDS + 1):
        placed = written(in_open_buckets(crowded, found))
        # another pivot in each round, mostly one of the largest part
        pivots = placed.groupBy("bucket").agg(F.min(F.struct(
            F.xxhash64("node", "bucket", F.lit(turn)).alias("turn"), "node", "part")).alias("pivot")) \
            .select("bucket", F.col("pivot.node").alias("pivot"), F.col("pivot.part").alias("pivot_part"))
        apart = placed.join(pivots, "bucket").filter(F.col("part") != F.col("pivot_part"))
        tried = written(ordered(apart, "node", "pivot").join(star, ["a", "b"], "left_anti"))
        fresh = verified(tried, texts, marks, settings)
        if fresh.isEmpty():
            break
        star, found = star.union(tried), written(merged(found, fresh))
    still = written(in_open_buckets(crowded, found).select("node", "part").distinct())
    own = written(texts.join(still, "node").select("node", "part", "text"))
    more = verified(written(rare_pairs(own, marks, settings)), own.select("node", "text"), marks, settings)
    classes = merged(found, more).withColumnRenamed("node", "c_node")
    of_kind = kinds.join(classes, F.col("node") == F.col("c_node"), "left") \
        .select("n_shingles", "set1", "set2", F.coalesce("component", "node").alias("class_node"))
    labelled = signed.select("node", "n_shingles", "set1", "set2").join(of_kind, ["n_shingles", "set1", "set2"], "left")
    own = F.when((F.col("n_shingles") > 0) & F.col("node.id").isNotNull(), F.col("class_node")).otherwise(F.col("node"))
    return labelled.select("node", own.alias("class_node"), "n_shingles", (own == F.col("node")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that stay: one of each class, texts without words, and rows without an id.

    Of rows that repeat id and text one stays, the first by a hash of all columns. Empty tables give none.
    """
    judged = written(_judged(docs, settings).filter((F.col("n_shingles") > 0) & F.col("node.id").isNotNull()))
    gone = judged.filter(~F.col("kept")).select("node").distinct()
    again = judged.filter("kept").groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("node")
    # both small tables are written, so that Spark broadcasts them by their size and moves no text for them
    marks = written(gone.withColumn("again", F.lit(False)).union(again.withColumn("again", F.lit(True))))
    rows = docs.select(F.struct("*").alias("doc"), node_of(F.col("doc_id"), F.col("text")).alias("own"))
    stay = rows.join(marks, F.col("own") == F.col("node"), "left_anti").select("doc")
    order = Window.partitionBy("own").orderBy(F.xxhash64("doc"))
    several = rows.join(marks.filter("again"), F.col("own") == F.col("node"), "left_semi") \
        .withColumn("copy", F.row_number().over(order)).filter("copy = 1").select("doc")
    return stay.union(several).select("doc.*")


def op9_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
