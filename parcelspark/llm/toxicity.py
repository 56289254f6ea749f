"""Toxicity by maximum-scoring segments of token log-odds, calibrated by extreme values."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.columns import remainder_of_id
from parcelspark.llm.texts import PLAIN, texts_of
from parcelspark.sources.tables import written

#: Letters of a word's stems, for words that are longer.
STEMS = range(3, 9)
#: Words whose scores a task keeps at hand; a fuller table starts anew.
KEPT_WORDS = 1_000_000
SCORED = "doc_id bigint, best double, total double, n_words bigint, passages array<struct<start:bigint,end:bigint,score:double>>"


@dataclass(frozen=True)
class Settings:
    sample_rows: int = 50_000  # labelled texts to learn from, at most
    prior: float = 10.0  # texts with a token that the Dirichlet prior counts for, in each class, per 1,000 of them
    least_z: float = 4.0  # log-odds below so many standard errors count as the drift
    least_docs: int = 5  # labelled texts with the word
    most_odds: float = 6.0
    drift: float = -0.25  # of every other word
    significant: float = 3.0  # normalised score (natural log) of a passage, beyond what a text of its length holds by chance
    folds: int = 3  # of the sample; texts are measured for the calibration with words of the other folds


@dataclass(frozen=True)
class Law:
    """Best segments of clean texts of n words: P(best > s) = 1 - exp(-k * n * exp(-decay * s))."""

    decay: float = 1.0
    k: float = 1.0

    def chance(self, n):
        """The normalised score that a clean text of n words reaches by chance."""
        return np.log1p(self.k * n)


@dataclass(frozen=True)
class Model:
    odds: dict[bytes, float]  # of words, and of stems after a ^
    law: Law
    weights: tuple[float, ...]  # of the columns of ``_calibrating``
    settings: Settings

    def score(self, best: np.ndarray, total: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_calibrating(best, total, n_words, self.law) @ np.array(self.weights), -30, 30)))


def _calibrating(best: np.ndarray, total: np.ndarray, n_words: np.ndarray, law: Law) -> np.ndarray:
    """One, the best segment's score beyond chance, the log of all segments' score, and the log of the length."""
    return np.stack([np.ones(len(best)), law.decay * best - law.chance(n_words), np.log1p(law.decay * total), np.log1p(n_words)], 1)


def segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score) of a text, in one pass.

    ``hits`` are (place, score above zero or below) of the words with a score of their own; every word between has ``drift``.
    Segments are disjoint; none can be longer or shorter and score more.
    """
    stack: list[list] = []  # [start, end, sum before, sum after], from left to right
    total, last = 0.0, -1
    for place, value in hits:
        total += drift * (place - last - 1)
        last = place
        before, total = total, total + value
        if value <= 0:
            continue
        new = [place, place + 1, before, total]
        while True:
            # the last segment that starts lower; those between can't be joined to anything to come
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= new[2]:
                j -= 1
            if j < 0 or stack[j][3] >= new[3]:
                stack.append(new)
                break
            new = [stack[j][0], new[1], stack[j][2], new[3]]
            del stack[j:]
    return [(s, e, after - before) for s, e, before, after in stack]


def stems(word: bytes) -> list[bytes]:
    """The first letters of a longer word, after a ^: abuse takes many endings."""
    letters = word.decode("utf-8", "replace")
    return [b"^" + letters[:k].encode() for k in STEMS if len(letters) > k]


class WordScores(dict):
    """Scores of words as they come: a word's own log-odds, else those of its longest stem that has some, else 0."""

    def __init__(self, odds: dict[bytes, float]):
        super().__init__()
        self.odds = odds

    def __missing__(self, word: bytes) -> float:
        score = self.odds.get(word)
        if score is None:
            score = next((self.odds[x] for x in reversed(stems(word)) if x in self.odds), 0.0)
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = score
        return score


def _measures(text: bytes, scores: WordScores, law: Law, settings: Settings) -> tuple[float, float, int, list]:
    """Score of the best segment and of all, number of words, and the significant passages."""
    words = text.translate(PLAIN).split()
    hits = [(i, v) for i, v in enumerate(map(scores.__getitem__, words)) if v]
    if not hits:
        return 0.0, 0.0, len(words), []
    found = segments(hits, settings.drift)
    chance = float(law.chance(len(words)))
    passages = [{"start": s, "end": e, "score": law.decay * v} for s, e, v in found if law.decay * v - chance >= settings.significant]
    return max(v for _, _, v in found), sum(v for _, _, v in found), len(words), passages


def measure(docs: DataFrame, odds: dict[bytes, float], law: Law, settings: Settings) -> DataFrame:
    """One row per row of ``docs``: doc_id, best, total, n_words, passages."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passage = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        scores = WordScores(odds)
        for batch in batches:
            rows = [_measures(t, scores, law, settings) for t in texts_of(batch.column(1))]
            best, total, n, passages = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.float64()), pa.array(total, pa.float64()), pa.array(n, pa.int64()),
                 pa.array(passages, passage)], ["doc_id", "best", "total", "n_words", "passages"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(scan, SCORED)


def labelled_sample(docs: DataFrame, labels: DataFrame, settings: Settings, folds: int = 5) -> DataFrame:
    """doc_id, text, toxic and fold of labelled rows outside the held-out fold, each text once.

    At most ``sample_rows`` ids, those of the smallest hashes; several labels of an id give the largest. The ids are the side
    that may be broadcast: their number is bounded.
    """
    ids = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (remainder_of_id(F.col("doc_id"), folds) != 0)) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample_rows)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    return rows.groupBy(F.xxhash64("text").alias("key")).agg(
        F.min_by("text", "doc_id").alias("text"), F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")) \
        .select("doc_id", "text", "toxic", F.pmod("key", F.lit(settings.folds)).cast("int").alias("fold"))


def token_counts(sample: DataFrame, settings: Settings) -> DataFrame:
    """word (or stem) and, for each label and fold, t<label>_<fold>: the texts with it; summed in each batch before the shuffle.

    Texts count, not places: a text that repeats one word over and over says no more about it than one that has it once.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[tuple[int, int], Counter] = {}
            for text, toxic, fold in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = set(text.translate(PLAIN).split())
                groups.setdefault((toxic, fold), Counter()).update(words.union(*map(stems, words)))
            for (toxic, fold), n in groups.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(n), pa.binary()), pa.array([toxic] * len(n), pa.int32()), pa.array([fold] * len(n), pa.int32()),
                     pa.array(n.values(), pa.int64())], ["word", "toxic", "fold", "n"])

    counted = sample.select(F.col("text").cast("binary").alias("text"), F.col("toxic").cast("int").alias("toxic"), "fold")
    return counted.mapInArrow(count, "word binary, toxic int, fold int, n bigint").groupBy("word").agg(*[
        F.sum(F.when((F.col("toxic") == y) & (F.col("fold") == f), F.col("n")).otherwise(0)).alias(f"t{y}_{f}")
        for y in (0, 1) for f in range(settings.folds)])


def word_odds(counts: DataFrame, folds: list[int], settings: Settings) -> dict[bytes, float]:
    """Log-odds of the words and stems that tell toxic texts of the folds from clean ones; nothing without texts of both.

    A token needs least_docs texts, so the table is bounded by the sample's words, and small by the test.
    """
    texts = counts.select("word", *[sum(F.col(f"t{y}_{f}") for f in folds).alias(f"n{y}") for y in (0, 1)])
    n0, n1 = texts.agg(F.sum("n0"), F.sum("n1")).first()
    if not n0 or not n1:
        return {}
    # log-odds under a Dirichlet prior in proportion to the tokens' counts, and their standard error
    weight = settings.prior * (n0 + n1) / 1000
    prior = F.lit(weight) * (F.col("n0") + F.col("n1")) / (n0 + n1)
    odds = F.log((F.col("n1") + prior) / (n1 + weight - F.col("n1") - prior)) \
        - F.log((F.col("n0") + prior) / (n0 + weight - F.col("n0") - prior))
    error = F.sqrt(1 / (F.col("n1") + prior) + 1 / (F.col("n0") + prior))
    listed = texts.filter(F.col("n0") + F.col("n1") >= settings.least_docs) \
        .select("word", odds.alias("odds"), error.alias("error")).filter(F.col("odds") / F.col("error") >= settings.least_z).collect()
    return {bytes(r.word): min(settings.most_odds, r.odds) for r in listed}


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn token log-odds, the extreme-value law and the calibration from the bounded sample of labelled rows.

    Law and calibration see texts as measured with the words of the other folds: those texts that gave a word score too well
    by it. Without a word that tells the classes apart every score is the share of toxic rows, or 0.
    """
    sample = written(labelled_sample(docs, labels, settings))
    counts = written(token_counts(sample, settings))
    size = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    folds = list(range(settings.folds))
    table = word_odds(counts, folds, settings)
    if not table:
        share = size.get(1, 0) / max(1, sum(size.values()))
        return Model({}, Law(), (math.log((share + 1e-6) / (1 - share + 1e-6)), 0.0, 0.0, 0.0), settings)
    parts = []
    for fold in folds:
        others = word_odds(counts, [f for f in folds if f != fold], settings)
        parts += [measure(sample.filter((F.col("fold") == fold) & (F.col("toxic") == y)), others, Law(), settings)
                  .select(F.lit(y).alias("toxic"), "best", "total", "n_words") for y in (0, 1)]
    # at most sample_rows rows of four numbers, in a fixed order so that sums of them agree between runs
    rows = np.array(sorted(tuple(r) for r in reduce(DataFrame.unionAll, parts).collect()), float).reshape(-1, 4)
    toxic, best, total, n_words = rows.T
    law = fit_law(best[toxic == 0], n_words[toxic == 0])
    return Model(table, law, _logistic(_calibrating(best, total, n_words, law), toxic), settings)


def fit_law(best: np.ndarray, n_words: np.ndarray) -> Law:
    """Both constants by maximum likelihood from clean texts; where nothing scored (best 0) only that is known."""
    scored = best > 0
    if not scored.any():
        return Law()

    def likelihood(decay: float) -> tuple[float, Law]:
        reached = float(np.sum(n_words * np.exp(-decay * best)))
        k = scored.sum() / reached  # the best k for this decay
        return float(scored.sum() * math.log(decay * k) - decay * best.sum() - k * reached), Law(decay, float(k))

    return max((likelihood(d) for d in np.arange(0.05, 5.0, 0.01)), key=lambda x: x[0])[1]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Newton steps of a logistic regression with a small ridge, halved until the likelihood rises.

    A whole step overshoots where the classes are nearly apart, and from there every probability is 0 or 1 and no step leads back.
    """
    def likelihood(beta: np.ndarray) -> float:
        z = x @ beta
        return float((y * z - np.logaddexp(0, z)).sum() - 0.5e-3 * beta @ beta)

    beta = np.zeros(x.shape[1])
    now = likelihood(beta)
    for _ in range(200):
        p = np.exp(-np.logaddexp(0, -(x @ beta)))
        slope = x.T @ (y - p) - 1e-3 * beta
        bend = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(x.shape[1])
        step = np.linalg.solve(bend, slope)
        while (then := likelihood(beta + step)) < now and np.abs(step).max() >= 1e-9:
            step = step / 2
        if then < now:
            break
        beta, now = beta + step, then
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(b) for b in beta)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, predicted, n_passages and passages (words from start to before end, score).

    Whole texts are scanned; null and empty ones have no passages and the score of such texts. Only doc_id and text are read.
    """
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(*(b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32)), pa.compute.list_value_length(b.column(4)).cast(pa.int64()),
                 b.column(4)], ["doc_id", "score", "predicted", "n_passages", "passages"])

    measured = measure(docs, model.odds, model.law, model.settings)
    return measured.mapInArrow(score, "doc_id bigint, score double, predicted int, n_passages bigint, "
                                      "passages array<struct<start:bigint,end:bigint,score:double>>")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, as they came; nothing is shuffled."""
    names = list(docs.columns)
    at = names.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WordScores(model.odds)
        for b in batches:
            rows = [_measures((t or "").encode(), scores, model.law, model.settings)[:3] for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(model.score(*np.array(rows, float).reshape(-1, 3).T) < 0.5))

    return docs.mapInArrow(keep, docs.schema)


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_toxicity(docs, model).select(
        "doc_id", (remainder_of_id(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted", "n_passages")
