"""Toxic passages: maximum-scoring segments over token log-odds, judged by extreme-value statistics."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyloom.llm.common import held_out_fold, read_table, register, text_of

BINS = 1 << 20  # hashed words: the size of the model, whatever the corpus
SAMPLE = 60_000  # labelled rows that a model is fitted on, at most
PRIOR = 10.0  # Dirichlet prior: observations of each word, shared by the classes in their overall proportion
LEAST_Z = 3.0  # log-odds below this many standard errors count as 0
MOST_ODDS = 5.0
DRIFT = 0.3  # cost of each word, so that the expected score of ordinary text is below 0
LEAST_BITS = 2.0  # normalized score from which a passage is significant
THRESHOLD = 0.7
MARKS = ".,;:!?|()\"'"
PASSAGES = "array<struct<first_word:int,end_word:int,score:double,evalue:double>>"


class WordBins(dict):
    """Word to hashed bin; forgets everything at its limit."""

    LIMIT = 500_000

    def __missing__(self, word: str) -> int:
        out = zlib.crc32(word.strip(MARKS).lower().encode()) & (BINS - 1)
        if len(word) <= 40:
            self[word] = out
        return out

    def of(self, text: str) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        words = text.split()
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


_WORDS = WordBins()


@dataclass
class Model:
    """Score of each bin, and what turns segment scores into evidence and evidence into a probability."""

    weights: np.ndarray
    scale: float = 1.0  # lambda of the extreme-value law
    log_k: float = 0.0
    slope: float = 0.0
    level: float = -20.0

    def evidence(self, score: float, words: int) -> float:
        return self.scale * score - self.log_k - math.log(max(words, 1))

    def probability(self, total: float) -> float:
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.slope * total + self.level))))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (Ruzzo and Tompa) as (first, end, score), in linear time.

    Stretches of positive scores are single steps. ``back`` leads from a segment to the nearest one
    before it that starts at a lower running sum.
    """
    positive = np.concatenate([[False], scores > 0, [False]])
    edges = np.flatnonzero(positive[1:] != positive[:-1])
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    low, high, first, end, back = [], [], [], [], []
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        lo, hi, start = sums[a], sums[b], a
        j = len(low) - 1
        while True:
            while j >= 0 and low[j] >= lo:
                j = back[j]
            if j < 0 or high[j] >= hi:
                break
            lo, start = low[j], first[j]
            for column in (low, high, first, end, back):
                del column[j:]
            j = len(low) - 1
        for column, value in zip((low, high, first, end, back), (lo, hi, start, b, j)):
            column.append(value)
    return [(f, e, float(h - x)) for x, h, f, e in zip(low, high, first, end)]


def find_passages(model: Model, text: str) -> tuple[float, list[tuple[int, int, float, float]]]:
    """Summed evidence of the significant passages, and the passages with their expected number by chance."""
    bins = _WORDS.of(text)
    out, total = [], 0.0
    for first, end, score in segments(model.weights[bins]):
        bits = model.evidence(score, len(bins))
        if bits >= LEAST_BITS:
            total += bits
            out.append((first, end, score, math.exp(-bits)))
    return total, out


def _sampled(labels: DataFrame) -> DataFrame:
    """At most ``SAMPLE`` labelled rows outside the held-out fold, by hash of the id: (doc_id, toxic)."""
    usable = labels.where("doc_id is not null and toxic is not null").where(~held_out_fold(F.col("doc_id")))
    one = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)


def count_words(docs: DataFrame, classes: dict[int, int]) -> np.ndarray:
    """Counts per bin, shape (5, BINS): all words of all rows, then for each class (half * 2 + toxic) its documents with the word."""
    given = docs.sparkSession.sparkContext.broadcast(classes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((5, BINS), np.int64)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bins = _WORDS.of(text)
                np.add.at(sums[0], bins, 1)
                if doc_id in given.value:
                    sums[1 + given.value[doc_id], np.unique(bins)] += 1
        kind, bin_ = np.nonzero(sums)
        for at in range(0, len(bin_), 50_000):
            part = slice(at, at + 50_000)
            yield pa.RecordBatch.from_arrays([pa.array(kind[part].astype(np.int32)), pa.array(bin_[part].astype(np.int32)), pa.array(sums[kind[part], bin_[part]])], ["kind", "bin", "n"])

    rows = docs.select("doc_id", text_of().alias("text")).mapInArrow(count, "kind int, bin int, n long")
    # at most five rows for each bin reach the driver
    table = rows.groupBy("kind", "bin").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((5, BINS), np.int64)
    out[table["kind"].to_numpy(), table["bin"].to_numpy()] = table["n"].to_numpy()
    return out


def log_odds(clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Weight of each bin: log-odds of toxic under the Dirichlet prior, cut to the significant ones, less the drift."""
    y0, y1 = clean.astype(float), toxic.astype(float)
    n0, n1 = max(y0.sum(), 1.0), max(y1.sum(), 1.0)
    share = n1 / (n0 + n1)
    a0, a1 = y0 + PRIOR * (1 - share), y1 + PRIOR * share
    odds = np.log(a1 / n1) - np.log(a0 / n0)
    sure = np.abs(odds) > LEAST_Z * np.sqrt(1 / a0 + 1 / a1)
    return np.where(sure, np.clip(odds, -1, MOST_ODDS), 0.0) - DRIFT


def extreme_value_scale(weights: np.ndarray, background: np.ndarray) -> float:
    """The positive root of sum(p * exp(scale * weight)) = 1 over the words of the whole corpus."""
    p = background / max(background.sum(), 1)
    if not (weights[background > 0] > 0).any() or p @ weights >= 0:
        return 1.0
    low, high = 0.0, 50.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if p @ np.exp(mid * weights) < 1 else (low, mid)
    return max(low, 1e-6)


def logistic_fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and level of a one-dimensional logistic regression with a weak ridge, by Newton steps.

    The rarer class weighs more by the square root of the ratio: between the probability at the
    sample's share of toxic rows and that at equal shares.
    """
    beta = np.zeros(2)
    design = np.stack([x, np.ones_like(x)])
    weight = np.where(y > 0, np.sqrt((1 - y.mean()) / y.mean()), 1.0)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta @ design, -50, 50)))
        grad = design @ (weight * (y - p)) - 1e-3 * beta
        hess = (design * (weight * p * (1 - p) + 1e-9)) @ design.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Model from the labelled rows of ``docs``; equal texts count once.

    Word counts of the whole corpus give the null distribution of scores. The constant of the
    extreme-value law and the logistic curve come from cross-fitting: each half of the sample is
    scored by the words of the other half. Without both classes nothing is toxic: every score is
    about 0.
    """
    text = text_of()
    sample = _sampled(labels)
    # bounded by SAMPLE rows
    known = docs.select("doc_id", text.alias("text")).join(F.broadcast(sample), "doc_id")
    once = known.groupBy(F.xxhash64("text").alias("h")).agg(F.min(F.struct("doc_id", "toxic")).alias("r")).select("r.*")
    classes = {r["doc_id"]: zlib.crc32(str(-r["doc_id"]).encode()) % 2 * 2 + int(r["toxic"] == 1) for r in once.collect()}
    counts = count_words(docs, classes)
    model = Model(log_odds(counts[1] + counts[3], counts[2] + counts[4]))
    model.scale = extreme_value_scale(model.weights, counts[0])
    if len({c % 2 for c in classes.values()}) < 2:
        return model
    # the weights by which each half is scored: those of the other one
    crossed = (log_odds(counts[3], counts[4]), log_odds(counts[1], counts[2]))
    given = docs.sparkSession.sparkContext.broadcast((classes, crossed))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights = given.value
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bins = _WORDS.of(text)
                out.append((known[doc_id] % 2, len(bins), [s for _, _, s in segments(weights[known[doc_id] // 2][bins])]))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), arrow.types)] if out else [pa.array([], t) for t in arrow.types]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    arrow = pa.schema([("toxic", pa.int32()), ("words", pa.int64()), ("scores", pa.list_(pa.float64()))])
    ids = docs.sparkSession.createDataFrame([(k,) for k in classes], "doc_id long")
    part = docs.select("doc_id", text.alias("text")).join(F.broadcast(ids), "doc_id")
    seen = part.mapInArrow(measure, "toxic int, words long, scores array<double>").collect()
    best = [model.scale * max(r["scores"], default=0.0) - math.log(max(r["words"], 1)) for r in seen if not r["toxic"]]
    model.log_k = float(np.mean(best)) - np.euler_gamma
    totals = [sum(b for b in (model.evidence(s, r["words"]) for s in r["scores"]) if b >= LEAST_BITS) for r in seen]
    model.slope, model.level = logistic_fit(np.array(totals), np.array([float(r["toxic"]) for r in seen]))
    return model


def scorer(spark: SparkSession, model: Model):
    """Column function: text to (score, passages)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(f"struct<score:double,passages:{PASSAGES}>")
    def score(texts):
        import pandas as pd

        rows = [find_passages(shared.value, t) for t in texts]
        return pd.DataFrame({"score": [shared.value.probability(t) for t, _ in rows], "passages": [
            [dict(zip(("first_word", "end_word", "score", "evalue"), p)) for p in ps] for _, ps in rows
        ]})

    return score


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and the significant passages (word numbers) of every row.

    A word is what white space separates, without marks at its ends, lower-cased. Null and empty
    texts have no passage and the score of a document without evidence. Repeated rows are scored
    alike; only doc_id and text are read. A null doc_id is scored and never trained on.
    """
    score = scorer(docs.sparkSession, fit(docs, labels))
    return docs.select("doc_id", held_out_fold(F.col("doc_id")).alias("held_out"), score(text_of()).alias("s")).select(
        "doc_id", "held_out", F.col("s.score").alias("score"), (F.col("s.score") >= THRESHOLD).cast("int").alias("predicted"), F.col("s.passages").alias("passages"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose score is below the threshold, with all columns."""
    score = scorer(docs.sparkSession, fit(docs, labels))
    return docs.where(score(text_of())["score"] < THRESHOLD)


@register("op1_toxicity")
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
