"""Toxicity by maximum-scoring segments with extreme-value calibration.

Learning. Tokens and their first ``STEM`` characters are counted by class in labelled documents. The toxic
share of a token is its count under a Dirichlet prior of ``TOKEN_PRIOR`` observations at the share of its stem, which in
turn has ``STEM_PRIOR`` observations at the share of all text. Its score is the log-odds of that share against
all text, less ``DRIFT``, so clean text drifts down. The model keeps the ``MAX_TOKENS`` most frequent
tokens and stems. Labels come from a hash sample of about ``MAX_LABELED`` labelled ids.

Scoring. One linear scan finds all maximal-scoring segments of a text (Ruzzo and Tompa). In clean text
the best score of n tokens follows an extreme-value distribution with parameters lambda
(from the token scores) and K (fitted to clean documents). A segment with an expectation of at
most ``MAX_EXPECTED`` is a toxic passage. Toxic words may be scattered, so the best segments of a text are judged
together by the sum statistic of Karlin and Altschul: the r best ones, each expected less than once, for the r that is
least likely in clean text. Its log chance becomes a probability by a logistic curve. Token scores are learned and the
curve is fitted on different documents.

Defined cases: a null or empty text has no segment and gets the score of normalised value ``-ln K``; labels with a
null id or a value other than 0 and 1 are not used; a doc_id labelled more than once takes the larger
label; without labels of both classes every score is the share of label 1 (0 without labels); an empty table gives an empty
result; repeated rows are scored one by one; very long texts are scored whole; input columns pass through inside ``row``, so their names cannot clash.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from patronscope.llm.common import Shared, packed_rows, schema_with
from patronscope.session import settle

MAX_LABELED = 20_000
MAX_TOKENS = 200_000
STEM = 4
TOKEN_PRIOR, STEM_PRIOR = 2.0, 30.0
DRIFT = 2.0
MAX_EXPECTED = 0.01
#: Documents are split by crc32(id) mod FOLDS: HELD_OUT is never learned from, CALIBRATE fits the curve.
FOLDS, HELD_OUT, CALIBRATE = 5, 0, 4

WORD = re.compile(r"\w+")


class Model(NamedTuple):
    tokens: dict[str, tuple[int, int]]  # clean and toxic count
    stems: dict[str, float]  # toxic share
    share: float
    decay: float = 1.0
    constant: float = 1.0
    intercept: float = 0.0
    slope: float = 0.0

PASSAGE = ("start", "end", "score")
PASSAGES = ArrayType(StructType([StructField(n, t) for n, t in zip(PASSAGE, (LongType(), LongType(), DoubleType()), strict=True)]))


def fold(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % FOLDS


def tokens_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Scores(dict):
    """Token -> score, remembered up to a bound."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.base = model, math.log(model.share / (1 - model.share)) if 0 < model.share < 1 else None

    def __missing__(self, token: str) -> float:
        if len(self) > 500_000:
            self.clear()
        found = -DRIFT
        if self.base is not None:
            clean, toxic = self.model.tokens.get(token, (0, 0))
            prior = self.model.stems.get(token[:STEM], self.model.share)
            found += math.log((toxic + TOKEN_PRIOR * prior) / (clean + TOKEN_PRIOR * (1 - prior))) - self.base
        self[token] = found
        return found

    def of(self, text: str) -> np.ndarray:
        return np.array(list(map(self.__getitem__, tokens_of(text))), float)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score) in order of their place, in linear time.

    The stack holds disjoint candidates with the totals left and right of them. A new candidate swallows
    those after the last one whose left total is smaller, if that one's right total is smaller than its own.
    """
    positive = scores > 0
    if not positive.any():
        return []
    totals = np.concatenate([[0.0], np.cumsum(scores)])
    edges = np.flatnonzero(np.diff(np.concatenate([[False], positive, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, left, right, place of the last smaller left
    for start, end, left, right in zip(starts.tolist(), ends.tolist(), totals[starts].tolist(), totals[ends].tolist(), strict=True):
        at = len(stack) - 1
        while True:
            while at >= 0 and stack[at][2] >= left:
                at = stack[at][4]
            if at < 0 or stack[at][3] >= right:
                break
            start, left = stack[at][0], stack[at][2]
            del stack[at:]
            at = len(stack) - 1
        stack.append((start, end, left, right, at))
    return [(s, e, right - left) for s, e, left, right, _ in stack]


def joint_score(scores: list[float], decay: float, size: float) -> float:
    """Minus the log chance of the r best segment scores in clean text, for the r with the largest one.

    ``size`` is ln(K n). A normalised score above zero is expected less than once; without such a segment the best normalised
    score is returned. Every further segment costs a factor of two, as r is chosen from the data.
    """
    known = sorted((decay * s - size for s in scores), reverse=True)
    if not known or known[0] <= 0:
        return known[0] if known else -size
    best, total = known[0], known[0]
    for r, own in enumerate(known[1:], 2):
        if own <= 0:
            break
        total += own
        best = max(best, total - (r - 1) * math.log(2 * total) + math.lgamma(r + 1) + math.lgamma(r))
    return best


def passages(scores: np.ndarray, model: Model, max_expected: float = MAX_EXPECTED) -> tuple[list[tuple[int, int, float]], float]:
    """Significant segments, and the joint score of the text."""
    found = maximal_segments(scores)
    size = math.log(model.constant * max(len(scores), 1))
    bar = (size - math.log(max_expected)) / model.decay
    return [f for f in found if f[2] >= bar], joint_score([s for _, _, s in found], model.decay, size)


def labeled_sample(labels: DataFrame, id_col: str, label: str, bound: int) -> DataFrame:
    """(id, label) of about ``bound`` labelled ids outside the held-out fold, by hash of the id."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & (fold(F.col(id_col)) != HELD_OUT))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("label"))
    parts = max(1, math.ceil(known.count() / bound))
    return known.where(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(parts)) == 0)


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Intercept and slope by Newton steps with a weak pull of the slope toward zero."""
    center, scale = x.mean(), x.std() or 1.0
    z = np.stack([np.ones_like(x), (x - center) / scale])
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(w @ z, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))) @ z.T + np.diag([1e-6, 0.1]), z @ (y - p) - np.array([0, 0.1]) * w)
        w += np.clip(step, -2, 2)
        if abs(step).max() < 1e-9:
            break
    return float(w[0] - w[1] * center / scale), float(w[1] / scale)


def decay_of(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of the mean of exp(root * score) = 1 in clean text."""
    if not weights.sum():
        return 1.0
    weights = weights / weights.sum()

    def excess(root: float) -> float:
        return float(weights @ np.exp(np.clip(root * scores, -700, 700))) - 1

    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def _counted(learned: DataFrame, length: int | None) -> list:
    """(token, clean, toxic): the ``MAX_TOKENS`` most frequent tokens, or stems of ``length``."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter(), Counter()
        for batch in batches:
            for value, kind in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[kind].update(t[:length] for t in tokens_of(value))
        names = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array(names, pa.string()), *[pa.array([c[n] for n in names], pa.int64()) for c in counts]]
        yield pa.RecordBatch.from_arrays(columns, names=["token", "clean", "toxic"])

    rows = learned.select("text", "label").mapInArrow(tally, "token string, clean long, toxic long")
    sums = rows.groupBy("token").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    return sums.orderBy(F.desc(F.col("clean") + F.col("toxic")), "token").limit(MAX_TOKENS).collect()


def learn_tokens(learned: DataFrame) -> Model:
    """The token part of the model from (text, label)."""
    tokens = {r["token"]: (r["clean"], r["toxic"]) for r in _counted(learned, None)}
    stems = _counted(learned, STEM)
    clean, toxic = sum(r["clean"] for r in stems), sum(r["toxic"] for r in stems)
    share = toxic / (clean + toxic) if clean + toxic else 0.0
    shares = {r["token"]: (r["toxic"] + STEM_PRIOR * share) / (r["clean"] + r["toxic"] + STEM_PRIOR) for r in stems}
    return Model(tokens, shares, share)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", max_labeled: int = MAX_LABELED) -> Model:
    """Learn from the labelled sample. The driver gets the bounded tables and three numbers per sampled document."""
    sample = F.broadcast(labeled_sample(labels, id_col, label, max_labeled))
    learned = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).join(sample, "id")
    learned = settle(learned.select("text", "label", (fold(F.col("id")) == CALIBRATE).alias("calibrate")), "labeled")
    model = learn_tokens(learned.where(~F.col("calibrate")))
    scores = Scores(model)
    decay = decay_of(np.array([scores[t] for t in model.tokens]), np.array([float(c) for c, _ in model.tokens.values()]))
    shared = Shared(docs.sparkSession, "toxicity", model)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(shared.value)
        for batch in batches:
            top, size = [], []
            for value in batch.column(0).to_pylist():
                own = scores.of(value)
                top.append(max((s for _, _, s in maximal_segments(own)), default=0.0))
                size.append(len(own))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(top, pa.float64()), pa.array(size, pa.int64())], names=["label", "best", "n"])

    rest = learned.where("calibrate").select("text", "label")
    bests = rest.mapInArrow(best, "label int, best double, n long").toPandas()
    y, top, n = bests["label"].to_numpy(float), bests["best"].to_numpy(), np.maximum(bests["n"].to_numpy(), 1)
    clean = y == 0
    constant = float(clean.sum() / (n[clean] * np.exp(-decay * top[clean])).sum()) if clean.any() else 1.0
    if clean.all() or not clean.any():
        share = float(y.mean()) if len(y) else 0.0
        return model._replace(decay=decay, constant=constant, intercept=math.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    model = model._replace(decay=decay, constant=constant)
    scaled = Shared(docs.sparkSession, "toxicity", model)

    def joint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, scores = scaled.value, Scores(scaled.value)
        for batch in batches:
            found = [passages(scores.of(value), model)[1] for value in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.float64())], names=["label", "joint"])

    judged = rest.mapInArrow(joint, "label int, joint double").toPandas()
    intercept, slope = _logistic(judged["joint"].to_numpy(), judged["label"].to_numpy(float))
    return model._replace(intercept=intercept, slope=slope)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text", max_expected: float = MAX_EXPECTED) -> DataFrame:
    """(row, score, passages) for every document; ``passages`` holds the first token, end token and score of each significant passage."""
    shared = Shared(docs.sparkSession, "toxicity", model)
    rows = packed_rows(docs, text)
    kind = pa.list_(pa.struct(list(zip(PASSAGE, (pa.int64(), pa.int64(), pa.float64()), strict=True))))
    schema = schema_with(rows.schema["row"].dataType, ("score", DoubleType()), ("passages", PASSAGES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, scores = shared.value, Scores(shared.value)
        for batch in batches:
            values, spans = [], []
            for data in batch.column("data").to_pylist():
                found, x = passages(scores.of(data.decode()), model, max_expected)
                values.append(1 / (1 + math.exp(-min(max(model.intercept + model.slope * x, -500), 500))))
                spans.append([dict(zip(PASSAGE, f, strict=True)) for f in found])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(values, pa.float64()), pa.array(spans, kind)], names=schema.names)

    return rows.mapInArrow(run, schema)
