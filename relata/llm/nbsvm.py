"""A quality classifier: naive Bayes support vectors over n-gram indicators.

Each n-gram indicator is scaled by the log ratio of its smoothed counts in the two classes; a linear model with hinge loss
is fitted to the scaled indicators, brought to length one, by dual coordinate descent. Margins become scores from 0 to 1
by a logistic curve that is fitted to margins of rows the model has not seen.

N-grams are hashed into ``BUCKETS`` places: words, pairs of words, runs of four character classes (every punctuation
mark is a class of its own; letters count by case, digits and characters beyond ASCII are one class each), and how often
a word follows itself. Only the text is an input.

The model is fitted on ``SAMPLE`` labelled rows at most, those with the least hashes of their ids, so the sample does not
depend on the order or the place of rows. Scoring is a map over all rows; the model's size is fixed.

Defined results: null texts are empty; an empty text has no indicators and gets the score of its bias; of several labels
of an id the least counts, null labels do not; without labels every score is 0.5, with one class only it is that class's
smoothed share; further columns are ignored by ``score`` and kept by ``keep``; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relata.llm.frames import map_texts, offsets_of, pieces
from relata.llm.hashing import VISIBLE, mix, text_bounds, word_hashes, word_places

#: Labelled rows the model is fitted on, at most.
SAMPLE = 3000
BITS = 18
BUCKETS = 1 << BITS
#: Scores from here on are taken for label 1.
THRESHOLD = 0.3
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 5
FOLDS = 3
RUN_BUCKETS = 8


def _character_classes() -> np.ndarray:
    found = np.full(256, 3, np.uint32)
    found[ord("a") : ord("z") + 1] = 1
    found[ord("A") : ord("Z") + 1] = 2
    found[ord("0") : ord("9") + 1] = 4
    rest = [byte for byte in range(128) if not chr(byte).isalnum()]
    found[rest] = np.arange(5, 5 + len(rest))
    return found


CHARACTER_CLASSES = _character_classes()


def indicators(texts: pa.Array) -> list[np.ndarray]:
    """The places of each text's n-grams, each once, ascending."""
    data, marks = offsets_of(texts)
    classes = CHARACTER_CLASSES[data]
    codes = np.zeros(max(0, len(data) - 3), np.uint32)
    for place in range(4):
        codes = codes * np.uint32(0x9E3779B1) + classes[place : place + len(codes)]
    codes = (codes * np.uint32(0x85EBCA6B) >> np.uint32(32 - BITS)).astype(np.int64)
    starts, ends = word_places(data, marks, VISIBLE)
    words = word_hashes(data, starts, ends, VISIBLE)
    bounds = text_bounds(starts, marks)
    shift = np.uint64(64 - BITS)
    single = (mix(words) >> shift).astype(np.int64)
    double = (mix(words[:-1] * np.uint64(3) + words[1:]) >> shift).astype(np.int64)
    same = words[1:] == words[:-1]
    runs = (mix(np.arange(RUN_BUCKETS, dtype=np.uint64) + np.uint64(77)) >> shift).astype(np.int64)
    seen, found = np.zeros(BUCKETS, bool), []
    for text in range(len(marks) - 1):
        low, high = bounds[text], bounds[text + 1]
        seen[codes[marks[text] : max(marks[text], marks[text + 1] - 3)]] = True
        seen[single[low:high]] = True
        if high - low > 1:
            seen[double[low : high - 1]] = True
            repeats = int(same[low : high - 1].sum()) * 64 // int(high - low)
            seen[runs[: repeats.bit_length()]] = True
        places = np.flatnonzero(seen)
        seen[places] = False
        found.append(places)
    return found


@dataclass
class Model:
    """Weights of the places times their log-count ratios, squared ratios for the lengths, bias, and the curve of scores."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def margins(self, rows: list[np.ndarray]) -> np.ndarray:
        sums = np.array([(self.weights[row].sum(), self.squares[row].sum()) for row in rows]).reshape(-1, 2)
        return sums[:, 0] / np.sqrt(np.maximum(sums[:, 1], 1e-12)) + self.bias

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(rows) + self.offset, -35, 35)))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log ratio of each place's smoothed share in the rows of label 1 to that in the others."""
    counts = np.full((2, BUCKETS), SMOOTHING)
    for row, label in zip(rows, labels, strict=True):
        counts[int(label), row] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def fit_margin(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """The hinge-loss model by dual coordinate descent; classes weigh the same in sum."""
    ratios = log_count_ratios(rows, labels)
    signs = np.where(labels == 1, 1.0, -1.0)
    share = np.mean(labels == 1)
    costs = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) * COST
    values = [ratios[row] / np.sqrt(max(1e-12, np.square(ratios[row]).sum())) for row in rows]
    weights, bias = np.zeros(BUCKETS), 0.0
    alphas = np.zeros(len(rows))
    random = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)):
            row, value = rows[i], values[i]
            slope = signs[i] * (weights[row] @ value + bias) - 1
            # Each row has length one, and one more for the bias.
            length = 2.0 if len(row) else 1.0
            alpha = min(max(alphas[i] - slope / length, 0.0), costs[i])
            step = (alpha - alphas[i]) * signs[i]
            if step:
                weights[row] += step * value
                bias += step
                alphas[i] = alpha
    return Model(weights * ratios, np.square(ratios), bias)


def fit_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margins to smoothed labels, by Newton steps."""
    ones, zeros = (labels == 1).sum(), (labels == 0).sum()
    wanted = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    inputs = np.stack([margins, np.ones_like(margins)])
    found = np.array([1.0, 0.0])
    for _ in range(50):
        guess = 1 / (1 + np.exp(-np.clip(found @ inputs, -35, 35)))
        curve = (inputs * (guess * (1 - guess))) @ inputs.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, inputs @ (guess - wanted) + 1e-6 * found)
        found = found - step * min(1.0, 5 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return float(found[0]), float(found[1])


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """The fitted and calibrated model of labelled rows."""
    flat = np.zeros(BUCKETS)
    ones = int((labels == 1).sum())
    if ones in (0, len(labels)):
        share = (ones + 1) / (len(labels) + 2)
        return Model(flat, flat, 0.0, 1.0, float(np.log(share / (1 - share))))
    fold = np.zeros(len(labels), np.int64)
    for label in (0, 1):
        own = np.flatnonzero(labels == label)
        fold[own] = np.arange(len(own)) % FOLDS
    margins = np.zeros(len(labels))
    for part in range(FOLDS):
        inside, outside = np.flatnonzero(fold != part), np.flatnonzero(fold == part)
        if len(outside) and 0 < (labels[inside] == 1).sum() < len(inside):
            margins[outside] = fit_margin([rows[i] for i in inside], labels[inside]).margins([rows[i] for i in outside])
    model = fit_margin(rows, labels)
    model.slope, model.offset = fit_curve(margins, labels)
    return model


def held_out(key: str) -> F.Column:
    """Whether a row's labels may not be learnt from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """The model of the labelled rows of ``docs`` that are not held out."""
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(key)).groupBy(key).agg(F.min(label).alias("label"))
    # At most SAMPLE ids, so the broadcast is bounded.
    chosen = known.orderBy(F.xxhash64(key), key).limit(SAMPLE)
    sample = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), key)
    sample = sample.groupBy(key, "text").agg(F.min("label").alias("label")).select("label", "text")

    def work(piece: pa.RecordBatch) -> list:
        return [piece.column(0), pa.array([row.astype(np.int32) for row in indicators(piece.column(1))], pa.list_(pa.int32()))]

    found = map_texts(sample, ["label", "text"], "label int, places array<int>", work)
    # Sorted, so that the fit does not depend on the order in which tasks end.
    table = found.orderBy(F.xxhash64("places"), "label").limit(SAMPLE).toArrow()
    places = table.column("places").combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int32()))
    rows = [np.asarray(row.values, np.int64) for row in places]
    return fit(rows, table.column("label").to_numpy().astype(np.int64) if table.num_rows else np.zeros(0, np.int64))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the ``score`` of each row's whole text."""
    kind = docs.schema[key].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(piece: pa.RecordBatch) -> list:
        return [piece.column(0), pa.array(sent.value.scores(indicators(piece.column(1))))]

    return map_texts(docs, [key, text], f"{key} {kind}, score double", work)


def keep(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with all their columns."""
    place = docs.columns.index(text)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            low = 0
            for piece in pieces(batch, place):
                stays = sent.value.scores(indicators(piece.column(place))) >= threshold
                yield batch.slice(low, piece.num_rows).filter(pa.array(stays))
                low += piece.num_rows

    return docs.mapInArrow(run, docs.schema)
