"""Quality classifier: naive Bayes support vectors over n-grams.

A text is the set of its character n-grams (orders 1 to 3, white space as one blank) and of
its word-shape n-grams (orders 1 to 4: repeats, capitals, symbols, punctuation), at 65,536
places.  Each indicator is scaled by its log-count ratio between the two classes,
texts are brought to unit length, and a linear hinge-loss model is fitted by dual coordinate
descent.  A sigmoid fitted to the margins turns them into scores between 0 and 1.

The fit uses a bounded sample of labelled rows: at most ``sample`` of either label, the first
by a hash of their id, so ratios, weights and sigmoid need no shuffle of texts and the model
has a fixed size.  Ids only select and shuffle; neither they nor any column but the text enter
a score.  Several labels of one id count as the lowest, of its texts the first by a hash is
taken.  With only one label, or none, the
score is the smoothed share of label 1 for every text.

A null or empty text has no n-grams and gets the score of a zero vector.  Repeated rows are
scored alike, an empty table gives an empty result, other columns are not read.  Texts are
read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import drawn_texts, map_batches

#: Places of the indicators: character n-grams are hashed to the first, the rest are n-grams
#: of word shapes.
PLACES, TEXT_PLACES = 1 << 16, 60_000
ORDERS, SHAPE_ORDERS = 3, 4
#: Bound of the training sample, per label.
SAMPLE = 3000
#: Score from which a text is predicted to have label 1.
THRESHOLD = 0.3

_PRIME = np.uint32(2654435761)


def _shape(words: list[str]) -> list[int]:
    """A digit below 8 per word: repeats the word before it, only capitals, no letter or
    digit, ends in a symbol, ends in punctuation, capitalised, other."""
    shapes, before = [], None
    for word in words:
        last = word[-1]
        if word == before:
            shapes.append(1)
        elif not (word.isalnum() or any(map(str.isalnum, word))):
            shapes.append(3)
        elif len(word) > 1 and word.isupper():
            shapes.append(2)
        elif last.isalnum():
            shapes.append(6 if word[0].isupper() else 7)
        else:
            shapes.append(5 if last in ".,;:!?" else 4)
        before = word
    return shapes


def grams(text: str | None) -> np.ndarray:
    """Sorted places of the distinct n-grams of a text."""
    marks = np.zeros(PLACES, dtype=bool)
    words = text.split() if text else []
    if not words:
        return np.flatnonzero(marks)
    codes = np.frombuffer(" ".join(words).encode("utf-32-le"), dtype="<u4") + np.uint32(1)
    mixed = codes * _PRIME
    for order in range(min(ORDERS, len(codes))):
        if order:
            mixed = (mixed[:-1] ^ (mixed[:-1] >> np.uint32(15))) * _PRIME + codes[order:]
        spread = ((mixed ^ (mixed >> np.uint32(13))) * _PRIME) >> np.uint32(16)
        marks[(spread * np.uint32(TEXT_PLACES)) >> np.uint32(16)] = True
    shapes = np.array(_shape(words))
    run, start = np.zeros(len(shapes) + 1, dtype=np.int64), TEXT_PLACES
    for order in range(min(SHAPE_ORDERS, len(shapes))):
        run = run[:-1] * 8 + shapes[order:]
        marks[start + run] = True
        start += 8 ** (order + 1)
    return np.flatnonzero(marks)


@dataclass
class Model:
    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, places: np.ndarray) -> float:
        if not len(places):
            return self.bias
        scaled = self.ratios[places]
        length = float(np.sqrt(scaled @ scaled)) or 1.0
        return float(scaled @ self.weights[places]) / length + self.bias

    def score(self, places: np.ndarray) -> float:
        at = self.slope * self.margin(places) + self.offset
        return float(1.0 / (1.0 + np.exp(-np.clip(at, -700, 700))))


def fit(texts: list[np.ndarray], labels: list[int], cost: float = 1.0, epochs: int = 20) -> Model:
    """Fit to n-gram sets and labels 0 or 1; the same input gives the same model."""
    y = np.array([1.0 if label else -1.0 for label in labels])
    n_good, n_bad = int((y > 0).sum()), int((y < 0).sum())
    zero = np.zeros(PLACES)
    if not n_good or not n_bad:
        return Model(zero, zero, 0.0, 0.0, float(np.log((n_good + 1) / (n_bad + 1))))
    counts = np.ones((2, PLACES))
    for places, label in zip(texts, y):
        counts[int(label > 0), places] += 1
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    rows = []
    for places in texts:
        scaled = ratios[places]
        rows.append(scaled / (np.sqrt(scaled @ scaled) or 1.0))
    weights, bias = np.zeros(PLACES), 0.0
    alpha = np.zeros(len(rows))
    limit = np.where(y > 0, cost * len(y) / (2 * n_good), cost * len(y) / (2 * n_bad))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            places, x = texts[i], rows[i]
            curvature = (1.0 if len(places) else 0.0) + 1.0  # unit length, and the bias
            slope = y[i] * (x @ weights[places] + bias) - 1.0
            new = min(max(alpha[i] - slope / curvature, 0.0), limit[i])
            step = (new - alpha[i]) * y[i]
            if step:
                weights[places] += step * x
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    model = Model(ratios, weights, bias, 1.0, 0.0)
    margins = np.array([model.margin(places) for places in texts])
    model.slope, model.offset = _sigmoid(margins, y > 0)
    return model


def _sigmoid(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method, with targets drawn in from 0 and 1."""
    n_good, n_bad = good.sum(), (~good).sum()
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    columns = np.stack([margins, np.ones_like(margins)], 1)
    at = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(columns @ at, -30, 30)))
        slope = columns.T @ (p - target) + 1e-3 * at
        bend = (columns * (p * (1 - p))[:, None]).T @ columns + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        at -= step * min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def fold(id_col: str, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds


def train(
    df: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model:
    """The model of a bounded sample of the labelled rows of ``df``."""
    single = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("id"))
        .agg(F.min(label_col).cast("int").alias("label"))
    )
    chosen = None
    for side in (F.col("label") == 1, F.col("label") != 1):
        part = single.filter(side).orderBy(F.xxhash64("id"), "id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most twice ``sample`` rows of two numbers, and as many texts drawn by them: small
    # however large the tables are and however many rows carry an id.
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def make():
        def work(columns):
            sets = [grams(text).astype("<u2").tobytes() for text in columns["text"]]
            return {"id": columns["id"], "label": columns["label"], "places": sets}

        return work

    drawn = map_batches(
        drawn_texts(rows, chosen), make, "id long, label int, places binary"
    )
    found = sorted({(r.id, r.label, bytes(r.places)) for r in drawn.collect()})
    texts = [np.frombuffer(r[2], dtype="<u2").astype(np.int64) for r in found]
    return fit(texts, [r[1] == 1 for r in found])


def score(
    df: DataFrame,
    model: Model,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row the id, ``score`` and ``predicted`` (1 from the threshold on)."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def make():
        found = sent.value

        def work(columns):
            scores = [found.score(grams(text)) for text in columns["text"]]
            return {id_col: columns["id"], "score": scores}

        return work

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_batches(rows, make, f"`{id_col}` long, score double").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
