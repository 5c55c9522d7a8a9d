"""A score of text quality: support vectors over naive Bayes features.

The features of a text are indicators of the byte trigrams it has, hashed into a
fixed number of places, and of pairs of words that repeat each other, by the power
of two of their number.  Each is scaled by the log-ratio of its smoothed counts in
the two classes, a text's features are brought to unit length (short ones stay
below it, as they say less), and a linear hinge-loss model is fitted to them by
dual coordinate descent.  Margins of texts that the model had not seen turn into a
score through a fitted sigmoid, moved to the shares of the classes among all labels.

The training sample is bounded: ``PER_CLASS`` labelled texts of either class, of
which the places of their trigrams are brought to the driver, no texts.  Scoring
reads whole texts and nothing else.

Defined results: a null text counts as empty, an empty text has the score of no
feature; without labels every score is 0.5, with one class only it is that class;
equal texts have equal scores; an empty table gives no rows; columns other than
those named are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.common import bounded_batches, bounded_sample, whole_text
from threadloom.llm.words import grouped, word_hashes

GRAMS = 1 << 16
LEVELS = 16  # powers of two that numbers of repeated words are told apart by
PLACES = GRAMS + 2 * LEVELS
PER_CLASS = 1500
PENALTY = 1.0
PASSES = 12
FLOOR = 0.5
FOLDS = 3


def trigram_places(data):
    """The place of the trigram that starts at each byte; two fewer than bytes."""
    import numpy as np

    if len(data) < 3:
        return np.zeros(0, np.int32)
    wide = data.astype(np.uint32)
    grams = wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]
    return (grams * np.uint32(2654435761) >> 16).astype(np.int32)


def repeat_places(data, starts, ends):
    """For each text the places that tell how many of its words are like the word
    before, and how many like the word before that."""
    import numpy as np

    hashes, owner, _, _ = word_hashes(data, starts, ends)
    places = [[] for _ in starts]
    for k in (1, 2):
        same = owner[k:][(hashes[k:] == hashes[:-k]) & (owner[k:] == owner[:-k])]
        counts = np.bincount(same, minlength=len(starts))
        for i in np.flatnonzero(counts):
            level = min(LEVELS, int(counts[i]).bit_length())
            first = GRAMS + (k - 1) * LEVELS
            places[i].extend(range(first, first + level))
    return places


def places_of(texts):
    """The distinct places of each text of an Arrow column, one text at a time."""
    import numpy as np

    stamp = np.zeros(GRAMS, np.int32)
    for _, _, data, starts, ends in grouped(texts):
        for start, end, more in zip(starts.tolist(), ends.tolist(), repeat_places(data, starts, ends)):
            found = distinct_places(trigram_places(data[start:end]), stamp)
            yield np.concatenate([found, np.array(more, np.int32)]) if more else found


def distinct_places(places, stamp):
    """Each place once.  ``stamp`` has an entry per place, with any content."""
    import numpy as np

    order = np.arange(len(places), dtype=np.int32)
    stamp[places] = order
    return places[stamp[places] == order]


@dataclass
class Scorer:
    """What scoring needs: weights and squared scales per place, offset, sigmoid."""

    weights: object
    squares: object
    floor: float
    offset: float
    slope: float
    shift: float

    def margin(self, places) -> float:
        length = max(self.floor, float(self.squares[places].sum())) ** 0.5
        return float(self.weights[places].sum()) / length + self.offset

    def score(self, places) -> float:
        z = self.slope * self.margin(places) + self.shift
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


@dataclass
class Constant:
    """Every text has the same score."""

    value: float

    def score(self, places) -> float:
        return self.value


def log_ratios(rows, labels):
    """Of the smoothed shares of each place in the two classes."""
    import numpy as np

    counts = np.ones((2, PLACES))
    for places, label in zip(rows, labels):
        counts[label][places] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def floor_of(rows, scale) -> float:
    """The squared length below which a text's features are not stretched to one."""
    import numpy as np

    return FLOOR * float(np.median([(scale[r] ** 2).sum() for r in rows])) or 1.0


def descend(rows, labels, scale, floor, passes: int = PASSES, seed: int = 3):
    """Dual coordinate descent for the hinge loss: weights of the scaled, normed
    features, and the offset, which is the weight of a constant feature."""
    import numpy as np

    rng = np.random.default_rng(seed)
    weights, offset = np.zeros(PLACES), 0.0
    signs = np.where(np.asarray(labels) == 1, 1.0, -1.0)
    values = [scale[r] / max(floor, (scale[r] ** 2).sum()) ** 0.5 for r in rows]
    lengths = [float(v @ v) + 1.0 for v in values]
    share = np.bincount(labels, minlength=2)
    most = [PENALTY * len(labels) / (2 * share[label]) for label in labels]
    dual = np.zeros(len(rows))
    for _ in range(passes):
        for i in rng.permutation(len(rows)):
            gradient = signs[i] * (weights[rows[i]] @ values[i] + offset) - 1
            moved = min(max(dual[i] - gradient / lengths[i], 0.0), most[i]) - dual[i]
            if moved:
                dual[i] += moved
                weights[rows[i]] += moved * signs[i] * values[i]
                offset += moved * signs[i]
    return weights, offset


def sigmoid(margins, labels, rounds: int = 50):
    """Slope and shift of the logistic curve of labels over margins, by Newton's method."""
    import numpy as np

    margins, labels = np.asarray(margins, float), np.asarray(labels)
    high, low = int((labels == 1).sum()), int((labels == 0).sum())
    target = np.where(labels == 1, (high + 1) / (high + 2), 1 / (low + 2))
    slope, shift = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -500, 500)))
        error, spread = p - target, p * (1 - p) + 1e-9
        gradient = np.array([(error * margins).sum() + 1e-3 * slope, error.sum()])
        curve = np.array([[(spread * margins**2).sum() + 1e-3, (spread * margins).sum()], [(spread * margins).sum(), spread.sum() + 1e-9]])
        step = np.linalg.solve(curve, gradient)
        slope, shift = slope - step[0], shift - step[1]
        if abs(step).max() < 1e-8:
            break
    return float(slope), float(shift)


def fit(rows, labels, shares=None) -> Scorer | Constant:
    """The model of texts given by their distinct places and labels 0 and 1;
    ``shares`` are the numbers of either label where the texts were drawn from."""
    import numpy as np

    labels = np.asarray(labels, int)
    if len(set(labels.tolist())) < 2:
        return Constant(float(labels[0]) if len(labels) else 0.5)
    fold = np.zeros(len(labels), int)
    for value in (0, 1):
        own = np.flatnonzero(labels == value)
        fold[own] = np.arange(len(own)) % FOLDS
    unseen = np.zeros(len(labels))
    for k in range(FOLDS):
        own, others = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
        if len(set(labels[others].tolist())) < 2:
            others = np.arange(len(labels))  # too few labels to leave some out
        some = [rows[i] for i in others]
        scale = log_ratios(some, labels[others])
        floor = floor_of(some, scale)
        weights, offset = descend(some, labels[others], scale, floor)
        part = Scorer(weights * scale, scale**2, floor, offset, 1.0, 0.0)
        unseen[own] = [part.margin(rows[i]) for i in own]
    slope, shift = sigmoid(unseen, labels)
    if shares is not None and min(shares) > 0:
        drawn = np.bincount(labels, minlength=2)
        shift += math.log(shares[1] / shares[0]) - math.log(drawn[1] / drawn[0])
    scale = log_ratios(rows, labels)
    floor = floor_of(rows, scale)
    weights, offset = descend(rows, labels, scale, floor)
    return Scorer(weights * scale, scale**2, floor, offset, slope, shift)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Scorer | Constant:
    """A scorer learned from the labelled rows of ``docs``."""
    import numpy as np

    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("_l"), F.col(label_col).cast("int").alias("label"))
    # PER_CLASS ids of either class: bounded, so they are sent to the scan of the texts.
    chosen = bounded_sample(known, "label", "_l", PER_CLASS)
    texts = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("text"))
    sample = texts.join(F.broadcast(chosen), F.col("_id") == F.col("_l")).select("_id", "label", "text")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            found = [np.sort(p).astype(np.int32).tobytes() for p in places_of(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["id", "label", "places"])

    rows = sample.mapInArrow(run, "id long, label int, places binary").sort("id", "label").collect()
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = [np.frombuffer(bytes(r["places"]), np.int32) for r in rows]
    return fit(found, [r["label"] for r in rows], (counts.get(0, 0), counts.get(1, 0)))


def scored(docs: DataFrame, scorer: Scorer | Constant, text_col: str, *columns: Column | str) -> DataFrame:
    """``columns`` of ``docs`` with the score of the whole text."""
    bounded_batches(docs.sparkSession)
    given = docs.select(*columns, whole_text(text_col).alias("_text"))
    kept = [f for f in given.schema.fields if f.name != "_text"]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType())])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            scores = [scorer.score(places) for places in places_of(batch.column(batch.num_columns - 1))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*[f.name for f in kept], "score"])

    return given.mapInArrow(run, schema)
