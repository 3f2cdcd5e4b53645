"""Quality classifier: naive Bayes support vectors over n-gram indicators.

Indicators say which byte trigrams a whole text has, hashed to a fixed number of features, and
which patterns six neighbours show in the sequence "same word as before or another". They
are scaled by the log ratio of their smoothed counts in the two classes; a linear model with
hinge loss is fitted to them by dual coordinate descent, its margin mapped to 0..1 by a logistic
curve fitted to margins of rows left out in turn.

The fit uses a bounded sample of the labelled rows (``sample``: rows with the smallest hashes of
their ids), as bit sets of fixed size, on the driver. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import numbered, schemas
from quillmark.llm.words import BLANK_BYTES, byte_table, slices, word_codes, word_spans

BITS, SAMPLE, FOLDS, EPOCHS, PENALTY, SMOOTHING = 15, 6000, 3, 8, 1.0, 1.0
PIECE, ECHO = 4 << 20, 6
FEATURES = (1 << BITS) + (1 << ECHO)
WORD_TABLE = byte_table(BLANK_BYTES, lower=True)


def indicators(data: np.ndarray) -> np.ndarray:
    """Which features a text has, as booleans; a text under three bytes has none.

    A text of several pieces is taken piece by piece.
    """
    present = np.zeros(FEATURES, bool)
    for at in range(0, max(len(data) - 2, 0), PIECE):
        d = data[at : at + PIECE + 2].astype(np.uint32)
        grams = d[:-2] << np.uint32(16) | d[1:-1] << np.uint32(8) | d[2:]
        present[grams * np.uint32(2654435761) >> np.uint32(32 - BITS)] = True
        piece = data[at : at + PIECE]
        codes = word_codes(*word_spans(piece, np.array([0, len(piece)]), WORD_TABLE)[:3])
        same = codes[1:] == codes[:-1]
        if len(same) >= ECHO:
            pattern = np.zeros(len(same) - ECHO + 1, np.int64)
            for k in range(ECHO):
                pattern |= same[k : len(same) - ECHO + 1 + k].astype(np.int64) << k
            present[(1 << BITS) + pattern] = True
    return present


@dataclass
class Quality:
    """Weights of the indicators, bias, slope and offset of the logistic curve."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def parts(self) -> tuple:
        """Plain data for a broadcast, which carries no classes to executors without this package."""
        return self.weights, self.bias, self.slope, self.offset

    def margin(self, present: np.ndarray) -> float:
        """Of indicators as booleans or as a list of those present."""
        chosen = self.weights[present]
        return float(chosen.sum()) / float(np.sqrt(max(len(chosen), 1))) + self.bias

    def score(self, present: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(present) + self.offset, -700, 700))))


def log_count_ratios(features: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Per feature, the log of its smoothed share in class 1 over that in class 0."""

    def counts(label: int) -> np.ndarray:
        total = np.full(FEATURES, SMOOTHING)
        for f, y in zip(features, labels):
            if y == label:
                total[f] += 1
        return total

    one, zero = counts(1), counts(0)
    return np.log(one / one.sum()) - np.log(zero / zero.sum())


def hinge_fit(features: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, seed: int = 0) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the linear hinge loss; classes weigh the same in sum.

    Rows are indicators times ratios, divided by the root of the number of indicators.
    """
    sign = np.where(labels == 1, 1.0, -1.0)
    cost = PENALTY * np.where(labels == 1, 0.5 / max((labels == 1).mean(), 1e-9), 0.5 / max((labels == 0).mean(), 1e-9))
    values = [ratios[f] / np.sqrt(max(len(f), 1)) for f in features]
    square = np.array([float(v @ v) + 1 for v in values])
    w, bias, dual, rng = np.zeros(FEATURES), 0.0, np.zeros(len(features)), np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(features)):
            slack = sign[i] * (w[features[i]] @ values[i] + bias) - 1
            new = min(max(dual[i] - slack / square[i], 0.0), cost[i])
            step = (new - dual[i]) * sign[i]
            if step:
                w[features[i]] += step * values[i]
                bias += step
                dual[i] = new
    return w * ratios, bias


def logistic_fit(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the likeliest logistic curve, by Newton steps with a small penalty."""
    x, beta = np.column_stack([margins, np.ones(len(margins))]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), x.T @ (labels - p) - 1e-3 * beta)
        beta = beta + np.clip(step, -5, 5)
    return float(beta[0]), float(beta[1])


def train(packed: list[bytes], labels: list[int]) -> Quality:
    """A model of packed indicators; with one class only, or none, a constant: its smoothed share."""
    y = np.array(labels, np.int64)
    if len(set(labels)) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return Quality(np.zeros(FEATURES), 0.0, 0.0, float(np.log(share / (1 - share))))
    features = [np.flatnonzero(np.unpackbits(np.frombuffer(p, np.uint8))).astype(np.int32) for p in packed]
    fold, margins = np.arange(len(y)) % FOLDS, np.zeros(len(y))
    for k in range(FOLDS):
        out = fold == k
        if len(set(y[~out].tolist())) == 2:
            some = [f for f, left in zip(features, out) if not left]
            part = Quality(*hinge_fit(some, y[~out], log_count_ratios(some, y[~out])), 1.0, 0.0)
            margins[out] = [part.margin(f) for f, left in zip(features, out) if left]
    w, bias = hinge_fit(features, y, log_count_ratios(features, y))
    return Quality(w, bias, *logistic_fit(margins, y))


def held_out(id_col: str):
    """Rows never learned from: those whose CRC-32 of the id as text is a multiple of five. A null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE) -> Quality:
    """A model from at most ``sample`` labelled ids that are not held out.

    Labels that are null or neither 0 nor 1 are left out; an id with several labels counts with
    the smallest; a labelled id without a text teaches nothing, one with several texts each of
    them, up to the bound.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("_labelled")).agg(F.min(label_col).cast("int").alias("_label"))
    known = known.orderBy(F.xxhash64("_labelled"), "_labelled").limit(sample)
    rows = docs.select(F.col(id_col).alias("_labelled"), F.col(text_col).alias("text")).join(F.broadcast(known), "_labelled")
    schema, arrow = schemas("_labelled string, _label int, packed binary")

    def pack(batches):
        for batch in batches:
            packed = [
                np.packbits(indicators(data[a:b])).tobytes()
                for _, _, data, at in slices(batch.column("text"))
                for a, b in zip(at[:-1].tolist(), at[1:].tolist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column("_labelled"), batch.column("_label"), pa.array(packed, pa.binary())], schema=arrow)

    found = rows.select(F.col("_labelled").cast("string"), "_label", "text").mapInArrow(pack, schema)
    found = found.orderBy("_labelled", "packed").limit(2 * sample).collect()
    return train([bytes(r["packed"]) for r in found], [r["_label"] for r in found])


def score(docs: DataFrame, model: Quality, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``_row, doc_id, score`` for each row; only the text counts. A null text is empty, an empty one has the bias' score."""
    shipped = docs.sparkSession.sparkContext.broadcast(model.parts())
    schema, arrow = schemas(f"_row long, doc_id {docs.schema[id_col].dataType.simpleString()}, score double")

    def rate(batches):
        model = Quality(*shipped.value)
        for batch in batches:
            found = [
                model.score(indicators(data[a:b]))
                for _, _, data, at in slices(batch.column("text"))
                for a, b in zip(at[:-1].tolist(), at[1:].tolist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("doc_id"), pa.array(found, pa.float64())], schema=arrow)

    return numbered(docs, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(rate, schema)


def accepted(docs: DataFrame, model: Quality, least: float, text_col: str = "text") -> DataFrame:
    """The documents whose score is ``least`` or more, all columns.

    A null text is scored as an empty one; rows equal in text share their fate.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model.parts())

    def choose(batches):
        model = Quality(*shipped.value)
        for batch in batches:
            keep = [
                model.score(indicators(data[a:b])) >= least
                for _, _, data, at in slices(batch.column(batch.schema.get_field_index(text_col)))
                for a, b in zip(at[:-1].tolist(), at[1:].tolist())
            ]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(choose, docs.schema)
