"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

Trees are complete and lie in flat arrays (feature, threshold by node; value by leaf), so that
all texts of a batch walk down a tree level by level with numpy. Training runs on a bounded
sample of labelled rows (`most_rows`), whose statistics are at most most_rows * 14 numbers.

Null and empty texts have zero statistics and a score like any other. Without labels every
score is the prior 0.5; with labels of one kind only, a constant. Repeated rows get equal scores. A
null id is scored and not held out. Extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import NAMES, text_statistics
from .labelled import held_out, training_sample

_ROWS = 2000


@dataclass(frozen=True)
class Trees:
    base: float
    feature: np.ndarray  # [tree, inner node]
    threshold: np.ndarray  # [tree, inner node]; values above go right
    value: np.ndarray  # [tree, leaf]

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(feature) + 1))):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - len(feature)]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, least: float = 5.0) -> Trees:
    """Logistic loss with second-order leaf values; splits between quantile bins of each feature."""
    inner = 2**depth - 1
    if not len(y):
        return Trees(0.0, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)])
    rate_of_ones = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    margin = np.full(len(y), np.log(rate_of_ones / (1 - rate_of_ones)))
    base, features, thresholds, values = float(margin[0]), [], [], []
    offsets = np.arange(x.shape[1]) * bins
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            cells = ((node - first)[:, None] * x.shape[1] * bins + offsets + binned).ravel()
            sums = lambda w: np.bincount(cells, np.repeat(w, x.shape[1]), n * x.shape[1] * bins).reshape(n, x.shape[1], bins).cumsum(2)  # noqa: E731, B023
            gl, hl = sums(g), sums(h)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
            gain[(hl < least) | (ht - hl < least)] = 0
            gain = gain.reshape(n, -1)
            best = gain.argmax(1)
            for k, cell in enumerate(best):
                f, b = divmod(int(cell), bins)
                if gain[k, cell] > 1e-6 and b < len(edges[f]):
                    feature[first + k], threshold[first + k] = f, edges[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
        margin = margin + value[leaf]
        features.append(feature), thresholds.append(threshold), values.append(value)
    return Trees(base, np.array(features), np.array(thresholds), np.array(values))


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns `keep` and `x`, the statistics of the whole text."""
    schema = docs.select(*keep).withColumn("x", F.array(F.lit(0.0))).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, _ROWS):
                part = batch.slice(k, _ROWS)
                x = text_statistics(part.column("text").to_pylist())
                lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), lists], [*keep, "x"])

    return docs.select(*keep, "text").mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = 20_000) -> Trees:
    rows = statistics(training_sample(docs, labels, label, most_rows), "doc_id", "label").select("label", "x").toPandas()
    x = np.array(rows["x"].tolist(), float).reshape(-1, len(NAMES))
    return fit(x, rows["label"].to_numpy(float))


def score(docs: DataFrame, model: Trees, threshold: float = 0.3, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """docs (all columns) with the score and the prediction under `names`; columns of these names are replaced."""
    docs = docs.drop(*names)
    schema = docs.withColumns({names[0]: F.lit(0.0), names[1]: F.lit(0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, _ROWS):
                part = batch.slice(k, _ROWS)
                scores = model.scores(text_statistics(part.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], [*part.schema.names, *names])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3, most_rows: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    slim = docs.select(F.col("doc_id").cast("long"), "text")
    scored = score(slim, train(slim, labels, label, most_rows), threshold)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
