"""Toxicity: a factorization machine over hashed terms of whole texts.

Terms are the lower-case words and the first letters of longer words, hashed to 2**18 places;
a text has each term once. The score is logistic in
    bias + sum(w_i) + sum over pairs (v_i . v_j)
so that pairs of terms weigh beyond their sum; the pair sum takes one pass:
((sum v_i)^2 - sum v_i^2) / 2. A term in `least_share` of the training texts has factors
whatever its own rate in either kind, so that a neutral term, such as a group mention, counts in the pairs
it forms. A term that the two kinds hold at different rates (by `least_z` standard errors) and
`least_docs` texts hold has factors and a weight of its own. Other terms count nothing. Training runs on a bounded sample of labelled rows (`most_rows`) by Adagrad on
mini-batches; a text contributes at most 2**18 places however long it is.

Null and empty texts have no term and score by the bias. Without labels every score is 0.5.
Repeated rows get equal scores; a null id is scored and not held out. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, training_sample
from .words import Words, chunks

BITS = 18
PREFIX = 5
_ROWS = 2000
_GAPS = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256))
_SPACE = np.array([b == 32 for b in range(256)])


def hashed_terms(texts: list[str | None], chunk_bytes: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(places, bounds): the different places of each text, ascending."""
    encoded = [(t or "").lower().encode("utf-8", "replace").translate(_GAPS) for t in texts]
    places, counts = [], [np.zeros(1, np.int64)]
    for a, b in chunks([len(t) for t in encoded], chunk_bytes):
        words = Words(encoded[a:b], _SPACE)
        long = np.flatnonzero(words.ends - words.starts > PREFIX)
        text = np.repeat(np.arange(b - a, dtype=np.uint64), words.counts)
        starts = words.starts[long]
        hashes = np.concatenate([words.hashes, words.spans(starts, starts + PREFIX) + np.uint64(1)])
        keys = np.unique(np.concatenate([text, text[long]]) << np.uint64(BITS) | hashes >> np.uint64(64 - BITS))
        counts.append(np.bincount((keys >> np.uint64(BITS)).astype(np.int64), minlength=b - a))
        places.append((keys & np.uint64((1 << BITS) - 1)).astype(np.int32))
    return np.concatenate(places) if places else np.zeros(0, np.int32), np.cumsum(np.concatenate(counts))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, 0, dtype=float)])
    return total[bounds[1:]] - total[bounds[:-1]]


@dataclass(frozen=True)
class Machine:
    bias: float
    weights: np.ndarray  # [place]
    factors: np.ndarray  # [place, factor]

    @cached_property
    def held(self) -> np.ndarray:
        return (self.weights != 0) | self.factors.any(1)

    def margins(self, places: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        # Most places are unknown and count nothing: they are left out before any sum.
        known = np.flatnonzero(self.held[places])
        bounds = np.searchsorted(known, bounds)
        v = self.factors[places[known]]
        return self.bias + _sums(self.weights[places[known]], bounds) + 0.5 * (_sums(v, bounds) ** 2 - _sums(v**2, bounds)).sum(1)

    def scores(self, places: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(places, bounds), -30, 30)))


def fit(places: np.ndarray, bounds: np.ndarray, y: np.ndarray, factors: int = 4, epochs: int = 15, batch: int = 256, rate: float = 0.3, decay: float = 2e-5, least_docs: int = 4, least_z: float = 3.0, least_share: float = 0.03) -> Machine:
    size = 1 << BITS
    rng = np.random.default_rng(7)
    docs_with = np.bincount(places, minlength=size)
    ones_with = np.bincount(places, np.repeat(y, np.diff(bounds)), size)
    ones, p = max(y.sum(), 1.0), docs_with / max(len(y), 1)
    zeros = max(len(y) - ones, 1.0)
    z = abs(ones_with / ones - (docs_with - ones_with) / zeros) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / ones + 1 / zeros))
    alone = (docs_with >= least_docs) & (z >= least_z)  # terms with a weight of their own
    held = alone | (docs_with >= max(least_docs, least_share * len(y)))
    w, v = np.zeros(size, np.float32), (rng.normal(0, 0.01, (size, factors)) * held[:, None]).astype(np.float32)
    if not len(y):
        return Machine(0.0, w, v)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(share / (1 - share)))
    kept = np.flatnonzero(held[places])
    places, bounds = places[kept], np.searchsorted(kept, bounds)
    gw, gv = np.full(size, 1e-6, np.float32), np.full((size, factors), 1e-6, np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), batch):
            rows = order[k : k + batch]
            lengths = bounds[rows + 1] - bounds[rows]
            own = np.concatenate([[0], np.cumsum(lengths)])
            at = np.repeat(bounds[rows] - own[:-1], lengths) + np.arange(own[-1])
            p, row = places[at], np.repeat(np.arange(len(rows)), lengths)
            sums = _sums(v[p], own)
            margin = bias + _sums(w[p], own) + 0.5 * (sums**2 - _sums(v[p] ** 2, own)).sum(1)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[rows]) / len(rows)
            terms, inverse = np.unique(p, return_inverse=True)
            e = error[row]
            dw = np.bincount(inverse, e, len(terms)) + decay * w[terms]
            dv = np.column_stack([np.bincount(inverse, e * (sums[row, f] - v[p, f]), len(terms)) for f in range(factors)]) + decay * v[terms]
            gw[terms] += dw**2
            gv[terms] += dv**2
            w[terms] -= rate * dw / np.sqrt(gw[terms]) * alone[terms]
            v[terms] -= 0.3 * rate * dv / np.sqrt(gv[terms])
            bias -= rate * error.sum()
    return Machine(float(bias), w, v)


def _terms_column(texts: list[str | None]) -> pa.Array:
    places, bounds = hashed_terms(texts)
    return pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(places))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most_rows: int = 12_000) -> Machine:
    sample = training_sample(docs, labels, label, most_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, _ROWS):
                part = batch.slice(k, _ROWS)
                yield pa.RecordBatch.from_arrays([part.column("label"), _terms_column(part.column("text").to_pylist())], ["label", "terms"])

    rows = sample.mapInArrow(run, "label int, terms array<int>").toArrow()
    lists = rows.column("terms").combine_chunks()
    bounds = np.asarray(lists.offsets, np.int64)
    return fit(np.asarray(lists.values), bounds, np.asarray(rows.column("label"), float))


def score(docs: DataFrame, model: Machine, threshold: float = 0.5, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """docs (all columns) with the score and the prediction under `names`; columns of these names are replaced."""
    docs = docs.drop(*names)
    schema = docs.withColumns({names[0]: F.lit(0.0), names[1]: F.lit(0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, _ROWS):
                part = batch.slice(k, _ROWS)
                scores = model.scores(*hashed_terms(part.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], [*part.schema.names, *names])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.5, most_rows: int = 12_000) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    slim = docs.select(F.col("doc_id").cast("long"), "text")
    scored = score(slim, train(slim, labels, label, most_rows), threshold)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
