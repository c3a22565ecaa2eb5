"""Quality by compression: how much better a text compresses with a dictionary of good text.

Two zstandard dictionaries are trained, on good and on bad labelled text. A text is cut into
chunks of 2,000 bytes, all of which are compressed with both; the size difference (bad minus
good) over all chunks, divided by the text's bytes, is the statistic. A logistic curve fitted on
labelled rows that no dictionary has seen turns it into a probability.

Bounds, all parameters: up to `per_class` labelled rows of each class for the dictionaries and as
many others for the curve, chosen by a hash of their ids; up to `chunks` chunks of each class, by
a hash too, go into a dictionary of `dict_bytes`. Scoring reads every whole text.

Null and empty texts have the statistic 0 and a score like any other. Where labels of one class
are missing, every score is the share of label 1 (0.5 without labels). Repeated rows and ids
repeat their score; several labels of an id count as 1 where any is; extra columns are not
returned; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import held_out, learnable, map_texts, pick, sample_ids

CHUNK = 2000
LEVEL = 3


def chunked(data: bytes) -> list[bytes]:
    return [data[i : i + CHUNK] for i in range(0, len(data), CHUNK)]


def train_dictionary(samples: list[bytes], dict_bytes: int) -> bytes:
    """A zstandard dictionary; of too little text, the text itself."""
    try:
        return zstandard.train_dictionary(dict_bytes, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-dict_bytes:]


class Difference:
    """Compressed-size difference per byte between two dictionaries."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self.good, self.bad = (self._compressor(d) for d in (good, bad))

    @staticmethod
    def _compressor(data: bytes) -> zstandard.ZstdCompressor:
        held = zstandard.ZstdCompressionDict(data)
        held.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False)

    def of(self, text: str | None) -> float:
        data = (text or "").encode("utf-8")
        if not data:
            return 0.0
        more = sum(len(self.bad.compress(c)) - len(self.good.compress(c)) for c in chunked(data))
        return more / len(data)


@dataclass
class Model:
    """dictionaries is None where a class is missing; then `prior` is every score."""

    dictionaries: tuple[bytes, bytes] | None
    slope: float
    offset: float
    prior: float

    def score(self, x: float) -> float:
        if self.dictionaries is None:
            return self.prior
        z = self.slope * x + self.offset
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a weighted, slightly ridged logistic regression, by Newton's method."""
    scale = float(x.std()) or 1.0
    a = np.column_stack([x / scale, np.ones_like(x)])
    w = np.zeros(2)
    ridge = np.diag([1e-3, 1e-6]) * weight.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (weight * (y - p)) - ridge @ w
        hessian = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    per_class: int = 2000,
    chunks: int = 6000,
    dict_bytes: int = 112_640,
) -> Model:
    known = learnable(labels, label)
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(n.values())
    prior = n.get(1, 0) / total if total else 0.5
    none = Model(None, 0.0, 0.0, prior)
    if len(n) < 2:
        return none
    halves = [known.where(F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == h) for h in (0, 1)]
    texts = pick(docs, "doc_id", "text").where(F.length("text") > 0)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (y, c)
                for y, t in zip(*(batch.column(k).to_pylist() for k in ("y", "text")), strict=True)
                for c in chunked(t.encode("utf-8"))
            ]
            ys, cs = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ys, pa.int32()), pa.array(cs, pa.binary())], names=["y", "chunk"]
            )

    pieces = (
        texts.join(F.broadcast(sample_ids(halves[0], per_class)), "doc_id")
        .select("y", "text")
        .mapInArrow(cut, "y int, chunk binary")
        .withColumn("o", F.xxhash64("chunk"))
    )
    samples = [
        [bytes(r["chunk"]) for r in pieces.where(F.col("y") == y).orderBy("o", "chunk").limit(chunks).collect()]
        for y in (1, 0)
    ]
    if not all(samples):
        return none
    good, bad = (train_dictionary(s, dict_bytes) for s in samples)
    chosen = texts.join(F.broadcast(sample_ids(halves[1], per_class)), "doc_id").select("y", "text")
    rows = _differences(chosen, good, bad).select("y", "difference").collect()
    x = np.array([r["difference"] for r in rows])
    y = np.array([r["y"] for r in rows], float)
    if not 0 < y.sum() < len(y):
        return none
    # the sample holds as many rows of either class at most; the curve is for all labelled rows
    weight = np.where(y == 1, prior / y.sum(), (1 - prior) / (len(y) - y.sum())) * len(y)
    return Model((good, bad), *fit_curve(x, y, weight), prior)


def _differences(rows: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    def start():
        of = Difference(good, bad).of
        return lambda texts: [[of(t) for t in texts]]

    return map_texts(rows, {"difference": "double"}, start, drop=("text",))


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""

    def start():
        of = Difference(*model.dictionaries).of if model.dictionaries else lambda t: 0.0
        return lambda texts: [[model.score(of(t)) for t in texts]]

    scored = map_texts(pick(docs, "doc_id", "text"), {"score": "double"}, start, drop=("text",))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
