"""Quality scores: ridge regression on random Fourier features of document statistics, calibrated.

Random Fourier features cos(Wx + b) approximate a Gaussian kernel over the standardised statistics. Each
partition of the training rows sums its own normal equations, Spark adds them up by matrix row, and the
driver solves one small system. Isotonic regression over binned training scores turns raw scores into shares.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import Scratch, importable, whole
from brookmart.llm.language import held_out

FEATURES, RIDGE, SEED = 256, 1e-3, 11
#: Bound of the training rows: about so many labelled documents, drawn by a hash of their identifiers.
TRAIN_ROWS, TRAIN_PARTS = 200_000, 32
BINS = 4096
STATISTICS = (
    "log characters", "log words", "characters a word", "lower-case letters", "capitals", "digits", "white space", "full stops and commas",
    "exclamation marks", "bars", "other marks", "bytes beyond ASCII", "byte entropy", "distinct words", "most frequent word",
    "repeated lines", "words a line", "compressed size", "words of capitals", "words ending in a mark",
)
_KIND = np.full(256, 9)
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 0, 1, 2
_KIND[[32, 9, 10, 11, 12, 13]], _KIND[[46, 44]], _KIND[33], _KIND[124] = 3, 4, 5, 6
_KIND[128:] = 7


def statistics(text: str) -> list[float]:
    """The numbers named in STATISTICS; all are finite for any text, the empty one included."""
    data = text.encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n = max(1, len(data))
    kinds = np.bincount(_KIND, counts, 10) / n
    share = counts[counts > 0] / n
    words = text.split()
    m = max(1, len(words))
    often = Counter(words)
    lines = [x for x in text.split("\n") if x]
    capitals = sum(map(str.isupper, often))
    marked = sum(not w[-1].isalnum() and w[-1] not in ".,!" for w in often)
    return [
        np.log1p(len(text)), np.log1p(len(words)), min(len(text) / m, 100.0), *kinds[:7], kinds[9], kinds[7],
        float(-(share * np.log2(share)).sum()), len(often) / m * np.log1p(m) / 5, max(often.values(), default=0) / m,
        1 - len(set(lines)) / max(1, len(lines)), min(m / max(1, len(lines)), 200.0) / 50, len(zlib.compress(data, 1)) / (n + 20),
        capitals / max(1, len(often)), marked / max(1, len(often)),
    ]


def fourier(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Rows of the design matrix: the Fourier features, the statistics themselves and a constant."""
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(SEED)
    w = rng.normal(size=(z.shape[1], FEATURES)) / np.sqrt(z.shape[1])
    return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ w + rng.uniform(0, 2 * np.pi, FEATURES)), z, np.ones((len(z), 1))])


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``values`` in weighted squares (adjacent violators are pooled)."""
    pools: list[list[float]] = []
    for v, w in zip(values, weights, strict=True):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v2, w2, n2 = pools.pop()
            v1, w1, n1 = pools[-1]
            pools[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.repeat([p[0] for p in pools], [int(p[2]) for p in pools])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return fourier(x, self.mean, self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated scores in [0, 1], linear between the middles of the bins."""
        return np.clip(np.interp(self.raw(x), self.knots, self.levels), 0, 1)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics of its whole text (null is empty), for every row."""
    importable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(F.col(text_col)).alias("text"))
    return rows.mapInArrow(run, "doc_id long, x array<double>")


def _matrix(column) -> np.ndarray:
    return np.array(column.tolist()).reshape(len(column), len(STATISTICS))


def fit(stats: DataFrame, labels: DataFrame, scratch: Scratch, id_col: str = "doc_id", label_col: str = "quality") -> Model | None:
    """Learn from the statistics of labelled documents; None if there are none.

    A document labelled more than once counts with its mean label. Labels without identifier or value are left out.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        F.avg(F.col(label_col).cast("double")).alias("y"))
    share = TRAIN_ROWS / max(1, known.count())
    drawn = known.where(F.xxhash64("doc_id") / 2.0**64 + 0.5 < share)
    train = scratch.keep(stats.join(drawn, "doc_id").select("x", "y").repartition(TRAIN_PARTS), "train")
    k = len(STATISTICS)
    m = train.agg(F.count(F.lit(1)), *(f(F.col("x")[i]) for f in (F.avg, F.stddev_pop) for i in range(k))).first()
    if not m[0]:
        return None
    mean, scale = np.array(m[1:k + 1]), np.array(m[k + 1:])
    scale[scale < 1e-9] = 1.0

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for f in frames:
            p = fourier(_matrix(f["x"]), mean, scale)
            part = p.T @ np.column_stack([p, f["y"]])
            total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"i": range(len(total)), "v": list(total)})

    def add(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": f["i"].iloc[:1], "v": [np.sum(np.stack(f["v"].tolist()), axis=0)]})

    rows = train.mapInPandas(sums, "i int, v array<double>").groupBy("i").applyInPandas(add, "i int, v array<double>").collect()
    system = np.array([r["v"] for r in sorted(rows, key=lambda r: r["i"])])
    a, b = system[:, :-1], system[:, -1]
    penalty = RIDGE * m[0] / FEATURES * np.eye(len(a))
    penalty[-1, -1] = 0.0
    model = Model(mean, scale, np.linalg.solve(a + penalty, b), np.zeros(1), np.zeros(1))

    def raw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            r = model.raw(_matrix(f["x"]))
            yield pd.DataFrame({"bin": np.clip((r + 0.5) * BINS / 2, 0, BINS - 1).astype(int), "r": r, "y": f["y"]})

    bins = train.mapInPandas(raw, "bin int, r double, y double").groupBy("bin").agg(
        F.avg("r").alias("r"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("n")).orderBy("bin").toPandas()
    model.knots, model.levels = bins["r"].to_numpy(), isotonic(bins["y"].to_numpy(), bins["n"].to_numpy())
    return model


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                  folds: int = 5, fold: int = 0, threshold: float = 0.3) -> DataFrame:
    """Learn from labelled documents outside one fold and score every row: doc_id, held_out, score, predicted.

    ``held_out`` marks identifiers whose checksum falls into the fold; these and null identifiers are not learned from. Null and
    empty texts are scored like others, by their statistics. Without training rows every score is 0.5. One row per row of ``docs``;
    its columns other than identifier and text are not read.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    stats = scratch.keep(document_statistics(docs, id_col, text_col), "statistics")
    out = held_out(F.col("doc_id"), folds, fold)
    model = fit(stats.where(~out), labels, scratch, id_col, label_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(STATISTICS))
            score = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.record_batch([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    scored = stats.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
