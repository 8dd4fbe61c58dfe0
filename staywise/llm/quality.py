"""Quality classifier: random Fourier features over document statistics,
ridge regression by partition-summed normal equations, isotonic calibration.

Statistics of a text (lengths, character classes, repeated words and lines)
are computed over the whole text.  Cosines of random projections of the
standardised statistics approximate a Gaussian kernel; the ridge weights solve
(X'X + l I) w = X'y, where every partition adds its own X'X and X'y, fold by
fold.  Scores become probabilities by isotonic regression of the labels on
scores by the weights of the other folds.

Defined cases: null and empty texts have all-zero statistics and get the score
of such a text; labels that are null are no labels; several labels of one id
count as their mean; without both kinds of label every score is 1 (nothing is
rejected untaught); a row without id is scored, never learnt from and not held
out; very long texts count whole; an empty table gives an empty result; other
columns are carried untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_workers, table, whole_row, written

HELD_OUT_MOD = 5
THRESHOLD = 0.3
# Labelled rows used for fitting, about: the expected size of a sample by hash.
SAMPLE = 60_000
FEATURES = 256   # random Fourier features
RIDGE = 1.0
PARTS = 5        # folds of the calibration
SUMMING = 8      # tasks that add up the sample
BINS = 1000      # score bins of the calibration
SEED = 9

# Byte classes of the statistics.
CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz",
           "digit": b"0123456789", "space": b" \t\r\n\v\f", "stop": b".,;:?", "shout": b"!",
           "table": b"|<>=_/\\{}[]", "symbol": b"#$%&*+@^~`", "quote": b"\"'()-"}
CLASS_OF = np.full(256, len(CLASSES))
for _i, _b in enumerate(CLASSES.values()):
    CLASS_OF[list(_b)] = _i
NAMES = [*CLASSES, "other", "log_chars", "log_words", "word_length", "distinct", "adjacent", "log_lines",
         "same_lines", "line_words", "stop_words", "shout_words", "symbol_words", "longest"]


def statistics(text: str | None) -> list[float]:
    """The statistics NAMES of one whole text."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    counts = np.bincount(CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=len(CLASSES) + 1)
    by = dict(zip(CLASSES, counts.tolist()))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [*(counts / len(raw)).tolist(),
            np.log1p(len(raw)), np.log1p(n), np.log1p((len(raw) - by["space"]) / n),
            len(set(words)) / n ** 0.9, sum(map(eq, words, words[1:])) / n,
            np.log1p(len(lines)), 1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)),
            by["stop"] / n, by["shout"] / n, (by["symbol"] + by["table"]) / n, np.log1p(max(map(len, words)))]


def matrix(texts: pd.Series) -> np.ndarray:
    return np.array([statistics(t) for t in texts], float).reshape(len(texts), len(NAMES))


def projection(seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Directions and phases; the kernel's width is the root of the number of
    statistics."""
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((len(NAMES), FEATURES)) / np.sqrt(len(NAMES)), rng.uniform(0, 2 * np.pi, FEATURES))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None = None
    edges: np.ndarray | None = None    # raw scores
    values: np.ndarray | None = None   # calibrated scores there

    def features(self, stats: np.ndarray) -> np.ndarray:
        """[1, standardised statistics, cosines]; statistics are clipped, so a
        text unlike all others stays in reach of what was learnt."""
        z = np.clip((stats - self.mean) / self.scale, -5, 5)
        w, b = projection()
        return np.hstack([np.ones((len(z), 1)), z, np.cos(z @ w + b) * np.sqrt(2 / FEATURES)])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.values is None:
            return np.ones(len(stats))
        return np.interp(self.raw(stats), self.edges, self.values)


def summed(rows: DataFrame, arrays) -> dict[int, np.ndarray]:
    """Sums over all rows of ``arrays(stats, y, fold)``, equally long vectors: every partition adds up its own, Spark adds those by position.
    The result's size is fixed by the number of features."""
    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for b in batches:
            if len(b):
                x = arrays(np.vstack(b["stats"].to_numpy()), b["y"].to_numpy(float), b["fold"].to_numpy())
                total = x if total is None else total + x
        if total is not None:
            yield pd.DataFrame({"i": range(len(total)), "v": list(total)})

    def add(b: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": b["i"][:1], "v": [np.sum(np.vstack(b["v"].to_numpy()), axis=0)]})

    # the rows are a bounded sample, whatever number of files they lie in
    sums = rows.coalesce(SUMMING).mapInPandas(part, "i int, v array<double>").groupBy("i").applyInPandas(add, "i int, v array<double>")
    return {r.i: np.array(r.v) for r in sums.collect()}


def pool_adjacent(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Isotonic (non-decreasing) least-squares fit."""
    blocks: list[list[float]] = []
    for v, w in zip(values.tolist(), weights.tolist()):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks[-1]
            blocks[-1] = [(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2]
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def levels(good: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Isotonic values of bins with ``n`` rows, ``good`` of them good.  A
    level's value is drawn towards the overall share by two rows, so that thin
    ends stay moderate; since that moves thin levels more than others, the
    drawn values are fitted once more and never fall."""
    fitted = pool_adjacent(good / n, n)
    _, level = np.unique(fitted, return_inverse=True)
    mass = np.bincount(level, weights=n)[level]
    return pool_adjacent((fitted * mass + 2 * good.sum() / n.sum()) / (mass + 2), n)


def calibrate(model: Model, rows: DataFrame, others: list[np.ndarray]) -> None:
    """Isotonic fit over BINS bins of the raw score, each row scored by the
    weights learnt without its fold."""
    weights = np.array(others)

    def binned(stats, y, fold):
        raw = (model.features(stats) * weights[fold]).sum(1)
        k = np.clip(((raw + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
        return np.array([np.bincount(k, minlength=BINS), np.bincount(k, weights=y, minlength=BINS)])

    sums = summed(rows, binned)
    n, good = sums[0], sums[1]
    used = n > 0
    model.edges = (np.flatnonzero(used) + 0.5) / BINS * 2 - 0.5
    model.values = levels(good[used], n[used])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """Learn from the labelled rows outside the held-out fold.  Above
    ``sample`` of them, a hash of the id chooses about that many; the fit,
    not the scoring, is bounded by it."""
    python_workers(docs.sparkSession)
    marks = (labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
             .filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT_MOD != 0)
             .groupBy(F.col("doc_id").alias("id")).agg(F.avg(label_col).alias("y")))
    n = marks.count()
    marks = marks.withColumn("h", F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / float(1 << 40))
    if n > sample:
        marks = marks.filter(F.col("h") < sample / n)
    stats = F.pandas_udf(lambda s: pd.Series(list(matrix(s))), "array<double>")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # the sample's ids: about ``sample`` rows at most, whatever the tables hold
    rows = written(texts.join(F.broadcast(marks), "id")
                   .select("y", F.pmod(F.hash("h"), F.lit(PARTS)).alias("fold"), stats("text").alias("stats")),
                   "labelled")
    moments = summed(rows, lambda x, y, fold: np.array(
        [x.sum(0), (x * x).sum(0), np.resize([len(x), y.sum()], x.shape[1])]))
    if not moments or not 0 < moments[2][1] < moments[2][0]:
        return Model(np.zeros(len(NAMES)), np.ones(len(NAMES)))
    count = moments[2][0]
    mean = moments[0] / count
    scale = np.sqrt(np.maximum(moments[1] / count - mean ** 2, 0))
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0))

    def equations(x, y, fold):
        f = model.features(x)
        parts = [(f[fold == k], y[fold == k]) for k in range(PARTS)]
        return np.vstack([m for a, b in parts for m in (a.T @ a, a.T @ b)])

    sums = summed(rows, equations)
    size = len(sums) // PARTS - 1
    folds = [np.vstack([sums[k * (size + 1) + i] for i in range(size + 1)]) for k in range(PARTS)]
    ridge = RIDGE * np.eye(size)
    ridge[0, 0] = 1e-9

    def solve(total: np.ndarray) -> np.ndarray:
        return np.linalg.solve(total[:size] + ridge, total[size])

    model.weights = solve(sum(folds))
    calibrate(model, rows, [solve(sum(folds) - f) for f in folds])
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (the whole input row), doc_id and score."""
    python_workers(docs.sparkSession)
    scored = F.pandas_udf(lambda s: pd.Series(model.score(matrix(s))), "double")
    return docs.select(whole_row(docs), F.col(id_col).alias("doc_id"), scored(F.col(text_col)).alias("score"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored at ``threshold`` or above."""
    return score(docs, fit(docs, labels)).filter(F.col("score") >= threshold).select("row.*")


def op9_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT_MOD == 0, F.lit(False))
    return score(docs, fit(docs, table(spark, sf_dir, "labels"))).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
