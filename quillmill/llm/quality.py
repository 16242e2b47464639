"""Quality scores by regularised quadratic discriminant analysis.

Each document is described by statistics of its bytes, words and lines, transformed to
be roughly normal. Each class has a mean and a covariance, shrunk towards the pooled
covariance and its diagonal; the Cholesky factors are computed once. A score is
the difference of the classes' log densities (Mahalanobis distances through the
factors, and log determinants), put through a logistic curve that is fitted, like the
shrinkage, on a fifth of the training rows. Model rows: at most TRAIN_ROWS labelled
ones, those of the least hash.

Defined cases: null texts are empty; an empty text has the statistics of no bytes, and
a score; without labelled rows of both classes every score is the share of label 1
(0.5 without labels); repeated rows give repeated results; a text may be of any length; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.ragged import chunks_by_size, offsets_of, worker
from quillmill.llm.spans import IS_SPACE, hash_spans

#: Labelled rows of statistics that the model is fitted on, at most.
TRAIN_ROWS = 50_000
SHRINKAGES = (0.02, 0.05, 0.1, 0.2, 0.4, 0.7)
CHUNK = 1_000_000

_CODES = np.arange(256)
_CLASSES = {
    "upper": (_CODES >= 65) & (_CODES <= 90),
    "lower": (_CODES >= 97) & (_CODES <= 122),
    "digit": (_CODES >= 48) & (_CODES <= 57),
    "beyond": _CODES >= 128,
    "space": IS_SPACE,
    "newline": _CODES == 10,
    "stop": np.isin(_CODES, [33, 46, 63]),  # ! . ?
    "exclaim": _CODES == 33,
    "comma": np.isin(_CODES, [44, 59, 58]),
    "symbol": np.isin(_CODES, [35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 92, 94, 95, 96, 124, 126]),
    "bracket": np.isin(_CODES, [40, 41, 91, 93, 123, 125, 34, 39]),
}
N_FEATURES = len(_CLASSES) + 12


def _sums(values: np.ndarray, offsets: np.ndarray, less: int = 0) -> np.ndarray:
    """Sums of the values from each offset to the next one, the last `less` of them left out."""
    running = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=running[1:])
    return running[offsets[1:] - less] - running[offsets[:-1]]


def _repeats(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By document: share of distinct items, and of the commonest one."""
    n = np.diff(offsets)
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(h)))
    most = np.zeros(len(n))
    np.maximum.at(most, d[at], runs)
    distinct = np.bincount(d[at], minlength=len(n))
    return distinct / np.maximum(n, 1), most / np.maximum(n, 1)


def statistics(texts: list[bytes]) -> np.ndarray:
    """Transformed statistics, texts x N_FEATURES."""
    lengths = np.array([len(t) for t in texts], np.int64)
    # two line feeds behind each text: words and lines end there
    offsets = offsets_of(lengths + 2)
    data = np.frombuffer(b"".join(t + b"\n\n" for t in texts), np.uint8)
    size = np.maximum(lengths, 1)
    share = lambda count, of: np.log((count + 0.5) / (of + 1.0))
    counts = {k: _sums(table[data], offsets) for k, table in _CLASSES.items()}
    counts["newline"] -= 2
    counts["space"] -= 2
    letters = counts["upper"] + counts["lower"] + counts["beyond"]
    out = [np.log1p(lengths)]
    out += [share(counts[k], letters if k == "upper" else size) for k in _CLASSES]

    word = ~IS_SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], word)).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    by_doc = np.searchsorted(starts, offsets)
    n_words = np.diff(by_doc)
    width = (ends - starts).astype(np.float64)
    mean = _sums(width, by_doc) / np.maximum(n_words, 1)
    square = _sums(width**2, by_doc) / np.maximum(n_words, 1)
    words = hash_spans(data, starts, ends)
    distinct, commonest = _repeats(words, by_doc)
    # words that the same word precedes; a text's first word has none before it
    again = np.zeros(len(words), bool)
    again[1:] = words[1:] == words[:-1]
    again[by_doc[:-1][n_words > 0]] = False
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    odd_end = _sums(_CLASSES["symbol"][last] | _CLASSES["exclaim"][last], by_doc)
    alone = _sums((ends - starts == 1) & _CLASSES["symbol"][last], by_doc)
    shout = _sums(_CLASSES["upper"][data[starts]] & _CLASSES["upper"][data[np.minimum(starts + 1, len(data) - 1)]], by_doc)
    out += [
        np.log1p(mean),
        np.log1p(np.sqrt(np.maximum(square - mean**2, 0))),
        np.log(distinct + 0.01) + 0.25 * np.log1p(n_words),  # distinct words fall slowly with the length
        np.log(commonest + 0.01),
        share(odd_end, n_words),
        share(alone, n_words),
        share(shout, n_words),
        share(_sums(again, by_doc), n_words),
    ]
    line_ends = np.flatnonzero(data == 10)
    line_starts = np.append(0, line_ends[:-1] + 1)
    keep = line_ends > line_starts
    line_starts, line_ends = line_starts[keep], line_ends[keep]
    lines_by_doc = np.searchsorted(line_starts, offsets)
    n_lines = np.diff(lines_by_doc)
    line_distinct, _ = _repeats(hash_spans(data, line_starts, line_ends), lines_by_doc)
    repeated = _sums(data[1:] == data[:-1], offsets, less=1)  # of bytes, neighbours that are equal
    out += [np.log1p(lengths / np.maximum(n_lines, 1)), np.log(1.02 - line_distinct * (n_lines > 0)), share(np.maximum(repeated - 1, 0), size)]
    return np.column_stack(out)


@dataclass
class Discriminant:
    prior: float
    means: np.ndarray | None = None  # 2 x features
    factors: np.ndarray | None = None  # 2 x features x features: inverse lower Cholesky factors
    logdets: np.ndarray | None = None
    scale: float = 1.0
    shift: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log density of class 1 less that of class 0."""
        logs = [
            -0.5 * (((x - self.means[c]) @ self.factors[c].T) ** 2).sum(axis=1) - 0.5 * self.logdets[c] for c in (0, 1)
        ]
        return logs[1] - logs[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.prior)
        z = np.clip(self.scale * self.difference(x) + self.shift, -40, 40)
        return 1 / (1 + np.exp(-z))


def _discriminant(x: np.ndarray, y: np.ndarray, shrinkage: float) -> Discriminant:
    """Covariances: half of the shrinkage goes to the pooled one, half to its diagonal."""
    groups = [x[y == c] for c in (0, 1)]
    means = np.array([g.mean(axis=0) for g in groups])
    spread = [(g - m).T @ (g - m) for g, m in zip(groups, means, strict=True)]
    pooled = sum(spread) / max(1, len(x) - 2)
    ridge = np.diag(np.maximum(np.diag(pooled), 1e-6))
    factors, logdets = [], []
    for g, s in zip(groups, spread, strict=True):
        own = s / max(1, len(g) - 1)
        chol = np.linalg.cholesky((1 - shrinkage) * own + shrinkage / 2 * (pooled + ridge))
        factors.append(np.linalg.inv(chol))
        logdets.append(2 * np.log(np.diag(chol)).sum())
    return Discriminant(float(y.mean()), means, np.array(factors), np.array(logdets))


def _logistic(d: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and shift of the curve, by Newton steps with a little damping."""
    d = np.clip(d, -60, 60)
    w = np.array([0.3, np.log((y.mean() + 0.01) / (1.01 - y.mean()))])
    a = np.column_stack((d, np.ones(len(d))))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        grad = a.T @ (p - y) + np.array([1e-3, 1e-3]) * w
        hess = (a * (p * (1 - p))[:, None]).T @ a + np.eye(2) * 1e-3
        step = np.linalg.solve(hess, grad)
        w = w - np.clip(step, -1, 1)
    return float(max(w[0], 1e-3)), float(w[1])


def fit(x: np.ndarray, y: np.ndarray) -> Discriminant:
    """x: rows of statistics, in an order that is as good as random; y: labels 0 and 1."""
    if len(y) == 0 or min((y == 0).sum(), (y == 1).sum()) < 10:
        return Discriminant(float(y.mean()) if len(y) else 0.5)
    held = np.arange(len(y)) % 5 == 4
    best = None
    for shrinkage in SHRINKAGES:
        if min((y[~held] == 0).sum(), (y[~held] == 1).sum()) < 2:
            break
        model = _discriminant(x[~held], y[~held], shrinkage)
        d = model.difference(x[held])
        scale, shift = _logistic(d, y[held])
        p = 1 / (1 + np.exp(-np.clip(scale * np.clip(d, -60, 60) + shift, -40, 40)))
        loss = -np.mean(np.log(np.where(y[held] == 1, p, 1 - p) + 1e-9))
        if best is None or loss < best[0]:
            best = (loss, shrinkage, scale, shift)
    if best is None:
        return Discriminant(float(y.mean()))
    model = _discriminant(x, y, best[1])
    model.scale, model.shift = best[2:]
    return model


def statistics_column(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    @worker("quality")
    def describe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for i, j in chunks_by_size(pa.compute.binary_length(texts).fill_null(0).to_pylist(), CHUNK):
                x = statistics([(t or "").encode() for t in texts[i:j].to_pylist()])
                ends = np.arange(j - i + 1, dtype=np.int32) * x.shape[1]
                yield pa.ListArray.from_arrays(pa.array(ends), pa.array(x.reshape(-1)))

    return describe(text)


def score_column(stats: Column, model: Discriminant) -> Column:
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            yield pa.array(model.score(rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)) if len(rows) else [], pa.float64())

    return score(stats)


def training_sample(described: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", label_col: str = "quality") -> tuple[np.ndarray, np.ndarray]:
    """At most TRAIN_ROWS rows of (statistics, label), those of the least hash of the id.

    A document is labelled once, however often its label is repeated; one whose labels
    differ, or are neither 0 nor 1, is not learned from. Rows of one id and equal
    statistics are one.
    """
    label = labels.groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).alias("y"), F.max(label_col).alias("other"))
    known = label.filter((F.col("y") == F.col("other")) & F.col("y").isin(0, 1))
    rows = (
        described.filter(usable)
        .select(F.col(id_col).alias("_doc"), "stats")
        .join(known, F.col("_doc") == F.col("_id"))
        .select(F.xxhash64("_doc").alias("h"), "stats", "y")
        .dropDuplicates()
        .orderBy("h", "y", "stats")
        .limit(TRAIN_ROWS)
        .collect()
    )
    return np.array([r["stats"] for r in rows], float).reshape(len(rows), -1 if rows else 0), np.array([r["y"] for r in rows], float)
