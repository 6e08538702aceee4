"""Quality classifier by positive-unlabelled learning.

A logistic model over features of whole texts, fitted to trusted positives and unlabelled web text by
the non-negative unbiased risk (softplus loss):

    R = prior * E_P[l(z)] + max(0, E_U[l(-z)] - prior * E_P[l(-z)])

Where the second part turns negative, its gradient is climbed back, so the model can't win by
overfitting the positives. The prior, the share of positives in unlabelled text, is estimated from
the same two samples: a positive-against-unlabelled model is fitted on one half, and over score
thresholds c the least ratio of P_U(score >= c) to P_P(score >= c) on the other half is taken, with a
margin for sampling error (best bin estimation). Labels of 0 are never read.

Features: square roots of the shares of byte values, and shares that describe words and lines. No
column but the text is an input.

Samples: at most `sample` positives and `sample` unlabelled rows, those with the smallest hashes of
their ids, so the bound does not grow with the table. They are the only rows that leave the
executors. Scores are computed by a vectorised function of the text alone; no row is shuffled.

Cases: null text counts as empty; an empty text has no features and gets the model's intercept. A
null id is never a training row. Without a positive every score is 0.5. Rows that repeat an id may
be drawn once each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fernlight.llm.common import chunks, column_bytes, span_hashes, word_spans

SAMPLE = 6000


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


# --- features

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = _LETTER[128:] = True
SHAPES = 7
WIDTH = 256 + SHAPES


def features(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(rows, WIDTH) features of the texts raw[at[k]:at[k + 1]]."""
    n = len(at) - 1
    out = np.zeros((n, WIDTH), np.float32)
    for i, j in chunks(at, 1 << 20):
        part, offsets = raw[at[i] : at[j]], at[i : j + 1] - at[i]
        size = np.diff(offsets)
        some = np.maximum(size, 1)
        row = np.repeat(np.arange(j - i, dtype=np.int64) << 8, size)
        seen = np.bincount(row + part, minlength=(j - i) << 8).reshape(j - i, 256)
        out[i:j, :256] = np.sqrt(seen / some[:, None])
        starts, ends, first = word_spans(part, offsets)
        words = np.diff(first)
        many = np.maximum(words, 1)
        if len(starts):
            of = np.repeat(np.arange(j - i), words)
            share = lambda x: np.bincount(of, weights=x, minlength=j - i) / many
            head, tail = part[starts], part[ends - 1]
            hashes = span_hashes(part, starts, ends)
            key = np.lexsort((hashes, of))
            new = np.ones(len(key), bool)
            new[1:] = (hashes[key][1:] != hashes[key][:-1]) | (of[key][1:] != of[key][:-1])
            out[i:j, 256] = share(_UPPER[head] & (ends - starts > 1) & _UPPER[part[starts + np.minimum(1, ends - starts - 1)]])
            out[i:j, 257] = share(~_LETTER[head])
            out[i:j, 258] = share(~_LETTER[tail])
            out[i:j, 259] = np.log1p(np.bincount(of[key], weights=new, minlength=j - i)) / np.log1p(many)
            out[i:j, 260] = np.minimum(share(ends - starts) / 20, 2)
            same = np.zeros(len(of), bool)
            same[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
            out[i:j, 261] = share(same)
        out[i:j, 262] = np.minimum(seen[:, 10] * 10 / many, 1)
    return out


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(x @ self.weights + self.bias)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(gradient, width: int, steps: int, rate: float) -> np.ndarray:
    """Adam from zero."""
    w, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)


def estimate_prior(p: np.ndarray, u: np.ndarray, decay: float = 1e-4) -> float:
    """Share of positives in u, by best bin estimation on the second halves."""
    train_p, train_u, test_p, test_u = p[::2], u[::2], p[1::2], u[1::2]

    def gradient(w):
        a, b = _sigmoid(train_p @ w) - 1, _sigmoid(train_u @ w)
        return train_p.T @ a / len(a) + train_u.T @ b / len(b) + decay * w

    w = _descend(gradient, p.shape[1], 300, 0.1)
    sp, su = np.sort(test_p @ w), np.sort(test_u @ w)
    at = np.unique(np.quantile(sp, np.linspace(0, 0.95, 200)))
    share_p, share_u = 1 - np.searchsorted(sp, at) / len(sp), 1 - np.searchsorted(su, at) / len(su)
    margin = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(sp)) + 1 / np.sqrt(len(su)))
    best = np.argmin((share_u + margin) / np.maximum(share_p, 1e-9))
    return float(np.clip(share_u[best] / max(share_p[best], 1e-9), 0.05, 0.99))


def risk_parts(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float]:
    """Both parts of the risk: prior * E_P[l(z)], and E_U[l(-z)] - prior * E_P[l(-z)], which is not to fall below 0."""
    zp, zu = p @ w, u @ w
    return prior * np.logaddexp(0, -zp).mean(), np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()


def risk_gradient(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float, decay: float) -> np.ndarray:
    """Gradient of the sum of both parts, or of the second's negative where it is below 0; and of decay / 2 * |w|^2."""
    sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
    rest = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
    if risk_parts(w, p, u, prior)[1] < 0:
        return -rest + decay * w
    return prior * (p.T @ (sp - 1)) / len(p) + rest + decay * w


def fit(positive: np.ndarray, unlabelled: np.ndarray, *, decay: float = 1e-4, steps: int = 500, rate: float = 0.1) -> Model:
    """Minimises the non-negative risk."""
    if len(positive) < 2 or len(unlabelled) < 2:
        return Model(np.zeros(WIDTH), 0.0, 0.5)
    p, u = _with_one(positive), _with_one(unlabelled)
    prior = estimate_prior(p, u)
    w = _descend(lambda w: risk_gradient(w, p, u, prior, decay), p.shape[1], steps, rate)
    return Model(w[:-1], float(w[-1]), prior)


# --- the operator


def _features_of(text: Column) -> Column:
    @F.arrow_udf("array<float>")
    def run(column: pa.Array) -> pa.Array:
        x = features(*column_bytes(column))
        return pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * WIDTH, x.ravel())

    return run(text)


def train(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fits the model to at most `sample` positives and `sample` unlabelled rows of docs, none of them held out."""
    few = lambda df: df.where(F.col("i").isNotNull() & ~held_out(F.col("i"))).orderBy(F.xxhash64("i"), "i").limit(sample).distinct()
    trusted = few(labels.where(F.col(label_col) == 1).select(F.col(id_col).cast("long").alias("i"))).withColumn("p", F.lit(True))
    web = few(docs.select(F.col(id_col).cast("long").alias("i"))).withColumn("p", F.lit(False))
    drawn = F.broadcast(trusted.union(web))  # 2 * sample rows at most
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).join(drawn, "i").select("p", _features_of(F.col("t")).alias("x"))
    got = rows.toArrow()
    x = got["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH) if got.num_rows else np.zeros((0, WIDTH), np.float32)
    is_p = got["p"].to_numpy(zero_copy_only=False).astype(bool) if got.num_rows else np.zeros(0, bool)
    order = np.lexsort(x[:, :64].T) if len(x) else np.zeros(0, np.int64)
    x, is_p = x[order], is_p[order]
    return fit(x[is_p], x[~is_p])


def score(text: Column, model: Model) -> Column:
    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        return pa.array(model.score(features(*column_bytes(column))))

    return run(text)


def score_quality(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, score, predicted."""
    model = train(docs, labels, sample=sample, id_col=id_col, text_col=text_col)
    out = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), score(F.col(text_col), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
