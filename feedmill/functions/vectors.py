"""Dense vector work: dot products in the JVM, attention as Arrow-batched numpy.

A sequence travels as one flat ``array<double>`` of n * d numbers, so an Arrow
batch becomes a (rows, n, d) tensor without touching single elements.
"""

import functools
import operator
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

# Tasks get these functions by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: what a masked attention score becomes.
MASKED = -1e12

_UNROLLED = 64
# Rows worked on at once inside a task, so that the tensors stay small.
_CHUNK = 512


def dot(a: Column, b: Column, dim: int) -> Column:
    """Dot product; short vectors are written out so that the sum is compiled."""
    if dim <= _UNROLLED:
        return functools.reduce(operator.add, [F.get(a, F.lit(i)) * F.get(b, F.lit(i)) for i in range(dim)])
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def sigmoid(score: Column) -> Column:
    return 1 / (1 + F.exp(-score))


def fixed_weights(rows: int, cols: int, shift: int = 0) -> np.ndarray:
    """Weight table ((31 i + 17 j + shift) mod 13 - 6) / 50."""
    i, j = np.indices((rows, cols))
    return ((31 * i + 17 * j + shift) % 13 - 6) / 50.0


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def attend(x, weights, heads, causal=False, q_len=None, v_len=None) -> np.ndarray:
    """Multi-head self-attention of each sequence in ``x`` (rows, n, d) with itself.

    ``causal`` hides later positions, ``v_len`` hides keys beyond a row's length,
    ``q_len`` zeroes the output beyond it.
    """
    rows, n, _ = x.shape
    q, k, v = ((x @ w).reshape(rows, n, heads, -1).swapaxes(1, 2) for w in weights)
    scores = q @ k.swapaxes(2, 3) / np.sqrt(q.shape[-1])
    at = np.arange(n)
    if causal:
        scores = scores + np.where(at[None, :] > at[:, None], MASKED, 0.0)
    if v_len is not None:
        scores = np.where((at < v_len[:, None])[:, None, None, :], scores, MASKED)
    out = (_softmax(scores) @ v).swapaxes(1, 2).reshape(rows, n, -1)
    if q_len is not None:
        out = out * (at < q_len[:, None])[:, :, None]
    return out


def attention_scores(x, w, b, q) -> np.ndarray:
    """q . tanh(x W + b) for each vector in the last axis of ``x``."""
    return np.tanh(x @ w + b) @ q


def pool(x, w, b, q) -> np.ndarray:
    """Additive attention: the mean of each sequence weighted by softmax of its scores."""
    return np.einsum("rn,rnd->rd", _softmax(attention_scores(x, w, b, q)), x)


def _in_chunks(work, flat: pd.Series, n: int, dim: int, *lengths) -> pd.Series:
    out = []
    for lo in range(0, len(flat), _CHUNK):
        part = flat.iloc[lo : lo + _CHUNK]
        x = np.stack(part.to_numpy()).astype(np.float64, copy=False).reshape(len(part), n, dim)
        result = work(x, *[v.to_numpy()[lo : lo + _CHUNK] for v in lengths])
        out.extend(result.reshape(len(part), -1))
    return pd.Series(out)


def self_attention_udf(weights, heads, n, dim, causal=False):
    """flat sequence -> flat sequence."""
    @F.pandas_udf("array<double>")
    def apply(flat: pd.Series) -> pd.Series:
        return _in_chunks(lambda x: attend(x, weights, heads, causal), flat, n, dim)

    return apply


def masked_self_attention_udf(weights, heads, n, dim, causal=False):
    """(flat sequence, query length, key length) -> flat sequence."""
    @F.pandas_udf("array<double>")
    def apply(flat: pd.Series, q_len: pd.Series, v_len: pd.Series) -> pd.Series:
        def work(x, q, v):
            return attend(x, weights, heads, causal, q, v)

        return _in_chunks(work, flat, n, dim, q_len, v_len)

    return apply


def encode_sequence_udf(weights, heads, pooling, n, dim):
    """flat sequence -> one vector: self-attention, then additive pooling."""
    @F.pandas_udf("array<double>")
    def apply(flat: pd.Series) -> pd.Series:
        return _in_chunks(lambda x: pool(attend(x, weights, heads), *pooling), flat, n, dim)

    return apply


def attention_score_udf(w, b, q):
    """vector -> attention score."""
    @F.pandas_udf("double")
    def apply(vec: pd.Series) -> pd.Series:
        if vec.empty:
            return pd.Series([], dtype="float64")
        x = np.stack(vec.to_numpy()).astype(np.float64, copy=False)
        return pd.Series(attention_scores(x, w, b, q))

    return apply
