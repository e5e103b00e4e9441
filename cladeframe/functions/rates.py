"""Transition probabilities of a discrete trait, ``P(t) = exp(Q t)``, and the search for rates.

With equal rates (ER) the matrix has a closed form and stays in the JVM.  Other
models go through one vectorised function that exponentiates the distinct
branch lengths of a batch.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


#: With ``d`` this value, staying has probability ``1/k + (1 - 1/k) d`` under
#: equal rates, and each change ``(1 - d) / k``.
ER_DECAY = "exp(-{k}d * rate * branch_length)"

#: Log-likelihoods whose difference is a smaller part of them are equal: sums leave so much.
SAME = 1e-12

#: A maximum is found when its neighbours are so close, in logarithms of the rate; peaks with
#: neighbours farther apart than ``COARSE`` are all looked at.
NARROW, COARSE = 1e-6, 0.6


def er_probability(k: int, same: Column, rate="rate", length="branch_length") -> Column:
    """Entry of the ER transition matrix, on the diagonal where ``same``."""
    d = F.exp(-F.lit(float(k)) * F.col(rate) * F.col(length))
    stay = F.lit(1.0 / k) + F.lit(1.0 - 1.0 / k) * d
    return F.when(same, stay).otherwise((F.lit(1.0) - d) / F.lit(float(k)))


def er_matrix(k: int, rate: float) -> np.ndarray:
    """Rate matrix with one rate for every change."""
    q = np.full((k, k), float(rate))
    np.fill_diagonal(q, -rate * (k - 1))
    return q


def rate_matrix(k: int, model: str, rates) -> np.ndarray:
    """Rate matrix from its free parameters: 1 (ER), k(k-1)/2 (SYM, upper
    triangle by rows) or k(k-1) (ARD, off-diagonal by rows)."""
    q = np.zeros((k, k))
    if model == "ER":
        q[:] = rates[0]
    elif model == "SYM":
        upper = np.triu_indices(k, 1)
        q[upper] = rates
        q = q + q.T
    elif model == "ARD":
        q[~np.eye(k, dtype=bool)] = rates
    else:
        raise ValueError(f"model must be ER, SYM or ARD, got {model!r}")
    np.fill_diagonal(q, 0.0)
    np.fill_diagonal(q, -q.sum(axis=1))
    return q


def free_rates(k: int, model: str) -> int:
    return {"ER": 1, "SYM": k * (k - 1) // 2, "ARD": k * (k - 1)}[model]


def expm_batch(q: np.ndarray, times: np.ndarray) -> np.ndarray:
    """``exp(q t)`` for every time: scale each by a power of two until its norm is
    at most 1/2, sum the Taylor series, square back."""
    a = q[None, :, :] * np.asarray(times, dtype=float)[:, None, None]
    norm = max(float(np.abs(a).sum(axis=2).max(initial=0.0)), 1e-300)
    squarings = max(0, math.ceil(math.log2(norm)) + 1)
    a = a / 2.0**squarings
    total = np.broadcast_to(np.eye(q.shape[0]), a.shape).copy()
    term = total.copy()
    for n in range(1, 19):
        term = term @ a / n
        total += term
    for _ in range(squarings):
        total = total @ total
    return total


def matrix_messages(k: int):
    """Pandas function ``(q flattened, length, likelihoods) -> P(t) . likelihoods``."""

    @F.pandas_udf("array<double>")
    def message(q: pd.Series, length: pd.Series, lik: pd.Series) -> pd.Series:
        rates = np.stack(q.to_numpy()).reshape(-1, k, k)
        liks = np.stack(lik.to_numpy())
        out = np.empty_like(liks)
        keys = pd.Series([r.tobytes() for r in rates])
        for rows in keys.groupby(keys).indices.values():
            times, inverse = np.unique(length.to_numpy()[rows], return_inverse=True)
            p = expm_batch(rates[rows[0]], times)
            out[rows] = np.einsum("nij,nj->ni", p[inverse], liks[rows])
        return pd.Series(list(out))

    return message


def matrix_probabilities(k: int):
    """Pandas function ``(q flattened, length) -> P(t)`` flattened by rows."""

    @F.pandas_udf("array<double>")
    def probabilities(q: pd.Series, length: pd.Series) -> pd.Series:
        rates = np.stack(q.to_numpy()).reshape(-1, k, k)
        out = np.empty((len(rates), k * k))
        keys = pd.Series([r.tobytes() for r in rates])
        for rows in keys.groupby(keys).indices.values():
            p = expm_batch(rates[rows[0]], length.to_numpy()[rows])
            out[rows] = p.reshape(len(rows), k * k)
        return pd.Series(list(out))

    return probabilities


def expm_q(q: np.ndarray, length) -> Column:
    """Column ``exp(q t)`` flattened by rows, for a branch-length column."""
    flat = F.array(*[F.lit(float(x)) for x in np.asarray(q).ravel()])
    return matrix_probabilities(len(q))(flat, length)


def next_rates(rates, likelihoods) -> tuple[int, np.ndarray]:
    """Number of the best of the rates looked at, which rise, and the rates to look at next;
    none when the maximum is found.

    Around every peak of the coarse scan; past its ends as long as the likelihood grows there;
    then inside the neighbours of the best rate, in even steps and around the vertex of the
    parabola through the three.  Where all smaller or all larger rates are as good as the best,
    it is the smallest of them.
    """
    x, f = np.log(rates), np.asarray(likelihoods, dtype=float)
    f = np.where(np.isfinite(f), f, -1e300)
    at, end, none = int(f.argmax()), len(x) - 1, np.empty(0)
    same = SAME * max(1.0, abs(f[at]))
    ties = np.flatnonzero(f >= f[at] - same)
    first, last = int(ties[0]), int(ties[-1])
    if first == 0 and last == end:
        return end // 2, none
    flat = first < last and (first == 0 or last == end)
    if flat:
        at = first
    wide = (x[2:] - x[:-2] > COARSE) & (f[1:-1] - f[:-2] > same) & (f[2:] - f[1:-1] <= same)
    steps = [np.linspace(x[i], x[i + 2], 9)[1:-1] for i in np.flatnonzero(wide)]
    if not flat and at in (0, end):
        steps.append(x[at] + (x[end] - x[0]) * np.linspace(0.0, 1.0 if at else -1.0, 7)[1:])
    elif not flat and not steps:
        (a, b, c), (below, top, above) = x[at - 1 : at + 2], f[at - 1 : at + 2]
        if c - a <= NARROW or top - min(below, above) <= same:
            return at, none
        left, right, rise, fall = b - a, c - b, top - below, top - above
        vertex = b + (right**2 * rise - left**2 * fall) / (right * rise + left * fall) / 2
        close = vertex + (c - a) * np.array([-1 / 64, -1 / 512, 0, 1 / 512, 1 / 64])
        steps = [np.linspace(a, c, 9)[1:-1], close]
    return at, np.exp(np.setdiff1d(np.concatenate([none, *steps]).round(10), x.round(10)))


def rate_search():
    """Pandas function ``(rates, log-likelihoods) -> best rate, its log-likelihood, rates to
    look at next`` (``next_rates``)."""

    @F.pandas_udf("rate double, log_likelihood double, next array<double>")
    def climb(rates: pd.Series, likelihoods: pd.Series) -> pd.DataFrame:
        rows = []
        for r, f in zip(rates, likelihoods):
            at, steps = next_rates(r, f)
            rows.append((r[at], f[at], steps))
        return pd.DataFrame(rows, columns=["rate", "log_likelihood", "next"])

    return climb
