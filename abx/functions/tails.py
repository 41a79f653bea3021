"""Tail probabilities as Arrow-batched pandas UDFs.

Spark has no erf or incomplete beta, and SciPy is not assumed. These run only on
summary rows (one per experiment, day or salt), never on user or event rows.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship these functions to Python workers by value: executors then need numpy
# and pandas only, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

def _erfc(x: np.ndarray) -> np.ndarray:
    return np.array([math.erfc(v) for v in np.asarray(x, dtype=float).ravel()], dtype=float).reshape(np.shape(x))


def _log_gamma_step(a: np.ndarray) -> np.ndarray:
    """log(Gamma(a + 1/2) / Gamma(a)): the ratio's asymptotic series at a + SHIFT, brought
    back by the recurrence. Nothing large is subtracted, so all a > 0 are served alike."""
    z = a + SHIFT
    series = 0.5 * np.log(z) - 1 / (8 * z) + 1 / (192 * z ** 3) - 1 / (640 * z ** 5) + 17 / (14336 * z ** 7)
    for k in range(SHIFT):
        series = series + np.log1p(-0.5 / (a + k + 0.5))
    return series


SHIFT = 20
NODES, WEIGHTS = np.polynomial.legendre.leggauss(160)
HEAD = 2.0      # below it the body is integrated, from it on the tail
REACH = 9.0     # of the tail's variable, beyond which exp(-w^2 df / (df + 1)) adds nothing for df >= 1


def student_sf2_np(t, df) -> np.ndarray:
    """Two-sided Student p-value P(|T_df| >= |t|) for df >= 1, by Gauss-Legendre quadrature.

    With h(s) = (df + 1) / 2 * log1p(s^2 / df) the density is C exp(-h(s)). Below
    ``HEAD`` the body 0..|t| is integrated over s. From there on the tail is taken
    over w, where h = h(|t|) + w^2: the integrand then falls like exp(-w^2), however
    heavy the tail. A fixed number of nodes: nothing iterates, nothing is cut off.
    """
    t, df = np.broadcast_arrays(np.abs(np.asarray(t, dtype=float)), np.asarray(df, dtype=float))
    out = np.full(t.shape, np.nan)
    ok = np.isfinite(t) & np.isfinite(df) & (df >= 1)
    if ok.any():
        x, n = t[ok][:, None], df[ok][:, None]
        log_c = _log_gamma_step(n / 2) - 0.5 * np.log(n * np.pi)
        unit = (NODES + 1) / 2
        s = np.minimum(x, HEAD) * unit
        body = np.minimum(x, HEAD) * 0.5 * (WEIGHTS * np.exp(log_c - (n + 1) / 2 * np.log1p(s * s / n))).sum(
            axis=1, keepdims=True)
        w = REACH * unit
        h0 = (n + 1) / 2 * np.log1p(np.maximum(x, HEAD) ** 2 / n)
        h = h0 + w * w
        at = np.sqrt(n * np.expm1(2 * h / (n + 1)))
        tail = REACH * 0.5 * (WEIGHTS * np.exp(log_c - h + 2 * h / (n + 1)) * (n / (n + 1)) * 2 * w / at).sum(
            axis=1, keepdims=True)
        out[ok] = np.where(x < HEAD, 1 - 2 * body, 2 * tail)[:, 0]
    return out


def normal_sf2_np(z) -> np.ndarray:
    """Two-sided normal p-value erfc(|z| / sqrt 2)."""
    z = np.asarray(z, dtype=float)
    out = np.full(z.shape, np.nan)
    ok = np.isfinite(z)
    if ok.any():
        out[ok] = _erfc(np.abs(z[ok]) / math.sqrt(2.0))
    return out


def chi2_1df_sf_np(x) -> np.ndarray:
    """Upper tail of chi-square with one degree of freedom: erfc(sqrt(x / 2))."""
    x = np.asarray(x, dtype=float)
    out = np.full(x.shape, np.nan)
    ok = np.isfinite(x) & (x >= 0)
    if ok.any():
        out[ok] = _erfc(np.sqrt(x[ok] / 2.0))
    return out


def _series(arr: np.ndarray) -> pd.Series:
    s = pd.Series(arr, dtype="float64")
    return s.where(np.isfinite(s), None)


@F.pandas_udf(T.DoubleType())
def student_sf2(t: pd.Series, df: pd.Series) -> pd.Series:
    return _series(student_sf2_np(t.astype("float64"), df.astype("float64")))


@F.pandas_udf(T.DoubleType())
def normal_sf2(z: pd.Series) -> pd.Series:
    return _series(normal_sf2_np(z.astype("float64")))


@F.pandas_udf(T.DoubleType())
def chi2_1df_sf(x: pd.Series) -> pd.Series:
    return _series(chi2_1df_sf_np(x.astype("float64")))
