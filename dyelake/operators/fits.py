"""Fits to small summaries of many rows: decay of mean signals."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _model(x: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and slopes of the sum of a exp(-b x), with p = (a, b) pairs and a constant last."""
    a, b = p[:-1:2, None], p[1:-1:2, None]
    e = np.exp(-b * x)
    slopes = np.empty((len(p), len(x)))
    slopes[:-1:2], slopes[1:-1:2], slopes[-1] = e, -a * x * e, 1.0
    return (a * e).sum(0) + p[-1], slopes.T


def decay_rates(x: np.ndarray, y: np.ndarray, n_exp: int, most_steps: int = 2000) -> np.ndarray | None:
    """Rates of the least-squares sum of ``n_exp`` (1 or 2) exponentials and a constant, by damped Gauss-Newton steps; None without convergence or under 5 points."""
    if len(y) < 5:
        return None
    span, fast = x[-1] - x[0], max(1, len(x) // 6)
    rate = lambda d: 6 * np.log(2) / d
    p = np.array([y[0] - y[-1], rate(span), y[-1]] if n_exp == 1 else [y[0] - y[fast], rate(x[fast] - x[0]), y[fast] - y[-1], rate(span), y[-1]], dtype=float)
    damp = 1e-3
    with np.errstate(all="ignore"):
        value, slopes = _model(x, p)
        error = ((y - value) ** 2).sum()
        for _ in range(most_steps):
            square = slopes.T @ slopes
            try:
                step = np.linalg.solve(square + damp * np.diag(np.diag(square) + 1e-30), slopes.T @ (y - value))
            except np.linalg.LinAlgError:
                return None
            new_value, new_slopes = _model(x, p + step)
            new_error = ((y - new_value) ** 2).sum()
            if new_error <= error:
                done = (np.abs(step) <= 1e-9 * (np.abs(p) + 1e-9)).all()
                p, value, slopes, error, damp = p + step, new_value, new_slopes, new_error, damp / 5
                if done:
                    return p[1:-1:2]
            elif (damp := damp * 5) > 1e12:
                # No step however small is better: the least there is.
                return p[1:-1:2]
    return None


def decay_half_life(radmat: DataFrame, n_exp: int = 1) -> DataFrame:
    """(field_i, channel_i, half_lives): ln 2 over each rate of an exponential fit to the mean signal of every cycle; null under 5 cycles or where the fit doesn't settle.

    Means are made by Spark; a group of the fit holds one row a cycle.
    """
    means = radmat.groupBy("field_i", "channel_i", "cycle_i").agg(F.avg("signal").alias("signal"))

    def fit(own: pd.DataFrame) -> pd.DataFrame:
        own = own.dropna(subset=["cycle_i", "signal"]).sort_values("cycle_i")
        rates = decay_rates(own["cycle_i"].to_numpy(float), own["signal"].to_numpy(float), n_exp)
        return pd.DataFrame({"half_lives": [None if rates is None or not (np.isfinite(rates) & (rates != 0)).all() else (np.log(2) / rates).tolist()]})

    def keyed(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        return fit(own).assign(field_i=key[0], channel_i=key[1])[["field_i", "channel_i", "half_lives"]]

    return means.groupBy("field_i", "channel_i").applyInPandas(keyed, "field_i int, channel_i int, half_lives array<double>")
