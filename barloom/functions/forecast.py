"""Exponential smoothing: a fixed-parameter form in SQL functions, a fitted form in NumPy.

The fitted form is a vectorised scalar UDF over one row per training window. Rows are
independent of each other, so they can be spread evenly over the tasks whatever the
item they belong to.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# The small kernel below travels to the executors inside the task, so they need not have
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_OBSERVATIONS = 10
GRID_STEP = 0.05
REFINE_ROUNDS = 6
_CHUNK = 512
#: Longest windows whose grid is searched by quadratic forms.
_FORM_LENGTH = 64
#: Series that are fitted abreast, and numbers in one array of their passes.
_SERIES, _CELLS = 16, 200_000


def holt_fixed(series: str | Column, alpha: float, beta: float) -> Column:
    """Final (level, trend) of Holt's linear method over an array, for given parameters.

    Starts from the first value and the first difference.
    """
    arr = F.col(series) if isinstance(series, str) else series
    first, second = F.get(arr, F.lit(0)), F.get(arr, F.lit(1))
    start = F.struct(first.alias("level"), (second - first).alias("trend"))

    def step(state: Column, y: Column) -> Column:
        expected = state["level"] + state["trend"]
        error = y - expected
        return F.struct(
            (expected + F.lit(alpha) * error).alias("level"),
            (state["trend"] + F.lit(alpha * beta) * error).alias("trend"),
        )

    rest = F.slice(arr, 2, F.greatest(F.size(arr) - 1, F.lit(0)))
    return F.when(F.size(arr) >= 2, F.aggregate(rest, start, step))


# The one-step errors of a window z follow e_t = D_t + p e_(t-1) - q e_(t-2) from zero, where D is the second (without
# trend the first) difference of z after zeros. For fixed parameters they are linear in the start state, so the best start
# state has a closed form. Parameters are whole numbers (i, j) of 1 / _unit(): alpha = i / unit, beta = j / unit.

def _unit() -> int:
    """The last step of the refinement divides one into this many."""
    return round(2**REFINE_ROUNDS / GRID_STEP)


def _grid(trend: bool) -> tuple[np.ndarray, np.ndarray]:
    """Candidates with 0 <= beta <= alpha <= 1, smallest first."""
    steps = range(0, _unit() + 1, 2**REFINE_ROUNDS)
    pairs = np.array([(i, j) for i in steps for j in (steps if trend else (0,)) if j <= i], np.int64)
    return pairs[:, 0], pairs[:, 1]


def _around(i: np.ndarray, j: np.ndarray, step: int, trend: bool) -> tuple[np.ndarray, np.ndarray]:
    """The neighbours of each row's parameters (neighbours, rows)."""
    moves = np.array([(u, v) for u in (-1, 0, 1) for v in ((-1, 0, 1) if trend else (0,)) if u or v], np.int64)
    near = np.clip(i + step * moves[:, :1], 0, _unit())
    return near, np.clip(j + step * moves[:, 1:], 0, near)


def _weights(i: np.ndarray, j: np.ndarray, trend: bool) -> tuple[np.ndarray, np.ndarray]:
    """p and q of the recursion of the errors."""
    alpha = i / _unit()
    return (2.0 - alpha - alpha * (j / _unit()), 1.0 - alpha) if trend else (1.0 - alpha, np.zeros_like(alpha))


def _inputs(z: np.ndarray, trend: bool) -> np.ndarray:
    """D of series along the first axis."""
    d = np.diff(z, axis=0, prepend=np.zeros_like(z[:1]))
    return np.diff(d, axis=0, prepend=np.zeros_like(z[:1])) if trend else d


def _errors(d: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Errors from a zero start state, time first."""
    out = np.empty((len(d), *p.shape))
    before, last, work = np.zeros_like(p), np.zeros_like(p), np.empty_like(p)
    for e, x in zip(out, d):
        np.multiply(p, last, out=e)
        np.multiply(q, before, out=work)
        e -= work
        e += x
        before, last = last, e
    return out


def _responses(n: int, p: np.ndarray, q: np.ndarray, trend: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Errors in answer to a start level and, with trend, a start slope of one, time first."""
    out, work = np.empty((n, *p.shape)), np.empty_like(p)
    out[0] = -1.0
    for t in range(1, n):
        np.multiply(p, out[t - 1], out=out[t])
        if t > 1 and trend:
            np.multiply(q, out[t - 2], out=work)
            out[t] -= work
    return (np.diff(out, axis=0, prepend=np.zeros_like(out[:1])), out) if trend else (out, None)


def _least(xx, xl, xb, ll, lb, bb):
    """Squared error for the best start state, and that state, from the sums of products of errors and responses."""
    if xb is None:
        level = -xl / ll
        return xx + level * xl, level, 0.0
    det = ll * bb - lb * lb
    level, slope = (xb * lb - xl * bb) / det, (xl * lb - xb * ll) / det
    return xx + level * xl + slope * xb, level, slope


def _products(sums, x: np.ndarray, level: np.ndarray, slope: np.ndarray | None):
    """The arguments of :func:`_least`; ``sums`` adds products over time."""
    pairs = ((x, x), (x, level), (x, slope), (level, level), (level, slope), (slope, slope))
    return [None if b is None else sums(a, b) for a, b in pairs]


def _totals(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("t...,t...->...", a, b)


def _running(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a * b
    return np.cumsum(out, axis=0, out=out)


def _end(z: np.ndarray, before: np.ndarray, e: np.ndarray, e_before: np.ndarray, i: np.ndarray, j: np.ndarray, trend: bool):
    """Level and slope after the last value, from the last two values and errors."""
    alpha = i / _unit()
    level = z - (1.0 - alpha) * e
    if not trend:
        return level, np.zeros_like(level)
    return level, level - (before - (1.0 - alpha) * e_before) - alpha * (1.0 - j / _unit()) * e


def _path(z: np.ndarray, i: np.ndarray, j: np.ndarray, trend: bool) -> tuple[np.ndarray, np.ndarray]:
    """Level and slope after the last value of every row of ``z``, from the best start state, value by value."""
    alpha = i / _unit()
    gain = alpha * (j / _unit())
    # of the data from a zero start state, and in answer to a start level and a start slope of one
    lev, slope = np.zeros((3, len(z))), np.zeros((3, len(z)))
    lev[1], slope[2] = 1.0, float(trend)
    sums = np.zeros((6, len(z)))
    for y in z.T:
        e = -lev - slope
        e[0] = y - lev[0] - slope[0]
        sums += e[[0, 0, 0, 1, 1, 2]] * e[[0, 1, 2, 1, 2, 2]]
        lev, slope = lev + slope + alpha * e, slope + gain * e
    _, l0, b0 = _least(*(sums if trend else [sums[0], sums[1], None, sums[3], None, None]))
    return lev[0] + l0 * lev[1] + b0 * lev[2], slope[0] + l0 * slope[1] + b0 * slope[2]


_FORMS: dict = {}


def _forms(n: int, trend: bool) -> np.ndarray:
    """The squared error of a window of ``n`` values is a quadratic form: its coefficients (products of two values, candidate)."""
    if (n, trend) not in _FORMS:
        p, q = _weights(*_grid(trend), trend)
        level, slope = _responses(n, p, q, trend)
        impulse = _inputs(-(level if slope is None else slope), trend)  # the errors after a value of one
        lag = np.arange(n)[:, None] - np.arange(n)
        answers = np.where(lag >= 0, impulse.T[:, np.maximum(lag, 0)], 0.0)  # candidate, time, value
        basis = np.stack([level.T] if slope is None else [level.T, slope.T], axis=2)
        known = answers.transpose(0, 2, 1) @ np.linalg.qr(basis)[0]
        form = answers.transpose(0, 2, 1) @ answers - known @ known.transpose(0, 2, 1)
        a, b = np.triu_indices(n)
        _FORMS[n, trend] = np.ascontiguousarray((form[:, a, b] * np.where(a == b, 1.0, 2.0)).T)
    return _FORMS[n, trend]


def _best_of_grid(z: np.ndarray, trend: bool) -> list[np.ndarray]:
    """Parameters and squared error of the best candidate for every row of ``z``."""
    i, j = _grid(trend)
    n = z.shape[1]
    if n <= _FORM_LENGTH:
        a, b = np.triu_indices(n)
        sse = (z[:, a] * z[:, b]) @ _forms(n, trend)
    else:  # the forms grow with the square of the length
        p, q = _weights(i, j, trend)
        level, slope = _responses(n, p, q, trend)
        of_errors = _inputs(np.ascontiguousarray(z.T), trend)
        sse = np.stack([_least(*_products(_totals, _errors(d, p, q), level, slope))[0] for d in of_errors.T])
    pick = sse.argmin(axis=1)
    return [i[pick], j[pick], sse[np.arange(len(z)), pick]]


def _refined(best: list[np.ndarray], errors, trend: bool) -> list[np.ndarray]:
    """Rounds of halving neighbourhoods around ``best`` (i, j, squared error), each row for itself. ``errors`` gives the
    squared errors of (neighbours, rows)."""
    rows = np.arange(len(best[0]))
    for at in range(REFINE_ROUNDS):
        i, j = _around(best[0], best[1], 2 ** (REFINE_ROUNDS - 1 - at), trend)
        sse = errors(i, j)
        pick = sse.argmin(axis=0)
        better = sse[pick, rows] < best[2]
        best = [np.where(better, new[pick, rows], old) for new, old in zip((i, j, sse), best)]
    return best


def fit_windows(y: np.ndarray, horizon: int, trend: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Forecasts (rows, horizon) and squared errors for equally long training windows.

    Grid search over the parameters, then rounds of halving neighbourhoods. Windows are
    centred and scaled first: the method is equivariant to both, and it keeps the normal
    equations well conditioned.
    """
    centre = y.mean(axis=1, keepdims=True)
    scale = np.abs(y - centre).max(axis=1, keepdims=True)
    scale = np.where(scale == 0, 1.0, scale)
    z = (y - centre) / scale
    d = _inputs(np.ascontiguousarray(z.T), trend)

    def parts(i, j):
        p, q = _weights(i, j, trend)
        return _errors(d, p, q), *_responses(len(d), p, q, trend)

    best = _refined(_best_of_grid(z, trend), lambda i, j: _least(*_products(_totals, *parts(i, j)))[0], trend)
    end = _path(z, best[0], best[1], trend)
    ahead = np.arange(1, horizon + 1)[None, :]
    return (end[0][:, None] + ahead * end[1][:, None]) * scale + centre, np.maximum(best[2], 0.0) * scale[:, 0] ** 2


def fit_origins(y: np.ndarray, train: int, horizon: int, trend: bool = True) -> np.ndarray:
    """Forecasts (n - train + 1, horizon) of one series from every origin with at least ``train`` values before it."""
    return fit_series([y], train, horizon, trend)[0]


def fit_series(series: list[np.ndarray], train: int, horizon: int, trend: bool = True) -> list[np.ndarray]:
    """:func:`fit_origins` of several series abreast.

    The sums behind the closed form are running sums, so one pass over a series under given parameters serves all its
    origins. All of them take the grid; each origin's best candidate is then refined as :func:`fit_windows` does it, where
    origins with the same neighbours share the passes. So an origin gets what a window of all values before it gets.
    """
    out = [np.zeros((0, horizon))] * len(series)
    order = sorted((k for k, y in enumerate(series) if len(y) >= train), key=lambda k: len(series[k]))
    for start in range(0, len(order), _SERIES):
        some = order[start : start + _SERIES]
        for k, found in zip(some, _fit_origins([series[k] for k in some], train, horizon, trend)):
            out[k] = found
    return out


def _fit_origins(series: list[np.ndarray], train: int, horizon: int, trend: bool) -> list[np.ndarray]:
    centres = np.array([y.mean() for y in series])
    scales = np.array([np.abs(y - c).max() or 1.0 for y, c in zip(series, centres)])
    lengths = np.array([len(y) for y in series])
    z = np.zeros((lengths.max(), len(series)))
    for k, y in enumerate(series):
        z[: len(y), k] = (y - centres[k]) / scales[k]
    d = _inputs(z, trend)
    width = max(1, _CELLS // len(z))  # columns at a time: bounds the memory of long series

    # the grid, block by block; the answers to the start state are the same for all series
    i, j = _grid(trend)
    best = [np.zeros((len(z) - train + 1, len(series)), np.int64) for _ in range(2)]
    best.append(np.full(best[0].shape, np.inf))
    for low in range(0, len(i), width):
        p, q = _weights(i[low : low + width], j[low : low + width], trend)
        level, slope = _responses(len(z), p, q, trend)
        own = _products(_running, level, level, slope)[3:]
        for k, n in enumerate(lengths):
            x = _errors(d[:n, k], p, q)
            mixed = [None if b is None else _running(x, b[:n])[train - 1 :] for b in (x, level, slope)]
            sse = _least(*mixed, *(None if b is None else b[train - 1 : n] for b in own))[0]
            pick = sse.argmin(axis=1)
            found = sse[np.arange(len(pick)), pick]
            better = found < best[2][: len(pick), k]
            for old, new in zip(best, (i[low + pick], j[low + pick], found)):
                old[: len(pick), k][better] = new[better]

    owner = np.repeat(np.arange(len(series)), lengths - train + 1)
    at = np.concatenate([np.arange(train - 1, n) for n in lengths])
    best = [b[at - train + 1, owner] for b in best]

    def passes(i, j, wanted):
        """``wanted`` of the running sums (x, level, slope) and their products, for each origin's candidates."""
        side = _unit() + 1
        keys, where = np.unique((owner * side + i) * side + j, return_inverse=True)
        where = where.reshape(i.shape)
        when = np.broadcast_to(at, i.shape)
        out = None
        for low in range(0, len(keys), width):
            some = keys[low : low + width]
            p, q = _weights(some // side % side, some % side, trend)
            most = lengths[some // side // side].max()
            x = _errors(d[:most, some // side // side], p, q)
            got = wanted(x, *_responses(most, p, q, trend), when, where - low, inside := (where >= low) & (where < low + len(some)))
            out = [np.empty(i.shape) for _ in got] if out is None else out
            for full, part in zip(out, got):
                full[inside] = part
        return out

    def errors(x, level, slope, when, where, inside):
        when, where = when[inside], where[inside]
        return [_least(*_products(lambda a, b: _running(a, b)[when, where], x, level, slope))[0]]

    def ends(x, level, slope, when, where, inside):
        when, where = when[inside], where[inside]
        _, l0, b0 = _least(*_products(lambda a, b: _running(a, b)[when, where], x, level, slope))
        return [x[t, where] + l0 * level[t, where] + (0.0 if slope is None else b0 * slope[t, where]) for t in (when, when - 1)]

    best = _refined(best, lambda i, j: passes(i, j, errors)[0], trend)
    level, slope = _end(z[at, owner], z[at - 1, owner], *passes(best[0], best[1], ends), best[0], best[1], trend)
    forecast = (level[:, None] + np.arange(1, horizon + 1) * slope[:, None]) * scales[owner, None] + centres[owner, None]
    return np.split(forecast, np.cumsum(lengths - train + 1)[:-1])


# ---- Spark side ------------------------------------------------------------------------

def forecast_lists(train: pa.Array, horizon: int, trend: str | None = "add") -> pa.Array:
    """Forecast per training array; NULL for short, missing or incomplete arrays."""
    lengths = pc.fill_null(pc.list_value_length(train), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = train.flatten().to_numpy(zero_copy_only=False).astype(float)
    starts = np.cumsum(lengths) - lengths
    out = np.full((len(train), horizon), np.nan)
    for n in np.unique(lengths[lengths >= MIN_OBSERVATIONS]):
        where = np.flatnonzero(lengths == n)
        for start in range(0, len(where), _CHUNK):
            part = where[start : start + _CHUNK]
            y = values[starts[part, None] + np.arange(n)]
            usable = np.isfinite(y).all(axis=1)
            if usable.any():
                out[part[usable]] = fit_windows(y[usable], horizon, trend == "add")[0]
    found = np.isfinite(out).all(axis=1)
    ends = np.append(0, np.cumsum(found * horizon)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(out[found].ravel()), mask=pa.array(~found))


def forecast_rows(train: pd.Series, horizon: int, trend: str | None = "add") -> pd.Series:
    """:func:`forecast_lists` of a series of arrays."""
    found = forecast_lists(pa.array(train.tolist(), pa.list_(pa.float64())), horizon, trend)
    return pd.Series(found.to_pylist(), dtype=object)


def ets_forecast(train: Column, horizon: int, trend: str | None = "add") -> Column:
    """Fitted exponential smoothing, ``horizon`` steps ahead: array<double>, NULL if not fitted.

    ``trend`` is 'add' or None.
    """
    if trend not in ("add", None):
        raise ValueError(f"unsupported form: trend={trend!r}")

    @F.arrow_udf("array<double>")
    def fitted(values: pa.Array) -> pa.Array:
        return forecast_lists(values, horizon, trend)

    return fitted(train)
