"""Factorization machine over hashed terms, with a calibrated score."""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def ragged(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(values, starts) of rows of different lengths."""
    lengths = np.array([len(r) for r in rows], np.int64)
    return np.concatenate(rows) if len(rows) else np.zeros(0, np.int64), np.concatenate([[0], np.cumsum(lengths)])


def _parts(rows: list[np.ndarray]) -> list[list[np.ndarray]]:
    """The rows, so many at a time as one step of a fit takes."""
    return [rows[i : i + 256] for i in range(0, len(rows), 256)]


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of values over rows; empty rows give 0."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    return total[starts[1:]] - total[starts[:-1]]


class FactorizationMachine:
    """log-odds = w0 + sum of w_i + 1/n times the sum over pairs of <v_i, v_j>, over
    the n distinct known terms of a row.  A term is known if at least ``least``
    rows of the sample have it and its share among positive and among other rows
    differs by ``contrast`` standard errors; thousands of terms without a bearing
    on the label would otherwise learn the sample by heart.  With ``factors`` 0
    it is a logistic regression.
    """

    def __init__(self, buckets: int, factors: int = 8, least: int = 5, contrast: float = 4.0, epochs: int = 20, rate: float = 0.2, decay: float = 1e-3, seed: int = 7):
        self.buckets, self.factors, self.least, self.contrast = buckets, factors, least, contrast
        self.epochs, self.rate, self.decay, self.seed = epochs, rate, decay, seed
        self.scale, self.shift = 1.0, 0.0

    def fit(self, rows: list[np.ndarray], y: np.ndarray) -> FactorizationMachine:
        """Fit on four rows of five and calibrate on the fifth (Platt scaling)."""
        draw = np.random.default_rng(self.seed)
        held = np.arange(len(rows)) % 5 == 4
        if len(rows) < 50 or len(set(y[held])) < 2 or len(set(y[~held])) < 2:
            held[:] = False
        self._fit([r for r, h in zip(rows, held, strict=True) if not h], y[~held], draw)
        if held.any():
            self._calibrate(np.concatenate([self.raw(part) for part in _parts([r for r, h in zip(rows, held, strict=True) if h])]), y[held])
        return self

    def _fit(self, rows: list[np.ndarray], y: np.ndarray, draw: np.random.Generator) -> None:
        count = lambda some: sum((np.bincount(ragged(part)[0].astype(np.int64), minlength=self.buckets) for part in _parts(some)), np.zeros(self.buckets, np.int64))
        with_term = count([r for r, label in zip(rows, y, strict=True) if label > 0.5])
        seen, n1, n0 = count(rows), max(1, (y > 0.5).sum()), max(1, (y <= 0.5).sum())
        share = seen / max(1, len(rows))
        error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n1 + 1 / n0))
        z = np.abs(with_term / n1 - (seen - with_term) / n0) / error
        known = np.flatnonzero((seen >= self.least) & (z >= self.contrast))
        self.place = np.full(self.buckets, -1, np.int32)
        self.place[known] = np.arange(len(known))
        n = len(known)
        share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        self.w0, self.w = np.log(share / (1 - share)), np.zeros(n)
        self.v = draw.normal(0, 0.01, (n, self.factors))
        gw, gv, g0 = np.full(n, 1e-6), np.full((n, self.factors), 1e-6), 1e-6
        short = [self._known(r) for r in rows]
        for _ in range(self.epochs if n else 0):
            for batch in np.array_split(draw.permutation(len(rows)), max(1, len(rows) // 256)):
                ids, starts = ragged([short[i] for i in batch])
                owner = np.repeat(np.arange(len(batch)), np.diff(starts))
                sums = _sums(self.v[ids], starts)
                out = self._out(ids, starts, sums)
                error = (_sigmoid(out) - y[batch]) / len(batch)
                scaled = error / np.maximum(1, np.diff(starts))
                d0 = error.sum()
                g0 += d0 * d0
                self.w0 -= self.rate * d0 / np.sqrt(g0)
                dw = np.bincount(ids, error[owner], n) + self.decay * self.w * np.bincount(ids, minlength=n).clip(0, 1) / len(batch)
                gw += dw * dw
                self.w -= self.rate * dw / np.sqrt(gw)
                for f in range(self.factors):
                    pair = scaled[owner] * (sums[owner, f] - self.v[ids, f])
                    dv = np.bincount(ids, pair, n) + self.decay * self.v[:, f] * np.bincount(ids, minlength=n).clip(0, 1) / len(batch)
                    gv[:, f] += dv * dv
                    self.v[:, f] -= 0.2 * self.rate * dv / np.sqrt(gv[:, f])

    def _known(self, row: np.ndarray) -> np.ndarray:
        found = self.place[row]
        return found[found >= 0]

    def _out(self, ids: np.ndarray, starts: np.ndarray, sums: np.ndarray) -> np.ndarray:
        pairs = 0.5 * ((sums**2).sum(axis=1) - _sums((self.v[ids] ** 2).sum(axis=1), starts))
        return self.w0 + _sums(self.w[ids], starts) + pairs / np.maximum(1, np.diff(starts))

    def raw(self, rows: list[np.ndarray]) -> np.ndarray:
        """Uncalibrated log-odds."""
        ids, starts = ragged([self._known(r) for r in rows])
        ids = ids.astype(np.int64)
        return self._out(ids, starts, _sums(self.v[ids], starts))

    def _calibrate(self, raw: np.ndarray, y: np.ndarray) -> None:
        """a and b of a * raw + b by Newton steps; a ridge keeps a near 1, and a
        step that doesn't lower the loss is halved."""
        loss = lambda a, b: np.logaddexp(0, -(2 * y - 1) * (a * raw + b)).sum() + 0.5 * (a - 1) ** 2
        a, b = 1.0, 0.0
        for _ in range(50):
            p = _sigmoid(a * raw + b)
            g = np.array([((p - y) * raw).sum() + (a - 1), (p - y).sum()])
            s = p * (1 - p)
            h = np.array([[(s * raw * raw).sum() + 1, (s * raw).sum()], [(s * raw).sum(), s.sum() + 1e-3]])
            step = np.linalg.solve(h, g)
            while np.abs(step).max() > 1e-6 and loss(a - step[0], b - step[1]) > loss(a, b):
                step = step / 2
            if np.abs(step).max() <= 1e-6:
                break
            a, b = a - step[0], b - step[1]
        if a > 0:
            self.scale, self.shift = float(a), float(b)

    def log_odds(self, rows: list[np.ndarray]) -> np.ndarray:
        return self.scale * self.raw(rows) + self.shift

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """Calibrated probabilities; a row without known terms has one, too."""
        return _sigmoid(self.log_odds(rows))
