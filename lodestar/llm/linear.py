"""Small linear models for one task: sparse logistic regression, calibration."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * np.asarray(x, np.float64)))


def minimise(f: Callable, x: np.ndarray, rounds: int = 60, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent; ``f`` returns (value, gradient)."""
    value, grad = f(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q, alphas = grad.copy(), []
        for s, y in reversed(steps):
            alphas.append(a := s @ q / (s @ y))
            q -= a * y
        if steps:
            s, y = steps[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.linalg.norm(q))
        for (s, y), a in zip(steps, reversed(alphas), strict=True):
            q += (a - y @ q / (s @ y)) * s
        slope, t = -(grad @ q), 1.0
        if slope > -1e-9:
            break
        while True:
            new, new_grad = f(x - t * q)
            if new <= value + 1e-4 * t * slope or t < 1e-6:
                break
            t /= 2
        if t < 1e-6:
            break
        if (-t * q) @ (new_grad - grad) > 1e-12:
            steps = [*steps[1 - memory:], (-t * q, new_grad - grad)]
        x, value, grad, old = x - t * q, new, new_grad, value
        if old - value < 1e-7 * max(1.0, abs(old)):
            break
    return x


#: Entries of a sparse matrix that are multiplied at a time.
ENTRIES = 1 << 21


class Sparse:
    """Rows of (feature index, value) in one flat layout."""

    def __init__(self, rows: list[np.ndarray], values: np.ndarray | None = None):
        self.ptr = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        self.idx = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        self.val = values

    def blocks(self) -> Iterator[tuple[int, int]]:
        """Ranges of rows with about ``ENTRIES`` entries."""
        a, n = 0, len(self.ptr) - 1
        while a < n:
            b = max(a + 1, int(np.searchsorted(self.ptr, self.ptr[a] + ENTRIES, "right")) - 1)
            yield a, b
            a = b

    def dot(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.ptr) - 1)
        for a, b in self.blocks():
            i, j = self.ptr[a], self.ptr[b]
            x = w[self.idx[i:j]] if self.val is None else w[self.idx[i:j]] * self.val[i:j]
            sums = np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)])
            out[a:b] = sums[self.ptr[a + 1:b + 1] - i] - sums[self.ptr[a:b] - i]
        return out

    def back(self, g: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros(width)
        for a, b in self.blocks():
            i, j = self.ptr[a], self.ptr[b]
            each = np.repeat(g[a:b], np.diff(self.ptr[a:b + 1]))
            out += np.bincount(self.idx[i:j], each if self.val is None else each * self.val[i:j], width)
        return out


class Blocks:
    """Rows of features of value 1, kept in blocks of about ``ENTRIES`` entries
    as they come: no entry is held twice, however many models read them."""

    def __init__(self) -> None:
        self.blocks: list[tuple[np.ndarray, np.ndarray]] = []  # sizes of the rows, features
        self.open: list[np.ndarray] = []
        self.entries = 0

    def add(self, row: np.ndarray) -> None:
        self.open.append(row.astype(np.int32))
        self.entries += len(row)
        if self.entries >= ENTRIES:
            self.close()

    def close(self) -> None:
        if self.open:
            sizes = np.fromiter(map(len, self.open), np.int64, len(self.open))
            self.blocks.append((sizes, np.concatenate(self.open)))
            self.open, self.entries = [], 0

    def __len__(self) -> int:
        return sum(len(sizes) for sizes, _ in self.blocks) + len(self.open)

    def dot(self, w: np.ndarray) -> np.ndarray:
        out = []
        for sizes, idx in self.blocks:
            sums = np.add.reduceat(np.append(w[idx], 0.0), np.cumsum(sizes) - sizes)
            out.append(np.where(sizes > 0, sums, 0.0))  # reduceat gives an empty row the entry after it
        return np.concatenate(out) if out else np.zeros(0)

    def back(self, g: np.ndarray, width: int) -> np.ndarray:
        out, at = np.zeros(width), 0
        for sizes, idx in self.blocks:
            out += np.bincount(idx, np.repeat(g[at:at + len(sizes)], sizes), width)
            at += len(sizes)
        return out


    def only(self, new: np.ndarray) -> Blocks:
        """The rows with feature ``new[i]`` for i, without those where it is negative."""
        out = Blocks()
        for sizes, idx in self.blocks:
            moved = new[idx]
            kept = np.concatenate([[0], np.cumsum(moved >= 0)])
            ends = np.cumsum(sizes)
            out.blocks.append((kept[ends] - kept[ends - sizes], moved[moved >= 0]))
        return out


class Stack:
    """Several ``Blocks``, one above the other."""

    def __init__(self, parts: list[Blocks]):
        self.parts = parts
        self.cuts = np.cumsum([0, *map(len, parts)])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.concatenate([p.dot(w) for p in self.parts])

    def back(self, g: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros(width)
        for p, a, b in zip(self.parts, self.cuts, self.cuts[1:], strict=False):
            out += p.back(g[a:b], width)
        return out


def fit_logistic(rows: Sparse | Blocks | Stack, y: np.ndarray, width: int, l2: float, scale: np.ndarray | None = None,
                 weight: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights (of the unscaled features) and bias. ``scale`` multiplies the
    features; the penalty is on the weights of the scaled ones."""
    scale = np.ones(width) if scale is None else scale
    weight = np.ones(len(y)) if weight is None else weight
    n = max(1.0, weight.sum())

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, b = x[:-1], x[-1]
        m = rows.dot(w * scale) + b
        err = weight * (sigmoid(m) - y)
        value = (weight * (np.logaddexp(0.0, m) - y * m)).sum() / n + 0.5 * l2 * (w @ w)
        return value, np.append(rows.back(err, width) * scale / n + l2 * w, err.sum() / n)

    x = minimise(loss, np.zeros(width + 1))
    return x[:-1] * scale, float(x[-1])


def calibrate(margins: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, float]:
    """(a, b) of sigmoid(a * margin + b), with smoothed targets (Platt)."""
    pos, neg = y.sum(), len(y) - y.sum()
    weight = np.ones(len(y)) if weight is None else weight
    n = weight.sum()
    if not pos or not neg:
        return 1.0, 0.0
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        m = x[0] * margins + x[1]
        err = sigmoid(m) - target
        err = weight * err
        return (float((weight * (np.logaddexp(0.0, m) - target * m)).sum() / n),
                np.array([(err * margins).sum() / n, err.sum() / n]))

    a, b = minimise(loss, np.array([1.0, 0.0]), 100)
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)
