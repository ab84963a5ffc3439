"""A linear-chain conditional random field with two states, trained and read by forward-backward passes.

Many chains lie in one array; a flag starts a new chain. The passes walk all blocks of the array side by side, so that a long chain costs no more
than many short ones, and only the ends of the blocks are joined one after another."""

from __future__ import annotations

import numpy as np

BLOCK = 128


class Chains:
    """Forward and backward messages for scores (of state 1 against 0), chain starts and the 2 x 2 transition scores."""

    def __init__(self, scores: np.ndarray, starts: np.ndarray, transitions: np.ndarray, initial: np.ndarray):
        self.n = n = len(scores)
        width = max(1, -(-n // BLOCK))
        pad = width * BLOCK - n
        odds = np.exp(np.clip(scores, -30, 30))
        first = np.exp(initial)
        steps = np.exp(transitions)
        m = np.empty((2, 2, n))
        for i in (0, 1):
            for j in (0, 1):
                m[i, j] = np.where(starts, first[j], steps[i, j])
        m[:, 1] *= odds
        if pad:
            same = np.zeros((2, 2, pad))
            same[0, 0] = same[1, 1] = 1
            m = np.concatenate([m, same], axis=2)
        self.m = m.reshape(2, 2, width, BLOCK).transpose(3, 0, 1, 2).copy()
        self.width = width
        self.alpha, self.beta = self._forward(), self._backward()

    def _products(self) -> np.ndarray:
        p = np.zeros((2, 2, self.width))
        p[0, 0] = p[1, 1] = 1
        for m in self.m:
            p = np.stack([[p[i, 0] * m[0, j] + p[i, 1] * m[1, j] for j in (0, 1)] for i in (0, 1)])
            p /= p.max(axis=(0, 1))
        return p

    def _forward(self) -> np.ndarray:
        self.p = p = self._products()
        came = np.empty((2, self.width))
        a, b = 0.5, 0.5
        for k, (p00, p01, p10, p11) in enumerate(zip(*(p[i, j].tolist() for i in (0, 1) for j in (0, 1)))):
            came[0, k], came[1, k] = a, b
            a, b = a * p00 + b * p10, a * p01 + b * p11
            a, b = a / (a + b), b / (a + b)
        out = np.empty((BLOCK, 2, self.width))
        for at, m in enumerate(self.m):
            came = np.stack([came[0] * m[0, 0] + came[1] * m[1, 0], came[0] * m[0, 1] + came[1] * m[1, 1]])
            came /= came.sum(axis=0)
            out[at] = came
        return out

    def _backward(self) -> np.ndarray:
        p = self.p
        came = np.empty((2, self.width))
        a, b = 0.5, 0.5
        rows = list(zip(*(p[i, j].tolist() for i in (0, 1) for j in (0, 1))))
        for k in range(self.width - 1, -1, -1):
            came[0, k], came[1, k] = a, b
            p00, p01, p10, p11 = rows[k]
            a, b = p00 * a + p01 * b, p10 * a + p11 * b
            a, b = a / (a + b), b / (a + b)
        out = np.empty((BLOCK, 2, self.width))
        for at in range(BLOCK - 1, -1, -1):
            out[at], m = came, self.m[at]
            came = np.stack([m[0, 0] * came[0] + m[0, 1] * came[1], m[1, 0] * came[0] + m[1, 1] * came[1]])
            came /= came.sum(axis=0)
        return out

    def _flat(self, x: np.ndarray) -> np.ndarray:
        return x.T.reshape(-1)[: self.n]

    def marginals(self) -> np.ndarray:
        """The probability of state 1 at every position."""
        both = self.alpha * self.beta
        return self._flat(both[:, 1] / both.sum(axis=1))

    def pairs(self, starts: np.ndarray) -> np.ndarray:
        """Expected numbers of each transition, 2 x 2, over all positions that do not start a chain."""
        m = self.m.transpose(1, 2, 3, 0).reshape(2, 2, -1)[:, :, : self.n][:, :, 1:]
        alpha = np.stack([self._flat(self.alpha[:, i]) for i in (0, 1)])[:, :-1]
        beta = np.stack([self._flat(self.beta[:, i]) for i in (0, 1)])[:, 1:]
        joint = alpha[:, None] * m * beta[None]
        joint = joint / joint.sum(axis=(0, 1)) * ~starts[1:]
        return joint.sum(axis=2)


def train(features, labels: np.ndarray, starts: np.ndarray, size: int, rounds: int = 80, rate: float = 0.3, ridge: float = 1e-3):
    """Weights of the features, transition scores (2 x 2) and initial scores by Adam on the likelihood of the labels.

    ``features`` has ``score(weights)`` and ``gather(values)``, its transpose."""
    parts = [np.zeros(size), np.zeros((2, 2)), np.zeros(2)]
    seen = np.zeros((2, 2))
    inner = ~starts[1:]
    np.add.at(seen, (labels[:-1][inner], labels[1:][inner]), 1)
    begun = np.bincount(labels[starts], minlength=2)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in parts]
    for turn in range(1, rounds + 1):
        chains = Chains(features.score(parts[0]), starts, parts[1], parts[2])
        p = chains.marginals()
        n = max(1, len(labels))
        ends = np.array([(1 - p[starts]).sum(), p[starts].sum()])
        slopes = [features.gather(labels - p) / n - ridge / n * parts[0], (seen - chains.pairs(starts)) / n, (begun - ends) / n]
        for part, slope, (first, second) in zip(parts, slopes, moments):
            first += 0.1 * (slope - first)
            second += 0.01 * (slope**2 - second)
            part += rate * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-8)
    return parts


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 1e-2) -> np.ndarray:
    """Weights (the last is the constant) of a logistic regression by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step * min(1, 5 / max(1e-9, np.abs(step).max()))
    return w


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
