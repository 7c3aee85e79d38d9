"""Bidirectional LSTM layers and a linear-chain CRF in numpy, with their gradients and Adam."""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def lstm(gates: np.ndarray, recurrent: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states (T, B, H) from input gates (T, B, 4H) in the order input, forget, output, candidate.

    Where the mask (T, B) is 0 the state passes unchanged.
    """
    steps, batch, width = gates.shape
    h = c = np.zeros((batch, width // 4), gates.dtype)
    states, kept = np.empty((steps, batch, width // 4), gates.dtype), []
    size = width // 4
    for t in range(steps):
        z = gates[t] + h @ recurrent
        s, g = _sigmoid(z[:, : 3 * size]), np.tanh(z[:, 3 * size :])
        fresh = s[:, size : 2 * size] * c + s[:, :size] * g
        squashed, m = np.tanh(fresh), mask[t][:, None]
        kept.append((s, g, c, squashed, h))
        c = m * fresh + (1 - m) * c
        h = m * (s[:, 2 * size :] * squashed) + (1 - m) * h
        states[t] = h
    return states, kept


def lstm_gradients(up: np.ndarray, kept: list, recurrent: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input gates and of the recurrent matrix, from those of the hidden states."""
    steps, batch, size = up.shape
    dh = dc = np.zeros((batch, size), up.dtype)
    gates, weights = np.empty((steps, batch, 4 * size), up.dtype), np.zeros_like(recurrent)
    for t in range(steps - 1, -1, -1):
        s, g, c, squashed, h = kept[t]
        m = mask[t][:, None]
        dh = dh + up[t]
        own, passed = dh * m, dh * (1 - m)
        cell = dc * m + own * s[:, 2 * size :] * (1 - squashed**2)
        inner = np.concatenate([cell * g, cell * c, own * squashed], 1) * s * (1 - s)
        z = np.concatenate([inner, cell * s[:, :size] * (1 - g**2)], 1)
        gates[t] = z
        weights += h.T @ z
        dc = dc * (1 - m) + cell * s[:, size : 2 * size]
        dh = passed + z @ recurrent.T
    return gates, weights


def both_ways(forward: np.ndarray, backward: np.ndarray, weights: dict, mask: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Hidden states of both directions, side by side; padding may stand at the end of a sequence."""
    a, kept_a = lstm(forward, weights["recurrent_f"], mask)
    b, kept_b = lstm(backward[::-1], weights["recurrent_b"], mask[::-1])
    return np.concatenate([a, b[::-1]], 2), (kept_a, kept_b)


def both_ways_gradients(up: np.ndarray, kept: tuple, weights: dict, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict]:
    size = up.shape[2] // 2
    a, wa = lstm_gradients(up[:, :, :size], kept[0], weights["recurrent_f"], mask)
    b, wb = lstm_gradients(up[::-1, :, size:], kept[1], weights["recurrent_b"], mask[::-1])
    return a, b[::-1], {"recurrent_f": wa, "recurrent_b": wb}


def first_weights(inputs: int, size: int, outputs: int, seed: int) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)

    def normal(rows: int, columns: int, scale: float) -> np.ndarray:
        return (draw.standard_normal((rows, columns)) * scale).astype(np.float32)

    weights = {"out": normal(2 * size, outputs, 0.3), "out_bias": np.zeros(outputs, np.float32)}
    for way in "fb":
        bias = np.zeros(4 * size, np.float32)
        bias[size : 2 * size] = 1
        weights |= {f"input_{way}": normal(inputs, 4 * size, inputs**-0.5), f"recurrent_{way}": normal(size, 4 * size, size**-0.5), f"bias_{way}": bias}
    return weights


class Adam:
    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.steps = weights, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items()}
        self.square = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, gradients: dict[str, np.ndarray], most: float = 5.0) -> None:
        self.steps += 1
        norm = float(np.sqrt(sum(float((g**2).sum()) for g in gradients.values())))
        for k, g in gradients.items():
            g = g * min(1.0, most / (norm + 1e-9))
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.001 * (g**2 - self.square[k])
            a, b = self.mean[k] / (1 - 0.9**self.steps), self.square[k] / (1 - 0.999**self.steps)
            self.weights[k] -= (self.rate * a / (np.sqrt(b) + 1e-8)).astype(self.weights[k].dtype)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def crf_gradients(scores: np.ndarray, moves: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood of label sequences (T, B) and its gradients for scores (T, B, K) and moves (K, K)."""
    steps, batch, kinds = scores.shape
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    alpha[0] = scores[0]
    for t in range(1, steps):
        alpha[t] = scores[t] + _logsum(alpha[t - 1][:, :, None] + moves, 1)
    for t in range(steps - 2, -1, -1):
        beta[t] = _logsum(moves + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
    total = _logsum(alpha[-1], 1)
    chance = np.exp(alpha + beta - total[None, :, None])
    pairs = np.exp(alpha[:-1, :, :, None] + moves + (scores[1:] + beta[1:])[:, :, None, :] - total[None, :, None, None])
    hot = np.eye(kinds, dtype=scores.dtype)[labels]
    taken = np.einsum("tbi,tbj->ij", hot[:-1], hot[1:])
    loss = total.mean() - ((scores * hot).sum() + (moves * taken).sum()) / batch
    return float(loss), (chance - hot) / batch, (pairs.sum((0, 1)) - taken) / batch


def viterbi(scores: np.ndarray, moves: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The best label sequences (T, B); steps whose mask is 0 repeat the label before them."""
    steps, batch, kinds = scores.shape
    best, back, own = scores[0].copy(), np.empty((steps, batch, kinds), np.int8), np.arange(kinds)
    for t in range(1, steps):
        every = best[:, :, None] + moves
        back[t] = every.argmax(1)
        fresh = every.max(1) + scores[t]
        live = mask[t][:, None] > 0
        back[t] = np.where(live, back[t], own)
        best = np.where(live, fresh, best)
    out = np.empty((steps, batch), np.int64)
    out[-1] = best.argmax(1)
    for t in range(steps - 1, 0, -1):
        out[t - 1] = back[t][np.arange(batch), out[t]]
    return out
