"""A character tagger in numpy: bidirectional LSTM, then a linear-chain CRF. Runs inside tasks.

All arrays are [window, place]; a window is a row of character numbers of fixed length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ALPHABET = 130  # ASCII, any other character, outside of the text
OTHER, OUTSIDE = 128, 129
_NEVER = -1e4


def characters(window: str, length: int) -> np.ndarray:
    """Character numbers, filled up to `length`."""
    out = np.full(length, OUTSIDE, np.int64)
    codes = np.frombuffer(window.encode("utf-32-le", "replace"), "<u4")
    out[: len(codes)] = np.minimum(codes, OTHER)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Lstm:
    """One direction. `table` holds, by character, what it adds to the four gates (bias included)."""

    table: np.ndarray  # [character, 4 * hidden]
    recurrent: np.ndarray  # [hidden, 4 * hidden]

    @staticmethod
    def new(hidden: int, rng: np.random.Generator) -> Lstm:
        table = rng.normal(0, 0.3, (ALPHABET, 4 * hidden))
        table[:, hidden : 2 * hidden] += 1  # the forget gate starts open
        return Lstm(table, rng.normal(0, hidden**-0.5, (hidden, 4 * hidden)))

    def forward(self, chars: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
        n, length = chars.shape
        hidden = self.recurrent.shape[0]
        h, c = np.zeros((n, hidden)), np.zeros((n, hidden))
        states, out = [], np.empty((n, length, hidden))
        for t in range(length):
            z = self.table[chars[:, t]] + h @ self.recurrent
            i, f, o = np.split(sigmoid(z[:, : 3 * hidden]), 3, 1)
            g = np.tanh(z[:, 3 * hidden :])
            before, c = (h, c), f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            states.append((*before, i, f, o, g, tc))
            out[:, t] = h
        return out, states

    def backward(self, chars: np.ndarray, states: list[tuple], d_out: np.ndarray) -> Lstm:
        d_table, d_recurrent = np.zeros_like(self.table), np.zeros_like(self.recurrent)
        dh, dc = np.zeros_like(d_out[:, 0]), np.zeros_like(d_out[:, 0])
        for t in range(chars.shape[1] - 1, -1, -1):
            h, c, i, f, o, g, tc = states[t]
            dh = dh + d_out[:, t]
            dc = dc + dh * o * (1 - tc**2)
            dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g**2)], 1)
            np.add.at(d_table, chars[:, t], dz)
            d_recurrent += h.T @ dz
            dh, dc = dz @ self.recurrent.T, dc * f
        return Lstm(d_table, d_recurrent)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def crf_marginals(emissions: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-partition by window, tag probabilities by place, expected transition counts."""
    n, length, tags = emissions.shape
    ahead, behind = np.empty_like(emissions), np.zeros_like(emissions)
    ahead[:, 0] = emissions[:, 0]
    for t in range(1, length):
        ahead[:, t] = _logsum(ahead[:, t - 1, :, None] + moves, 1) + emissions[:, t]
    for t in range(length - 2, -1, -1):
        behind[:, t] = _logsum(moves + (emissions[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
    total = _logsum(ahead[:, -1], 1)
    tag = np.exp(ahead + behind - total[:, None, None])
    pairs = np.zeros((tags, tags))
    for t in range(1, length):
        pairs += np.exp(ahead[:, t - 1, :, None] + moves + (emissions[:, t] + behind[:, t])[:, None, :] - total[:, None, None]).sum(0)
    return total, tag, pairs


def viterbi(emissions: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best tag sequence of every window."""
    n, length, _ = emissions.shape
    best, back = emissions[:, 0], np.zeros(emissions.shape, np.int64)
    for t in range(1, length):
        scores = best[:, :, None] + moves
        back[:, t] = scores.argmax(1)
        best = scores.max(1) + emissions[:, t]
    out = np.empty((n, length), np.int64)
    out[:, -1] = best.argmax(1)
    for t in range(length - 1, 0, -1):
        out[:, t - 1] = back[np.arange(n), t, out[:, t]]
    return out


@dataclass
class Tagger:
    ahead: Lstm
    behind: Lstm
    out: np.ndarray  # [2 * hidden, tag]
    bias: np.ndarray  # [tag]
    moves: np.ndarray  # [tag, tag]; forbidden moves stay at a very low score
    allowed: np.ndarray  # [tag, tag]

    @staticmethod
    def new(hidden: int, allowed: np.ndarray, seed: int = 11) -> Tagger:
        rng = np.random.default_rng(seed)
        tags = len(allowed)
        return Tagger(Lstm.new(hidden, rng), Lstm.new(hidden, rng), rng.normal(0, 0.3, (2 * hidden, tags)), np.zeros(tags), np.where(allowed, 0.0, _NEVER), allowed)

    def parameters(self) -> list[np.ndarray]:
        return [self.ahead.table, self.ahead.recurrent, self.behind.table, self.behind.recurrent, self.out, self.bias, self.moves]

    def emissions(self, chars: np.ndarray) -> np.ndarray:
        both = np.concatenate([self.ahead.forward(chars)[0], self.behind.forward(chars[:, ::-1])[0][:, ::-1]], 2)
        return both @ self.out + self.bias

    def decode(self, chars: np.ndarray, batch: int = 1024) -> np.ndarray:
        parts = [viterbi(self.emissions(chars[k : k + batch]), self.moves) for k in range(0, len(chars), batch)]
        return np.concatenate(parts) if parts else np.zeros(chars.shape, np.int64)

    def gradients(self, chars: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log-likelihood and its gradient by parameter."""
        n, length = chars.shape
        left, left_states = self.ahead.forward(chars)
        right, right_states = self.behind.forward(chars[:, ::-1])
        both = np.concatenate([left, right[:, ::-1]], 2)
        emissions = both @ self.out + self.bias
        total, tag, pairs = crf_marginals(emissions, self.moves)
        gold = np.take_along_axis(emissions, tags[:, :, None], 2).sum() + self.moves[tags[:, :-1], tags[:, 1:]].sum()
        d = tag
        np.put_along_axis(d, tags[:, :, None], np.take_along_axis(d, tags[:, :, None], 2) - 1, 2)
        d /= n
        np.subtract.at(pairs, (tags[:, :-1], tags[:, 1:]), 1)
        d_both = d @ self.out.T
        hidden = left.shape[2]
        one = self.ahead.backward(chars, left_states, d_both[:, :, :hidden])
        two = self.behind.backward(chars[:, ::-1], right_states, d_both[:, ::-1, hidden:])
        d_out = both.reshape(n * length, -1).T @ d.reshape(n * length, -1)
        return float(total.sum() - gold) / n, [one.table, one.recurrent, two.table, two.recurrent, d_out, d.sum((0, 1)), np.where(self.allowed, pairs / n, 0)]


def fit(chars: np.ndarray, tags: np.ndarray, allowed: np.ndarray, hidden: int = 16, epochs: int = 10, batch: int = 128, rate: float = 0.02, seed: int = 11) -> Tagger:
    """Adam on mini-batches; the step shrinks to nothing towards the end. The same rows give the same tagger."""
    model, rng = Tagger.new(hidden, allowed, seed), np.random.default_rng(seed)
    first = [np.zeros_like(p) for p in model.parameters()]
    second = [np.zeros_like(p) for p in model.parameters()]
    step, steps = 0, epochs * -(-len(chars) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(chars))
        for k in range(0, len(chars), batch):
            rows = order[k : k + batch]
            _, gradients = model.gradients(chars[rows], tags[rows])
            norm = np.sqrt(sum((g**2).sum() for g in gradients))
            step += 1
            for p, g, m, v in zip(model.parameters(), gradients, first, second, strict=True):
                g = g * min(1.0, 5.0 / (norm + 1e-12))
                m += 0.1 * (g - m)
                v += 0.01 * (g**2 - v)
                p -= rate * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model
