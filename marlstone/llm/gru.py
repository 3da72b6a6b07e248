"""A bidirectional gated recurrent network over bytes in numpy: training through time, and labelling of every position."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: The code of a position beyond the end of a text.
PAD = 256


@dataclass
class Direction:
    """Gates in rows (reset, update, candidate). ``table``: their input per byte, biases included."""

    table: np.ndarray  # 3h x 257
    weight: np.ndarray  # 3h x h
    bias: np.ndarray  # h, of the candidate's recurrent part


@dataclass
class Network:
    ahead: Direction
    back: Direction
    out: np.ndarray  # labels x 2h
    out_bias: np.ndarray

    @property
    def hidden(self) -> int:
        return len(self.ahead.bias)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def new_network(labels: int, hidden: int, rng: np.random.Generator) -> Network:
    def direction() -> Direction:
        table = rng.normal(0, 0.5, (3 * hidden, PAD + 1)).astype(np.float32)
        table[hidden:2 * hidden] += 1  # start by remembering
        table[:, PAD] = 0
        table[hidden:2 * hidden, PAD] = 40  # an update gate of 1: padding leaves the state alone
        return Direction(
            table, rng.normal(0, hidden ** -0.5, (3 * hidden, hidden)).astype(np.float32), np.zeros(hidden, np.float32))

    return Network(direction(), direction(), rng.normal(0, 0.3, (labels, 2 * hidden)).astype(np.float32),
                   np.zeros(labels, np.float32))


def _forward(d: Direction, codes: np.ndarray, kept: list | None):
    """States after each position; codes are steps x texts. ``kept`` collects what the way back needs."""
    h = len(d.bias)
    state = np.zeros((h, codes.shape[1]), np.float32)
    bias = d.bias[:, None]
    for code in codes:
        given = d.table[:, code]
        own = d.weight @ state
        gates = sigmoid(given[:2 * h] + own[:2 * h])
        reset, update = gates[:h], gates[h:]
        memory = own[2 * h:] + bias
        candidate = np.tanh(given[2 * h:] + reset * memory)
        if kept is not None:
            kept.append((state, reset, update, memory, candidate))
        state = candidate + update * (state - candidate)
        yield state


def _backward(d: Direction, codes: np.ndarray, kept: list, outer: list[np.ndarray]) -> Direction:
    """Gradients, given those of the loss by each state."""
    h = len(d.bias)
    table, weight, bias = np.zeros((PAD + 1, 3 * h), np.float32), np.zeros_like(d.weight), np.zeros_like(d.bias)
    flow = np.zeros_like(kept[0][0])
    for step in reversed(range(len(codes))):
        state, reset, update, memory, candidate = kept[step]
        flow = flow + outer[step]
        d_candidate = flow * (1 - update) * (1 - candidate ** 2)
        d_update = flow * (state - candidate) * update * (1 - update)
        d_memory = d_candidate * reset
        d_reset = d_candidate * memory * reset * (1 - reset)
        given = np.concatenate([d_reset, d_update, d_candidate])
        own = np.concatenate([d_reset, d_update, d_memory])
        np.add.at(table, codes[step], given.T)
        weight += own @ state.T
        bias += d_memory.sum(axis=1)
        flow = flow * update + d.weight.T @ own
    table[PAD] = 0
    return Direction(table.T, weight, bias)


def gradients(net: Network, codes: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy of the label at every position of every text, and its gradient by each parameter."""
    keep_a, keep_b = [], []
    ahead = list(_forward(net.ahead, codes, keep_a))
    back = list(_forward(net.back, codes[::-1], keep_b))[::-1]
    real = codes != PAD
    total = max(int(real.sum()), 1)
    out, out_bias, loss = np.zeros_like(net.out), np.zeros_like(net.out_bias), 0.0
    outer_a, outer_b = [], []
    every = np.arange(codes.shape[1])
    for step in range(len(codes)):
        both = np.concatenate([ahead[step], back[step]])
        scores = net.out @ both + net.out_bias[:, None]
        scores -= scores.max(axis=0)
        chance = np.exp(scores)
        chance /= chance.sum(axis=0)
        loss -= float((np.log(chance[labels, every] + 1e-9) * real[step]).sum())
        chance[labels, every] -= 1
        chance *= real[step] / total
        out += chance @ both.T
        out_bias += chance.sum(axis=1)
        pull = net.out.T @ chance
        outer_a.append(pull[:net.hidden])
        outer_b.append(pull[net.hidden:])
    a = _backward(net.ahead, codes, keep_a, outer_a)
    b = _backward(net.back, codes[::-1], keep_b, outer_b[::-1])
    return loss / total, [a.table, a.weight, a.bias, b.table, b.weight, b.bias, out, out_bias]


def train(
    texts: list[bytes], labels: np.ndarray, kinds: int, hidden: int, steps: int, window: int, batch: int,
    rate: float = 0.02, seed: int = 5,
) -> Network:
    """Adam on random windows of the texts; each label is drawn as often as any other."""
    rng = np.random.default_rng(seed)
    net = new_network(kinds, hidden, rng)
    values = [net.ahead.table, net.ahead.weight, net.ahead.bias, net.back.table, net.back.weight, net.back.bias,
              net.out, net.out_bias]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    by_label = [np.flatnonzero(labels == k) for k in range(kinds)]
    by_label = [x for x in by_label if len(x)]
    for step in range(1, steps + 1):
        chosen = np.array([rng.choice(by_label[k]) for k in rng.integers(0, len(by_label), batch)])
        codes = np.full((window, batch), PAD)
        for column, k in enumerate(chosen):
            start = rng.integers(0, max(1, len(texts[k]) - window // 2))
            piece = np.frombuffer(texts[k][start:start + window], np.uint8)
            codes[:len(piece), column] = piece
        _, found = gradients(net, codes, labels[chosen])
        norm = float(np.sqrt(sum((g ** 2).sum() for g in found)))
        pace = rate * min(1.0, 10 * (1 - (step - 1) / steps)) * min(1.0, step / 10)
        for v, g, m, s in zip(values, found, first, second):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            v -= pace * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-6)
    return net


def label_windows(net: Network, codes: np.ndarray) -> np.ndarray:
    """Sums over the positions of each text (steps x texts) of the label probabilities: texts x labels."""
    h = net.hidden
    sums = np.zeros((len(net.out_bias), codes.shape[1]), np.float32)
    left = [net.out[:, :h] @ state for state in _forward(net.ahead, codes, None)]
    for step, state in zip(reversed(range(len(codes))), _forward(net.back, codes[::-1], None)):
        scores = left[step] + net.out[:, h:] @ state + net.out_bias[:, None]
        scores -= scores.max(axis=0)
        np.exp(scores, out=scores)
        scores *= (codes[step] != PAD) / scores.sum(axis=0)
        sums += scores
    return sums.T
