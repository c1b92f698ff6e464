"""A small reverse-mode differentiation over numpy, and Adam, for the models trained here.

The functions take arrays or Var; on plain arrays they compute without keeping anything, so a model's
forward pass is written once for training and scoring.
"""

from __future__ import annotations

import numpy as np


class Var:
    def __init__(self, data, back=None, of=()):
        self.data, self.back, self.of, self.grad = np.asarray(data), back, of, None

    @property
    def shape(self):
        return self.data.shape


def val(x):
    return x.data if isinstance(x, Var) else x


def _fit(g, shape):
    while g.ndim > len(shape):
        g = g.sum(0)
    for i, n in enumerate(shape):
        if n == 1 and g.shape[i] != 1:
            g = g.sum(i, keepdims=True)
    return g


def _op(out, back, *of):
    return Var(out, back, of) if any(isinstance(x, Var) for x in of) else out


def add(x, y):
    a, b = val(x), val(y)
    return _op(a + b, lambda g: (_fit(g, a.shape), _fit(g, b.shape)), x, y)


def sub(x, y):
    a, b = val(x), val(y)
    return _op(a - b, lambda g: (_fit(g, a.shape), -_fit(g, b.shape)), x, y)


def mul(x, y):
    a, b = val(x), val(y)
    return _op(a * b, lambda g: (_fit(g * b, a.shape), _fit(g * a, b.shape)), x, y)


def matmul(x, y):
    """x of any rank times y: a matrix, or of x's rank."""
    a, b = val(x), val(y)

    def back(g):
        db = a.reshape(-1, a.shape[-1]).T @ g.reshape(-1, g.shape[-1]) if b.ndim == 2 else np.swapaxes(a, -1, -2) @ g
        return g @ np.swapaxes(b, -1, -2), db

    # one product of matrices, not one for each leading index
    out = (a.reshape(-1, a.shape[-1]) @ b).reshape(*a.shape[:-1], b.shape[-1]) if a.ndim > 2 and b.ndim == 2 else a @ b
    return _op(out, back, x, y)


def tanh(x):
    t = np.tanh(val(x))
    return _op(t, lambda g: (g * (1 - t * t),), x)


def sigmoid(x):
    s = 0.5 * np.tanh(0.5 * val(x)) + 0.5
    return _op(s, lambda g: (g * s * (1 - s),), x)


def relu(x):
    a = val(x)
    return _op(np.maximum(a, 0), lambda g: (g * (a > 0),), x)


def take(x, index):
    """Rows of a table."""
    a = val(x)

    def back(g):
        out, flat = np.zeros_like(a), index.reshape(-1)
        if len(flat):
            order = np.argsort(flat, kind="stable")
            rows = flat[order]
            new = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
            out[rows[new]] = np.add.reduceat(g.reshape(-1, a.shape[-1])[order], new, 0)
        return (out,)

    return _op(a[index], back, x)


def bag(table, rows: np.ndarray, n: np.ndarray, mean: bool = False):
    """Sum or mean of the rows of a table that belong together: n of them (one or more) for each, one after the other."""
    a, starts = val(table), np.cumsum(n) - n
    scale = (1 / n if mean else np.ones(len(n))).astype(np.float32)[:, None]
    out = np.add.reduceat(a[rows], starts, 0) * scale if len(n) else np.zeros((0, a.shape[1]), np.float32)

    def back(g):
        order = np.argsort(rows, kind="stable")
        at, d = rows[order], np.zeros_like(a)
        if len(at):
            new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            d[at[new]] = np.add.reduceat(np.repeat(g * scale, n, 0)[order], new, 0)
        return (d,)

    return _op(out, back, table)


def part(x, key):
    a = val(x)

    def back(g):
        out = np.zeros_like(a)
        out[key] = g
        return (out,)

    return _op(a[key], back, x)


def reshape(x, *shape):
    a = val(x)
    return _op(a.reshape(shape), lambda g: (g.reshape(a.shape),), x)


def swap(x):
    return _op(np.swapaxes(val(x), -1, -2), lambda g: (np.swapaxes(g, -1, -2),), x)


def concat(xs, axis=-1):
    ends = np.cumsum([val(x).shape[axis] for x in xs])[:-1]
    return _op(np.concatenate([val(x) for x in xs], axis), lambda g: tuple(np.split(g, ends, axis)), *xs)


def stack(xs, axis=0):
    n = len(xs)
    return _op(np.stack([val(x) for x in xs], axis), lambda g: tuple(np.take(g, i, axis) for i in range(n)), *xs)


def total(x, axis):
    a = val(x)
    return _op(a.sum(axis), lambda g: (np.broadcast_to(np.expand_dims(g, axis), a.shape),), x)


def top(x, axis):
    a = val(x)
    at = np.expand_dims(a.argmax(axis), axis)

    def back(g):
        out = np.zeros_like(a)
        np.put_along_axis(out, at, np.expand_dims(g, axis), axis)
        return (out,)

    return _op(np.take_along_axis(a, at, axis).squeeze(axis), back, x)


def softmax(x, axis=-1):
    a = val(x)
    e = np.exp(a - a.max(axis, keepdims=True))
    s = e / e.sum(axis, keepdims=True)
    return _op(s, lambda g: (s * (g - (g * s).sum(axis, keepdims=True)),), x)


def bce(logit, y, weight):
    """Weighted mean of the binary cross-entropy."""
    a = val(logit)
    w = weight / weight.sum()
    loss = (w * (np.logaddexp(0, a) - y * a)).sum()
    return _op(loss, lambda g: (g * w * (1 / (1 + np.exp(-np.clip(a, -50, 50))) - y),), logit)


def cross_entropy(logits, y):
    a = val(logits)
    m = a.max(-1, keepdims=True)
    e = np.exp(a - m)
    s = e.sum(-1, keepdims=True)
    rows = np.arange(len(y))
    loss = (np.log(s[:, 0]) + m[:, 0] - a[rows, y]).mean()

    def back(g):
        p = e / s
        p[rows, y] -= 1
        return (g * p / len(y),)

    return _op(loss, back, logits)


def backward(loss: Var) -> None:
    order, seen, stack_ = [], set(), [(loss, False)]
    while stack_:
        x, done = stack_.pop()
        if done:
            order.append(x)
        elif id(x) not in seen:
            seen.add(id(x))
            stack_.append((x, True))
            stack_ += [(y, False) for y in x.of if isinstance(y, Var)]
    loss.grad = np.ones_like(loss.data)
    for x in reversed(order):
        if x.back is not None:
            for y, g in zip(x.of, x.back(x.grad)):
                if isinstance(y, Var):
                    y.grad = g if y.grad is None else y.grad + g
            x.grad = None


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float = 0.01, decay: float = 0.0):
        self.p, self.rate, self.decay, self.t = params, rate, decay, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, loss_of) -> float:
        """loss_of: from the parameters as Var to the loss."""
        live = {k: Var(v) for k, v in self.p.items()}
        loss = loss_of(live)
        backward(loss)
        self.move({k: x.grad for k, x in live.items() if x.grad is not None})
        return float(loss.data)

    def move(self, grads: dict[str, np.ndarray]) -> None:
        """A step by the given gradients."""
        self.t += 1
        for k, g in grads.items():
            g = g + self.decay * self.p[k] if self.decay else g
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            step = self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)
            self.p[k] = (self.p[k] - step).astype(np.float32)


def init(rng: np.random.Generator, **shapes: tuple) -> dict[str, np.ndarray]:
    """Small random weights; vectors start at 0."""
    return {k: (rng.normal(0, 1 / np.sqrt(max(s[0], 1) if len(s) > 1 and s[0] < 1000 else 10), s) if len(s) > 1 else np.zeros(s)).astype(np.float32) for k, s in shapes.items()}


def lstm(x, wh, n_hidden: int, mask: np.ndarray, reverse: bool = False):
    """Hidden states (T, B, H) from x (T, B, 4H), inputs already through their weights; mask (T, B, 1) is 0 past the end."""
    steps = range(val(x).shape[0])
    h = c = np.zeros((val(x).shape[1], n_hidden), np.float32)
    out = [None] * len(steps)
    for t in reversed(steps) if reverse else steps:
        z = add(part(x, t), matmul(h, wh))
        gate = sigmoid(part(z, (slice(None), slice(0, 3 * n_hidden))))
        i, f, o = (part(gate, (slice(None), slice(k * n_hidden, (k + 1) * n_hidden))) for k in range(3))
        c = mul(add(mul(f, c), mul(i, tanh(part(z, (slice(None), slice(3 * n_hidden, None)))))), mask[t])
        h = mul(o, tanh(c))
        out[t] = h
    return stack(out)


def gru(x, wh, wn, n_hidden: int, mask: np.ndarray, reverse: bool = False):
    """Hidden states (T, B, H) from x (T, B, 3H), inputs already through their weights."""
    steps = range(val(x).shape[0])
    h = np.zeros((val(x).shape[1], n_hidden), np.float32)
    out = [None] * len(steps)
    for t in reversed(steps) if reverse else steps:
        xt = part(x, t)
        gate = sigmoid(add(part(xt, (slice(None), slice(0, 2 * n_hidden))), matmul(h, wh)))
        z, r = part(gate, (slice(None), slice(0, n_hidden))), part(gate, (slice(None), slice(n_hidden, None)))
        n = tanh(add(part(xt, (slice(None), slice(2 * n_hidden, None))), matmul(mul(r, h), wn)))
        h = mul(add(h, mul(z, sub(n, h))), mask[t])
        out[t] = h
    return stack(out)
