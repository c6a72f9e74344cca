"""A small causal self-attention model in numpy: which class of subword comes next.

One head. A block of ``STRIDE`` tokens is scored with the ``STRIDE`` tokens before it as context, so windows of
``2 * STRIDE`` overlap by half and each token is scored once. Queries, keys and values are rows of tables
by input symbol, distance enters as a learned bias, later tokens and missing ones are masked.
"""

from __future__ import annotations

import copy
import math
from dataclasses import dataclass

import numpy as np

STRIDE = 16
WIDTH = 16
MASKED = np.float32(-1e9)
LARGEST = 60.0  # of a score before its exponential


def blocks_of(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For sequences laid end to end: first place of every block, its number of tokens, and whether a block precedes it."""
    starts = np.cumsum(lengths) - lengths
    n = -(-lengths // STRIDE)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    first = np.repeat(starts, n) + nth * STRIDE
    return first, np.minimum(STRIDE, np.repeat(starts + lengths, n) - first), nth > 0


def sums(x: np.ndarray) -> np.ndarray:
    """Over the last axis."""
    return (x.reshape(-1, x.shape[-1]) @ np.ones(x.shape[-1], x.dtype)).reshape(x.shape[:-1])


def added(at: np.ndarray, parts: tuple[np.ndarray, ...], size: int) -> list[np.ndarray]:
    """Rows of ``parts`` added up by the symbols ``at`` that they belong to."""
    symbol = at.ravel()
    order = np.argsort(symbol.astype(np.uint16) if size <= 1 << 16 else symbol, kind="stable")  # short numbers are sorted by their digits
    symbol = symbol[order]
    starts = np.flatnonzero(np.append(True, symbol[1:] != symbol[:-1]))
    sums = np.add.reduceat(np.concatenate([p.reshape(-1, p.shape[-1]) for p in parts], axis=1).take(order, axis=0), starts, axis=0)
    out, a = [], 0
    for part in parts:
        out.append(np.zeros((size, part.shape[-1]), part.dtype))
        out[-1][symbol[starts]] = sums[:, a : a + part.shape[-1]]
        a += part.shape[-1]
    return out


@dataclass
class Attention:
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    rest: np.ndarray
    bias: np.ndarray  # by distance, 2 * STRIDE
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, symbols: int, classes: int, shares: np.ndarray, seed: int = 5) -> Attention:
        rng = np.random.default_rng(seed)
        tables = [rng.normal(0, 0.3, (symbols, WIDTH)).astype(np.float32) for _ in range(4)]
        return cls(*tables, np.zeros(2 * STRIDE, np.float32), rng.normal(0, 0.1, (WIDTH, classes)).astype(np.float32),
                   np.log(shares).astype(np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.query, self.key, self.value, self.rest, self.bias, self.out, self.out_bias]

    def inputs(self, x: np.ndarray, first: np.ndarray, size: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of every window (blocks x 2 * STRIDE) and the mask of its scores."""
        place = first[:, None] + np.arange(-STRIDE, STRIDE)
        there = np.concatenate([np.repeat(more[:, None], STRIDE, 1), np.arange(STRIDE) < size[:, None]], axis=1)
        window = x[np.clip(place, 0, len(x) - 1)]
        gap = np.arange(STRIDE)[:, None] + STRIDE - np.arange(2 * STRIDE)
        score = np.where(gap >= 0, self.bias[np.clip(gap, 0, 2 * STRIDE - 1)], MASKED)
        return window, score[None] + np.where(there, np.float32(0), MASKED)[:, None, :]

    def attend(self, window: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, ...]:
        last = window[:, STRIDE:]
        q, k, v = self.query.take(last, axis=0), self.key.take(window, axis=0), self.value.take(window, axis=0)
        a = q @ k.transpose(0, 2, 1)
        np.clip(a, -LARGEST, LARGEST, out=a)  # so that no row of exponentials is zero or infinite
        a += mask
        np.exp(a, out=a)
        a /= sums(a)[..., None]
        return q, k, v, a, a @ v

    def logits(self, h: np.ndarray) -> np.ndarray:
        z = h @ self.out
        z += self.out_bias
        return np.clip(z, -LARGEST, LARGEST, out=z)

    def score(self, x: np.ndarray, targets: np.ndarray, lengths: np.ndarray, at_once: int = 128) -> np.ndarray:
        """Natural log-probability of every target class. ``x``: the symbol before each target."""
        first, size, more = blocks_of(lengths)
        out = np.zeros(len(x), np.float32)
        for a in range(0, len(first), at_once):
            f, n = first[a : a + at_once], size[a : a + at_once]
            window, mask = self.inputs(x, f, n, more[a : a + at_once])
            inside = np.arange(STRIDE) < n[:, None]
            place = (f[:, None] + np.arange(STRIDE))[inside]
            h = self.attend(window, mask)[4][inside] + self.rest.take(window[:, STRIDE:][inside], axis=0)
            z = self.logits(h)
            own = z[np.arange(len(z)), targets[place]]
            np.exp(z, out=z)
            out[place] = own - np.log(sums(z))
        return out

    def gradients(self, x: np.ndarray, targets: np.ndarray, first: np.ndarray, size: np.ndarray, more: np.ndarray) -> tuple[float, list[np.ndarray]]:
        window, mask = self.inputs(x, first, size, more)
        last = window[:, STRIDE:]
        q, k, v, a, o = self.attend(window, mask)
        h = (o + self.rest.take(last, axis=0)).reshape(-1, WIDTH)
        share = (np.arange(STRIDE) < size[:, None]).ravel() / h.dtype.type(size.sum())
        at = np.arange(len(h)), targets.take((first[:, None] + np.arange(STRIDE)).ravel(), mode="clip")
        d = self.logits(h)
        own = d[at]
        np.exp(d, out=d)
        total = sums(d)
        loss = -float(((own - np.log(total)) * share).sum())
        d *= (share / total)[:, None]
        d[at] -= share
        dh = (d @ self.out.T).reshape(o.shape)
        ds = dh @ v.transpose(0, 2, 1)
        ds -= sums(dh * o)[..., None]  # the mean of a row, weighted by its attention
        ds *= a
        g = [*added(last, (ds @ k, dh), len(self.query)), *added(window, (ds.transpose(0, 2, 1) @ q, a.transpose(0, 2, 1) @ dh), len(self.query))]
        g = [g[0], g[2], g[3], g[1], np.zeros_like(self.bias), h.T @ d, np.ones(len(d), d.dtype) @ d]
        gap = np.arange(STRIDE)[:, None] + STRIDE - np.arange(2 * STRIDE)
        np.add.at(g[4], np.clip(gap, 0, 2 * STRIDE - 1), np.where(gap >= 0, ds.sum(axis=0), 0))
        return loss, g

    def train(self, x: np.ndarray, targets: np.ndarray, lengths: np.ndarray, steps: int, batch: int = 96, rate: float = 0.02, seed: int = 6) -> float:
        """Adam over random blocks; returns the mean loss of the last tenth of the steps."""
        first, size, more = blocks_of(lengths)
        steps = min(steps, 2 * len(first) // batch + 20)  # about two rounds over a small sample at most
        rng, last, adam = np.random.default_rng(seed), [], Adam(self)
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(first), batch)
            loss, grads = self.gradients(x, targets, first[pick], size[pick], more[pick])
            adam.step(grads, rate * min(1.0, step / 50) * (1 - 0.95 * step / steps))
            if step > 0.9 * steps:
                last.append(loss)
        return float(np.mean(last)) if last else float("nan")


class Adam:
    """Moments of the gradients of one model."""

    def __init__(self, model: Attention):
        self.model, self.done = model, 0
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in model.parameters()]

    def step(self, grads: list[np.ndarray], pace: float) -> None:
        """``grads`` are overwritten."""
        self.done += 1
        for p, g, (m, v) in zip(self.model.parameters(), grads, self.moments, strict=True):
            g *= 0.1
            m *= 0.9
            m += g
            np.multiply(g, g, out=g)  # a hundredth of the gradient's square
            v *= 0.99
            v += g
            scale = np.sqrt(v, out=g)
            scale *= 1 / math.sqrt(1 - 0.99**self.done)
            scale += 1e-6
            np.divide(m, scale, out=scale)
            scale *= pace / (1 - 0.9**self.done)
            p -= scale


class Learner:
    """A task's own copy of a model, which learns from every block of the sequences it is given, once."""

    def __init__(self, start: Attention, batch: int = 256, rate: float = 0.004, seed: int = 8):
        self.start, self.model = start, copy.deepcopy(start)
        self.adam, self.batch, self.rate, self.rng = Adam(self.model), batch, rate, np.random.default_rng(seed)
        self.seen = np.zeros(len(start.query))  # how often each symbol was read

    def again(self) -> Learner:
        """A new one from the same start."""
        return Learner(self.start, self.batch, self.rate)

    def learn(self, x: np.ndarray, targets: np.ndarray, lengths: np.ndarray) -> None:
        first, size, more = blocks_of(lengths)
        order = self.rng.permutation(len(first))
        for a in range(0, len(order), self.batch):
            pick = order[a : a + self.batch]
            share = size[pick].sum() / (self.batch * STRIDE)  # a short batch moves the weights less
            self.adam.step(self.model.gradients(x, targets, first[pick], size[pick], more[pick])[1], self.rate * share * min(1.0, (self.adam.done + 1) / 20))
        self.seen += np.bincount(x, minlength=len(self.seen))

    def moved(self) -> np.ndarray:
        """What it learned, weighted by the symbols read, and the weights: these can be added up over tasks."""
        parts = []
        for p, q in zip(self.model.parameters(), self.start.parameters(), strict=True):
            weight = self.seen if len(p) == len(self.seen) else np.full(len(p), self.seen.sum())
            parts.append(((p - q).astype(float) * (weight[:, None] if p.ndim == 2 else weight)).ravel())
        return np.concatenate([*parts, self.seen])


def averaged(start: Attention, moved: np.ndarray) -> Attention:
    """The start and the mean of what all tasks learned."""
    model, seen, a = copy.deepcopy(start), moved[len(moved) - len(start.query) :], 0
    for p in model.parameters():
        weight = seen if len(p) == len(seen) else np.full(len(p), seen.sum())
        mean = moved[a : a + p.size].reshape(p.shape) / np.maximum(weight[:, None] if p.ndim == 2 else weight, 1.0)
        p += mean.astype(p.dtype)
        a += p.size
    return model
