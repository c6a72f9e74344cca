"""A character tagger in numpy: a bidirectional LSTM whose outputs are decoded by a chain of tag transitions (CRF).

Tag 0 is "outside"; a tag may only stay, begin after 0, or end into 0. Texts are read in windows that overlap; each
character takes its tag from the window in which it lies farther inside, so one tag sequence results per text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

HIDDEN = 8
SYMBOLS = 98  # 0: behind the end, 1: not ASCII, then printable ASCII, then control characters
WINDOW, MARGIN = 512, 32
GRAIN = 64  # a window's length is a multiple of this
BATCH = 1 << 20  # characters of windows read together
NEVER = np.float32(-1e4)
Model = dict[str, np.ndarray]

SYMBOL = np.full(256, 97, np.uint8)
SYMBOL[32:127] = np.arange(2, 97)


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points < 128, SYMBOL[np.minimum(points, 255)], 1).astype(np.uint8)


def fresh(tags: int, seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)

    def some(*shape: int, by: float) -> np.ndarray:
        return rng.normal(0, by, shape).astype(np.float32)

    model: Model = {}
    for side in "fb":
        model["x" + side] = some(SYMBOLS, 4 * HIDDEN, by=0.3)
        model["x" + side][:, HIDDEN : 2 * HIDDEN] += 1.0  # remember at first
        model["u" + side] = some(HIDDEN, 4 * HIDDEN, by=0.3)
        model["o" + side] = some(HIDDEN, tags, by=0.3)
    model["bias"] = np.zeros(tags, np.float32)
    model["trans"] = np.zeros((tags, tags), np.float32)
    return model


def allowed(tags: int) -> np.ndarray:
    ok = np.eye(tags, dtype=bool)
    ok[0], ok[:, 0] = True, True
    return ok


# Gates stand in the order in, forget, out, new. A sigmoid is a tanh of half the value.
HALF = np.repeat(np.array([0.5, 0.5, 0.5, 1.0], np.float32), HIDDEN)


def lstm(codes: np.ndarray, x: np.ndarray, u: np.ndarray, back: bool, keep: bool = False) -> Iterator[tuple]:
    """(place, state, what the gradient needs) along codes (places x windows), from either end."""
    x, u = x * HALF, u * HALF
    h = np.zeros((codes.shape[1], HIDDEN), np.float32)
    c = h
    for t in range(len(codes) - 1, -1, -1) if back else range(len(codes)):
        z = x[codes[t]]
        z += h @ u
        np.tanh(z, out=z)
        s = z[:, : 3 * HIDDEN]
        s *= 0.5
        s += 0.5
        before, last = c, h
        c = s[:, HIDDEN : 2 * HIDDEN] * c
        c += s[:, :HIDDEN] * z[:, 3 * HIDDEN :]
        cell = np.tanh(c)
        h = s[:, 2 * HIDDEN :] * cell
        yield t, h, (z, before, last, cell) if keep else None


def outputs(model: Model, codes: np.ndarray) -> np.ndarray:
    """(places, tags, windows): how well each tag fits each place.

    Both directions go along together. Units are rows here, so that gates are contiguous; states are kept doubled, which saves
    the halves of the sigmoids."""
    places, n = codes.shape
    half = np.tile(HALF[:, None], (2, 1, 1))
    table = np.stack([model["xf"].T, model["xb"].T]) * half
    inner = np.stack([model["uf"].T, model["ub"].T]) * half * np.float32(0.5)
    last = np.stack([model["of"].T, model["ob"].T]) * np.float32(0.5)
    out = np.empty((places, len(model["bias"]), n), np.float32)
    z, add = (np.empty((2, 4 * HIDDEN, n), np.float32) for _ in range(2))
    h, c, new = (np.zeros((2, HIDDEN, n), np.float32) for _ in range(3))
    enter, keep, show, fresh_ = (z[:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
    fit = np.empty((2, len(model["bias"]), n), np.float32)
    for t in range(places):
        back = places - 1 - t
        np.take(table[0], codes[t], axis=1, out=z[0], mode="clip")
        np.take(table[1], codes[back], axis=1, out=z[1], mode="clip")
        np.matmul(inner, h, out=add)
        z += add
        np.tanh(z, out=z)
        z[:, : 3 * HIDDEN] += 1
        np.multiply(keep, c, out=c)
        np.multiply(enter, fresh_, out=new)
        c += new
        c *= 0.5
        np.tanh(c, out=h)
        h *= show
        np.matmul(last, h, out=fit)
        for at, side, first in ((t, fit[0], t <= back), (back, fit[1], back > t)):
            if first:
                out[at] = side
            else:
                out[at] += side
    out += model["bias"][:, None]
    return out


def best_tags(out: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """(places, windows): the tag sequence with the largest sum of outputs and transitions."""
    places, tags, n = out.shape
    enter, leave, stay = trans[0, 1:, None], trans[1:, 0, None], np.diag(trans)[1:, None]
    stays = np.empty((places, tags - 1, n), bool)
    left = np.zeros((places, n), np.int8)
    score = out[0].copy()
    for t in range(1, places):
        begin, go = score[0] + enter, score[1:] + stay
        np.greater(go, begin, out=stays[t])
        ends = score[1:] + leave
        best = score[0] + trans[0, 0]
        for k in range(tags - 1):
            np.copyto(left[t], k + 1, where=ends[k] > best)
            np.maximum(best, ends[k], out=best)
        np.maximum(begin, go, out=score[1:])
        score[0] = best
        score += out[t]
    tag = np.empty((places, n), np.int8)
    tag[-1] = score.argmax(axis=0)
    at = np.arange(n)
    for t in range(places - 1, 0, -1):
        now = tag[t]
        tag[t - 1] = np.where(now == 0, left[t], np.where(stays[t, np.maximum(now - 1, 0), at], now, 0)) if now.any() else left[t]
    return tag


def window_starts(length: int) -> list[tuple[int, int, int]]:
    """(start, first, stop): windows of a text and the places that take their tags from each."""
    step = WINDOW - 2 * MARGIN
    n = 1 if length <= WINDOW else -(-(length - 2 * MARGIN) // step)
    return [(i * step, i * step + (MARGIN if i else 0), length if i == n - 1 else (i + 1) * step + MARGIN) for i in range(n)]


def tagged(model: Model, texts: Sequence[np.ndarray]) -> list[np.ndarray]:
    """The tag of every character of the texts (given as symbols)."""
    tags = [np.zeros(len(x), np.int8) for x in texts]
    by_size: dict[int, list[tuple[int, int, int, int]]] = {}
    for i, x in enumerate(texts):
        for start, first, stop in window_starts(len(x)) if len(x) else ():
            size = -(-min(WINDOW, len(x) - start) // GRAIN) * GRAIN
            by_size.setdefault(size, []).append((i, start, first, stop))
    for size, windows in by_size.items():
        for a in range(0, len(windows), max(1, BATCH // size)):
            part = windows[a : a + max(1, BATCH // size)]
            codes = np.zeros((len(part), size), np.uint8)
            for row, (i, start, _, _) in zip(codes, part):
                piece = texts[i][start : start + size]
                row[: len(piece)] = piece
            found = best_tags(outputs(model, np.ascontiguousarray(codes.T)), model["trans"]).T
            for row, (i, start, first, stop) in zip(found, part):
                tags[i][first:stop] = row[first - start : stop - start]
    return tags


# Fitting

def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def chain_loss(out: np.ndarray, trans: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Negative log-likelihood per window of the tags ``y`` (places x windows), and its slopes."""
    places, tags, n = out.shape
    trans = np.where(allowed(tags), trans, NEVER)
    ahead, behind = np.empty_like(out), np.zeros_like(out)
    ahead[0] = out[0]
    for t in range(1, places):
        ahead[t] = log_sum(ahead[t - 1][:, None] + trans[:, :, None], 0) + out[t]
    for t in range(places - 2, -1, -1):
        behind[t] = log_sum(trans[:, :, None] + (out[t + 1] + behind[t + 1])[None], 1)
    whole = log_sum(ahead[-1], 0)
    d_out = np.exp(ahead + behind - whole)
    pairs = np.exp(ahead[:-1, :, None] + trans[None, :, :, None] + (out[1:] + behind[1:])[:, None] - whole).sum(axis=(0, 3))
    t, w = np.meshgrid(np.arange(places), np.arange(n), indexing="ij")
    gold = out[t, y, w].sum() + trans[y[:-1], y[1:]].sum()
    d_out[t, y, w] -= 1
    np.subtract.at(pairs, (y[:-1], y[1:]), 1)
    return float((whole.sum() - gold) / n), d_out / n, np.where(allowed(tags), pairs, 0) / n


def slopes(model: Model, codes: np.ndarray, y: np.ndarray) -> tuple[float, Model]:
    """Loss of a batch (places x windows) and the slope of every parameter."""
    kept = {s: {t: (h, more) for t, h, more in lstm(codes, model["x" + s], model["u" + s], s == "b", keep=True)} for s in "fb"}
    out = np.stack([(kept["f"][t][0] @ model["of"] + kept["b"][t][0] @ model["ob"] + model["bias"]).T for t in range(len(codes))])
    loss, d_out, d_trans = chain_loss(out, model["trans"], y)
    grad: Model = {"bias": d_out.sum(axis=(0, 2)).astype(np.float32), "trans": d_trans.astype(np.float32)}
    for s in "fb":
        x, u, o = np.zeros_like(model["x" + s]), np.zeros_like(model["u" + s]), np.zeros_like(model["o" + s])
        dh = np.zeros((codes.shape[1], HIDDEN), np.float32)
        dc = np.zeros_like(dh)
        for t in range(len(codes)) if s == "b" else range(len(codes) - 1, -1, -1):
            h, (z, before, last, cell) = kept[s][t]
            o += h.T @ d_out[t].T
            dh = dh + d_out[t].T @ model["o" + s].T
            i, f, q, g = (z[:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
            dc = dc + dh * q * (1 - cell * cell)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * cell * q * (1 - q), dc * i * (1 - g * g)], axis=1)
            np.add.at(x, codes[t], dz)
            u += last.T @ dz
            dh, dc = dz @ model["u" + s].T, dc * f
        grad |= {"x" + s: x, "u" + s: u, "o" + s: o}
    return loss, grad


def fit(codes: np.ndarray, y: np.ndarray, tags: int, steps: int, batch: int = 64, rate: float = 0.03, seed: int = 7) -> Model:
    """Adam over windows (windows x places) and their tags; the order is fixed by the seed."""
    model, rng = fresh(tags, seed), np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in model.items()}
    square = {k: np.zeros_like(v) for k, v in model.items()}
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        if len(order) < batch:
            order = np.append(order, rng.permutation(len(codes)))
        pick, order = order[:batch], order[batch:]
        _, grad = slopes(model, codes[pick].T, y[pick].T.astype(np.int64))
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grad.items():
            mean[k] += 0.1 * (g - mean[k])
            square[k] += 0.01 * (g * g - square[k])
            model[k] -= np.float32(now) * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)
    model["trans"] = np.where(allowed(tags), model["trans"], NEVER).astype(np.float32)
    return model
