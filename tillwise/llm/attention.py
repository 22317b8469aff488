"""A small causal self-attention model over token classes, in numpy: loss, gradients and scores of batched windows.

The classes lie in groups of equal size: a token's group is predicted first, then its class among the group's, so a
token costs two short softmaxes instead of one over all classes.
"""

from __future__ import annotations

import numpy as np

#: Positions of a window, and how many of its last ones are predicted; the others are context that an
#: earlier window has predicted.
WINDOW, STEP = 32, 16
WIDTH = 24
#: Windows whose attention is computed at once.
PART = 40
NAMES = ("embed", "place", "query", "key", "value", "out", "bias", "inner", "inner_bias")

Params = dict[str, np.ndarray]


def groups_of(classes: int) -> int:
    """How many groups: the largest divisor of the number of classes that is at most its root."""
    return next(g for g in range(int(classes**0.5), 0, -1) if classes % g == 0)


def shapes(classes: int) -> dict[str, tuple[int, ...]]:
    groups = groups_of(classes)
    return {
        "embed": (classes + 1, WIDTH), "place": (WINDOW, WIDTH), "query": (WIDTH, WIDTH), "key": (WIDTH, WIDTH),
        "value": (WIDTH, WIDTH), "out": (WIDTH, groups), "bias": (groups,),
        "inner": (groups, WIDTH, classes // groups), "inner_bias": (groups, classes // groups),
    }


def initial(class_share: np.ndarray, seed: int = 7) -> Params:
    """Small random weights; the biases alone predict the classes' shares."""
    rng = np.random.default_rng(seed)
    params = {k: (0.1 * rng.standard_normal(s)).astype(np.float32) for k, s in shapes(len(class_share)).items()}
    share = class_share.reshape(params["inner_bias"].shape)
    params["bias"] = np.log(share.sum(1)).astype(np.float32)
    params["inner_bias"] = np.log(share / share.sum(1, keepdims=True)).astype(np.float32)
    return params


def flat(params: Params) -> np.ndarray:
    return np.concatenate([params[k].ravel() for k in NAMES])


def unflat(values: np.ndarray, classes: int) -> Params:
    out, at = {}, 0
    for k, s in shapes(classes).items():
        n = int(np.prod(s))
        out[k] = np.asarray(values[at : at + n], np.float32).reshape(s)
        at += n
    return out


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first predicted position, number within the document) of the windows that predict every token once."""
    per = -(-lengths // STEP)
    doc = np.repeat(np.arange(len(lengths)), per)
    number = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    return doc, number * STEP, number


def gather(classes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, doc: np.ndarray, first: np.ndarray, begin: int):
    """Inputs (the class before each position, begin at a document's start), their mask, targets and theirs."""
    place = first[:, None] - (WINDOW - STEP) + np.arange(WINDOW)
    length = lengths[doc][:, None]
    real = (place >= 0) & (place < length)
    at = starts[doc][:, None] + np.where(real, place, 0)
    x = np.where(place > 0, classes[np.maximum(at - 1, 0)], begin)
    return np.where(real, x, begin), real, classes[at[:, -STEP:]], real[:, -STEP:]


_PAST = np.arange(WINDOW)[None, :] <= (WINDOW - STEP + np.arange(STEP))[:, None]
#: Logits are cut here, which keeps their exponentials within single precision without a search for the largest.
LIMIT = 60


def _softmax(logits: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
    """Over the last axis, in place; the sums are products with ones, which are faster over short axes."""
    np.clip(logits, -LIMIT, LIMIT, out=logits)
    np.exp(logits, out=logits)
    if mask is not None:
        logits *= mask
    rows = logits.reshape(-1, logits.shape[-1])
    rows /= (rows @ np.ones(rows.shape[1], rows.dtype))[:, None]
    return logits


def _attend(q: np.ndarray, k: np.ndarray, v: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = (q / q.dtype.type(WIDTH**0.5)) @ k.transpose(0, 2, 1)
    a = _softmax(s, _PAST if real.all() else _PAST & real[:, None, :] | ~real[:, -STEP:, None])
    return a, a @ v


def _forward(p: Params, x: np.ndarray, real: np.ndarray):
    h = p["embed"].take(x, 0)
    h += p["place"]
    ask = h[:, -STEP:]
    q, k, v = ask @ p["query"], h @ p["key"], h @ p["value"]
    a, seen = _attend(q, k, v, real)
    return h, ask, q, k, v, a, ask + seen


def _top(p: Params, x: np.ndarray, real: np.ndarray) -> np.ndarray:
    """The last of _forward's results, for many windows: the products of every class and place are taken once."""
    names = ("query", "key", "value")
    classes, places = ([p[k], *(p[k] @ p[n] for n in names)] for k in ("embed", "place"))
    out = np.empty((len(x), STEP, WIDTH), p["embed"].dtype)
    # few windows at a time, whose parts then stay in a processor's cache
    for i in range(0, len(x), PART):
        part, own = x[i : i + PART], x[i : i + PART, -STEP:]
        ask, q = (classes[j].take(own, 0) + places[j][-STEP:] for j in (0, 1))
        k, v = (classes[j].take(part, 0) + places[j] for j in (2, 3))
        np.add(ask, _attend(q, k, v, real[i : i + PART])[1], out=out[i : i + PART])
    return out


def _sorted_by(group: np.ndarray, groups: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The rows in the order of their groups, and each group that occurs with its first row and the one after its last."""
    ends = np.cumsum(np.bincount(group, minlength=groups)).tolist()
    order = np.argsort(group.astype(np.int16), kind="stable")
    return order, [(g, a, b) for g, (a, b) in enumerate(zip([0, *ends[:-1]], ends, strict=True)) if a < b]


def _with_bias(p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Weights with the biases as a last row, for inputs with a last column of ones."""
    return np.concatenate([p["out"], p["bias"][None]]), np.concatenate([p["inner"], p["inner_bias"][:, None]], 1)


def _with_one(top: np.ndarray) -> np.ndarray:
    return np.concatenate([top, np.ones((len(top), 1), top.dtype)], 1)


def _inner_shares(tops: np.ndarray, inner: np.ndarray, parts: list[tuple[int, int, int]]) -> np.ndarray:
    """Of rows in the order of their groups the shares within the group."""
    logits = np.empty((len(tops), inner.shape[2]), tops.dtype)
    for g, a, b in parts:
        np.matmul(tops[a:b], inner[g], out=logits[a:b])
    return _softmax(logits)


def log_shares(p: Params, x: np.ndarray, real: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log probability of each target class."""
    top, (out, inner) = _with_one(_top(p, x, real).reshape(-1, p["out"].shape[0])), _with_bias(p)
    group, member = np.divmod(target.ravel(), inner.shape[2])
    order, parts = _sorted_by(group, len(inner))
    tops, rows = top.take(order, 0), np.arange(len(top))
    share = np.empty(len(top), top.dtype)
    share[order] = _softmax(tops @ out)[rows, group[order]] * _inner_shares(tops, inner, parts)[rows, member[order]]
    return np.log(np.maximum(share, 1e-30)).reshape(target.shape)


def gradients(p: Params, x: np.ndarray, real: np.ndarray, target: np.ndarray, valid: np.ndarray) -> Params:
    """Gradients of the mean cross entropy over the valid targets."""
    h, ask, q, k, v, a, top = _forward(p, x, real)
    width, kind = top.shape[2], top.dtype.type
    group, member = np.divmod(target.ravel(), p["inner_bias"].shape[1])
    order, parts = _sorted_by(group, len(p["inner"]))
    tops, (out, inner) = _with_one(top.reshape(-1, width).take(order, 0)), _with_bias(p)
    rows, weight = np.arange(len(tops)), (valid.ravel()[order] / kind(max(1, valid.sum())))[:, None]
    d = _softmax(tops @ out)
    d[rows, group[order]] -= 1
    d *= weight
    d_out, d_tops = tops.T @ d, d @ p["out"].T
    d = _inner_shares(tops, inner, parts)
    d[rows, member[order]] -= 1
    d *= weight
    d_inner, back = np.zeros_like(inner), np.empty_like(d_tops)
    for g, i, j in parts:
        np.matmul(tops[i:j].T, d[i:j], out=d_inner[g])
        np.matmul(d[i:j], p["inner"][g].T, out=back[i:j])
    d_tops += back
    d_top = np.empty_like(top)
    d_top.reshape(-1, width)[order] = d_tops
    d_a = d_top @ v.transpose(0, 2, 1)
    d_a -= np.einsum("ijk,ijk->ij", d_a, a)[..., None]
    d_a *= a
    d_s = d_a / kind(width**0.5)
    d_q, d_k, d_v = d_s @ k, d_s.transpose(0, 2, 1) @ q, a.transpose(0, 2, 1) @ d_top
    d_h = d_k @ p["key"].T
    d_h += d_v @ p["value"].T
    d_h[:, -STEP:] += d_top + d_q @ p["query"].T
    if not real.all():
        d_h *= real[..., None]
    seen, classes = x.ravel(), len(p["embed"])
    embed = np.stack([np.bincount(seen, column, classes) for column in d_h.reshape(-1, width).T], 1).astype(kind)
    flat_ask, flat_h = ask.reshape(-1, width), h.reshape(-1, width)
    return {
        "out": d_out[:-1], "bias": d_out[-1], "inner": d_inner[:, :-1], "inner_bias": d_inner[:, -1],
        "embed": embed, "place": d_h.sum(0), "query": flat_ask.T @ d_q.reshape(-1, width),
        "key": flat_h.T @ d_k.reshape(-1, width), "value": flat_h.T @ d_v.reshape(-1, width),
    }


class Adam:
    """All parameters lie in one vector, which is updated in place; params are views of it."""

    def __init__(self, params: Params, rate: float):
        self.vector, self.rate, self.step = flat(params), rate, 0
        self.params, at = {}, 0
        for k in NAMES:
            self.params[k] = self.vector[at : at + params[k].size].reshape(params[k].shape)
            at += params[k].size
        self.m, self.v = np.zeros_like(self.vector), np.zeros_like(self.vector)

    def update(self, grads: Params) -> None:
        self.step += 1
        g = flat(grads)
        squares = 0.01 * g
        squares *= g
        self.v *= 0.99
        self.v += squares
        g *= 0.1
        self.m *= 0.9
        self.m += g
        down = np.sqrt(np.divide(self.v, 1 - 0.99**self.step, out=squares), out=squares)
        down += 1e-8
        up = np.divide(self.m, 1 - 0.9**self.step, out=g)
        up /= down
        up *= self.rate
        self.vector -= up
