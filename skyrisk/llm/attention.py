"""A small causal self-attention language model in numpy.

Tokens have frequency ranks and classes. The network predicts the class of the next token
from a window; within its class a token has its smoothed share of the corpus counts. So the
probabilities of all tokens sum to one, and the softmax is as small as the number of classes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

WINDOW, STRIDE = 32, 16  # tokens seen at once; tokens scored by each window behind the first
WIDTH, HIDDEN, CLASSES, OWN = 16, 16, 32, 1024  # OWN: most frequent tokens with an embedding each


@dataclass
class Vocabulary:
    """Classes and in-class probabilities from token counts. The frequent tokens spread over
    the classes by rank, so that each class has a similar share of the text."""

    counts: np.ndarray
    place: np.ndarray = field(init=False)  # embedding row of each token
    of: np.ndarray = field(init=False)  # class of each token
    log_share: np.ndarray = field(init=False)  # log10 of the token's share of its class

    def __post_init__(self) -> None:
        n = len(self.counts)
        weight = self.counts + 0.1
        order = np.lexsort((np.arange(n), -weight))
        mass = np.cumsum(weight[order]) / weight.sum()
        self.of, self.place = np.zeros(n, np.int32), np.zeros(n, np.int32)
        # Frequent tokens fill classes of equal mass; every class gets a token at least.
        self.of[order] = np.minimum((mass - weight[order] / weight.sum()) * CLASSES, CLASSES - 1).astype(np.int32)
        for c in np.setdiff1d(np.arange(CLASSES), self.of[order]):
            self.of[order[-1 - c]] = c
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        self.place[:] = np.where(rank < OWN, rank, OWN + self.of)
        total = np.bincount(self.of, weight, CLASSES)
        self.log_share = np.log10(weight / total[self.of])


Parameters = dict[str, np.ndarray]


def initial(seed: int = 9) -> Parameters:
    rng = np.random.default_rng(seed)
    shape = {"tokens": (OWN + CLASSES + 1, WIDTH), "places": (WINDOW, WIDTH), "qkv": (WIDTH, 3 * WIDTH), "out": (WIDTH, WIDTH),
             "up": (WIDTH, HIDDEN), "down": (HIDDEN, WIDTH), "classes": (WIDTH, CLASSES), "bias": (CLASSES,)}
    return {k: (rng.standard_normal(s) * (0.1 if k in ("tokens", "places") else 0.0 if k == "bias" else s[0] ** -0.5)).astype(np.float32) for k, s in shape.items()}


_LATER = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)  # hides what comes later
_CELLS = np.arange((OWN + CLASSES + 1) * WIDTH).reshape(-1, WIDTH)  # where the numbers of an embedding lie


def _exponentials(a: np.ndarray) -> None:
    """In place, along the last axis, up to a factor; small values need no shift."""
    if a.max() > 60:
        a -= a.max(-1, keepdims=True)
    np.exp(a, out=a)


def _scaled(p: Parameters) -> np.ndarray:
    """The weights of queries, keys and values, with the scale of the attention in those of the queries."""
    w = p["qkv"].copy()
    w[:, :WIDTH] *= w.dtype.type(WIDTH**-0.5)
    return w


def forward(p: Parameters, rows: np.ndarray, first: int = 0) -> tuple[np.ndarray, tuple]:
    """Class logits behind every position, from the `first` on, of windows of embedding rows."""
    n, t = rows.shape
    x = p["tokens"].take(rows, axis=0)
    x += p["places"][:t]
    qkv = x @ _scaled(p)
    q, k = qkv[:, first:, :WIDTH], qkv[:, :, WIDTH : 2 * WIDTH]
    v = np.ones((n, t, WIDTH + 1), x.dtype)  # the last column sums the weights
    v[:, :, :WIDTH] = qkv[:, :, 2 * WIDTH :]
    a = np.matmul(q, np.ascontiguousarray(k.transpose(0, 2, 1)))
    a += _LATER[first:t, :t]
    _exponentials(a)  # weights up to a factor for each position
    mixed = np.matmul(a, v)
    inverse = 1 / mixed[:, :, WIDTH:]
    mixed = mixed[:, :, :WIDTH] * inverse
    h = mixed @ p["out"]
    h += x[:, first:]
    r = h @ p["up"]
    np.maximum(r, np.zeros_like(r), out=r)
    z = r @ p["down"]
    z += h
    logits = z @ p["classes"]
    logits += p["bias"]
    return logits, (x, q, k, v, a, inverse, mixed, h, r, z)


def _outer(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a' b over all positions, some windows at a time: products so small stay on the task's own core."""
    n, t, _ = a.shape
    some = next(k for k in (8, 4, 2, 1) if n % k == 0)
    a, b = a.reshape(n // some, some * t, -1), b.reshape(n // some, some * t, -1)
    products = np.matmul(a.transpose(0, 2, 1), b)
    return (np.ones(len(products), a.dtype) @ products.reshape(len(products), -1)).reshape(products.shape[1:])


def _gradients(p: Parameters, rows: np.ndarray, goal: np.ndarray, known: np.ndarray) -> tuple[float, Parameters]:
    """In the numbers of `p`; one array of a wider type would make all that follows as wide."""
    logits, (x, q, k, v, a, inverse, mixed, h, r, z) = forward(p, rows)
    n, t = rows.shape
    kind = x.dtype.type
    back = {name: np.ascontiguousarray(w.T) for name, w in (*((name, p[name]) for name in ("classes", "down", "up", "out")), ("qkv", _scaled(p)))}
    d = logits
    if max(d.max(), -d.min()) > 60:
        d -= d.max(2, keepdims=True)
    np.exp(d, out=d)
    flat, place = d.reshape(-1), np.arange(0, d.size, CLASSES) + goal.reshape(-1)
    total = d.reshape(-1, CLASSES) @ np.ones(CLASSES, kind)
    share = (known.reshape(-1) / max(known.sum(), 1)).astype(kind)
    loss = -(np.log(flat.take(place) / total + kind(1e-20)) * share).sum()
    d *= (share / total).reshape(n, t, 1)
    flat[place] -= share
    g = {"classes": _outer(z, d), "bias": np.ones(n * t, kind) @ d.reshape(-1, CLASSES)}
    dz = d @ back["classes"]
    g["down"] = _outer(r, dz)
    du = dz @ back["down"]
    du *= r > 0
    g["up"] = _outer(h, du)
    dh = du @ back["up"]
    dh += dz
    g["out"] = _outer(mixed, dh)
    dm = dh @ back["out"]
    dm *= inverse
    less = np.empty((n, t, WIDTH + 1), kind)
    less[:, :, :WIDTH] = dm
    np.einsum("ntw,ntw->nt", dm, mixed, out=less[:, :, WIDTH])  # the mean of each row by its weights
    v[:, :, WIDTH] = -1
    ds = np.matmul(less, np.ascontiguousarray(v.transpose(0, 2, 1)))
    ds *= a
    dqkv = np.empty((n, t, 3 * WIDTH), kind)
    dqkv[:, :, :WIDTH] = np.matmul(ds, k)
    dqkv[:, :, WIDTH : 2 * WIDTH] = np.matmul(ds.transpose(0, 2, 1), q)
    dqkv[:, :, 2 * WIDTH :] = np.matmul(a.transpose(0, 2, 1), dm)
    g["qkv"] = _outer(x, dqkv)
    g["qkv"][:, :WIDTH] *= kind(WIDTH**-0.5)
    dx = dqkv @ back["qkv"]
    dx += dh
    g["places"] = np.zeros_like(p["places"])
    g["places"][:t] = dx.sum(0)
    cell = _CELLS.take(rows, axis=0)
    g["tokens"] = np.bincount(cell.reshape(-1), dx.reshape(-1), p["tokens"].size).astype(kind).reshape(p["tokens"].shape)
    return float(loss), g


class Fit:
    """Adam on windows: embedding rows, class to come and whether it counts."""

    def __init__(self, p: Parameters, rate: float = 4e-3) -> None:
        self.all = np.concatenate([v.ravel() for v in p.values()])  # all numbers; those of `p` lie in it
        ends = np.cumsum([v.size for v in p.values()])
        self.p = {k: part.reshape(v.shape) for (k, v), part in zip(p.items(), np.split(self.all, ends[:-1]), strict=True)}
        self.m, self.s, self.step = (np.zeros_like(self.all) for _ in range(3))
        self.rate, self.steps, self.rng = rate, 0, np.random.default_rng(3)

    def over(self, rows: np.ndarray, goal: np.ndarray, known: np.ndarray, batch: int = 64) -> None:
        """One pass over the windows."""
        order, m, s, step = self.rng.permutation(len(rows)), self.m, self.s, self.step
        for at in range(0, len(order), batch):
            b = order[at : at + batch]
            _, parts = _gradients(self.p, rows[b], goal[b], known[b])
            g = np.concatenate([parts[k].ravel() for k in self.p])
            self.steps += 1
            m *= 0.9
            m += np.multiply(g, 0.1, out=step)
            s *= 0.99
            np.multiply(g, g, out=step)
            step *= 0.01
            s += step
            np.multiply(s, 1 / (1 - 0.99**self.steps), out=step)
            np.sqrt(step, out=step)
            step += 1e-8
            np.divide(m, step, out=step)
            step *= self.rate / (1 - 0.9**self.steps)
            self.all -= step


def vector(p: Parameters) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)]).astype(np.float64)


def parameters(v: np.ndarray) -> Parameters:
    """From the numbers of `vector`."""
    p, at = initial(), 0
    for k in sorted(p):
        p[k], at = v[at : at + p[k].size].reshape(p[k].shape).astype(np.float32), at + p[k].size
    return p


def examples(vocabulary: Vocabulary, flat: np.ndarray, lengths: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Training windows one behind another, in which each token of the texts is predicted once."""
    offset = np.cumsum(lengths) - lengths
    row, goal = _behind(vocabulary, flat)
    n = -(-lengths // WINDOW)
    text = np.repeat(np.arange(len(lengths)), n)
    begin = (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * WINDOW
    inside = begin[:, None] + np.arange(WINDOW)
    place = offset[text, None] + inside
    rows = row[place]
    rows[begin == 0, 0] = vocabulary.place[start]
    return rows, goal[place], inside < lengths[text, None]


def _behind(vocabulary: Vocabulary, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The embedding row before each token, and the token's class, with room for a window."""
    row = np.full(len(flat) + WINDOW + 1, OWN + CLASSES, np.int32)
    row[1 : len(flat) + 1] = vocabulary.place[flat]
    goal = np.zeros(len(flat) + WINDOW, np.int32)
    goal[: len(flat)] = vocabulary.of[flat]
    return row, goal


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, and first scored position of the windows that score each token once."""
    n = 1 + np.maximum(0, -(-(lengths - WINDOW) // STRIDE))
    text = np.repeat(np.arange(len(lengths)), n)
    number = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    # Window i > 0 starts at i * STRIDE and scores what the one before did not reach.
    return text, number * STRIDE, np.where(number > 0, number * STRIDE + WINDOW - STRIDE, 0)


def log_probabilities(p: Parameters, vocabulary: Vocabulary, flat: np.ndarray, lengths: np.ndarray, start: int, batch: int = 128) -> np.ndarray:
    """log10 probability of each text; `flat` has the tokens of all texts in order, each
    predicted from those before it, the first from the `start` token."""
    offset = np.cumsum(lengths) - lengths
    row, goal = _behind(vocabulary, flat)
    out = np.bincount(np.repeat(np.arange(len(lengths)), lengths), vocabulary.log_share[flat], len(lengths))
    text, begin, scored = windows(lengths)
    ones = np.ones(CLASSES, np.float32)
    # What a text begins with is scored from its first position on; of later windows the first part only gives context.
    for first, group in ((0, np.flatnonzero(begin == 0)), (WINDOW - STRIDE, np.flatnonzero(begin > 0))):
        step = np.arange(first, WINDOW)
        for at in range(0, len(group), batch):
            w = group[at : at + batch]
            rows = row[(offset[text[w]] + begin[w])[:, None] + np.arange(WINDOW)]  # the token before each place
            if not first:
                rows[:, 0] = vocabulary.place[start]
            logits = forward(p, rows, first)[0].reshape(-1, CLASSES)
            _exponentials(logits)
            inside = begin[w, None] + step
            chosen = logits.reshape(-1).take(np.arange(0, logits.size, CLASSES) + goal[offset[text[w], None] + inside].reshape(-1))
            chosen /= logits @ ones
            chosen = np.log(np.maximum(chosen, np.float32(1e-30))).reshape(inside.shape)
            chosen *= (inside >= scored[w, None]) & (inside < lengths[text[w], None])
            out += np.bincount(text[w], (chosen @ ones[: len(step)]) / np.log(10), len(lengths))
    return out
