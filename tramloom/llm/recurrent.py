"""A bidirectional gated recurrent network with attention pooling, in numpy: forward, backward, Adam."""

from __future__ import annotations

import numpy as np

Params = dict[str, np.ndarray]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def new_params(words: int, grams: int, width: int, hidden: int, attention: int, rng: np.random.Generator) -> Params:
    """Word and character n-gram vectors, two GRUs (gates in the order update, reset, candidate), attention, output."""
    draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    p = {"word": draw(words, width, scale=0.1), "gram": draw(grams, width, scale=0.1)}
    for d in "fb":
        p |= {f"W{d}": draw(2 * width, 3 * hidden, scale=(2 * width) ** -0.5), f"U{d}": draw(hidden, 3 * hidden, scale=hidden**-0.5), f"c{d}": np.zeros(3 * hidden, np.float32)}
    return p | {"A": draw(2 * hidden, attention, scale=(2 * hidden) ** -0.5), "a": np.zeros(attention, np.float32), "v": draw(attention, scale=attention**-0.5), "w": draw(2 * hidden, scale=(2 * hidden) ** -0.5), "o": np.zeros(1, np.float32)}


def gru(x: np.ndarray, mask: np.ndarray, U: np.ndarray, keep: bool = False):
    """States (T, B, H) for projected inputs x (T, B, 3H); where mask (T, B) is 0 the state stays."""
    steps, batch, width = x.shape
    n = width // 3
    h, out, cache = np.zeros((batch, n), np.float32), np.empty((steps, batch, n), np.float32), []
    for t in range(steps):
        u = h @ U
        zr = sigmoid(x[t, :, : 2 * n] + u[:, : 2 * n])
        z, r = zr[:, :n], zr[:, n:]
        c = np.tanh(x[t, :, 2 * n :] + r * u[:, 2 * n :])
        new = h + (1 - z) * mask[t, :, None] * (c - h)
        if keep:
            cache.append((h, z, r, c, u[:, 2 * n :]))
        h = out[t] = new
    return out, cache


def gru_back(dout: np.ndarray, mask: np.ndarray, U: np.ndarray, cache: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the projected inputs and of U."""
    steps, batch, n = dout.shape
    dx, dU, dh = np.zeros((steps, batch, 3 * n), np.float32), np.zeros_like(U), np.zeros((batch, n), np.float32)
    for t in reversed(range(steps)):
        h, z, r, c, uc = cache[t]
        g = dout[t] + dh
        m = mask[t, :, None]
        dc = g * (1 - z) * m * (1 - c * c)
        dz = -g * (c - h) * m * z * (1 - z)
        dr = dc * uc * r * (1 - r)
        du = np.concatenate([dz, dr, dc * r], axis=1)
        dx[t] = np.concatenate([dz, dr, dc], axis=1)
        dU += h.T @ du
        dh = g * (1 - (1 - z) * m) + du @ U.T
    return dx, dU


def forward(p: Params, xf: np.ndarray, xb: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Logits (B,) for inputs projected for both directions (T, B, 3H). A window without words has the bias alone."""
    hf, cf = gru(xf, mask, p["Uf"], keep)
    hb, cb = gru(xb[::-1], mask[::-1], p["Ub"], keep)
    h = np.concatenate([hf, hb[::-1]], axis=2)
    e = np.tanh(h @ p["A"] + p["a"])
    s = np.where(mask > 0, e @ p["v"], -1e9)
    w = np.exp(s - s.max(0)) * mask
    w /= np.maximum(w.sum(0), 1e-9)
    pooled = (w[:, :, None] * h).sum(0)
    return pooled @ p["w"] + p["o"][0], (cf, cb, h, e, w, pooled)


def backward(p: Params, dlogit: np.ndarray, mask: np.ndarray, cache) -> tuple[Params, np.ndarray, np.ndarray]:
    """Gradients of U, A, a, v, w, o and of the projected inputs of both directions."""
    cf, cb, h, e, w, pooled = cache
    n = h.shape[2] // 2
    g = {"w": pooled.T @ dlogit, "o": np.array([dlogit.sum()], np.float32)}
    dpool = dlogit[:, None] * p["w"]
    dh = w[:, :, None] * dpool
    dw = (h * dpool).sum(2)
    ds = w * (dw - (w * dw).sum(0))
    de = ds[:, :, None] * p["v"] * (1 - e * e)
    g |= {"v": np.einsum("tba,tb->a", e, ds), "A": np.einsum("tbh,tba->ha", h, de), "a": de.sum((0, 1))}
    dh += de @ p["A"].T
    dxf, g["Uf"] = gru_back(dh[:, :, :n], mask, p["Uf"], cf)
    dxb, g["Ub"] = gru_back(dh[::-1, :, n:], mask[::-1], p["Ub"], cb)
    return g, dxf, dxb[::-1]


class Adam:
    def __init__(self, p: Params, rate: float = 0.01) -> None:
        self.p, self.rate, self.t = p, rate, 0
        self.m, self.s = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))

    def step(self, g: Params) -> None:
        self.t += 1
        for k, x in g.items():
            self.m[k] += 0.1 * (x - self.m[k])
            self.s[k] += 0.001 * (x * x - self.s[k])
            self.p[k] -= (self.rate * self.m[k] / (1 - 0.9**self.t) / (np.sqrt(self.s[k] / (1 - 0.999**self.t)) + 1e-8)).astype(np.float32)
