"""A character-level bidirectional LSTM with CRF transitions in numpy: training by Adam, decoding by Viterbi.

All windows have one length; shorter texts are padded with class 0. Input weights and embedding are one table, so a
step is a row lookup and one small matrix product for a whole batch of windows.
"""

from __future__ import annotations

import numpy as np

OTHER_SPACE, OTHER_LETTER, OTHER, CLASSES = 96, 97, 98, 99


def classes_of(text: str) -> np.ndarray:
    """Character classes: printable ASCII each its own, then white space, letters, the rest."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ascii_ = (points >= 32) & (points < 127)
    out = np.where(points >= 128, OTHER_LETTER, OTHER).astype(np.int16)
    out[(points >= 9) & (points <= 13)] = OTHER_SPACE
    return np.where(ascii_, points.astype(np.int64) - 31, out).astype(np.int16)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    def __init__(self, kinds: int, hidden: int = 16, seed: int = 7):
        rng, h, k = np.random.default_rng(seed), hidden, 1 + 2 * kinds
        f = lambda *s, scale=0.2: rng.normal(0, scale, s).astype(np.float32)
        self.h, self.k = h, k
        self.p = {"xf": f(CLASSES, 4 * h), "uf": f(h, 4 * h), "xb": f(CLASSES, 4 * h), "ub": f(h, 4 * h),
                  "w": f(2 * h, k), "b": np.zeros(k, np.float32), "t": f(k, k, scale=0.1), "s": np.zeros(k, np.float32)}
        for name in ("xf", "xb"):
            self.p[name][:, h: 2 * h] += 1.0  # forget gates start open
        # Tags: 0 outside, 1 + 2 kind begins, 2 + 2 kind continues; a continuation needs its own kind before it.
        self.barred = np.zeros((k, k), np.float32)
        for to in range(2, k, 2):
            self.barred[:, to] = -1e4
            self.barred[[to - 1, to], to] = 0
        self.barred_start = np.array([0] + [0, -1e4] * kinds, np.float32)

    def _run(self, x: np.ndarray, way: str, cache: list | None) -> np.ndarray:
        h, (n, steps) = self.h, x.shape
        table, u = self.p["x" + way], self.p["u" + way]
        state, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        out = np.empty((steps, n, h), np.float32)
        for t in (range(steps) if way == "f" else range(steps - 1, -1, -1)):
            a = table[x[:, t]] + state @ u
            i, fg, o, g = _sigmoid(a[:, :h]), _sigmoid(a[:, h: 2 * h]), _sigmoid(a[:, 2 * h: 3 * h]), np.tanh(a[:, 3 * h:])
            before, cell = cell, fg * cell + i * g
            tc = np.tanh(cell)
            if cache is not None:
                cache.append((t, i, fg, o, g, before, tc, state))
            state = o * tc
            out[t] = state
        return out

    def _back(self, x, way, cache, dout, grad):
        h, n = self.h, x.shape[0]
        u, dstate, dcell = self.p["u" + way], np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        pre = np.empty((x.shape[1], n, 4 * h), np.float32)
        for t, i, fg, o, g, before, tc, prev in reversed(cache):
            ds = dout[t] + dstate
            dcell = dcell + ds * o * (1 - tc * tc)
            d = np.concatenate([dcell * g * i * (1 - i), dcell * before * fg * (1 - fg), ds * tc * o * (1 - o),
                                dcell * i * (1 - g * g)], 1)
            grad["u" + way] += prev.T @ d
            dstate, dcell = d @ u.T, dcell * fg
            pre[t] = d
        hot = np.zeros((x.size, CLASSES), np.float32)
        hot[np.arange(x.size), x.T.ravel()] = 1
        grad["x" + way] += hot.T @ pre.reshape(-1, 4 * h)

    def emissions(self, x: np.ndarray, caches=None) -> np.ndarray:
        """(steps, windows, tags)"""
        both = np.concatenate([self._run(x, w, None if caches is None else caches[w]) for w in "fb"], 2)
        if caches is not None:
            caches["both"] = both
        return both @ self.p["w"] + self.p["b"]

    def step(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of the tags y (windows, steps) and its gradients."""
        grad, caches = {k: np.zeros_like(v) for k, v in self.p.items()}, {"f": [], "b": []}
        e = self.emissions(x, caches)
        steps, n, _ = e.shape
        trans, start = self.p["t"] + self.barred, self.p["s"] + self.barred_start
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = start + e[0]
        for t in range(1, steps):
            alpha[t] = _logsum(alpha[t - 1][:, :, None] + trans, 1) + e[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = _logsum(trans + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        z = _logsum(alpha[-1], 1)
        yt, rows = y.T, np.arange(n)
        gold = start[yt[0]] + e[0][rows, yt[0]]
        de = np.exp(alpha + beta - z[None, :, None])
        grad["s"] += de[0].sum(0) - np.bincount(yt[0], minlength=self.k)
        for t in range(1, steps):
            gold = gold + trans[yt[t - 1], yt[t]] + e[t][rows, yt[t]]
            pair = np.exp(alpha[t - 1][:, :, None] + trans + (e[t] + beta[t] - z[:, None])[:, None, :])
            grad["t"] += pair.sum(0)
            np.add.at(grad["t"], (yt[t - 1], yt[t]), -1)
        np.put_along_axis(de, yt[:, :, None], np.take_along_axis(de, yt[:, :, None], 2) - 1, 2)
        flat, both = de.reshape(-1, self.k), caches["both"]
        grad["w"] += both.reshape(-1, 2 * self.h).T @ flat
        grad["b"] += flat.sum(0)
        dboth = de @ self.p["w"].T
        self._back(x, "f", caches["f"], dboth[:, :, : self.h], grad)
        self._back(x, "b", caches["b"], dboth[:, :, self.h:], grad)
        return float((z - gold).mean()), {k: v / n for k, v in grad.items()}

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = 240, batch: int = 64, rate: float = 0.02) -> list[float]:
        rng = np.random.default_rng(11)
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        losses = []
        for i in range(1, steps + 1):
            rows = rng.integers(0, len(x), batch)
            loss, grad = self.step(x[rows], y[rows])
            losses.append(loss)
            lr = rate * (1 - i / (steps + 1))
            for k, g in grad.items():
                g = np.clip(g, -5, 5)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.p[k] -= (lr * (m[k] / (1 - 0.9**i)) / (np.sqrt(v[k] / (1 - 0.99**i)) + 1e-8)).astype(np.float32)
        return losses

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best tag path of every window (windows, steps)."""
        e = self.emissions(x)
        trans = self.p["t"] + self.barred
        best, back = self.p["s"] + self.barred_start + e[0], []
        for t in range(1, len(e)):
            all_ = best[:, :, None] + trans
            back.append(all_.argmax(1))
            best = all_.max(1) + e[t]
        path = np.empty(x.shape, np.int8)
        path[:, -1] = best.argmax(1)
        for t in range(len(e) - 2, -1, -1):
            path[:, t] = back[t][np.arange(len(x)), path[:, t + 1]]
        return path


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis)) + top.squeeze(axis)
