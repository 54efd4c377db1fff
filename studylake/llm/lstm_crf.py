"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Batches are windows of equal length. Everything is vectorised over the batch;
the only loops run over the window's characters.
"""

from __future__ import annotations

import numpy as np

Params = dict[str, np.ndarray]
HIDDEN = 16
#: Character classes: printable ASCII one by one, then white space, other letters, the rest, padding.
N_CHARS = 95 + 4
SPACE, LETTER, OTHER, PAD = 95, 96, 97, 98


def encode(text: str) -> np.ndarray:
    """Character classes of a text, one per code point."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    out = np.where((code >= 0xAA) & (code < 0x2000), LETTER, OTHER)
    ascii_ = (code > 32) & (code < 127)
    out[ascii_] = code[ascii_] - 32
    out[(code == 32) | ((code >= 9) & (code <= 13)) | (code == 0xA0)] = SPACE
    return out


def init(n_labels: int, seed: int) -> Params:
    rng = np.random.default_rng(seed)
    p: Params = {}
    for d in ("f", "b"):
        p["x" + d] = rng.normal(0, 0.2, (N_CHARS, 4 * HIDDEN))
        p["h" + d] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
        p["c" + d] = np.zeros(4 * HIDDEN)
        p["c" + d][HIDDEN:2 * HIDDEN] = 1.0  # the forget gate starts open
    p["out"] = rng.normal(0, 0.2, (2 * HIDDEN, n_labels))
    p["bias"] = np.zeros(n_labels)
    p["move"] = np.zeros((n_labels, n_labels))
    return p


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))


def _run(p: Params, d: str, x: np.ndarray, keep: list | None) -> np.ndarray:
    """Hidden states (batch, length, HIDDEN) of one direction over x in reading order."""
    n, length = x.shape
    h, c = np.zeros((n, HIDDEN), p["out"].dtype), np.zeros((n, HIDDEN), p["out"].dtype)
    out = np.empty((n, length, HIDDEN), p["out"].dtype)
    wx, wh = p["x" + d] + p["c" + d], p["h" + d]
    for t in range(length):
        z = wx[x[:, t]] + h @ wh
        s = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:]
        g = np.tanh(z[:, 3 * HIDDEN:])
        before_h, before_c = h, c
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        out[:, t] = h
        if keep is not None:
            keep.append((i, f, o, g, tc, before_h, before_c))
    return out


def emissions(p: Params, x: np.ndarray) -> np.ndarray:
    """Label scores (batch, length, labels) from both directions."""
    forward = _run(p, "f", x, None)
    backward = _run(p, "b", x[:, ::-1], None)[:, ::-1]
    return np.concatenate([forward, backward], 2) @ p["out"] + p["bias"]


def _lse(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis)) + np.squeeze(top, axis)


def marginals(e: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward log scores, log normaliser and label probabilities."""
    n, length, k = e.shape
    a, b = np.empty_like(e), np.zeros_like(e)
    a[:, 0] = e[:, 0]
    for t in range(1, length):
        a[:, t] = _lse(a[:, t - 1][:, :, None] + move[None], 1) + e[:, t]
    for t in range(length - 2, -1, -1):
        b[:, t] = _lse(move[None] + (e[:, t + 1] + b[:, t + 1])[:, None, :], 2)
    z = _lse(a[:, -1], 1)
    return a, b, z, np.exp(a + b - z[:, None, None])


def posteriors(e: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Label probabilities of sequences of any length: forward and backward
    scores are normalised at each step, so they stay small."""
    length = e.shape[1]
    a, b = np.empty_like(e), np.zeros_like(e)
    a[:, 0] = e[:, 0] - _lse(e[:, 0], 1)[:, None]
    for t in range(1, length):
        step = _lse(a[:, t - 1][:, :, None] + move[None], 1) + e[:, t]
        a[:, t] = step - _lse(step, 1)[:, None]
    for t in range(length - 2, -1, -1):
        step = _lse(move[None] + (e[:, t + 1] + b[:, t + 1])[:, None, :], 2)
        b[:, t] = step - _lse(step, 1)[:, None]
    both = a + b
    return np.exp(both - _lse(both, 2)[:, :, None])


def viterbi(e: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best label paths (batch, length)."""
    n, length, k = e.shape
    back = np.empty((n, length, k), np.int8)
    best = e[:, 0]
    for t in range(1, length):
        cand = best[:, :, None] + move[None]
        back[:, t] = cand.argmax(1)
        best = cand.max(1) + e[:, t]
        best = best - best.max(1, keepdims=True)  # scores of long sequences stay small
    path = np.empty((n, length), np.int64)
    path[:, -1] = best.argmax(1)
    rows = np.arange(n)
    for t in range(length - 1, 0, -1):
        path[:, t - 1] = back[rows, t, path[:, t]]
    return path


def gradients(p: Params, x: np.ndarray, y: np.ndarray) -> tuple[float, Params]:
    """Mean negative log-likelihood of label windows and its gradients."""
    n, length = x.shape
    k = p["bias"].shape[0]
    kept: dict[str, list] = {"f": [], "b": []}
    hf = _run(p, "f", x, kept["f"])
    hb = _run(p, "b", x[:, ::-1], kept["b"])
    both = np.concatenate([hf, hb[:, ::-1]], 2)
    e = both @ p["out"] + p["bias"]
    a, b, z, prob = marginals(e, p["move"])
    rows, cols = np.arange(n)[:, None], np.arange(length)[None]
    gold = e[rows, cols, y].sum(1) + p["move"][y[:, :-1], y[:, 1:]].sum(1)
    loss = float((z - gold).mean())
    de = prob
    de[rows, cols, y] -= 1
    de /= n
    move = np.zeros((k, k))
    for t in range(1, length):
        pair = a[:, t - 1][:, :, None] + p["move"][None] + (e[:, t] + b[:, t])[:, None, :] - z[:, None, None]
        move += np.exp(pair).sum(0)
    np.add.at(move, (y[:, :-1], y[:, 1:]), -1)
    g: Params = {"move": move / n, "out": np.einsum("nlh,nlk->hk", both, de), "bias": de.sum((0, 1))}
    dh = de @ p["out"].T
    for d, grad, xs in (("f", dh[:, :, :HIDDEN], x), ("b", dh[:, ::-1, HIDDEN:], x[:, ::-1])):
        wh = p["h" + d]
        gx, gh = np.zeros_like(p["x" + d]), np.zeros_like(wh)
        next_h, next_c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        for t in range(length - 1, -1, -1):
            i, f, o, c_in, tc, before_h, before_c = kept[d][t]
            dht = grad[:, t] + next_h
            dc = dht * o * (1 - tc * tc) + next_c
            dz = np.concatenate([dc * c_in * i * (1 - i), dc * before_c * f * (1 - f),
                                 dht * tc * o * (1 - o), dc * i * (1 - c_in * c_in)], 1)
            next_h, next_c = dz @ wh.T, dc * f
            gh += before_h.T @ dz
            np.add.at(gx, xs[:, t], dz)
        g["x" + d], g["h" + d], g["c" + d] = gx, gh, gx.sum(0)
    return loss, g


def train(x: np.ndarray, y: np.ndarray, n_labels: int, epochs: int, batch: int = 32, rate: float = 0.03, seed: int = 5) -> Params:
    """Fit by Adam; the same windows give the same parameters."""
    p = init(n_labels, seed)
    rng = np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            _, g = gradients(p, x[pick], y[pick])
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            step += 1
            for k, v in g.items():
                v = v * min(1.0, 5.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * v
                s[k] = 0.999 * s[k] + 0.001 * v * v
                p[k] = p[k] - rate * 0.85**epoch * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return p
