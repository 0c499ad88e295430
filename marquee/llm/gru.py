"""A gated recurrent language model in numpy with an output factored into classes.

The probability of a word is that of its class times that of the word in its class, so a step costs two short softmaxes.
Training is truncated back-propagation through windows of a stream; the state goes on from window to window, and a
document's end clears it. Scoring carries the state through the whole of a document.
"""

from __future__ import annotations

import numpy as np

#: Sizes: words (the first is a document's end, the second any rare word), embedding, state, words in a class.
WORDS, EMBED, STATE, CLASS = 1024, 24, 32, 32
#: Tokens in a window of back-propagation, and streams trained side by side.
WINDOW, LANES = 32, 96
RATE = 6e-3

END, RARE = 0, 1


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class Gru:
    def __init__(self, counts: np.ndarray, seed: int = 1):
        """`counts`: of the words in training; the model starts as their plain frequencies."""
        rng = np.random.default_rng(seed)
        n = len(counts)
        self.words, self.classes = n, n // CLASS
        assert n % CLASS == 0
        p = (counts + 1.0) / (counts + 1.0).sum()
        by_class = p.reshape(self.classes, CLASS)
        near = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
        self.p = {
            "embed": rng.normal(0, 0.3, (n, EMBED)),
            "wx": near(EMBED, 3 * STATE),
            "bx": np.zeros(3 * STATE),
            "u": near(STATE, 3 * STATE),
            "wc": near(STATE, self.classes) * 0.1,
            "bc": np.log(by_class.sum(1)),
            "wo": rng.normal(0, 0.02, (n, STATE)),
            "bo": np.log(by_class / by_class.sum(1, keepdims=True)).reshape(-1),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def vector(self) -> np.ndarray:
        return np.concatenate([v.reshape(-1) for v in self.p.values()])

    def load(self, vector: np.ndarray) -> Gru:
        at = 0
        for k, v in self.p.items():
            self.p[k] = vector[at : at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size
        return self

    def run(self, inputs: np.ndarray, h: np.ndarray, keep: bool = False):
        """States after each input (steps x lanes); an end clears the state before it is read."""
        p, steps = self.p, len(inputs)
        a = (p["embed"] @ p["wx"] + p["bx"])[inputs]  # once for each word, not for each token
        live = (inputs != END).astype(np.float32)[:, :, None]
        states = np.empty((steps, len(h), STATE), np.float32)
        trail = []
        for t in range(steps):
            h = h * live[t]
            hu = h @ p["u"]
            gates = _sigmoid(a[t, :, : 2 * STATE] + hu[:, : 2 * STATE])
            z, r = gates[:, :STATE], gates[:, STATE:]
            n = np.tanh(a[t, :, 2 * STATE :] + r * hu[:, 2 * STATE :])
            new = n + z * (h - n)
            if keep:
                trail.append((h, z, r, n, hu[:, 2 * STATE :]))
            h = states[t] = new
        return states, h, (live, trail)

    def _softmax(self, logits):
        logits = logits - logits.max(1, keepdims=True)
        e = np.exp(logits)
        s = e.sum(1, keepdims=True)
        return logits, e, s

    def output(self, states: np.ndarray, targets: np.ndarray, gradient: bool = False):
        """Natural log-probability of each target; with `gradient` also that of the mean loss by states and weights."""
        p, n = self.p, len(targets)
        kind = targets // CLASS
        rows = np.arange(n)
        logits, e, s = self._softmax(states @ p["wc"] + p["bc"])
        log = logits[rows, kind] - np.log(s[:, 0])
        order = np.argsort(kind, kind="stable")
        edges = np.searchsorted(kind[order], np.arange(self.classes + 1))
        if gradient:
            d = e / s
            d[rows, kind] -= 1
            d /= n
            g = {"wc": states.T @ d, "bc": d.sum(0), "wo": np.zeros_like(p["wo"]), "bo": np.zeros_like(p["bo"])}
            dh = d @ p["wc"].T
        for c in np.flatnonzero(np.diff(edges)):
            own = order[edges[c] : edges[c + 1]]
            part = slice(c * CLASS, (c + 1) * CLASS)
            h, w = states[own], p["wo"][part]
            logits, e, s = self._softmax(h @ w.T + p["bo"][part])
            k, at = np.arange(len(own)), targets[own] - c * CLASS
            log[own] += logits[k, at] - np.log(s[:, 0])
            if gradient:
                d = e / s
                d[k, at] -= 1
                d /= n
                g["wo"][part], g["bo"][part] = d.T @ h, d.sum(0)
                dh[own] += d @ w
        return (log, dh, g) if gradient else log

    def gradients(self, inputs: np.ndarray, targets: np.ndarray, h: np.ndarray):
        """(gradients of the mean loss over a window, state after it)."""
        p = self.p
        states, last, (live, trail) = self.run(inputs, h, keep=True)
        steps, lanes, _ = states.shape
        _, dh, g = self.output(states.reshape(-1, STATE), targets.reshape(-1), gradient=True)
        dh = dh.reshape(steps, lanes, STATE)
        da = np.empty((steps, lanes, 3 * STATE), np.float32)
        dhu = np.empty_like(da)
        back = np.zeros((lanes, STATE), np.float32)
        for t in range(steps - 1, -1, -1):
            before, z, r, n, hun = trail[t]
            d = dh[t] + back
            dn = d * (1 - z) * (1 - n * n)
            da[t, :, :STATE] = d * (before - n) * z * (1 - z)
            da[t, :, STATE : 2 * STATE] = dn * hun * r * (1 - r)
            da[t, :, 2 * STATE :] = dn
            dhu[t] = da[t]
            dhu[t, :, 2 * STATE :] = dn * r
            back = (d * z + dhu[t] @ p["u"].T) * live[t]
        flat = da.reshape(-1, 3 * STATE)
        before = np.stack([step[0] for step in trail]).reshape(-1, STATE)
        g["u"] = before.T @ dhu.reshape(-1, 3 * STATE)
        g["bx"] = flat.sum(0)
        order = np.argsort(inputs.reshape(-1), kind="stable")
        ids = inputs.reshape(-1)[order]
        first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        by_word, ids = np.add.reduceat(flat[order], first), ids[first]  # summed before the products, again once for each word
        g["wx"] = p["embed"][ids].T @ by_word
        g["embed"] = np.zeros_like(p["embed"])
        g["embed"][ids] = by_word @ p["wx"].T
        return g, last


class Trainer:
    """Adam over windows of a token stream, fed piece by piece."""

    def __init__(self, model: Gru, rate: float = RATE):
        self.model, self.rate, self.step = model, rate, 0
        self.first = {k: np.zeros_like(v) for k, v in model.p.items()}
        self.second = {k: np.zeros_like(v) for k, v in model.p.items()}
        self.rest = np.empty(0, np.int64)
        self.tokens = 0

    def feed(self, stream: np.ndarray, final: bool = False) -> None:
        """Train on a stream of documents, each closed by an end; what does not fill a window waits for more."""
        stream = np.concatenate([self.rest, stream])
        lanes = LANES if len(stream) >= LANES * WINDOW else max(1, len(stream) // WINDOW)
        length = len(stream) // lanes
        if not final and length < WINDOW:
            self.rest = stream
            return
        use = lanes * length
        self.rest = stream[use:]
        if not use:
            return
        targets = stream[:use].reshape(lanes, length).T
        inputs = np.append(END, stream[: use - 1]).reshape(lanes, length).T
        h = np.zeros((lanes, STATE), np.float32)
        for t in range(0, length, WINDOW):
            y = np.ascontiguousarray(targets[t : t + WINDOW])
            g, h = self.model.gradients(np.ascontiguousarray(inputs[t : t + WINDOW]), y, h)
            self.tokens += y.size
            self._update(g)

    def _update(self, g) -> None:
        self.step += 1
        norm = float(np.sqrt(sum(float((v * v).sum()) for v in g.values())))
        scale = min(1.0, 1.0 / max(norm, 1e-9))
        rate = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for k, v in g.items():
            v = v * np.float32(scale)
            self.first[k] += 0.1 * (v - self.first[k])
            self.second[k] += 0.001 * (v * v - self.second[k])
            self.model.p[k] -= np.float32(rate) * self.first[k] / (np.sqrt(self.second[k]) + 1e-7)


def score(model: Gru, documents: list[np.ndarray]) -> np.ndarray:
    """Natural log-probability of each document (ids, the last an end), the state carried through all of it."""
    out = np.zeros(len(documents))
    if not documents:
        return out
    sizes = np.array([len(d) for d in documents])
    total = int(sizes.sum())
    lanes = int(np.clip(total // max(int(sizes.max()), 256), 1, 256))
    load, plan = [(0, k) for k in range(lanes)], [[] for _ in range(lanes)]
    from heapq import heapreplace

    for i in np.argsort(-sizes, kind="stable").tolist():
        n, k = load[0]
        plan[k].append(i)
        heapreplace(load, (n + int(sizes[i]), k))
    length = max(n for n, _ in load)
    targets = np.zeros((lanes, length), np.int64)
    owner = np.full((lanes, length), len(documents))
    for k, own in enumerate(plan):
        if own:
            ids = np.concatenate([documents[i] for i in own])
            targets[k, : len(ids)] = ids
            owner[k, : len(ids)] = np.repeat(own, sizes[own])
    inputs = np.zeros_like(targets)
    inputs[:, 1:] = targets[:, :-1]
    h = np.zeros((lanes, STATE), np.float32)
    sums = np.zeros(len(documents) + 1)
    for t in range(0, length, 64):
        states, h, _ = model.run(np.ascontiguousarray(inputs[:, t : t + 64].T), h)
        own = owner[:, t : t + 64].T.reshape(-1)
        there = own < len(documents)
        log = model.output(states.reshape(-1, STATE)[there], targets[:, t : t + 64].T.reshape(-1)[there])
        sums += np.bincount(own[there], log, len(documents) + 1)
    return sums[:-1]
