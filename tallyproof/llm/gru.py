"""A gated recurrent language model in numpy with a class-factored softmax.

Words are numbered by class: word w is in class w // CLASS_SIZE, and P(word) = P(class) * P(word | class), so a token
costs one softmax over classes and one over a class. Input weights are kept as one row of gate inputs per word.
"""

from __future__ import annotations

import heapq

import numpy as np

HIDDEN, CLASS_SIZE, WINDOW = 16, 32, 20
Params = dict[str, np.ndarray]


def shapes(words: int) -> dict[str, tuple[int, ...]]:
    """Shapes of the parameters for ``words`` words (a multiple of CLASS_SIZE)."""
    classes = words // CLASS_SIZE
    return {
        "inputs": (words + 1, 3 * HIDDEN),  # the last row: before the first word of a document
        "state": (HIDDEN, 3 * HIDDEN),
        "class_w": (HIDDEN, classes),
        "class_b": (classes,),
        "word_w": (classes, HIDDEN, CLASS_SIZE),
        "word_b": (classes, CLASS_SIZE),
    }


def initial(counts: np.ndarray, seed: int = 5) -> Params:
    """Small random weights, and biases under which every word has its share of ``counts``."""
    rng = np.random.default_rng(seed)
    p = {n: (rng.normal(0, 0.1, s)).astype(np.float32) for n, s in shapes(len(counts)).items()}
    p["state"] = np.concatenate([np.linalg.qr(rng.normal(size=(HIDDEN, HIDDEN)))[0] for _ in range(3)], 1).astype(np.float32)
    by_class = (counts + 1e-3).reshape(-1, CLASS_SIZE)
    p["class_b"] = np.log(by_class.sum(1) / by_class.sum()).astype(np.float32)
    p["word_b"] = np.log(by_class / by_class.sum(1, keepdims=True)).astype(np.float32)
    return p


def flat(p: Params) -> np.ndarray:
    return np.concatenate([p[n].ravel() for n in sorted(p)])


def shaped(values: np.ndarray, words: int) -> Params:
    out, at = {}, 0
    for n, s in sorted(shapes(words).items()):
        size = int(np.prod(s))
        out[n] = values[at : at + size].reshape(s).astype(np.float32)
        at += size
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)
    return x


def run(p: Params, before: np.ndarray, h: np.ndarray, keep: bool = False) -> tuple[np.ndarray, np.ndarray, list]:
    """States after each step of ``before`` (steps x lanes: the word before, or the number of words at a document's
    start, where the state starts anew), the last state, and (``keep``) what the way back needs."""
    steps, lanes = before.shape
    gates = p["inputs"][before]
    fresh = before == len(p["inputs"]) - 1
    states, kept = np.empty((steps, lanes, HIDDEN), np.float32), []
    u = p["state"]
    for t in range(steps):
        if fresh[t].any():
            h = np.where(fresh[t][:, None], np.float32(0), h)
        a = h @ u
        zr = _sigmoid(gates[t, :, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = a[:, 2 * HIDDEN :]
        n = np.tanh(gates[t, :, 2 * HIDDEN :] + r * c)
        if keep:
            kept.append((h, z, r, c, n))
        h = n + z * (h - n)
        states[t] = h
    return states, h, kept


def _exp(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp of rows of logits and its row sums. ``x`` is shifted by its largest value, one for all rows: states lie in (-1, 1), so
    rows don't differ by what a float holds. A product sums short rows faster than a reduction."""
    x -= x.max(initial=-np.inf)
    e = np.exp(x)
    return e, np.maximum(e @ np.ones(e.shape[1], e.dtype), np.float32(1e-37))


def output(p: Params, states: np.ndarray, words: np.ndarray, grads: Params | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log probability of each word given its state; with ``grads`` also the loss's gradient by states (and by weights, added)."""
    klass = words // CLASS_SIZE
    x = states @ p["class_w"] + p["class_b"]
    e, total = _exp(x)
    at = np.arange(len(words))
    logs = x[at, klass] - np.log(total)
    back = None
    if grads is not None:
        d = e / total[:, None]
        d[at, klass] -= 1
        back = d @ p["class_w"].T
        grads["class_w"] += states.T @ d
        grads["class_b"] += d.sum(0)
    order = np.argsort(klass.astype(np.uint16), kind="stable")
    cuts = np.searchsorted(klass[order], np.arange(len(p["class_b"]) + 1))
    sorted_states, place = states[order], words[order] % CLASS_SIZE
    for k in range(len(cuts) - 1):
        i, j = cuts[k], cuts[k + 1]
        if i == j:
            continue
        h, w = sorted_states[i:j], place[i:j]
        x = h @ p["word_w"][k] + p["word_b"][k]
        e, total = _exp(x)
        rows = np.arange(j - i)
        logs[order[i:j]] += x[rows, w] - np.log(total)
        if grads is not None:
            d = e / total[:, None]
            d[rows, w] -= 1
            back[order[i:j]] += d @ p["word_w"][k].T
            grads["word_w"][k] += h.T @ d
            grads["word_b"][k] += d.sum(0)
    return logs, back


def gradients(p: Params, before: np.ndarray, words: np.ndarray, h: np.ndarray) -> tuple[Params, np.ndarray, float]:
    """Gradients of one window, truncated at its start; the state to carry on; the mean loss."""
    steps, lanes = before.shape
    grads = {n: np.zeros_like(v) for n, v in p.items()}
    states, last, kept = run(p, before, h, keep=True)
    logs, back = output(p, states.reshape(-1, HIDDEN), words.ravel(), grads)
    back = back.reshape(steps, lanes, HIDDEN)
    fresh = before == len(p["inputs"]) - 1
    dgates = np.empty((steps, lanes, 3 * HIDDEN), np.float32)
    dh, ut = np.zeros((lanes, HIDDEN), np.float32), p["state"].T.copy()
    das, hs = np.empty_like(dgates), np.empty((steps, lanes, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        h, z, r, c, n = kept[t]
        dh = dh + back[t]
        dn = dh * (1 - z) * (1 - n * n)
        dgates[t, :, :HIDDEN] = dh * (h - n) * z * (1 - z)
        dgates[t, :, HIDDEN : 2 * HIDDEN] = dn * c * r * (1 - r)
        dgates[t, :, 2 * HIDDEN :] = dn
        das[t] = dgates[t]
        das[t, :, 2 * HIDDEN :] *= r
        hs[t] = h
        dh = dh * z + das[t] @ ut
        if fresh[t].any():
            dh[fresh[t]] = 0
    grads["state"] += hs.reshape(-1, HIDDEN).T @ das.reshape(-1, 3 * HIDDEN)
    ids = before.ravel()
    order = np.argsort(ids.astype(np.uint16), kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.diff(ids, prepend=-1))
    grads["inputs"][ids[first]] = np.add.reduceat(dgates.reshape(-1, 3 * HIDDEN)[order], first)
    for g in grads.values():
        g /= steps * lanes
    return grads, last, float(-logs.mean())


class Adam:
    def __init__(self, p: Params):
        self.first, self.second, self.step = {n: np.zeros_like(v) for n, v in p.items()}, {n: np.zeros_like(v) for n, v in p.items()}, 0

    def update(self, p: Params, grads: Params, rate: float) -> None:
        self.step += 1
        a, b = 1 - 0.9**self.step, 1 - 0.99**self.step
        for n, g in grads.items():
            self.first[n] += 0.1 * (g - self.first[n])
            self.second[n] += 0.01 * (g * g - self.second[n])
            p[n] -= (rate / a) * self.first[n] / (np.sqrt(self.second[n] / b) + 1e-6)


def train(p: Params, words: np.ndarray, starts: np.ndarray, adam: Adam, rate: float, lanes: int = 512) -> float:
    """One pass over ``words`` (documents one after another; ``starts``: True at their first words) in windows of truncated
    backpropagation. State is carried from window to window. All words are used: what doesn't fill all lanes is a window of fewer lanes."""
    before = np.where(starts, len(p["inputs"]) - 1, np.concatenate([[0], words[:-1]]))
    loss, weight, at = 0.0, 0, 0
    while at < len(words):
        rest = len(words) - at
        width = max(1, min(lanes, rest // WINDOW))
        length = rest // width
        length -= length % WINDOW if length >= WINDOW else 0
        own = [x[at : at + width * length].reshape(width, length).T for x in (before, words)]
        at += width * length
        h = np.zeros((width, HIDDEN), np.float32)
        for t in range(0, length, WINDOW):
            b, w = (x[t : t + WINDOW] for x in own)
            grads, h, x = gradients(p, b, w, h)
            adam.update(p, grads, rate * min(1.0, b.size / 2000))
            loss, weight = loss + x * b.size, weight + b.size
    return loss / max(weight, 1)


def log_likelihoods(p: Params, words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Natural log probability of each word of documents of ``sizes`` words (1 at least), state carried through all of a document.

    Documents are dealt to lanes, the longest first to the emptiest lane; lanes run side by side.
    """
    begins = np.cumsum(sizes) - sizes
    before = np.concatenate([[0], words[:-1]])
    before[begins] = len(p["inputs"]) - 1
    lanes = int(np.clip(len(words) // max(1, sizes.max(initial=1)), 32, 512))
    loads = [(0, k) for k in range(min(lanes, len(sizes)))]
    members: list[list[int]] = [[] for _ in loads]
    for i in np.argsort(-sizes, kind="stable").tolist():
        load, k = heapq.heappop(loads)
        members[k].append(i)
        heapq.heappush(loads, (load + int(sizes[i]), k))
    places = [np.concatenate([np.arange(begins[i], begins[i] + sizes[i]) for i in m]) for m in members]
    longest = max(map(len, places), default=0)
    grid = np.full((longest, len(places)), -1, np.int64)
    for k, x in enumerate(places):
        grid[: len(x), k] = x
    out = np.zeros(len(words))
    h = np.zeros((len(places), HIDDEN), np.float32)
    step = max(1, 20_000 // max(1, len(places)))
    for t in range(0, longest, step):
        part = grid[t : t + step]
        some = part >= 0
        live = int(some.any(0).sum())  # lanes end one by one
        if live < some.shape[1]:
            open_ = np.flatnonzero(some.any(0))
            part, some, h, grid = part[:, open_], some[:, open_], h[open_], grid[:, open_]
        states, h, _ = run(p, np.where(some, before[part], 0), h)
        at = part[some]
        out[at] = output(p, states[some], words[at])[0]
    return out
