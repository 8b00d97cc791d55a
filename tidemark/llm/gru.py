"""A gated recurrent network over word ids in numpy, with a class-factored output.

The chance of the next id is the chance of its class times its chance within the class. Classes follow
frequency, so that frequent ids lie in small classes. Documents run side by side in lanes, window after
window; the state goes on from window to window and starts anew with each document. Learning cuts
gradients at the window's start (truncated backpropagation through time).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np


FAR = 60.0  # e to its power, and a row's worth of that, fit 32-bit numbers
BLOCK = 2048  # rows whose class logits are made at once: they stay in the processor's cache


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def class_bounds(counts: np.ndarray, classes: int) -> np.ndarray:
    """counts: of ids, falling. Bounds of runs of ids with about equal sums of the counts' roots."""
    roots = np.cumsum(np.sqrt(counts + 1.0))
    cuts = np.searchsorted(roots, roots[-1] * np.arange(1, classes) / classes) + 1 if len(counts) else []
    return np.unique(np.concatenate([[0], cuts, [len(counts)]])).astype(np.int64)


@dataclass
class Weights:
    """All float32. into: a row of gate inputs for each id and, last, for the start of a document."""

    into: np.ndarray  # ids + 1, 3 * hidden
    again: np.ndarray  # hidden, 3 * hidden
    to_class: np.ndarray  # hidden, classes
    class_bias: np.ndarray
    to_word: np.ndarray  # ids, hidden
    word_bias: np.ndarray
    bounds: np.ndarray  # of the classes' ids; not learned

    def __post_init__(self) -> None:
        self.class_of = np.repeat(np.arange(len(self.bounds) - 1, dtype=np.int16), np.diff(self.bounds))

    @classmethod
    def start(cls, counts: np.ndarray, singles: int, classes: int, hidden: int, seed: int = 3) -> Weights:
        """counts: of all ids; the last `singles` ids are classes of their own. Starts from frequencies."""
        rng = np.random.default_rng(seed)
        n = len(counts)
        bounds = np.concatenate([class_bounds(counts[: n - singles], classes), np.arange(n - singles + 1, n + 1)])
        bounds = np.unique(bounds)
        total = counts + 0.5
        by_class = np.add.reduceat(total, bounds[:-1])
        sizes = np.diff(bounds)
        return cls(
            rng.normal(0, 0.3, (n + 1, 3 * hidden)).astype(np.float32),
            rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32),
            np.zeros((hidden, len(sizes)), np.float32),
            np.log(by_class / by_class.sum()).astype(np.float32),
            np.zeros((n, hidden), np.float32),
            np.log(total / np.repeat(by_class, sizes)).astype(np.float32),
            bounds,
        )

    def learned(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self) if f.name != "bounds"]

    def pack(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.learned()])

    def unpack(self, flat: np.ndarray) -> Weights:
        out, at = [], 0
        for w in self.learned():
            out.append(flat[at : at + w.size].reshape(w.shape).astype(np.float32))
            at += w.size
        return Weights(*out, self.bounds)


class Lanes:
    """Documents dealt out to lanes that run side by side; longer lanes come first. The ids of a lane lie
    in a row, and a window looks up its own: memory goes with the ids, not with the longest lane."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, lanes: int, start_id: int):
        """ids: of all documents in a row. lengths: ids of each document, 1 or more."""
        lanes = max(1, min(lanes, len(lengths)))
        begins = np.cumsum(lengths) - lengths
        heap = [(0, k) for k in range(lanes)]
        docs: list[list[int]] = [[] for _ in range(lanes)]
        for d in np.argsort(-lengths, kind="stable").tolist():
            total, k = heapq.heappop(heap)
            docs[k].append(d)
            heapq.heappush(heap, (total + int(lengths[d]), k))
        docs.sort(key=lambda lane: -sum(int(lengths[d]) for d in lane))
        self.sizes = np.array([sum(int(lengths[d]) for d in lane) for lane in docs])
        self.begins = np.cumsum(self.sizes) - self.sizes
        order = np.array([d for lane in docs for d in lane], np.int64)
        own = lengths[order]
        self.doc_of = np.repeat(order, own).astype(np.int32)
        heads = np.cumsum(own) - own
        self.target_of = ids[np.arange(len(self.doc_of)) + np.repeat(begins[order] - heads, own)].astype(np.int32)
        self.fresh_of = np.zeros(len(self.doc_of), bool)
        self.fresh_of[heads] = True
        self.input_of = np.full(len(self.doc_of), start_id, np.int32)
        self.input_of[1:] = self.target_of[:-1]
        self.input_of[self.fresh_of] = start_id

    def windows(self, length: int, tokens: int = 0) -> Iterator[Window]:
        """Windows of `length` steps; with `tokens`, longer ones where few lanes go on."""
        t, last = 0, int(self.sizes[0]) if len(self.sizes) else 0
        while t < last:
            n = int((self.sizes > t).sum())
            end = min(t + max(length, tokens // n), last)
            yield Window(self, t, end, n)
            t = end


class Window:
    """Steps t to `end` of the first n lanes: target (-1 behind a lane's end), document, input, fresh."""

    def __init__(self, lanes: Lanes, t: int, end: int, n: int):
        steps = np.arange(t, end)[:, None]
        live = steps < lanes.sizes[:n]
        at = np.where(live, steps + lanes.begins[:n], 0)
        self.steps, self.n, self.live = end - t, n, live
        self.target = np.where(live, lanes.target_of[at], -1)
        self.doc, self.input = lanes.doc_of[at], lanes.input_of[at]
        self.fresh = lanes.fresh_of[at] & live


def run(w: Weights, window: Window, state: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States after each step of a window, a row for each unit, so that each gate's values lie together; `keep`
    gets what going back needs."""
    hidden, n = w.again.shape[0], window.n
    states = np.empty((window.steps, hidden, n), np.float32)
    again = np.ascontiguousarray(w.again.T)
    h = np.ascontiguousarray(state[:, :n])
    for k in range(window.steps):
        fresh = window.fresh[k]
        if fresh.any():
            h = np.where(fresh, np.float32(0), h)
        x = np.ascontiguousarray(w.into[window.input[k]].T)
        a = again @ h
        gates, new = x[: 2 * hidden], x[2 * hidden :]
        gates += a[: 2 * hidden]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        z, r = gates[:hidden], gates[hidden:]
        new += r * a[2 * hidden :]
        np.tanh(new, out=new)
        before = h
        h = states[k]
        np.subtract(before, new, out=h)
        h *= z
        h += new
        if keep is not None:
            keep.append((before, z, r, new, a[2 * hidden :]))
    return states


def _by_step(x: np.ndarray) -> np.ndarray:
    """Values of steps, units and lanes with a row for each step of each lane."""
    return np.ascontiguousarray(x.transpose(0, 2, 1)).reshape(-1, x.shape[1])


def _chances(x: np.ndarray, place: np.ndarray, rows: np.ndarray, near: bool) -> tuple[np.ndarray, np.ndarray]:
    """Log chances of the places of each row of logits, and the rows' sums; `x` is left as what is summed.
    Logits known to be near 0 need no shift. One shift does for all rows, unless some lie so far below others
    that nothing would be left of them."""
    if not near:
        top = x.max()
        x -= top if top - x.min() < FAR else x.max(axis=1, keepdims=True)
    own = x[rows, place]
    np.exp(x, out=x)
    sums = x @ np.ones(x.shape[1], x.dtype)
    return own - np.log(sums), sums


def outcome(w: Weights, h: np.ndarray, target: np.ndarray, slopes: dict | None = None) -> np.ndarray:
    """The log chance of each target after each state. `slopes` gets the loss's slopes, summed."""
    hidden = h.shape[1]
    classes = w.class_of[target]
    rows = np.arange(len(target))
    # The bias is the weight of a last unit that is always 1; the others lie between -1 and 1.
    h = np.concatenate([h, np.ones((len(h), 1), np.float32)], axis=1)
    to_class = np.concatenate([w.to_class, w.class_bias[None]])
    to_word = np.concatenate([w.to_word, w.word_bias[:, None]], axis=1)
    near = float(np.abs(to_class).sum(axis=0).max()) < FAR
    near_words = np.maximum.reduceat(np.abs(to_word).sum(axis=1), w.bounds[:-1]) < FAR
    out = np.empty(len(target))
    if slopes is not None:
        slope_class, slope_word = np.zeros((to_class.shape[1], hidden + 1), np.float32), np.zeros_like(to_word)
        slopes["h"] = np.empty((len(h), hidden), np.float32)
    for first in range(0, len(target), BLOCK):
        part = slice(first, first + BLOCK)
        hc, own = h[part], classes[part]
        p = hc @ to_class
        out[part], sums = _chances(p, own, rows[: len(own)], near)
        if slopes is not None:
            # Rows are divided by their sums where they are narrow.
            p[rows[: len(own)], own] -= sums
            shares = (1 / sums)[:, None]
            slope_class += p.T @ (hc * shares)
            np.multiply(p @ w.to_class.T, shares, out=slopes["h"][part])
    # In order of classes: each class's own rows lie together.
    order = np.argsort(classes, kind="stable")
    at = np.searchsorted(classes[order], np.arange(len(w.bounds)))
    hs, places, inner = h[order], target[order], np.zeros(len(order), np.float32)
    back = np.zeros((len(order), hidden if slopes is not None else 0), np.float32)
    for c in np.flatnonzero(np.diff(at)):
        low, high = w.bounds[c], w.bounds[c + 1]
        if high - low == 1:
            continue
        part = slice(at[c], at[c + 1])
        hc, place = hs[part], places[part] - low
        own = rows[: len(place)]
        p = hc @ to_word[low:high].T
        inner[part], sums = _chances(p, place, own, near_words[c])
        if slopes is not None:
            p[own, place] -= sums
            shares = (1 / sums)[:, None]
            slope_word[low:high] = p.T @ (hc * shares)
            np.multiply(p @ w.to_word[low:high], shares, out=back[part])
    out[order] += inner
    if slopes is not None:
        slopes["h"][order] += back
        slopes["to_class"], slopes["class_bias"] = slope_class[:, :hidden].T, slope_class[:, hidden]
        slopes["to_word"], slopes["word_bias"] = slope_word[:, :hidden], slope_word[:, hidden]
    return out


def score(w: Weights, ids: np.ndarray, lengths: np.ndarray, *, lanes: int = 512, window: int = 24) -> np.ndarray:
    """The natural log chance of each whole document."""
    sums = np.zeros(len(lengths))
    if not len(lengths):
        return sums
    deal = Lanes(ids, lengths, lanes, len(w.into) - 1)
    state = np.zeros((w.again.shape[0], len(deal.sizes)), np.float32)
    for part in deal.windows(window, lanes * window):
        states = run(w, part, state)
        state = states[-1]
        h = _by_step(states)
        target, doc = part.target.ravel(), part.doc.ravel()
        live = part.live.ravel()
        if not live.all():
            target, doc, h = target[live], doc[live], h[live]
        sums += np.bincount(doc, outcome(w, h, target), minlength=len(lengths))
    return sums


class Learner:
    """Adagrad over windows."""

    def __init__(self, w: Weights, rate: float):
        self.w, self.rate = w, rate
        self.sums = [np.full_like(x, 1e-3) for x in w.learned()]

    def _step(self, k: int, weight: np.ndarray, slope: np.ndarray, rows=slice(None)) -> None:
        slope = np.clip(slope, -5, 5)
        self.sums[k][rows] += slope * slope
        weight[rows] -= self.rate * slope / np.sqrt(self.sums[k][rows])

    def learn(self, ids: np.ndarray, lengths: np.ndarray, *, lanes: int = 512, window: int = 32) -> int:
        """Goes through all documents, learning from every window, with the state carried on. Gives how
        many ids were learned from."""
        w, learned = self.w, 0
        if not len(lengths):
            return 0
        deal = Lanes(ids, lengths, lanes, len(w.into) - 1)
        hidden = w.again.shape[0]
        state = np.zeros((hidden, len(deal.sizes)), np.float32)
        for part in deal.windows(window):
            n = part.n
            keep: list = []
            states = run(w, part, state, keep)
            state = states[-1]
            target, live = part.target.ravel(), part.live.ravel()
            slopes: dict = {}
            outcome(w, _by_step(states)[live], target[live], slopes)
            learned += int(live.sum())
            back = np.zeros((len(target), hidden), np.float32)
            back[live] = slopes["h"] / n
            back = np.ascontiguousarray(back.reshape(part.steps, n, hidden).transpose(0, 2, 1))
            into, again, carry = np.empty((part.steps, n, 3 * hidden), np.float32), np.zeros_like(w.again), 0
            pre = np.empty((3 * hidden, n), np.float32)
            d_z, d_r, d_again = pre[:hidden], pre[hidden : 2 * hidden], pre[2 * hidden :]
            for k in range(part.steps - 1, -1, -1):
                before, z, r, new, a = keep[k]
                d = back[k]
                d += carry
                rest = 1 - z
                d_new = 1 - new * new
                d_new *= rest
                d_new *= d
                np.subtract(before, new, out=d_z)
                d_z *= z
                carry = d * z
                rest *= d
                d_z *= rest
                np.multiply(d_new, r, out=d_again)
                np.subtract(1, r, out=d_r)
                d_r *= a
                d_r *= d_again
                into[k, :, : 2 * hidden] = pre[: 2 * hidden].T
                into[k, :, 2 * hidden :] = d_new.T
                again += before @ pre.T
                carry += w.again @ pre
                fresh = part.fresh[k]
                if fresh.any():
                    carry[:, fresh] = 0
            used = part.input.ravel().astype(np.uint16 if len(w.into) <= 1 << 16 else np.int32)
            order = np.argsort(used, kind="stable")
            firsts = np.flatnonzero(np.append(True, np.diff(used[order]) != 0))
            rows = used[order][firsts]
            self._step(0, w.into, np.add.reduceat(into.reshape(-1, 3 * hidden)[order], firsts), rows)
            self._step(1, w.again, again)
            for k, name in enumerate(("to_class", "class_bias", "to_word", "word_bias"), 2):
                self._step(k, getattr(w, name), slopes[name] / n)
        return learned
