"""A gated recurrent language model over token ids, in numpy, for one task.

The output is factored: a softmax over classes, then one over the words of the
class.  Ids below ``n_words`` are words; classes of words are runs of ids in
order of frequency with about equal mass.  Ids from ``n_words`` on are groups
of rarer words; each is a class of its own, whose inner chances the caller
knows.  Training cuts a stream of documents into parallel streams and
backpropagates through windows of ``WINDOW`` tokens; the state is carried from
window to window and is zero where a document begins.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np

WINDOW = 32
STREAMS = 128
MIN_STREAMS = 8
#: Windows that a task's share is cut into before it gets more parallel streams.
UPDATES = 128
CHUNK = 1 << 20
_SCORED_AT_ONCE = 64
_EPS = 1e-6


def class_starts(counts: np.ndarray, n_classes: int) -> np.ndarray:
    """First ids of the classes, and the number of words: runs of ids with about equal mass, one word at least."""
    mass = np.cumsum(counts, dtype=np.float64)
    cuts = np.searchsorted(mass, mass[-1] * np.arange(1, n_classes) / n_classes, side="right") if len(counts) else np.zeros(0, int)
    return np.unique(np.concatenate([[0], cuts, [len(counts)]])).astype(np.int64)


class GatedModel:
    """Parameters, training and scoring; every parameter is a float32 array, and so is its sum of squared gradients."""

    def __init__(self, starts: np.ndarray, n_groups: int, end: int, hidden: int, rate: float):
        self.starts, self.n_groups, self.end, self.hidden, self.rate = starts, n_groups, end, hidden, rate
        self.n_words, self.n_word_classes = int(starts[-1]), len(starts) - 1
        n_in, n_classes = self.n_words + n_groups, self.n_word_classes + n_groups
        self.class_of = np.concatenate([np.repeat(np.arange(self.n_word_classes), np.diff(starts)), self.n_word_classes + np.arange(n_groups)])
        self.shapes = {"input": (n_in, 3 * hidden), "recur": (hidden, 3 * hidden), "gate_bias": (3 * hidden,), "classes": (hidden, n_classes),
                       "class_bias": (n_classes,), "words": (self.n_words, hidden), "word_bias": (self.n_words,)}
        self.parameters: dict[str, np.ndarray] = {}
        self.squares: dict[str, np.ndarray] = {}

    def start(self, counts: np.ndarray, seed: int = 1) -> GatedModel:
        """Small random weights; the biases give each word its share of ``counts`` (one per id)."""
        rng = np.random.default_rng(seed)
        for name, shape in self.shapes.items():
            scale = 0.0 if "bias" in name else 0.1 if name == "input" else 1 / np.sqrt(self.hidden)
            self.parameters[name] = (rng.normal(size=shape) * scale).astype(np.float32)
            self.squares[name] = np.full(shape, 1e-3, dtype=np.float32)
        share = np.maximum(counts.astype(np.float64), 0.5)
        self.parameters["words"] *= 0.1
        self.parameters["classes"] *= 0.1
        self.parameters["word_bias"][:] = np.log(share[:self.n_words])
        mass = np.bincount(self.class_of, weights=share)
        self.parameters["class_bias"][:] = np.log(mass / mass.sum())
        return self

    def packed(self) -> np.ndarray:
        """All parameters and squares as one array."""
        return np.concatenate([d[name].ravel() for d in (self.parameters, self.squares) for name in self.shapes])

    def unpack(self, flat: np.ndarray) -> GatedModel:
        at = 0
        for d in (self.parameters, self.squares):
            for name, shape in self.shapes.items():
                size = int(np.prod(shape))
                d[name] = flat[at:at + size].reshape(shape).astype(np.float32)
                at += size
        return self

    def _step(self, name: str, gradient: np.ndarray, rows: slice | np.ndarray = slice(None)) -> None:
        """One Adagrad step for some rows of a parameter."""
        squares = self.squares[name][rows] + gradient * gradient
        self.squares[name][rows] = squares
        self.parameters[name][rows] -= self.rate * gradient / (np.sqrt(squares) + np.float32(_EPS))

    def _for_gates(self) -> tuple[np.ndarray, np.ndarray]:
        """What each id pushes into the gates and the candidate, and the recurrent weights turned, as ``_gates`` takes them.

        A gate at x is (1 + tanh(x / 2)) / 2; the halves are taken here.
        """
        pushed, recur = self.parameters["input"] + self.parameters["gate_bias"], self.parameters["recur"].T.copy()
        pushed[:, :2 * self.hidden] *= 0.5
        recur[:2 * self.hidden] *= 0.5
        return pushed, recur

    def _gates(self, before: np.ndarray, pushed: np.ndarray, recur: np.ndarray, own: np.ndarray, gates: np.ndarray, candidate: np.ndarray, after: np.ndarray) -> None:
        """Fill the state's share, both gates, the candidate and the new state; a column is a stream, so each part is one run of memory."""
        h = self.hidden
        np.matmul(recur, before, out=own)
        np.add(pushed[:2 * h], own[:2 * h], out=gates)
        np.tanh(gates, out=gates)
        gates += 1.0
        gates *= 0.5
        np.multiply(gates[h:], own[2 * h:], out=candidate)
        candidate += pushed[2 * h:]
        np.tanh(candidate, out=candidate)
        np.subtract(before, candidate, out=after)
        after *= gates[:h]
        after += candidate

    @staticmethod
    def _softmax(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(chances, log of the sum of exponentials), by column; ``logits`` are overwritten."""
        top = logits.max(axis=0)
        logits -= top
        np.exp(logits, out=logits)
        total = logits.sum(axis=0)
        logits /= total
        return logits, top + np.log(total)

    def _by_class(self, targets: np.ndarray) -> tuple[np.ndarray, list[tuple[slice, int, int]]]:
        """(order by class, [(places in that order, first word, end of the words)]) for the word classes of several words among the targets."""
        classes = self.class_of[targets].astype(np.int16)
        order = np.argsort(classes, kind="stable")
        edges = np.searchsorted(classes[order], np.arange(self.n_word_classes + 1))
        some = [c for c in np.flatnonzero(np.diff(edges)) if self.starts[c + 1] - self.starts[c] > 1]
        return order, [(slice(int(edges[c]), int(edges[c + 1])), int(self.starts[c]), int(self.starts[c + 1])) for c in some]

    def _train_outputs(self, states: np.ndarray, targets: np.ndarray, scale: np.float32) -> np.ndarray:
        """Update the output layers; the gradient of the states."""
        p = self.parameters
        chances, _ = self._softmax(p["classes"].T @ states.T + p["class_bias"][:, None])
        chances[self.class_of[targets], np.arange(len(targets))] -= 1.0
        chances *= scale
        back = chances.T @ p["classes"].T
        self._step("classes", states.T @ chances.T)
        self._step("class_bias", chances.sum(axis=1))
        order, runs = self._by_class(targets)
        ordered, wanted, inner_back = states[order], targets[order], np.zeros_like(states)
        for at, lo, hi in runs:
            some = ordered[at]
            inner, _ = self._softmax(p["words"][lo:hi] @ some.T + p["word_bias"][lo:hi, None])
            inner[wanted[at] - lo, np.arange(len(some))] -= 1.0
            inner *= scale
            np.matmul(inner.T, p["words"][lo:hi], out=inner_back[at])
            self._step("words", inner @ some, slice(lo, hi))
            self._step("word_bias", inner.sum(axis=1), slice(lo, hi))
        back[order] += inner_back
        return back

    def _train_window(self, inputs: np.ndarray, targets: np.ndarray, valid: np.ndarray | None, state: np.ndarray) -> np.ndarray:
        """Learn from one window (steps x streams); the state after it."""
        steps, streams = inputs.shape
        h, p, state = self.hidden, self.parameters, state.T
        table, recur = self._for_gates()
        pushed = np.ascontiguousarray(table[inputs].transpose(0, 2, 1))
        begins = inputs == self.end
        resets = begins.any(axis=1)
        own, gates = np.empty((steps, 3 * h, streams), np.float32), np.empty((steps, 2 * h, streams), np.float32)
        before, candidate, after = (np.empty((steps, h, streams), np.float32) for _ in range(3))
        for t in range(steps):
            before[t] = np.where(begins[t], np.float32(0), state) if resets[t] else state
            self._gates(before[t], pushed[t], recur, own[t], gates[t], candidate[t], after[t])
            state = after[t]
        flat, wanted = np.ascontiguousarray(after.transpose(0, 2, 1)).reshape(-1, h), targets.reshape(-1)
        scale = np.float32(1 / streams)
        if valid is None:
            back = self._train_outputs(flat, wanted, scale)
        else:
            at = np.flatnonzero(valid.reshape(-1))
            back = np.zeros_like(flat)
            back[at] = self._train_outputs(flat[at], wanted[at], scale)
        back = np.ascontiguousarray(back.reshape(steps, streams, h).transpose(0, 2, 1))
        pull = np.empty((steps, 3 * h, streams), np.float32)
        slope = np.zeros((h, streams), np.float32)
        keep = gates * (1 - gates)
        keep[:, :h] *= before - candidate
        keep[:, h:] *= own[:, 2 * h:]
        flow = (1 - gates[:, :h]) * (1 - candidate * candidate)
        for t in range(steps - 1, -1, -1):
            slope += back[t]
            np.multiply(slope, keep[t, :h], out=pull[t, :h])
            moved = np.multiply(slope, flow[t], out=pull[t, 2 * h:])
            np.multiply(moved, keep[t, h:], out=pull[t, h:2 * h])
            # From here on ``own`` has the slopes of the state's share.
            own[t, :2 * h] = pull[t, :2 * h]
            np.multiply(moved, gates[t, h:], out=own[t, 2 * h:])
            slope *= gates[t, :h]
            slope += p["recur"] @ own[t]
            if resets[t]:
                slope[:, begins[t]] = 0
        np.clip(pull, -1, 1, out=pull)
        self._step("recur", np.matmul(before, own.transpose(0, 2, 1)).sum(axis=0))
        self._step("gate_bias", pull.sum(axis=(0, 2)))
        ids = inputs.reshape(-1)
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        pull = np.ascontiguousarray(pull.transpose(0, 2, 1)).reshape(-1, 3 * h)
        self._step("input", np.add.reduceat(pull[order], first, axis=0), ids[first])
        return state.T

    def train(self, documents: Iterator[np.ndarray]) -> int:
        """Learn from documents, each an array of ids that ends with ``end``; the number of tokens."""
        held, size, total = [], 0, 0
        for ids in documents:
            held.append(ids)
            size += len(ids)
            if size >= CHUNK:
                total += self._train_chunk(np.concatenate(held))
                held, size = [], 0
        return total + (self._train_chunk(np.concatenate(held)) if size else 0)

    def _train_chunk(self, ids: np.ndarray) -> int:
        n = len(ids)
        streams = int(np.clip(n // (WINDOW * UPDATES), MIN_STREAMS, STREAMS))
        length = -(-n // streams)
        fill = streams * length - n
        targets = np.concatenate([ids, np.full(fill, self.end, ids.dtype)])
        inputs = np.concatenate([[self.end], targets[:-1]]).reshape(streams, length).T
        valid = (np.arange(len(targets)) < n).reshape(streams, length).T if fill else None
        targets = targets.reshape(streams, length).T.astype(np.int64)
        inputs = np.ascontiguousarray(inputs)
        state = np.zeros((streams, self.hidden), np.float32)
        for t in range(0, length, WINDOW):
            window = slice(t, t + WINDOW)
            state = self._train_window(inputs[window], targets[window], None if valid is None or valid[window].all() else valid[window], state)
        return n

    def log_chances(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural logarithm of each target's chance after its state; of its class only for a group of rarer words."""
        p = self.parameters
        logits = p["classes"].T @ states.T + p["class_bias"][:, None]
        found = logits[self.class_of[targets], np.arange(len(targets))]
        found = found.astype(np.float64) - self._softmax(logits)[1]
        order, runs = self._by_class(targets)
        ordered, wanted = states[order], targets[order]
        for at, lo, hi in runs:
            inner = p["words"][lo:hi] @ ordered[at].T + p["word_bias"][lo:hi, None]
            own = inner[wanted[at] - lo, np.arange(inner.shape[1])]
            found[order[at]] += own.astype(np.float64) - self._softmax(inner)[1]
        return found

    def score(self, documents: Sequence[np.ndarray], streams: int = 2 * STREAMS) -> np.ndarray:
        """The sum of ``log_chances`` over each whole document.

        Documents are dealt to parallel streams, longest first; a stream
        carries its state over all windows of a document and drops out when it
        has no more documents.
        """
        sizes = np.array([len(d) for d in documents], dtype=np.int64)
        streams = max(1, min(streams, len(documents)))
        heap, parts = [(0, s) for s in range(streams)], [[] for _ in range(streams)]
        for k in np.argsort(-sizes, kind="stable"):
            filled, s = heap[0]
            parts[s].append(int(k))
            heapq.heapreplace(heap, (filled + int(sizes[k]), s))
        lengths = np.array([int(sizes[p].sum()) if p else 0 for p in parts])
        rank = np.argsort(-lengths, kind="stable")
        lengths, parts = lengths[rank], [parts[s] for s in rank]
        out = np.zeros(len(documents))
        steps = int(lengths[0]) if streams else 0
        tokens = np.full((streams, steps), self.end, dtype=np.int64)
        for s, part in enumerate(parts):
            if part:
                tokens[s, :lengths[s]] = np.concatenate([documents[k] for k in part])
        chances = np.zeros((streams, steps))
        h = self.hidden
        state, last = np.zeros((h, streams), np.float32), np.full(streams, self.end)
        table, recur = self._for_gates()
        for t in range(0, steps, _SCORED_AT_ONCE):
            stop = min(steps, t + _SCORED_AT_ONCE)
            active = int(np.searchsorted(-lengths, -t))
            inside = np.concatenate([last[:active, None], tokens[:active, t:stop]], axis=1).T
            pushed = np.ascontiguousarray(table[inside[:-1]].transpose(0, 2, 1))
            begins = inside[:-1] == self.end
            resets = begins.any(axis=1)
            states = np.empty((stop - t, h, active), np.float32)
            own, gates, candidate = (np.empty((n * h, active), np.float32) for n in (3, 2, 1))
            now = np.ascontiguousarray(state[:, :active])
            for k in range(stop - t):
                before = np.where(begins[k], np.float32(0), now) if resets[k] else now
                now = states[k]
                self._gates(before, pushed[k], recur, own, gates, candidate, now)
            found = self.log_chances(np.ascontiguousarray(states.transpose(0, 2, 1)).reshape(-1, h), inside[1:].reshape(-1))
            chances[:active, t:stop] = found.reshape(stop - t, active).T
            state, last = now, inside[-1]
        for s, part in enumerate(parts):
            if part:
                edges = np.concatenate([[0], np.cumsum(sizes[part])[:-1]])
                out[part] = np.add.reduceat(chances[s, :lengths[s]], edges)
        return out
