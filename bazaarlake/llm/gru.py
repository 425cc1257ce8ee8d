"""A gated recurrent language model in numpy with a class-factored softmax.

A symbol is a class and, in the first classes, a word of it. The network gives
the class's probability by one softmax and the word's by another over its class.
Training runs over windows of a few steps and truncates the gradient there; the
state is carried from window to window, in training and in scoring, and starts
at zero with each document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WINDOW = 16  # steps of a gradient
LONG = 64  # steps that are scored at once
ROWS = 2048  # states whose classes are scored at once, so that they stay in the cache
SAFE = 60.0  # logits of at most this size are exponentiated as they are
Parameters = dict[str, np.ndarray]


def start(symbols: int, hidden: int, class_bias: np.ndarray, word_bias: np.ndarray) -> Parameters:
    """Small random weights; the biases make the untrained model the unigram model."""
    rng = np.random.default_rng(3)

    def small(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) * 0.1).astype(np.float32)

    return {
        "in": small(symbols, 3 * hidden),  # input weights, folded into the embedding
        "rec": small(hidden, 3 * hidden),
        "cw": np.zeros((hidden, len(class_bias)), np.float32),
        "cb": class_bias.astype(np.float32),
        "ww": np.zeros((len(word_bias), hidden), np.float32),
        "wb": word_bias.astype(np.float32),
    }


def lanes(lengths: np.ndarray, most: int) -> list[np.ndarray]:
    """Documents dealt to at most ``most`` lanes of like length, longest lane first."""
    n = max(1, min(most, len(lengths)))
    order = np.argsort(-lengths, kind="stable")
    loads = np.zeros(n, np.int64)
    out: list[list[int]] = [[] for _ in range(n)]
    for doc in order.tolist():
        lane = int(loads.argmin())
        out[lane].append(doc)
        loads[lane] += lengths[doc]
    return [np.array(out[i]) for i in np.argsort(-loads, kind="stable")]


def windows(docs: list[np.ndarray], most: int, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(inputs, targets, document) per window, each steps x lanes; -1 past a lane's end.

    The input of a document's first symbol is -1: state and input are zero there.
    """
    lengths = np.array([len(d) for d in docs])
    dealt = lanes(lengths, most)
    steps = int(max(sum(lengths[d]) for d in dealt))
    steps += -steps % width
    target = np.full((len(dealt), steps), -1, np.int32)
    given, owner = target.copy(), target.copy()
    for lane, mine in enumerate(dealt):
        at = 0
        for doc in mine.tolist():
            n = lengths[doc]
            target[lane, at : at + n] = docs[doc]
            given[lane, at + 1 : at + n] = docs[doc][:-1]
            owner[lane, at : at + n] = doc
            at += n
    for at in range(0, steps, width):
        live = int((target[:, at] >= 0).sum())  # lanes get shorter from first to last
        part = slice(at, at + width)
        yield given[:live, part].T, target[:live, part].T, owner[:live, part].T


class Network:
    def __init__(self, parameters: Parameters, classes: np.ndarray, words: np.ndarray):
        """``classes``: class of each symbol; ``words``: first word of each class with
        words, and the end. Symbols 0.. are the words in order of their classes."""
        self.p = parameters
        self.classes, self.words = classes, words
        self.hidden = len(parameters["rec"])

    def _forward(self, h: np.ndarray, given: np.ndarray):
        """States after each step; (state before, z, r, candidate's recurrent part,
        candidate, whether the document begins) of all steps for the gradient.

        Lanes lie along the last axis, so that every gate is one block of memory."""
        p, n = self.p, self.hidden
        steps, lanes_ = given.shape
        fresh = given < 0
        begins = fresh.any(axis=1).tolist()
        x = p["in"][given]
        x[fresh] = 0
        x = np.ascontiguousarray(x.transpose(0, 2, 1))
        gates, new, rec = x[:, : 2 * n], x[:, 2 * n :], np.ascontiguousarray(p["rec"].T)
        before = np.empty((steps, n, lanes_), np.float32)
        inner, out = np.empty_like(before), np.empty_like(before)
        g, move = np.empty((3 * n, lanes_), np.float32), np.empty((n, lanes_), np.float32)
        for t in range(steps):
            state, gate, fill = before[t], gates[t], new[t]
            state[:] = h
            if begins[t]:
                state[:, fresh[t]] = 0
            np.dot(rec, state, out=g)
            gate += g[: 2 * n]
            np.negative(gate, out=gate)
            np.exp(gate, out=gate)
            gate += 1
            np.reciprocal(gate, out=gate)
            inner[t] = g[2 * n :]
            np.multiply(gate[n:], inner[t], out=move)
            fill += move
            np.tanh(fill, out=fill)
            np.subtract(state, fill, out=move)
            move *= gate[:n]
            np.add(fill, move, out=out[t])
            h = out[t]
        return out, (before, gates[:, :n], gates[:, n:], inner, new, fresh)

    @staticmethod
    def _safe(weights: np.ndarray, bias: np.ndarray) -> bool:
        """Whether no logit can be large: states lie between -1 and 1."""
        if not bias.size:
            return True
        return float(np.abs(weights).sum(axis=0).max() + np.abs(bias).max()) <= SAFE

    @staticmethod
    def _sums(logits: np.ndarray, safe: bool) -> np.ndarray:
        """Exponentiates ``logits`` in place, less their largest unless ``safe``."""
        if not safe:
            logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        return logits @ np.ones(logits.shape[1], np.float32)

    def _class_logits(self, rows: np.ndarray) -> np.ndarray:
        logits = rows @ self.p["cw"]
        logits += self.p["cb"]
        return logits

    def _word_logits(self, rows: np.ndarray, first: int, end: int) -> np.ndarray:
        logits = rows @ self.p["ww"][first:end].T
        logits += self.p["wb"][first:end]
        return logits

    def _logs(self, logits: np.ndarray, goal: np.ndarray, safe: bool) -> np.ndarray:
        """Log-probability of each row's goal."""
        if not safe:
            logits -= logits.max(axis=1, keepdims=True)
        mine = logits[np.arange(len(goal)), goal]
        return mine - np.log(self._sums(logits, True).astype(np.float64))

    def _ordered(self, goal: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """(order by class, classes in it, places where the classes with words begin, and the end)."""
        kinds = self.classes[goal]
        if len(self.words) < 2**15:
            kinds = kinds.astype(np.int16)
        order = np.argsort(kinds, kind="stable")
        kinds = kinds[order]
        return order, kinds, np.searchsorted(kinds, np.arange(len(self.words))).tolist()

    def score(self, docs: list[np.ndarray], most: int) -> np.ndarray:
        """Natural log-probability of each document's symbols."""
        total = np.zeros(len(docs))
        h = np.zeros((self.hidden, min(most, max(len(docs), 1))), np.float32)
        p, cuts = self.p, self.words.tolist()
        safe_class, safe_word = self._safe(p["cw"], p["cb"]), self._safe(p["ww"].T, p["wb"])
        for given, target, owner in windows(docs, most, LONG) if docs else ():
            states, _ = self._forward(h[:, : given.shape[1]], given)
            h = states[-1]
            mask = target >= 0
            order, kinds, at = self._ordered(target[mask])
            rows, goal = states.transpose(0, 2, 1)[mask][order], target[mask][order]
            logs = np.empty(len(goal))
            for a in range(0, len(goal), ROWS):
                part = slice(a, a + ROWS)
                logs[part] = self._logs(self._class_logits(rows[part]), kinds[part], safe_class)
            for first, end, a, b in zip(cuts, cuts[1:], at, at[1:]):
                if b > a:
                    logits = self._word_logits(rows[a:b], first, end)
                    logs[a:b] += self._logs(logits, goal[a:b] - first, safe_word)
            total += np.bincount(owner[mask][order], logs, len(docs))
        return total

    def _word_errors(
        self,
        rows: np.ndarray,
        goal: np.ndarray,
        kinds: np.ndarray,
        at: list[int],
        scale: np.float32,
        back: np.ndarray,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of "ww" and "wb"; adds the states' to ``back``.

        Rows lie in the order of their classes and end in a one. The logits of all
        classes lie in one block of memory, so that most is done at once.
        """
        p, n, cuts = self.p, self.hidden, self.words.tolist()
        weights = np.concatenate([p["ww"], p["wb"][:, None]], axis=1)
        grad = np.zeros_like(weights)
        width, many = np.diff(self.words), np.diff(at)
        ends = np.concatenate([[0], np.cumsum(width * many)])
        flat, sums = np.empty(ends[-1], np.float32), np.empty(at[-1], np.float32)
        used = np.flatnonzero(many).tolist()
        spans = [
            (cuts[k], cuts[k + 1], at[k], at[k + 1], flat[x:y].reshape(-1, cuts[k + 1] - cuts[k]))
            for k, x, y in zip(used, ends[used].tolist(), ends[1:][used].tolist())
        ]
        safe, ones = self._safe(p["ww"].T, p["wb"]), np.ones(max([0, *width.tolist()]), np.float32)
        for first, end, a, b, logits in spans:
            np.dot(rows[a:b], weights[first:end].T, out=logits)
            if not safe:
                logits -= logits.max(axis=1, keepdims=True)
        np.exp(flat, out=flat)
        for first, end, a, b, error in spans:
            np.dot(error, ones[: end - first], out=sums[a:b])
        sums = (scale / sums)[:, None]
        for _, _, a, b, error in spans:
            error *= sums[a:b]
        kinds = kinds[: at[-1]]
        nth = np.arange(at[-1]) - np.array(at)[kinds]
        flat[ends[kinds] + nth * width[kinds] + goal[: at[-1]] - self.words[kinds]] -= scale
        for first, end, a, b, error in spans:
            back[a:b] += error @ p["ww"][first:end]
            np.dot(error.T, rows[a:b], out=grad[first:end])
        return grad[:, :n], grad[:, n]

    def train(self, docs: list[np.ndarray], squares: Parameters, rate: float, most: int) -> None:
        """One pass; ``squares`` are Adagrad's sums, kept by the caller."""
        p, n = self.p, self.hidden
        h = h_all = np.zeros((n, min(most, max(len(docs), 1))), np.float32)

        kind = np.int16 if len(p["in"]) < 2**15 else np.int32  # the former is sorted by radix

        def step(name: str, grad: np.ndarray, rows=None) -> None:
            np.clip(grad, -5, 5, out=grad)
            some = slice(None) if rows is None else rows
            sums = squares[name][some]
            sums += grad * grad
            if rows is not None:
                squares[name][rows] = sums
            root = sums + np.float32(1e-6)
            np.sqrt(root, out=root)
            grad *= np.float32(rate)
            grad /= root
            p[name][some] -= grad

        for given, target, _ in windows(docs, most, WINDOW) if docs else ():
            states, kept = self._forward(h[:, : given.shape[1]], given)
            h = states[-1]
            mask = target >= 0
            rows, goal = states.transpose(0, 2, 1)[mask], target[mask]
            # Few lanes are left at the end: they count by their tokens, not as a whole.
            scale = np.float32(1 / (h_all.shape[1] * WINDOW))
            order, kinds, at = self._ordered(goal)
            goal = goal[order]
            given_one = np.ones((len(goal), n + 1), np.float32)  # the last column meets the biases
            given_one[:, :n] = rows[order]
            weights = np.concatenate([p["cw"], p["cb"][None]])
            error = given_one @ weights
            error *= (scale / self._sums(error, self._safe(p["cw"], p["cb"])))[:, None]
            error[np.arange(len(goal)), kinds] -= scale
            back = error @ p["cw"].T
            grad = given_one.T @ error
            grads = {"cw": grad[:n], "cb": grad[n]}
            grads["ww"], grads["wb"] = self._word_errors(given_one, goal, kinds, at, scale, back)
            unsorted = np.empty_like(back)
            unsorted[order] = back
            back = unsorted
            outer = np.zeros((*given.shape, n), np.float32)
            outer[mask] = back
            outer = np.ascontiguousarray(outer.transpose(0, 2, 1))
            before, z, r, g, new, fresh = kept
            # What the gradient of a state is multiplied by, for all steps at once.
            to_new = (1 - z) * (1 - new * new)
            to_z = (before - new) * z * (1 - z)
            to_r = g * r * (1 - r)
            inner = np.empty((len(given), 3 * n, given.shape[1]), np.float32)
            through = np.empty_like(inner)
            d = np.zeros_like(outer[0])
            for t in range(len(given) - 1, -1, -1):
                d += outer[t]
                here, on = inner[t], through[t]
                d_new = here[2 * n :]
                np.multiply(d, to_new[t], out=d_new)
                np.multiply(d, to_z[t], out=here[:n])
                np.multiply(d_new, to_r[t], out=here[n : 2 * n])
                on[: 2 * n] = here[: 2 * n]
                np.multiply(d_new, r[t], out=on[2 * n :])
                d *= z[t]
                d += p["rec"] @ on
                d[:, fresh[t]] = 0
            rec = np.matmul(before, through.transpose(0, 2, 1)).sum(axis=0)
            used = given >= 0
            symbols = given[used]
            if len(symbols):
                order = np.argsort(symbols.astype(kind), kind="stable")
                symbols = symbols[order]
                starts = np.flatnonzero(np.diff(symbols, prepend=-1))
                flow = inner.transpose(0, 2, 1).reshape(-1, 3 * n)[np.flatnonzero(used)[order]]
                step("in", np.add.reduceat(flow, starts, axis=0), symbols[starts])
            for name, grad in (*grads.items(), ("rec", rec)):
                step(name, grad)
