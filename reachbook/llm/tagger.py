"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Batches of windows of one length go through both directions at once; a window's
tags are scored by a linear chain whose transitions are learned with the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Characters of their own; others fall into classes by kind.
_SIGNS = "@.-_+()[]{}<>/\\:;,!?'\"=#*%&$|~^` \t\n"
CLASSES = 2 + 26 + 1 + 10 + len(_SIGNS)


def _code(point: int) -> int:
    char = chr(point)
    if char in _SIGNS:
        return 39 + _SIGNS.index(char)
    if "0" <= char <= "9":
        return 29 + int(char)
    if "a" <= char <= "z":
        return 2 + ord(char) - ord("a")
    if "A" <= char <= "Z":
        return 28
    return 1


_TABLE = np.array([_code(p) for p in range(128)], np.uint8)


def codes(text: str) -> np.ndarray:
    """Character classes: 0 is padding, 1 all that is not ASCII."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _TABLE[np.minimum(points, 127)], 1).astype(np.uint8)


@dataclass
class Shape:
    tags: int
    embedding: int = 16
    hidden: int = 24


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Tagger:
    """Parameters by name, all float32."""

    def __init__(self, shape: Shape, seed: int = 7):
        rng = np.random.default_rng(seed)
        h, e = shape.hidden, shape.embedding
        self.shape = shape

        def start(*size: int) -> np.ndarray:
            return (rng.standard_normal(size) / np.sqrt(size[0])).astype(np.float32)

        self.p = {"emb": (rng.standard_normal((CLASSES, e)) * 0.3).astype(np.float32)}
        for way in "fb":
            bias = np.zeros(4 * h, np.float32)
            bias[h : 2 * h] = 1.0  # remember at first
            self.p |= {f"{way}x": start(e, 4 * h), f"{way}h": start(h, 4 * h), f"{way}c": bias}
        self.p |= {"out": start(2 * h, shape.tags), "outc": np.zeros(shape.tags, np.float32)}
        self.p["trans"] = np.zeros((shape.tags, shape.tags), np.float32)

    # Forward. Arrays are time first: (T, N, ...).

    def _lstm(self, x: np.ndarray, way: str, keep: bool) -> tuple[np.ndarray, list]:
        h = self.shape.hidden
        steps, n = x.shape[:2]
        gates_in = x @ self.p[f"{way}x"] + self.p[f"{way}c"]
        state, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        out, kept = np.empty((steps, n, h), np.float32), []
        for t in range(steps):
            g = gates_in[t] + state @ self.p[f"{way}h"]
            s = _sigmoid(g[:, : 3 * h])
            i, f, o, c = s[:, :h], s[:, h : 2 * h], s[:, 2 * h :], np.tanh(g[:, 3 * h :])
            before, old = state, cell
            cell = f * old + i * c
            tanh_cell = np.tanh(cell)
            state = o * tanh_cell
            out[t] = state
            if keep:
                kept.append((before, old, i, f, o, c, tanh_cell))
        return out, kept

    def emissions(self, windows: np.ndarray) -> np.ndarray:
        """Scores (N, T, tags) of windows (N, T) of character classes."""
        x = self.p["emb"][windows.T]
        forward, _ = self._lstm(x, "f", False)
        backward, _ = self._lstm(x[::-1], "b", False)
        both = np.concatenate([forward, backward[::-1]], axis=2)
        return (both @ self.p["out"] + self.p["outc"]).transpose(1, 0, 2)

    # Training: the likelihood of the right tags, by backpropagation.

    def _lstm_back(self, x, way, kept, grad_out, grads) -> np.ndarray:
        h = self.shape.hidden
        steps, n = x.shape[:2]
        grad_gates = np.empty((steps, n, 4 * h), np.float32)
        grad_state, grad_cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        for t in range(steps - 1, -1, -1):
            before, old, i, f, o, c, tanh_cell = kept[t]
            grad_h = grad_out[t] + grad_state
            grad_c = grad_cell + grad_h * o * (1 - tanh_cell**2)
            g = grad_gates[t]
            g[:, :h] = grad_c * c * i * (1 - i)
            g[:, h : 2 * h] = grad_c * old * f * (1 - f)
            g[:, 2 * h : 3 * h] = grad_h * tanh_cell * o * (1 - o)
            g[:, 3 * h :] = grad_c * i * (1 - c**2)
            grad_cell = grad_c * f
            grad_state = g @ self.p[f"{way}h"].T
            grads[f"{way}h"] += before.T @ g
        flat = grad_gates.reshape(-1, 4 * h)
        grads[f"{way}x"] += x.reshape(-1, x.shape[2]).T @ flat
        grads[f"{way}c"] += flat.sum(axis=0)
        return grad_gates @ self.p[f"{way}x"].T

    def _chain(self, scores: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Loss, and its gradients for the scores (T, N, K) and the transitions."""
        steps, n, k = scores.shape
        trans = self.p["trans"].astype(np.float64)
        alpha, beta = np.empty((steps, n, k)), np.zeros((steps, n, k))
        alpha[0] = scores[0]
        for t in range(1, steps):
            alpha[t] = scores[t] + _log_sum(alpha[t - 1][:, :, None] + trans, 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = _log_sum(trans + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _log_sum(alpha[-1], 1)
        grad = np.exp(alpha + beta - total[None, :, None])
        rows, times = np.arange(n), np.arange(steps)[:, None]
        grad[times, rows, tags] -= 1
        moves = alpha[:-1, :, :, None] + trans + (scores[1:] + beta[1:])[:, :, None, :] - total[None, :, None, None]
        grad_trans = np.exp(moves).sum(axis=(0, 1))
        np.subtract.at(grad_trans, (tags[:-1].ravel(), tags[1:].ravel()), 1)
        right = scores[times, rows, tags].sum() + trans[tags[:-1], tags[1:]].sum()
        return float(total.sum() - right) / n, (grad / n).astype(np.float32), (grad_trans / n).astype(np.float32)

    def gradients(self, windows: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        grads = {name: np.zeros_like(v) for name, v in self.p.items()}
        x = self.p["emb"][windows.T]
        forward, kept_f = self._lstm(x, "f", True)
        backward, kept_b = self._lstm(x[::-1], "b", True)
        both = np.concatenate([forward, backward[::-1]], axis=2)
        loss, grad, grads["trans"] = self._chain((both @ self.p["out"] + self.p["outc"]).astype(np.float64), tags.T)
        grads["out"] = both.reshape(-1, both.shape[2]).T @ grad.reshape(-1, grad.shape[2])
        grads["outc"] = grad.sum(axis=(0, 1))
        grad_both = grad @ self.p["out"].T
        h = self.shape.hidden
        grad_x = self._lstm_back(x, "f", kept_f, grad_both[:, :, :h], grads)
        grad_x = grad_x + self._lstm_back(x[::-1], "b", kept_b, grad_both[::-1, :, h:], grads)[::-1]
        np.add.at(grads["emb"], windows.T.ravel(), grad_x.reshape(-1, grad_x.shape[2]))
        return loss, grads

    def fit(self, windows: np.ndarray, tags: np.ndarray, *, steps: int, batch: int, rate: float, seed: int = 3) -> list[float]:
        """Adam on random batches; the rate falls to a tenth."""
        rng = np.random.default_rng(seed)
        first = {name: np.zeros_like(v) for name, v in self.p.items()}
        second = {name: np.zeros_like(v) for name, v in self.p.items()}
        losses = []
        for step in range(1, steps + 1):
            chosen = rng.integers(0, len(windows), batch)
            loss, grads = self.gradients(windows[chosen], tags[chosen])
            losses.append(loss)
            norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
            scale = min(1.0, 5.0 / (norm + 1e-9))
            now = rate * (1 - 0.9 * step / steps)
            for name, g in grads.items():
                g = g * scale
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.999 * second[name] + 0.001 * g * g
                m, v = first[name] / (1 - 0.9**step), second[name] / (1 - 0.999**step)
                self.p[name] = self.p[name] - (now * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
        return losses

    def best_paths(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tags (N, T) of the best path over each row's first `lengths` scores (N, T, K)."""
        n, steps, _ = scores.shape
        trans = self.p["trans"]
        best = scores[:, 0].copy()
        came = np.zeros(scores.shape, np.int8)
        for t in range(1, steps):
            moves = best[:, :, None] + trans
            came[:, t] = moves.argmax(axis=1)
            after = moves.max(axis=1) + scores[:, t]
            best = np.where((t < lengths)[:, None], after, best)
        tags = np.zeros((n, steps), np.int8)
        now = best.argmax(axis=1)
        rows = np.arange(n)
        for t in range(steps - 1, -1, -1):
            inside = t < lengths
            tags[:, t] = np.where(inside, now, 0)
            now = np.where(inside, came[rows, t, now], now)
        return tags


class Path:
    """The best path over scores that come bit by bit.

    Whatever follows, the path up to now ends in one of the tags. As far back as
    the best paths to all of them are the same, it is settled and given out, so
    only the unsettled end is held: a few characters, as a rule.
    """

    def __init__(self, tagger: Tagger):
        self.trans = tagger.p["trans"]
        self.best: np.ndarray | None = None
        self.came = np.zeros((0, len(self.trans)), np.int8)

    def feed(self, scores: np.ndarray) -> np.ndarray:
        """Tags that are settled now, in order, after the next scores (T, K)."""
        came = np.zeros(scores.shape, np.int8)
        best = self.best
        for t, own in enumerate(scores):
            if best is None:
                best = own
                continue
            moves = best[:, None] + self.trans
            came[t] = moves.argmax(axis=0)
            best = moves.max(axis=0) + own
            if not t & 255:
                best = best - best.max()  # sums stay small, hence exact
        self.best = best
        self.came = np.concatenate([self.came, came])
        # The tags before place t that the best paths to each last tag have.
        tags = np.arange(len(self.trans))
        for t in range(len(self.came) - 1, 0, -1):
            tags = self.came[t][tags]
            if (tags == tags[0]).all():
                return self._settled(t, int(tags[0]))
        return np.zeros(0, np.int8)

    def _settled(self, end: int, tag: int) -> np.ndarray:
        """The path over the first `end` places that ends in a tag."""
        out = np.empty(end, np.int8)
        for t in range(end - 1, -1, -1):
            out[t] = tag
            tag = int(self.came[t][tag])
        self.came = self.came[end:]
        return out

    def finish(self) -> np.ndarray:
        return self._settled(len(self.came), int(self.best.argmax())) if len(self.came) else np.zeros(0, np.int8)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - most).sum(axis=axis)) + most.squeeze(axis)
