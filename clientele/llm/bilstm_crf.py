"""A character tagger in numpy: a bidirectional LSTM with a linear-chain CRF on top.

Sequences come as integer arrays of shape (steps, batch). Small enough to be trained on the
driver in seconds and sent to every task.
"""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Tagger:
    """``parameters`` is a dictionary of float32 arrays: what has to be stored or sent."""

    def __init__(self, parameters: dict[str, np.ndarray]):
        self.parameters = parameters

    @classmethod
    def new(cls, n_symbols: int, n_tags: int, hidden: int, seed: int) -> Tagger:
        rng = np.random.default_rng(seed)

        def uniform(*shape: int, scale: float) -> np.ndarray:
            return rng.uniform(-scale, scale, shape).astype(np.float32)

        p = {}
        for way in "fb":
            # The embedding and the input weights are one table.
            p[f"x{way}"] = uniform(n_symbols, 4 * hidden, scale=0.5)
            p[f"x{way}"][:, hidden : 2 * hidden] += 1.0
            p[f"h{way}"] = uniform(hidden, 4 * hidden, scale=hidden**-0.5)
        p["out"] = uniform(2 * hidden, n_tags, scale=0.3)
        p["bias"] = np.zeros(n_tags, np.float32)
        p["move"] = uniform(n_tags, n_tags, scale=0.1)
        return cls(p)

    def _run(self, x: np.ndarray, way: str, keep: bool) -> tuple[np.ndarray, list]:
        p = self.parameters
        table, u = p[f"x{way}"], p[f"h{way}"]
        steps, batch = x.shape
        n = u.shape[0]
        h = np.zeros((batch, n), np.float32)
        c = np.zeros((batch, n), np.float32)
        out, memory = np.empty((steps, batch, n), np.float32), []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = table[x[t]] + h @ u
            i, f, o = _sigmoid(z[:, :n]), _sigmoid(z[:, n : 2 * n]), _sigmoid(z[:, 3 * n :])
            g = np.tanh(z[:, 2 * n : 3 * n])
            was_h, was_c = h, c
            c = f * c + i * g
            s = np.tanh(c)
            h = o * s
            out[t] = h
            if keep:
                memory.append((t, was_h, was_c, i, f, g, o, s))
        return out, memory

    def _back(self, x: np.ndarray, way: str, memory: list, d_out: np.ndarray, grads: dict) -> None:
        u = self.parameters[f"h{way}"]
        d_table, d_u = grads[f"x{way}"], grads[f"h{way}"]
        dh = np.zeros_like(memory[0][1])
        dc = np.zeros_like(dh)
        for t, was_h, was_c, i, f, g, o, s in reversed(memory):
            dh = dh + d_out[t]
            dc = dc + dh * o * (1 - s * s)
            dz = np.concatenate(
                [dc * g * i * (1 - i), dc * was_c * f * (1 - f), dc * i * (1 - g * g), dh * s * o * (1 - o)], axis=1
            )
            np.add.at(d_table, x[t], dz)
            d_u += was_h.T @ dz
            dh, dc = dz @ u.T, dc * f

    def scores(self, x: np.ndarray) -> np.ndarray:
        """What each tag scores at each place, without the moves between tags."""
        forward, _ = self._run(x, "f", False)
        backward, _ = self._run(x, "b", False)
        both = np.concatenate([forward, backward], axis=2)
        return both @ self.parameters["out"] + self.parameters["bias"]

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best sequence of tags of each column."""
        e, move = self.scores(x), self.parameters["move"]
        steps, batch, n = e.shape
        best, back = e[0], np.empty((steps, batch, n), np.int8)
        for t in range(1, steps):
            by = best[:, :, None] + move
            back[t] = by.argmax(axis=1)
            best = by.max(axis=1) + e[t]
        tags = np.empty((steps, batch), np.int8)
        tags[-1] = best.argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = back[t][np.arange(batch), tags[t]]
        return tags

    def gradients(self, x: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """The mean negative log-likelihood of the tags and its gradients."""
        p = self.parameters
        forward, memory_f = self._run(x, "f", True)
        backward, memory_b = self._run(x, "b", True)
        both = np.concatenate([forward, backward], axis=2)
        e, move = both @ p["out"] + p["bias"], p["move"]
        steps, batch, n = e.shape
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0]
        for t in range(1, steps):
            alpha[t] = _logsumexp(alpha[t - 1][:, :, None] + move, 1) + e[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = _logsumexp(move + (beta[t + 1] + e[t + 1])[:, None, :], 2)
        whole = _logsumexp(alpha[-1], 1)
        d_e = np.exp(alpha + beta - whole[:, None])
        d_move = np.zeros_like(move)
        for t in range(1, steps):
            d_move += np.exp(
                alpha[t - 1][:, :, None] + move + (e[t] + beta[t])[:, None, :] - whole[:, None, None]
            ).sum(axis=0)
        at, column = np.arange(steps)[:, None], np.arange(batch)[None]
        gold = e[at, column, tags].sum(axis=0) + move[tags[:-1], tags[1:]].sum(axis=0)
        d_e[at, column, tags] -= 1
        np.add.at(d_move, (tags[:-1], tags[1:]), -1)
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        grads["move"] = d_move / batch
        d_e /= batch
        grads["out"] = np.tensordot(both, d_e, axes=([0, 1], [0, 1]))
        grads["bias"] = d_e.sum(axis=(0, 1))
        d_both, half = d_e @ p["out"].T, forward.shape[2]
        self._back(x, "f", memory_f, d_both[:, :, :half], grads)
        self._back(x, "b", memory_b, d_both[:, :, half:], grads)
        return float((whole - gold).mean()), grads

    def train(self, x: np.ndarray, tags: np.ndarray, rounds: int, batch: int = 64, rate: float = 0.01, seed: int = 0) -> list[float]:
        """Adam over shuffled batches; returns the mean loss of each round."""
        rng, losses = np.random.default_rng(seed), []
        first = {k: np.zeros_like(v) for k, v in self.parameters.items()}
        second = {k: np.zeros_like(v) for k, v in self.parameters.items()}
        step, total = 0, rounds * max(1, x.shape[1] // batch)
        for _ in range(rounds):
            order, sums = rng.permutation(x.shape[1]), []
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                loss, grads = self.gradients(x[:, some], tags[:, some])
                sums.append(loss)
                step += 1
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                now = rate * max(0.1, 1 - step / total)
                for k, g in grads.items():
                    g = g * min(1.0, 5.0 / (norm + 1e-9))
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    by = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    self.parameters[k] = (self.parameters[k] - now * by).astype(np.float32)
            losses.append(float(np.mean(sums)))
        return losses
