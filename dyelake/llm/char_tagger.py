"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

import numpy as np

VOCABULARY, PAD, OTHER = 130, 129, 128


def encode(text: str, length: int) -> np.ndarray:
    """Character ids: ASCII as is, one id for all others, padded to ``length``."""
    ids = np.full(length, PAD, np.int64)
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)[:length]
    ids[: len(codes)] = np.minimum(codes, OTHER)
    return ids


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Tagger:
    """Emissions from a BiLSTM over character embeddings; a linear-chain CRF over the tags."""

    def __init__(self, tags: int, embed: int = 10, hidden: int = 16, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        init = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.hidden, self.tags = hidden, tags
        self.p = {"E": init(VOCABULARY, embed) * 3, "Wo": init(2 * hidden, tags), "bo": np.zeros(tags, np.float32), "A": init(tags, tags) * 0.1}
        for d in "fb":
            self.p |= {f"Wx{d}": init(embed, 4 * hidden), f"Wh{d}": init(hidden, 4 * hidden), f"b{d}": np.zeros(4 * hidden, np.float32)}
            self.p[f"b{d}"][hidden : 2 * hidden] = 1.0

    def _lstm(self, x: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """Hidden states (steps, batch, hidden) over x (steps, batch, embed), and what backward() needs."""
        n, h = self.hidden, np.zeros((x.shape[1], self.hidden), np.float32)
        c, out, tape = h, np.empty((x.shape[0], x.shape[1], n), np.float32), []
        into = x @ self.p[f"Wx{d}"] + self.p[f"b{d}"]
        for t in range(len(x)):
            z = into[t] + h @ self.p[f"Wh{d}"]
            gate = _sigmoid(z[:, : 3 * n])
            i, f, o, g = gate[:, :n], gate[:, n : 2 * n], gate[:, 2 * n :], np.tanh(z[:, 3 * n :])
            new = f * c + i * g
            squashed = np.tanh(new)
            tape.append((h, c, i, f, o, g, squashed))
            c, h = new, o * squashed
            out[t] = h
        return out, tape

    def _lstm_back(self, x: np.ndarray, d: str, tape: list, slope: np.ndarray, grads: dict) -> np.ndarray:
        dh, dc = np.zeros_like(slope[0]), np.zeros_like(slope[0])
        dz = np.empty((*slope.shape[:2], 4 * self.hidden), np.float32)
        n = self.hidden
        for t in range(len(x) - 1, -1, -1):
            h, c, i, f, o, g, squashed = tape[t]
            dh = dh + slope[t]
            dc = dc + dh * o * (1 - squashed**2)
            dz[t, :, :n] = dc * g * i * (1 - i)
            dz[t, :, n : 2 * n] = dc * c * f * (1 - f)
            dz[t, :, 2 * n : 3 * n] = dh * squashed * o * (1 - o)
            dz[t, :, 3 * n :] = dc * i * (1 - g**2)
            dc = dc * f
            dh = dz[t] @ self.p[f"Wh{d}"].T
        flat = dz.reshape(-1, 4 * n)
        before = np.stack([s[0] for s in tape]).reshape(-1, n)
        grads[f"Wh{d}"], grads[f"b{d}"] = before.T @ flat, flat.sum(0)
        grads[f"Wx{d}"] = x.reshape(-1, x.shape[2]).T @ flat
        return dz @ self.p[f"Wx{d}"].T

    def emissions(self, ids: np.ndarray) -> tuple[np.ndarray, tuple]:
        """(steps, batch, tags) scores of ids (batch, steps)."""
        x = self.p["E"][ids.T]
        ahead, tape_f = self._lstm(x, "f")
        back, tape_b = self._lstm(x[::-1], "b")
        both = np.concatenate((ahead, back[::-1]), axis=2)
        return both @ self.p["Wo"] + self.p["bo"], (x, both, tape_f, tape_b)

    def _chain(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each place's tag probabilities (steps, batch, tags), sums over the batch of those of each pair of neighbours' tags, and
        the log partition. Forward and backward sums are kept to a total of 1 at each place."""
        top, edge = e.max(2, keepdims=True), self.p["A"].max()
        like, step = np.exp(e - top), np.exp(self.p["A"] - edge)
        fore, aft, total = np.empty_like(like), np.ones_like(like), np.empty((*e.shape[:2], 1), e.dtype)
        for t in range(len(e)):
            now = (fore[t - 1] @ step) * like[t] if t else like[0]
            total[t] = now.sum(1, keepdims=True)
            fore[t] = now / total[t]
        pairs = np.zeros_like(step)
        for t in range(len(e) - 2, -1, -1):
            ahead = like[t + 1] * aft[t + 1] / total[t + 1]
            aft[t] = ahead @ step.T
            pairs += fore[t].T @ ahead
        return fore * aft, pairs * step, (np.log(total) + top).sum((0, 2)) + (len(e) - 1) * edge

    def gradients(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of tags (batch, steps), and its gradients."""
        e, (x, both, tape_f, tape_b) = self.emissions(ids)
        share, pair, total = self._chain(e)
        size, gold = ids.shape[0], tags.T
        onehot = np.eye(self.tags, dtype=np.float32)[gold]
        score = (e * onehot).sum((0, 2)) + self.p["A"][gold[:-1], gold[1:]].sum(0)
        pair = pair - np.bincount((gold[:-1] * self.tags + gold[1:]).ravel(), minlength=self.tags**2).reshape(pair.shape).astype(np.float32)
        de = ((share - onehot) / size).astype(np.float32)
        grads = {"A": pair / size, "bo": de.sum((0, 1)), "Wo": both.reshape(-1, both.shape[2]).T @ de.reshape(-1, self.tags)}
        dboth = de @ self.p["Wo"].T
        n = self.hidden
        dx = self._lstm_back(x, "f", tape_f, dboth[:, :, :n], grads)
        dx = dx + self._lstm_back(x[::-1], "b", tape_b, dboth[::-1, :, n:], grads)[::-1]
        grads["E"] = np.stack([np.bincount(ids.T.ravel(), dx[:, :, k].ravel(), VOCABULARY) for k in range(dx.shape[2])], axis=1).astype(np.float32)
        return float((total - score).mean()), grads

    def train(self, ids: np.ndarray, tags: np.ndarray, epochs: int = 14, batch: int = 64, rate: float = 0.01, seed: int = 5) -> float:
        """Adam over shuffled batches; the last epoch's mean loss."""
        rng, loss, step = np.random.default_rng(seed), 0.0, 0
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        for epoch in range(epochs):
            losses = []
            for own in np.array_split(rng.permutation(len(ids)), max(1, len(ids) // batch)):
                lost, grads = self.gradients(ids[own], tags[own])
                losses.append(lost)
                step += 1
                norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
                now = rate * (0.5 if epoch >= epochs * 2 // 3 else 1.0)
                for k, g in grads.items():
                    g = g * min(1.0, 5 / (norm + 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            loss = float(np.mean(losses))
        return loss

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags (batch, steps), and at each place the probability of that tag."""
        e, _ = self.emissions(ids)
        best, back = e[0], np.empty(e.shape, np.int64)
        for t in range(1, len(e)):
            score = best[:, :, None] + self.p["A"]
            back[t] = score.argmax(1)
            best = e[t] + score.max(1)
        path = np.empty(e.shape[:2], np.int64)
        path[-1] = best.argmax(1)
        for t in range(len(e) - 1, 0, -1):
            path[t - 1] = np.take_along_axis(back[t], path[t][:, None], 1)[:, 0]
        sure = np.take_along_axis(self._chain(e)[0], path[:, :, None], 2)[:, :, 0]
        return path.T, sure.T
