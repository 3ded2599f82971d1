"""A small character tagger in numpy: bidirectional LSTM with CRF transitions.

Texts come as (batch, length) arrays of character numbers, tags as arrays of
the same shape. Padding is a character of its own, tagged 0.
"""

from __future__ import annotations

import numpy as np

_BARRED = -1e4  # score of a transition that can't be


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class BiLstmCrf:
    """``allowed[i, j]``: tag j may follow tag i; ``openers``: may come first."""

    def __init__(self, characters: int, allowed: np.ndarray, openers: np.ndarray, width: int = 8, hidden: int = 12,
                 seed: int = 42):
        rng = np.random.default_rng(seed)
        tags = len(allowed)

        def random(*shape: int) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

        self.hidden = hidden
        self.barred = np.where(allowed, 0.0, _BARRED)
        self.no_start = np.where(openers, 0.0, _BARRED)
        self.p = {"chars": rng.normal(0, 0.3, (characters, width)), "out": random(2 * hidden, tags), "out_b": np.zeros(tags),
                  "trans": np.zeros((tags, tags)), "start": np.zeros(tags)}
        for way in ("f", "b"):
            bias = np.zeros(4 * hidden)
            bias[hidden:2 * hidden] = 1.0  # remember at first
            self.p |= {f"x_{way}": random(width, 4 * hidden), f"h_{way}": random(hidden, 4 * hidden), f"c_{way}": bias}

    # ------------------------------------------------------------- layers ----

    def _lstm(self, x: np.ndarray, way: str, keep: bool) -> tuple[np.ndarray, list]:
        batch, length, _ = x.shape
        n, p = self.hidden, self.p
        gates = x @ p[f"x_{way}"] + p[f"c_{way}"]
        h, c = np.zeros((batch, n)), np.zeros((batch, n))
        out, steps = np.zeros((batch, length, n)), []
        for t in range(length) if way == "f" else range(length - 1, -1, -1):
            z = gates[:, t] + h @ p[f"h_{way}"]
            s = _sigmoid(z[:, :3 * n])
            i, f, o, g = s[:, :n], s[:, n:2 * n], s[:, 2 * n:], np.tanh(z[:, 3 * n:])
            before_h, before_c = h, c
            c = f * c + i * g
            squashed = np.tanh(c)
            h = o * squashed
            out[:, t] = h
            if keep:
                steps.append((t, i, f, o, g, before_h, before_c, squashed))
        return out, steps

    def _lstm_back(self, x: np.ndarray, way: str, steps: list, grad: np.ndarray, grads: dict) -> np.ndarray:
        n, p = self.hidden, self.p
        weights = p[f"h_{way}"]
        dh, dc = np.zeros_like(grad[:, 0]), np.zeros_like(grad[:, 0])
        dz_all, d_weights = np.zeros((*grad.shape[:2], 4 * n)), np.zeros_like(weights)
        for t, i, f, o, g, before_h, before_c, squashed in reversed(steps):
            dh = dh + grad[:, t]
            dc = dc + dh * o * (1 - squashed ** 2)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * squashed * o * (1 - o),
                                 dc * i * (1 - g ** 2)], axis=1)
            dz_all[:, t] = dz
            d_weights += before_h.T @ dz
            dh, dc = dz @ weights.T, dc * f
        flat = dz_all.reshape(-1, 4 * n)
        grads[f"h_{way}"] = d_weights
        grads[f"x_{way}"] = x.reshape(-1, x.shape[2]).T @ flat
        grads[f"c_{way}"] = flat.sum(axis=0)
        return dz_all @ p[f"x_{way}"].T

    # ----------------------------------------------------------- learning ----

    def loss_and_grads(self, chars: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of the tag sequences."""
        p, (batch, length) = self.p, chars.shape
        x = p["chars"][chars]
        forward, f_steps = self._lstm(x, "f", True)
        backward, b_steps = self._lstm(x, "b", True)
        both = np.concatenate([forward, backward], axis=2)
        emit = both @ p["out"] + p["out_b"]
        trans, start = p["trans"] + self.barred, p["start"] + self.no_start

        alpha = np.zeros_like(emit)
        alpha[:, 0] = start + emit[:, 0]
        for t in range(1, length):
            alpha[:, t] = _log_sum(alpha[:, t - 1, :, None] + trans, 1) + emit[:, t]
        total = _log_sum(alpha[:, -1], 1)
        beta = np.zeros_like(emit)
        for t in range(length - 2, -1, -1):
            beta[:, t] = _log_sum(trans + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], 2)

        rows, at = np.arange(batch)[:, None], np.arange(length)[None, :]
        gold = (start[tags[:, 0]] + emit[rows, at, tags].sum(axis=1) + trans[tags[:, :-1], tags[:, 1:]].sum(axis=1))
        d_emit = np.exp(alpha + beta - total[:, None, None])  # marginals
        d_start = d_emit[:, 0].sum(axis=0) - np.bincount(tags[:, 0], minlength=len(start))
        pairs = np.exp(alpha[:, :-1, :, None] + trans + (emit[:, 1:] + beta[:, 1:])[:, :, None, :]
                       - total[:, None, None, None]).sum(axis=(0, 1))
        np.subtract.at(pairs, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1.0)
        d_emit[rows, at, tags] -= 1.0
        d_emit /= batch

        grads = {"start": d_start / batch, "trans": pairs / batch, "out_b": d_emit.sum(axis=(0, 1)),
                 "out": both.reshape(-1, both.shape[2]).T @ d_emit.reshape(-1, d_emit.shape[2])}
        d_both = d_emit @ p["out"].T
        n = self.hidden
        d_x = self._lstm_back(x, "f", f_steps, d_both[:, :, :n], grads) + self._lstm_back(x, "b", b_steps, d_both[:, :, n:], grads)
        grads["chars"] = np.zeros_like(p["chars"])
        np.add.at(grads["chars"], chars.ravel(), d_x.reshape(-1, d_x.shape[2]))
        return float((total - gold).mean()), grads

    def fit(self, chars: np.ndarray, tags: np.ndarray, epochs: int = 8, batch: int = 32, rate: float = 0.02,
            seed: int = 42) -> list[float]:
        """Adam; returns the mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, losses = 0, []
        for epoch in range(epochs):
            seen = []
            for part in np.array_split(rng.permutation(len(chars)), max(1, len(chars) // batch)):
                loss, grads = self.loss_and_grads(chars[part], tags[part])
                seen.append(loss)
                step += 1
                size = np.sqrt(sum((g ** 2).sum() for g in grads.values()))
                for k, g in grads.items():
                    g = g * min(1.0, 5.0 / max(size, 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    slow = rate * (1 - epoch / epochs)
                    self.p[k] -= slow * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
            losses.append(float(np.mean(seen)))
        return losses

    # ----------------------------------------------------------- decoding ----

    def _lstm_single(self, chars: np.ndarray, way: str) -> np.ndarray:
        """(length, hidden, batch) states in single precision, for decoding.

        A step is one product: character and state stand below each other in
        one matrix. tanh(x) = 2 sigmoid(2 x) - 1, and exp is the cheapest
        function numpy has for single precision."""
        n, p = self.hidden, self.p
        width = p["chars"].shape[1]
        scale = np.where(np.arange(4 * n) < 3 * n, -1.0, -2.0)
        weights = np.ascontiguousarray((np.vstack([p[f"x_{way}"], p[f"c_{way}"][None], p[f"h_{way}"]]) * scale).T, np.float32)
        looked_up = np.ascontiguousarray(p["chars"].T, np.float32)
        length, batch = chars.shape
        out = np.empty((length, n, batch), np.float32)
        state = np.zeros((width + 1 + n, batch), np.float32)
        state[width] = 1
        c = np.zeros((n, batch), np.float32)
        gates, squashed = np.empty((4 * n, batch), np.float32), np.empty((n, batch), np.float32)
        with np.errstate(over="ignore"):  # 1 / (1 + infinity) is the 0 it should be
            for t in range(length) if way == "f" else range(length - 1, -1, -1):
                np.take(looked_up, chars[t], axis=1, out=state[:width], mode="clip")
                np.matmul(weights, state, out=gates)
                np.exp(gates, out=gates)
                gates += 1
                np.reciprocal(gates, out=gates)
                new = gates[3 * n:]
                new *= 2
                new -= 1
                new *= gates[:n]
                c *= gates[n:2 * n]
                c += new
                np.multiply(c, -2, out=squashed)
                np.exp(squashed, out=squashed)
                squashed += 1
                np.divide(2, squashed, out=squashed)
                squashed -= 1
                np.multiply(gates[2 * n:3 * n], squashed, out=out[t])
                state[width + 1:] = out[t]
        return out

    def decode(self, chars: np.ndarray) -> np.ndarray:
        """Most probable tag sequence of each row (Viterbi); rows whose best
        path can only be zeros (``_may_leave_zero``) need no search."""
        n, p = self.hidden, self.p
        turned = np.ascontiguousarray(chars.T)
        weights = p["out"].T.astype(np.float32)
        emit = weights[:, :n] @ self._lstm_single(turned, "f")
        emit += weights[:, n:] @ self._lstm_single(turned, "b")
        emit += p["out_b"].astype(np.float32)[:, None]  # (length, tags, batch)
        trans, start = p["trans"] + self.barred, p["start"] + self.no_start
        tags = np.zeros(chars.shape, np.int8)
        open_rows = np.flatnonzero(self._may_leave_zero(emit, trans.astype(np.float32), start.astype(np.float32)))
        if len(open_rows):
            tags[open_rows] = self._viterbi(emit[:, :, open_rows].transpose(2, 0, 1).astype(np.float64), trans, start)
        return tags

    @staticmethod
    def _may_leave_zero(emit: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Rows in which some path may score above the path of zeros.

        ``above`` bounds from above, for each other tag, what the best path to
        it has over the path of zeros. A tag is entered from the tags that may
        come before it, at the greatest transition; while no path that went
        back to 0 had more than 0, the path of zeros is the best to 0."""
        gain = trans - trans[0, 0]
        enter = gain.max(axis=0)[1:, None]
        before = gain[:, 1:] > _BARRED / 2  # [i, j]: tag 1 + j may follow tag i
        from_zero = before[0]
        leave = gain[1:, 0, None]
        others = [np.flatnonzero(before[1:, j]) for j in range(len(trans) - 1)]
        anywhere = [j for j in range(len(others)) if from_zero[j]]
        inside = [j for j in range(len(others)) if not from_zero[j]]
        pairs = max((len(others[j]) for j in inside), default=0)
        # the tags before an inside tag, repeated to equal numbers
        sources = np.array([np.resize(others[j], pairs) for j in inside]).reshape(len(inside), pairs)
        over = emit[:, 1:] - emit[:, :1]
        over[1:] += enter
        above = over[0] + (start[1:] - start[0])[:, None]
        left = (above + leave > 0).any(axis=0)
        for t in range(1, len(emit)):
            best = np.maximum(above.max(axis=0), 0)
            new = over[t]
            new[anywhere] += best
            if inside:
                new[inside] += above[sources].max(axis=1)
            above = new
            left |= (above + leave).max(axis=0) > 0
        return left | (above.max(axis=0) > 0)

    @staticmethod
    def _viterbi(emit: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
        score = start + emit[:, 0]
        back = np.zeros(emit.shape, np.int8)
        for t in range(1, emit.shape[1]):
            reach = score[:, :, None] + trans
            back[:, t] = reach.argmax(axis=1)
            score = reach.max(axis=1) + emit[:, t]
        tags = np.zeros(emit.shape[:2], np.int8)
        tags[:, -1] = score.argmax(axis=1)
        rows = np.arange(len(emit))
        for t in range(emit.shape[1] - 1, 0, -1):
            tags[:, t - 1] = back[rows, t, tags[:, t]]
        return tags
