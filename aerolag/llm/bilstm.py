"""A character-level bidirectional LSTM with a CRF on top, in numpy.

Gates are piecewise linear (clipped lines for the sigmoid and the hyperbolic tangent). Arrays put
time first and the batch last, so that every step works on contiguous rows.
"""

from __future__ import annotations

import numpy as np

# ASCII, and one symbol for all other letters; one pads.
SYMBOLS = 130
OTHER, PAD = 128, 129


class Tagger:
    """Scores labels for every character and decodes the best sequence of labels."""

    def __init__(self, hidden: int, labels: int, seed: int = 7) -> None:
        random = np.random.default_rng(seed)

        def draw(*shape: int, scale: float) -> np.ndarray:
            return (random.standard_normal(shape) * scale).astype(np.float32)

        self.hidden, self.labels = hidden, labels
        self.weights: dict[str, np.ndarray] = {}
        for side in ("left", "right"):
            inputs = draw(4 * hidden, SYMBOLS, scale=0.5)
            # Forget gates start open.
            inputs[:hidden] += 1.0
            self.weights[f"{side}_in"] = inputs
            self.weights[f"{side}_own"] = draw(4 * hidden, hidden, scale=0.3)
            self.weights[f"{side}_out"] = draw(labels, hidden, scale=0.3)
        self.weights["bias"] = np.zeros((labels, 1), np.float32)
        self.weights["step"] = np.zeros((labels, labels), np.float32)

    # Forward

    def _run(self, side: str, symbols: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states (time, hidden, batch); with ``keep`` also what learning needs."""
        h_size = self.hidden
        inputs, own = self.weights[f"{side}_in"], self.weights[f"{side}_own"]
        time, batch = symbols.shape
        states = np.empty((time, h_size, batch), np.float32)
        h = np.zeros((h_size, batch), np.float32)
        c = np.zeros((h_size, batch), np.float32)
        kept = []
        for t in range(time):
            z = np.take(inputs, symbols[t], axis=1)
            z += own @ h
            gates = z[: 3 * h_size]
            gates *= 0.25
            gates += 0.5
            raw = z.copy() if keep else None
            np.clip(gates, 0, 1, out=gates)
            np.clip(z[3 * h_size :], -1, 1, out=z[3 * h_size :])
            forget, write, show, new = (z[i * h_size : (i + 1) * h_size] for i in range(4))
            before_h, before_c = h, c
            c = forget * c
            c += write * new
            h = np.clip(c, -1, 1)
            h *= show
            states[t] = h
            if keep:
                kept.append((raw, z, before_h, before_c, c))
        return states, kept

    def _score(self, side: str, symbols: np.ndarray, scores: np.ndarray) -> None:
        """Add what one direction says to ``scores``; as :meth:`_run`, in buffers used again."""
        n = self.hidden
        inputs, own, out = (self.weights[f"{side}_{part}"] for part in ("in", "own", "out"))
        # The line of the sigmoid is 0.25 x + 0.5; it goes into the weights here.
        inputs = np.concatenate([inputs[: 3 * n] * 0.25 + 0.5, inputs[3 * n :]]).astype(np.float32)
        own = np.concatenate([own[: 3 * n] * 0.25, own[3 * n :]]).astype(np.float32)
        batch = symbols.shape[1]
        z, added = np.empty((2, 4 * n, batch), np.float32)
        c, h, write = np.zeros((3, n, batch), np.float32)
        said = np.empty((self.labels, batch), np.float32)
        for t in range(len(symbols)):
            np.take(inputs, symbols[t], axis=1, out=z, mode="clip")
            z += np.matmul(own, h, out=added)
            np.clip(z[: 3 * n], 0, 1, out=z[: 3 * n])
            np.clip(z[3 * n :], -1, 1, out=z[3 * n :])
            c *= z[:n]
            np.multiply(z[n : 2 * n], z[3 * n :], out=write)
            c += write
            np.clip(c, -1, 1, out=h)
            h *= z[2 * n : 3 * n]
            scores[t] += np.matmul(out, h, out=said)

    def emissions(self, symbols: np.ndarray) -> np.ndarray:
        """Scores (time, labels, batch) of ``symbols`` (time, batch), both directions added."""
        time, batch = symbols.shape
        scores = np.empty((time, self.labels, batch), np.float32)
        scores[:] = self.weights["bias"]
        self._score("left", symbols, scores)
        self._score("right", symbols[::-1], scores[::-1])
        return scores

    def unremarkable(self, scores: np.ndarray) -> np.ndarray:
        """Sequences whose best labels are surely all 0, by what a run of others can win at most.

        A run pays for its first and its last transition, except at the ends of the sequence; each
        of its labels wins at most its best lead over label 0, and each transition within it at
        most the best lead of any. The largest sum over all runs is found from left to right.
        """
        step = self.weights["step"]
        lead = step - step[0, 0]
        within = max(0.0, float(lead[1:, 1:].max()))
        enter, leave = -float(lead[0, 1:].max()), -float(lead[1:, 0].max())
        wins = scores[:, 1:].max(axis=1) - scores[:, 0] + within
        run, most = np.full(scores.shape[2], max(enter, 0.0)), np.full(scores.shape[2], -np.inf)
        for now in wins:
            np.maximum(run, 0, out=run)
            run += now
            np.maximum(most, run, out=most)
        # An open end is not paid for; ties and rounding count as open.
        return (most < enter + leave - 1e-3) & (run < enter - 1e-3)

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """Best labels (time, batch) by Viterbi."""
        time, labels, batch = scores.shape
        step = self.weights["step"][:, :, None]
        best, back = scores[0], np.empty((time, labels, batch), np.int8)
        for t in range(1, time):
            paths = best[:, None] + step
            back[t] = paths.argmax(axis=0)
            best = paths.max(axis=0) + scores[t]
        path = np.empty((time, batch), np.int8)
        path[-1] = best.argmax(axis=0)
        columns = np.arange(batch)
        for t in range(time - 1, 0, -1):
            path[t - 1] = back[t, path[t], columns]
        return path

    # Learning

    def _crf(self, scores: np.ndarray, truth: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Mean loss of the true labels, and its gradients by emissions and transitions."""
        time, labels, batch = scores.shape
        step = self.weights["step"].astype(np.float64)
        power = np.exp(step)
        forward, backward = np.empty(scores.shape), np.zeros(scores.shape)

        def log_sum(x: np.ndarray, matrix: np.ndarray) -> np.ndarray:
            top = x.max(axis=0)
            return np.log(matrix @ np.exp(x - top)) + top

        forward[0] = scores[0]
        for t in range(1, time):
            forward[t] = log_sum(forward[t - 1], power.T) + scores[t]
        for t in range(time - 2, -1, -1):
            backward[t] = log_sum(backward[t + 1] + scores[t + 1], power)
        top = forward[-1].max(axis=0)
        whole = np.log(np.exp(forward[-1] - top).sum(axis=0)) + top
        shares = np.exp(forward + backward - whole)
        hot = np.arange(labels)[None, :, None] == truth[:, None, :]
        ahead = np.exp(np.clip(backward[1:] + scores[1:] - whole / 2, -300, 300))
        behind = np.exp(np.clip(forward[:-1] - whole / 2, -300, 300))
        expected = np.einsum("tib,tjb->ij", behind, ahead) * power
        seen = np.zeros((labels, labels))
        np.add.at(seen, (truth[:-1].ravel(), truth[1:].ravel()), 1)
        score = (scores * hot).sum() + (seen * step).sum()
        loss = (whole.sum() - score) / batch
        return loss, ((shares - hot) / batch).astype(np.float32), (expected - seen) / batch

    def _back(self, side: str, symbols: np.ndarray, kept: list, errors: np.ndarray) -> dict:
        """Gradients of one direction; ``errors`` (time, hidden, batch) is by its states."""
        h_size = self.hidden
        own = self.weights[f"{side}_own"]
        by_own = np.zeros_like(own)
        by_z = np.empty((len(kept), 4 * h_size, symbols.shape[1]), np.float32)
        dh_next, dc_next = np.float32(0), np.float32(0)
        for t in range(len(kept) - 1, -1, -1):
            raw, z, before_h, before_c, c = kept[t]
            forget, write, show, new = (z[i * h_size : (i + 1) * h_size] for i in range(4))
            dh = errors[t] + dh_next
            dc = dh * show * (np.abs(c) < 1) + dc_next
            dz = by_z[t]
            dz[:h_size] = dc * before_c
            dz[h_size : 2 * h_size] = dc * new
            dz[2 * h_size : 3 * h_size] = dh * np.clip(c, -1, 1)
            dz[3 * h_size :] = dc * write
            inside = (raw[: 3 * h_size] > 0) & (raw[: 3 * h_size] < 1)
            dz[: 3 * h_size] *= 0.25 * inside
            dz[3 * h_size :] *= np.abs(raw[3 * h_size :]) < 1
            by_own += dz @ before_h.T
            dh_next, dc_next = own.T @ dz, dc * forget
        flat = by_z.transpose(1, 0, 2).reshape(4 * h_size, -1)
        hot = np.zeros((symbols.size, SYMBOLS), np.float32)
        hot[np.arange(symbols.size), symbols.ravel()] = 1
        return {f"{side}_in": flat @ hot, f"{side}_own": by_own}

    def gradients(self, symbols: np.ndarray, truth: np.ndarray) -> tuple[float, dict]:
        left, kept_left = self._run("left", symbols, True)
        right, kept_right = self._run("right", symbols[::-1], True)
        right = right[::-1]
        scores = np.matmul(self.weights["left_out"], left)
        scores += np.matmul(self.weights["right_out"], right)
        scores += self.weights["bias"]
        loss, by_scores, by_step = self._crf(scores, truth)
        found = {"bias": by_scores.sum(axis=(0, 2))[:, None], "step": by_step.astype(np.float32)}
        for side, states, kept in (("left", left, kept_left), ("right", right, kept_right)):
            found[f"{side}_out"] = np.einsum("tlb,thb->lh", by_scores, states)
            errors = np.matmul(self.weights[f"{side}_out"].T, by_scores)
            if side == "left":
                found |= self._back(side, symbols, kept, errors)
            else:
                found |= self._back(side, symbols[::-1], kept, errors[::-1])
        return loss, found


def fit(
    tagger: Tagger, symbols: np.ndarray, truth: np.ndarray, steps: int, batch: int, rate: float, seed: int = 11
) -> list[float]:
    """Adam with a falling rate on random batches of the columns; gives the losses."""
    random = np.random.default_rng(seed)
    first = {name: np.zeros_like(w) for name, w in tagger.weights.items()}
    second = {name: np.zeros_like(w) for name, w in tagger.weights.items()}
    losses = []
    for number in range(1, steps + 1):
        chosen = random.integers(0, symbols.shape[1], batch)
        loss, found = tagger.gradients(symbols[:, chosen], truth[:, chosen])
        losses.append(loss)
        now = rate * min(1.0, 2 * (1 - (number - 1) / steps))
        for name, gradient in found.items():
            gradient = np.clip(gradient, -1, 1)
            first[name] = 0.9 * first[name] + 0.1 * gradient
            second[name] = 0.99 * second[name] + 0.01 * gradient**2
            step = first[name] / (1 - 0.9**number) / (np.sqrt(second[name] / (1 - 0.99**number)) + 1e-6)
            tagger.weights[name] -= (now * step).astype(np.float32)
    return losses
