"""A bidirectional gated recurrent network over bytes, in numpy, trained by backpropagation through time.

A step reads two neighbouring bytes, each by its own table, and labels each of
the two positions by its own output, from the states of both directions.
Sequences are read whole. Inference runs many sequences of similar length side
by side, one matrix product a step, gate and direction.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Weights:
    """Weights of both directions and of the output; gates in the order update, reset, candidate."""

    embed: tuple[np.ndarray, np.ndarray]  # 512 x 3H: what the first and the second byte of a step add to the gates
    recur: tuple[np.ndarray, np.ndarray]  # H x 3H
    candidate_bias: tuple[np.ndarray, np.ndarray]  # H: inside the reset product
    out: np.ndarray  # 2H x 2 classes: of the first and of the second byte of a step
    out_bias: np.ndarray

    @property
    def classes(self) -> int:
        return len(self.out_bias) // 2


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(w: Weights, side: int, x: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States ``(T, B, H)`` of one direction over ``x`` ``(T, B, 2)``; with ``keep`` also what backpropagation needs."""
    embed, recur, bias = w.embed[side], w.recur[side], w.candidate_bias[side]
    steps, rows, _ = x.shape
    hidden = recur.shape[0]
    states = np.empty((steps, rows, hidden), np.float32)
    h = np.zeros((rows, hidden), np.float32)
    full = mask.all(axis=1)
    tape = []
    gates, pre = np.empty((rows, 3 * hidden), np.float32), np.empty((rows, 3 * hidden), np.float32)
    for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
        np.add(embed[x[t, :, 0]], embed[x[t, :, 1]], out=pre)
        np.matmul(h, recur, out=gates)
        zr = pre[:, : 2 * hidden] + gates[:, : 2 * hidden]
        zr *= 0.5
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        z, r = zr[:, :hidden], zr[:, hidden:]
        inner = gates[:, 2 * hidden :] + bias
        n = np.tanh(pre[:, 2 * hidden :] + r * inner)
        new = n + z * (h - n)
        if not full[t]:
            new *= mask[t][:, None]
        if keep:
            tape.append((t, h, z, r, n, inner))
        states[t] = h = new
    return states, tape


def gate_tables(w: Weights) -> list[np.ndarray]:
    """For each direction what every pair of bytes adds to the gates, ``(3, 65536, H)``, halved where a sigmoid follows."""
    hidden = w.recur[0].shape[0]
    half = np.array([0.5, 0.5, 1.0], np.float32)[:, None, None]
    out = []
    for embed in w.embed:
        gates = embed.reshape(512, 3, hidden).transpose(1, 0, 2) * half
        out.append(np.ascontiguousarray((gates[:, :256, None] + gates[:, None, 256:]).reshape(3, 65536, hidden), np.float32))
    return out


def position_probabilities(w: Weights, x: np.ndarray, mask: np.ndarray, tables: list[np.ndarray] | None = None) -> np.ndarray:
    """Class probabilities ``(T, B, 2, classes)`` of every position, by step, sequence and byte of the step."""
    tables = tables or gate_tables(w)
    steps, rows, _ = x.shape
    hidden, wide = w.recur[0].shape[0], len(w.out_bias)
    logits = np.empty((steps, rows, wide), np.float32)
    mask = mask[:, :, 0]
    full = mask.all(axis=1)
    pairs = x[:, :, 0] * 256 + (x[:, :, 1] - 256)
    # Gates lie one after another, each contiguous, so that every step works on whole arrays.
    pre, gates = np.empty((3, rows, hidden), np.float32), np.empty((3, rows, hidden), np.float32)
    part = np.empty((rows, wide), np.float32)
    (z, r, n), (_, _, inner) = pre, gates
    # Halved gate weights turn the sigmoids into tanh without another product.
    half = np.array([0.5, 0.5, 1.0], np.float32)[:, None, None]
    for side in (0, 1):
        table = tables[side]
        recur = np.ascontiguousarray(w.recur[side].reshape(hidden, 3, hidden).transpose(1, 0, 2) * half)
        bias, out = w.candidate_bias[side], w.out[side * hidden : (side + 1) * hidden]
        h = np.zeros((rows, hidden), np.float32)
        for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
            for gate in range(3):
                np.take(table[gate], pairs[t], axis=0, out=pre[gate], mode="clip")
                np.matmul(h, recur[gate], out=gates[gate])
            pre[:2] += gates[:2]
            np.tanh(pre[:2], out=pre[:2])
            pre[:2] *= 0.5
            pre[:2] += 0.5
            inner += bias
            inner *= r
            n += inner
            np.tanh(n, out=n)
            h -= n
            h *= z
            h += n
            if not full[t]:
                h *= mask[t][:, None]
            if side == 0:
                np.matmul(h, out, out=logits[t])
            else:
                logits[t] += np.matmul(h, out, out=part)
    logits += w.out_bias
    np.clip(logits, -30, 30, out=logits)
    np.exp(logits, out=logits)
    flat = logits.reshape(-1, w.classes)
    flat /= flat @ np.ones((w.classes, 1), np.float32)
    return logits.reshape(steps, rows, 2, w.classes)


def _gradients(w: Weights, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross entropy of the positions and its gradient by every weight."""
    steps_mask = mask[:, :, 0]
    (forward, tape_f), (backward, tape_b) = _run(w, 0, x, steps_mask, True), _run(w, 1, x, steps_mask, True)
    both = np.concatenate([forward, backward], axis=2)
    steps, rows, _ = both.shape
    hidden = w.recur[0].shape[0]
    states = both.reshape(steps * rows, -1)
    logits = (states @ w.out + w.out_bias).reshape(steps * rows * 2, -1)
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=1, keepdims=True)
    weight = (mask / mask.sum()).reshape(-1).astype(np.float32)
    at = np.arange(steps * rows * 2), np.tile(np.repeat(y, 2), steps)
    loss = float(-(np.log(p[at] + 1e-9) * weight).sum())
    p[at] -= 1
    p *= weight[:, None]
    p = p.reshape(steps * rows, -1)
    d_out, d_out_bias = states.T @ p, p.sum(axis=0)
    d_both = (p @ w.out.T).reshape(both.shape)
    grads: list[np.ndarray] = []
    for side, tape in ((0, tape_f), (1, tape_b)):
        d_embed = np.zeros_like(w.embed[side])
        d_recur = np.zeros_like(w.recur[side])
        d_bias = np.zeros_like(w.candidate_bias[side])
        d_pre = np.empty((steps, rows, 3 * hidden), both.dtype)
        carried = np.zeros((rows, hidden), np.float32)
        for t, h, z, r, n, inner in reversed(tape):
            d_h = (d_both[t, :, side * hidden : (side + 1) * hidden] + carried) * steps_mask[t][:, None]
            d_n = d_h * (1 - z) * (1 - n * n)
            d_z = d_h * (h - n) * z * (1 - z)
            d_r = d_n * inner * r * (1 - r)
            d_inner = d_n * r
            d_pre[t] = np.concatenate([d_z, d_r, d_n], axis=1)
            rec = np.concatenate([d_z, d_r, d_inner], axis=1)
            d_recur += h.T @ rec
            d_bias += d_inner.sum(axis=0)
            carried = d_h * z + rec @ w.recur[side].T
        # The rows of one byte are brought together and summed in one go.
        flat = d_pre.reshape(steps * rows, -1)
        for byte in (0, 1):
            read = x[:, :, byte].reshape(-1)
            order = np.argsort(read, kind="stable")
            seen, starts = np.unique(read[order], return_index=True)
            d_embed[seen] += np.add.reduceat(flat[order], starts, axis=0)
        grads += [d_embed, d_recur, d_bias]
    return loss, [*grads, d_out, d_out_bias]


def pack(sequences: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(x, mask)``, both ``(T, B, 2)``: bytes padded with 0, and 1 where there is a byte; a step's first byte is there if the step is."""
    lengths = np.array([len(s) for s in sequences])
    steps = max(1, int(lengths.max() + 1) // 2)
    x = np.frombuffer(b"".join(s.ljust(2 * steps, b"\0") for s in sequences), np.uint8).reshape(len(sequences), steps, 2)
    x = np.ascontiguousarray(x.transpose(1, 0, 2).astype(np.intp)) + np.array([0, 256])
    spots = 2 * np.arange(steps)[:, None, None] + np.arange(2)
    return x, (spots < lengths[None, :, None]).astype(np.float32)


def train(sequences: list[bytes], labels: np.ndarray, classes: int, hidden: int = 32, epochs: int = 12, batch: int = 64, span: int = 96, rate: float = 0.02, seed: int = 7, noise: float = 0.02, start: Weights | None = None) -> Weights:
    """Weights fitted by Adam on random spans of the sequences, with a few bytes replaced at random, from ``start`` on if given."""
    rng = np.random.default_rng(seed)
    scale = 1 / np.sqrt(hidden)
    shapes = [(512, 3 * hidden), (hidden, 3 * hidden), (hidden,)] * 2 + [(2 * hidden, 2 * classes), (2 * classes,)]
    values = [(rng.normal(0, scale, s) if len(s) > 1 else np.zeros(s)).astype(np.float32) for s in shapes]
    if start:
        values = [v.copy() for side in zip(start.embed, start.recur, start.candidate_bias, strict=True) for v in side] + [start.out.copy(), start.out_bias.copy()]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    step, total = 0, epochs * max(1, -(-len(sequences) // batch))
    for _ in range(epochs):
        order = rng.permutation(len(sequences))
        for k in range(0, len(order), batch):
            picked = []
            for n in order[k : k + batch]:
                s = sequences[n]
                begin = int(rng.integers(0, max(1, len(s) - span // 2)))
                piece = bytearray(s[begin : begin + int(rng.integers(span // 2, span + 1))] or b" ")
                for spot in np.flatnonzero(rng.random(len(piece)) < noise):
                    piece[spot] = int(rng.integers(32, 127))
                picked.append(bytes(piece))
            x, mask = pack(picked)
            _, grads = _gradients(as_weights(values), x, mask, labels[order[k : k + batch]])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            step += 1
            speed = rate * (1 - step / (total + 1)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for v, g, m, s2 in zip(values, grads, first, second, strict=True):
                g = g * min(1.0, 1.0 / (norm + 1e-6))
                m += 0.1 * (g - m)
                s2 += 0.001 * (g * g - s2)
                v -= speed * m / (np.sqrt(s2) + 1e-8)
    return as_weights(values)


def as_weights(values: list[np.ndarray]) -> Weights:
    """Weights from their list: embedding, recurrence and bias of each direction, then the output's."""
    return Weights((values[0], values[3]), (values[1], values[4]), (values[2], values[5]), values[6], values[7])


def pooled_probabilities(w: Weights, sequences: list[bytes], rows: int = 1024, cells: int = 1024 * 160, tables: list[np.ndarray] | None = None) -> np.ndarray:
    """The mean class probability over the positions of every sequence, ``(len(sequences), classes)``; uniform for an empty one.

    At most ``rows`` sequences, and where they are long so many that they have
    ``cells`` steps, are run side by side.
    """
    tables = tables or gate_tables(w)
    out = np.full((len(sequences), w.classes), 1 / w.classes)
    parts = sorted((len(s), n) for n, s in enumerate(sequences) if s)
    begin = 0
    while begin < len(parts):
        # Sequences of one run differ little in length, so that little of it is padding.
        limit = parts[begin][0] * 1.15 + 4
        end = begin + 1
        while end < len(parts) and parts[end][0] <= limit and (end - begin + 1) * (parts[end][0] // 2 + 1) <= cells and end - begin < rows:
            end += 1
        owners = [n for _, n in parts[begin:end]]
        x, mask = pack([sequences[n] for n in owners])
        p = position_probabilities(w, x, mask, tables)
        if not mask.all():
            p *= mask[..., None]
        out[owners] = p.sum(axis=(0, 2)) / mask.sum(axis=(0, 2))[:, None]
        begin = end
    return out
