"""A character-level bidirectional LSTM with a conditional random field, trained and run in numpy.

Gates squash by x / (1 + |x|) instead of the exponential forms, which numpy
computes several times faster.  All windows of a batch move through a position
together, both directions at once.
"""

from __future__ import annotations

import numpy as np

#: Tags: 0 is outside; kind k begins with 2k + 1, after a place outside, and goes on with 2k + 2.
OUTSIDE = 0
#: Letters apart from case, one class each for digits, other letters, line ends, other gaps and the padding; other ASCII by itself.
PAD, OTHER = 0, 1
CLASSES = np.full(129, OTHER, np.uint8)
CLASSES[ord("a") : ord("z") + 1] = CLASSES[ord("A") : ord("Z") + 1] = np.arange(2, 28)
CLASSES[ord("0") : ord("9") + 1] = 28
CLASSES[[9, 32]] = 29
CLASSES[[10, 11, 12, 13]] = 30
_MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]
CLASSES[_MARKS] = np.arange(31, 31 + len(_MARKS))
N_CLASSES = 31 + len(_MARKS)
NEVER = -1e4
#: Numbers that stand for a class.
DEPTH = 8


def classes(text: str) -> np.ndarray:
    """The class of each code point."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return CLASSES[np.minimum(points, 128)]


def _squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


class Tagger:
    """Weights: ``chars`` (class, DEPTH), ``inp`` (direction, DEPTH and a constant, 4 gates of ``hidden``), ``loop``, ``out``, ``bias`` and ``trans`` (from, to)."""

    def __init__(self, kinds: int, hidden: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.kinds, self.hidden, self.tags = kinds, hidden, 2 * kinds + 1
        f = np.float32
        self.chars = rng.normal(size=(N_CLASSES, DEPTH)).astype(f)
        self.inp = (rng.normal(size=(2, DEPTH + 1, 4 * hidden)) / np.sqrt(DEPTH)).astype(f)
        self.inp[:, DEPTH, hidden : 2 * hidden] += 1  # states last at first
        self.loop = (rng.normal(size=(2, hidden, 4 * hidden)) / np.sqrt(hidden)).astype(f)
        self.out = (rng.normal(size=(2, hidden, self.tags)) / np.sqrt(hidden)).astype(f)
        self.bias = np.zeros(self.tags, f)
        self.trans = np.zeros((self.tags, self.tags), f)
        self.allowed = np.ones((self.tags, self.tags), bool)
        for k in range(kinds):
            self.allowed[:, 2 * k + 2] = False
            self.allowed[1:, 2 * k + 1] = False
            self.allowed[[2 * k + 1, 2 * k + 2], 2 * k + 2] = True

    def weights(self) -> list[np.ndarray]:
        return [self.chars, self.inp, self.loop, self.out, self.bias, self.trans]

    def moves(self) -> np.ndarray:
        return np.where(self.allowed, self.trans, np.float32(NEVER))

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        """(position, DEPTH and two, window): the numbers of each class, a constant, and a mark of padding."""
        every = np.zeros((N_CLASSES, DEPTH + 2), np.float32)
        every[:, :DEPTH], every[:, DEPTH] = self.chars, 1
        every[PAD] = np.arange(DEPTH + 2) == DEPTH + 1
        return np.ascontiguousarray(every[x.T].transpose(0, 2, 1))

    def _mixed(self) -> np.ndarray:
        """(direction, 4 gates, inputs and hidden states).  Padding shuts the gates of input and memory: behind it a direction starts anew, however long it is."""
        shut = np.zeros((2, 1, 4 * self.hidden), np.float32)
        shut[:, :, : 2 * self.hidden] = -1e30
        return np.ascontiguousarray(np.concatenate((self.inp, shut, self.loop), 1).transpose(0, 2, 1))

    def states(self, x: np.ndarray, keep: bool = False):
        """Hidden states (direction, position, hidden, window), each direction in its own order; ``keep`` adds gates and cells."""
        n, length = x.shape
        h = self.hidden
        inputs, mixed = self._inputs(x), self._mixed()
        all_h = np.empty((2, length, h, n), np.float32)
        both = np.zeros((2, DEPTH + 2 + h, n), np.float32)
        hid = both[:, DEPTH + 2 :]
        cell = np.zeros((2, h, n), np.float32)
        gates, size = np.empty((2, 4 * h, n), np.float32), np.empty((2, 4 * h, n), np.float32)
        flat, more = np.empty((2, h, n), np.float32), np.empty((2, h, n), np.float32)
        kept = [] if keep else None
        for t in range(length):
            both[0, : DEPTH + 2], both[1, : DEPTH + 2] = inputs[t], inputs[length - 1 - t]
            np.matmul(mixed, both, out=gates)
            np.abs(gates, out=size)
            size += 1
            gates /= size
            # The gates are (1 + y) / 2 of these y; the halves are taken once, on the products.
            gates[:, : 3 * h] += 1
            if keep:
                kept.append([gates.copy(), cell.copy()])
            cell *= gates[:, h : 2 * h]
            np.multiply(gates[:, :h], gates[:, 3 * h :], out=more)
            cell += more
            cell *= 0.5
            np.abs(cell, out=flat)
            flat += 1
            np.divide(cell, flat, out=flat)
            np.multiply(gates[:, 2 * h : 3 * h], flat, out=hid)
            hid *= 0.5
            all_h[:, t] = hid
            if keep:
                kept[-1][0][:, : 3 * h] *= 0.5
                kept[-1].append(flat.copy())
        return (all_h, kept) if keep else all_h

    def emissions(self, x: np.ndarray, all_h: np.ndarray | None = None) -> np.ndarray:
        """(position, tag, window); padding is outside."""
        if all_h is None:
            all_h = self.states(x)
        e = self.out[0].T @ all_h[0]
        e += self.out[1].T @ all_h[1][::-1]
        e += self.bias[:, None]
        if (x == PAD).any():
            pad = (x == PAD).T
            e[:, 1:][np.broadcast_to(pad[:, None], e[:, 1:].shape)] = NEVER
            e[:, OUTSIDE][pad] = 0
        return e

    def _open(self, e: np.ndarray, moves: np.ndarray) -> np.ndarray:
        """(position, window): places that a best path may tag.

        On a best path no span can gain by staying outside instead.  So only places in some span count, of any
        one kind, that is worth more than that.
        """
        begin = np.arange(1, self.tags, 2)
        out = e[:, OUTSIDE][:, None]
        stay = moves[OUTSIDE, OUTSIDE]
        enter = moves[OUTSIDE, begin] - stay
        on = np.maximum(moves[begin, begin + 1], moves[begin + 1, begin + 1]) - stay
        leave = np.maximum(moves[begin, OUTSIDE], moves[begin + 1, OUTSIDE]) - stay
        first = e[:, begin] - out + enter[:, None]
        more = e[:, begin + 1] - out + on[:, None]
        # A window may start inside a span.
        first[0] = np.maximum(first[0], np.maximum(e[0, begin], e[0, begin + 1]) - out[0])
        left, right = first.copy(), np.zeros_like(first)
        for t in range(1, len(e)):
            np.maximum(left[t], left[t - 1] + more[t], out=left[t])
        for t in range(len(e) - 2, -1, -1):
            np.maximum(right[t + 1] + more[t + 1], 0, out=right[t])
        # Numbers are rounded; at the window's end nothing follows.
        left += right
        return (left > -np.maximum(leave, 0)[:, None] - 1e-3).any(1)

    def decode(self, e: np.ndarray) -> list[tuple[int, int, int, int, float]]:
        """(window, from, to, kind, gain) of the spans on each window's best path; gain is over the path that stays outside."""
        moves = self.moves()
        # Between two places that stay outside for sure, a stretch is decoded by itself.
        maybe = np.zeros((e.shape[2], len(e) + 2), np.int8)
        maybe[:, 1:-1] = self._open(e, moves).T
        edge = np.diff(maybe, axis=1)
        rows, lo = np.nonzero(edge == 1)
        hi = np.nonzero(edge == -1)[1]
        order = np.argsort(hi - lo, kind="stable")
        wide = (hi - lo)[order]
        out, at = [], 0
        while at < len(order):
            # Stretches of about one length go together, of at most some 200,000 places.
            end = min(int(np.searchsorted(wide, wide[at] * 5 // 4 + 8, "right")), at + max(1, 200_000 // int(wide[at] * 5 // 4 + 8)))
            group = order[at:end]
            out += self._paths(e, moves, rows[group], lo[group], hi[group])
            at = end
        return sorted(out)

    def _paths(self, e: np.ndarray, moves: np.ndarray, rows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int, int, int, float]]:
        """The spans of the best paths from ``lo`` to ``hi`` of windows ``rows``, which are outside at the places on both sides."""
        length, tags, n = len(e), self.tags, len(rows)
        wide = int((hi - lo).max())
        places = lo[:, None] + np.arange(wide)
        own = e[np.minimum(places, length - 1), :, rows[:, None]]
        into = np.ascontiguousarray(moves.T)
        # A span may have begun before the window, but not before a later place.
        best = own[:, 0] + np.where((lo > 0)[:, None], moves[OUTSIDE], 0)
        steps = np.empty((wide, n, tags), np.intp)
        for t in range(1, wide):
            every = best[:, None, :] + into
            # A stretch that has ended waits for the others.
            here = (places[:, t] < hi)[:, None]
            steps[t] = np.where(here, every.argmax(2), np.arange(tags))
            best = np.where(here, every.max(2) + own[:, t], best)
        best = best + np.where((hi < length)[:, None], moves[:, OUTSIDE], 0)
        path = np.empty((n, wide), np.int64)
        path[:, -1] = best.argmax(1)
        at = np.arange(n)
        for t in range(wide - 1, 0, -1):
            path[:, t - 1] = steps[t, at, path[:, t]]
        path[places >= hi[:, None]] = OUTSIDE
        out = []
        for w in np.flatnonzero((path != OUTSIDE).any(1)):
            tag = path[w]
            for a in np.flatnonzero((tag != OUTSIDE) & ((np.arange(wide) == 0) | (tag % 2 == 1))).tolist():
                kind = (int(tag[a]) - 1) // 2
                b = a + 1
                while b < wide and tag[b] == 2 * kind + 2:
                    b += 1
                before = [OUTSIDE] if a + lo[w] else []
                steps_in = np.array(before + tag[a:b].tolist())
                gain = own[w, np.arange(a, b), tag[a:b]].sum() - own[w, a:b, OUTSIDE].sum() + moves[steps_in[:-1], steps_in[1:]].sum() - moves[OUTSIDE, OUTSIDE] * (len(steps_in) - 1)
                out.append((int(rows[w]), int(lo[w]) + a, int(lo[w]) + b, kind, float(gain)))
        return out

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """The mean negative log-likelihood of tags ``y`` for windows ``x``, and its gradients.

        Products are taken a position at a time: small ones, which numpy leaves to one thread.
        """
        n, length = x.shape
        h = self.hidden
        all_h, kept = self.states(x, keep=True)
        e = self.emissions(x, all_h).transpose(2, 0, 1).astype(np.float64)
        moves = self.moves().astype(np.float64)
        step = np.exp(moves)
        top = e.max(2, keepdims=True)
        emit = np.ascontiguousarray(np.exp(e - top).transpose(1, 0, 2))
        fwd, scale = np.empty((length, n, self.tags)), np.empty((length, n, 1))
        a = emit[0]
        for t in range(length):
            if t:
                a = (fwd[t - 1] @ step) * emit[t]
            scale[t] = a.sum(1, keepdims=True)
            np.divide(a, scale[t], out=fwd[t])
        bwd = np.ones((length, n, self.tags))
        back = np.ascontiguousarray(step.T)
        for t in range(length - 2, -1, -1):
            bwd[t] = ((bwd[t + 1] * emit[t + 1]) @ back) / scale[t + 1]
        rows = np.arange(n)[:, None]
        gold = e[rows, np.arange(length), y].sum() + moves[y[:, :-1], y[:, 1:]].sum()
        total = np.log(scale).sum() + top.sum()
        de = fwd * bwd
        de[np.arange(length)[:, None], rows.T, y.T] -= 1
        de[(x == PAD).T] = 0
        pairs = np.matmul(fwd[:-1].transpose(0, 2, 1), bwd[1:] * emit[1:] / scale[1:]).sum(0) * step
        pairs -= np.bincount((y[:, :-1] * self.tags + y[:, 1:]).ravel(), minlength=self.tags**2).reshape(self.tags, self.tags)
        d_trans = np.where(self.allowed, pairs, 0) / n
        de = np.ascontiguousarray((de / n).astype(np.float32).transpose(0, 2, 1))
        d_out = np.stack([np.matmul(all_h[k], d.transpose(0, 2, 1)).sum(0) for k, d in enumerate((de, de[::-1]))])
        d_h = np.stack((self.out[0] @ de, self.out[1] @ de[::-1]))
        d_gates = np.empty((length, 2, 4 * h, n), np.float32)
        next_h = next_c = np.zeros((2, h, n), np.float32)
        for t in range(length - 1, -1, -1):
            gates, before, flat = kept[t]
            d = d_gates[t]
            g = d_h[:, t] + next_h
            d_cell = g * gates[:, 2 * h : 3 * h] * (1 - np.abs(flat)) ** 2 + next_c
            slope = (1 - np.abs(2 * gates[:, : 3 * h] - 1)) ** 2
            slope *= 0.5
            d[:, :h] = d_cell * gates[:, 3 * h :]
            d[:, h : 2 * h] = d_cell * before
            d[:, 2 * h : 3 * h] = g * flat
            d[:, : 3 * h] *= slope
            d[:, 3 * h :] = d_cell * gates[:, :h] * (1 - np.abs(gates[:, 3 * h :])) ** 2
            next_c = d_cell * gates[:, h : 2 * h]
            next_h = self.loop @ d
        d_loop = np.stack([np.matmul(all_h[k, :-1], d_gates[1:, k].transpose(0, 2, 1)).sum(0) for k in range(2)])
        inputs = self._inputs(x)
        d_inp = np.stack([np.matmul(own[:, : DEPTH + 1], d_gates[:, k].transpose(0, 2, 1)).sum(0) for k, own in enumerate((inputs, inputs[::-1]))])
        d_chars = np.zeros_like(self.chars)
        own = (self.inp[0, :DEPTH] @ d_gates[:, 0] + (self.inp[1, :DEPTH] @ d_gates[:, 1])[::-1]).transpose(0, 2, 1).reshape(-1, DEPTH)
        at = x.T.reshape(-1)
        order = np.argsort(at, kind="stable")
        which, first = np.unique(at[order], return_index=True)
        d_chars[which] = np.add.reduceat(own[order], first)
        d_chars[PAD] = 0
        return float(total - gold) / n, [d_chars, d_inp, d_loop, d_out, de.sum((0, 2)), d_trans.astype(np.float32)]


def train(model: Tagger, x: np.ndarray, y: np.ndarray, steps: int, batch: int, rate: float = 0.02, seed: int = 3) -> Tagger:
    """Adam over random batches, with a rate that falls to a twentieth and gradients bounded in length."""
    rng = np.random.default_rng(seed)
    one = [np.zeros_like(w) for w in model.weights()]
    two = [np.zeros_like(w) for w in model.weights()]
    for s in range(1, steps + 1):
        at = rng.choice(len(x), min(batch, len(x)), replace=False)
        _, grads = model.loss(x[at], y[at])
        length = np.sqrt(sum(float((g.astype(np.float64) ** 2).sum()) for g in grads))
        now = rate * (0.05 + 0.95 * (1 - s / (steps + 1)))
        for w, g, m, v in zip(model.weights(), grads, one, two, strict=True):
            g = g * min(1.0, 5 / max(length, 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= now * (m / (1 - 0.9**s)) / (np.sqrt(v / (1 - 0.99**s)) + 1e-6)
    return model
