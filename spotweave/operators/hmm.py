"""Two-state hidden Markov model over windowed coverage: transcribed regions.

Emissions are gamma densities of counts + 1.  Parameters are fitted by
Baum-Welch on all tracks; the sums a step needs are a few numbers a track, so
a step is one grouped pass and a small collect.  Regions are runs of the
Viterbi path.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.sources.scratch import written

# Window, log probabilities of leaving a state, shape of the background, stop of the fit.
SIZE, LEAVE_OFF, LEAVE_ON, BACKGROUND, STOP = 50, -5.0, -200.0, 5.0, 0.1


@dataclass
class Model:
    shape: np.ndarray
    scale: np.ndarray
    trans: np.ndarray
    start: np.ndarray

    @classmethod
    def initial(cls) -> Model:
        off, on = math.log1p(-math.exp(LEAVE_OFF)), math.log1p(-math.exp(LEAVE_ON))
        return cls(np.array([BACKGROUND, 0.5]), np.array([1 / BACKGROUND, 10.0]), np.array([[off, LEAVE_OFF], [LEAVE_ON, on]]), np.array([0.0, -np.inf]))

    def emissions(self, x: np.ndarray) -> np.ndarray:
        lg = np.array([math.lgamma(k) for k in self.shape])
        return (self.shape - 1) * np.log(x)[:, None] - x[:, None] / self.scale - lg - self.shape * np.log(self.scale)


def windows(reads: DataFrame, size: int = SIZE) -> DataFrame:
    """(chrom, strand, bin, n): reads that start in each window."""
    return reads.groupBy("chrom", "strand", F.floor(F.col("start") / size).alias("bin")).agg(F.count("*").alias("n"))


def _track(p: pd.DataFrame) -> np.ndarray:
    out = np.ones(int(p["bin"].max()) + 1)
    out[p["bin"].to_numpy(int)] += p["n"].to_numpy(float)
    return out


def scan(start: np.ndarray, steps: np.ndarray, plus) -> np.ndarray:
    """Vectors v[t] = v[t - 1] x steps[t], v[-1] = start, where x multiplies by + and adds by ``plus``.

    The steps are cut into about sqrt(n) blocks: products within all blocks
    at once, then from block to block, so few array operations do the work of
    a loop over n.
    """
    n = len(steps)
    size = max(1, math.isqrt(n))
    blocks = -(-n // size)
    one = np.array([[0.0, -np.inf], [-np.inf, 0.0]])
    padded = np.broadcast_to(one, (blocks * size, 2, 2)).copy()
    padded[:n] = steps
    padded = padded.reshape(blocks, size, 2, 2)
    products = np.empty((size, blocks, 2, 2))
    now = np.broadcast_to(one, (blocks, 2, 2))
    for k in range(size):
        step = padded[:, k]
        now = plus(now[:, :, 0, None] + step[:, None, 0, :], now[:, :, 1, None] + step[:, None, 1, :])
        products[k] = now
    begin = np.empty((blocks, 2))
    v = start
    for b in range(blocks):
        begin[b] = v
        v = plus(v[0] + now[b, 0], v[1] + now[b, 1])
    out = plus(begin[None, :, 0, None] + products[:, :, 0], begin[None, :, 1, None] + products[:, :, 1])
    return out.transpose(1, 0, 2).reshape(-1, 2)[:n]


def forward_backward(model: Model, x: np.ndarray):
    """(log likelihood, posteriors, expected transitions)."""
    e = model.emissions(x)
    n = len(x)
    steps = model.trans[None] + e[1:, None, :]
    f = np.vstack(((model.start + e[0])[None], scan(model.start + e[0], steps, np.logaddexp)))
    back = scan(np.zeros(2), steps[::-1].transpose(0, 2, 1), np.logaddexp)[::-1]
    b = np.vstack((back, np.zeros((1, 2))))
    total = np.logaddexp(*f[-1])
    moves = np.exp(f[:-1, :, None] + model.trans[None] + (e[1:] + b[1:])[:, None, :] - total).sum(0) if n > 1 else np.zeros((2, 2))
    return total, np.exp(f + b - total), moves


def viterbi(model: Model, x: np.ndarray) -> np.ndarray:
    """The likeliest states; of equally likely ways the one through state 0."""
    e = model.emissions(x)
    v = np.vstack(((model.start + e[0])[None], scan(model.start + e[0], model.trans[None] + e[1:, None, :], np.maximum)))
    back = (v[:-1, :, None] + model.trans[None]).argmax(1)  # [t, state at t + 1] = state at t
    path = np.zeros(len(x), np.int8)
    path[-1] = v[-1].argmax()
    fixed, swaps = back[:, 0] == back[:, 1], (back[:, 0] == 1) & (back[:, 1] == 0)
    path[:-1][fixed] = back[fixed, 0]
    # Everywhere else a state comes from itself: it is that of the next place that doesn't.
    known = np.append(np.flatnonzero(fixed | swaps), len(x) - 1)
    after = known[np.searchsorted(known, np.arange(len(x)))]
    for t in np.flatnonzero(swaps)[::-1]:
        path[t] = 1 - path[after[t + 1]]
    return path[after]


def _gamma(weight: float, total: float, logs: float, shape: float) -> tuple[float, float]:
    """Shape and scale of the weighted maximum likelihood, by Minka's fixed-point start and a few Newton steps."""
    mean = total / weight
    s = math.log(mean) - logs / weight
    if s <= 1e-9:
        return shape, mean / shape
    k = (3 - s + math.sqrt((s - 3) ** 2 + 24 * s)) / (12 * s)
    return k, mean / k


def _expectation(model: Model):
    def expect(p: pd.DataFrame) -> pd.DataFrame:
        x = _track(p)
        total, post, steps = forward_backward(model, x)
        sums = np.column_stack((post.sum(0), (post * x[:, None]).sum(0), (post * np.log(x)[:, None]).sum(0)))
        return pd.DataFrame({"v": [[total, *sums.ravel(), *steps.ravel()]]})

    return expect


def fit(tracks: DataFrame, rounds: int = 50) -> Model:
    """Baum-Welch until the log likelihood gains less than STOP."""
    model, before = Model.initial(), -math.inf
    tracks = written(tracks, "tracks")
    for _ in range(rounds):

        got = tracks.groupBy("chrom", "strand").applyInPandas(_expectation(model), "v array<double>")
        m = np.array(got.select(F.array(*[F.sum(F.col("v")[i]) for i in range(11)]).alias("s")).first()["s"] or [0.0] * 11, float)
        if not np.isfinite(m).all() or m[0] - before < STOP:
            break
        before = m[0]
        sums, steps = m[1:7].reshape(2, 3), m[7:].reshape(2, 2)
        fitted = [_gamma(*sums[i], model.shape[i]) if sums[i, 0] > 1e-6 else (model.shape[i], model.scale[i]) for i in range(2)]
        with np.errstate(divide="ignore"):
            rows = steps.sum(1, keepdims=True)
            trans = np.where(rows > 1e-9, np.log(np.maximum(steps / np.maximum(rows, 1e-300), 1e-300)), model.trans)
        model = Model(np.array([f[0] for f in fitted]), np.array([f[1] for f in fitted]), trans, model.start)
    return model


def transcribed_regions(reads: DataFrame, size: int = SIZE, model: Model | None = None) -> DataFrame:
    """(chrom, strand, start, end) of transcribed runs."""
    tracks = windows(reads, size)
    model = model or fit(tracks)

    def runs(p):
        path = viterbi(model, _track(p))
        edge = np.diff(np.concatenate(([0], path, [0])))
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        return pd.DataFrame({"chrom": p["chrom"].iloc[0], "strand": p["strand"].iloc[0], "start": a * size, "end": b * size})

    return tracks.groupBy("chrom", "strand").applyInPandas(runs, "chrom string, strand string, start long, end long")
