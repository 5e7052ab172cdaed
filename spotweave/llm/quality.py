"""Quality classifier: random Fourier features over document statistics, ridge by summed normal equations, isotonic calibration.

Statistics are computed over whole texts.  Each task sums Z'Z and Z'y of its
training rows; the sums (a fixed size) are added up and solved on the driver.
A held-back fifth of the training rows calibrates raw scores by pooling
adjacent violators over a fixed grid of score bins.

Edge cases: null and empty texts have all-zero statistics and get the model's
score for them; labels other than 0 and 1, and rows without a label, take no
part in training; without both classes every document scores 0.5; an empty
table gives no rows; repeated rows get equal scores; of several labels of a
doc_id the least counts; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.llm import text as tx
from spotweave.llm.common import bounded, written

#: Labelled rows that training reads at most; more are thinned by a hash of doc_id.
TRAIN_ROWS = 400_000
#: Random features, their kernel width in units of sqrt(number of statistics), ridge penalty per row.
FEATURES, WIDTH, RIDGE = 384, 0.6, 1e-4
#: Tasks that sum the normal equations, and bins of the calibration grid on [-1, 2].
SUM_TASKS, BINS = 16, 3000
REJECT_BELOW = 0.3

#: Byte classes; every other ASCII byte is 0.
CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\v\f", "\n", ".,;:", "!?", "#$%&*+=@^~\\{}[]_", "|<>/", "'\"()-`"]
_CLASS = np.zeros(256, np.int64)
for _k, _chars in enumerate(CLASSES):
    for _c in _chars:
        _CLASS[ord(_c)] = _k + 1
_CLASS[128:] = len(CLASSES) + 1
N_CLASSES = len(CLASSES) + 2
NAMES = ["log_bytes", "log_words", "word_mean", "word_sd", "word_max", "upper", "digit", "blank", "line", "stop", "bang", "symbol", "bar", "quote", "wide", "distinct", "twice", "alternate", "one_byte", "long_word", "stop_per_word", "top_word"]


def statistics(col: pa.Array) -> np.ndarray:
    """One row of statistics for each text."""
    data, off = tx.raw(col)
    rows = len(col)
    bytes_ = np.diff(off).astype(np.float64)
    owner = np.repeat(np.arange(rows), np.diff(off))
    cls = np.bincount(owner * N_CLASSES + _CLASS[data], minlength=rows * N_CLASSES).reshape(rows, N_CLASSES)
    share = cls / np.maximum(bytes_, 1)[:, None]
    words, first = tx.word_hashes(data, off)
    n = np.diff(first).astype(np.float64)
    per = np.maximum(n, 1)
    row = np.repeat(np.arange(rows), np.diff(first))
    gap = tx.GAP[data]
    if len(data):
        begin = np.concatenate(([True], gap[:-1]))
        begin[off[:-1][off[:-1] < len(data)]] = True
        starts = np.flatnonzero(begin & ~gap)
        stop = np.concatenate((gap[1:], [True]))
        stop[off[1:][off[1:] > 0] - 1] = True
        size = (np.flatnonzero(stop & ~gap) + 1 - starts).astype(np.float64)
    else:
        size = np.zeros(0)
    sums = lambda x: np.bincount(row, x, rows)
    mean = sums(size) / per
    sd = np.sqrt(np.maximum(sums(size**2) / per - mean**2, 0))
    longest = np.zeros(rows)
    np.maximum.at(longest, row, size)
    twice = np.zeros(len(words))
    other = np.zeros(len(words))
    if len(words) > 2:
        twice[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
        other[2:] = (words[2:] == words[:-2]) & (row[2:] == row[:-2])
    distinct, top = np.zeros(rows), np.zeros(rows)
    for i in range(rows):
        if n[i]:
            own = np.sort(words[first[i] : first[i + 1]])
            edge = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1], [True])))
            distinct[i], top[i] = len(edge) - 1, np.diff(edge).max()
    out = np.column_stack(
        [
            np.log1p(bytes_), np.log1p(n), mean, sd, np.log1p(longest), share[:, 2], share[:, 3], share[:, 4], share[:, 5], share[:, 6],
            np.sqrt(share[:, 7]), np.sqrt(share[:, 8]), np.sqrt(share[:, 9]), np.sqrt(share[:, 10]), share[:, 11],
            distinct / per, np.sqrt(sums(twice) / per), np.sqrt(sums(other) / per), sums(size == 1) / per, np.sqrt(sums(size >= 20) / per), cls[:, 6] / per, np.sqrt(top / per),
        ]
    )
    return np.where(bytes_[:, None] > 0, out, 0.0)


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, tid, stats array<float>) for each row; ``tid`` is a hash of the text, which tells rows of one doc_id apart."""

    def make(batches):
        for batch in tx.text_slices(batches, "text"):
            x = statistics(batch.column("text")).astype(np.float32)
            stats = pa.ListArray.from_arrays(
                pa.array(np.arange(0, x.size + 1, len(NAMES), dtype=np.int32)), pa.array(x.ravel())
            )
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("tid"), stats], ["doc_id", "tid", "stats"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("tid")).mapInArrow(make, "doc_id long, tid long, stats array<float>")


@dataclass
class QualityModel:
    """A fitted classifier; ``score`` maps statistics to calibrated probabilities."""

    centre: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def lift(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.centre) / self.scale, -6, 6)
        return np.column_stack((np.sqrt(2 / len(self.phase)) * np.cos(x @ self.omega + self.phase), np.ones(len(x))))

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.lift(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = self.raw(stats)
        if not len(self.knots):
            return np.full(len(raw), 0.5)
        # A thousandth of the raw score keeps documents of one step apart.
        return np.clip(0.999 * np.interp(raw, self.knots, self.levels) + 0.001 / (1 + np.exp(-4 * (raw - 0.5))), 0, 1)


def isotonic(at: np.ndarray, weight: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; returns (centre of each block, its level)."""
    blocks: list[list[float]] = []
    for x, w, y in zip(at, weight, mean, strict=True):
        blocks.append([x * w, w, y * w])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    b = np.array(blocks).reshape(-1, 3)
    return b[:, 0] / b[:, 1], b[:, 2] / b[:, 1]


def _stack(col: pd.Series) -> np.ndarray:
    return np.array(col.tolist(), dtype=np.float64).reshape(len(col), len(NAMES))


def fit(rows: DataFrame, seed: int = 7) -> QualityModel:
    """Fit on rows (stats, y, part): parts 1-3 give the normal equations, part 4 the calibration."""
    rng = np.random.default_rng(seed)
    d = len(NAMES)
    model = QualityModel(
        np.zeros(d), np.ones(d), rng.normal(0, 1 / (WIDTH * np.sqrt(d)), (d, FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.zeros(0), np.zeros(0)
    )
    # ``rows`` are a written table of TRAIN_ROWS at most: few tasks read them, and few sums are moved.
    train = rows.where("part < 4").coalesce(SUM_TASKS)

    def moments(batches):
        total = np.zeros((2, d))
        n = np.zeros(3)
        for p in batches:
            if len(p):
                x = _stack(p["stats"])
                total += [x.sum(0), (x**2).sum(0)]
                n += [len(p), p["y"].sum(), 0]
        yield pd.DataFrame({"m": [np.concatenate((n, total.ravel())).tolist()]})

    got = [r["m"] for r in train.mapInPandas(moments, "m array<double>").collect()]
    m = np.sum(got, axis=0) if got else np.zeros(3 + 2 * d)
    if not 0 < m[1] < m[0]:
        return model
    model.centre = m[3 : 3 + d] / m[0]
    model.scale = np.sqrt(np.maximum(m[3 + d :] / m[0] - model.centre**2, 0)) + 1e-6

    def equations(batches):
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for p in batches:
            for at in range(0, len(p), 2000):
                part = p.iloc[at : at + 2000]
                z = model.lift(_stack(part["stats"]))
                total += z.T @ np.column_stack((z, part["y"].to_numpy(np.float64)))
        yield pd.DataFrame({"i": np.arange(FEATURES + 1), "v": list(total)})

    def add(p):
        return pd.DataFrame({"i": p["i"].iloc[:1], "v": [np.sum(p["v"].tolist(), axis=0)]})

    summed = train.mapInPandas(equations, "i int, v array<double>").groupBy("i").applyInPandas(add, "i int, v array<double>").toPandas().sort_values("i")
    total = np.array(summed["v"].tolist())
    penalty = np.eye(FEATURES + 1) * RIDGE * m[0]
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(total[:, :-1] + penalty, total[:, -1])

    def bins(batches):
        for p in batches:
            if len(p):
                b = np.clip(np.round(model.raw(_stack(p["stats"])) * BINS / 3), -BINS // 3, 2 * BINS // 3).astype(int)
                yield pd.DataFrame({"b": b, "y": p["y"].to_numpy(np.float64)})

    held = rows.where("part = 4").mapInPandas(bins, "b int, y double").groupBy("b").agg(F.count("*").alias("n"), F.avg("y").alias("y")).orderBy("b").toPandas()
    if not len(held):
        held = pd.DataFrame({"b": [0, BINS // 3], "n": [1, 1], "y": [0.0, 1.0]})
    model.knots, model.levels = isotonic(held["b"].to_numpy() * 3 / BINS, held["n"].to_numpy(np.float64), held["y"].to_numpy())
    return model


def remainder(doc_id):
    """crc32 of doc_id as text, modulo 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(1)).cast("int")


def _scored(docs: DataFrame, labels: DataFrame, reject_below: float) -> DataFrame:
    """(doc_id, tid, held_out, score, predicted) for each row of ``docs``."""
    stats = written(document_statistics(docs), "statistics")
    y = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("double").alias("y"))
    rows = stats.join(y, "doc_id").withColumn("part", remainder(F.col("doc_id"))).where("part <> 0")
    n = rows.count()
    if n > TRAIN_ROWS:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(1_000_003 * TRAIN_ROWS / n))
    model = fit(written(rows.select("stats", "y", "part"), "training"))

    def predict(batches):
        for batch in batches:
            stats = batch.column("stats")
            x = stats.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "tid", "held_out")), pa.array(model.score(x))], ["doc_id", "tid", "held_out", "score"]
            )

    return (
        stats.withColumn("held_out", remainder(F.col("doc_id")) == 0)
        .select("doc_id", "tid", "held_out", "stats")
        .mapInArrow(predict, "doc_id long, tid long, held_out boolean, score double")
        .withColumn("predicted", (F.col("score") >= reject_below).cast("int"))
    )


def score_documents(docs: DataFrame, labels: DataFrame, reject_below: float = REJECT_BELOW) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``; learns only from rows that aren't held out."""
    return _scored(docs, labels, reject_below).drop("tid")


def keep_good(docs: DataFrame, labels: DataFrame, reject_below: float = REJECT_BELOW) -> DataFrame:
    """``docs`` without the rows that the classifier rejects.

    Rows are told apart by doc_id and text: each goes or stays by its own text, whatever others share its doc_id or lack one.
    """
    bad = _scored(docs, labels, reject_below).where("predicted = 0").select(F.col("doc_id").alias("bad_id"), F.col("tid").alias("bad_tid")).distinct()
    d, b = docs.alias("d"), bounded(written(bad, "rejected")).alias("b")
    on = F.col("d.doc_id").cast("long").eqNullSafe(F.col("b.bad_id")) & (F.xxhash64("d.text") == F.col("b.bad_tid"))
    return d.join(b, on, "left_anti").select([F.col(f"d.`{c}`") for c in docs.columns])
