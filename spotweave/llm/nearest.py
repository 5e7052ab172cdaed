"""Approximate nearest neighbours by an inverted multi-index.

Unit vectors are cut in two halves; each half is quantised by its own k-means
codebook, fitted on a bounded, documented sample.  Every row is indexed under
its pair of centroids.  A query walks the pairs in order of summed distance
with a heap (the multi-sequence algorithm) until the visited cells hold enough
rows, and all entries of those cells are reranked by the exact cosine of the
original vectors in double precision.  How many rows are enough is measured on
the table itself: the part of the sample that has to be visited to find nearly
all neighbours within the sample.

Rows of a first-half centroid meet the queries that visit it in groups of at
most GROUP_ROWS rows and GROUP_QUERIES queries, so neither a crowded cell nor
a popular query lands in one task.

Edge cases: see ``vectors.valid`` for rows that take no part; fewer than k
candidates are all returned; ties go to the smaller vec_id; of rows that share
a vec_id each is a candidate, and a query where the id says so, with ranks of
its own; an empty table, or one without queries, gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotweave.llm.common import bounded, written
from spotweave.llm.vectors import matrix, valid

#: Rows of a cell, about, which give the number of centroids of a half, within bounds; rows that train them at most, rounds of k-means.
CELL_ROWS, FEWEST, MOST, TRAIN_ROWS, ROUNDS = 64, 4, 512, 20_000, 8
#: Neighbours within the sample that the visited part must hold, and the sampled queries that measure it.
RECALL, MEASURED = 0.94, 400
LEAST_CANDIDATES = 200
GROUP_ROWS, GROUP_QUERIES = 8192, 16_384


def kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        near = ((c**2).sum(1)[None, :] - 2 * x @ c.T).argmin(1)
        for i in range(len(c)):
            own = x[near == i]
            c[i] = own.mean(0) if len(own) else x[rng.integers(len(x))]
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x**2).sum(1)[:, None] + (c**2).sum(1)[None, :] - 2 * x @ c.T


def unit(x: np.ndarray) -> np.ndarray:
    # Scaling by the largest component first keeps huge and tiny vectors finite.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x**2).sum(1, keepdims=True))


def multi_sequence(a: np.ndarray, b: np.ndarray, counts: np.ndarray, want: int) -> list[tuple[int, int]]:
    """Pairs (i, j) in order of a[i] + b[j] until their cells hold ``want`` entries."""
    oa, ob = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    heap, seen, out, held = [(a[oa[0]] + b[ob[0]], 0, 0)], {(0, 0)}, [], 0
    while heap and held < want:
        _, i, j = heapq.heappop(heap)
        cell = (int(oa[i]), int(ob[j]))
        if counts[cell]:
            out.append(cell)
            held += int(counts[cell])
        for n in ((i + 1, j), (i, j + 1)):
            if n[0] < len(oa) and n[1] < len(ob) and n not in seen:
                seen.add(n)
                heapq.heappush(heap, (a[oa[n[0]]] + b[ob[n[1]]], *n))
    return out


def exact_cosine(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosines of q with each row of v; equal rows get equal values."""
    return np.clip((unit(v) * unit(q[None, :])).sum(1), -1, 1)


def cell_counts(c1: np.ndarray, c2: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    out = np.zeros(size, np.int64)
    np.add.at(out, (c1, c2), 1)
    return out


def measured_probe(u: np.ndarray, left: np.ndarray, right: np.ndarray, k: int, recall: float = RECALL) -> float:
    """The part of the sample ``u`` (unit rows) that queries must visit, cell by cell, to hold ``recall`` of their k nearest others."""
    half = left.shape[1]
    d1, d2 = distances(u[:, :half], left), distances(u[:, half:], right)
    c1, c2 = d1.argmin(1), d2.argmin(1)
    counts = cell_counts(c1, c2, (len(left), len(right)))
    seen = []
    for i in range(0, len(u), max(1, len(u) // MEASURED)):
        s = u @ u[i]
        s[i] = -2
        # A cell is reached when all of smaller sums have been, so no walk is needed here.
        sums = d1[i][:, None] + d2[i][None, :]
        seen += [counts[sums <= sums[c1[j], c2[j]]].sum() for j in np.argpartition(-s, min(k, len(u) - 1))[:k]]
    return float(np.quantile(seen, recall)) / len(u) if len(u) > k else 1.0


def query_blocks(queries: DataFrame, blocks: int):
    """The block of each query: those of one first half, or of neighbouring numbers of it, lie together, GROUP_QUERIES in a block, about."""
    if blocks == 1:
        return F.lit(0)
    counts = {r["c1"]: r["count"] for r in queries.groupBy("c1").count().collect()}
    many = np.array([counts.get(c, 0) for c in range(max(counts) + 1)])
    start = np.cumsum(many) - many
    at = lambda x: F.element_at(F.array(*[F.lit(int(v)) for v in x]), F.col("c1") + 1)
    # A crowded first half reaches over several blocks; which one is drawn by a hash.
    u = F.pmod(F.xxhash64("row"), F.lit(1 << 20)) / float(1 << 20)
    return F.least(F.floor((at(start) + u * at(many)) * blocks / int(many.sum())), F.lit(blocks - 1)).cast("int")


def entries_by_block(index: DataFrame, walks: DataFrame | None, split) -> DataFrame:
    """``index`` with ``part`` and ``block``: each entry once for every block of queries that visits its first half; without ``walks`` there is one block."""
    own = index.withColumn("part", F.pmod(F.xxhash64("row"), split).cast("int"))
    if walks is None:
        return own.withColumn("block", F.lit(0))
    visited = written(walks.select("c1", "block").distinct(), "visited")
    return own.join(bounded(visited), "c1").select(*own.columns, "block")


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, probe: float | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id is divisible by ``every``, its k nearest others by cosine.

    ``probe`` is the part of all rows that a query's cells must hold; by default it is measured.
    """
    spark = vectors.sparkSession
    rows = valid(vectors, zero=False)
    n = rows.count()
    share = min(1.0, TRAIN_ROWS / max(n, 1))
    sample = rows.where(F.pmod(F.xxhash64("row", "vec_id"), F.lit(1 << 30)) <= int(share * (1 << 30))).select("vec_id", "row", "v").orderBy("vec_id", "row").toPandas()
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    x = unit(matrix(sample["v"]))
    half = max(1, x.shape[1] // 2)
    if x.shape[1] == 1:
        x = np.column_stack((x, np.zeros(len(x))))
    many = int(min(MOST, max(FEWEST, (n / CELL_ROWS) ** 0.5)))
    left, right = kmeans(x[:, :half], many, 1), kmeans(x[:, half:], many, 2)
    if probe is None:
        probe = measured_probe(x, left, right, k)
    books = spark.sparkContext.broadcast((left, right))

    def halves(col):
        u = unit(matrix(col))
        return (u[:, :half], u[:, half:]) if u.shape[1] > 1 else (u, np.zeros((len(u), 1)))

    def quantise(batches):
        left, right = books.value
        for batch in batches:
            if batch.num_rows:
                a, b = halves(batch.column("v"))
                c1, c2 = distances(a, left).argmin(1), distances(b, right).argmin(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(c1.astype(np.int32)), pa.array(c2.astype(np.int32))], [*batch.schema.names, "c1", "c2"])

    index = written(rows.mapInArrow(quantise, "row long, vec_id long, v binary, c1 int, c2 int"), "index")
    counts = np.zeros((len(left), len(right)), np.int64)
    for r in index.groupBy("c1", "c2").count().collect():
        counts[r["c1"], r["c2"]] = r["count"]
    parts = [int(-(-s // GROUP_ROWS)) or 1 for s in counts.sum(1)]
    queries = index.where(F.col("vec_id") % every == 0)
    n_queries = queries.count()
    blocks = max(1, -(-n_queries // GROUP_QUERIES))
    want = max(int(probe * n), LEAST_CANDIDATES, k + 1)
    cells = spark.sparkContext.broadcast(counts)

    def walk(batches):
        left, right = books.value
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = halves(batch.column("v"))
            d1, d2 = distances(a, left), distances(b, right)
            rows_, ids, block = (batch.column(c).to_pylist() for c in ("row", "vec_id", "block"))
            out = []

            def emit(out):
                r, q, v, block, c, visit = zip(*out, strict=True)
                return pa.RecordBatch.from_arrays([pa.array(r, pa.int64()), pa.array(q, pa.int64()), pa.array(v, pa.binary()), pa.array(block, pa.int32()), pa.array(c, pa.int32()), pa.array(visit, pa.list_(pa.int32()))], ["q_row", "query_id", "q", "block", "c1", "visit"])

            for i in range(batch.num_rows):
                visit: dict[int, list[int]] = {}
                for one, two in multi_sequence(d1[i], d2[i], cells.value, want):
                    visit.setdefault(one, []).append(two)
                v = batch.column("v")[i].as_py()
                out += [(rows_[i], ids[i], v, block[i], one, twos) for one, twos in visit.items()]
                if len(out) >= 2000:
                    yield emit(out)
                    out = []
            if out:
                yield emit(out)

    split = F.element_at(F.array(*[F.lit(p) for p in parts]), F.col("c1") + 1)
    walks = (
        queries.withColumn("block", query_blocks(queries, blocks)).select("row", "vec_id", "v", "block").repartition("row")
        .mapInArrow(walk, "q_row long, query_id long, q binary, block int, c1 int, visit array<int>")
        .withColumn("part", F.explode(F.sequence(F.lit(0), split - 1)))
    )
    if blocks > 1:
        # Walked once: which first halves a block of queries visits is needed before entries go to it.
        walks = written(walks, "walks")
    entries = entries_by_block(index, walks if blocks > 1 else None, split)

    def rerank(queries, own):
        found = []
        if len(queries) and len(own):
            own = own.sort_values(["vec_id", "row"], kind="stable")
            v, rows_, ids, c2 = matrix(own["v"]), own["row"].to_numpy(), own["vec_id"].to_numpy(), own["c2"].to_numpy()
            u = unit(v)
            q = matrix(queries["q"])
            uq = unit(q)
            member = np.zeros((len(q), len(counts[0])), bool)
            for i, cs in enumerate(queries["visit"]):
                member[i, list(cs)] = True
            best: list[list] = [[] for _ in range(len(q))]
            for c in np.unique(c2):
                at, who = np.flatnonzero(c2 == c), np.flatnonzero(member[:, c])
                for some in range(0, len(who), 256):
                    block = who[some : some + 256]
                    s = uq[block] @ u[at].T
                    edge = np.partition(s, -min(k + 1, s.shape[1]), 1)[:, -min(k + 1, s.shape[1])]
                    for i, row, e in zip(block, s, edge, strict=True):
                        best[i].append(at[row >= e - 1e-9])
            for i, lists in enumerate(best):
                if lists:
                    at = np.sort(np.concatenate(lists))
                    query = queries["q_row"].iloc[i]
                    at = at[rows_[at] != query]
                    s = exact_cosine(q[i], v[at])
                    top = np.argsort(-s, kind="stable")[:k]
                    found += [(query, queries["query_id"].iloc[i], rows_[at[j]], ids[at[j]], s[j]) for j in top]
        return pd.DataFrame(found, columns=["q_row", "query_id", "row", "vec_id", "score"])

    key = ["c1", "part", "block"]
    near = walks.groupBy(*key).cogroup(entries.groupBy(*key)).applyInPandas(rerank, "q_row long, query_id long, row long, vec_id long, score double")
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id", "row")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
