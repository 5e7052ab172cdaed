"""Exact top-k inner products by columnar branch-and-bound.

Rows become blocks in vertical layout (one run of values a dimension), without
a shuffle; the stated queries become blocks too, and each block of rows meets
each block of queries.  Blocks are dealt over groups whose number follows the
number of rows.  For a query, partial products are accumulated one
block of dimensions at a time.  By Cauchy-Schwarz on the remaining dimensions
every candidate's product lies within partial +- |q_rest| |x_rest|; candidates
whose upper bound is below the k-th best lower bound are compacted away.
Arithmetic is in integers, so results are exact.

Edge cases: see ``vectors.valid`` (zero vectors do take part); fewer than k
candidates are all returned; ties go to the smaller vec_id; of rows that share
a vec_id each is a candidate, and a query where the id says so, with ranks of
its own; an empty table, or one without queries, gives no rows; extra columns
are ignored.  Scores have to
fit a long: where the number of dimensions and the largest components of two
blocks leave it open, products are computed in unbounded integers, and a score
that doesn't fit raises an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spotweave.llm.vectors import matrix, valid

SCALE = 256
BLOCK_ROWS, BLOCK_QUERIES, BLOCK_DIMS = 4096, 512, 16
#: Rows of a group at most, about: its blocks meet the blocks of queries one after another.
GROUP_ROWS = 64 * BLOCK_ROWS

#: Blocks of queries whose best scores a task keeps; without them only bounds are looser.
KNOWN = 1024


def whole(x: np.ndarray) -> np.ndarray:
    """Doubles without a fraction as integers, unbounded ones where 64 bits don't hold them."""
    if np.abs(x).max(initial=0) < 2**62:
        return x.astype(np.int64)
    return np.array([int(c) for c in x.ravel()], dtype=object).reshape(x.shape)


def fits(q: np.ndarray, x: np.ndarray) -> bool:
    """Whether every product, of whole vectors or of parts, lies within 62 bits: by the number of dimensions and the largest components."""
    most = [max(abs(int(a.max(initial=0))), abs(int(a.min(initial=0)))) if a.size else 0 for a in (q, x)]
    return len(x) * most[0] * most[1] < 2**62


def search_block(q: np.ndarray, q_rows: np.ndarray, x: np.ndarray, rows: np.ndarray, k: int, best: np.ndarray | None = None):
    """(query, place, score) of each query's k best in a block; x is vertical (dimension first) and its order breaks ties.

    Queries and candidates are told apart by their row numbers.  ``best`` (query, k) holds the best scores of
    earlier blocks, smallest first, and takes this block's in; candidates below the k-th are left out.
    """
    out = []
    if not fits(q, x):
        q, x = q.astype(object), x.astype(object)
        for i, query in enumerate(q_rows):
            s = [(-sum(int(a) * int(b) for a, b in zip(q[i], x[:, j], strict=True)), j) for j in range(len(rows)) if rows[j] != query]
            out += [(i, j, -s_) for s_, j in sorted(s)[:k]]
        return out
    dims = len(x)
    cuts = list(range(0, dims, BLOCK_DIMS)) + [dims]
    # Norms of what remains from each cut on; a little larger than exact.
    rest_x = [np.sqrt((x[c:].astype(np.float64) ** 2).sum(0)) * (1 + 1e-12) for c in cuts]
    for i, query in enumerate(q_rows):
        alive = np.flatnonzero(rows != query)
        partial = np.zeros(len(alive), np.int64)
        known = -np.inf if best is None else best[i, 0]
        for b, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            part = x[lo:hi] if len(alive) == len(rows) else x[lo:hi, alive]
            partial = partial + q[i, lo:hi] @ part
            if hi < dims and len(alive) and (len(alive) > k or known > -np.inf):
                slack = np.sqrt((q[i, hi:].astype(np.float64) ** 2).sum()) * rest_x[b + 1][alive] * (1 + 1e-12) + 1e-6
                # Doubles round large products; a little room keeps the bounds on the safe side.
                room = 1e-12 * np.abs(partial)
                floor = known
                if len(alive) > k:
                    floor = max(floor, np.partition(partial - slack - room, -k)[-k])
                keep = partial + slack + room >= floor
                alive, partial = alive[keep], partial[keep]
        top = np.argsort(-partial, kind="stable")[:k]
        out += [(i, int(alive[j]), int(partial[j])) for j in top]
        if best is not None:
            # As doubles, rounded down: bounds only.
            found = np.nextafter(partial[top].astype(np.float64), -np.inf)
            best[i] = np.sort(np.concatenate((best[i], found)))[-k:]
    return out


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """(first, rows, ids, data): runs of ``size`` rows sorted by (vec_id, row), with vertical data, quantised."""

    def block(part):
        ids, row, v = (np.concatenate(x) for x in zip(*part, strict=True))
        order = np.lexsort((row, ids))
        data = [row[order].astype(np.int64).tobytes(), ids[order].astype(np.int64).tobytes(), np.ascontiguousarray(np.floor(v[order] * SCALE).T).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([int(row[0])], pa.int64()), *[pa.array([x], pa.binary()) for x in data]], ["first", "rows", "ids", "data"])

    def make(batches):
        held, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, size - n)
                held.append((part.column("vec_id").to_numpy(), part.column("row").to_numpy(), matrix(part.column("v"))))
                at, n = at + part.num_rows, n + part.num_rows
                if n == size:
                    yield block(held)
                    held, n = [], 0
        if held:
            yield block(held)

    return rows.mapInArrow(make, "first long, rows binary, ids binary, data binary")


def top_products(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id is divisible by ``every``, its k largest products with others."""
    rows = valid(vectors, zero=True)
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    n = rows.count()
    size = int(min(BLOCK_ROWS, max(256, n // (8 * tasks))))
    groups = int(max(min(2 * tasks, -(-n // size)), -(-n // GROUP_ROWS), 1))
    queries = rows.where(F.col("vec_id") % every == 0)
    n_queries = queries.count()
    left = blocks(queries.repartition(max(1, -(-n_queries // BLOCK_QUERIES))), BLOCK_QUERIES)
    left = left.select(F.col("rows").alias("q_rows"), F.col("ids").alias("q_ids"), F.col("data").alias("q"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"))
    right = blocks(rows, size).select("rows", "ids", "data", F.pmod(F.xxhash64("first"), F.lit(groups)).cast("int").alias("g"))

    def search(batches):
        # The k-th best scores that this task has seen go with a block of queries from one block of rows to the next.
        best: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                q_rows, q_ids, q, own, ids, data = (batch.column(c)[at].as_buffer() for c in ("q_rows", "q_ids", "q", "rows", "ids", "data"))
                qr, qi, xr, xi = (np.frombuffer(x, np.int64) for x in (q_rows, q_ids, own, ids))
                qv = whole(np.frombuffer(q).reshape(-1, len(qi)).T)
                xv = whole(np.frombuffer(data).reshape(-1, len(xi)))
                found = search_block(qv, qr, xv, xr, k, best.setdefault(int(qr[0]), np.full((len(qr), k), -np.inf)))
                if len(best) > KNOWN:
                    del best[next(iter(best))]
                if found:
                    i, j, score = zip(*found, strict=True)
                    i, j = list(i), list(j)
                    yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in (qr[i], qi[i], xr[j], xi[j])], pa.array(score, pa.int64())], ["q_row", "query_id", "row", "vec_id", "score"])

    best = left.join(right, "g").drop("g").mapInArrow(search, "q_row long, query_id long, row long, vec_id long, score long")
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id", "row")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
