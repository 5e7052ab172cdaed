"""Vectors in Arrow batches: which take part, and their arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.llm.common import written


def valid(vectors: DataFrame, zero: bool) -> DataFrame:
    """(row, vec_id, v binary of doubles) of the rows that take part, written once; ``row`` tells rows of one vec_id apart.

    Out: null ids and vectors, those with null or non-finite components, and
    unless ``zero`` those without a component other than 0.  Vectors may differ
    in length: components that one lacks count as 0.
    """
    e = F.col("embedding")
    fine = e.isNotNull() & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("e"))
    if not zero:
        rows = rows.where(F.exists("e", lambda x: x != 0))
    width = max(1, rows.agg(F.max(F.size("e"))).first()[0] or 0)

    def pack(batches):
        for batch in batches:
            col = batch.column("e")
            flat, size = col.flatten().to_numpy(zero_copy_only=False), np.diff(col.offsets.to_numpy())
            x = np.zeros((batch.num_rows, width))
            x[np.arange(width) < size[:, None]] = flat
            data = pa.py_buffer(np.ascontiguousarray(x))
            ends = pa.py_buffer(np.arange(0, 8 * width * (batch.num_rows + 1), 8 * width, dtype=np.int32))
            v = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, ends, data])
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("vec_id"), v], ["row", "vec_id", "v"])

    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    return written(numbered.mapInArrow(pack, "row long, vec_id long, v binary"), "vectors")


def matrix(col) -> np.ndarray:
    """Rows of a binary column (Arrow array or pandas series) as one array of doubles."""
    data = col.to_pylist() if hasattr(col, "to_pylist") else col.tolist()
    return np.frombuffer(b"".join(data), np.float64).reshape(len(data), -1) if data else np.zeros((0, 1))
