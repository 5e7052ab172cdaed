"""Shared plumbing: the shared folder, written tables, bounded broadcasts and components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only after its rows have been counted against this bound.
BROADCAST_ROWS = 500_000
#: Edges of a graph in one partition, about.
EDGES = 500_000
#: Neighbours of a node from which its smallest one is broadcast, not shuffled to all its edges in one task.
HUB = 1_000_000
#: Arrow batches for Python steps: Spark's default of 64 MB is held several times over in each task.  A session that sets it itself is left alone.
BATCH, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "2m"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where the setting is absent the checkpoint folder of the context serves, and on one machine (a local
    master, as in tests) a temporary folder is made and set; on a cluster its lack is an error.
    """
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    path = spark.conf.get("spark.checkpoint.dir", None) or (known.get() if known.isDefined() else None)
    if not path:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="spotweave-")
    if not known.isDefined():
        context.setCheckpointDir(path)
    if spark.conf.get(BATCH, None) == BATCH_DEFAULT:
        spark.conf.set(BATCH, BATCH_BYTES)
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/spotweave-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, parts: int | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, of ``parts`` files at most if given: evaluated once, lineage cut, safe against lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    (df if parts is None else df.coalesce(parts)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(*tables: DataFrame) -> None:
    """Delete the files behind tables made by :func:`written`, once nothing reads them any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/spotweave-" in folder:
                path = context._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, name: str) -> str:
    """A column name made from ``name`` that ``df`` doesn't have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    name = f"spotweave_{name}"
    while name in taken:
        name += "_"
    return name


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if ``df`` (cheap to count: a written table) has at most ``rows`` rows, else leave it to a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def _beside_smallest(edges: DataFrame, low: DataFrame) -> DataFrame:
    """Edges (u, v) with ``m``, the smallest neighbour of u; those of hubs stay where they are, as the hubs, at most edges / HUB of them, are sent to them."""
    hubs = written(low.where(F.col("n") >= HUB).select("u", F.col("m").alias("hub")), "hubs", 1)
    if hubs.isEmpty():
        drop_written(hubs)
        return edges.join(low.drop("n"), "u")
    known = edges.join(bounded(hubs), "u", "left")
    rest = known.where("hub is null").drop("hub").join(low.drop("n"), "u")
    return known.where("hub is not null").withColumnRenamed("hub", "m").unionByName(rest)


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph given as rows (u, v): returns (node, component), the smallest node of each.

    Alternating large-star and small-star steps; each step is two grouped
    minima (combined before the shuffle) and joins on slim rows, and its
    result is checkpointed, in as many files as its rows need.  Nodes without
    an edge do not appear.
    """
    shared_dir(edges.sparkSession)
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges")
    count = edges.count()
    parts = count // EDGES + 1
    e = edges.distinct().coalesce(parts).checkpoint()
    before = None
    while True:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        up = both.where("v > u")
        # No step makes more edges, so where there are fewer than a hub's there is none.
        met = up.join(low.drop("n"), "u") if count < HUB else _beside_smallest(up, low)
        large = met.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.distinct().coalesce(parts).checkpoint()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = (
            small.where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .distinct()
            .coalesce(parts)
            .checkpoint()
        )
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    drop_written(edges)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v"), F.col("v")).distinct()
    )
