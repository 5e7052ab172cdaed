"""The folder that driver and executors share, for tables that a query writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, else its checkpoint folder, else (a local master only) a temporary one."""
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    path = spark.conf.get("spark.checkpoint.dir", None) or (known.get() if known.isDefined() else None)
    if not path:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="spotweave-")
    if not known.isDefined():
        context.setCheckpointDir(path)
    return path.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/spotweave-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: evaluated once, so what it numbers stays the same when executors are lost."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Delete the files behind tables made by :func:`written`, once nothing reads them any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/spotweave-" in folder:
                path = context._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
