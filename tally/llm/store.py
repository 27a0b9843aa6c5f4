"""Written tables in the shared folder, and the settings the operators rely on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Rows and bytes per Arrow batch handed to Python: bound the memory of a worker (a longer text is a batch of its own).
ARROW_ROWS = 512
ARROW_BYTES = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, ``spark.checkpoint.dir`` of the session.

    Where it is unset and there is one local JVM only (tests), a scratch
    folder is set; on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tally-llm-"))
    return sc.getCheckpointDir()


def saved(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written once as Parquet into the shared folder and read back.

    Cuts the lineage: a lost executor costs a re-read of files, not a
    recomputation, and values made from partition numbers stay as they are.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tally/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators (semantics and bounded Arrow batches).

    Python workers import this package; where it is not installed (tests, one
    machine) they find it by the folder that the driver loaded it from.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH", ""), root) if x)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def schema_of(fields: list[StructField], ddl: str) -> StructType:
    """``fields`` and the ones of a DDL text."""
    return StructType([*fields, *StructType.fromDDL(ddl).fields])


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df``, marked for broadcasting if it has at most ``rows`` rows; else joined as Spark plans it.

    Either way the same rows join. ``df`` should be a written table, as it is counted.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
