"""Current settled ledger versions, maintained by Structured Streaming.

The ledger is append-only: new versions of a transaction arrive over time.
``settled_state`` keeps, per transaction, one aggregate row holding its
newest settled version and its void cutoff, so each micro-batch touches only
the transactions it contains. It computes exactly what the batch
``cleared_versions`` computes:

* newest settled version = ``max`` of an ordering struct (NULL ``created_at``
  first, then newest, then the tie-break, NULL first) - Postgres ``DESC``;
* void cutoff = latest void (NULL as soon as one void has no time) or, for
  ``effective_only``, the earliest void (``min``);
* ``live`` = the newest version is not earlier than the cutoff. A later void
  can turn a transaction off, so the state is emitted in update mode with the
  flag instead of being filtered.

State is one row per transaction, held in the RocksDB state store (the
session default set by ``build_session``), so it lives on executor disk, not
on the heap. There is deliberately no watermark: a void can arrive any time
after its transaction, and evicting a transaction's state would silently
revive a voided one. ``write_changes`` is an idempotent ``foreachBatch`` sink
(one folder per batch id, overwritten on replay) and ``current_from_changes``
reads the live rows back.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tally.operators.latest import latest_per_key, newest
from tally.plans.ledger import LEDGER_TIEBREAK, settled_filter
from tally.session import checkpoint_dir

def _desc_nulls_first_key(cols: Sequence[str]) -> Column:
    """Struct whose ``max`` is the first row under ``c DESC NULLS FIRST, ...``."""
    parts = []
    for i, c in enumerate(cols):
        parts += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}")]
    return F.struct(*parts)


def settled_state(ledger: DataFrame, date_rule: str = "created_local",
                  tiebreak: Sequence[str] = LEDGER_TIEBREAK) -> DataFrame:
    """Per transaction: newest settled version, void cutoff and ``live`` flag."""
    keep = [c for c in ledger.columns if c != "transaction_id"]
    lender = ledger.filter(F.col("party") == "lender")
    if date_rule == "effective_only":
        counts = F.col("status") == "cleared"
    else:
        counts = settled_filter()
    voided = F.col("status") == "voided"
    version = F.struct(_desc_nulls_first_key(["created_at", *tiebreak]).alias("o"),
                       F.struct(*[F.col(c) for c in keep]).alias("r"))
    created = F.col("created_at")
    agg = lender.groupBy("transaction_id").agg(
        F.max(F.when(counts, version)).alias("latest"),
        F.count(F.when(voided, F.lit(1))).alias("n_voids"),
        F.count(F.when(voided, created)).alias("n_timed_voids"),
        F.max(F.when(voided, created)).alias("last_void"),
        F.min(F.when(voided, created)).alias("first_void"))
    if date_rule == "effective_only":
        cutoff = F.col("first_void")
    else:
        cutoff = F.when(F.col("n_voids") == F.col("n_timed_voids"), F.col("last_void"))
    # Live: a settled version exists and it is not strictly earlier than the
    # cutoff (a NULL on either side keeps it, as the anti-join does).
    live = (F.col("latest").isNotNull()
            & F.coalesce(~(F.col("latest.r.created_at") < cutoff), F.lit(True)))
    return agg.select("transaction_id", "latest.r.*", cutoff.alias("void_at"),
                      live.alias("live"))


def write_changes(path: str):
    """``foreachBatch`` sink: the batch's changed rows into ``path/batch_id=N``.

    Overwriting the batch folder makes a replayed batch idempotent.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
              .write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}")))
    return sink


def current_from_changes(spark: SparkSession, path: str) -> DataFrame:
    """Live rows of the newest emitted state per transaction."""
    changes = spark.read.option("basePath", path).parquet(path)
    latest = latest_per_key(changes, ["transaction_id"], [newest("batch_id")])
    return latest.filter(F.col("live")).drop("batch_id", "live", "void_at")


def run_settled_stream(spark: SparkSession, ledger_stream: DataFrame,
                       date_rule: str = "created_local",
                       root: str | None = None, name: str = "ledger_settled") -> DataFrame:
    """Run the stream over everything available now; return the live versions.

    Output and checkpoint live under ``root`` (default: a fresh folder in the
    shared ``spark.checkpoint.dir``).
    """
    root = root or os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    out = os.path.join(root, "changes")
    query = (settled_state(ledger_stream, date_rule)
             .writeStream.outputMode("update")
             .option("checkpointLocation", os.path.join(root, "checkpoint"))
             .foreachBatch(write_changes(out))
             .trigger(availableNow=True)
             .queryName(f"{name}_{uuid.uuid4().hex[:8]}")
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    if query.lastProgress is None or not any(p["numInputRows"] for p in query.recentProgress):
        return spark.createDataFrame([], ledger_stream.schema)      # nothing arrived, nothing was written
    return current_from_changes(spark, out)


def ledger_stream_from_events(spark: SparkSession, folder: str,
                              schema: StructType | str) -> DataFrame:
    """The derived ``ledger`` table as a stream over the events table of ``folder``.

    The table is one file or a folder of files; the pattern matches just its name.
    """
    from tally.sources.fixtures import VIEWS
    events = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 64)
              .parquet(f"{folder.rstrip('/')}/events.parque[t]"))
    return events.select(*[F.expr(e).alias(c) for c, e in VIEWS["ledger"].columns])
