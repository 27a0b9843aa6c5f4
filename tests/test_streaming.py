"""The streaming ledger state equals the batch plan, including late voids."""

import datetime as dt
import os
import tempfile

from tally.plans import ledger as L
from tally.streaming.ledger import current_from_changes, settled_state, write_changes

T0 = dt.datetime(2024, 1, 10, 12, 0)
DDL = ("event_id bigint, transaction_id bigint, loan_id bigint, user_id bigint, "
       "party string, status string, method string, transaction_type string, "
       "created_at timestamp_ntz, value_date timestamp_ntz, effective_date date, "
       "external_post_date timestamp_ntz, debit bigint, credit bigint, merchant_party_id bigint")


def row(eid, tid, status, method, hours):
    c = None if hours is None else T0 + dt.timedelta(hours=hours)
    return (eid, tid, tid, 1, "lender", status, method, "disbursement", c, c, None, None,
            100, 0, tid)


def test_stream_matches_batch_across_batches(spark):
    root = tempfile.mkdtemp(prefix="tally-stream-test-")
    src = os.path.join(root, "in")
    batches = [
        [row(1, 1, "cleared", "direct", 0), row(2, 2, "pending", "card", 0),
         row(3, 3, "cleared", "check", None)],
        [row(4, 1, "voided", "direct", 5),          # cancels txn 1 later
         row(5, 2, "cleared", "card", 2), row(6, 4, "voided", "card", 1)],
        [row(7, 4, "pending", "card", 3), row(8, 3, "voided", "check", 9)],
    ]
    out = os.path.join(root, "changes")
    os.makedirs(src)
    stream_df = spark.readStream.schema(DDL).parquet(src)
    q = None
    for i, b in enumerate(batches):
        stage = os.path.join(root, f"stage-{i}")
        spark.createDataFrame(b, DDL).coalesce(1).write.parquet(stage)
        for f in os.listdir(stage):          # publish atomically, as a file feed does
            if f.endswith(".parquet"):
                os.rename(os.path.join(stage, f), os.path.join(src, f"batch-{i}-{f}"))
        if q is None:
            q = (settled_state(stream_df).writeStream.outputMode("update")
                 .option("checkpointLocation", os.path.join(root, "ckpt"))
                 .foreachBatch(write_changes(out)).start())
        q.processAllAvailable()
    q.stop()
    got = sorted(r.event_id for r in current_from_changes(spark, out).collect())
    every = [r for b in batches for r in b]
    want = sorted(r.event_id for r in
                  L.cleared_versions({"ledger": spark.createDataFrame(every, DDL)}).collect())
    assert got == want == [3, 5, 7]


def test_stream_reads_a_table_of_several_files(spark):
    from given_tables import SF_SMALL
    from tally.plans.catalogue import QUERIES
    root = tempfile.mkdtemp(prefix="tally-stream-test-")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(3).write.parquet(f"{root}/events.parquet")
    stream = QUERIES["ledger_unvoided_latest_stream"](spark, root).collect()
    batch = QUERIES["ledger_unvoided_latest"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, stream)) == sorted(map(tuple, batch)) and batch
