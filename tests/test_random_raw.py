"""Every catalogue query against its oracle on random raw test tables.

The raw tables have the shapes of the driver's test data but random values,
salted with the cases that decide results: instants exactly at New York
midnight around each report's cutoff, the edges of the day-1..15 window,
daylight-saving days, equal timestamps within a transaction (ties), and the
key residues that make the derived tables produce NULLs.
"""

import datetime as dt
import hashlib
import os
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tally.plans.catalogue import QUERIES
from tally.plans.oracle import ORACLE_SQL

US = dt.timedelta(microseconds=1)
EDGES = [  # UTC instants at or next to New York midnights the reports cut on
    dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1, 5) - US,
    dt.datetime(2024, 1, 16, 5), dt.datetime(2024, 1, 16, 5) - US,
    dt.datetime(2024, 1, 21, 5), dt.datetime(2024, 1, 21, 5) - US,
    dt.datetime(2024, 1, 20, 5), dt.datetime(2024, 3, 10, 7), dt.datetime(2024, 11, 3, 6),
]
SHIP_EDGES = [
    dt.datetime(2000, 1, 1, 5), dt.datetime(2000, 1, 1, 5) - US, dt.datetime(2000, 1, 1),
    dt.datetime(1999, 12, 31, 5), dt.datetime(1999, 4, 4, 7), dt.datetime(1999, 10, 31, 6),
]


def raw_tables(seed: int) -> dict[str, pa.Table]:
    rng = np.random.default_rng(seed)
    n_events, n_orders, n_users, n_parts = 400, 300, 25, 60

    def pick(values, n):
        return [values[i] for i in rng.integers(0, len(values), n)]

    base = dt.datetime(2023, 12, 25)
    ts = [base + dt.timedelta(seconds=int(s)) for s in rng.integers(0, 40 * 86400, n_events)]
    for i, edge in enumerate(EDGES * 3):
        ts[i] = edge
    for i in range(30, 60):               # ties: equal instants within one user
        ts[i] = ts[i - 30]
    users = rng.integers(0, n_users, n_events)
    users[30:60] = users[0:30]
    events = pa.table({
        "event_id": pa.array(rng.permutation(n_events * 3)[:n_events], pa.int64()),
        "ts": pa.array(ts, pa.timestamp("us")),
        "user_id": pa.array(users, pa.int64()),
        "event_type": pa.array(pick(["view", "signup", "purchase", "error", "click"], n_events)),
        "value": pa.array(np.round(rng.uniform(0.01, 500, n_events), 2)),
        "props": pa.array(['{"k": 1}'] * n_events),
    })
    odate = [dt.datetime(1995, 1, 1) + dt.timedelta(days=int(d))
             for d in rng.integers(0, 2400, n_orders)]
    orders = pa.table({
        "o_orderkey": pa.array(np.arange(n_orders), pa.int64()),
        "o_custkey": pa.array(rng.integers(0, n_users * 2, n_orders), pa.int64()),
        "o_orderstatus": pa.array(pick(["F", "O", "P"], n_orders)),
        "o_totalprice": pa.array(np.round(rng.uniform(100, 400000, n_orders), 2)),
        "o_orderdate": pa.array(odate, pa.timestamp("us")),
        "o_orderpriority": pa.array(pick(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED",
                                          "5-LOW"], n_orders)),
    })
    rows = []
    for key in range(n_orders):
        for line in range(1, int(rng.integers(1, 6)) + 1):
            ship = dt.datetime(1999, 6, 1) + dt.timedelta(hours=int(rng.integers(0, 24 * 330)))
            rows.append((key, line, ship))
    for i, edge in enumerate(SHIP_EDGES * 4):
        rows[i * 7] = (rows[i * 7][0], rows[i * 7][1], edge)
    n_items = len(rows)
    lineitem = pa.table({
        "l_orderkey": pa.array([r[0] for r in rows], pa.int64()),
        "l_partkey": pa.array(rng.integers(0, n_parts, n_items), pa.int64()),
        "l_suppkey": pa.array(rng.integers(0, 10, n_items), pa.int64()),
        "l_linenumber": pa.array([r[1] for r in rows], pa.int32()),
        "l_quantity": pa.array(rng.integers(1, 50, n_items).astype(float)),
        "l_extendedprice": pa.array(np.round(rng.uniform(1, 90000, n_items), 2)),
        "l_discount": pa.array(np.zeros(n_items)),
        "l_tax": pa.array(np.zeros(n_items)),
        "l_returnflag": pa.array(pick(["R", "A", "N"], n_items)),
        "l_linestatus": pa.array(pick(["O", "F"], n_items)),
        "l_shipdate": pa.array([r[2] for r in rows], pa.timestamp("us")),
    })
    customer = pa.table({
        "c_custkey": pa.array(np.arange(n_users * 2), pa.int64()),
        "c_name": pa.array([f"Customer#{i:09d}" for i in range(n_users * 2)]),
        "c_nationkey": pa.array(rng.integers(0, 25, n_users * 2), pa.int32()),
        "c_acctbal": pa.array(np.zeros(n_users * 2)),
        "c_mktsegment": pa.array(pick(["HOUSEHOLD", "MACHINERY", "BUILDING"], n_users * 2)),
    })
    words = ["small ring", "red widget", "blue bolt", "hot gear", "RING bolt", "gizmo"]
    part = pa.table({
        "p_partkey": pa.array(np.arange(n_users * 10 + 20), pa.int64()),
        "p_name": pa.array(pick(words, n_users * 10 + 20)),
        "p_brand": pa.array(pick(["Brand#1", "Brand#2"], n_users * 10 + 20)),
        "p_type": pa.array(pick(["STEEL", "COPPER"], n_users * 10 + 20)),
        "p_size": pa.array(rng.integers(1, 50, n_users * 10 + 20), pa.int32()),
        "p_retailprice": pa.array(np.zeros(n_users * 10 + 20)),
    })
    return {"events": events, "orders": orders, "lineitem": lineitem,
            "customer": customer, "part": part}


@pytest.fixture(scope="module", params=[7, 2024])
def raw_dir(request):
    root = tempfile.mkdtemp(prefix=f"tally-raw-{request.param}-")
    for name, table in raw_tables(request.param).items():
        pq.write_table(table, os.path.join(root, f"{name}.parquet"))
    return root


def lines(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(repr(r[i]) if isinstance(r[i], float) else str(r[i])
                           for i in order) for r in rows)


def test_all_queries_match_oracles_on_random_raw_tables(spark, raw_dir):
    import duckdb
    con = duckdb.connect()
    for name in ("events", "orders", "lineitem", "customer", "part"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet("
                    f"'{raw_dir}/{name}.parquet')")
    bad, sizes = [], {}
    for name, query in QUERIES.items():
        df = query(spark, raw_dir)
        rows = [tuple(r) for r in df.collect()]
        res = con.execute(ORACLE_SQL[name])
        ocols = [c[0] for c in res.description]
        orows = res.fetchall()
        sizes[name] = len(rows)
        same = (sorted(df.columns) == sorted(ocols)
                and hashlib.sha256("\n".join(lines(rows, df.columns)).encode()).digest()
                == hashlib.sha256("\n".join(lines(orows, ocols)).encode()).digest())
        if not same:
            bad.append(name)
    assert not bad, bad
    assert sum(1 for n in sizes.values() if n > 0) >= 24, sizes
