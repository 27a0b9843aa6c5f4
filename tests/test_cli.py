"""The command line runs a report over a folder of tables."""

import os
import tempfile

from given_tables import SF_SMALL
from tally.cli import main
from tally.plans.catalogue import QUERIES
from tally.sources.fixtures import fixture_tables


def test_cli_runs_external_ledger(spark):
    root = tempfile.mkdtemp(prefix="tally-cli-")
    t = fixture_tables(spark, SF_SMALL)
    for name in ("ledger", "loans", "applications"):
        t[name].write.parquet(os.path.join(root, name))
    out = os.path.join(root, "out")
    rc = main(["run", "external_ledger", "--tables", root, "--infer-schema",
               "--param", "program=agent_partner", "--param", "generated_at=2024-01-20T12:05",
               "--param", "exclude_agents=TEST_AGENT", "--out", out])
    assert rc == 0
    got = spark.read.parquet(out)
    want = QUERIES["external_ledger_created_local"](spark, SF_SMALL)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == \
        sorted(map(tuple, want.collect()))


def test_parameters_are_read_by_annotation():
    import datetime as dt
    from collections.abc import Sequence

    from tally.cli import parse_params

    def report(t, slug: str | None, exclude_agents: Sequence[str], cutoff: dt.date, n: int, strict: bool = False):
        pass

    got = parse_params(report, ["slug=24E780", "exclude_agents=00123,55e10", "cutoff=2024-01-02", "n=3", "strict=yes"])
    assert got == {"slug": "24E780", "exclude_agents": ["00123", "55e10"], "cutoff": dt.date(2024, 1, 2), "n": 3,
                   "strict": True}
    assert parse_params(report, ["slug=123456"]) == {"slug": "123456"}
