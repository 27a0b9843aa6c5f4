"""Run a report over a folder of input tables and write the result.

    python -m tally list
    python -m tally run external_ledger --tables /data/lending \
        --param program=partner --param generated_at=2024-01-20T12:05 \
        --param exclude_agents=A1,A2 --out /data/out/external_ledger --format parquet

Parameters are converted by the report's signature: ``date`` and
``datetime`` from ISO text, ``Sequence`` from comma-separated text, ``bool``
from true/false, numbers from digits. The session comes from
``build_session()``, so cluster settings (master, checkpoint folder, shuffle
partitions) are taken from the environment.
"""

from __future__ import annotations

import argparse
import datetime as dt
import inspect
import sys
import typing

from tally.plans import ledger, loans, remittance

REPORTS = {
    "ledger_current_versions": ledger.ledger_current_versions,
    "ledger_first_versions": ledger.ledger_first_versions,
    "cleared_versions": ledger.cleared_versions,
    "latest_then_filter": ledger.latest_then_filter,
    "external_ledger": ledger.external_ledger,
    "external_ledger_first_last": ledger.external_ledger_first_last,
    "early_month_cleared_totals": ledger.early_month_cleared_totals,
    "merchant_spend": ledger.merchant_spend,
    "acceleration_events": loans.acceleration_events,
    "upsizes": loans.upsizes,
    "loan_snapshots_current": loans.loan_snapshots_current,
    "loan_snapshots_collections": loans.loan_snapshots_collections,
    "reapplications": loans.reapplications,
    "reapplications_expired": loans.reapplications_expired,
    "first_expired_authorization": loans.first_expired_authorization,
    "reapplication_report": loans.reapplication_report,
    "previous_investor_tape_totals": remittance.previous_investor_tape_totals,
    "new_purchasable": remittance.new_purchasable,
    "nsf_repayments": remittance.nsf_repayments,
    "entry_impacts": remittance.entry_impacts,
    "loan_balances": remittance.loan_balances,
    "investor_refunds": remittance.investor_refunds,
    "remittance_report": remittance.remittance_report,
}


def _convert(text: str, annotation) -> object:
    """By the parameter's annotation alone: text and ids stay text, whatever they look like."""
    kind = str(annotation)
    if "Sequence" in kind or "list" in kind:
        return [v for v in text.split(",") if v != ""]
    if "datetime.datetime" in kind:
        return dt.datetime.fromisoformat(text)
    if "date" in kind:
        return dt.date.fromisoformat(text)
    if "bool" in kind:
        return text.lower() in ("1", "true", "yes")
    for number in (int, float):
        if number.__name__ in kind:
            return number(text)
    return text


def parse_params(fn, pairs: list[str]) -> dict:
    hints = typing.get_type_hints(fn)
    params = inspect.signature(fn).parameters
    out = {}
    for pair in pairs:
        key, _, value = pair.partition("=")
        if key not in params:
            raise SystemExit(f"unknown parameter {key!r}; takes {list(params)[1:]}")
        out[key] = _convert(value, hints.get(key, str))
    return out


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tally")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="list reports and their parameters")
    run = sub.add_parser("run", help="run one report")
    run.add_argument("report", choices=sorted(REPORTS))
    run.add_argument("--tables", help="folder with one sub-folder per table")
    run.add_argument("--jdbc-url", help="read the tables from this JDBC database instead")
    run.add_argument("--jdbc-prop", action="append", default=[], metavar="KEY=VALUE",
                     help="JDBC connection property (user, password, driver, ...)")
    run.add_argument("--jdbc-slices", type=int, default=64)
    run.add_argument("--input-format", default="parquet")
    run.add_argument("--infer-schema", action="store_true",
                     help="use the files' own schemas instead of the declared ones")
    run.add_argument("--param", action="append", default=[], metavar="KEY=VALUE")
    run.add_argument("--out", required=True)
    run.add_argument("--overwrite", action="store_true", help="replace what lies at --out")
    run.add_argument("--format", default="parquet", choices=["parquet", "csv", "json", "orc"])
    args = ap.parse_args(argv)

    if args.cmd == "list":
        for name, fn in sorted(REPORTS.items()):
            params = [p for p in inspect.signature(fn).parameters if p != "t"]
            print(f"{name}: {', '.join(params)}")
        return 0

    from tally.session import build_session
    from tally.sources.tables import read_tables
    fn = REPORTS[args.report]
    kwargs = parse_params(fn, args.param)
    spark = build_session()
    if args.jdbc_url:
        from tally.sources.jdbc import read_jdbc_tables
        props = dict(p.partition("=")[::2] for p in args.jdbc_prop)
        tables = read_jdbc_tables(spark, args.jdbc_url, props, slices=args.jdbc_slices)
    elif args.tables:
        tables = read_tables(spark, args.tables, fmt=args.input_format,
                             schemas={} if args.infer_schema else None)
    else:
        raise SystemExit("give --tables or --jdbc-url")
    positional = [p for p in inspect.signature(fn).parameters.values()
                  if p.kind == p.POSITIONAL_OR_KEYWORD and p.default is p.empty][1:]
    call_args = [kwargs.pop(p.name) for p in positional if p.name in kwargs]
    df = fn(tables, *call_args, **kwargs)
    writer = df.write.mode("overwrite" if args.overwrite else "errorifexists")
    if args.format == "csv":
        writer = writer.option("header", "true")
    writer.format(args.format).save(args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
