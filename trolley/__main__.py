"""Command line: build the warehouse, run the DQ gate, run or list queries.

  python -m trolley build --source DIR [--format csv]     ingest the six files, write marts, DQ gate
  python -m trolley build --driver SF_DIR                 same over the driver's derived tables
  python -m trolley query KEY (--source DIR | --driver SF_DIR) [--show N] [--out PATH]
  python -m trolley list

On a cluster pass the session settings with spark-submit; the work folder is
the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _session(local: str | None) -> SparkSession:
    if local:
        from trolley.session import local_session
        return local_session(local)
    return SparkSession.builder.getOrCreate()


def _warehouse(spark: SparkSession, args):
    from trolley.plans.warehouse import Warehouse
    if args.source:
        return Warehouse.from_files(spark, args.source, args.format)
    return Warehouse.get(spark, args.driver)


def _param(text: str) -> tuple[str, object]:
    name, _, value = text.partition("=")
    try:
        return name, json.loads(value)
    except json.JSONDecodeError:
        return name, value


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="trolley")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("build", "query"):
        p = sub.add_parser(name)
        if name == "query":
            p.add_argument("key")
            p.add_argument("--out", help="write the full result as Parquet here instead of showing it")
            p.add_argument("--param", action="append", default=[], metavar="NAME=VALUE",
                           help="a parameter of the query; VALUE is JSON or plain text, e.g. n=5, departments=[\"a\", \"b\"]")
        p.add_argument("--show", type=int, default=20 if name == "query" else 200, help="rows to print")
        src = p.add_mutually_exclusive_group(required=True)
        src.add_argument("--source", help="folder with the six source files")
        src.add_argument("--driver", help="driver test-data folder (tables are derived)")
        p.add_argument("--format", default="csv")
        p.add_argument("--local", help="run on local[N] instead of the ambient session")
        p.add_argument("--threads", type=int, default=8)
    sub.add_parser("list")
    args = ap.parse_args(argv)

    from trolley import catalog
    if args.cmd == "list":
        for k in sorted(catalog.registry()):
            print(k)
        return 0
    spark = _session(args.local)
    wh = _warehouse(spark, args)
    from trolley.session import size_shuffles
    size_shuffles(spark, wh.input_bytes())
    if args.cmd == "build":
        from trolley.operators import quality
        wh.build_all(threads=args.threads)
        report = wh.written("dq_gate", quality.dq_gate(wh))
        report.orderBy("status", "check_name").show(args.show, truncate=False)
        failed = report.filter("check_name = 'gate'").first().issue_count
        print(f"warehouse at {wh.root}; failed checks: {failed}; full report under {wh.path('reports', '')}")
        return 1 if failed else 0
    reg = catalog.registry()
    if args.key not in reg:
        print(f"unknown query {args.key!r}; see `python -m trolley list`", file=sys.stderr)
        return 2
    df = reg[args.key].on(wh, **dict(_param(x) for x in args.param))
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
