"""``python -m marketloom query NAME FOLDER``, ``list``, or ``load JOB...`` with settings from MARKETLOOM_* variables."""

from __future__ import annotations

import argparse
import datetime as dt
import os

from marketloom.session import build_session, checkpoint_dir


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="marketloom")
    sub = p.add_subparsers(dest="what", required=True)
    sub.add_parser("list", help="names of the queries")
    q = sub.add_parser("query", help="run a query over a folder of Parquet tables")
    q.add_argument("name")
    q.add_argument("folder")
    q.add_argument("--out", help="write Parquet there instead of showing rows")
    load = sub.add_parser("load", help="load captured files into the lake")
    load.add_argument("jobs", nargs="*")
    load.add_argument("--captured", action="append", default=[], metavar="KIND=PATH")
    a = p.parse_args(argv)

    from marketloom.plans import catalog

    if a.what == "list":
        print("\n".join(sorted(catalog.queries())))
        return 0
    spark = build_session()
    if a.what == "query":
        df = catalog.queries()[a.name](spark, a.folder)
        df.write.parquet(a.out) if a.out else df.show(truncate=False)
        return 0
    from marketloom.jobs import Context, run
    from marketloom.operators.lake import Lake
    from marketloom.settings import Settings

    s = Settings.read(os.environ).required("lake_root")
    checkpoint_dir(spark)
    done = run(Context(spark, Lake(spark, s.lake_root), s, dict(x.split("=", 1) for x in a.captured), dt.datetime.now(dt.timezone.utc)), a.jobs or None)
    for job, versions in done.items():
        print(job, versions)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
