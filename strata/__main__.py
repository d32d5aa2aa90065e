"""Command line: run, backfill, incremental runs, cross-domain KPIs and queries over views.

    python -m strata run deforestation --raw 'landing/prodes/*.csv' --root lake
    python -m strata run tax --raw 'landing/irpf/*.csv' --root lake --years 2023:2023   # backfill
    python -m strata incremental spending --landing landing/siconfi --root lake
    python -m strata cross --root lake
    python -m strata query --root lake "SELECT * FROM gold_deforestation_by_biome ORDER BY year LIMIT 10"
"""

from __future__ import annotations

import argparse
import json

from strata.plans import medallion
from strata.session import get_spark
from strata.sources.versions import attach_views

def _years(text: str | None):
    if not text:
        return None
    lo, _, hi = text.partition(":")
    return int(lo), int(hi or lo)


def main(argv=None) -> None:
    """Parse the command line and run one command (see the module docstring)."""
    p = argparse.ArgumentParser(prog="strata")
    p.add_argument("--master", default=None)
    p.add_argument("--profile", default="default", choices=["default", "cluster"])
    sub = p.add_subparsers(dest="cmd", required=True)

    r = sub.add_parser("run", help="raw -> bronze -> silver -> gold, gate, views")
    r.add_argument("domain", choices=sorted(medallion.DOMAINS))
    r.add_argument("--raw", required=True)
    r.add_argument("--root", required=True)
    r.add_argument("--years", help="backfill range A:B (only those year partitions are replaced)")
    r.add_argument("--sep", default=",")
    r.add_argument("--encoding", default="UTF-8", help="text encoding of the raw files, e.g. ISO-8859-1")
    r.add_argument("--mode", default="prefer_rollup", choices=["prefer_rollup", "as_executed"])
    r.add_argument("--no-gate", action="store_true")
    r.add_argument("--mixed", action="store_true", help="files of any layout: each has its delimiter and headers, found by their aliases")
    r.add_argument("--checks", help="SQL file of named checks (-- name:, -- expect: eq 0) that the run must pass; tables are {bronze}, {silver}, {<gold table>}")
    r.add_argument("--atomic", action="store_true", help="versioned tables: readers see a run's tables whole or not at all")
    r.add_argument("--fail-fast", action="store_true", help="reject the whole drop if any row cannot be typed")

    i = sub.add_parser("incremental", help="run a domain for new landing files only")
    i.add_argument("domain", choices=sorted(medallion.DOMAINS))
    i.add_argument("--landing", required=True)
    i.add_argument("--root", required=True)
    i.add_argument("--sep", default=",")
    i.add_argument("--max-files-per-batch", type=int, default=None)
    i.add_argument("--encoding", default="UTF-8", help="text encoding of the landing files")
    i.add_argument("--mixed", action="store_true", help="files of any layout")

    c = sub.add_parser("cross", help="cross-domain KPIs and views")
    c.add_argument("--root", required=True)
    c.add_argument("--category", default="Environment")

    q = sub.add_parser("query", help="SQL over the gold views")
    q.add_argument("--root", required=True)
    q.add_argument("sql")
    q.add_argument("--rows", type=int, default=20)

    a = p.parse_args(argv)
    spark = get_spark(app=f"strata-{a.cmd}", master=a.master, profile=a.profile)
    if a.cmd == "run":
        kwargs = {"years": _years(a.years), "gate": not a.no_gate, "sep": a.sep, "fail_fast": a.fail_fast,
                  "encoding": a.encoding, "mixed": a.mixed, "atomic": a.atomic, "checks": a.checks}
        if a.domain == "deforestation":
            kwargs["mode"] = a.mode
        out = medallion.DOMAINS[a.domain][0](spark, a.raw, a.root, **kwargs)
        print(json.dumps({k: v for k, v in out.items() if k != "details"}, default=str))
    elif a.cmd == "incremental":
        out = medallion.run_incremental(spark, a.domain, a.landing, a.root, sep=a.sep,
                                        max_files_per_batch=a.max_files_per_batch, encoding=a.encoding, mixed=a.mixed)
        print(json.dumps({"batches": len(out)}))
    elif a.cmd == "cross":
        print(json.dumps(medallion.run_cross_domain(spark, a.root, a.category)))
    else:
        attach_views(spark, a.root)
        spark.sql(a.sql).show(a.rows, truncate=False)


if __name__ == "__main__":
    main()
