"""Command line: ``python -m tessera load INPUT_DIR ROOT [--check]``.

Runs the raw, clean and star layers over the fourteen extracts in INPUT_DIR
(file names as in the table specs; a missing file ends the run before anything
is loaded, unless ``--allow-missing``; the folder may be in any store Hadoop's
file systems reach), prints the audit rows, and with ``--check`` runs every quality check over the loaded
tables and prints one summary row per check.
"""

from __future__ import annotations

import argparse
import os
import sys


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="tessera")
    sub = p.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load", help="raw -> clean -> star over a folder of extracts")
    ld.add_argument("input_dir")
    ld.add_argument("root", help="table root (each load writes a new version below it)")
    ld.add_argument("--parallelism", type=int, default=4)
    ld.add_argument("--max-reject-fraction", type=float, default=0.0)
    ld.add_argument("--allow-missing", action="store_true", help="load the extracts that are there")
    ld.add_argument("--prefix", default="", help="put before the namespaces bronze, silver and gold")
    ld.add_argument("--keep-versions", type=int, help="versions left of each table (default: all)")
    ld.add_argument("--check", action="store_true", help="run the quality checks afterwards")
    ld.add_argument("--show-violations", type=int, default=0, help="rows to show per failing check")
    args = p.parse_args(argv)

    from tessera.plans.checks import quality_report
    from tessera.plans.pipeline import Warehouse
    from tessera.session import build_session

    spark = build_session(os.environ.get("TESSERA_MASTER"))

    def exists(path: str) -> bool:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)

    wh = Warehouse(spark, args.root, parallelism=args.parallelism,
                   max_reject_fraction=args.max_reject_fraction, prefix=args.prefix,
                   keep_versions=args.keep_versions)
    paths = {t.stem: f"{args.input_dir.rstrip('/')}/{t.file_name}" for t in wh.tables}
    inputs = {stem: path for stem, path in paths.items() if exists(path)}
    missing = sorted(paths[stem] for stem in paths if stem not in inputs)
    if not inputs or (missing and not args.allow_missing):
        print("missing extracts: " + ", ".join(missing), file=sys.stderr)
        return 2
    wh.define()
    try:
        wh.run(inputs)
    finally:
        wh.audit_frame().drop("error").show(100, truncate=False)
    if args.check:
        summary, checks = quality_report(spark, prefix=args.prefix)
        for r in summary.collect():
            print(f"{r['check']:60s} {r['table']:40s} {r['violations']}")
            if args.show_violations and r["violations"]:
                checks[r["check"]][1].show(args.show_violations, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
