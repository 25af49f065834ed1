"""Command line: ``python -m tallyloom {generate,prepare,analyse,report} ...``.

Under spark-submit the cluster's own master and settings apply; run by plain
Python it uses all local cores.
"""

from __future__ import annotations

import argparse

from tallyloom import jobs
from tallyloom.session import build_session
from tallyloom.sources.scratch import drop_scratch


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tallyloom")
    commands = parser.add_subparsers(dest="job", required=True)

    generate = commands.add_parser("generate", help="write sample tables")
    generate.add_argument("out")
    generate.add_argument("--orders", dest="n_orders", type=int, default=150_000)
    generate.add_argument("--seed", type=int, default=7)
    generate.add_argument("--hot-share", type=float, default=0.0)
    generate.add_argument("--csv", action="store_true")
    generate.add_argument("--overwrite", action="store_true")

    prepare = commands.add_parser("prepare", help="ingest, validate, clean and enrich")
    prepare.add_argument("root")
    prepare.add_argument("out")
    prepare.add_argument("--csv", action="store_true")

    analyse = commands.add_parser("analyse", help="profiles, outliers, trends, rankings")
    analyse.add_argument("root")
    analyse.add_argument("out")

    report = commands.add_parser("report", help="subtotals, shares, key figures")
    report.add_argument("root")
    report.add_argument("out")
    report.add_argument("--format", dest="fmt", choices=["csv", "json"], default="csv")
    return parser


def main(argv: list[str] | None = None) -> None:
    options = vars(_parser().parse_args(argv))
    job = options.pop("job")
    spark = build_session(f"tallyloom-{job}")
    try:
        jobs.JOBS[job](spark, **options)
    finally:
        # The results are written; what was written on the way to them is not needed.
        drop_scratch(spark)


if __name__ == "__main__":
    main()
