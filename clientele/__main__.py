"""Run a standard job: ``python -m clientele drive16 --database retail``."""

from __future__ import annotations

import argparse
import logging

from clientele.operators import EligibilityRule
from clientele.plans import PRESETS, preset
from clientele.sources import get_session


def _age(text: str) -> EligibilityRule:
    column, _, years = text.partition("=")
    try:
        return EligibilityRule(column, int(years))
    except ValueError:
        raise argparse.ArgumentTypeError(f"{text!r} is not of the form COLUMN=YEARS.") from None


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="clientele", description=__doc__)
    parser.add_argument("job", choices=sorted(PRESETS))
    parser.add_argument("--database", help="where the tables are read and written")
    parser.add_argument("--source-database", help="where the tables are read, if elsewhere")
    parser.add_argument("--destination-database", help="where the result goes, if elsewhere")
    parser.add_argument("--source", action="append", help="a table to read, for each of the job's")
    parser.add_argument("--destination", help="the table to write")
    parser.add_argument("--dob", default="dob", help="the birth column")
    parser.add_argument(
        "--age", type=_age, action="append", metavar="COLUMN=YEARS",
        help="a flag column and its minimum age, in place of the job's",
    )
    parser.add_argument("--as-of", help="ISO date to count ages at; today by default")
    parser.add_argument(
        "--fixed-layout", action="store_true",
        help="apply the job's file count, which is meant for small tables: each file is one task",
    )
    parser.add_argument(
        "--unstaged", action="store_true",
        help="drop the old result first; it is lost if the job fails",
    )
    parser.add_argument("--on-error", choices=("raise", "log"), default="raise")
    args = parser.parse_args(argv)
    if not (args.database or args.source_database and args.destination_database):
        parser.error("give --database, or --source-database and --destination-database")
    logging.basicConfig()
    logging.getLogger("clientele").setLevel(logging.INFO)

    spark = get_session(args.job)
    try:
        job = preset(
            args.job,
            args.database,
            args.as_of,
            rules=tuple(args.age) if args.age else None,
            fixed_layout=args.fixed_layout,
            staged=not args.unstaged,
            source_database=args.source_database,
            destination_database=args.destination_database,
            sources=tuple(args.source) if args.source else None,
            destination=args.destination,
            dob=args.dob,
        )
        return 0 if job.run(spark, on_error=args.on_error) else 1
    finally:
        spark.stop()


if __name__ == "__main__":
    raise SystemExit(main())
