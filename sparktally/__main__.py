"""Command line: run one of the jobs on files and write its output.

    python -m sparktally ratings movies  --movies M --ratings R1 R2 --out DIR
    python -m sparktally ratings genres  --movies M --ratings R1 R2 --out DIR
    python -m sparktally ratings gender  --movies M --ratings R1 R2 --users U --out DIR
    python -m sparktally ratings age     --movies M --ratings R1 R2 --users U --out DIR
    python -m sparktally reviews --reviews R --stopwords S --out DIR

The output replaces ``DIR``. ``--preview N`` prints the first N lines of a
rating report (default 15); ``--master`` sets the Spark master when not
launched by spark-submit.
"""

from __future__ import annotations

import argparse
import sys

from sparktally.plans.movies import rating_report, run_rating_report
from sparktally.plans.reviews import run_review_reports
from sparktally.session import get_session
from sparktally.sinks import dump


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m sparktally")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="job", required=True)
    r = sub.add_parser("ratings", help="rating questions over movie / rating / user files")
    r.add_argument("question", choices=["movies", "genres", "gender", "age"])
    r.add_argument("--movies", required=True)
    r.add_argument("--ratings", required=True, nargs="+")
    r.add_argument("--users")
    r.add_argument("--out", required=True)
    r.add_argument("--preview", type=int, default=15)
    t = sub.add_parser("reviews", help="review-text questions over a ';'-delimited review file")
    t.add_argument("--reviews", required=True, nargs="+")
    t.add_argument("--stopwords", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--sep", default=";")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = get_session(args.master)
    if args.job == "ratings":
        if args.question in ("gender", "age") and not args.users:
            print("--users is required for this question", file=sys.stderr)
            return 2
        run_rating_report(spark, args.question, args.movies, args.ratings, args.out, args.users)
        # The report frame is sorted: its first rows, not those of some file.
        lines = rating_report(spark, args.question, args.movies, args.ratings, args.users)
        for row in dump(lines, args.preview):
            print(f"{row.key}\t{row.value}")
    else:
        paths = run_review_reports(spark, args.reviews, args.stopwords, args.out, args.sep)
        for name, path in paths.items():
            print(f"{name}\t{path}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
