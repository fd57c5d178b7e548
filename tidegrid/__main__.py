"""Command line: ``spark-submit`` or ``python -m tidegrid collect|forecast|report ...``."""

from __future__ import annotations

import argparse
from datetime import date

from tidegrid.operators.forest import ForestParams
from tidegrid.plans import jobs
from tidegrid.session import build_session
from tidegrid.sources.readers import read_csv, read_parquet
from tidegrid.sources.schemas import OBSERVATIONS, PRICES


def _pairs(items: list[str] | None, default: dict[str, str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items) if items else default


def main() -> None:
    parser = argparse.ArgumentParser(prog="tidegrid")
    parser.add_argument("job", choices=["collect", "forecast", "report"])
    parser.add_argument("--root", required=True, help="folder of the versioned tables")
    parser.add_argument("--run-date", required=True, type=date.fromisoformat)
    parser.add_argument("--prices", help="daily prices: series_id, ts, adj_close")
    parser.add_argument("--observations", help="indicator observations: series_id, ts, value")
    parser.add_argument("--ticker", action="append", metavar="ID=NAME")
    parser.add_argument("--indicator", action="append", metavar="ID=NAME")
    parser.add_argument("--months", type=int, default=36)
    parser.add_argument("--format", default="parquet", choices=["csv", "parquet"])
    parser.add_argument("--folds", type=int, default=5)
    parser.add_argument("--expanding", action="store_true", help="validate each fold with models of the earlier folds only")
    parser.add_argument("--trees", type=int, default=100)
    parser.add_argument("--depth", type=int, default=10)
    parser.add_argument("--no-bfill", action="store_true", help="leave levels before their first observation to the median")
    parser.add_argument("--score-row", default="last_labelled", choices=["last_labelled", "last_observed"])
    args = parser.parse_args()

    spark = build_session(f"tidegrid {args.job}")
    shared = dict(root=args.root, run_date=args.run_date, fmt=args.format,
                  tickers=_pairs(args.ticker, jobs.TICKERS), indicators=_pairs(args.indicator, jobs.INDICATORS))
    ahead = args.score_row == "last_observed"
    if args.job == "collect":
        if not args.prices or not args.observations:
            parser.error("collect needs --prices and --observations")

        def read(path: str, schema: str):
            return read_csv(spark, path, schema) if path.endswith(".csv") else read_parquet(spark, path)

        print(jobs.collect(spark, read(args.prices, PRICES), read(args.observations, OBSERVATIONS),
                           months=args.months, keep_last=ahead, fill_targets=not ahead, **shared))
    elif args.job == "forecast":
        params = ForestParams(trees=args.trees, depth=args.depth)
        jobs.forecast(spark, score_row=args.score_row, params=params, bfill=not args.no_bfill, k=args.folds,
                      expanding=args.expanding, **shared).show(truncate=False, vertical=True)
    else:
        for row in jobs.report(spark, **shared).orderBy("line_no").toLocalIterator():
            print(row["line"])


if __name__ == "__main__":
    main()
