"""Command line: the layered ETL from a CSV folder, and table profiles.

    python -m tierline medallion --csv FOLDER --out LOCATION [--prefix P] [--semicolon]
    python -m tierline profile PATH [--format parquet] [--report nulls|dups|describe|corr|values]
"""

from __future__ import annotations

import argparse
import sys

REPORTS = ("nulls", "dups", "describe", "corr", "values")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tierline")
    sub = parser.add_subparsers(dest="command", required=True)
    med = sub.add_parser("medallion", help="CSV folder -> bronze -> silver -> gold tables")
    med.add_argument("--csv", required=True, help="folder holding <table>.csv files")
    med.add_argument("--out", required=True, help="shared location for the three layers")
    med.add_argument("--prefix", default="", help="prefix for the bronze/silver/gold database names")
    med.add_argument("--format", default="parquet")
    med.add_argument("--semicolon", action="store_true", help="CSV separator is ';'")
    prof = sub.add_parser("profile", help="quality profile of one table")
    prof.add_argument("path")
    prof.add_argument("--format", default="parquet")
    prof.add_argument("--report", choices=REPORTS, action="append")
    args = parser.parse_args(argv)

    from .session import build_session
    spark = build_session(app_name=f"tierline-{args.command}")
    if args.command == "medallion":
        from .plans import medallion
        layers, report = medallion.run_from_csv(spark, args.csv, args.out, prefix=args.prefix,
                                                fmt=args.format, semicolon=args.semicolon)
        for r in report:
            print(f"bronze.{r.table_name}: {r.status} ({r.n_rows} rows)")
        for name in ("silver", "gold"):
            print(f"{layers[name].name}: {', '.join(layers[name].saved)}")
        return 0

    from .operators import profile
    df = spark.read.format(args.format).load(args.path)
    builders = {"nulls": profile.null_profile, "dups": profile.dup_profile,
                "describe": profile.describe_numeric, "corr": lambda d: profile.corr_long(d).drop("i", "j"),
                "values": profile.value_counts}
    for name in args.report or REPORTS:
        print(f"== {name}")
        report = builders[name](df)
        report.show(report.count(), truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
