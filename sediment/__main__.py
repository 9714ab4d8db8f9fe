"""Command line: `python -m sediment merge OUT SNAPSHOT...` and `python -m sediment convert OUT LEGACY`."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from sediment import convert_archive, merge_archives


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="sediment")
    jobs = parser.add_subparsers(dest="job", required=True)
    merge = jobs.add_parser("merge", help="consolidate snapshots into one archive")
    merge.add_argument("out")
    merge.add_argument("snapshots", nargs="+")
    merge.add_argument("--map-mode", choices=("strict", "rank_zip"), default="strict")
    merge.add_argument("--stale", choices=("null", "keep"), default="null")
    merge.add_argument("--include-table", action="append", default=[], dest="include_tables")
    convert = jobs.add_parser("convert", help="migrate a legacy archive")
    convert.add_argument("out")
    convert.add_argument("legacy")
    convert.add_argument("--target", help="an archive with the tables, columns and constraints of the new schema")
    for job in (merge, convert):
        job.add_argument("--versioned", action="store_true", help="publish as a new version in OUT, with a pointer to it")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("sediment").getOrCreate()
    if args.job == "merge":
        result = merge_archives(
            spark,
            args.snapshots,
            args.out,
            map_mode=args.map_mode,
            stale=args.stale,
            include_tables=args.include_tables,
            versioned=args.versioned,
        )
        for r in result.ranked:
            print(f"{r.merge_rank}. {r.path}{' (base)' if r.is_base else ''}")
    else:
        result = convert_archive(spark, args.legacy, args.out, args.target, versioned=args.versioned)
    for note in result.notes:
        print(note)
    print(f"written: {args.out}")


if __name__ == "__main__":
    main()
