"""Batch entry point: build and write feature snapshots (the monthly backfill job).

    spark-submit -m marketlens.plans.jobs --group products \\
        --first 2017-01-01 --last 2018-07-01 --database marketplace --table fs.fs_products

    python -m marketlens.plans.jobs --group delivery --ref 2018-07-01 --parquet-root /data/marketplace \\
        --path /warehouse/fs_delivery

Every group but payments builds the whole month spine in one job and
replaces exactly those snapshot partitions.  Payments covers every month
with a sale before ``--ref`` in one build and is overwritten as a whole table
(S13); a spine is refused for it.
"""

from __future__ import annotations

import argparse

from marketlens.functions.dates import month_starts, snapshot_dates
from marketlens.plans import snapshots
from marketlens.session import get_spark
from marketlens.sources.marketplace import from_catalog, from_parquet


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--group", required=True, choices=list(snapshots.GROUPS))
    ap.add_argument("--ref", help="one reference date (yyyy-mm-dd)")
    ap.add_argument("--first", help="first month start of the spine")
    ap.add_argument("--last", help="last month start of the spine")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--database", help="catalog database holding the source tables")
    src.add_argument("--parquet-root", help="folder with one parquet folder per source table")
    dst = ap.add_mutually_exclusive_group(required=True)
    dst.add_argument("--table", help="target catalog table")
    dst.add_argument("--path", help="target parquet folder")
    args = ap.parse_args(argv)

    if args.ref:
        dates = list(snapshot_dates(args.ref))
    elif args.first and args.last:
        dates = month_starts(args.first, args.last)
    else:
        ap.error("give --ref or both --first and --last")

    if snapshots.GROUPS[args.group].whole and not args.ref:
        ap.error(f"{args.group} covers every month before one date: give --ref")

    spark = get_spark()
    mk = from_catalog(spark, args.database) if args.database else from_parquet(spark, args.parquet_root)
    snapshots.write_group(args.group, mk, dates, path=args.path, table=args.table)


if __name__ == "__main__":
    main()
