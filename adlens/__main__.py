"""Command line: run the five stages and print the run report as JSON.

    python -m adlens --raw /shared/ads/incoming --warehouse /shared/ads/warehouse
    python -m adlens --testdata /root/testdata/sf0.01 [--warehouse DIR] [--rules all]

Without ``--warehouse`` a fresh folder under ``spark.checkpoint.dir`` is used.
"""

from __future__ import annotations

import argparse
import json

from adlens.config import AGE_GROUPS, GENDERS, VALID_CAMPAIGN_IDS
from adlens.plans.pipeline import run_pipeline
from adlens.session import build_session
from adlens.sources.raw import land_raw, read_raw_csv
from adlens.sources.testdata import ad_rows_from_lineitem


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="adlens", description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw", help="folder or glob of raw ad-row CSV files")
    src.add_argument("--testdata", help="scale-factor folder of the test tables")
    ap.add_argument("--warehouse", help="output folder on shared storage")
    ap.add_argument("--rules", choices=["campaign", "all"], default="campaign",
                    help="rows loaded into bronze: rule 1 only (default) or all rules")
    ap.add_argument("--campaigns", help="allowed campaign ids, by commas")
    ap.add_argument("--ages", help="age groups of the silver layer, by commas")
    ap.add_argument("--genders", help="genders of the silver layer, by commas")
    ap.add_argument("--partitions", type=int, help="deal the landed raw rows into so many partitions")
    ap.add_argument("--master", help="Spark master, e.g. local[8]")
    args = ap.parse_args(argv)
    spark = build_session(args.master)
    raw = land_raw(read_raw_csv(spark, args.raw) if args.raw
                   else ad_rows_from_lineitem(spark, args.testdata), args.partitions)

    def listed(text, default):
        return tuple(x.strip() for x in text.split(",")) if text else default

    wh, rep = run_pipeline(spark, raw, args.warehouse, load_rules=args.rules,
                           campaign_ids=listed(args.campaigns, VALID_CAMPAIGN_IDS),
                           ages=listed(args.ages, AGE_GROUPS), genders=listed(args.genders, GENDERS))
    print(json.dumps({"warehouse": wh.root, "timings": rep.timings, "validation": rep.validation,
                      "load": rep.load, "checks": rep.checks}, default=str))
    spark.stop()


if __name__ == "__main__":
    main()
