"""Run the feature job on stored source tables.

    python -m vitrina --root <folder with the 8 tables> --out <feature table path> \\
        [--category "FRAGANCIAS" [--category "MAQUILLAJE" ...]] [--closed-from 201401 --closed-to 201714 --open-from 201715 --open-to 201806] \\
        [--strict] [--format parquet] [--normalised]

The eight tables are read from ``<root>/<source name>`` (DPais, DPRODUCTO, DTIPOOFERTA, FVTAPROEBECAMC01,
DMATRIZCAMPANA, FVTAPROCAMMES, DAPOYOPRODUCTO, FNUMPEDCAM); the result is written partitioned by campaign,
replacing only the campaigns of the run.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .params import Params
from .plans.feature_job import feature_table
from .plans.settings import job_session
from .plans.sink import write_features
from .session import ensure_checkpoint_dir, remove_stored
from .sources.tables import read_tables


def parse(argv=None) -> argparse.Namespace:
    defaults = Params()
    ap = argparse.ArgumentParser(prog="vitrina", description="demand feature table")
    ap.add_argument("--root", required=True, help="folder holding the eight source tables")
    ap.add_argument("--out", required=True, help="output path of the feature table")
    ap.add_argument("--format", default="parquet", help="storage format of the source tables")
    ap.add_argument("--normalised", action="store_true", help="the tables were written by store_tables")
    ap.add_argument("--category", action="append", help=f"repeat it for several categories in one run (default {defaults.category})")
    ap.add_argument("--closed-from", default=defaults.closed_from)
    ap.add_argument("--closed-to", default=defaults.closed_to)
    ap.add_argument("--open-from", default=defaults.open_from)
    ap.add_argument("--open-to", default=defaults.open_to)
    ap.add_argument("--development-to", default=defaults.development_to)
    ap.add_argument("--key-filter-bits", type=int, help="filter the fact scans by the run's products, for product tables too large to broadcast")
    ap.add_argument("--strict", action="store_true", help="fail on unparsable exposure texts and zero order counts")
    return ap.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    ensure_checkpoint_dir(spark)
    chosen = args.category or [Params().category]
    p = Params(closed_from=args.closed_from, closed_to=args.closed_to, open_from=args.open_from,
               open_to=args.open_to, category=chosen[0], categories=tuple(chosen) if len(chosen) > 1 else (), development_to=args.development_to,
               strict=args.strict, key_filter_bits=args.key_filter_bits)
    tables = read_tables(job_session(spark), args.root, args.format, normalised=args.normalised)
    write_features(feature_table(tables, p), args.out)


def main(argv=None) -> None:
    spark = SparkSession.builder.appName("vitrina").getOrCreate()
    try:
        run(spark, parse(argv))
    finally:
        remove_stored(spark)


if __name__ == "__main__":
    main()
