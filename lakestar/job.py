"""Layers as a job for spark-submit.

    spark-submit --py-files lakestar.zip lakestar/job.py --raw s3a://raw --bronze s3a://bronze --silver s3a://silver --gold s3a://gold
    spark-submit ... lakestar/job.py ... --step silver --step icu --keep-times

Without ``--step`` all run. Settings of the session, the shared ``spark.checkpoint.dir`` among them, are given to spark-submit.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from lakestar.plans.refresh import STEPS, Layers, cut_id_specs, refresh
from lakestar.plans.silver import SILVER_TABLES, keep_times
from lakestar.session import build_session
from lakestar.sources.tables import DEFAULT_FORMAT


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    for root in ("raw", "bronze", "silver", "gold"):
        parser.add_argument(f"--{root}", required=True, help=f"root of the {root} layer")
    parser.add_argument("--rejects", help="root of the tables of malformed raw lines; without it they are cut or padded")
    parser.add_argument("--keys", help="root of the key tables; without it surrogate keys are made anew with their dimension")
    parser.add_argument("--step", action="append", choices=STEPS, help="step to run, may be repeated; all by default")
    parser.add_argument("--format", default=DEFAULT_FORMAT, help="table format of all layers but the raw one")
    parser.add_argument("--codes", nargs="+", default=["icd_code", "icd_version"], help="columns that name a diagnosis")
    parser.add_argument("--on", nargs="+", default=["emar_id", "emar_seq"], help="columns that tie a detail to its administration")
    parser.add_argument("--keep-times", action="store_true", help="typed dates keep their time of day")
    parser.add_argument("--cut-ids", action="store_true", help="composite ids are cut to ints, which merges some")
    parser.add_argument("--repair", action="store_true", help="write tables anew that a failed job left without a marker")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    given = _arguments(argv)
    specs = cut_id_specs() if given.cut_ids else SILVER_TABLES
    if given.keep_times:
        specs = {table: keep_times(spec) for table, spec in specs.items()}
    layers = Layers(
        spark or build_session("lakestar-refresh"), given.raw, given.bronze, given.silver, given.gold, given.format, given.repair,
        given.rejects, given.keys,
    )
    refresh(layers, given.step or STEPS, specs, given.codes, given.on)


if __name__ == "__main__":
    main()
