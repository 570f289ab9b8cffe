"""Jobs for spark-submit: load the seed tables, refresh, test or audit the models."""

from __future__ import annotations

import argparse
import sys

from wardflow.plans import audits
from wardflow.plans.build import ChecksFailed, TestResult, build_all, save_seeds, test_tables
from wardflow.operators.sinks import layer_table
from wardflow.session import build_session
from wardflow.sources import read_csv, sources_from_catalog
from wardflow.sources.schemas import ADMISSION_EVENTS, PROVIDER_TYPES


def arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="wardflow", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    seed = jobs.add_parser("seed", help="write the event and provider type tables")
    seed.add_argument("events", help="CSV of admission events")
    seed.add_argument("--provider-types", help="CSV of provider types; default: the built-in list")
    build = jobs.add_parser("build", help="refresh and test every model")
    build.add_argument("--raw-schema", default="workspace.hrrp_raw")
    build.add_argument("--seed-schema", default="hrrp_seeds")
    build.add_argument("--ccn-padded", action="store_true", help="join on zero-padded numbers")
    build.add_argument("--keep-going", action="store_true", help="publish despite failed tests")
    jobs.add_parser("test", help="test the models of the last refresh; 1 when a test failed")
    audit = jobs.add_parser("audit", help="print the audits of the last refresh")
    audit.add_argument("--raw-schema", default="workspace.hrrp_raw")
    audit.add_argument("--seed-schema", default="hrrp_seeds")
    return parser.parse_args(argv)


def show(results: list[TestResult]) -> None:
    """Every test that did not pass, warnings included, and how many did."""
    for result in results:
        if result.status != "PASS":
            print(f"{result.status} {result.check} ({result.violations})", file=sys.stderr)
    print(f"{sum(r.status == 'PASS' for r in results)} of {len(results)} tests passed", file=sys.stderr)


def main(argv: list[str] | None = None) -> int:
    options = arguments(argv)
    spark = build_session()
    if options.job == "seed":
        types = options.provider_types
        save_seeds(
            spark,
            read_csv(spark, options.events, ADMISSION_EVENTS),
            read_csv(spark, types, PROVIDER_TYPES) if types else None,
        )
        return 0
    if options.job == "test":
        results = test_tables(spark)
        show(results)
        return int(any(result.status == "FAIL" for result in results))
    if options.job == "audit":
        raw = sources_from_catalog(spark, options.raw_schema, options.seed_schema)
        for rows in audits.all_audits(raw, lambda layer, name: spark.table(layer_table(layer, name))):
            for row in rows.toLocalIterator():
                print(" ".join(f"{name}={value}" for name, value in row.asDict().items()))
        return 0
    try:
        build_all(
            spark,
            sources_from_catalog(spark, options.raw_schema, options.seed_schema),
            ccn_padded=options.ccn_padded,
            block_on_failure=not options.keep_going,
            report=show,
        )
    except ChecksFailed as failure:
        print(failure, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
