"""One full refresh: models in dependency order, each layer tested before it counts."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardflow.operators.sinks import (
    layer_table,
    publish_version,
    save_catalog_view,
    save_table,
    save_version,
    save_view,
)
from wardflow.plans import intermediate, marts, staging, suite
from wardflow.session import materialize
from wardflow.sources.readers import Sources
from wardflow.sources.reference_rows import provider_type_codes


class TestResult(NamedTuple):
    """One data test: ``status`` is PASS, WARN or FAIL, as severity has it."""

    __test__ = False  # no test case of pytest

    check: str
    severity: str
    violations: int
    status: str


class ChecksFailed(RuntimeError):
    """Error-level data tests with violations; ``failed`` lists (check, violations)."""

    def __init__(self, layer: str, failed: list[tuple[str, int]]):
        super().__init__(f"{layer}: " + ", ".join(f"{name} ({n})" for name, n in failed))
        self.failed = failed


def results_of(results: DataFrame) -> list[TestResult]:
    """Rows of a suite, one per test."""
    rows = results.select("check", "severity", "violations", "status").collect()
    return sorted(TestResult(*row) for row in rows)


def require(results: list[TestResult], layer: str) -> None:
    """Raise if an error-level test failed."""
    failed = [(r.check, r.violations) for r in results if r.status == "FAIL"]
    if failed:
        raise ChecksFailed(layer, failed)


def save_seeds(
    spark: SparkSession,
    events: DataFrame,
    provider_types: DataFrame | None = None,
    *,
    default_schema: str = "default",
    schemas: dict[str, str] | None = None,
) -> None:
    """Write the event file and the provider type lookup as tables."""
    lookup = provider_type_codes(spark) if provider_types is None else provider_types
    for name, df in (("raw_readmissions_events", events), ("cms_provider_type_codes", lookup)):
        save_table(df, layer_table("seeds", name, default_schema, schemas))


@dataclass
class Counted:
    """Violations of row tests, counted while models are written."""

    counts: dict[str, int] = field(default_factory=dict)

    def write(self, model: str, df: DataFrame, write: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Write ``df`` and keep the counts of its row tests; no row is read twice for them."""
        tests = suite.row_tests(model)
        if not tests:
            return write(df)
        seen = Observation(f"{model}-{uuid.uuid4().hex}")
        counted = [F.count_if(broken).alias(name) for name, broken in tests.items()]
        written = write(df.observe(seen, *counted))
        self.counts |= seen.get
        return written

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(sorted(self.counts.items()), "check string, violations long")


def build_all(
    spark: SparkSession,
    sources: Sources,
    *,
    default_schema: str = "default",
    schemas: dict[str, str] | None = None,
    ccn_padded: bool = False,
    block_on_failure: bool = True,
    report: Callable[[list[TestResult]], None] = lambda results: None,
) -> suite.Models:
    """Refresh every model and return them, marts as the tables that were published.

    Staging models are views of the catalog where the inputs are catalog tables, else
    temporary ones. The later models are written next to the tables of the last refresh,
    which are replaced when all tests have passed: a failed refresh leaves them as they
    were. Tests on single rows are counted while a model is written; the other tests read
    what was written. ``report`` gets the results of each layer, also the warnings.
    With ``block_on_failure`` a layer whose tests failed raises ``ChecksFailed``.
    """
    version = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    written: list[str] = []

    def table_of(layer: str, name: str) -> str:
        return layer_table(layer, name, default_schema, schemas)

    def write(counted: Counted, layer: str, name: str, df: DataFrame) -> DataFrame:
        table = table_of(layer, name)
        written.append(table)
        return counted.write(name, df, lambda rows: save_version(rows, table, version))

    def tested(layer: str, results: DataFrame) -> None:
        found = results_of(suite.with_status(results))
        report(found)
        if block_on_failure:
            require(found, layer)

    models = staged_views(spark, sources, table_of)
    counted = Counted()
    staged = suite.Models(
        **models
        # The one staging model that sorts; three tests and a model read it.
        | {
            "stg_providers": counted.write(
                "stg_providers", models["stg_providers"], lambda rows: materialize(rows, "stg_providers")
            )
        }
    )
    tested(
        "staging",
        suite.not_null_tests(staged, ("stg_hrrp_metrics", "stg_admissions"))
        .unionByName(counted.rows(spark))
        .unionByName(suite.staging_set_tests(staged)),
    )

    counted = Counted()
    enriched = write(
        counted,
        "intermediate",
        "int_providers_enriched",
        intermediate.int_providers_enriched(
            staged.stg_hrrp_metrics,
            staged.stg_providers,
            staged.stg_admissions,
            ccn_padded=ccn_padded,
        ),
    )
    flagged = write(
        counted,
        "intermediate",
        "int_readmissions_flagged",
        intermediate.int_readmissions_flagged(sources.events),
    )
    built = replace(
        staged,
        dim_providers=write(counted, "marts", "dim_providers", marts.dim_providers(enriched)),
        dim_conditions=write(counted, "marts", "dim_conditions", marts.dim_conditions(spark)),
        fct_readmissions=write(counted, "marts", "fct_readmissions", marts.fct_readmissions(flagged)),
    )
    tested(
        "marts",
        counted.rows(spark)
        .unionByName(suite.unique_tests(built, suite.MART_MODELS))
        .unionByName(suite.relationships_tests(built)),
    )
    published = {table.rpartition(".")[2]: publish_version(spark, table, version) for table in written}
    return replace(built, **{name: published[name] for name in suite.MART_MODELS})


def staged_views(
    spark: SparkSession, sources: Sources, table_of: Callable[[str, str], str]
) -> dict[str, DataFrame]:
    """Register the staging models as views and return them."""
    if sources.texts:
        return {
            name: save_catalog_view(spark, table_of("staging", name), query)
            for name, query in staging.staging_views(sources.texts).items()
        }
    models = {
        "stg_hrrp_metrics": staging.stg_hrrp_metrics(sources.metrics),
        "stg_admissions": staging.stg_admissions(sources.hospitals),
        "stg_providers": staging.stg_providers(sources.providers, sources.provider_types),
    }
    return {name: save_view(df, name) for name, df in models.items()}


def test_tables(
    spark: SparkSession, *, default_schema: str = "default", schemas: dict[str, str] | None = None
) -> list[TestResult]:
    """Run all tests on the views and tables of the last refresh, without building anything."""

    def read(layer: str, name: str) -> DataFrame:
        return spark.table(layer_table(layer, name, default_schema, schemas))

    models = suite.Models(
        **{name: read("staging", name) for name in suite.STAGING_MODELS},
        **{name: read("marts", name) for name in suite.MART_MODELS},
    )
    models = replace(models, stg_providers=materialize(models.stg_providers, "stg_providers"))
    summary = materialize(suite.fact_summary(models.fct_readmissions), "fact_summary")
    return results_of(suite.dq_suite(models, summary))


test_tables.__test__ = False
