import datetime as dt
from dataclasses import replace
from types import SimpleNamespace

import pytest
from fixtures import event_row, hospital_row, metric_row, provider_row, sources
from pyspark.sql import functions as F

from wardflow.__main__ import main, show
from wardflow.operators.sinks import (
    layer_schema,
    layer_table,
    publish_version,
    save_table,
    save_version,
    save_view,
)
from wardflow.plans import audits, build, reports, staging
from wardflow.session import materialize, shared_folder
from wardflow.sources import condition_rows, conform, read_csv, sources_from_catalog, sources_from_files
from wardflow.sources.schemas import ADMISSION_EVENTS, PROVIDER_TYPES, RAW_METRICS

D = dt.date


def test_events_csv(spark, tmp_path):
    path = tmp_path / "raw_readmissions_events.csv"
    path.write_text(
        "patient_id,admission_id,facility_id,admission_date,discharge_date,"
        "admission_type,diagnosis_category,length_of_stay,extra\n"
        "P1,A1,100001,2026-01-05,2026-01-09,Emergency,AMI,4,x\n"
        "P1,A2,100001,02/01/2026,,Planned,,oops,x\n"
    )
    df = read_csv(spark, str(path), ADMISSION_EVENTS)
    assert df.schema.names == ADMISSION_EVENTS.names
    assert [f.dataType for f in df.schema.fields] == [f.dataType for f in ADMISSION_EVENTS.fields]
    assert [tuple(row) for row in df.orderBy("admission_id").collect()] == [
        ("A1", "P1", 100001, D(2026, 1, 5), D(2026, 1, 9), "Emergency", "AMI", 4),
        ("A2", "P1", 100001, D(2026, 2, 1), None, "Planned", None, None),
    ]


def test_type_codes_csv_keeps_leading_zeros(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_text(
        "provider_type_code,provider_type_label,category,is_hrrp_eligible\n"
        "00,Short-term,Hospital,true\n01,Hospital,Hospital,false\n"
    )
    rows = read_csv(spark, str(path), PROVIDER_TYPES).collect()
    assert [(r["provider_type_code"], r["is_hrrp_eligible"]) for r in rows] == [
        ("00", True),
        ("01", False),
    ]


def test_conform_restores_type_codes_guessed_as_numbers(spark):
    guessed = spark.sql("SELECT 0 AS provider_type_code, 'x' AS provider_type_label, "
                        "'y' AS category, 'true' AS is_hrrp_eligible, 1 AS extra")
    row = conform(guessed, PROVIDER_TYPES).first()
    assert tuple(row) == ("00", "x", "y", True)


def test_conform_leaves_longer_type_codes_whole(spark):
    guessed = spark.sql("SELECT 123 AS provider_type_code UNION ALL SELECT 7 UNION ALL SELECT NULL")
    guessed = guessed.selectExpr("*", "'x' AS provider_type_label", "'y' AS category", "TRUE AS is_hrrp_eligible")
    codes = {r["provider_type_code"] for r in conform(guessed, PROVIDER_TYPES).collect()}
    assert codes == {"123", "07", None}


def test_metrics_csv_with_zero_padded_number(spark, tmp_path):
    path = tmp_path / "metrics.csv"
    names = ",".join(f'"{name}"' for name in RAW_METRICS.names)
    values = ["010001", "A", "AL", "READM-30-HF-HRRP", "N/A", *["1"] * 4, "x", "y", ""]
    path.write_text(f"{names}\n{','.join(values)}\n")
    row = read_csv(spark, str(path), RAW_METRICS).first()
    assert row["Facility ID"] == 10001 and row["Number of Discharges"] == "N/A"


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_sources_from_files(spark, tmp_path, file_format):
    made = sources(spark)
    for name, table in {
        "metrics": "raw_hospital_readmissions",
        "providers": "raw_providers",
        "hospitals": "raw_admissions",
        "events": "raw_readmissions_events",
        "provider_types": "cms_provider_type_codes",
    }.items():
        writer = getattr(made, name).write.option("header", True)
        writer.format(file_format).save(str(tmp_path / f"{table}.{file_format}"))
    read = sources_from_files(spark, str(tmp_path), file_format)
    for name in ("metrics", "providers", "hospitals", "events", "provider_types"):
        before, after = getattr(made, name), getattr(read, name)
        assert sorted(map(str, before.collect())) == sorted(map(str, after.collect())), name


def test_layer_names():
    assert layer_schema(" custom ", "sandbox") == "custom"
    assert layer_schema(None, "sandbox") == "sandbox"
    assert layer_table("marts", "dim_providers") == "hrrp_marts.dim_providers"
    assert layer_table("marts", "t", "sandbox", {}) == "sandbox.t"


def test_sinks(spark):
    df = spark.range(3)
    assert save_table(df, "sink_test.numbers").count() == 3
    assert save_table(spark.range(2), "sink_test.numbers").count() == 2
    save_view(df, "numbers_view")
    assert spark.table("numbers_view").count() == 3


def test_materialize_writes_to_the_shared_folder(spark):
    df = materialize(spark.range(5), "five")
    assert df.count() == 5
    folder = shared_folder(spark)
    assert all(folder.rstrip("/").split("/")[-1] in path for path in df.inputFiles())
    assert shared_folder(spark) == folder


def test_shared_folder_prefers_the_named_one():
    named = {"spark.checkpoint.dir": "hdfs://shared/folder"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: named.get(key, default)))
    assert shared_folder(session) == "hdfs://shared/folder"


def test_build_from_catalog(spark):
    made = sources(
        spark, events=[event_row(1, facility=100001), event_row(2, "P1", D(2026, 1, 9), facility=100001)]
    )
    save_table(made.metrics, "hrrp_raw.raw_hospital_readmissions")
    save_table(made.providers, "hrrp_raw.raw_providers")
    save_table(made.hospitals, "hrrp_raw.raw_admissions")
    build.save_seeds(spark, made.events)
    built = build.build_all(spark, sources_from_catalog(spark, "hrrp_raw"))
    assert spark.table("hrrp_marts.fct_readmissions").count() == 2
    assert spark.table("hrrp_marts.int_readmissions_flagged").where("is_readmission").count() == 1
    assert spark.table("hrrp_marts.dim_conditions").count() == 6
    # Staging outlives the session: another one reads the views.
    other = spark.newSession()
    assert other.table("hrrp_staging.stg_admissions").first()["facility_id"] == 100001
    assert other.table("hrrp_staging.stg_providers").count() == 1
    assert not [t for t in spark.catalog.listTables() if t.isTemporary and t.name.startswith("stg_")]
    report = reports.readmission_rate_by_condition_state(
        built.fct_readmissions, built.dim_conditions, built.dim_providers
    )
    assert [tuple(r) for r in report.collect()] == [("Heart Attack (AMI)", "01", 2, 1, 50.0)]
    # A second full refresh replaces the tables.
    build.build_all(spark, sources_from_catalog(spark, "hrrp_raw", bundled_provider_types=True))
    assert spark.table("hrrp_marts.fct_readmissions").count() == 2
    # The views follow their tables.
    save_table(made.hospitals.limit(0), "hrrp_raw.raw_admissions")
    other.catalog.refreshTable("hrrp_raw.raw_admissions")
    assert other.table("hrrp_staging.stg_admissions").count() == 0


def test_views_equal_the_models(spark):
    hospitals = [hospital_row(str(i), **{"Hospital Ownership": o}) for i, o in enumerate(["Proprietary", "Veterans Health Administration", None, "O'Neil \\ Co"])]
    texts = ["Not Available", "N/A", "", None, "1.5", "x", "Too Few to Report"]
    metrics = [metric_row(i, **{"Excess Readmission Ratio": t, "Number of Discharges": t, "Start Date": t}) for i, t in enumerate(texts)]
    providers = [
        provider_row("1", effectiveDate=20240101), provider_row("1", exportDate=20250202), provider_row("2", providerType="04"),
        provider_row("3", fiscalYearBeginDate=20190101), provider_row("4", terminationDate=20240230), provider_row("5", fiscalYearEndDate=19000101),
    ]
    made = sources(spark, metrics=metrics, hospitals=hospitals, providers=providers)
    # Uploads with guessed types, which the views bring to the contract.
    save_table(made.metrics.withColumn("Facility ID", F.col("Facility ID").cast("string")), "view_raw.raw_hospital_readmissions")
    save_table(made.hospitals, "view_raw.raw_admissions")
    typed = made.providers.withColumn("providerType", F.col("providerType").cast("int"))
    save_table(typed.withColumn("bedSize", F.col("bedSize").cast("string")), "view_raw.raw_providers")
    build.save_seeds(spark, made.events, schemas={"seeds": "view_seeds"})
    read = sources_from_catalog(spark, "view_raw", "view_seeds")
    views = build.staged_views(spark, read, lambda layer, name: f"view_{layer}.{name}")
    plain = build.staged_views(spark, made, lambda layer, name: name)
    for name, view in views.items():
        assert sorted(map(str, view.collect())) == sorted(map(str, plain[name].collect())), name
        assert view.schema == plain[name].schema or name == "stg_providers"
    bundled = sources_from_catalog(spark, "view_raw", "view_seeds", bundled_provider_types=True)
    assert spark.sql(staging.staging_views(bundled.texts)["stg_providers"]).count() == plain["stg_providers"].count()


def test_failed_refresh_leaves_the_old_tables(spark):
    made = sources(spark, events=[event_row(1, facility=100001)])
    names = {"schemas": {}, "default_schema": "kept"}
    build.build_all(spark, made, **names)
    before = spark.table("kept.fct_readmissions").collect()
    files = spark.table("kept.fct_readmissions").inputFiles()
    orphan = replace(made, events=spark.createDataFrame([event_row(2, facility=7), event_row(2, facility=7)], ADMISSION_EVENTS))
    with pytest.raises(build.ChecksFailed) as failure:
        build.build_all(spark, orphan, **names)
    assert dict(failure.value.failed) == {"unique_fct_readmissions_admission_id": 1, "relationships_fct_readmissions_facility_id": 2}
    assert spark.table("kept.fct_readmissions").collect() == before
    assert spark.table("kept.fct_readmissions").inputFiles() == files
    assert spark.table("kept.dim_providers").count() == 1
    # What passes replaces all tables; a query that has begun still finds the files before.
    begun = spark.table("kept.fct_readmissions")
    more = replace(made, events=spark.createDataFrame([event_row(i, f"P{i}", facility=100001) for i in range(5)], ADMISSION_EVENTS))
    build.build_all(spark, more, **names)
    assert spark.table("kept.fct_readmissions").count() == 5 and begun.collect() == before
    build.build_all(spark, made, **names)
    assert spark.table("kept.fct_readmissions").count() == 1


def test_versions_of_a_table(spark):
    for version, rows in (("v1", 3), ("v2", 5), ("v3", 7)):
        save_version(spark.range(rows), "versioned.numbers", version)
        assert publish_version(spark, "versioned.numbers", version).count() == rows
    folder = spark.catalog.getDatabase("versioned").locationUri
    kept = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{folder}/_versions/numbers")
    assert {r.path.split("/")[-2] for r in kept.select("path").collect()} == {"v2", "v3"}
    # Other columns: the table is made anew.
    save_version(spark.range(2).selectExpr("id", "id + 1 AS next"), "versioned.numbers", "v4")
    assert publish_version(spark, "versioned.numbers", "v4").columns == ["id", "next"]
    # A table that an older release wrote in place.
    save_table(spark.range(4), "versioned.managed")
    save_version(spark.range(6), "versioned.managed", "v1")
    assert publish_version(spark, "versioned.managed", "v1").count() == 6


def test_row_tests_are_counted_while_writing(spark):
    counted = build.Counted()
    fact = spark.createDataFrame(
        [("A1", 1, D(2026, 1, 1), True, "Cancer Treatment", "Planned", 31), (None, None, None, False, "AMI", "Planned", 3)],
        "admission_id string, facility_id long, admission_date date, is_readmission boolean, "
        "diagnosis_category string, admission_type string, days_since_prior_discharge int",
    )
    written = counted.write("fct_readmissions", fact, lambda df: materialize(df, "fact"))
    assert written.count() == 2
    assert counted.counts == {
        "not_null_fct_readmissions_admission_id": 1,
        "not_null_fct_readmissions_facility_id": 1,
        "not_null_fct_readmissions_admission_date": 1,
        "fct_readmissions_no_planned_cancer_flagged": 1,
        "fct_readmissions_flags_within_30_days": 1,
    }
    counted.write("fct_readmissions", fact.limit(0), lambda df: materialize(df, "fact"))
    assert set(counted.counts.values()) == {0}


def test_conform_losses(spark):
    uploaded = spark.createDataFrame(
        [("A1", "P", "7", "2026-01-05", "01/09/2026", "E", "AMI", "4"), ("A2", "P", "x", "soon", None, "E", "AMI", "4.5"), ("A3", None, None, None, "9", None, None, None)],
        "admission_id string, patient_id string, facility_id string, admission_date string, discharge_date string, "
        "admission_type string, diagnosis_category string, length_of_stay string",
    )
    got = {r.column_name: r.lost_values for r in audits.conform_losses(uploaded, "events", ADMISSION_EVENTS).collect()}
    assert got == {"facility_id": 1, "admission_date": 1, "discharge_date": 1, "length_of_stay": 1}
    assert audits.conform_losses(conform(uploaded, ADMISSION_EVENTS), "events", ADMISSION_EVENTS).count() == 0
    dates = sources(spark, providers=[provider_row("1", terminationDate=20240230), provider_row("2", effectiveDate=7), provider_row("3")])
    lost = audits.cast_losses(dates.metrics, dates.hospitals, dates.providers).where("table_name = 'raw_providers'")
    assert {r.column_name: r.lost_values for r in lost.collect() if r.lost_values} == {"terminationDate": 1, "effectiveDate": 1}


def test_build_stops_at_failed_staging(spark):
    made = sources(spark, hospitals=[hospital_row("1"), hospital_row("1")])
    made = replace(made, events=made.events.limit(0))
    with pytest.raises(build.ChecksFailed) as failure:
        build.build_all(spark, made, schemas={}, default_schema="stopped")
    assert failure.value.failed == [("unique_stg_admissions_facility_id", 1)]
    assert not spark.catalog.databaseExists("stopped")
    build.build_all(spark, made, schemas={}, default_schema="stopped", block_on_failure=False)
    assert spark.table("stopped.dim_providers").count() == 1


def test_jobs(spark, tmp_path, capsys):
    made = sources(spark)
    save_table(made.metrics, "job_raw.raw_hospital_readmissions")
    save_table(made.providers, "job_raw.raw_providers")
    save_table(made.hospitals, "job_raw.raw_admissions")
    events = tmp_path / "events.csv"
    header = ",".join(ADMISSION_EVENTS.names)
    events.write_text(f"{header}\nA1,P1,100001,2026-01-05,2026-01-09,Emergency,AMI,4\n")
    assert main(["seed", str(events)]) == 0
    assert main(["build", "--raw-schema", "job_raw"]) == 0
    assert spark.table("hrrp_marts.fct_readmissions").first()["admission_id"] == "A1"

    # A measure that no condition has is worth a warning, no more.
    assert main(["test"]) == 0
    assert "27 of 27 tests passed" in capsys.readouterr().err
    assert main(["audit", "--raw-schema", "job_raw"]) == 0
    printed = capsys.readouterr().out
    assert "audit_check=fct_readmissions: referential integrity total_fct_rows=1" in printed
    assert "table_name=raw_providers column_name=terminationDate lost_values=0" in printed

    # Violations of what has been published: the job tells warnings from failures.
    conditions = spark.table("hrrp_marts.dim_conditions")
    save_version(conditions.where("measure_code <> 'READM-30-AMI-HRRP'"), "hrrp_marts.dim_conditions", "z1")
    publish_version(spark, "hrrp_marts.dim_conditions", "z1")
    assert main(["test"]) == 0
    assert "WARN relationships_fct_readmissions_measure_code (1)" in capsys.readouterr().err
    save_version(spark.table("hrrp_marts.dim_providers").limit(0), "hrrp_marts.dim_providers", "z1")
    publish_version(spark, "hrrp_marts.dim_providers", "z1")
    assert main(["test"]) == 1
    shown = capsys.readouterr().err
    assert "FAIL relationships_fct_readmissions_facility_id (1)" in shown and "WARN relationships" in shown

    events.write_text(f"{header}\nA1,P1,7,2026-01-05,2026-01-09,Emergency,AMI,4\n")
    assert main(["seed", str(events)]) == 0
    assert main(["build", "--raw-schema", "job_raw"]) == 1
    assert "relationships_fct_readmissions_facility_id (1)" in capsys.readouterr().err


def test_build_shows_warnings(spark, capsys):
    made = sources(spark)
    shown = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(build.marts, "dim_conditions", lambda spark: condition_rows(spark).where("sort_order > 1"))
        build.build_all(spark, made, schemas={}, default_schema="warned", report=shown.extend)
    assert {r.check: (r.violations, r.status) for r in shown if r.status != "PASS"} == {
        "relationships_fct_readmissions_measure_code": (1, "WARN")
    }
    assert len(shown) == 27 and spark.table("warned.fct_readmissions").count() == 1
    show(shown)
    assert "WARN relationships_fct_readmissions_measure_code (1)" in capsys.readouterr().err
