"""Small hand-made inputs in the raw tables' shapes."""

from __future__ import annotations

import datetime as dt

from wardflow.sources import Sources, provider_type_codes
from wardflow.sources.schemas import (
    ADMISSION_EVENTS,
    HOSPITAL_NAMES,
    METRIC_NAMES,
    RAW_HOSPITALS,
    RAW_METRICS,
    RAW_PROVIDERS,
)

D = dt.date


def metric_row(facility=10001, measure="READM-30-HF-HRRP", **changes):
    row = dict.fromkeys(METRIC_NAMES)
    row |= {
        "Facility ID": facility,
        "Facility Name": f"Hospital {facility}",
        "State": "AL",
        "Measure Name": measure,
        "Number of Discharges": "100",
        "Excess Readmission Ratio": "1.05",
        "Predicted Readmission Rate": "15.5",
        "Expected Readmission Rate": "14.8",
        "Number of Readmissions": "20",
        "Start Date": "2021-07-01",
        "End Date": "06/30/2024",
    }
    return row | changes


def hospital_row(facility="010001", **changes):
    row = dict.fromkeys(HOSPITAL_NAMES, "3")
    row |= {
        "Facility ID": facility,
        "Facility Name": f"Hospital {facility}",
        "Address": "1 Main St",
        "City/Town": "Town",
        "State": "AL",
        "Hospital Type": "Acute Care Hospitals",
        "Hospital Ownership": "Proprietary",
        "Emergency Services": "Yes",
        "Meets criteria for birthing friendly designation": "No",
        "Hospital overall rating": "4",
    }
    return row | changes


def provider_row(ccn="010001", **changes):
    row = {field.name: None for field in RAW_PROVIDERS.fields}
    row |= {
        "providerCcn": ccn,
        "providerType": "00",
        "stateCode": "01",
        "bedSize": 120,
        "hrrAdjustment": 0.985,
        "fiscalYearBeginDate": 20240701,
        "fiscalYearEndDate": 20250630,
        "effectiveDate": 20240701,
        "exportDate": 20250101,
        "terminationDate": 20610701,
        "lastUpdated": "2025-01-01",
        "internsToBedsRatio": 0.25,
        "censusDivision": "6",
    }
    return row | changes


def event_row(
    number, patient="P1", admitted=D(2026, 1, 1), days=4, kind="Emergency", diagnosis="AMI", facility=10001
):
    return (
        f"A{number:03d}",
        patient,
        facility,
        admitted,
        admitted and admitted + dt.timedelta(days),
        kind,
        diagnosis,
        days,
    )


def frame(spark, data, schema):
    rows = [tuple(row[name] for name in schema.names) for row in data]
    return spark.createDataFrame(rows, schema)


def sources(spark, metrics=None, hospitals=None, providers=None, events=None):
    """Sources with one matching row each, unless given."""
    return Sources(
        metrics=frame(spark, metrics or [metric_row(100001)], RAW_METRICS),
        hospitals=frame(spark, hospitals or [hospital_row("100001")], RAW_HOSPITALS),
        providers=frame(spark, providers or [provider_row("100001")], RAW_PROVIDERS),
        events=spark.createDataFrame(
            events or [event_row(1, facility=100001)], ADMISSION_EVENTS
        ),
        provider_types=provider_type_codes(spark),
    )
