"""The pipeline's inputs, derived from the order tables of the test data.

Orders stand for admissions, suppliers for hospitals and order lines for
provider records, so every input grows with the tables it comes from.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.sources.reference_rows import MEASURE_CODES, provider_type_codes
from wardflow.sources.schemas import HOSPITAL_NAMES, PROVIDER_NAMES, RAW_PROVIDERS

DIAGNOSES = (
    "Heart Failure",
    "AMI",
    "Pneumonia",
    "COPD",
    "Hip Replacement",
    "CABG",
    "Surgical Complication",
    "Cancer Treatment",
    "Rehabilitation",
    "Transplant",
)
STATES = ("AL", "CA", "NY", "TX", "WA")
HOSPITAL_TYPES = (
    "Acute Care Hospitals",
    "Critical Access Hospitals",
    "Childrens",
    "Psychiatric",
)
OWNERS = (
    "Government - Federal",
    "Government - Hospital District or Authority",
    "Government - Local",
    "Government - State",
    "Proprietary",
    "Voluntary non-profit - Church",
    "Voluntary non-profit - Other",
    "Voluntary non-profit - Private",
    "Tribal",
    "Physician",
    "Department of Defense",
    "Veterans Health Administration",
)


def _pick(values, position: str) -> str:
    """SQL for the value at a zero-based position of a fixed list."""
    listed = ", ".join(f"'{value}'" for value in values)
    return f"get(array({listed}), CAST({position} AS INT))"


def facility_number(key: str) -> str:
    """Distinct hospital number per key: five or six digits for the first 990,000."""
    return f"(({key}) * 123457 % 990000 + 10000 + 1000000 * (({key}) div 990000))"


def ccn(key: str) -> str:
    text = f"CAST({facility_number(key)} AS STRING)"
    return f"CASE WHEN length({text}) < 6 THEN lpad({text}, 6, '0') ELSE {text} END"


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{text} AS `{name}`" for name, text in columns.items()])


def admission_events(orders: DataFrame, supplier: DataFrame) -> DataFrame:
    """One admission per order; one in about twenty hospitals is unknown elsewhere."""
    hospitals = supplier.agg(F.expr("count(*) + 1 + count(*) div 20")).scalar()
    placed = orders.withColumn("hospital", F.col("o_orderkey") % hospitals)
    return _select(
        placed,
        {
            "admission_id": "CAST(o_orderkey AS STRING)",
            "patient_id": "CAST(o_custkey AS STRING)",
            "facility_id": facility_number("hospital"),
            "admission_date": "CAST(o_orderdate AS DATE)",
            "discharge_date": "date_add(o_orderdate, CAST(o_orderkey % 7 + 1 AS INT))",
            "admission_type": """CASE o_orderpriority WHEN '5-LOW' THEN 'Planned'
                WHEN '4-NOT SPECIFIED' THEN 'Elective' ELSE 'Emergency' END""",
            "diagnosis_category": _pick(DIAGNOSES, "o_orderkey % 10"),
            "length_of_stay": "CAST(o_orderkey % 7 + 1 AS INT)",
        },
    )


def uploaded_events(events: DataFrame) -> DataFrame:
    """The admissions as an upload of texts, in which some dates and numbers cannot be read."""
    key = "CAST(admission_id AS BIGINT)"
    texts = {name: f"CAST({name} AS STRING)" for name in events.columns}
    texts |= {
        "facility_id": f"CASE WHEN {key} % 19 = 0 THEN concat('F', facility_id) ELSE CAST(facility_id AS STRING) END",
        "admission_date": f"""CASE WHEN {key} % 17 = 0 THEN 'pending'
            WHEN {key} % 13 = 0 THEN date_format(admission_date, 'MM/dd/yyyy')
            ELSE CAST(admission_date AS STRING) END""",
        "discharge_date": f"CASE WHEN {key} % 29 <> 0 THEN CAST(discharge_date AS STRING) END",
        "length_of_stay": f"CASE WHEN {key} % 23 = 0 THEN concat(length_of_stay, ' days') ELSE CAST(length_of_stay AS STRING) END",
    }
    return _select(events, texts)


def raw_hospital_readmissions(lineitem: DataFrame) -> DataFrame:
    """One row per supplier and measure, which the line number stands for."""
    grouped = lineitem.groupBy(
        "l_suppkey", F.expr("(l_linenumber - 1) % 6").alias("measure")
    ).agg(F.expr("count(*) AS n"), F.expr("sum(l_orderkey) % 600 + 700 AS k"))
    return _select(
        grouped,
        {
            "Facility ID": facility_number("l_suppkey"),
            "Facility Name": "concat('Facility ', l_suppkey)",
            "State": _pick(STATES, "l_suppkey % 5"),
            "Measure Name": _pick(MEASURE_CODES, "measure"),
            "Number of Discharges": """CASE WHEN n % 11 = 0 THEN 'Too Few to Report'
                WHEN n % 13 = 0 THEN 'Not Available' ELSE CAST(n AS STRING) END""",
            "Excess Readmission Ratio": """CASE WHEN k % 19 = 0 THEN 'Not Available'
                ELSE concat(k div 1000, '.', lpad(k % 1000, 3, '0')) END""",
            "Predicted Readmission Rate": """CASE WHEN k % 17 = 0 THEN 'N/A'
                ELSE concat(10 + k % 20, '.', k % 10) END""",
            "Expected Readmission Rate": """CASE WHEN k % 29 = 0 THEN ''
                ELSE concat('15.', lpad(n % 100, 2, '0')) END""",
            "Number of Readmissions": """CASE WHEN n % 7 = 0 THEN 'Too Few to Report'
                WHEN n % 17 = 0 THEN concat('about ', n div 5)
                ELSE CAST(n div 5 AS STRING) END""",
            "Start Date": """CASE WHEN k % 23 = 0 THEN 'Not Available'
                WHEN k % 2 = 0 THEN '2021-07-01' ELSE '07/01/2021' END""",
            "End Date": """CASE WHEN k % 31 = 0 THEN NULL
                WHEN k % 3 = 0 THEN '06/30/2024' ELSE '2024-06-30' END""",
            "Footnote": "CASE WHEN k % 5 = 0 THEN '5' END",
        },
    )


def raw_providers(lineitem: DataFrame) -> DataFrame:
    """One provider record per order line; one supplier in ten is of no eligible type."""
    day = "month(l_shipdate) * 100 + day(l_shipdate)"
    texts = {
        "providerCcn": ccn("l_suppkey"),
        "nationalProviderIdentifier": "1000000000 + l_suppkey",
        "providerType": """CASE WHEN l_suppkey % 10 = 3 THEN '05'
            WHEN l_returnflag = 'A' THEN '00' WHEN l_returnflag = 'N' THEN '04' ELSE '08' END""",
        "stateCode": "lpad(l_suppkey % 53 + 1, 2, '0')",
        "countyCode": "lpad(l_suppkey % 254 + 1, 3, '0')",
        "msaActualGeographicLocation": "1000 + l_suppkey % 8000",
        "cbsaActualGeographicLocation": "10000 + l_suppkey % 39000",
        "censusDivision": "l_suppkey % 9 + 1",
        "bedSize": "20 + l_suppkey * 37 % 900",
        "caseMixIndex": "(900 + l_orderkey % 1300) / 1000",
        "internsToBedsRatio": "(l_suppkey % 4) / 8",
        "medicaidRatio": "(l_partkey % 500) / 1000",
        "supplementalSecurityIncomeRatio": "(l_partkey % 300) / 1000",
        "operatingDsh": "(l_orderkey % 200) / 1000",
        "capitalIndirectMedicalEducationRatio": "(l_suppkey % 50) / 1000",
        "uncompensatedCareAmount": "l_extendedprice",
        "vbpParticipantIndicator": "CASE WHEN l_orderkey % 10 = 0 THEN 'N' ELSE 'Y' END",
        "vbpAdjustment": "(980 + l_orderkey % 41) / 1000",
        "hrrParticipantIndicator": "CASE WHEN l_orderkey % 29 = 0 THEN 'N' ELSE 'Y' END",
        "hrrAdjustment": "CASE WHEN l_orderkey % 29 <> 0 THEN (960 + l_orderkey % 45) / 1000 END",
        "hacReductionParticipantIndicator": "CASE WHEN l_partkey % 4 = 0 THEN 'Y' ELSE 'N' END",
        "ehrReductionIndicator": "CASE WHEN l_partkey % 9 = 0 THEN 'Y' END",
        "soleCommunityOrMedicareDependentHospitalBaseYear": "CASE WHEN l_suppkey % 6 = 0 THEN 1982 + l_suppkey % 40 END",
        "specialPaymentIndicator": "CASE WHEN l_suppkey % 8 = 0 THEN '1' END",
        "hospitalQualityIndicator": "CASE WHEN l_partkey % 5 = 0 THEN '1' END",
        "newHospital": "CASE WHEN l_suppkey % 50 = 0 THEN 'Y' ELSE 'N' END",
        "ltchDppIndicator": "CASE WHEN l_suppkey % 70 = 0 THEN 'Y' END",
        "operatingCostToChargeRatio": "(l_partkey % 700) / 1000",
        "capitalCostToChargeRatio": "(l_partkey % 80) / 1000",
        "caseMixAdjustedCostPerDischarge_PpsFacilitySpecificRate": "l_extendedprice * 0.5D",
        "passThroughAmountForCapital": "l_quantity",
        "passThroughAmountForDirectMedicalEducation": "l_discount",
        "passThroughAmountForDirectGraduateMedicalEducation": "l_tax",
        "passThroughAmountForOrganAcquisition": "l_quantity * 2",
        "passThroughAmountForKidneyAcquisition": "l_quantity * 4",
        "passThroughAmountForAllogenicStemCellAcquisition": "l_quantity * 8",
        "passThroughTotalAmount": "l_extendedprice * 2",
        "fiscalYearBeginDate": f"""CASE WHEN l_orderkey % 97 = 0 THEN 19000101
            ELSE (year(l_shipdate) + 24) * 10000 + {day} END""",
        "fiscalYearEndDate": f"(year(l_shipdate) + 25) * 10000 + {day}",
        "effectiveDate": "(year(l_shipdate) + 24) * 10000 + month(l_shipdate) * 100 + 1",
        "exportDate": "20251000 + l_linenumber",
        "terminationDate": """CASE l_orderkey % 3 WHEN 0 THEN 20610701 WHEN 1 THEN 19000101
            ELSE 20260100 + l_linenumber END""",
        "lastUpdated": "concat(l_orderkey, '-', l_partkey, '-', l_linenumber)",
        "intermediaryNumber": "lpad(l_suppkey % 15 + 1, 5, '0')",
    }
    types = {field.name: field.dataType.simpleString() for field in RAW_PROVIDERS.fields}
    return _select(
        lineitem,
        {name: f"CAST({texts[name]} AS {types[name]})" for name in PROVIDER_NAMES},
    )


def raw_admissions(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """One row per supplier; federal, unknown and unlisted owners occur."""
    counts = [name for name in HOSPITAL_NAMES if name.startswith("Count of ")]
    footnotes = [name for name in HOSPITAL_NAMES if name.endswith("Group Footnote")]
    columns = {
        "Facility ID": ccn("s_suppkey"),
        "Facility Name": "s_name",
        "Address": "concat(s_suppkey % 9000 + 1, ' Main St')",
        "City/Town": "n_name",
        "State": _pick(STATES, "s_suppkey % 5"),
        "ZIP Code": "CAST(s_suppkey % 89999 + 10000 AS STRING)",
        "County/Parish": "concat('County ', s_suppkey % 67)",
        "Telephone Number": "concat('555-', lpad(s_suppkey % 10000, 4, '0'))",
        "Hospital Type": _pick(HOSPITAL_TYPES, "s_suppkey % 4"),
        "Hospital Ownership": f"""CASE WHEN s_suppkey % 37 = 36 THEN NULL
            WHEN s_suppkey % 41 = 40 THEN 'Unknown' ELSE {_pick(OWNERS, "s_suppkey % 12")} END""",
        "Emergency Services": _pick(("Yes", "No", ""), "s_suppkey % 3"),
        "Meets criteria for birthing friendly designation": _pick(
            ("Yes", "No", "", "yes"), "s_suppkey % 4"
        ),
        "Hospital overall rating": _pick(
            ("1", "2", "3", "4", "5", "Not Available", "Not Applicable", ""), "s_suppkey % 8"
        ),
        "Hospital overall rating footnote": "CASE WHEN s_suppkey % 8 > 4 THEN '16' END",
    }
    no_value = ("Not Available", "Not Applicable", "Too Few to Report", "N/A", "")
    for i, name in enumerate(counts):
        digit = f"s_suppkey * {i + 3} % 17"
        columns[name] = f"""CASE WHEN {digit} < 12 THEN CAST({digit} AS STRING)
            ELSE {_pick(no_value, f"{digit} - 12")} END"""
    for i, name in enumerate(footnotes):
        columns[name] = f"CASE WHEN (s_suppkey + {i}) % 6 = 0 THEN '19' END"
    joined = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return _select(joined, {name: columns[name] for name in HOSPITAL_NAMES})


class SampleInputs:
    """The inputs over one folder of tables, each made when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def metrics(self) -> DataFrame:
        return raw_hospital_readmissions(self.table("lineitem"))

    @cached_property
    def providers(self) -> DataFrame:
        return raw_providers(self.table("lineitem"))

    @cached_property
    def hospitals(self) -> DataFrame:
        return raw_admissions(self.table("supplier"), self.table("nation"))

    @cached_property
    def events(self) -> DataFrame:
        return admission_events(self.table("orders"), self.table("supplier"))

    @cached_property
    def uploaded_events(self) -> DataFrame:
        return uploaded_events(self.events)

    @cached_property
    def provider_types(self) -> DataFrame:
        return provider_type_codes(self.spark)
