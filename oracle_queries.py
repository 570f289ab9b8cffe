"""Independent SQL for every registered query, over the same tables (DuckDB)."""

from __future__ import annotations

import re

_NO_VALUE = "('Not Available', 'Not Applicable', 'Too Few to Report', 'N/A', '')"
_MEASURES = """('READM-30-AMI-HRRP', 'READM-30-HF-HRRP', 'READM-30-PN-HRRP',
    'READM-30-COPD-HRRP', 'READM-30-HIP-KNEE-HRRP', 'READM-30-CABG-HRRP')"""
_OWNERS = """('Government - Federal', 'Government - Hospital District or Authority',
    'Government - Local', 'Government - State', 'Proprietary', 'Voluntary non-profit - Church',
    'Voluntary non-profit - Other', 'Voluntary non-profit - Private', 'Tribal', 'Physician')"""


def _facility(key: str) -> str:
    return f"(({key}) * 123457 % 990000 + 10000 + 1000000 * (({key}) // 990000))"


def _ccn(key: str) -> str:
    text = f"CAST({_facility(key)} AS VARCHAR)"
    return f"CASE WHEN length({text}) < 6 THEN lpad({text}, 6, '0') ELSE {text} END"


def _padded(text: str) -> str:
    return f"CASE WHEN length({text}) < 6 THEN lpad({text}, 6, '0') ELSE {text} END"


def _date(text: str) -> str:
    return f"""coalesce(TRY_CAST({text} AS DATE),
        CAST(try_strptime({text}, '%m/%d/%Y') AS DATE))"""


def _day(number: str) -> str:
    return f"CAST(try_strptime(CAST({number} AS VARCHAR), '%Y%m%d') AS DATE)"


def _percent(part: str, whole: str, digits: int) -> str:
    """Half-up rounding of 100 * part / whole in whole numbers."""
    scale = 10**digits
    return f"""CAST((2 * 100 * {scale} * ({part}) + ({whole})) // (2 * nullif({whole}, 0))
        AS DOUBLE) / {scale}"""


def _thousandths_avg(column: str) -> str:
    """Half-up rounding to four digits of the average of three-digit values."""
    total = f"CAST(sum(CAST(round({column} * 1000) AS BIGINT)) AS BIGINT)"
    return f"""CAST((2 * 10 * {total} + count({column})) // (2 * nullif(count({column}), 0))
        AS DOUBLE) / 10000"""


def _count_if(condition: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


_HOSPITAL_TEXTS = [
    ("Facility ID", _ccn("s_suppkey")),
    ("Facility Name", "s_name"),
    ("Address", "(s_suppkey % 9000 + 1) || ' Main St'"),
    ("City/Town", "n_name"),
    ("State", "['AL', 'CA', 'NY', 'TX', 'WA'][s_suppkey % 5 + 1]"),
    ("ZIP Code", "CAST(s_suppkey % 89999 + 10000 AS VARCHAR)"),
    ("County/Parish", "'County ' || (s_suppkey % 67)"),
    ("Telephone Number", "'555-' || lpad(CAST(s_suppkey % 10000 AS VARCHAR), 4, '0')"),
    (
        "Hospital Type",
        """['Acute Care Hospitals', 'Critical Access Hospitals', 'Childrens',
        'Psychiatric'][s_suppkey % 4 + 1]""",
    ),
    (
        "Hospital Ownership",
        """CASE WHEN s_suppkey % 37 = 36 THEN NULL WHEN s_suppkey % 41 = 40 THEN 'Unknown' ELSE
        ['Government - Federal', 'Government - Hospital District or Authority',
        'Government - Local', 'Government - State', 'Proprietary',
        'Voluntary non-profit - Church', 'Voluntary non-profit - Other',
        'Voluntary non-profit - Private', 'Tribal', 'Physician', 'Department of Defense',
        'Veterans Health Administration'][s_suppkey % 12 + 1] END""",
    ),
    ("Emergency Services", "['Yes', 'No', ''][s_suppkey % 3 + 1]"),
    (
        "Meets criteria for birthing friendly designation",
        "['Yes', 'No', '', 'yes'][s_suppkey % 4 + 1]",
    ),
    (
        "Hospital overall rating",
        """['1', '2', '3', '4', '5', 'Not Available', 'Not Applicable', ''][s_suppkey % 8 + 1]""",
    ),
    ("Hospital overall rating footnote", "CASE WHEN s_suppkey % 8 > 4 THEN '16' END"),
]
_HOSPITAL_COUNTS = [
    ("Count of Facility MORT Measures", "mort_measures_count"),
    ("Count of MORT Measures Better", "mort_better_count"),
    ("Count of MORT Measures No Different", "mort_same_count"),
    ("Count of MORT Measures Worse", "mort_worse_count"),
    ("Count of Facility Safety Measures", "safety_measures_count"),
    ("Count of Safety Measures Better", "safety_better_count"),
    ("Count of Safety Measures No Different", "safety_same_count"),
    ("Count of Safety Measures Worse", "safety_worse_count"),
    ("Count of Facility READM Measures", "readm_measures_count"),
    ("Count of READM Measures Better", "readm_better_count"),
    ("Count of READM Measures No Different", "readm_same_count"),
    ("Count of READM Measures Worse", "readm_worse_count"),
    ("Count of Facility Pt Exp Measures", "ptexp_measures_count"),
    ("Count of Facility TE Measures", "te_measures_count"),
]
_HOSPITAL_FOOTNOTES = [
    ("MORT Group Footnote", "mort_group_footnote"),
    ("Safety Group Footnote", "safety_group_footnote"),
    ("READM Group Footnote", "readm_group_footnote"),
    ("Pt Exp Group Footnote", "ptexp_group_footnote"),
    ("TE Group Footnote", "te_group_footnote"),
]


def _raw_admissions() -> str:
    columns = [f'{text} AS "{name}"' for name, text in _HOSPITAL_TEXTS]
    for i, (name, _) in enumerate(_HOSPITAL_COUNTS):
        digit = f"s_suppkey * {i + 3} % 17"
        columns.append(
            f"""CASE WHEN {digit} < 12 THEN CAST({digit} AS VARCHAR) ELSE ['Not Available',
            'Not Applicable', 'Too Few to Report', 'N/A', ''][{digit} - 11] END AS "{name}" """
        )
    for i, (name, _) in enumerate(_HOSPITAL_FOOTNOTES):
        columns.append(f"""CASE WHEN (s_suppkey + {i}) % 6 = 0 THEN '19' END AS "{name}" """)
    return f"""SELECT {', '.join(columns)} FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


def _stg_admissions() -> str:
    def flag(name: str) -> str:
        return f"""CASE WHEN "{name}" = 'Yes' THEN true WHEN "{name}" = 'No' THEN false END"""

    counts = [
        f"""CASE WHEN "{old}" NOT IN {_NO_VALUE} THEN TRY_CAST("{old}" AS INTEGER) END AS {new}"""
        for old, new in _HOSPITAL_COUNTS
    ]
    footnotes = [f'"{old}" AS {new}' for old, new in _HOSPITAL_FOOTNOTES]
    return f"""SELECT TRY_CAST("Facility ID" AS BIGINT) AS facility_id,
        "Facility Name" AS facility_name, "Address" AS address, "City/Town" AS city,
        "State" AS state_code, "ZIP Code" AS zip_code, "County/Parish" AS county,
        "Telephone Number" AS phone_number, "Hospital Type" AS hospital_type,
        "Hospital Ownership" AS hospital_ownership,
        {flag('Emergency Services')} AS has_emergency_services,
        {flag('Meets criteria for birthing friendly designation')} AS is_birthing_friendly,
        CASE WHEN "Hospital overall rating" NOT IN ('Not Available', 'Not Applicable', '')
            THEN TRY_CAST("Hospital overall rating" AS INTEGER) END AS overall_rating,
        "Hospital overall rating footnote" AS overall_rating_footnote,
        {', '.join(counts + footnotes)}
        FROM raw_admissions
        WHERE "Hospital Ownership" NOT IN
            ('Department of Defense', 'Veterans Health Administration')"""


_SHIP_DAY = "month(l_shipdate) * 100 + day(l_shipdate)"

# (name in staging, SQL over order lines, type)
_PROVIDER_COLUMNS = [
    ("provider_ccn", _ccn("l_suppkey"), "VARCHAR"),
    ("national_provider_id", "1000000000 + l_suppkey", "VARCHAR"),
    (
        "provider_type_code",
        """CASE WHEN l_suppkey % 10 = 3 THEN '05' WHEN l_returnflag = 'A' THEN '00'
            WHEN l_returnflag = 'N' THEN '04' ELSE '08' END""",
        "VARCHAR",
    ),
    ("state_code", "lpad(CAST(l_suppkey % 53 + 1 AS VARCHAR), 2, '0')", "VARCHAR"),
    ("county_code", "lpad(CAST(l_suppkey % 254 + 1 AS VARCHAR), 3, '0')", "VARCHAR"),
    ("msa_actual_location", "1000 + l_suppkey % 8000", "VARCHAR"),
    ("cbsa_actual_location", "10000 + l_suppkey % 39000", "VARCHAR"),
    ("census_division", "l_suppkey % 9 + 1", "VARCHAR"),
    ("bed_count", "20 + (l_suppkey * 37) % 900", "INTEGER"),
    ("case_mix_index", "(900 + l_orderkey % 1300) / 1000", "DOUBLE"),
    ("interns_to_beds_ratio", "(l_suppkey % 4) / 8", "DOUBLE"),
    ("medicaid_ratio", "(l_partkey % 500) / 1000", "DOUBLE"),
    ("ssi_ratio", "(l_partkey % 300) / 1000", "DOUBLE"),
    ("operating_dsh_payment", "(l_orderkey % 200) / 1000", "DOUBLE"),
    ("capital_ime_ratio", "(l_suppkey % 50) / 1000", "DOUBLE"),
    ("uncompensated_care_amount", "l_extendedprice", "DOUBLE"),
    ("vbp_participant_flag", "CASE WHEN l_orderkey % 10 = 0 THEN 'N' ELSE 'Y' END", "VARCHAR"),
    ("vbp_adjustment_factor", "(980 + l_orderkey % 41) / 1000", "DOUBLE"),
    ("hrr_participant_flag", "CASE WHEN l_orderkey % 29 = 0 THEN 'N' ELSE 'Y' END", "VARCHAR"),
    (
        "hrr_adjustment_factor",
        "CASE WHEN l_orderkey % 29 <> 0 THEN (960 + l_orderkey % 45) / 1000 END",
        "DOUBLE",
    ),
    (
        "hac_reduction_participant_flag",
        "CASE WHEN l_partkey % 4 = 0 THEN 'Y' ELSE 'N' END",
        "VARCHAR",
    ),
    ("ehr_reduction_flag", "CASE WHEN l_partkey % 9 = 0 THEN 'Y' END", "VARCHAR"),
    (
        "sole_community_hospital_indicator",
        "CASE WHEN l_suppkey % 6 = 0 THEN 1982 + l_suppkey % 40 END",
        "VARCHAR",
    ),
    ("special_payment_indicator", "CASE WHEN l_suppkey % 8 = 0 THEN '1' END", "VARCHAR"),
    ("hospital_quality_indicator", "CASE WHEN l_partkey % 5 = 0 THEN '1' END", "VARCHAR"),
    ("is_new_hospital_flag", "CASE WHEN l_suppkey % 50 = 0 THEN 'Y' ELSE 'N' END", "VARCHAR"),
    ("ltch_dpp_indicator", "CASE WHEN l_suppkey % 70 = 0 THEN 'Y' END", "VARCHAR"),
    ("operating_cost_to_charge_ratio", "(l_partkey % 700) / 1000", "DOUBLE"),
    ("capital_cost_to_charge_ratio", "(l_partkey % 80) / 1000", "DOUBLE"),
    ("case_mix_adjusted_cost_per_discharge", "l_extendedprice / 2", "DOUBLE"),
    ("pass_through_capital", "l_quantity", "DOUBLE"),
    ("pass_through_direct_medical_ed", "l_discount", "DOUBLE"),
    ("pass_through_direct_graduate_med_ed", "l_tax", "DOUBLE"),
    ("pass_through_organ_acquisition", "l_quantity * 2", "DOUBLE"),
    ("pass_through_kidney_acquisition", "l_quantity * 4", "DOUBLE"),
    ("pass_through_stem_cell_acquisition", "l_quantity * 8", "DOUBLE"),
    ("pass_through_total", "l_extendedprice * 2", "DOUBLE"),
    (
        "fiscal_year_begin_date",
        f"""CASE WHEN l_orderkey % 97 = 0 THEN 19000101
            ELSE (year(l_shipdate) + 24) * 10000 + {_SHIP_DAY} END""",
        "BIGINT",
    ),
    ("fiscal_year_end_date", f"(year(l_shipdate) + 25) * 10000 + {_SHIP_DAY}", "BIGINT"),
    (
        "effective_date",
        "(year(l_shipdate) + 24) * 10000 + month(l_shipdate) * 100 + 1",
        "BIGINT",
    ),
    ("export_date", "20251000 + l_linenumber", "BIGINT"),
    (
        "termination_date",
        """CASE l_orderkey % 3 WHEN 0 THEN 20610701 WHEN 1 THEN 19000101
            ELSE 20260100 + l_linenumber END""",
        "BIGINT",
    ),
    ("last_updated_raw", "l_orderkey || '-' || l_partkey || '-' || l_linenumber", "VARCHAR"),
    ("medicare_intermediary_id", "lpad(CAST(l_suppkey % 15 + 1 AS VARCHAR), 5, '0')", "VARCHAR"),
]
_PROVIDER_DAYS = [
    "fiscal_year_begin_date",
    "fiscal_year_end_date",
    "effective_date",
    "export_date",
    "termination_date",
]


def _provider_day(name: str) -> str:
    if name == "termination_date":
        return f"CASE WHEN {name} NOT IN (20610701, 19000101) THEN {_day(name)} END"
    return _day(name)


def _raw_providers() -> str:
    columns = [f"CAST({sql} AS {kind}) AS {name}" for name, sql, kind in _PROVIDER_COLUMNS]
    return f"SELECT {', '.join(columns)} FROM lineitem"


def _stg_providers() -> str:
    columns = [
        f"{_provider_day(name)} AS {name}" if name in _PROVIDER_DAYS else name
        for name, _, _ in _PROVIDER_COLUMNS
    ]
    return f"""SELECT {', '.join(columns)} FROM (
        SELECT *, row_number() OVER (PARTITION BY provider_ccn ORDER BY
            fiscal_year_begin_date DESC NULLS LAST, effective_date DESC NULLS LAST,
            export_date DESC NULLS LAST, last_updated_raw DESC NULLS LAST) AS version_rank
        FROM raw_providers
        WHERE provider_type_code = '00'
          AND fiscal_year_begin_date BETWEEN 20200101 AND 20251231)
        WHERE version_rank = 1"""


def _enriched(padded: bool) -> str:
    key = "CAST(h.facility_id AS VARCHAR)"
    key = _padded(key) if padded else key
    return f"""SELECT h.facility_id, a.facility_name,
        coalesce(p.state_code, a.state_code) AS state_code, a.address, a.city, a.hospital_type,
        a.hospital_ownership, a.has_emergency_services, a.overall_rating, p.bed_count,
        p.case_mix_index, p.medicaid_ratio, p.hrr_adjustment_factor, p.vbp_adjustment_factor,
        p.operating_dsh_payment, h.avg_excess_readmission_ratio, h.total_readmissions,
        h.total_discharges, h.measures_with_data, a.readm_better_count, a.readm_same_count,
        a.readm_worse_count, p.provider_ccn IS NULL AS missing_provider_data,
        a.facility_id IS NULL AS missing_admissions_data, p.fiscal_year_begin_date
        FROM (SELECT facility_id,
                CAST(sum(CAST(excess_readmission_ratio AS DECIMAL(26, 12))) AS DOUBLE)
                    / count(excess_readmission_ratio) AS avg_excess_readmission_ratio,
                CAST(sum(number_of_readmissions) AS BIGINT) AS total_readmissions,
                CAST(sum(number_of_discharges) AS BIGINT) AS total_discharges,
                count(DISTINCT CASE WHEN excess_readmission_ratio IS NOT NULL
                    THEN measure_name END) AS measures_with_data
            FROM stg_hrrp_metrics GROUP BY facility_id) h
        LEFT JOIN stg_providers p ON {key} = p.provider_ccn
        LEFT JOIN stg_admissions a ON h.facility_id = a.facility_id"""


def _metric(name: str, kind: str) -> str:
    return f"""CASE WHEN "{name}" NOT IN ('Not Available', 'Too Few to Report', 'N/A', '')
        THEN TRY_CAST("{name}" AS {kind}) END"""


def _rule(prior: str, days: int = 30, excluded: str = "") -> str:
    excluded = excluded or "'Cancer Treatment', 'Rehabilitation', 'Transplant'"
    return f"""({prior} IS NOT NULL
        AND date_diff('day', {prior}, admission_date) BETWEEN 0 AND {days}
        AND NOT (admission_type = 'Planned' AND diagnosis_category IN ({excluded})))"""


# Named results; each may use the ones above it.
_VIEWS = {
    "provider_type_codes": """SELECT * FROM (VALUES
        ('00', 'Short-term Acute Care Hospital', 'Hospital', true),
        ('01', 'Hospital', 'Hospital', false),
        ('02', 'Long-term Care Hospital', 'Hospital', false),
        ('03', 'Religious Non-medical Health Care Institution', 'Hospital', false),
        ('04', 'Critical Access Hospital', 'Hospital', false),
        ('05', 'Childrens Hospital', 'Hospital', false),
        ('06', 'Cancer Hospital', 'Hospital', false),
        ('07', 'Rehabilitation Hospital', 'Hospital', false),
        ('08', 'Psychiatric Hospital', 'Hospital', false),
        ('14', 'Indian Health Service Hospital', 'Hospital', false),
        ('15', 'Other Hospital', 'Hospital', false),
        ('16', 'Veterans Affairs Hospital', 'Hospital', false),
        ('17', 'Tribal Hospital', 'Hospital', false),
        ('33', 'Other', 'Other', false),
        ('35', 'Other Specialty Hospital', 'Hospital', false),
        ('36', 'Skilled Nursing Facility', 'SNF', false),
        ('37', 'Other Skilled Nursing', 'SNF', false),
        ('38', 'Nursing Facility', 'SNF', false),
        ('49', 'Home Health Agency', 'HHA', false),
        ('50', 'Hospice', 'Hospice', false),
        ('51', 'Comprehensive Outpatient Rehabilitation Facility', 'CORF', false))
        AS t(provider_type_code, provider_type_label, category, is_hrrp_eligible)""",
    "dim_conditions": """SELECT measure_code, condition_name, condition_category,
        CAST(sort_order AS INTEGER) AS sort_order FROM (VALUES
        ('READM-30-AMI-HRRP', 'Heart Attack (AMI)', 'Cardiac', 1),
        ('READM-30-HF-HRRP', 'Heart Failure', 'Cardiac', 2),
        ('READM-30-PN-HRRP', 'Pneumonia', 'Respiratory', 3),
        ('READM-30-COPD-HRRP', 'COPD', 'Respiratory', 4),
        ('READM-30-HIP-KNEE-HRRP', 'Hip/Knee Replacement', 'Surgical', 5),
        ('READM-30-CABG-HRRP', 'Coronary Artery Bypass (CABG)', 'Surgical', 6))
        AS t(measure_code, condition_name, condition_category, sort_order)""",
    "admission_events": f"""SELECT CAST(o_orderkey AS VARCHAR) AS admission_id,
        CAST(o_custkey AS VARCHAR) AS patient_id,
        {_facility('o_orderkey % (SELECT count(*) + 1 + count(*) // 20 FROM supplier)')}
            AS facility_id,
        CAST(o_orderdate AS DATE) AS admission_date,
        CAST(o_orderdate AS DATE) + CAST(o_orderkey % 7 + 1 AS INTEGER) AS discharge_date,
        CASE o_orderpriority WHEN '5-LOW' THEN 'Planned' WHEN '4-NOT SPECIFIED' THEN 'Elective'
            ELSE 'Emergency' END AS admission_type,
        ['Heart Failure', 'AMI', 'Pneumonia', 'COPD', 'Hip Replacement', 'CABG',
            'Surgical Complication', 'Cancer Treatment', 'Rehabilitation',
            'Transplant'][o_orderkey % 10 + 1] AS diagnosis_category,
        CAST(o_orderkey % 7 + 1 AS INTEGER) AS length_of_stay
        FROM orders""",
    "uploaded_events": """SELECT admission_id, patient_id,
        CASE WHEN key % 19 = 0 THEN 'F' ELSE '' END || facility_id AS facility_id,
        CASE WHEN key % 17 = 0 THEN 'pending'
            WHEN key % 13 = 0 THEN strftime(admission_date, '%m/%d/%Y')
            ELSE CAST(admission_date AS VARCHAR) END AS admission_date,
        CASE WHEN key % 29 <> 0 THEN CAST(discharge_date AS VARCHAR) END AS discharge_date,
        admission_type, diagnosis_category,
        length_of_stay || CASE WHEN key % 23 = 0 THEN ' days' ELSE '' END AS length_of_stay
        FROM (SELECT *, CAST(admission_id AS BIGINT) AS key FROM admission_events)""",
    "raw_readmissions_events": f"""SELECT facility_id, admission_date, discharge_date, length_of_stay
        FROM uploaded_events""",
    "raw_hospital_readmissions": f"""SELECT {_facility('l_suppkey')} AS "Facility ID",
        'Facility ' || l_suppkey AS "Facility Name",
        ['AL', 'CA', 'NY', 'TX', 'WA'][l_suppkey % 5 + 1] AS "State",
        ['READM-30-AMI-HRRP', 'READM-30-HF-HRRP', 'READM-30-PN-HRRP', 'READM-30-COPD-HRRP',
            'READM-30-HIP-KNEE-HRRP', 'READM-30-CABG-HRRP'][measure + 1] AS "Measure Name",
        CASE WHEN n % 11 = 0 THEN 'Too Few to Report' WHEN n % 13 = 0 THEN 'Not Available'
            ELSE CAST(n AS VARCHAR) END AS "Number of Discharges",
        CASE WHEN k % 19 = 0 THEN 'Not Available'
            ELSE (k // 1000) || '.' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') END
            AS "Excess Readmission Ratio",
        CASE WHEN k % 17 = 0 THEN 'N/A' ELSE (10 + k % 20) || '.' || (k % 10) END
            AS "Predicted Readmission Rate",
        CASE WHEN k % 29 = 0 THEN '' ELSE '15.' || lpad(CAST(n % 100 AS VARCHAR), 2, '0') END
            AS "Expected Readmission Rate",
        CASE WHEN n % 7 = 0 THEN 'Too Few to Report' WHEN n % 17 = 0 THEN 'about ' || (n // 5)
            ELSE CAST(n // 5 AS VARCHAR) END AS "Number of Readmissions",
        CASE WHEN k % 23 = 0 THEN 'Not Available' WHEN k % 2 = 0 THEN '2021-07-01'
            ELSE '07/01/2021' END AS "Start Date",
        CASE WHEN k % 31 = 0 THEN NULL WHEN k % 3 = 0 THEN '06/30/2024'
            ELSE '2024-06-30' END AS "End Date",
        CASE WHEN k % 5 = 0 THEN '5' END AS "Footnote"
        FROM (SELECT l_suppkey, (l_linenumber - 1) % 6 AS measure, count(*) AS n,
                CAST(sum(l_orderkey) % 600 + 700 AS BIGINT) AS k
            FROM lineitem GROUP BY l_suppkey, measure)""",
    "raw_providers": _raw_providers(),
    "raw_admissions": _raw_admissions(),
    "stg_hrrp_metrics": f"""SELECT "Facility ID" AS facility_id,
        "Facility Name" AS facility_name, "State" AS state_code, "Measure Name" AS measure_name,
        {_metric('Number of Discharges', 'INTEGER')} AS number_of_discharges,
        {_metric('Excess Readmission Ratio', 'DOUBLE')} AS excess_readmission_ratio,
        {_metric('Predicted Readmission Rate', 'DOUBLE')} AS predicted_readmission_rate,
        {_metric('Expected Readmission Rate', 'DOUBLE')} AS expected_readmission_rate,
        {_metric('Number of Readmissions', 'INTEGER')} AS number_of_readmissions,
        CASE WHEN "Start Date" NOT IN ('Not Available', 'N/A', '')
            THEN {_date('"Start Date"')} END AS measurement_period_start,
        {_date('"End Date"')} AS measurement_period_end,
        "Footnote" AS footnote_code
        FROM raw_hospital_readmissions""",
    "stg_admissions": _stg_admissions(),
    "stg_providers": _stg_providers(),
    "int_providers_enriched": _enriched(padded=False),
    "int_providers_enriched_padded": _enriched(padded=True),
    "int_readmissions_flagged": f"""SELECT admission_id, patient_id, facility_id,
        admission_date, discharge_date, admission_type, diagnosis_category, length_of_stay,
        prior_admission_id, prior_discharge_date,
        CAST(date_diff('day', prior_discharge_date, admission_date) AS INTEGER)
            AS days_since_prior_discharge,
        {_rule('prior_discharge_date')} AS is_readmission
        FROM (SELECT *, lag(admission_id) OVER w AS prior_admission_id,
                lag(discharge_date) OVER w AS prior_discharge_date
            FROM admission_events
            WINDOW w AS (PARTITION BY patient_id
                ORDER BY admission_date NULLS FIRST, CAST(admission_id AS BIGINT)))""",
    "dim_providers": """SELECT facility_id, facility_name, state_code, address, city,
        hospital_type, hospital_ownership, has_emergency_services, bed_count, overall_rating,
        avg_excess_readmission_ratio, measures_with_data, hrr_adjustment_factor,
        vbp_adjustment_factor, case_mix_index, medicaid_ratio, missing_provider_data,
        missing_admissions_data FROM int_providers_enriched""",
    "fct_readmissions": """SELECT admission_id, patient_id, facility_id,
        CASE diagnosis_category WHEN 'Heart Failure' THEN 'READM-30-HF-HRRP'
            WHEN 'AMI' THEN 'READM-30-AMI-HRRP' WHEN 'Pneumonia' THEN 'READM-30-PN-HRRP'
            WHEN 'COPD' THEN 'READM-30-COPD-HRRP'
            WHEN 'Hip Replacement' THEN 'READM-30-HIP-KNEE-HRRP'
            WHEN 'CABG' THEN 'READM-30-CABG-HRRP' END AS measure_code,
        admission_date, discharge_date, prior_admission_id, prior_discharge_date,
        length_of_stay, days_since_prior_discharge, is_readmission, admission_type,
        diagnosis_category FROM int_readmissions_flagged""",
}

_NOT_NULL = [
    ("stg_hrrp_metrics", "facility_id"),
    ("stg_hrrp_metrics", "measure_name"),
    ("stg_admissions", "facility_id"),
    ("stg_admissions", "facility_name"),
    ("stg_admissions", "state_code"),
    ("stg_providers", "provider_ccn"),
    ("stg_providers", "state_code"),
    ("dim_providers", "facility_id"),
    ("dim_providers", "facility_name"),
    ("dim_conditions", "measure_code"),
    ("dim_conditions", "condition_name"),
    ("fct_readmissions", "admission_id"),
    ("fct_readmissions", "facility_id"),
    ("fct_readmissions", "admission_date"),
]
_UNIQUE = [
    ("stg_admissions", "facility_id"),
    ("stg_providers", "provider_ccn"),
    ("dim_providers", "facility_id"),
    ("dim_conditions", "measure_code"),
    ("fct_readmissions", "admission_id"),
]
_ACCEPTED = [
    ("stg_hrrp_metrics", "measure_name", _MEASURES),
    ("stg_admissions", "hospital_ownership", _OWNERS),
    ("stg_providers", "provider_type_code", "('00')"),
]
_PARENTS = [
    ("facility_id", "dim_providers", "facility_id"),
    ("measure_code", "dim_conditions", "measure_code"),
]


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _check(name: str, source: str) -> str:
    return f"""SELECT '{name}' AS "check", count(*) AS violations FROM {source}"""


_NOT_NULL_SQL = _union(
    [_check(f"not_null_{m}_{c}", f"{m} WHERE {c} IS NULL") for m, c in _NOT_NULL]
)
_UNIQUE_SQL = _union(
    [
        _check(
            f"unique_{m}_{c}",
            f"(SELECT {c} FROM {m} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)",
        )
        for m, c in _UNIQUE
    ]
)
_ACCEPTED_SQL = _union(
    [
        _check(
            f"accepted_values_{m}_{c}", f"(SELECT DISTINCT {c} FROM {m} WHERE {c} NOT IN {values})"
        )
        for m, c, values in _ACCEPTED
    ]
)
_PARENTS_SQL = _union(
    [
        _check(
            f"relationships_fct_readmissions_{c}",
            f"""fct_readmissions f WHERE f.{c} IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM {parent} q WHERE q.{key} = f.{c})""",
        )
        for c, parent, key in _PARENTS
    ]
)
_PAIRS_SQL = _check(
    "unique_combination_stg_hrrp_metrics_facility_id_measure_name",
    """(SELECT facility_id, measure_name FROM stg_hrrp_metrics
        GROUP BY facility_id, measure_name HAVING count(*) > 1)""",
)
_CANCER_SQL = _check(
    "fct_readmissions_no_planned_cancer_flagged",
    """fct_readmissions WHERE is_readmission AND diagnosis_category = 'Cancer Treatment'
        AND admission_type = 'Planned'""",
)
_WINDOW_SQL = _check(
    "fct_readmissions_flags_within_30_days",
    "fct_readmissions WHERE is_readmission AND days_since_prior_discharge > 30",
)


def _gate(name: str, count: str, source: str) -> str:
    return f"""SELECT '{name}' AS test_name, {count} AS violation_count,
        CASE WHEN {count} = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {source}"""


def _metric_row(name: str, value: str) -> str:
    return f"SELECT '{name}' AS metric, CAST({value} AS VARCHAR) AS value FROM raw_admissions"


def _lost(table: str, column: str, sentinels: str, cast: str) -> str:
    known = f'AND "{column}" NOT IN {sentinels}' if sentinels else ""
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name,
        count(*) AS lost_values FROM {table}
        WHERE "{column}" IS NOT NULL {known} AND {cast} IS NULL"""


def _losses() -> str:
    metric = "('Not Available', 'Too Few to Report', 'N/A', '')"
    rows = [
        ("Facility ID", "", 'TRY_CAST("Facility ID" AS BIGINT)'),
        ("Number of Discharges", metric, 'TRY_CAST("Number of Discharges" AS INTEGER)'),
        ("Excess Readmission Ratio", metric, 'TRY_CAST("Excess Readmission Ratio" AS DOUBLE)'),
        ("Predicted Readmission Rate", metric, 'TRY_CAST("Predicted Readmission Rate" AS DOUBLE)'),
        ("Expected Readmission Rate", metric, 'TRY_CAST("Expected Readmission Rate" AS DOUBLE)'),
        ("Number of Readmissions", metric, 'TRY_CAST("Number of Readmissions" AS INTEGER)'),
        ("Start Date", "('Not Available', 'N/A', '')", _date('"Start Date"')),
        ("End Date", "", _date('"End Date"')),
    ]
    parts = [_lost("raw_hospital_readmissions", *row) for row in rows]
    hospital = [
        ("Facility ID", "", 'TRY_CAST("Facility ID" AS BIGINT)'),
        (
            "Hospital overall rating",
            "('Not Available', 'Not Applicable', '')",
            'TRY_CAST("Hospital overall rating" AS INTEGER)',
        ),
    ] + [(old, _NO_VALUE, f'TRY_CAST("{old}" AS INTEGER)') for old, _ in _HOSPITAL_COUNTS]
    parts += [_lost("raw_admissions", *row) for row in hospital]
    days = {
        "fiscalYearBeginDate": "fiscal_year_begin_date",
        "fiscalYearEndDate": "fiscal_year_end_date",
        "effectiveDate": "effective_date",
        "exportDate": "export_date",
        "terminationDate": "termination_date",
    }
    for old, new in days.items():
        known = "AND termination_date NOT IN (20610701, 19000101)" if old == "terminationDate" else ""
        parts.append(
            f"""SELECT 'raw_providers' AS table_name, '{old}' AS column_name, count(*) AS lost_values
            FROM raw_providers WHERE {new} IS NOT NULL {known} AND {_day(new)} IS NULL"""
        )
    uploads = {
        "facility_id": "TRY_CAST(facility_id AS BIGINT)",
        "admission_date": _date("admission_date"),
        "discharge_date": _date("discharge_date"),
        "length_of_stay": "TRY_CAST(length_of_stay AS INTEGER)",
    }
    parts += [_lost("raw_readmissions_events", name, "", cast) for name, cast in uploads.items()]
    return _union(parts)


_RATE_COLUMNS = f"""count(*) AS total_admissions,
    {_count_if('is_readmission')} AS readmission_count,
    {_percent(_count_if('is_readmission'), 'count(*)', 1)} AS readmission_rate_pct"""


def _missing(what: str, flag: str, suffix: str) -> str:
    return f"""SELECT 'int_providers_enriched: missing {what} data' AS audit_check,
        count(*) AS total_rows, {_count_if(flag)} AS rows_missing_{suffix},
        {_percent(_count_if(flag), 'count(*)', 1)} AS pct_missing_{suffix}
        FROM int_providers_enriched"""


_QUERIES = {
    "provider_type_codes": """SELECT t.*, coalesce(n, 0) AS raw_records
        FROM provider_type_codes t LEFT JOIN
        (SELECT provider_type_code AS code, count(*) AS n FROM raw_providers GROUP BY 1)
        ON code = provider_type_code""",
    "dim_conditions": """SELECT c.*, coalesce(n, 0) AS published_rows
        FROM dim_conditions c LEFT JOIN
        (SELECT measure_name, count(*) AS n FROM stg_hrrp_metrics GROUP BY 1)
        ON measure_name = measure_code""",
    "is_readmission": f"""SELECT admission_id, {_rule('prior_discharge')} AS is_readmission,
        {_rule('prior_discharge', 7, "'Transplant'")} AS is_readmission_7_days
        FROM (SELECT admission_id,
            CASE WHEN i % 11 <> 0 THEN day - CAST(i % 41 - 4 AS INTEGER) END AS prior_discharge,
            CASE WHEN i % 13 <> 0 THEN day END AS admission_date,
            CASE WHEN i % 7 <> 0 THEN kind END AS admission_type,
            CASE WHEN i % 9 <> 0 THEN diagnosis END AS diagnosis_category
            FROM (SELECT admission_id, CAST(admission_id AS BIGINT) AS i, admission_date AS day,
                admission_type AS kind, diagnosis_category AS diagnosis FROM admission_events))""",
    "safe_cast_int": f"""SELECT "Facility ID" AS ccn,
        "Count of Facility READM Measures" AS text,
        CASE WHEN "Count of Facility READM Measures" NOT IN {_NO_VALUE}
            THEN TRY_CAST("Count of Facility READM Measures" AS INTEGER) END AS value
        FROM raw_admissions""",
    "safe_cast_double": f"""SELECT "Facility ID" AS facility_id,
        "Measure Name" AS measure_name, "Predicted Readmission Rate" AS text,
        CASE WHEN "Predicted Readmission Rate" NOT IN {_NO_VALUE}
            THEN TRY_CAST("Predicted Readmission Rate" AS DOUBLE) END AS value
        FROM raw_hospital_readmissions""",
    "safe_cast_date": f"""SELECT "Facility ID" AS facility_id,
        "Measure Name" AS measure_name, "Start Date" AS text,
        CASE WHEN "Start Date" NOT IN ('Not Available', 'Not Applicable', 'N/A', '')
            THEN {_date('"Start Date"')} END AS value
        FROM raw_hospital_readmissions""",
    "yyyymmdd_dates": f"""SELECT {_provider_day('fiscal_year_begin_date')} AS fiscalYearBeginDate,
        {_provider_day('fiscal_year_end_date')} AS fiscalYearEndDate,
        {_provider_day('effective_date')} AS effectiveDate,
        {_provider_day('export_date')} AS exportDate,
        {_provider_day('termination_date')} AS terminationDate, count(*) AS records
        FROM raw_providers GROUP BY 1, 2, 3, 4, 5""",
    "penalty_bands": f"""SELECT CASE WHEN hrr_adjustment_factor IS NULL
            THEN '4. No financial data'
            WHEN hrr_adjustment_factor >= 1.0 THEN '1. No penalty (factor >= 1.0)'
            WHEN hrr_adjustment_factor >= 0.99 THEN '2. Light penalty (0.99-1.0)'
            WHEN hrr_adjustment_factor >= 0.97 THEN '3. Moderate penalty (0.97-0.99)'
            ELSE '4. Heavy penalty (<0.97)' END AS penalty_band,
        count(*) AS hospital_count,
        {_thousandths_avg('hrr_adjustment_factor')} AS avg_adjustment_factor
        FROM dim_providers GROUP BY 1 ORDER BY 1""",
    "readmission_rate_by_condition_state": f"""SELECT c.condition_name, p.state_code AS state,
        {_RATE_COLUMNS}
        FROM fct_readmissions f LEFT JOIN dim_conditions c ON f.measure_code = c.measure_code
        LEFT JOIN dim_providers p ON f.facility_id = p.facility_id
        WHERE c.condition_name IS NOT NULL
        GROUP BY c.condition_name, p.state_code""",
    "providers_above_expected": """SELECT d.facility_id, d.facility_name, d.state_code,
        s.census_division, d.hospital_ownership, d.bed_count,
        s.interns_to_beds_ratio > 0 AS is_teaching, d.avg_excess_readmission_ratio,
        d.measures_with_data
        FROM dim_providers d
        LEFT JOIN stg_providers s ON CAST(d.facility_id AS VARCHAR) = s.provider_ccn
        WHERE d.avg_excess_readmission_ratio > 1""",
    "readmission_rate_by_diagnosis": f"""SELECT diagnosis_category, {_RATE_COLUMNS}
        FROM fct_readmissions GROUP BY diagnosis_category""",
    "simulated_vs_published": f"""SELECT c.measure_code, condition_name, condition_category,
        sort_order, simulated_admissions, simulated_readmissions,
        {_percent('simulated_readmissions', 'simulated_admissions', 1)} AS simulated_rate_pct,
        facilities_with_ratio, avg_excess_readmission_ratio
        FROM dim_conditions c
        LEFT JOIN (SELECT measure_code, count(*) AS simulated_admissions,
            {_count_if('is_readmission')} AS simulated_readmissions
            FROM fct_readmissions GROUP BY 1) f ON f.measure_code = c.measure_code
        LEFT JOIN (SELECT measure_name,
            count(excess_readmission_ratio) AS facilities_with_ratio,
            {_thousandths_avg('excess_readmission_ratio')} AS avg_excess_readmission_ratio
            FROM stg_hrrp_metrics GROUP BY 1) m ON m.measure_name = c.measure_code""",
    "raw_profile": _union(
        [
            _metric_row("Total rows", "count(*)"),
            _metric_row("Distinct facility_ids", 'count(DISTINCT "Facility ID")'),
            _metric_row(
                "Hospital ownership categories (raw)", 'count(DISTINCT "Hospital Ownership")'
            ),
            _metric_row(
                'Rows with overall_rating = "Not Available"',
                _count_if("\"Hospital overall rating\" = 'Not Available'"),
            ),
            _metric_row(
                "Rows with overall_rating = numeric",
                _count_if("regexp_matches(\"Hospital overall rating\", '^[0-9]+$')"),
            ),
            _metric_row(
                "Distinct hospital_ownership values",
                "string_agg(DISTINCT \"Hospital Ownership\", ', ' ORDER BY \"Hospital Ownership\")",
            ),
        ]
    ),
    "dq_gate": _union(
        [
            _gate(
                "unique_facility_id_in_stg_admissions",
                "count(*) - count(DISTINCT facility_id)",
                "stg_admissions",
            ),
            _gate(
                "accepted_values_measure_name",
                _count_if(f"measure_name NOT IN {_MEASURES}"),
                "stg_hrrp_metrics",
            ),
            _gate(
                "unique_combination_facility_measure",
                "count(*) - count(DISTINCT facility_id || '|' || measure_name)",
                "stg_hrrp_metrics",
            ),
        ]
    ),
    "audit_missing_providers": _missing("provider", "missing_provider_data", "provider"),
    "audit_missing_admissions": _missing("admissions", "missing_admissions_data", "admissions"),
    "audit_ccn_format": f"""SELECT 'stg_providers: CCN format profile' AS audit_check,
        count(*) AS total_ccns, {_count_if('length(provider_ccn) <> 6')} AS ccns_not_6_chars,
        {_count_if('provider_ccn <> trim(provider_ccn)')} AS ccns_with_whitespace,
        {_count_if("substring(provider_ccn, 1, 1) = '0'")} AS ccns_with_leading_zero
        FROM stg_providers""",
    "audit_ref_integrity": f"""SELECT 'fct_readmissions: referential integrity' AS audit_check,
        count(*) AS total_fct_rows,
        {_count_if('c.measure_code IS NULL')} AS orphaned_from_dim_conditions,
        {_count_if('p.facility_id IS NULL')} AS orphaned_from_dim_providers,
        {_percent(_count_if('c.measure_code IS NULL OR p.facility_id IS NULL'), 'count(*)', 2)}
            AS pct_with_any_orphan
        FROM fct_readmissions f LEFT JOIN dim_conditions c ON f.measure_code = c.measure_code
        LEFT JOIN dim_providers p ON f.facility_id = p.facility_id""",
    "audit_cast_losses": _losses(),
    "conformed_events": f"""SELECT admission_id, patient_id,
        TRY_CAST(facility_id AS BIGINT) AS facility_id, {_date('admission_date')} AS admission_date,
        {_date('discharge_date')} AS discharge_date, admission_type, diagnosis_category,
        TRY_CAST(length_of_stay AS INTEGER) AS length_of_stay FROM uploaded_events""",
    "test_not_null": _NOT_NULL_SQL,
    "test_unique": _UNIQUE_SQL,
    "test_accepted_values": _ACCEPTED_SQL,
    "test_relationships": _PARENTS_SQL,
    "test_unique_combination": _PAIRS_SQL,
    "test_no_planned_cancer": _CANCER_SQL,
    "test_window_30": _WINDOW_SQL,
    "dq_suite": f"""SELECT "check", severity, violations,
        CASE WHEN violations = 0 THEN 'PASS' WHEN severity = 'warn' THEN 'WARN' ELSE 'FAIL' END
            AS status
        FROM (SELECT *, CASE WHEN "check" = 'relationships_fct_readmissions_measure_code'
                THEN 'warn' ELSE 'error' END AS severity
            FROM ({_union([_NOT_NULL_SQL, _UNIQUE_SQL, _ACCEPTED_SQL, _PARENTS_SQL, _PAIRS_SQL,
                           _CANCER_SQL, _WINDOW_SQL])}))""",
}
for _name in (
    "admission_events",
    "stg_hrrp_metrics",
    "stg_admissions",
    "stg_providers",
    "int_providers_enriched",
    "int_providers_enriched_padded",
    "int_readmissions_flagged",
    "dim_providers",
    "fct_readmissions",
):
    _QUERIES[_name] = f"SELECT * FROM {_name}"
# However histories are cut, the result is the same.
_QUERIES["int_readmissions_flagged_sliced"] = _QUERIES["int_readmissions_flagged"]


def _with_views(sql: str) -> str:
    """Put the named results a query uses, directly or not, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in _VIEWS.items():
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(body)
                needed.append(name)

    visit(sql)
    views = ", ".join(f"{name} AS ({_VIEWS[name]})" for name in needed)
    return f"WITH {views} {sql}" if needed else sql


def build() -> dict[str, str]:
    return {name: _with_views(sql) for name, sql in _QUERIES.items()}
