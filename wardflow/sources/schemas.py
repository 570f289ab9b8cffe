"""Contracts of the raw tables: columns, types and the names used downstream."""

from __future__ import annotations

from pyspark.sql import types as T

_SPARK_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
}


def _schema(**groups: list[str]) -> T.StructType:
    """Schema from column names grouped by type name."""
    return T.StructType(
        [T.StructField(name, _SPARK_TYPES[kind]) for kind, names in groups.items() for name in names]
    )


# Raw column -> column name used from staging on.
METRIC_NAMES = {
    "Facility ID": "facility_id",
    "Facility Name": "facility_name",
    "State": "state_code",
    "Measure Name": "measure_name",
    "Number of Discharges": "number_of_discharges",
    "Excess Readmission Ratio": "excess_readmission_ratio",
    "Predicted Readmission Rate": "predicted_readmission_rate",
    "Expected Readmission Rate": "expected_readmission_rate",
    "Number of Readmissions": "number_of_readmissions",
    "Start Date": "measurement_period_start",
    "End Date": "measurement_period_end",
    "Footnote": "footnote_code",
}

# Raw column -> column name used from staging on.
HOSPITAL_NAMES = {
    "Facility ID": "facility_id",
    "Facility Name": "facility_name",
    "Address": "address",
    "City/Town": "city",
    "State": "state_code",
    "ZIP Code": "zip_code",
    "County/Parish": "county",
    "Telephone Number": "phone_number",
    "Hospital Type": "hospital_type",
    "Hospital Ownership": "hospital_ownership",
    "Emergency Services": "has_emergency_services",
    "Meets criteria for birthing friendly designation": "is_birthing_friendly",
    "Hospital overall rating": "overall_rating",
    "Hospital overall rating footnote": "overall_rating_footnote",
    "Count of Facility MORT Measures": "mort_measures_count",
    "Count of MORT Measures Better": "mort_better_count",
    "Count of MORT Measures No Different": "mort_same_count",
    "Count of MORT Measures Worse": "mort_worse_count",
    "MORT Group Footnote": "mort_group_footnote",
    "Count of Facility Safety Measures": "safety_measures_count",
    "Count of Safety Measures Better": "safety_better_count",
    "Count of Safety Measures No Different": "safety_same_count",
    "Count of Safety Measures Worse": "safety_worse_count",
    "Safety Group Footnote": "safety_group_footnote",
    "Count of Facility READM Measures": "readm_measures_count",
    "Count of READM Measures Better": "readm_better_count",
    "Count of READM Measures No Different": "readm_same_count",
    "Count of READM Measures Worse": "readm_worse_count",
    "READM Group Footnote": "readm_group_footnote",
    "Count of Facility Pt Exp Measures": "ptexp_measures_count",
    "Pt Exp Group Footnote": "ptexp_group_footnote",
    "Count of Facility TE Measures": "te_measures_count",
    "TE Group Footnote": "te_group_footnote",
}

# Raw column -> column name used from staging on.
PROVIDER_NAMES = {
    "providerCcn": "provider_ccn",
    "nationalProviderIdentifier": "national_provider_id",
    "providerType": "provider_type_code",
    "stateCode": "state_code",
    "countyCode": "county_code",
    "msaActualGeographicLocation": "msa_actual_location",
    "cbsaActualGeographicLocation": "cbsa_actual_location",
    "censusDivision": "census_division",
    "bedSize": "bed_count",
    "caseMixIndex": "case_mix_index",
    "internsToBedsRatio": "interns_to_beds_ratio",
    "medicaidRatio": "medicaid_ratio",
    "supplementalSecurityIncomeRatio": "ssi_ratio",
    "operatingDsh": "operating_dsh_payment",
    "capitalIndirectMedicalEducationRatio": "capital_ime_ratio",
    "uncompensatedCareAmount": "uncompensated_care_amount",
    "vbpParticipantIndicator": "vbp_participant_flag",
    "vbpAdjustment": "vbp_adjustment_factor",
    "hrrParticipantIndicator": "hrr_participant_flag",
    "hrrAdjustment": "hrr_adjustment_factor",
    "hacReductionParticipantIndicator": "hac_reduction_participant_flag",
    "ehrReductionIndicator": "ehr_reduction_flag",
    "soleCommunityOrMedicareDependentHospitalBaseYear": "sole_community_hospital_indicator",
    "specialPaymentIndicator": "special_payment_indicator",
    "hospitalQualityIndicator": "hospital_quality_indicator",
    "newHospital": "is_new_hospital_flag",
    "ltchDppIndicator": "ltch_dpp_indicator",
    "operatingCostToChargeRatio": "operating_cost_to_charge_ratio",
    "capitalCostToChargeRatio": "capital_cost_to_charge_ratio",
    "caseMixAdjustedCostPerDischarge_PpsFacilitySpecificRate": "case_mix_adjusted_cost_per_discharge",
    "passThroughAmountForCapital": "pass_through_capital",
    "passThroughAmountForDirectMedicalEducation": "pass_through_direct_medical_ed",
    "passThroughAmountForDirectGraduateMedicalEducation": "pass_through_direct_graduate_med_ed",
    "passThroughAmountForOrganAcquisition": "pass_through_organ_acquisition",
    "passThroughAmountForKidneyAcquisition": "pass_through_kidney_acquisition",
    "passThroughAmountForAllogenicStemCellAcquisition": "pass_through_stem_cell_acquisition",
    "passThroughTotalAmount": "pass_through_total",
    "fiscalYearBeginDate": "fiscal_year_begin_date",
    "fiscalYearEndDate": "fiscal_year_end_date",
    "effectiveDate": "effective_date",
    "exportDate": "export_date",
    "terminationDate": "termination_date",
    "lastUpdated": "last_updated_raw",
    "intermediaryNumber": "medicare_intermediary_id",
}

PROVIDER_DATES = [
    "fiscalYearBeginDate",
    "fiscalYearEndDate",
    "effectiveDate",
    "exportDate",
    "terminationDate",
]
_PROVIDER_NUMBERS = [
    "caseMixIndex",
    "internsToBedsRatio",
    "medicaidRatio",
    "supplementalSecurityIncomeRatio",
    "operatingDsh",
    "capitalIndirectMedicalEducationRatio",
    "uncompensatedCareAmount",
    "vbpAdjustment",
    "hrrAdjustment",
    "operatingCostToChargeRatio",
    "capitalCostToChargeRatio",
    "caseMixAdjustedCostPerDischarge_PpsFacilitySpecificRate",
    "passThroughAmountForCapital",
    "passThroughAmountForDirectMedicalEducation",
    "passThroughAmountForDirectGraduateMedicalEducation",
    "passThroughAmountForOrganAcquisition",
    "passThroughAmountForKidneyAcquisition",
    "passThroughAmountForAllogenicStemCellAcquisition",
    "passThroughTotalAmount",
]
_provider_types = (
    dict.fromkeys(PROVIDER_DATES, "bigint")
    | dict.fromkeys(_PROVIDER_NUMBERS, "double")
    | {"bedSize": "int"}
)

RAW_METRICS = _schema(bigint=["Facility ID"], string=list(METRIC_NAMES)[1:])
RAW_HOSPITALS = _schema(string=list(HOSPITAL_NAMES))
RAW_PROVIDERS = T.StructType(
    [
        T.StructField(name, _SPARK_TYPES[_provider_types.get(name, "string")])
        for name in PROVIDER_NAMES
    ]
)
PROVIDER_TYPES = _schema(
    string=["provider_type_code", "provider_type_label", "category"],
    boolean=["is_hrrp_eligible"],
)
ADMISSION_EVENTS = T.StructType(
    [
        T.StructField("admission_id", T.StringType()),
        T.StructField("patient_id", T.StringType()),
        T.StructField("facility_id", T.LongType()),
        T.StructField("admission_date", T.DateType()),
        T.StructField("discharge_date", T.DateType()),
        T.StructField("admission_type", T.StringType()),
        T.StructField("diagnosis_category", T.StringType()),
        T.StructField("length_of_stay", T.IntegerType()),
    ]
)
