"""The star schema: columns, grains, foreign keys, text limits and domains."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# fixed values: table and column names with their types; "?" marks a nullable column.
# Counts are int and percentages decimal(9,2), so that a busy week or a tiny quota fits.
COLUMNS = {
    "dim_date": """
        date_key date, day_of_week_num smallint, day_of_week_name string, day_of_month smallint,
        week_number smallint, month_num smallint, month_name string, calendar_quarter smallint,
        calendar_year smallint, fiscal_quarter smallint, fiscal_year smallint,
        fiscal_quarter_name string, fiscal_period_name string, is_weekend boolean,
        is_holiday boolean, holiday_name string?""",
    "dim_territory": """
        territory_key bigint, territory_code string, territory_name string, district_code string,
        district_name string, region_code string, region_name string, zone_code string,
        zone_name string, national string""",
    "dim_rep": """
        rep_key bigint, rep_id string, rep_durable_key string, rep_name string, title string,
        hire_date date, employment_status string, manager_name string, manager_id string,
        territory_key bigint, current_territory_key bigint, current_territory_name string,
        specialty_focus string, district string, region string, effective_date date,
        expiration_date date?, is_current boolean""",
    "dim_hcp": """
        hcp_key bigint, npi_number string, hcp_durable_key string, vendor_hcp_id string?,
        first_name string, last_name string, full_name string, specialty string,
        sub_specialty string?, practice_name string?, address_line_1 string,
        address_line_2 string?, city string, state string, zip string, segment string,
        decile_rank smallint, effective_date date, expiration_date date?, is_current boolean""",
    "dim_product": """
        product_key bigint, product_code string, brand_name string, generic_name string,
        therapeutic_area string, indication string, drug_class string, formulation string,
        dosage_strength string, route_of_admin string, market_status string, launch_date date,
        patent_expiry_date date?, effective_date date, expiration_date date?,
        is_current boolean""",
    "dim_visit_flags": """
        visit_flags_key bigint, visit_type string, call_type string, access_type string,
        program_type string""",
    "dim_call_notes": """
        call_notes_key bigint, note_text string, note_length int, note_type string,
        note_created_at timestamp_ntz, note_created_by string""",
    "dim_audit": """
        audit_key bigint, batch_id string, batch_start_time timestamp_ntz,
        batch_end_time timestamp_ntz?, batch_status string, source_system string,
        source_file_name string?, source_row_count bigint, loaded_row_count bigint,
        dq_flag string, dq_notes string?, transform_version string, loaded_by string,
        corrects_period date?""",
    "dim_month": """
        month_key date, month_name string, month_num smallint, calendar_quarter smallint,
        calendar_year smallint, fiscal_quarter smallint, fiscal_year smallint,
        fiscal_period_name string""",
    "dim_territory_rollup": """
        territory_rollup_key bigint, territory_key bigint, territory_name string,
        district string, region string""",
    "bridge_hcp_rep_alignment": """
        alignment_key bigint, group_key bigint, hcp_key bigint, rep_key bigint,
        product_key bigint, credit_split_weight decimal(10,9), effective_date date,
        expiration_date date?, is_current boolean""",
    "fct_hcp_visit": """
        visit_key bigint, visit_id string, date_key date, rep_key bigint, hcp_key bigint,
        product_key bigint, visit_flags_key bigint, call_notes_key bigint, audit_key bigint,
        samples_dropped int, visit_duration_minutes int""",
    "fct_prescription_weekly": """
        prescription_key bigint, week_end_date_key date, hcp_key bigint, product_key bigint,
        territory_key bigint, group_key bigint?, audit_key bigint, new_rx_count int,
        total_rx_count int, total_units bigint, brand_units bigint, total_market_units bigint,
        market_share_pct decimal(9,2)?""",
    "fct_quota_attainment": """
        quota_key bigint, fiscal_quarter_key date, prior_year_quarter_key date, rep_key bigint,
        product_key bigint, territory_key bigint, audit_key bigint, quota_units bigint,
        actual_units bigint, prior_year_actual_units bigint, attainment_pct decimal(9,2)?,
        effective_date date, expiration_date date?, is_current boolean""",
    "fct_hcp_coverage_target": """
        coverage_key bigint, fiscal_quarter_key date, rep_key bigint, hcp_key bigint,
        product_key bigint""",
    "fct_prescription_territory_monthly": """
        territory_monthly_key bigint, month_key date, territory_rollup_key bigint,
        product_key bigint, new_rx_count bigint, total_rx_count bigint, total_units bigint,
        brand_units bigint, total_market_units bigint, market_share_pct decimal(9,2)?,
        source_row_count bigint, last_rebuilt_at timestamp_ntz""",
}

# fixed values: unique keys
GRAINS = {
    "dim_date": ["date_key"],
    "dim_territory": ["territory_code"],
    "dim_rep": ["rep_durable_key", "effective_date"],
    "dim_hcp": ["hcp_durable_key", "effective_date"],
    "dim_product": ["product_code"],
    "dim_visit_flags": ["visit_type", "call_type", "access_type", "program_type"],
    "dim_call_notes": ["call_notes_key"],
    "dim_audit": ["audit_key"],
    "dim_month": ["month_key"],
    "dim_territory_rollup": ["territory_rollup_key"],
    "bridge_hcp_rep_alignment": ["group_key", "rep_key", "product_key", "effective_date"],
    "fct_hcp_visit": ["visit_id"],
    "fct_prescription_weekly": [
        "week_end_date_key", "hcp_key", "product_key", "territory_key"
    ],
    "fct_quota_attainment": ["rep_key", "product_key", "fiscal_quarter_key"],
    "fct_hcp_coverage_target": ["fiscal_quarter_key", "rep_key", "hcp_key", "product_key"],
    "fct_prescription_territory_monthly": ["month_key", "territory_rollup_key", "product_key"],
}

# fixed values: (column, dimension, key of the dimension)
FOREIGN_KEYS = {
    "dim_rep": [
        ("territory_key", "dim_territory", "territory_key"),
        ("current_territory_key", "dim_territory", "territory_key"),
    ],
    "dim_territory_rollup": [("territory_key", "dim_territory", "territory_key")],
    "bridge_hcp_rep_alignment": [
        ("hcp_key", "dim_hcp", "hcp_key"),
        ("rep_key", "dim_rep", "rep_key"),
        ("product_key", "dim_product", "product_key"),
    ],
    "fct_hcp_visit": [
        ("date_key", "dim_date", "date_key"),
        ("rep_key", "dim_rep", "rep_key"),
        ("hcp_key", "dim_hcp", "hcp_key"),
        ("product_key", "dim_product", "product_key"),
        ("visit_flags_key", "dim_visit_flags", "visit_flags_key"),
        ("call_notes_key", "dim_call_notes", "call_notes_key"),
        ("audit_key", "dim_audit", "audit_key"),
    ],
    "fct_prescription_weekly": [
        ("week_end_date_key", "dim_date", "date_key"),
        ("hcp_key", "dim_hcp", "hcp_key"),
        ("product_key", "dim_product", "product_key"),
        ("territory_key", "dim_territory", "territory_key"),
        ("audit_key", "dim_audit", "audit_key"),
    ],
    "fct_quota_attainment": [
        ("fiscal_quarter_key", "dim_date", "date_key"),
        ("prior_year_quarter_key", "dim_date", "date_key"),
        ("rep_key", "dim_rep", "rep_key"),
        ("product_key", "dim_product", "product_key"),
        ("territory_key", "dim_territory", "territory_key"),
        ("audit_key", "dim_audit", "audit_key"),
    ],
    "fct_hcp_coverage_target": [
        ("fiscal_quarter_key", "dim_date", "date_key"),
        ("rep_key", "dim_rep", "rep_key"),
        ("hcp_key", "dim_hcp", "hcp_key"),
        ("product_key", "dim_product", "product_key"),
    ],
    "fct_prescription_territory_monthly": [
        ("month_key", "dim_month", "month_key"),
        ("territory_rollup_key", "dim_territory_rollup", "territory_rollup_key"),
        ("product_key", "dim_product", "product_key"),
    ],
}

# fixed values: text limits and fixed widths that the data model states
TEXT_LIMITS = {
    "dim_territory": {"territory_code": 20, "territory_name": 100, "national": 50},
    "dim_rep": {"rep_id": 20, "rep_durable_key": 20, "rep_name": 100, "employment_status": 20},
    "dim_hcp": {"npi_number": 10, "hcp_durable_key": 20, "full_name": 200, "zip": 10},
    "dim_product": {"product_code": 20, "brand_name": 100, "market_status": 20},
    "dim_audit": {"batch_id": 50, "dq_flag": 20, "source_file_name": 200},
    "fct_hcp_visit": {"visit_id": 50},
}
FIXED_WIDTHS = {"dim_hcp": {"state": 2, "segment": 1}}

# fixed values: allowed values of coded columns
DOMAINS = {
    ("dim_rep", "employment_status"): ["active", "terminated", "leave"],
    ("dim_hcp", "segment"): ["A", "B", "C", "D"],
    ("dim_product", "market_status"): ["launched", "withdrawn", "pipeline"],
    ("dim_visit_flags", "visit_type"): ["in_person", "virtual"],
    ("dim_visit_flags", "call_type"): ["planned", "unplanned"],
    ("dim_visit_flags", "access_type"): ["saw_physician", "drop_off"],
    ("dim_visit_flags", "program_type"): ["standard_call", "lunch_program"],
    ("dim_call_notes", "note_type"): ["follow_up", "objection", "sample_request"],
    ("dim_audit", "batch_status"): ["running", "completed", "failed"],
    ("dim_audit", "dq_flag"): ["clean", "corrected", "superseded"],
}
FLAG_DOMAINS = {c: v for (t, c), v in DOMAINS.items() if t == "dim_visit_flags"}

# Folder columns: date filters of the reports then prune whole folders.
PARTITIONS = {
    "fct_hcp_visit": ["date_key"],
    "fct_prescription_weekly": ["week_end_date_key"],
    "fct_quota_attainment": ["fiscal_quarter_key"],
    "fct_hcp_coverage_target": ["fiscal_quarter_key"],
    "fct_prescription_territory_monthly": ["month_key"],
}

TYPES = {
    "date": T.DateType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def type_of(kind: str) -> T.DataType:
    """A stated type; decimals of any precision and scale are read from their name."""
    exact = re.fullmatch(r"decimal\((\d+),(\d+)\)", kind)
    return T.DecimalType(int(exact[1]), int(exact[2])) if exact else TYPES[kind]


def schema_of(name: str) -> T.StructType:
    fields = []
    for column in re.split(r",\s+", COLUMNS[name].strip()):
        col, kind = column.split()
        fields.append(T.StructField(col, type_of(kind.rstrip("?")), kind.endswith("?")))
    return T.StructType(fields)


def required(name: str) -> list[str]:
    return [f.name for f in schema_of(name).fields if not f.nullable]
