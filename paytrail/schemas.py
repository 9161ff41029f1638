"""Declared schemas of the source extracts and the data-quality log.

Money and rates are exact decimals and pay periods are strings, so neither sums
nor joins depend on what a CSV reader would infer.
"""

MONEY = "decimal(18,2)"
RATE = "decimal(9,4)"

# Tables, column names and types of the extracts that sources deliver.
REFERENCE_EXTRACTS = {
    "agencies": "agency_id string, agency_name string, agency_type string, region string",
    "agents": (
        "agent_id string, first_name string, last_name string, email string, hire_date date, "
        "termination_date date, agent_status string, license_number string, "
        "license_state string, agency_id string, upline_agent_id string"
    ),
    "agent_tier_history": (
        "agent_id string, tier string, effective_start_date date, "
        "effective_end_date date, is_current boolean"
    ),
    "products": (
        "product_id string, product_name string, line_of_business string, "
        f"base_commission_rate {RATE}, premium_low int, premium_high int"
    ),
    "commission_plans": (
        "plan_id string, product_id string, agent_tier string, transaction_type string, "
        f"commission_rate {RATE}, effective_start_date date, effective_end_date date"
    ),
}

MONTHLY_EXTRACTS = {
    "policies": (
        "policy_id string, policy_number string, customer_id string, product_id string, "
        "agent_id string, issue_date date, policy_start_date date, cancel_date date, "
        f"annual_premium {MONEY}, policy_status string"
    ),
    "commission_transactions": (
        "transaction_id string, policy_id string, agent_id string, product_id string, "
        f"transaction_type string, transaction_date date, premium_amount {MONEY}, "
        f"commission_rate {RATE}, commission_amount {MONEY}"
    ),
    "chargebacks": (
        "chargeback_id string, original_transaction_id string, policy_id string, "
        f"agent_id string, chargeback_date date, chargeback_reason string, chargeback_amount {MONEY}"
    ),
    "payments": (
        "payment_id string, agent_id string, pay_period string, payment_date date, "
        f"gross_commission {MONEY}, chargeback_deductions {MONEY}, "
        f"net_payment_amount {MONEY}, payment_status string, payment_method string"
    ),
}

# Date column that decides the month folder of each monthly extract.
EXTRACT_DATE = {
    "policies": "issue_date",
    "commission_transactions": "transaction_date",
    "chargebacks": "chargeback_date",
    "payments": "payment_date",
}

# Columns of the quality log that readers of it rely on.
QUALITY_LOG = (
    "table_name string, check_name string, description string, severity string, "
    "failing_rows bigint, total_rows bigint, passed boolean, run_timestamp string"
)
