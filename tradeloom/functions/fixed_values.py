"""Reference data that must hold for results to be right.

FIXED VALUES: every table below is data, not logic. Change a value here only
if the business definition changes.
"""

# --- currency rates to USD; an unknown or missing currency counts as 1.0 ----
FX_TO_USD = {
    "USD": 1.0,
    "EUR": 1.085,
    "GBP": 1.272,
    "JPY": 0.0067,
    "CHF": 1.112,
    "CAD": 0.738,
    "AUD": 0.653,
    "HKD": 0.128,
    "SGD": 0.749,
    "CNY": 0.138,
}

# --- legal entities ---------------------------------------------------------
LEGAL_ENTITY_SCHEMA = (
    "counterparty_id string, lei_code string, legal_entity_name string, "
    "lei_country string, credit_rating string"
)
LEGAL_ENTITIES = [
    ("CP001", "5493000IBP32UQZ0KL24", "Alpha Capital LLC", "US", "AA"),
    ("CP002", "213800WSGIIZCXF1P572", "Beta Finance GmbH", "DE", "A+"),
    ("CP003", "969500T3MBS4SQAMHJ45", "Gamma Trading Ltd", "GB", "A"),
    ("CP004", "254900OPPU84GM83WH09", "Delta Securities SA", "FR", "BBB+"),
    ("CP005", "3358003ERQZ8EKGPNB86", "Epsilon Funds Ltd", "IE", "AA-"),
]

# --- settlement statuses ----------------------------------------------------
STATUS_SCHEMA = (
    "status_key int, status_code string, status_label string, "
    "is_terminal boolean, requires_action boolean"
)
STATUSES = [
    (1, "SETTLED", "Settled", True, False),
    (2, "PENDING", "Pending Settlement", False, False),
    (3, "FAILED", "Failed", True, True),
    (4, "CANCELLED", "Cancelled", True, False),
    (5, "UNKNOWN", "Unknown", False, True),
]
UNKNOWN_STATUS_KEY = 5

# --- defaults for missing values -------------------------------------------
NULL_DEFAULTS = {
    "notional": 0.0,
    "quantity": 0.0,
    "currency": "USD",
    "direction": "UNKNOWN",
    "settlement_status": "PENDING",
    "asset_class": "UNKNOWN",
    "exchange": "UNKNOWN",
}

# --- canonical column types -------------------------------------------------
COLUMN_TYPES = {
    "notional": "double",
    "quantity": "double",
    "trade_id": "string",
    "trade_date": "timestamp_ntz",
    "settlement_date": "timestamp_ntz",
    "counterparty_id": "string",
    "product_id": "string",
    "currency": "string",
    "direction": "string",
}

# --- feeds: every column that is cast later is text here ---------------------
TRADES_CSV_SCHEMA = (
    "trade_id string, product_id string, counterparty_id string, asset_class string, "
    "currency string, direction string, notional string, quantity string, "
    "trade_date string, settlement_date string, settlement_status string, exchange string"
)

# --- lineage layers, in pipeline order, and their display colours -----------
LAYER_ORDER = ["raw", "clean", "typed", "dedup", "enriched", "risk_report", "fact_trades"]
LAYER_COLOURS = {
    "raw": "#6B7280",
    "clean": "#3B82F6",
    "typed": "#8B5CF6",
    "dedup": "#EC4899",
    "enriched": "#10B981",
    "risk_report": "#F59E0B",
    "fact_trades": "#EF4444",
    "other": "#9CA3AF",
}
DEFAULT_COLOUR = "#9CA3AF"

# --- dead letters -----------------------------------------------------------
DEAD_LETTER_COLUMNS = ["_dlq_batch_id", "_dlq_stage", "_dlq_reason", "_dlq_ts"]

# --- data quality -----------------------------------------------------------
SEVERITY_WEIGHTS = {"CRITICAL": 2.0, "ERROR": 1.5, "WARN": 1.0}

NAMED_EXPRESSIONS = {
    "settlement_after_trade": "settlement_date >= trade_date",
    "notional_matches_direction": "NOT (direction = 'SELL' AND notional < 0)",
    "quantity_positive_if_buy": "NOT (direction = 'BUY' AND quantity <= 0)",
    "lei_present_if_large_trade":
        "NOT (notional_usd > 10000000 AND (lei_code IS NULL OR lei_code = ''))",
    "settlement_within_10_days": "days_to_settlement BETWEEN 0 AND 10",
}

CURRENCIES = ["USD", "EUR", "GBP", "JPY", "CHF", "CAD", "AUD", "HKD", "SGD", "CNY"]

RULES = [
    # post_ingest
    {"name": "trade_id_not_null", "type": "null_check", "field": "trade_id",
     "severity": "CRITICAL", "stage": "post_ingest"},
    {"name": "notional_not_null", "type": "null_check", "field": "notional",
     "severity": "CRITICAL", "stage": "post_ingest"},
    {"name": "trade_date_not_null", "type": "null_check", "field": "trade_date",
     "severity": "CRITICAL", "stage": "post_ingest"},
    {"name": "counterparty_id_not_null", "type": "null_check", "field": "counterparty_id",
     "severity": "ERROR", "stage": "post_ingest"},
    {"name": "product_id_not_null", "type": "null_check", "field": "product_id",
     "severity": "ERROR", "stage": "post_ingest"},
    {"name": "currency_not_null", "type": "null_check", "field": "currency",
     "severity": "ERROR", "stage": "post_ingest"},
    {"name": "currency_valid", "type": "referential_integrity", "field": "currency",
     "mode": "static_values", "allowed_values": CURRENCIES,
     "severity": "ERROR", "stage": "post_ingest"},
    {"name": "direction_valid", "type": "referential_integrity", "field": "direction",
     "mode": "static_values", "allowed_values": ["BUY", "SELL"],
     "severity": "ERROR", "stage": "post_ingest"},
    {"name": "counterparty_id_valid", "type": "referential_integrity",
     "field": "counterparty_id", "mode": "static_values",
     "allowed_values": ["CP001", "CP002", "CP003", "CP004", "CP005"],
     "severity": "WARN", "stage": "post_ingest"},
    # post_clean
    {"name": "notional_positive", "type": "range_check", "field": "notional",
     "min": 0.01, "max": 1000000000, "severity": "ERROR", "stage": "post_clean"},
    {"name": "quantity_positive", "type": "range_check", "field": "quantity",
     "min": 1, "max": 10000000, "severity": "ERROR", "stage": "post_clean"},
    {"name": "settlement_date_not_null", "type": "null_check", "field": "settlement_date",
     "severity": "WARN", "stage": "post_clean"},
    {"name": "settlement_status_valid", "type": "referential_integrity",
     "field": "settlement_status", "mode": "static_values",
     "allowed_values": ["SETTLED", "PENDING", "FAILED", "CANCELLED", "UNKNOWN"],
     "severity": "WARN", "stage": "post_clean"},
    {"name": "settlement_date_not_before_trade_date", "type": "cross_field",
     "fields": ["trade_date", "settlement_date"], "expr": "settlement_date >= trade_date",
     "severity": "WARN", "stage": "post_clean"},
    {"name": "notional_usd_positive", "type": "range_check", "field": "notional_usd",
     "min": 0.01, "max": 2000000000, "severity": "ERROR", "stage": "post_clean"},
    # pre_load
    {"name": "notional_usd_not_null", "type": "null_check", "field": "notional_usd",
     "severity": "CRITICAL", "stage": "pre_load"},
    {"name": "notional_eur_not_null", "type": "null_check", "field": "notional_eur",
     "severity": "ERROR", "stage": "pre_load"},
    {"name": "trade_year_not_null", "type": "null_check", "field": "trade_year",
     "severity": "ERROR", "stage": "pre_load"},
    {"name": "fx_rate_in_valid_range", "type": "range_check", "field": "fx_rate_to_usd",
     "min": 0.0001, "max": 1000.0, "severity": "ERROR", "stage": "pre_load"},
    {"name": "lei_present_for_large_trades", "type": "cross_field",
     "fields": ["notional_usd", "lei_code"],
     "expr": "NOT (notional_usd > 10000000 AND (lei_code IS NULL OR lei_code = ''))",
     "severity": "WARN", "stage": "pre_load"},
    {"name": "days_to_settlement_reasonable", "type": "cross_field",
     "fields": ["trade_date", "settlement_date", "days_to_settlement"],
     "expr": "days_to_settlement BETWEEN -1 AND 30",
     "severity": "WARN", "stage": "pre_load"},
]
# --- end of fixed values ----------------------------------------------------
