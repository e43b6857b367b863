"""Explicit schemas, value domains and column defaults of the seven tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)


def _struct(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


_I, _L, _S, _B, _D, _SH = T.IntegerType(), T.LongType(), T.StringType(), T.BooleanType(), T.DateType(), T.ShortType()

SCHEMAS: dict[str, T.StructType] = {
    "products": _struct(
        ("product_id", _I, False), ("product_code", _S, False), ("product_name", _S, False),
        ("product_category", _S, False), ("product_description", _S, True), ("revenue_value", MONEY, False),
        ("min_eligibility_age", _I, False), ("is_active", _B, False),
    ),
    "campaign_channels": _struct(
        ("channel_id", _I, False), ("channel_name", _S, False), ("channel_description", _S, True),
        ("benchmark_ctr", T.DecimalType(5, 2), True), ("benchmark_cvr", T.DecimalType(5, 2), True),
        ("benchmark_cpa", T.DecimalType(10, 2), True), ("is_active", _B, False),
    ),
    "customers": _struct(
        ("customer_id", _L, False), ("customer_code", _S, False), ("first_name", _S, False),
        ("last_name", _S, False), ("date_of_birth", _D, False), ("gender", _S, True), ("email", _S, True),
        ("phone", _S, True), ("region", _S, False), ("city", _S, True), ("postcode", _S, True),
        ("customer_segment", _S, False), ("employment_status", _S, True), ("annual_income", MONEY, True),
        ("credit_score", _SH, True), ("number_of_products", _SH, False), ("is_active", _B, False),
        ("is_dnc", _B, False), ("acquisition_date", _D, False), ("acquisition_channel_id", _I, True),
    ),
    "campaigns": _struct(
        ("campaign_id", _I, False), ("campaign_code", _S, False), ("campaign_name", _S, False),
        ("campaign_type", _S, False), ("product_id", _I, False), ("channel_id", _I, False),
        ("target_segment", _S, True), ("start_date", _D, False), ("end_date", _D, False),
        ("total_budget", MONEY, False), ("contacts_target", _I, False), ("ab_test_enabled", _B, False),
        ("campaign_manager", _S, True), ("status", _S, False), ("notes", _S, True),
    ),
    "campaign_interactions": _struct(
        ("interaction_id", _L, False), ("campaign_id", _I, False), ("customer_id", _L, False),
        ("channel_id", _I, False), ("interaction_date", _D, False), ("interaction_type", _S, False),
        ("interaction_outcome", _S, False), ("response_date", _D, True), ("ab_variant", _S, True),
        ("agent_id", _S, True),
    ),
    "campaign_conversions": _struct(
        ("conversion_id", _L, False), ("interaction_id", _L, False), ("campaign_id", _I, False),
        ("customer_id", _L, False), ("product_id", _I, False), ("channel_id", _I, False),
        ("conversion_date", _D, False), ("revenue_attributed", MONEY, False), ("conversion_type", _S, False),
        ("ab_variant", _S, True),
    ),
    "customer_products": _struct(
        ("customer_product_id", _L, False), ("customer_id", _L, False), ("product_id", _I, False),
        ("campaign_id", _I, True), ("channel_id", _I, True), ("acquisition_date", _D, False),
        ("closure_date", _D, True), ("status", _S, False), ("product_value", MONEY, True), ("notes", _S, True),
    ),
}

# Dependency order: every table comes after the tables its keys point to.
LOAD_ORDER = list(SCHEMAS)

PRIMARY_KEYS = {
    "products": "product_id",
    "campaign_channels": "channel_id",
    "customers": "customer_id",
    "campaigns": "campaign_id",
    "campaign_interactions": "interaction_id",
    "campaign_conversions": "conversion_id",
    "customer_products": "customer_product_id",
}

# The domains of the coded columns.
CATEGORIES = ["Credit Card", "Savings Account", "Fixed Deposit", "Personal Loan", "Home Loan"]
CHANNELS = ["Email", "SMS", "Branch", "Telemarketing", "Digital"]
SEGMENTS = ["Mass Market", "Affluent", "Premier", "Private Banking"]
GENDERS = ["Male", "Female", "Non-Binary", "Prefer Not to Say"]
EMPLOYMENT = ["Employed", "Self-Employed", "Unemployed", "Retired", "Student", "Part-Time"]
CAMPAIGN_TYPES = ["Acquisition", "Retention", "Cross-Sell", "Upsell", "Win-Back", "Awareness"]
CAMPAIGN_STATUS = ["Planned", "Active", "Paused", "Completed", "Cancelled"]
INTERACTION_TYPES = ["Sent", "Delivered", "Opened", "Clicked", "Called", "Visited Branch", "Web Visit"]
OUTCOMES = [
    "Pending", "Interested", "Not Interested", "Converted", "Opted Out", "No Response",
    "Callback Requested", "Declined",
]
VARIANTS = ["A", "B", "C"]
CONVERSION_TYPES = ["New", "Cross-Sell", "Upsell", "Reactivation"]
HOLDING_STATUS = ["Active", "Closed", "Suspended", "Pending Activation"]

# What a column holds when the writer gives nothing.
DEFAULTS: dict[str, dict[str, object]] = {
    "products": {"revenue_value": 0, "min_eligibility_age": 18, "is_active": True},
    "campaign_channels": {"is_active": True},
    "customers": {
        "customer_segment": "Mass Market", "number_of_products": 0, "is_active": True, "is_dnc": False,
    },
    "campaigns": {"total_budget": 0, "contacts_target": 0, "ab_test_enabled": False, "status": "Planned"},
    "campaign_interactions": {"interaction_outcome": "Pending"},
    "campaign_conversions": {"revenue_attributed": 0, "conversion_type": "New"},
    "customer_products": {"status": "Active"},
}

# Tables whose rows carry a last-changed time besides the creation time.
TOUCHED_TABLES = ["products", "customers", "campaigns", "customer_products"]
