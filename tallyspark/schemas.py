"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_COLUMNS = [
    "id", "voucher_id", "consumer_id", "vch_type", "vch_amount", "vch_date", "vch_year",
    "vch_month", "vch_day", "vch_created_on", "vch_desc", "fc_amount", "fc_rate", "account_id",
    "record_created_on", "category_id", "use_case_title",
]

RAW = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

MONEY = "decimal(18,2)"
RATE = "decimal(18,6)"
CATEGORY_ID = "decimal(38,6)"

FLAGS = [
    "missing_description", "missing_transaction_date", "negative_amount", "zero_amount",
    "invalid_transaction_type", "future_transaction_date",
]

PRODUCTION_DDL = (
    "voucher_id long, source_id long, consumer_id long, transaction_type string,"
    " amount decimal(18,2), transaction_date date, transaction_year int,"
    " transaction_month int, transaction_day int, created_on timestamp_ntz,"
    " description string, foreign_currency_amount decimal(18,2),"
    " foreign_currency_rate decimal(18,6), account_id long,"
    " record_created_on timestamp_ntz, original_category_id decimal(38,6),"
    " use_case_title string, missing_description boolean,"
    " missing_transaction_date boolean, negative_amount boolean, zero_amount boolean,"
    " invalid_transaction_type boolean, future_transaction_date boolean"
)

#: The keyed production table: what batch, incremental and stream loads all write to.
LOADED_AT = "etl_loaded_at"
TABLE_DDL = f"{PRODUCTION_DDL}, {LOADED_AT} timestamp_ntz"

DQ_LOG_DDL = (
    "check_name string, check_status string, records_checked long, records_failed long,"
    " check_timestamp timestamp_ntz, details string"
)

MESSAGE_DDL = (
    "voucher_id string, consumer_id string, transaction_type string, amount string,"
    " transaction_date string, description string"
)
