"""Reference-data JSON lines with explicit schemas, so identifiers keep their
leading zeros and an empty answer keeps its columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tickloom.operators import formatting
from tickloom.schemas import struct

# Column names and types of the three reference tables, in file order.
ADJUSTMENT_FACTORS = """
security_id bigint, event_id bigint, event_type string, issuer_name string, security_type string,
primary_exchange string, operating_mic string, nasdaq_symbol string, local_code string,
local_code_resulting string, isin string, isin_resulting string, us_code string, status string,
ex_date string, factor double, close double, currency string, sentiment double, reason int,
detail string, ts_created string
"""
SECURITY_MASTER = """
ts_record string, ts_effective string, listing_id string, listing_group_id string, security_id string,
issuer_id string, listing_status string, listing_source string, listing_created_date string,
listing_date string, delisting_date string, issuer_name string, security_type string,
security_description string, primary_exchange string, exchange string, operating_mic string,
symbol string, nasdaq_symbol string, local_code string, isin string, us_code string, bbg_comp_id string,
bbg_comp_ticker string, figi string, figi_ticker string, fisn string, lei string, sic string, cik string,
gics string, naics string, cic string, cfi string, incorporation_country string, listing_country string,
register_country string, trading_currency string, multi_currency boolean, segment_mic_name string,
segment_mic string, structure string, lot_size bigint, par_value double, par_value_currency string,
voting string, vote_per_sec double, shares_outstanding bigint, shares_outstanding_date string,
ts_created string
"""
CORPORATE_ACTIONS = """
ts_record string, event_unique_id string, event_id string, listing_id string, listing_group_id string,
security_id string, issuer_id string, event_action string, event string, event_subtype string,
event_date_label string, event_date string, event_created_date string, effective_date string,
ex_date string, record_date string, record_date_id string, related_event string, related_event_id string,
global_status string, listing_status string, listing_source string, listing_date string,
delisting_date string, issuer_name string, security_type string, security_description string,
primary_exchange string, exchange string, operating_mic string, symbol string, nasdaq_symbol string,
local_code string, isin string, us_code string, bbg_comp_id string, bbg_comp_ticker string, figi string,
figi_ticker string, listing_country string, register_country string, trading_currency string,
multi_currency boolean, segment_mic_name string, segment_mic string, mand_volu_flag string,
rd_priority int, lot_size int, par_value double, par_value_currency string, payment_date string,
duebills_redemption_date string, from_date string, to_date string, registration_date string,
start_date string, end_date string, open_date string, close_date string, start_subscription_date string,
end_subscription_date string, option_election_date string, withdrawal_rights_from_date string,
withdrawal_rights_to_date string, notification_date string, financial_year_end_date string,
exp_completion_date string, payment_type string, option_id string, serial_id string,
default_option_flag boolean, rate_currency string, ratio_old double, ratio_new double, fraction string,
outturn_style string, outturn_security_type string, outturn_security_id string, outturn_isin string,
outturn_us_code string, outturn_local_code string, outturn_bbg_comp_id string,
outturn_bbg_comp_ticker string, outturn_figi string, outturn_figi_ticker string, min_offer_qty double,
max_offer_qty double, min_qualify_qty double, max_qualify_qty double, min_accept_qty double,
max_accept_qty double, tender_strike_price double, tender_price_step double, option_expiry_time string,
option_expiry_tz string, withdrawal_rights_flag string, withdrawal_rights_expiry_time string,
withdrawal_rights_expiry_tz string, expiry_time string, expiry_tz string, date_info map<string,string>,
rate_info map<string,string>, event_info map<string,string>, ts_created string
"""
TABLES = {"corporate_actions": CORPORATE_ACTIONS, "adjustment_factors": ADJUSTMENT_FACTORS,
          "security_master": SECURITY_MASTER}
TIME_COLUMNS = {
    "corporate_actions": ("ts_record", "ts_created"),
    "adjustment_factors": ("ts_created",),
    "security_master": ("ts_record", "ts_effective", "ts_created"),
}
DATE_COLUMNS = {
    "corporate_actions": (
        "event_date", "event_created_date", "effective_date", "ex_date", "record_date", "listing_date",
        "delisting_date", "payment_date", "duebills_redemption_date", "from_date", "to_date",
        "registration_date", "start_date", "end_date", "open_date", "close_date", "start_subscription_date",
        "end_subscription_date", "option_election_date", "withdrawal_right_from_date",
        "withdrawal_rights_from_date", "withdrawal_rights_to_date", "notification_date",
        "financial_year_end_date", "exp_completion_date",
    ),
    "adjustment_factors": ("ex_date",),
    "security_master": ("listing_created_date", "listing_date", "delisting_date", "shares_outstanding_date"),
}


def schema_of(kind: str) -> T.StructType:
    """Stored schema; dates and times are text until converted."""
    return struct(TABLES[kind].strip())


def read_reference(spark: SparkSession, path, kind: str) -> DataFrame:
    """JSON lines, plain or zstd, with dates and times converted (bad text gives NULL)."""
    raw = spark.read.schema(schema_of(kind)).json(path)
    return formatting.dates(formatting.datetimes(raw, TIME_COLUMNS[kind]), DATE_COLUMNS[kind])
