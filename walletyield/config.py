"""Thresholds and table schemas.

The business constants below must equal the reference's for identical
results; they are fixed values, stated together in one place.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import types as T

# --- fixed values (business rules) -------------------------------------
# minimum balance, strictly greater:            100
# holding period after the last movement:       24 hours
# rate look-back, dates including the day:      90
# trailing average window, rows:                14
# daily rate: (1 + annual/100) ** (1/365) - 1, HALF_UP to 10 dp, stored at 8 dp
# money: NUMERIC(18, 2); daily rate: NUMERIC(18, 8)
# ------------------------------------------------------------------------


@dataclass(frozen=True)
class Thresholds:
    min_balance: Decimal = Decimal("100")
    hold_hours: int = 24
    lookback_days: int = 90
    ma_rows: int = 14


DEFAULT = Thresholds()

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(18, 8)
RATE_10DP = T.DecimalType(18, 10)


def _f(name, dtype, nullable=True, comment=None):
    meta = {"comment": comment} if comment else {}
    return T.StructField(name, dtype, nullable, meta)


# Declared table schemas (nullability and column comments kept as metadata).
USERS = T.StructType([
    _f("user_id", T.LongType(), False, "Account number, one row each"),
])

CDC = T.StructType([
    _f("seq", T.LongType(), True, "Position in the feed: orders movements of one instant"),
    _f("user_id", T.LongType(), True),
    _f("ts", T.TimestampNTZType(), True),
    _f("amount_change", MONEY, True),
])

WALLET_HISTORY = T.StructType([
    _f("seq", T.LongType(), True, "Position in the feed: orders movements of one instant"),
    _f("user_id", T.LongType(), False, "Account whose balance changed"),
    _f("ts", T.TimestampNTZType(), False,
       "Instant of the movement (UTC); a balance is held from here to the next movement"),
    _f("amount_change", MONEY, True),
    _f("balance", MONEY, False, "Sum of all movements up to and including this one"),
])

DAILY_RATES = T.StructType([
    _f("rate_date", T.DateType(), False, "Day on which the rate was published"),
    _f("daily_rate", RATE, False, "Growth of one unit over one day, compounding to the annual rate"),
])

DAILY_PAYOUTS = T.StructType([
    _f("payout_date", T.DateType(), False, "Day that is paid"),
    _f("user_id", T.LongType(), False, "Account that is paid"),
    _f("calculated_amount", MONEY, False, "Start-of-day balance times the rate in force, rounded to cents"),
])

RAW_CDC_CSV = T.StructType([
    T.StructField("user_id", T.LongType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("amount_change", MONEY, True),
])

TABLE_SCHEMAS = {
    "users": USERS,
    "wallet_history": WALLET_HISTORY,
    "daily_interest_rates": DAILY_RATES,
    "daily_bonus_payouts": DAILY_PAYOUTS,
}

# Unique / primary keys and not-null columns declared by the schemas.
UNIQUE_KEYS = {
    "users": [["user_id"]],
    "wallet_history": [["user_id", "ts", "seq"], ["user_id", "ts"]],
    "daily_interest_rates": [["rate_date"]],
    "daily_bonus_payouts": [["payout_date", "user_id"]],
}
