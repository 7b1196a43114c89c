"""Fixed values of the domain: codes, defaults, offsets, horizons and bands.

They are part of the report definitions, so results only match when they match.
"""

from __future__ import annotations

# --- fixed values: channels -------------------------------------------------
DEFAULT_CHANNEL = "21"
UNKNOWN_ACCOUNT_CHANNEL = "no_acc"
NULL_TEXT_CHANNEL = "pyw"
MAX_PARENT_LEN = 10
MAX_CHILD_LEN = 10
MAX_PKG_LEN = 15

# --- fixed values: orders ---------------------------------------------------
PAID = 4
REFUNDED = 8
GAME_PRODUCT = 6
APPLE_PAY_TYPE = 5
PAY_TYPE_CODES = {11: "a", 100: "b"}

# --- fixed values: retention offsets and value horizons, in days -------------
RETENTION_SHORT = (1, 2, 3, 4, 5, 6, 14, 29, 59)
RETENTION_LONG = (*range(1, 15), 29)
LTV_SHORT = (2, 3, 4, 5, 6, 7, 15, 30, 60)
LTV_LONG = (*range(1, 16), 30, 45, 60, 90, 180)
PAY_LTV = (1, 2, 3, 7, 30)
PAY_OFFSETS = (*range(0, 15), 29, 44, 59, 89, 119, 149, 179)
PAY_CURVE_DAYS = 15

# --- fixed values: attribution ------------------------------------------------
CLICK_LOOKBACK_DAYS = 7
ACTIVATION_LOOKBACK_DAYS = 30
MEDIA = {0: "pyw", 1: "momo", 2: "baidu", 3: "jinritoutiao", 4: "aiqiyi", 5: "uc", 6: "guangdiantong"}
HASHED_MEDIA = (1, 3)
OS_ANDROID = 1
OS_IOS = 2

# --- fixed values: devices ------------------------------------------------------
ZERO_DEVICE = "0" * 32
NULL_DEVICES = ("0" * 32, "0" * 15, "")
HASHED_NULL_DEVICE = "5284047f4ffb4e04824a2fd1d1f0cd62"

# --- fixed values: landing-page click types -----------------------------------------
CLICK_TYPES = {1: "show_uv", 2: "download_uv", 3: "adpage_click_uv", 4: "request_click_uv"}

# --- fixed values: histogram bands [lo, hi] of counts, [lo, hi) of money -------------
ACCOUNTS_PER_DEVICE = ((1, 1), (2, 5), (6, 10), (11, 20), (21, 50), (51, 100), (101, 200), (201, None))
LOGINS_PER_DEVICE = ((1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 10), (11, None))
SPEND_BANDS = (
    (None, 1), (1, 50), (50, 100), (100, 300), (300, 500), (500, 1000), (1000, 2000), (2000, 3000),
    (3000, 5000), (5000, 10000), (10000, 30000), (30000, None),
)

ORDER_DEDUP_SECONDS = 3600
DAY_STATE_HOURS = 48
OPEN_END_DATE = "9999-01-01"
OPEN_START_DATE = "2016-01-01"
