"""Fixed values of the data model.

The values below are part of the stored data format (action names, number
scales, source tags), so they must stay exactly as they are.
"""

# Lending actions kept from the contract-event log.
LENDING_ACTIONS = (
    "supply",
    "withdraw",
    "supply_collateral",
    "withdraw_collateral",
    "borrow",
    "repay",
    "claim",
    "new_auction",
    "fill_auction",
)
AUCTION_ACTIONS = ("new_auction", "fill_auction")

# Backstop actions kept from the contract-event log.
BACKSTOP_ACTIONS = (
    "deposit",
    "withdraw",
    "queue_withdrawal",
    "dequeue_withdrawal",
    "claim",
    "donate",
    "draw",
    "gulp_emissions",
)

DEPOSIT_ACTIONS = ("supply", "supply_collateral")
WITHDRAW_ACTIONS = ("withdraw", "withdraw_collateral")

# Kinds of contract-state entries (first symbol of the entry key).
POSITIONS = "Positions"
RESERVE_DATA = "ResData"
RESERVE_CONFIG = "ResConfig"
POOL_BALANCE = "PoolBalance"
TOTAL_SHARES = "TotalShares"
ALL_RECORD_DATA = "AllRecordData"

# Fixed-point scales (number of decimal digits).
AMOUNT_DIGITS = 7
RATE_DIGITS = 12
EPS_DIGITS = 14

SECONDS_PER_YEAR = 31_536_000
LEDGERS_PER_DAY = 17_280

# First day for which emission yields exist.
YIELD_LAUNCH_DATE = "2025-04-14"
# Lower bound of the "all" time-range preset.
ALL_TIME_START = "2020-01-01"

# Where a row came from.
SRC_BACKFILL = "bq"
SRC_STREAM = "gs"
SRC_CSV = "csv"
SRC_STATE_FEED = "sdk"

# Where a token price came from.
PRICE_MARKET = "coingecko"
PRICE_BOND = "etherfuse"
PRICE_PEGGED = "pegged"
PRICE_ORACLE = "sdk_oracle"
PRICE_POOL_RATIO = "sdk_backstop"
PRICE_BACKFILL = "bigquery"

# Exchange rates used when the landed payload has no usable USD entry.
FALLBACK_FX = {"USD": 1.0, "EUR": 1.05, "GBP": 1.27}

# Shapes of addresses and dates.
ADDRESS_PATTERN = r"^[GCM][A-Z2-7]{55}$"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
