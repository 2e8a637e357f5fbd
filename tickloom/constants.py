"""Schemas, limits and fixed values shared by the operators."""

from __future__ import annotations

# Event domains.
DOMAINS = (
    "market",
    "transaction",
    "wallet",
    "holder",
    "security",
    "news",
    "social",
    "discovery",
)

ENVELOPE_SCHEMA = (
    "event_id string, source string, schema_version string, ingestion_timestamp timestamp, "
    "event_timestamp timestamp, token_address string, domain string, payload string"
)
ENVELOPE_COLUMNS = (
    "event_id",
    "source",
    "schema_version",
    "ingestion_timestamp",
    "event_timestamp",
    "token_address",
    "domain",
    "payload",
)
SILVER_SCHEMA = (
    "event_id string, source string, schema_version string, ingestion_timestamp timestamp, "
    "event_timestamp timestamp, token_address string, domain string, open double, high double, "
    "low double, close double, volume double, volume_usd double, currency string, event_date date"
)
GOLD_SCHEMA = (
    SILVER_SCHEMA
    + ", return_1h double, return_4h double, return_24h double, sma_20 double, "
    "volatility_20 double, rsi_14 double, ema_fast double, ema_slow double, macd double, "
    "macd_signal double"
)
# One landed response per line.
LANDED_SCHEMA = "request_key string, received_at timestamp, response string"

HOURS_PER_YEAR = 24 * 365

# Model features and the default label parameters.
ENTRY_FEATURES = (
    "return_1h",
    "return_4h",
    "return_24h",
    "sma_20",
    "volatility_20",
    "rsi_14",
    "ema_fast",
    "ema_slow",
    "macd",
    "macd_signal",
)
EXIT_FEATURES = (
    "unrealized_return",
    "periods_held",
    "drawdown_from_high",
    "volatility_20",
    "rsi_14",
    "macd",
)
ENTRY_HORIZON, ENTRY_UPPER_PCT, ENTRY_LOWER_PCT = 6, 0.01, 0.01
EXIT_HOLDING_PERIOD, EXIT_HORIZON, EXIT_DECLINE_THRESHOLD = 4, 3, 0.01
MIN_TRAINING_ROWS = 20

# Candle intervals in seconds.
INTERVAL_SECONDS = {
    "1m": 60,
    "3m": 180,
    "5m": 300,
    "15m": 900,
    "30m": 1800,
    "1H": 3600,
    "2H": 7200,
    "4H": 14400,
    "6H": 21600,
    "8H": 28800,
    "12H": 43200,
    "1D": 86400,
    "3D": 259200,
    "1W": 604800,
}
CANDLES_PER_REQUEST = 900

# News categories in the order they are tried, with their keywords.
NEWS_KEYWORDS = (
    ("hack", ("hack", "hacked", "hacker", "compromised")),
    ("exploit", ("exploit", "exploited", "vulnerability", "drained")),
    ("rug_allegations", ("rug pull", "rugpull", "rugged", "scam alert")),
    ("security_incident", ("security incident", "breach", "unauthorized access")),
    ("lawsuit", ("lawsuit", "sued", "sec charges", "class action")),
    ("regulation", ("regulation", "regulator", "sec ", "compliance", "banned")),
    ("delisting", ("delist", "delisting", "removed from")),
    ("exchange_listing", ("lists ", "listing", "now available on", "added to")),
    ("network_outage", ("outage", "downtime", "network down", "halted")),
    ("whale_activity", ("whale", "large transfer", "moved $")),
    ("partnership", ("partnership", "partners with", "collaborat")),
    ("developer_announcement", ("roadmap", "mainnet", "testnet", "upgrade", "release")),
    ("token_launch", ("launches", "launch of", "airdrop", "new token")),
)
# Outlets whose reports count as credible.
CREDIBLE_DOMAINS = (
    "coindesk.com",
    "cointelegraph.com",
    "theblock.co",
    "decrypt.co",
    "reuters.com",
    "bloomberg.com",
)

# Share of supply held by the ten largest holders, per tier.
CONCENTRATION_TIERS = ((0.80, "CRITICAL"), (0.60, "VERY_HIGH"), (0.40, "HIGH"), (0.20, "MODERATE"))
# Rug-risk points and score tiers.
TIER_POINTS = {"LOW": 0, "MODERATE": 15, "HIGH": 30, "VERY_HIGH": 40, "CRITICAL": 50}
OUTFLOW_POINTS, MINT_POINTS, FREEZE_POINTS, MAX_SCORE = 25, 20, 15, 100
SCORE_TIERS = ((81, "CRITICAL"), (61, "VERY_HIGH"), (41, "HIGH"), (21, "MODERATE"))
# Candidate sanity and momentum floors (volume, liquidity, holders, trades).
MAX_VOLUME_TO_LIQUIDITY = 50.0
MOMENTUM_FLOORS = (("STRONG", 50_000, 20_000, 100, 200), ("MODERATE", 10_000, 5_000, 50, 50))
# Decision cascade.
OVERRIDE_TIERS = ("CRITICAL", "VERY_HIGH")
ACUTE_NEWS = ("hack", "exploit", "rug_allegations", "security_incident")
# Alert severities and their order in reports.
MOVE_SEVERITIES = ((0.20, "CRITICAL"), (0.10, "HIGH"), (0.05, "WARNING"), (0.02, "WATCH"))
SEVERITY_ORDER = ("CRITICAL", "HIGH", "WARNING", "WATCH", "INFO")
# Promotion margins.
MIN_AUC_GAIN, MAX_BRIER_LOSS = 0.02, 0.01
# A position with no more than this size left is closed.
CLOSED_SIZE = 1e-12
# Tokens always on the watchlist, and how many discovered ones join them.
MANUAL_WATCHLIST = ("So11111111111111111111111111111111111111112",)
MAX_DISCOVERED = 10
# Default news feeds, in reading order.
DEFAULT_FEEDS = ("cointelegraph.com", "coindesk.com")

# Texts of rug-risk reasons and of missing signals.
RISK_TEXTS = {
    "concentration": "Holder concentration is %s (+%d points)",
    "outflow": "Monitored wallet sent tokens out within the last 24h (+%d points)" % OUTFLOW_POINTS,
    "mint": "Mint authority is still active - supply can be increased at will (+%d points)" % MINT_POINTS,
    "freeze": "Freeze authority is still active - holder accounts can be frozen (+%d points)" % FREEZE_POINTS,
    "clean": "No red flags detected in the signals that were available",
    "no_concentration": "holder concentration data unavailable",
    "no_outflow": "dev-wallet outflow data unavailable",
    "no_mint": "mint authority status unavailable",
    "no_freeze": "freeze authority status unavailable",
}
# Texts of recommendation reasons and risks.
DECISION_TEXTS = {
    "tier_override": (
        "SECURITY OVERRIDE: rug-risk tier is %s (score %s/100) - this overrides any other bullish signal"
    ),
    "news_override": (
        "SECURITY OVERRIDE: recent news classified as '%s'%s - this overrides any other bullish signal, regardless "
        "of source credibility, since even an unconfirmed report of this severity warrants caution until verified"
    ),
    "credibility": " (source credibility: %s)",
    "tier_risk": "Rug-risk tier: %s",
    "news_risk": "News event: %s",
    "tier": "Rug-risk tier is %s (score %s/100)",
    "no_model": "Entry model probability unavailable",
    "momentum": (
        "Discovery screening metrics (volume, liquidity, holders, trade count) are strong - this is a raw-data "
        "heuristic, NOT a model prediction, and does not by itself justify BUY"
    ),
    "bullish": "Entry model probability is %.2f (bullish)",
    "bearish": "Entry model probability is %.2f (bearish)",
    "neutral": "Entry model probability is %.2f (not strongly bullish or bearish)",
    "silent": "No strong signals in either direction",
}
# Texts of promotion reasons.
PROMOTION_TEXTS = {
    "first": "No existing champion - promoting first model",
    "incomparable": "Cannot compare: roc_auc missing from champion or challenger metrics",
    "weak": (
        "ROC-AUC improvement (%+.4f) is below the required minimum (0.02) - challenger is not clearly better, "
        "keeping current champion"
    ),
    "ahead": "ROC-AUC improved by %+.4f (%.4f -> %.4f)",
    "worse": (
        "REJECTED despite ROC-AUC improvement: calibration (Brier score) regressed by %+.4f, exceeding the allowed "
        "tolerance (0.01) - the challenger may be gaming ROC-AUC via overconfident predictions"
    ),
    "calibrated": "Calibration (Brier score) did not regress meaningfully (%+.4f)",
    "uncalibrated": (
        "Brier score unavailable for one or both models - calibration check skipped, promotion decision based on "
        "ROC-AUC alone"
    ),
}
