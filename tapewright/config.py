"""Constants of the data model and parameters with their defaults."""

from __future__ import annotations

from dataclasses import dataclass

PRICE_SCALE = 1_000_000_000
SIZE_SCALE = 1

# Names used in stored tables.
SCHEMAS = ("mbo", "mbp-10", "mbp-1", "bbo-1s", "bbo-1m", "trades", "ohlcv-1s", "ohlcv-1m", "ohlcv-1h")
TRADE_SCHEMAS = ("mbo", "mbp-1", "mbp-10")
BOOK_SCHEMAS = ("mbp-1", "mbp-10")
JOB_STATUS = ("PENDING", "COMPLETE", "FAILED", "GAP_UNEXPECTED", "GAP_EXPECTED")
REVIEW_STATUS = ("REVIEWED", "UNREVIEWED")
GAP_REASONS = ("EXCHANGE_CLOSED", "INTERNAL_ERROR", "OTHER", "UNKNOWN")
GAP_NOTE = "Gap detected by gap detector lambda"

SEQUENCE_RATIO = 0.20
GAP_SEARCH_MINUTES = 2880


@dataclass(frozen=True)
class MetricParams:
    """How one metric is scored: direction, thresholds, hour window on each side, and days looked back."""

    name: str
    direction: str
    z: float
    fallback: float
    hour_window: int
    lookback: int
    detect: bool
    rule: str
    minimum_days: int = 3

    @property
    def freshness_days(self) -> int:
        return 3 * self.minimum_days


# The parameters of each metric.
METRICS: tuple[MetricParams, ...] = (
    MetricParams("tickCount", "LOW", 3.0, 0.10, 1, 28, True, "TICK_COUNT_ANOMALY"),
    MetricParams("spread", "HIGH", 4.0, 10.0, 1, 21, False, "SPREAD_ANOMALY"),
    MetricParams("midPrice", "BOTH", 4.0, 0.0, 0, 21, False, "MID_PRICE_ANOMALY"),
    MetricParams("tradeVolume", "LOW", 3.0, 0.10, 1, 28, False, "TRADE_VOLUME_ANOMALY"),
    MetricParams("tradeFrequency", "LOW", 3.0, 0.10, 1, 28, False, "TRADE_FREQUENCY_ANOMALY"),
    MetricParams("volatility", "HIGH", 4.0, 5.0, 1, 21, False, "VOLATILITY_ANOMALY"),
)

# The gap tolerance.
TOLERANCE_DAYS, TOLERANCE_SAMPLES, TOLERANCE_LEAST, TOLERANCE_MOST, TOLERANCE_FACTOR = 14, 3, 1, 1440, 3.0

#: Conversions that jobs may ask for: (source, target).
CONVERSIONS: tuple[tuple[str, str], ...] = (
    ("mbp-10", "mbp-10"), ("mbp-10", "mbp-1"), ("mbp-10", "trades"), ("mbp-10", "bbo-1s"), ("mbp-10", "bbo-1m"), ("mbp-10", "ohlcv-1s"), ("mbp-10", "ohlcv-1m"), ("mbp-10", "ohlcv-1h"),
    ("mbp-1", "trades"), ("mbp-1", "bbo-1s"), ("mbp-1", "bbo-1m"), ("mbp-1", "ohlcv-1s"), ("mbp-1", "ohlcv-1m"), ("mbp-1", "ohlcv-1h"),
    ("mbo", "trades"), ("mbo", "ohlcv-1s"), ("mbo", "ohlcv-1m"), ("mbo", "ohlcv-1h"),
)
