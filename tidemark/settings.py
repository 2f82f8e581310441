"""Parameters of every stage, as plain frozen dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field

# The columns a raw transaction table must have.
REQUIRED_COLUMNS = (
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
)


@dataclass(frozen=True)
class QualityRules:
    max_missing_pct: float = 5.0
    min_unit_price: float = 0.01
    min_quantity: float = -100000.0
    max_quantity: float = 100000.0
    cancellation_prefix: str = "C"
    duplicate_keys: tuple[str, ...] = ("InvoiceNo", "StockCode", "CustomerID")
    min_date: str = "2010-01-01"
    max_date: str = "2012-12-31"
    min_transactions: int = 2


@dataclass(frozen=True)
class CleaningRules:
    min_unit_price: float = 0.01
    max_price_quantile: float = 0.99
    quantity_iqr_factor: float = 3.0
    min_transactions: int = 2
    high_return_share: float = 0.8
    cancellation_prefix: str = "C"
    # Day and month are never guessed: the first format that parses wins.
    date_formats: tuple[str, ...] = (
        "M/d/yyyy H:mm",
        "yyyy-MM-dd HH:mm:ss",
        "yyyy-MM-dd'T'HH:mm:ss",
        "yyyy-MM-dd",
    )


@dataclass(frozen=True)
class FeatureRules:
    observation_days: int = 180
    # Window name -> days, both appear in the column names.
    windows: tuple[tuple[str, int], ...] = (
        ("short", 30),
        ("medium", 60),
        ("long", 90),
        ("very_long", 180),
    )


@dataclass(frozen=True)
class ChurnRules:
    observation_days: int = 180
    prediction_days: int = 90
    gap_days: int = 0
    min_transactions: int = 2
    min_tenure_days: int = 30
    validation_days: int = 90


@dataclass(frozen=True)
class ValueRules:
    horizon_days: int = 180
    log_transform: bool = True
    default_churn_probability: float = 0.2


@dataclass(frozen=True)
class SegmentThresholds:
    """Upper and lower limits used by the segment naming rules."""

    champion_recency: float = 30
    champion_frequency: float = 10
    champion_monetary: float = 100
    loyal_frequency: float = 8
    loyal_monetary: float = 80
    risk_recency: float = 60
    risk_frequency: float = 5
    risk_monetary: float = 60
    hibernating_recency: float = 90
    hibernating_frequency: float = 3
    new_recency: float = 30
    new_frequency: float = 3
    promising_recency: float = 45
    promising_frequency: float = 3
    attention_recency: float = 60
    attention_frequency: float = 2


@dataclass(frozen=True)
class Settings:
    quality: QualityRules = field(default_factory=QualityRules)
    cleaning: CleaningRules = field(default_factory=CleaningRules)
    features: FeatureRules = field(default_factory=FeatureRules)
    churn: ChurnRules = field(default_factory=ChurnRules)
    value: ValueRules = field(default_factory=ValueRules)
    naming: SegmentThresholds = field(default_factory=SegmentThresholds)
    seed: int = 42
