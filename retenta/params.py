"""Operator parameters.  Plain frozen dataclasses, passed explicitly."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class BusinessParams:
    retention_value: float = 1000.0
    contact_cost: float = 50.0
    churn_cost: float = 500.0


@dataclass(frozen=True)
class OutlierParams:
    iqr_factor: float = 1.5
    z_limit: float = 3.0
    winsor_low: float = 0.01
    winsor_high: float = 0.99
    contamination: float = 0.1


@dataclass(frozen=True)
class SplitParams:
    test_size: float = 0.2
    val_size: float = 0.2
    seed: int = 42
    folds: int = 5


@dataclass(frozen=True)
class CampaignParams:
    retention_cost: float = 50.0
    retention_effectiveness: float = 0.3
    min_clv: float = 100.0
    min_probability: float = 0.1
    budget: float = 10000.0


@dataclass(frozen=True)
class Transactions:
    """Names of the three columns every transaction operator needs."""

    customer: str = "customer_id"
    date: str = "date"
    value: str = "value"
