"""Job parameters. Every date that a job depends on is a parameter, so reruns give the same rows."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field
from datetime import date


@dataclass(frozen=True)
class RunParams:
    """Parameters of the extract, quality and customer steps of one run day."""

    run_date: date
    as_of: date | None = None  # "today" of the cleaning rules; None means current_date()
    lookback_days: int = 30
    until: date | None = None  # optional upper bound of the extract, open by default
    min_transactions: int = 5
    amount_max: float = 1_000_000.0
    date_floor: date = date(2010, 1, 1)
    segments: tuple[str, ...] = ("Premium", "Standard")
    dedupe_fanout: bool = False


@dataclass(frozen=True)
class FeatureParams:
    """Parameters of feature preparation."""

    critical_columns: tuple[str, ...] = ()
    date_columns: tuple[str, ...] = ()
    categorical_columns: tuple[str, ...] | None = None  # None: every string column
    key_columns: tuple[str, ...] = ()  # identify rows: never imputed, filtered, scaled or assembled
    target_column: str = "target"
    test_size: float = 0.2
    random_state: int = 42
    strict_reference: bool = False  # sequential filter over all numbers, statistics redone per batch


@dataclass(frozen=True)
class ModelParams:
    """Parameters of model training and acceptance."""

    model_type: str = "random_forest"
    n_estimators: int = 100
    max_depth: int | None = None
    max_iter: int = 1000
    random_state: int = 42
    max_bins: int = 32
    min_accuracy: float = 0.85
    extra: dict = field(default_factory=dict)

    def as_dict(self) -> dict:
        flat = asdict(self)
        return {**{k: v for k, v in flat.items() if k != "extra"}, **flat["extra"]}
