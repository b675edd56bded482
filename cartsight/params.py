"""Parameters of every stage. The defaults below are fixed values of the data model."""

from __future__ import annotations

from dataclasses import dataclass, field

# Event types, in funnel order.
VIEW = "view"
SCROLL = "scroll"
ADD_TO_CART = "add_to_cart"
REMOVE_FROM_CART = "remove_from_cart"
PURCHASE = "purchase"
EVENT_TYPES = (VIEW, SCROLL, ADD_TO_CART, REMOVE_FROM_CART, PURCHASE)
INTENT_BOUNDARY = (PURCHASE, ADD_TO_CART)

# Sentinels and units.
NEVER_HOURS = 9999.0
SECOND_US = 1_000_000
MINUTE_US = 60 * SECOND_US
HOUR_US = 60 * MINUTE_US
DAY_US = 24 * HOUR_US

# Columns that identify or label an example and are never model inputs.
ID_COLUMNS = ("user_id", "item_id", "session_id", "session_end_time")
LABEL = "label"


@dataclass(frozen=True)
class SkewParams:
    """When is a key too hot for one task, and how finely is it cut along its order column.

    A key is cut only if it holds more than ``share`` of all rows and more than ``min_rows``.
    At most ``1 / share`` keys can exceed the share, so everything sent to the driver or
    broadcast about hot keys is bounded by ``coarse / share`` numbers.
    """

    share: float = 1.0 / 5000
    min_rows: int = 2_000_000
    coarse: int = 64
    fine: int = 64
    tracked: int = 20_000


@dataclass(frozen=True)
class SessionParams:
    inactivity_minutes: int = 30
    boundary_events: tuple[str, ...] = INTENT_BOUNDARY
    min_duration_seconds: int = 30
    max_duration_seconds: int = 3600


@dataclass(frozen=True)
class SplitParams:
    train_share: float = 0.70
    val_share: float = 0.15


@dataclass(frozen=True)
class FeatureParams:
    windows_days: tuple[int, ...] = (1, 7, 30)
    horizon_sessions: int = 3
    max_null_rate: float = 0.05


@dataclass(frozen=True)
class ModelParams:
    # Linear model
    max_iter: int = 1000
    # Boosted trees
    pos_weight: float = 9999.0
    max_depth: int = 6
    step_size: float = 0.05
    rounds: int = 200
    subsample: float = 0.8
    feature_share: float = 0.8
    patience: int = 20
    seed: int = 42
    # Hyper-parameter grid (searched on the temporal validation split)
    grid_max_depth: tuple[int, ...] = (4, 6, 8, 10)
    grid_step_size: tuple[float, ...] = (0.01, 0.05, 0.1, 0.2)
    grid_rounds: tuple[int, ...] = (100, 200, 300, 500)
    grid_pos_weight: tuple[float, ...] = (5000.0, 10000.0, 15000.0, 20000.0)
    grid_parallel: int = 8  # fits side by side


@dataclass(frozen=True)
class ScoreParams:
    threshold: float = 0.5
    target_precision: float = 0.10
    search_low: float = 0.001
    search_high: float = 0.999
    search_steps: int = 100
    top_percents: tuple[int, ...] = (1, 5, 10, 20)
    sweep: tuple[float, ...] = (0.3, 0.5, 0.7)


@dataclass(frozen=True)
class Params:
    skew: SkewParams = field(default_factory=SkewParams)
    session: SessionParams = field(default_factory=SessionParams)
    split: SplitParams = field(default_factory=SplitParams)
    feature: FeatureParams = field(default_factory=FeatureParams)
    model: ModelParams = field(default_factory=ModelParams)
    score: ScoreParams = field(default_factory=ScoreParams)
