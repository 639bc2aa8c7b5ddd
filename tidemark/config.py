"""Operator defaults in one frozen place."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SliceConfig:
    days: int = 30
    schedule_days: int = 14


@dataclass(frozen=True)
class QualityConfig:
    min_rating: float = 0.5
    max_rating: float = 5.0
    required: tuple[str, ...] = ("user_id", "item_id", "rating", "ts")


@dataclass(frozen=True)
class SequenceConfig:
    min_rating: float = 3.5
    max_len: int = 50
    min_len: int = 5
    mask_prob: float = 0.20
    seed: int = 42
    mask_value: int = 0
    pad_value: int = 0
    ignore_label: int = -100


@dataclass(frozen=True)
class FactorConfig:
    rank: int = 50
    iterations: int = 20
    reg: float = 0.02
    bias_damping: float = 5.0
    seed: int = 42


@dataclass(frozen=True)
class EvaluationConfig:
    k: int = 10
    relevant_rating: float = 3.5
    min_ndcg_gain: float = 0.001
    min_rmse_gain: float = 0.005


@dataclass(frozen=True)
class SplitConfig:
    train_fraction: float = 0.80
    val_fraction: float = 0.10
    holdout_fraction: float = 0.20


@dataclass(frozen=True)
class MonitoringConfig:
    drift_share: float = 0.5
    min_current_rows: int = 10
    wasserstein_threshold: float = 0.1
    degradation_window: int = 3
    min_new_rows: int = 1000


@dataclass(frozen=True)
class StorageConfig:
    """Buckets that history and user state are cut into; some hundred for billions of rows."""

    buckets: int = 64


@dataclass(frozen=True)
class EngineConfig:
    slices: SliceConfig = field(default_factory=SliceConfig)
    quality: QualityConfig = field(default_factory=QualityConfig)
    sequences: SequenceConfig = field(default_factory=SequenceConfig)
    factors: FactorConfig = field(default_factory=FactorConfig)
    evaluation: EvaluationConfig = field(default_factory=EvaluationConfig)
    split: SplitConfig = field(default_factory=SplitConfig)
    monitoring: MonitoringConfig = field(default_factory=MonitoringConfig)
    storage: StorageConfig = field(default_factory=StorageConfig)
