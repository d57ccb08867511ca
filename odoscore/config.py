"""Job configuration: one frozen object instead of a file read by every job."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SplitConfig:
    validation: float = 0.15
    test: float = 0.15
    seed: int = 42


@dataclass(frozen=True)
class ModelConfig:
    kind: str
    params: dict = field(default_factory=dict)


@dataclass(frozen=True)
class GuardrailConfig:
    min_auc: float = 0.80
    max_regression: float = 0.01


@dataclass(frozen=True)
class JobConfig:
    """Defaults are the published training settings."""

    label: str = "churn"
    key: str = "customer_id"
    split: SplitConfig = SplitConfig()
    baseline: ModelConfig = ModelConfig("logistic_regression", {"C": 1.0, "max_iter": 1000})
    candidate: ModelConfig = ModelConfig(
        "gradient_boosting", {"n_estimators": 200, "max_depth": 3, "learning_rate": 0.05}
    )
    guardrail: GuardrailConfig = GuardrailConfig()
    # Output tables are written below this folder; None keeps results in memory only.
    artifact_root: str | None = None

    def table(self, name: str) -> str:
        if self.artifact_root is None:
            raise ValueError("artifact_root is not set")
        return f"{self.artifact_root.rstrip('/')}/{name}"
