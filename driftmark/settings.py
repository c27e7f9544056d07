"""Settings, from the environment where it names them."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

PREFIX = "DRIFTMARK_"


class SettingsError(ValueError):
    """A setting without sense."""


@dataclass(frozen=True)
class Settings:
    store: str = "driftmark-store"
    events: str = "driftmark-events"
    embedding_provider: str = "hashed"
    embedding_dimension: int = 384
    embedding_failure_rate: float = 0.0
    max_retries: int = 5
    retry_base_delay_seconds: float = 0.5
    reconcile_interval_seconds: float = 300.0
    reconcile_grace_seconds: float = 60.0
    reconcile_batch: int = 1000
    relay_batch: int = 500
    relay_poll_interval_ms: int = 200
    min_chars: int = 80
    max_chars: int = 1000
    buckets: int = 16
    lock_seconds: float = 900.0
    embedding_url: str = ""
    embedding_model: str = "text-embedding-3-small"
    embedding_key_variable: str = "EMBEDDING_API_KEY"
    embedding_timeout_seconds: float = 30.0
    kafka_servers: str = ""
    kafka_topic: str = "document-changes"

    def __post_init__(self) -> None:
        positive = ("embedding_dimension", "reconcile_interval_seconds", "reconcile_batch", "relay_batch", "relay_poll_interval_ms", "min_chars", "buckets", "lock_seconds", "embedding_timeout_seconds")
        for name in positive:
            if getattr(self, name) <= 0:
                raise SettingsError(f"{name} must be positive")
        for name in ("max_retries", "retry_base_delay_seconds", "reconcile_grace_seconds"):
            if getattr(self, name) < 0:
                raise SettingsError(f"{name} must not be negative")
        if not 0.0 <= self.embedding_failure_rate <= 1.0:
            raise SettingsError("embedding_failure_rate must be between 0 and 1")
        if self.embedding_provider not in ("hashed", "remote"):
            raise SettingsError(f"unknown embedding_provider {self.embedding_provider!r}")
        if self.embedding_provider == "remote" and not self.embedding_url:
            raise SettingsError("embedding_provider remote needs embedding_url")
        if self.max_chars < self.min_chars:
            raise SettingsError("max_chars must not be less than min_chars")

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Settings:
        """Blank counts as not set."""
        env = os.environ if env is None else env
        given = {}
        for f in fields(cls):
            if raw := env.get(PREFIX + f.name.upper(), "").strip():
                try:
                    given[f.name] = type(f.default)(raw)  # type: ignore[call-overload,misc]
                except ValueError as e:
                    raise SettingsError(f"{PREFIX}{f.name.upper()}: {raw!r}") from e
        return cls(**given)
