"""Settings from the environment, checked."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

#: Searches used where no file names others.
DEFAULT_QUERIES = (
    '(#nifty50 OR #nifty OR "Nifty 50")',
    '(#banknifty OR #niftybank OR "Bank Nifty")',
    "(#sensex OR SENSEX)",
    '(#intraday OR "intraday trading") (NIFTY OR BANKNIFTY OR NSE OR BSE)',
    '(#stockmarketindia OR #indianstockmarket OR "Indian stock market")',
    "(NSE OR BSE) (stock OR stocks OR shares OR market)",
    "(NIFTY OR BANKNIFTY) (CE OR PE OR call OR put OR options)",
    "(NIFTY OR SENSEX) (bullish OR bearish OR breakout OR breakdown)",
)
TRUE = frozenset({"1", "true", "yes", "on"})


def parse_queries(text: str) -> tuple[str, ...]:
    """One query a line, in order and once each. A line that begins with `#` and a blank is a comment; `#tag` is a query."""
    lines = (line.strip() for line in text.splitlines())
    found = dict.fromkeys(line for line in lines if line and not line.startswith("# "))
    return tuple(found) or DEFAULT_QUERIES


def load_queries(path: str | Path | None) -> tuple[str, ...]:
    where = Path(path) if path else None
    return parse_queries(where.read_text(encoding="utf-8")) if where and where.exists() else DEFAULT_QUERIES


@dataclass(frozen=True)
class Settings:
    data_dir: str = "data"
    log_level: str = "INFO"
    exclude_reposts: bool = True
    window_minutes: int = 15
    vector_features: int = 1 << 14
    rows_per_file: int = 2_000_000
    state_buckets: int = 64
    raw_candidate_multiplier: float = 2.5
    queries: tuple[str, ...] = field(default=DEFAULT_QUERIES)

    def __post_init__(self) -> None:
        for name in ("window_minutes", "vector_features", "rows_per_file", "state_buckets"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")
        if self.raw_candidate_multiplier < 1:
            raise ValueError("raw_candidate_multiplier must be at least 1")
        if not self.queries:
            raise ValueError("at least one query is needed")

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ, prefix: str = "FERNLIGHT_") -> Settings:
        got: dict = {}
        for name, kind in (("data_dir", str), ("log_level", str), ("window_minutes", int), ("vector_features", int), ("rows_per_file", int), ("state_buckets", int), ("raw_candidate_multiplier", float)):
            if value := env.get(prefix + name.upper(), "").strip():
                try:
                    got[name] = kind(value)
                except ValueError:
                    raise ValueError(f"{prefix}{name.upper()} is not a number: {value!r}") from None
        if value := env.get(prefix + "EXCLUDE_REPOSTS", "").strip():
            got["exclude_reposts"] = value.lower() in TRUE
        return cls(**got, queries=load_queries(env.get(prefix + "QUERIES_FILE")))
