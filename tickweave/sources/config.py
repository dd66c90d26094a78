"""Settings from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from tickweave.schemas import database_name


def names(raw: str | None, default: tuple[str, ...] = ()) -> tuple[str, ...]:
    """A comma list without blanks and empty entries; an empty text or a dash is the empty list."""
    if raw is None:
        return default
    if raw.strip() in ("", "-"):
        return ()
    return tuple(x.strip() for x in raw.split(",") if x.strip())


def boolean(raw: str | None, default: bool) -> bool:
    if raw is None:
        return default
    if raw not in ("true", "false"):
        raise ValueError(f"neither true nor false: {raw!r}")
    return raw == "true"


def positive(raw: str | None, default: int) -> int:
    if raw is None:
        return default
    if not raw.isascii() or not raw.isdigit() or int(raw) < 1:
        raise ValueError(f"not a positive whole number: {raw!r}")
    return int(raw)


@dataclass(frozen=True)
class Config:
    database: str
    binance_spot: tuple[str, ...]
    binance_perpetual: tuple[str, ...]
    okx_spot: tuple[str, ...]
    okx_perpetual: tuple[str, ...]
    funding: bool

    @classmethod
    def load(cls, env: Mapping[str, str] = os.environ) -> Config:
        get = lambda k: env.get(f"TICKWEAVE_{k}")
        return cls(
            database_name(get("DATABASE") or "market_data"), names(get("BINANCE_SPOT")), names(get("BINANCE_PERPETUAL")), names(get("OKX_SPOT")),
            names(get("OKX_PERPETUAL")), boolean(get("FUNDING"), True),
        )
