"""Settings of every stage; a frozen value passed to the operators."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, fields, replace
from pathlib import Path


@dataclass(frozen=True)
class Settings:
    instrument: str = "XAUUSD"
    min_price: float = 1500.0
    max_price: float = 5000.0
    classify_threshold: float = 0.7
    resolver_threshold: float = 0.6
    link_window_hours: float = 48.0
    price_tolerance: float = 1.0
    tiebreak_epsilon: float = 0.05
    min_link_confidence: float = 0.6
    win_policy: str = "ANY_TP"
    max_holding_hours: float = 168.0
    default_sl_policy: str = "NONE"
    default_sl_pips: float = 50.0
    bar_interval: str = "1min"
    coverage_ratio: float = 0.5
    version: str = "v0.1"

    def __post_init__(self):
        if self.default_sl_policy not in ("NONE", "FIXED_PIPS"):
            raise ValueError(f"unknown stop policy {self.default_sl_policy!r}")
        if self.win_policy not in ("ANY_TP", "FIRST_TP_ONLY", "FINAL_CLOSE_VS_ENTRY"):
            raise ValueError(f"unknown win policy {self.win_policy!r}")


# Where each setting stands in a settings file.
TOML_KEYS = {
    "instrument": ("instrument", "default"),
    "min_price": ("instrument", "xauusd_min_price"),
    "max_price": ("instrument", "xauusd_max_price"),
    "classify_threshold": ("classify", "rule_confidence_threshold"),
    "resolver_threshold": ("parse", "llm_escalation_threshold"),
    "link_window_hours": ("link", "active_window_hours"),
    "price_tolerance": ("link", "price_match_tolerance"),
    "tiebreak_epsilon": ("link", "llm_tiebreak_epsilon"),
    "win_policy": ("evaluate", "win_policy"),
    "max_holding_hours": ("evaluate", "max_holding_hours"),
    "default_sl_policy": ("evaluate", "default_sl_policy"),
    "default_sl_pips": ("evaluate", "default_sl_pips"),
    "bar_interval": ("market", "interval"),
}


def load(path: str | Path | None = None, **changes) -> Settings:
    """Defaults, then a TOML file if there is one, then keyword changes."""
    found = {}
    if path is not None and Path(path).exists():
        data = tomllib.loads(Path(path).read_text())
        for name, (section, key) in TOML_KEYS.items():
            if key in data.get(section, {}):
                kind = next(f.type for f in fields(Settings) if f.name == name)
                value = data[section][key]
                found[name] = float(value) if kind == "float" else value
    return replace(Settings(), **(found | changes))
