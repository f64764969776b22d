"""Settings: defaults with a local overlay, merged one level deep."""

from __future__ import annotations

import copy
from pathlib import Path

#: The defaults.
DEFAULTS = {
    "flags": {"high_debt_to_equity": 2.0, "ocf_to_net_profit_low": 0.7, "low_liquidity_average_daily_volume": 10000.0, "liquidity_lookback_days": 20, "liquidity_minimum_observations": 5},
    "ocr": {"enabled": True, "dpi": 300, "minimum_characters": 80},
    "confidence_threshold": "0.80",
}


def merged(defaults: dict, local: dict) -> dict:
    """Sections of local replace single keys of the sections of defaults; other values replace whole ones."""
    out = copy.deepcopy(defaults)
    for k, v in local.items():
        out[k] = {**out[k], **v} if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def load(path: str | None = None) -> dict:
    """DEFAULTS with a YAML file over them, if one is given and there."""
    if not path or not Path(path).exists():
        return copy.deepcopy(DEFAULTS)
    import yaml

    return merged(DEFAULTS, yaml.safe_load(Path(path).read_text()) or {})
