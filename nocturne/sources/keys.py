"""Local service keys from config/keys.yaml into the environment; what is set already stays."""

from __future__ import annotations

import logging
import os
from pathlib import Path

log = logging.getLogger("nocturne.keys")
NAMES = {"astrometry_net": "ASTROMETRY_NET_API_KEY", "nasa": "NASA_API_KEY"}


def load_keys(root: str | Path) -> dict[str, str]:
    """Names that were set by this call. A file that can't be read or isn't a mapping is reported and left out."""
    import yaml

    path = Path(root) / "config" / "keys.yaml"
    if not path.exists():
        return {}
    try:
        data = yaml.safe_load(path.read_text()) or {}
    except yaml.YAMLError as e:
        log.warning("%s can't be read: %s", path, e)
        return {}
    if not isinstance(data, dict):
        log.warning("%s isn't a mapping and is left out", path)
        return {}
    out = {}
    for name, variable in NAMES.items():
        if data.get(name) and not os.environ.get(variable):
            os.environ[variable] = str(data[name]).strip()
            out[variable] = "set"
    return out
