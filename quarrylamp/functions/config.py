"""Configuration files."""

from __future__ import annotations

import json
from pathlib import Path


def load_yaml(path: str | Path) -> dict:
    """What a YAML file holds. Without a YAML library only its JSON subset can be read; a missing file raises
    FileNotFoundError."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml
    except ImportError:
        return json.loads(text) if text.strip() else {}
    return yaml.safe_load(text) or {}
