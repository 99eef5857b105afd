"""Configuration records from a nested mapping or a JSON/YAML file."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from barloom.schema import DiscoverConfig, IngestConfig, SelectionConfig

try:
    import yaml
except ImportError:  # optional: JSON files work without it
    yaml = None


def _tuple(section: Mapping[str, Any], key: str) -> tuple:
    return tuple(section.get(key) or ())


def selection_config(config: Mapping[str, Any]) -> SelectionConfig:
    """From the ``auto_select`` section and the ``manual_*`` lists; defaults where absent."""
    known = SelectionConfig.__dataclass_fields__
    auto = {k: v for k, v in (config.get("auto_select") or {}).items() if k in known}
    return SelectionConfig(
        **auto,
        include_ids=_tuple(config, "manual_include"),
        exclude_ids=_tuple(config, "manual_exclude"),
        include_names=_tuple(config, "manual_include_names"),
        exclude_names=_tuple(config, "manual_exclude_names"),
    )


def ingest_config(config: Mapping[str, Any]) -> IngestConfig:
    """From the ``ingest_targets`` and ``runtime_caps`` sections; defaults where absent."""
    targets = config.get("ingest_targets") or {}
    caps = config.get("runtime_caps") or {}
    known = DiscoverConfig.__dataclass_fields__
    discover = {k: v for k, v in (targets.get("auto_discover") or {}).items() if k in known}
    return IngestConfig(
        include_ids=_tuple(targets, "include_ids"),
        include_names=_tuple(targets, "include_names"),
        exclude_ids=_tuple(targets, "exclude_ids"),
        exclude_names=_tuple(targets, "exclude_names"),
        discover=DiscoverConfig(**discover),
        max_items=caps.get("max_items_per_run", IngestConfig.max_items),
    )


def load_config(path: str) -> dict[str, Any]:
    """A configuration file as a nested mapping."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        return json.loads(text)
    if yaml is None:
        raise RuntimeError("reading YAML needs the yaml package; use a JSON file instead")
    return yaml.safe_load(text) or {}
