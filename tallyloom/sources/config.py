"""Table configs from YAML-like mappings or JSON files (S16); driver-side metadata only."""

from __future__ import annotations

import json
from collections.abc import Mapping
from pathlib import Path
from typing import Any

from tallyloom.plans.steps import Step
from tallyloom.sinks.spec import LoadSpec, choose_mode


def read_config(path: str) -> dict[str, Any]:
    """A JSON file, or a YAML file where a YAML parser is installed."""
    return parse_config(Path(path).read_text(encoding="utf-8"))


def parse_config(text: str) -> dict[str, Any]:
    """JSON, or YAML where a YAML parser is installed."""
    if text.lstrip().startswith("{"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading YAML needs PyYAML; pass a mapping or a JSON file") from e
    return yaml.safe_load(text)


def _steps(processing: Any) -> list[Step]:
    """Steps of a mapping ``{name: params}`` or a list of names and one-entry mappings (trap T21)."""
    if not processing:
        return []
    items = []
    for entry in processing.items() if isinstance(processing, Mapping) else processing:
        if isinstance(entry, str):
            items.append((entry, None))
        elif isinstance(entry, Mapping):
            items.extend(entry.items())
        else:
            items.append(entry)
    out = []
    for name, params in items:
        if params is False:
            continue
        body = dict(params) if isinstance(params, Mapping) else {}
        body = {k: v for k, v in body.items() if k != "params"}
        out.append(Step(name, body))
    return out


def table_from_config(name: str, config: Mapping[str, Any], order: tuple[str, ...] = ()) -> tuple[list[Step], LoadSpec]:
    """Steps and load spec of one configured table. The config's own key is always used (trap T35)."""
    if config.get("load_mode"):
        keys = tuple((config.get("query") or {}).get("column_name", ()))
        mode, increment = config["load_mode"], ()
    else:
        mode, keys, increment = choose_mode(config)
    spec = LoadSpec(name, keys, mode, order, increment, alert_only=bool(config.get("avoid_insert_data")))
    return _steps(config.get("processing")), spec
