"""Settings from YAML-like text with ``${NAME:default}`` taken from the environment."""

from __future__ import annotations

import json
import os
import re
import shutil
from collections.abc import Mapping
from pathlib import Path
from typing import Any

try:
    import yaml
except ImportError:
    yaml = None

_REFERENCE = re.compile(r"\$\{(\w+)(?::([^}]*))?\}")


def coerce(text: str) -> Any:
    """A boolean, whole number or decimal if the text spells one, else the text."""
    if text.lower() in ("true", "false"):
        return text.lower() == "true"
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def substitute(value: Any, environment: Mapping[str, str] | None = None) -> Any:
    """``value`` with every reference in it, in nested mappings and lists too, replaced; a missing one without default is empty."""
    environment = os.environ if environment is None else environment
    if isinstance(value, dict):
        return {k: substitute(v, environment) for k, v in value.items()}
    if isinstance(value, list):
        return [substitute(v, environment) for v in value]
    if not isinstance(value, str) or not _REFERENCE.search(value):
        return value
    return coerce(_REFERENCE.sub(lambda m: environment.get(m.group(1), m.group(2) or ""), value))


def get(settings: Mapping[str, Any], path: str, default: Any = None) -> Any:
    """The value at a dotted path."""
    for name in path.split("."):
        if not isinstance(settings, Mapping) or name not in settings:
            return default
        settings = settings[name]
    return settings


def put(settings: dict[str, Any], path: str, value: Any) -> dict[str, Any]:
    """``settings`` with the value at a dotted path, as a new mapping."""
    head, _, rest = path.partition(".")
    inner = settings.get(head)
    return settings | {head: put(inner if isinstance(inner, dict) else {}, rest, value) if rest else value}


def load(path: str, environment: Mapping[str, str] | None = None) -> dict[str, Any]:
    """The settings in a JSON or, where its reader is installed, YAML file, references replaced; an empty file has none.

    Files of other types, or whose top is no mapping, raise ValueError.
    """
    text, kind = Path(path).read_text(encoding="utf-8"), Path(path).suffix.lower()
    if kind == ".json":
        found = json.loads(text) if text.strip() else {}
    elif kind in (".yaml", ".yml"):
        if yaml is None:
            raise ValueError("no reader of YAML is installed")
        found = yaml.safe_load(text) or {}
    else:
        raise ValueError(f"not a file of settings: {path!r}")
    if not isinstance(found, dict):
        raise ValueError("settings must be a mapping")
    return substitute(found, environment)


def save(settings: Mapping[str, Any], path: str) -> None:
    """Writes settings to a JSON or YAML file; what was there before is kept beside it as ``.bak``."""
    kind = Path(path).suffix.lower()
    if kind not in (".json", ".yaml", ".yml") or (kind != ".json" and yaml is None):
        raise ValueError(f"cannot write settings to {path!r}")
    text = json.dumps(settings, indent=2, ensure_ascii=False) if kind == ".json" else yaml.safe_dump(dict(settings), allow_unicode=True, sort_keys=False)
    if Path(path).exists():
        shutil.copyfile(path, f"{path}.bak")
    Path(path).write_text(text, encoding="utf-8")


def schema_of(settings: Any) -> dict[str, str]:
    """The type of every setting by its dotted path: ``bool``, ``int``, ``float``, ``str``, ``list`` or ``null``."""
    out: dict[str, str] = {}
    stack: list[tuple[str, Any]] = [("", settings)]
    while stack:
        path, value = stack.pop()
        if isinstance(value, Mapping):
            stack += [(f"{path}.{k}" if path else str(k), v) for k, v in value.items()]
        else:
            out[path] = "null" if value is None else type(value).__name__
    return dict(sorted(out.items()))


def errors(settings: Mapping[str, Any], schema: Mapping[str, str]) -> list[str]:
    """What is missing or of another type than ``schema`` says, in order of paths; whole numbers may stand for decimals."""
    have = schema_of(settings)
    out = []
    for path, kind in sorted(schema.items()):
        if path not in have:
            out.append(f"{path} is missing")
        elif have[path] != kind and not (kind == "float" and have[path] == "int"):
            out.append(f"{path} is {have[path]}, not {kind}")
    return out
