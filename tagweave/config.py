"""Run settings: nested YAML, changes with dotted keys, and key=value templates."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping
from pathlib import Path

import yaml


def flatten(nested: Mapping, prefix: str = "") -> dict:
    """Nested mapping with dotted keys."""
    flat = {}
    for key, value in nested.items():
        if isinstance(value, Mapping):
            flat |= flatten(value, f"{prefix}{key}.")
        else:
            flat[f"{prefix}{key}"] = value
    return flat


def combined_changes(changes: Iterable[tuple[str, str]], update_from: Mapping) -> list[tuple[str, str]]:
    """Settings of another file as changes, overruled by explicit ones."""
    taken = {key: "null" if value is None else str(value) for key, value in flatten(update_from).items()}
    return list((taken | dict(changes)).items())


def absolute_path(value: str, workdir: str | Path = ".") -> str:
    """A relative path with ``../`` that exists, made absolute; symbolic links are kept."""
    path = Path(workdir) / value
    if "../" not in value or not path.exists():
        return value
    return os.path.abspath(path) if path.is_symlink() else str(path.resolve())


def apply_changes(settings: dict, changes: Iterable[tuple[str, str]], workdir: str | Path = ".") -> dict:
    """Set dotted keys to values read as YAML."""
    for key, text in changes:
        *parents, last = key.split(".")
        level = settings
        for name in parents:
            level = level[name]
        level[last] = yaml.safe_load(absolute_path(text, workdir))
    return settings


def change_file(path: str | Path, changes: Iterable[tuple[str, str]]) -> dict:
    """Change a settings file; it is replaced only once the new text is complete."""
    path = Path(path)
    settings = apply_changes(yaml.safe_load(path.read_text()) or {}, changes, path.parent)
    fresh = path.with_name(path.name + ".tmp")
    fresh.write_text(yaml.safe_dump(settings, sort_keys=False))
    os.replace(fresh, path)
    return settings


def fill_template(lines: Iterable[str], parameters: Mapping[str, object]) -> list[str]:
    """``key=value`` lines with new values; keys set to None are commented out."""
    filled = []
    for line in lines:
        key, sign, _ = line.partition("=")
        if line.startswith("#") or not sign:
            filled.append(line)
        elif parameters[key] is None:
            filled.append(f"#{line}")
        else:
            filled.append(f"{key}={parameters[key]}\n")
    return filled
