"""Configuration of an endpoint: YAML with a base, merged, checked, and the columns it needs."""

from __future__ import annotations

from datetime import date, datetime
from pathlib import Path


class ConfigError(ValueError):
    """A configuration that can't be run; the message names what is missing."""


def deep_merge(base: dict, over: dict) -> dict:
    """base with over's values; dictionaries are merged, everything else is replaced."""
    out = dict(base)
    for key, value in over.items():
        out[key] = deep_merge(out[key], value) if isinstance(value, dict) and isinstance(out.get(key), dict) else value
    return out


def load_config(path: str, base: str | None = None) -> dict:
    import yaml

    read = lambda p: yaml.safe_load(Path(p).read_text(encoding="utf-8")) or {}
    return deep_merge(read(base), read(path)) if base else read(path)


REQUIRED = {
    "categorical": ("type", "kind", "col_in", "field_out"),
    "transactions": ("type", "reference", "amount", "rate", "when", "created"),
    "due_dates": ("type", "number", "amount", "due", "created"),
    "statements": ("type", "account", "opening", "debits", "credits", "closing", "day", "created"),
}


def validate_config(config: dict, kinds: set[str] | None = None) -> None:
    """Raises ConfigError with every problem found: missing keys, unknown types, missing dictionary files."""
    problems = [f"missing key: {k}" for k in ("api_id", "fields") if not config.get(k)]
    for name, block in (config.get("fields") or {}).items():
        family = block.get("type")
        if family not in REQUIRED:
            problems.append(f"fields.{name}: unknown type {family!r}")
            continue
        problems += [f"fields.{name}: missing key {k}" for k in REQUIRED[family] if not block.get(k)]
        if family == "categorical" and kinds is not None and block.get("kind") not in kinds:
            problems.append(f"fields.{name}: unknown kind {block.get('kind')!r}")
        for key in ("dictionary", "memory"):
            if block.get(key) and key == "dictionary" and not Path(block[key]).exists():
                problems.append(f"fields.{name}: file not found: {block[key]}")
    if problems:
        raise ConfigError("; ".join(problems))


def initial_since(value) -> datetime | None:
    """load.initial_since as a time: text, date or datetime; null or blank for none."""
    if value is None or value == "":
        return None
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    try:
        return datetime.fromisoformat(str(value).strip())
    except ValueError:
        raise ConfigError(f"load.initial_since isn't a date: {value!r}") from None


NOT_COLUMNS = {"type", "kind", "field_out", "dictionary", "memory", "flow", "inclusive", "tolerance", "options", "country_idle", "categories"}


def block_columns(block: dict) -> list[str]:
    """The source columns that a field's block names: its values but for settings, lists unfolded."""
    out = []
    for key, value in block.items():
        if key not in NOT_COLUMNS:
            out += [v for v in (value if isinstance(value, list) else [value]) if isinstance(v, str)]
    return out


def required_columns(config: dict) -> list[str]:
    """All columns to read, in order of mention: fields', the load time's, extras'; synthetic ones (_...) aren't read."""
    named = [c for block in (config.get("fields") or {}).values() for c in block_columns(block)]
    named += [config.get("dt_cr_col", "dtCr"), *config.get("extra_columns", [])]
    return [c for c in dict.fromkeys(named) if c and not c.startswith("_")]


def primary_columns(config: dict) -> list[str]:
    return [b["col_in"] for b in (config.get("fields") or {}).values() if b.get("col_in") and not b["col_in"].startswith("_")]


def reconcile(required: list[str], primary: list[str], available: list[str]) -> tuple[list[str], list[str]]:
    """Columns to read and those left out; a primary column that isn't there is an error."""
    have = {c.lower(): c for c in available}
    lost = [c for c in primary if c.lower() not in have]
    if lost:
        raise ConfigError(f"columns not in the source: {', '.join(lost)}")
    return [have[c.lower()] for c in required if c.lower() in have], [c for c in required if c.lower() not in have]
