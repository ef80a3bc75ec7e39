"""Configuration in markdown: '## Section', 'key: value', and '- item' lists below a key."""

from __future__ import annotations

from pathlib import Path


class ConfigError(ValueError):
    pass


def _unquoted(text: str) -> str:
    text = text.strip()
    return text[1:-1] if len(text) >= 2 and text[0] == text[-1] and text[0] in "\"'`" else text


def parse(text: str) -> dict[str, str | list[str]]:
    """All keys of all sections. A key without a value takes the list below it; '[]' is an empty list."""
    out: dict[str, str | list[str]] = {}
    key = None
    for raw in text.splitlines():
        line = raw.strip()
        if not line or line.startswith(("#", "<!--", ">", "```")):
            key = None if line.startswith("#") else key
        elif line.startswith("- ") and key is not None:
            if not isinstance(out[key], list):
                raise ConfigError(f"{key} has a value and a list")
            out[key].append(_unquoted(line[2:].split(" #")[0]))
        elif ":" in line and not line.startswith(("-", "|")):
            name, _, value = line.partition(":")
            if " " in name.strip():
                key = None
                continue
            key, value = name.strip(), value.split(" #")[0].strip()
            out[key] = [] if value in ("", "[]") else _unquoted(value)
            if out[key] != []:
                key = key if value == "" else None
    return out


class Config:
    def __init__(self, values: dict, root: Path):
        self.values, self.root = values, root

    @classmethod
    def load(cls, path: str) -> Config:
        p = Path(path)
        if not p.is_file():
            raise ConfigError(f"no configuration at {path}")
        return cls(parse(p.read_text(encoding="utf-8")), p.resolve().parent)

    def text(self, key: str, default: str | None = None) -> str:
        if key not in self.values and default is None:
            raise ConfigError(f"missing key {key}")
        value = self.values.get(key, default)
        if isinstance(value, list):
            raise ConfigError(f"{key} is a list")
        return value

    def number(self, key: str, default: float | None = None, kind=float):
        try:
            return kind(self.text(key, None if default is None else str(default)))
        except ValueError as e:
            raise ConfigError(f"{key} is not a number") from e

    def flag(self, key: str, default: bool | None = None) -> bool:
        value = self.text(key, None if default is None else str(default)).lower()
        if value not in ("true", "false", "yes", "no", "1", "0", "on", "off"):
            raise ConfigError(f"{key} is not a flag")
        return value in ("true", "yes", "1", "on")

    def items(self, key: str, default: list[str] | None = None) -> list[str]:
        value = self.values.get(key, default)
        if value is None:
            raise ConfigError(f"missing key {key}")
        return value if isinstance(value, list) else [value]

    def path(self, key: str, default: str | None = None) -> Path:
        p = Path(self.text(key, default)).expanduser()
        return p if p.is_absolute() else self.root / p
