"""Settings from a YAML file: sections of plain values."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

SECTIONS = ("paths", "company", "preprocessing", "ocr", "layout", "vlm", "validation", "llm", "runtime")


@dataclass(frozen=True)
class Settings:
    sections: dict[str, dict[str, Any]] = field(default_factory=dict)

    def get(self, section: str, key: str, default: Any = None) -> Any:
        return self.sections.get(section, {}).get(key, default)


def scalar(text: str) -> Any:
    """null, booleans and quoted text as what they are; anything else stays text."""
    plain = text.strip()
    known = {"": None, "null": None, "~": None, "true": True, "false": False}
    if plain.lower() in known:
        return known[plain.lower()]
    return plain[1:-1] if len(plain) > 1 and plain[0] == plain[-1] and plain[0] in "\"'" else plain


def mappings(text: str) -> dict[str, Any]:
    """Nested mappings by indentation, where no YAML library is at hand."""
    root: dict[str, Any] = {}
    open_ = [(-1, root)]
    for line in text.splitlines():
        if not (body := line.split(" #")[0].rstrip()).strip() or body.lstrip().startswith("#"):
            continue
        key, _, value = body.strip().partition(":")
        indent = len(body) - len(body.lstrip())
        while open_[-1][0] >= indent:
            open_.pop()
        if value.strip():
            open_[-1][1][key] = scalar(value)
        else:
            open_[-1][1][key] = inner = {}
            open_.append((indent, inner))
    return root


def load(path: str) -> Settings:
    """The file's settings; a section that isn't a mapping is an error."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml

        raw = yaml.safe_load(text) or {}
    except ImportError:
        raw = mappings(text)
    for name, section in raw.items():
        if name in SECTIONS and not isinstance(section, dict):
            raise ValueError(f"section {name} must be a mapping")
    return Settings({k: v for k, v in raw.items() if isinstance(v, dict)})
