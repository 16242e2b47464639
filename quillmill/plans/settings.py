"""Settings: one JSON file, looked up once, read by dotted path."""

from __future__ import annotations

import copy
import json
import os
from functools import lru_cache
from pathlib import Path

#: The environment variable that names the settings file.
VARIABLE = "QUILLMILL_SETTINGS"


def find_settings(path: str | None = None) -> Path | None:
    """The argument, then the environment variable, then settings.json here; None if there is none."""
    for candidate in (path, os.environ.get(VARIABLE), "settings.json"):
        if candidate and Path(candidate).is_file():
            return Path(candidate)
    return None


@lru_cache(maxsize=8)
def _load(path: Path) -> dict:
    return json.loads(path.read_text(encoding="utf-8"))


class Settings:
    def __init__(self, values: dict | None = None, path: str | None = None):
        found = find_settings(path)
        self.values = values if values is not None else _load(found) if found else {}

    def get(self, dotted: str, default: object = None) -> object:
        """The value at a.b.c, or the default."""
        at: object = self.values
        for key in dotted.split("."):
            if not isinstance(at, dict) or key not in at:
                return default
            at = at[key]
        return copy.deepcopy(at)

    def section_schema(self, name: str) -> list:
        """The schema a section's name maps to, else the one for unhandled content, else []."""
        schemas = self.get("schemas", {})
        key = self.get("section_names", {}).get(name, name)
        return copy.deepcopy(schemas.get(key, schemas.get("unhandled_content", [])))

    def heading_aliases(self) -> str:
        """A line for each type: its headings, comma-joined."""
        return "\n".join(f"{kind}: {', '.join(names)}" for kind, names in self.get("heading_aliases", {}).items())
