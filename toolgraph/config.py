"""Settings from a ``.env`` text with typed getters; read on demand, never at import."""

from __future__ import annotations

from dataclasses import dataclass, field

TRUE = {"true", "1", "yes", "on"}


@dataclass
class Settings:
    values: dict[str, str] = field(default_factory=dict)

    @classmethod
    def parse(cls, text: str) -> Settings:
        lines = (line.strip() for line in text.splitlines())
        pairs = (line.split("=", 1) for line in lines if line and not line.startswith("#") and "=" in line)
        return cls({k.strip(): v.strip().strip("\"'") for k, v in pairs})

    def get(self, key: str, default: str | None = None) -> str | None:
        return self.values.get(key, default)

    def get_int(self, key: str, default: int = 0) -> int:
        try:
            return int(self.values[key])
        except (KeyError, ValueError):
            return default

    def get_bool(self, key: str, default: bool = False) -> bool:
        return self.values[key].lower() in TRUE if key in self.values else default
