"""Settings: defaults, overlaid by a TOML file's sections and by environment variables.

The file has a section ``default`` and sections named after environments; a variable
``LEXMILL_<NAME>`` goes before both.
"""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass, fields, replace
from pathlib import Path


@dataclass(frozen=True)
class Settings:
    data_dir: str = "data"
    sources_file: str = str(Path(__file__).parent / "resources" / "sources.csv")
    http_timeout: int = 30
    http_retries: int = 3
    http_backoff: float = 0.5
    user_agent: str = "lexmill/0.1"
    log_level: str = "INFO"
    split_ratio: float = 0.8
    seed: int = 42
    storage: str = ""

    @property
    def bronze(self) -> str:
        return f"{self.data_dir}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.data_dir}/silver"

    @property
    def gold(self) -> str:
        return f"{self.data_dir}/gold"

    @property
    def remote(self) -> bool:
        """Whether tables are in an object store rather than a local folder."""
        return "://" in self.data_dir or bool(self.storage)

    def problems(self) -> list[str]:
        """What makes the settings unusable."""
        out = [f"{name} is empty" for name in ("data_dir", "sources_file", "user_agent") if not getattr(self, name)]
        if self.http_timeout <= 0:
            out.append("http_timeout isn't positive")
        if not 0 < self.split_ratio < 1:
            out.append("split_ratio isn't between 0 and 1")
        return out


def load(path: str | None = None, environment: str = "default") -> Settings:
    """Settings from a file's sections and the environment; without a file, from the latter alone."""
    found: dict[str, object] = {}
    if path and Path(path).exists():
        sections = tomllib.loads(Path(path).read_text(encoding="utf-8"))
        found |= sections.get("default", {}) | sections.get(environment, {})
    kinds = {f.name: type(getattr(Settings(), f.name)) for f in fields(Settings)}
    found |= {name: os.environ[key] for name in kinds if (key := f"LEXMILL_{name.upper()}") in os.environ}
    return replace(Settings(), **{name: kinds[name](value) for name, value in found.items() if name in kinds})
