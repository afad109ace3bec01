"""Settings of the stages, and files that overlay them."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Settings:
    """Where the tables are, and what the stages do."""

    documents: str = "documents.parquet"
    benchmark: str = "benchmark.parquet"
    out: str = "out"
    languages: tuple[str, ...] = ()
    gram: int = 13
    target_words: int = int(28e9 / 1.3)
    per_shard: int = 50_000
    chunk: int = 513
    held_out_skip: int = 0
    held_out_docs: int = 10_000
    quotas: dict[str, int] = field(default_factory=dict)

    def overlaid(self, values: dict) -> Settings:
        """These settings with some replaced; dicts are merged key by key, a name that isn't one is an error."""
        known = {f.name: getattr(self, f.name) for f in dataclasses.fields(self)}
        if unknown := sorted(set(values) - set(known)):
            raise ValueError(f"no such settings: {', '.join(unknown)}")
        merged = {k: {**known[k], **v} if isinstance(known[k], dict) else tuple(v) if isinstance(known[k], tuple) else v for k, v in values.items()}
        return dataclasses.replace(self, **merged)


def load(paths: list[str], given: dict | None = None) -> Settings:
    """Settings from files, each of which overlays those before it, then from what is given. JSON, or YAML where PyYAML is installed."""
    settings = Settings()
    for path in paths:
        with open(path) as f:
            if path.endswith((".yaml", ".yml")):
                import yaml

                settings = settings.overlaid(yaml.safe_load(f) or {})
            else:
                settings = settings.overlaid(json.load(f))
    return settings.overlaid(given or {})
